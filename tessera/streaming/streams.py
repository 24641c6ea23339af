"""Incremental forms of the batch behaviours, as Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.sinks import current_ratings, merge_ratings


def unseen(stream: DataFrame, key: str = "id", ts: str | None = None, late: str = "7 days") -> DataFrame:
    """Each key once, across restarts by the checkpoint. With a time column a key is
    forgotten ``late`` after it was seen, which bounds the state; without one every key is
    kept."""
    if ts is None:
        return stream.dropDuplicates([key])
    return stream.withWatermark(ts, late).dropDuplicatesWithinWatermark([key])


def daily_ledger(stream: DataFrame, late: str = "2 days") -> DataFrame:
    """Attempts per judge and UTC day."""
    return stream.withWatermark("ts", late).groupBy(F.window("ts", "1 day").alias("day"), "judge").agg(F.count(F.lit(1)).alias("used"))


def failure_streaks(stream: DataFrame, after: int = 4) -> DataFrame:
    """(judge, streak) in the batch in which a judge reaches ``after`` failures in a row, with
    the longest streak of that batch, and not again while the streak goes on; a success
    resets the count, which lives in the state store. ``stream``: judge, ts, failed. A
    judge's rows of a batch are ordered by ts as a whole."""
    import pandas as pd
    from pyspark.sql.streaming.state import GroupStateTimeout

    def step(key, frames, state):
        n = state.get[0] if state.exists else 0
        rows = pd.concat(list(frames)).sort_values("ts")
        reached, longest = False, 0
        for bad in rows["failed"]:
            n = n + 1 if bad else 0
            reached, longest = reached or n == after, max(longest, n)
        state.update((n,))
        if reached:
            yield pd.DataFrame({"judge": [key[0]], "streak": [longest]})

    return stream.groupBy("judge").applyInPandasWithState(step, "judge long, streak long", "n long", "append", GroupStateTimeout.NoTimeout)


def upsert_into(spark, path: str):
    """foreachBatch function that merges ratings into a table of the current ones, and a
    reader of it."""

    def put(batch: DataFrame, _epoch: int) -> None:
        merge_ratings(spark, batch, path)

    return put, lambda: current_ratings(spark, path)
