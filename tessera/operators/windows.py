"""Ordered operators: stratified selection, assignment, interleaving, work logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType
from pyspark.sql.window import Window

from ..functions.text import utc_day


def hash_order(seed: str, key: Column) -> Column:
    """A deterministic shuffle key that both this engine and plain SQL can compute."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def select_gold(scores: DataFrame, per_language: int, normal_share: float, seed: str) -> DataFrame:
    """``scores`` (id, language, overall) with stratum borderline or normal: per language
    the items nearest the median, and a shuffled sample of the rest.

    Medians come from an aggregation; a rank up to a constant lets Spark cut each task's
    groups before the shuffle, so no task sorts a language."""
    per = scores.groupBy("language").agg(F.percentile("overall", 0.5).alias("med"), F.count(F.lit(1)).alias("pool"))
    per = per.withColumn("take", F.least(F.lit(per_language), "pool")).withColumn("n_normal", F.bround(F.col("take") * normal_share, 0).cast("int"))
    x = scores.join(per, scores["language"].eqNullSafe(per["language"])).drop(per["language"])
    near = Window.partitionBy("language").orderBy(F.abs(F.col("overall") - F.col("med")), "id")
    border = x.withColumn("rk", F.row_number().over(near)).where(F.col("rk") <= per_language).where(F.col("rk") <= F.col("take") - F.col("n_normal"))
    rest = x.join(border.select("id"), "id", "left_anti")
    shuffled = Window.partitionBy("language").orderBy(hash_order(seed, F.col("id")), "id")
    normal = rest.withColumn("rk", F.row_number().over(shuffled)).where(F.col("rk") <= per_language).where(F.col("rk") <= F.col("n_normal"))
    cols = lambda df, name: df.select("id", "language", "overall", F.lit(name).alias("stratum"))
    return cols(border, "borderline").unionByName(cols(normal, "normal"))


def positions(rows: DataFrame, key: str, chunk: Column, order: list[Column | str], out: str) -> DataFrame:
    """``rows`` with ``out``: 0, 1, ... within each ``key`` by ``chunk``, then ``order``. Rows
    are counted by chunk first, so that no task sorts a whole group."""
    x = rows.withColumn("_chunk", chunk)
    before = Window.partitionBy("_k").orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)
    counts = x.groupBy(F.col(key).alias("_k"), F.col("_chunk").alias("_c")).agg(F.count(F.lit(1)).alias("_n"))
    starts = counts.select("_k", "_c", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    both = x.join(starts, x[key].eqNullSafe(starts["_k"]) & x["_chunk"].eqNullSafe(starts["_c"])).drop("_k", "_c")
    inside = F.row_number().over(Window.partitionBy(key, "_chunk").orderBy(*order))
    return both.withColumn(out, F.col("_start") + inside - 1).drop("_chunk", "_start")


def shuffled_position(rows: DataFrame, key: str, seed: str, id_: str, out: str) -> DataFrame:
    """``positions`` in shuffled order, by chunks of the hash's first digits."""
    x = rows.withColumn("_h", hash_order(seed, F.col(id_)))
    return positions(x, key, F.substring("_h", 1, 3), ["_h", id_], out).drop("_h")


def assign_raters(tasks: DataFrame, raters: list[str], overlap: float, seed: str) -> DataFrame:
    """Alternating primary raters per language; a shuffled share gets the next one too."""
    sizes = tasks.groupBy(F.col("language").alias("_l")).agg(F.count(F.lit(1)).alias("n"))
    x = shuffled_position(tasks, "language", seed, "id", "idx")
    x = shuffled_position(x, "language", seed + "/overlap", "id", "pick")
    x = x.join(sizes, x["language"].eqNullSafe(sizes["_l"])).drop("_l")
    r, k = F.array(*map(F.lit, raters)), len(raters)
    double = (F.col("pick") < F.ceil(F.lit(overlap) * F.col("n"))) if k > 1 else F.lit(False)
    first, second = (F.get(r, F.pmod(F.col("idx") + i, F.lit(k)).cast("int")) for i in (0, 1))
    return x.select("id", "language", F.when(double, F.array(first, second)).otherwise(F.array(first)).alias("raters"), double.alias("overlap"))


def interleave(rows: DataFrame, key: str, within: list[Column], coarse: Column | None = None) -> DataFrame:
    """Round-robin across groups: adds ``turn``; sort by (turn, key). ``coarse``, by which
    ``within`` sorts first, has few values against the rows; with it no task sorts a group."""
    if coarse is not None:
        return positions(rows, key, coarse, within, "_turn").withColumn("turn", F.col("_turn") + 1).drop("_turn")
    return rows.withColumn("turn", F.row_number().over(Window.partitionBy(key).orderBy(*within)))


def congested(log: DataFrame, after: int = 4) -> DataFrame:
    """``log`` (judge, ts, event_id, failed): the event at which each judge first has
    ``after`` failures in a row. A task orders a judge's day; what a day's end carries into
    the next comes from one row a day. Rows whose ``failed`` is null don't count."""
    numeric = isinstance(log.schema["ts"].dataType, NumericType)
    day = F.floor(F.col("ts") / 86_400) if numeric else F.to_date("ts")
    x = log.where("failed IS NOT NULL").select("judge", "ts", "event_id", "failed", day.alias("day"))
    line = Window.partitionBy("judge", "day").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    x = x.withColumn("row", F.row_number().over(Window.partitionBy("judge", "day").orderBy("ts", "event_id"))).withColumn("good", F.max(F.when(~F.col("failed"), F.col("row"))).over(line))
    days = x.groupBy("judge", "day").agg(F.max("row").alias("rows"), F.max("good").alias("good"))
    days = days.select(F.col("judge").alias("_j"), F.col("day").alias("_d"), (F.col("rows") - F.coalesce("good", F.lit(0))).alias("tail"), F.col("good").isNotNull().cast("int").alias("reset"))
    by = Window.partitionBy("_j").orderBy("_d")
    days = days.withColumn("island", F.sum("reset").over(by)).withColumn("tail", F.sum("tail").over(Window.partitionBy("_j", "island").orderBy("_d")))
    days = days.select("_j", "_d", F.lag("tail", 1, 0).over(by).alias("carried"))
    both = x.join(days, x["judge"].eqNullSafe(days["_j"]) & x["day"].eqNullSafe(days["_d"]))
    streak = F.when(F.col("good").isNull(), F.col("row") + F.col("carried")).otherwise(F.col("row") - F.col("good"))
    return both.where(streak >= after).groupBy("judge").agg(F.min(F.struct("ts", "event_id")).alias("at")).select("judge", F.col("at.event_id").alias("event_id"))


def within_budget(log: DataFrame, cap: int, per_run: int | None = None) -> DataFrame:
    """Attempts, failed ones included, up to ``cap`` per UTC day; of new work (``run``
    not null) at most ``per_run`` rows of a run."""
    w = Window.partitionBy("day").orderBy("ts", "event_id")
    out = log.withColumn("day", utc_day(F.col("ts"))).withColumn("attempt", F.row_number().over(w)).where(F.col("attempt") <= cap)
    if per_run is None:
        return out
    turn = F.row_number().over(Window.partitionBy("run").orderBy("ts", "event_id"))
    return out.withColumn("_turn", turn).where(F.col("run").isNull() | (F.col("_turn") <= per_run)).drop("_turn")


def budget_left(log: DataFrame, day: str, cap: int, per_run: int) -> int:
    """How many attempts a run may make: the smaller of its own cap and what is left of
    the day's."""
    used = log.where(utc_day(F.col("ts")) == day).count()
    return max(0, min(per_run, cap - used))


def allocate_ids(new: DataFrame, taken: DataFrame, prefix: str) -> DataFrame:
    """``new`` (key) gets the free numbers of ``prefix%04d`` in key order. ``taken`` (id)."""
    upto = new.count() + taken.count()  # so many numbers leave one for each new row
    free = new.sparkSession.range(1, upto + 1).select(F.format_string(prefix + "%04d", "id").alias("new_id"), F.col("id").alias("num")).join(taken.select(F.col("id").alias("new_id")), "new_id", "left_anti")
    free = free.withColumn("rk", F.row_number().over(Window.orderBy("num")))
    return new.withColumn("rk", F.row_number().over(Window.orderBy("key"))).join(free, "rk").select("key", "new_id")


def first_n(rows: DataFrame, key: str, order: list[str], n: int) -> DataFrame:
    return rows.withColumn("_rn", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where(F.col("_rn") <= n).drop("_rn")


def combo_suffix(items: DataFrame) -> DataFrame:
    """Per (language, task) counter over seed position."""
    w = Window.partitionBy("target_language", "task_family").orderBy("seed_pos", "id")
    return items.withColumn("n", F.row_number().over(w) - 1)
