"""Selecting from and merging seed and item pools."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as T
from .gates import SEED_NEEDS_ANSWER
from .windows import hash_order

# The task families.
TASKS = ("instruction", "qa", "classification", "summarization", "translation", "reasoning")


def of_task(rows: DataFrame, task: str) -> DataFrame:
    return rows.where(F.col("task_family") == task)


def resolve_tasks(spec: str) -> list[str]:
    """``all`` or a comma list of task families; ValueError for any other."""
    names = list(TASKS) if spec.strip() == "all" else [t.strip() for t in spec.split(",") if t.strip()]
    unknown = [t for t in names if t not in TASKS]
    if unknown or not names:
        raise ValueError(f"unknown task {', '.join(unknown) or spec!r}; there are {', '.join(TASKS)}")
    return names


def of_tasks(rows: DataFrame, spec: str) -> DataFrame:
    return rows.where(F.col("task_family").isin(*resolve_tasks(spec)))


def of_rubric(ratings: DataFrame, version: str) -> DataFrame:
    """Ratings given under one version of the instructions."""
    return ratings.where(F.col("instructions_version") == version)


def low_scores(rows: DataFrame, value: str, below: float) -> DataFrame:
    """Candidates for a review; a missing value is none."""
    return rows.where(F.col(value) < below)


def head(pool: DataFrame, n: int, order: str = "pos") -> DataFrame:
    """The first ``n`` of an ordered pool, ties by id."""
    ties = ["id"] if "id" in pool.columns and order != "id" else []
    return pool.orderBy(order, *ties).limit(n)


def examples(rows: DataFrame, keys: list[str], value: str, n: int) -> DataFrame:
    """Per group its size and the first ``n`` values in order. Ranks are cut by Spark's
    group limit before the shuffle, so a hot group sends ``n`` rows a task."""
    w = Window.partitionBy(*keys).orderBy(value)
    few = rows.select(*keys, value).withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n)
    first = few.groupBy(*keys).agg(F.array_sort(F.collect_list(value)).alias("examples"))
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return sizes.join(first, keys, "left")


def sampled(rows: DataFrame, key: str, id_: str, n: int, seed: str) -> DataFrame:
    """``n`` rows of each group in a deterministic shuffled order."""
    w = Window.partitionBy(key).orderBy(hash_order(seed, F.col(id_)), id_)
    return rows.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def all_ids(*pools: DataFrame, key: str = "id") -> DataFrame:
    """Ids of any of the pools, once each."""
    out = pools[0].select(key)
    for p in pools[1:]:
        out = out.union(p.select(key))
    return out.distinct()


def united(*pools: DataFrame) -> DataFrame:
    """All rows of the pools; a column that one lacks is null there."""
    out = pools[0]
    for p in pools[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def merged_metadata(left: Column, right: Column) -> Column:
    """Both maps' entries; the right one wins."""
    left, right = F.coalesce(left, F.create_map().cast("map<string,string>")), F.coalesce(right, F.create_map().cast("map<string,string>"))
    return F.map_concat(F.map_filter(left, lambda k, _: ~F.map_contains_key(right, k)), right)


def with_duplicates(candidates: DataFrame, known: DataFrame) -> DataFrame:
    """``candidates`` (prompt, drop_reason, pos, ...): those not dropped whose normalised
    prompt is among ``known`` (prompt) or an earlier candidate get the reason duplicate."""
    w = Window.partitionBy("_key", "_in").orderBy("pos")
    x = candidates.withColumn("_key", T.norm_key(F.col("prompt"))).withColumn("_in", F.col("drop_reason").isNull())
    x = x.withColumn("_turn", F.row_number().over(w))
    old = known.select(T.norm_key(F.col("prompt")).alias("_key")).distinct().withColumn("_old", F.lit(True))
    x = x.join(old, "_key", "left")
    again = F.col("_in") & ((F.col("_turn") > 1) | F.col("_old").isNotNull())
    return x.withColumn("drop_reason", F.when(again, "duplicate").otherwise(F.col("drop_reason"))).drop("_key", "_in", "_turn", "_old")


def seed_review(new: DataFrame, pool: DataFrame) -> DataFrame:
    """One row: counts of new seeds that repeat a prompt or an id of the pool, have labels
    without their answer, show no options, or lack an answer; and the five first ids."""
    prompts = pool.select(T.norm_key(F.col("prompt")).alias("_key")).distinct().withColumn("_dup", F.lit(True))
    ids = pool.select("id").distinct().withColumn("_clash", F.lit(True))
    x = new.withColumn("_key", T.norm_key(F.col("prompt"))).join(prompts, "_key", "left").join(ids, "id", "left")
    is_class, answer = F.col("task_family") == "classification", F.coalesce("expected", F.lit(""))
    shown = F.size(F.filter("labels", lambda v: F.contains(F.lower("prompt"), F.lower(v))))
    first = head(new.select("id"), 5, "id").agg(F.array_sort(F.collect_list("id")).alias("first_ids"))
    counts = x.agg(
        F.count(F.lit(1)).alias("seeds"), F.count_if(F.col("_dup")).alias("duplicates"), F.count_if(F.col("_clash")).alias("id_clashes"),
        F.count_if(is_class & ~F.coalesce(F.array_contains("labels", answer), F.lit(False))).alias("bad_labels"),
        F.count_if(is_class & (F.coalesce(shown, F.lit(0)) < 2)).alias("no_options"), F.count_if(F.col("task_family").isin(*SEED_NEEDS_ANSWER) & (answer == "")).alias("missing_expected"),
    )
    return counts.crossJoin(first)  # one row each
