"""The logical joins: lookups, resumable work planning, pairings. Strategy is Catalyst's;
sides known to be small are left to its size threshold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def with_seed(items: DataFrame, seeds: DataFrame, how: str = "left") -> DataFrame:
    s = seeds.select(F.col("id").alias("seed_id"), F.col("prompt").alias("seed_prompt"), F.col("expected").alias("seed_expected"), F.lit(True).alias("seed_known"))
    return items.join(s, "seed_id", how)


def orphan_count(items: DataFrame, seeds: DataFrame) -> DataFrame:
    return items.join(seeds.select(F.col("id").alias("seed_id")), "seed_id", "left_anti").agg(F.count(F.lit(1)).alias("orphans"))


def eligible(items: DataFrame, scores: DataFrame) -> DataFrame:
    return items.join(scores.select(F.col("item_id").alias("id")).distinct(), "id", "left_semi")


def cycled(seeds: DataFrame, n: int) -> DataFrame:
    """The first ``n`` of a pool repeated in order: (idx, seed columns). ``seeds`` has a
    0-based ``pos`` per task_family."""
    sized = seeds.withColumn("_size", F.count(F.lit(1)).over(Window.partitionBy("task_family")))
    turns = F.sequence(F.col("pos"), F.lit(n - 1), F.col("_size").cast(sized.schema["pos"].dataType))
    return sized.where(F.col("pos") < n).withColumn("idx", F.explode(turns)).drop("_size", "pos")


def plan_jobs(seeds: DataFrame, languages: DataFrame, existing: DataFrame | None = None, per_combo: int | None = None) -> DataFrame:
    """Jobs (task_family, target_language, seed_id, idx) not done yet, in index-major
    order. ``languages`` (target_language, lang_pos); a seed is planned once a combo."""
    pool = cycled(seeds, per_combo) if per_combo else seeds.withColumnRenamed("pos", "idx")
    jobs = pool.select("task_family", F.col("id").alias("seed_id"), "idx").crossJoin(languages)
    if existing is not None:
        jobs = jobs.groupBy("task_family", "target_language", "lang_pos", "seed_id").agg(F.min("idx").alias("idx"))
        jobs = jobs.join(existing, ["seed_id", "target_language", "task_family"], "left_anti")
    return jobs.orderBy("idx", "task_family", "lang_pos")


def judge_work(items: DataFrame, judges: DataFrame, done: DataFrame, seeds: DataFrame) -> DataFrame:
    """(item, judge) pairs that are not scored yet and whose seed exists."""
    todo = items.select(F.col("id").alias("item_id"), "seed_id").crossJoin(judges.select("judge"))
    return todo.join(done, ["item_id", "judge"], "left_anti").join(seeds.select(F.col("id").alias("seed_id")), "seed_id", "left_semi")


def unscored(items: DataFrame, log: DataFrame) -> DataFrame:
    return items.join(log.select("id").distinct(), "id", "left_anti")


def panel(targets: DataFrame, judges: DataFrame) -> DataFrame:
    """Every target with every judge (or every seed with every model): judges are few."""
    return targets.crossJoin(judges)


def each_of(targets: DataFrame, name: str, values: list[str]) -> DataFrame:
    """Every target with every one of a list: no join, and no Python worker to read the list."""
    return targets.select("*", F.explode(F.array(*map(F.lit, values)).cast("array<string>")).alias(name))


def mismatched(pairs: DataFrame, rows_per_key: str = "language") -> DataFrame:
    """Each row with the vector of the next row of its group, by rotation, so that no
    theta join is needed: adds ``other``."""
    w = Window.partitionBy(rows_per_key).orderBy("id")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return pairs.withColumn("other", F.coalesce(F.lead("vector").over(w), F.first("vector").over(whole)))


def manifest_rows(manifest: DataFrame) -> DataFrame:
    """``manifest`` (provenance: map of task_id to a struct) as a row per task."""
    return manifest.select(F.explode("provenance").alias("task_id", "p")).select("task_id", "p.*")


def provenance(ratings: DataFrame, manifest: DataFrame) -> DataFrame:
    """Ratings with where their item comes from; a manifest document is exploded first."""
    return ratings.join(manifest_rows(manifest) if "provenance" in manifest.columns else manifest, "task_id")


def rater_pairs(ratings: DataFrame, value: str) -> DataFrame:
    """Pairs of different raters of one task."""
    a = ratings.select("task_id", F.col("rater_id").alias("rater_a"), F.col(value).alias("a"))
    b = ratings.select("task_id", F.col("rater_id").alias("rater_b"), F.col(value).alias("b"))
    return a.join(b, "task_id").where("rater_a < rater_b")


def known_seeds(new: DataFrame, pool: DataFrame, key) -> DataFrame:
    """New seeds whose normalised prompt is in the pool."""
    return new.withColumn("_k", key(F.col("prompt"))).join(pool.select(key(F.col("prompt")).alias("_k")).distinct(), "_k", "left_semi").drop("_k")
