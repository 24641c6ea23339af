"""Roles that the driver's tables play: items, seeds, labels, logs, vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

TASKS = ("instruction", "qa", "classification", "summarization", "translation", "reasoning")


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def items(spark: SparkSession, d: str) -> DataFrame:
    task = F.element_at(F.array(*map(F.lit, TASKS)), (F.col("doc_id") % 6 + 1).cast("int"))
    return table(spark, d, "documents").select(
        F.col("doc_id").alias("id"), F.concat(F.lit("seed-"), (F.col("doc_id") % 50).cast("string")).alias("seed_id"), task.alias("task_family"),
        F.col("lang").alias("target_language"), F.col("text").alias("prompt"), F.when(F.col("doc_id") % 4 == 0, F.col("text")).when(F.col("doc_id") % 4 == 1, "Yes.").alias("expected"), "source", "n_chars",
    )


ITEMS_SQL = """items AS (
  SELECT doc_id AS id, 'seed-' || CAST(doc_id % 50 AS VARCHAR) AS seed_id,
         ['instruction','qa','classification','summarization','translation','reasoning'][CAST(doc_id % 6 + 1 AS INT)] AS task_family,
         lang AS target_language, text AS prompt, CASE WHEN doc_id % 4 = 0 THEN text WHEN doc_id % 4 = 1 THEN 'Yes.' END AS expected, source, n_chars
  FROM documents)"""


def pairs(spark: SparkSession, d: str) -> DataFrame:
    """Each user turn with the assistant turn right after it."""
    w = Window.partitionBy("conv_id").orderBy("turn")
    c = table(spark, d, "conversations").select("conv_id", "turn", "role", "text", F.lead("role").over(w).alias("next_role"), F.lead("text").over(w).alias("answer"))
    return c.where("role = 'user' AND next_role = 'assistant'").select("conv_id", "turn", F.col("text").alias("prompt"), F.col("answer").alias("expected"))


def attempts(spark: SparkSession, d: str) -> DataFrame:
    """The events as a log of judge attempts; an error is a failed one."""
    return table(spark, d, "events").select("event_id", "ts", (F.col("user_id") % 40).alias("judge"), (F.col("event_type") == "error").alias("failed"), "event_type", "value", "user_id")


def scores(spark: SparkSession, d: str) -> DataFrame:
    """Judge scores: every event is one of three judges on one of a thousand items."""
    e = table(spark, d, "events")
    v = F.abs(F.col("value"))
    axis = lambda k: ((F.floor(v * k) % 101) / 100)
    return e.select((F.col("event_id") % 1000).alias("item_id"), F.concat(F.lit("org/j"), (F.col("user_id") % 3).cast("string")).alias("judge"), axis(10).alias("fluency"), axis(7).alias("faithfulness"), axis(3).alias("bias"))


SCORES_SQL = """scores AS (
  SELECT event_id % 1000 AS item_id, 'org/j' || CAST(user_id % 3 AS VARCHAR) AS judge, CAST(floor(abs(value) * 10) AS BIGINT) % 101 / 100.0::DOUBLE AS fluency,
         CAST(floor(abs(value) * 7) AS BIGINT) % 101 / 100.0::DOUBLE AS faithfulness, CAST(floor(abs(value) * 3) AS BIGINT) % 101 / 100.0::DOUBLE AS bias
  FROM events)"""
