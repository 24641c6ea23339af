"""A corpus pipeline over ``documents``: five stages, each one operator of tessera.llm,
each applied to all rows that the stage before kept.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns the
next stage's documents, the last one the shards. Null and empty texts go in the first
stage; an empty table passes through; ties and repeated rows are as the operators say
(rows with one doc_id stay or go together; a row without doc_id is no near-duplicate and no
leak). Extra columns pass through the first four stages, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import decontam, langid, mixing, neardup, sharding
from tessera.llm.common import scratch

#: A document is rejected if no language reaches this mean probability over its bytes. Few
#: words, as in a short notice, are told with little more than chance, and are kept.
LEAST_SCORE = 0.3


def _free(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` doesn't have."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``docs`` whose doc_id is not in ``ids`` (doc_id)."""
    gone = _free(docs, "gone_id")
    return docs.join(ids.select(F.col("doc_id").alias(gone)).distinct(), F.col("doc_id") == F.col(gone), "left_anti")


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose language is told with some confidence; without a lang to
    learn from, those that hold a letter."""
    labels, weights = langid.train(langid.sample(docs.where("lang IS NOT NULL").select("doc_id", "text", "lang")))
    if not labels:
        return docs.where(F.col("text").rlike("\\p{L}"))
    pred, score = _free(docs, "lang_pred"), _free(docs, "lang_score")
    told = langid.predict(docs, labels, weights, docs.columns, (pred, score))
    return told.where((F.col(pred) != "und") & (F.col(score) >= LEAST_SCORE)).select(*docs.columns)


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates."""
    return _without(docs, neardup.group(docs).where(~F.col("kept")))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents that hold no benchmark item."""
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return _without(docs, decontam.leaks(docs.select("doc_id", "text"), bench))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    key, copies, turn = (_free(docs, c) for c in ("mixed_id", "mixed_copies", "mixed_turn"))
    taken = mixing.mix(docs.select("doc_id", "text", "source")).groupBy(F.col("doc_id").alias(key)).agg(F.max("copies").alias(copies)).where(F.col(copies) > 0)
    both = docs.join(taken, F.col("doc_id").eqNullSafe(F.col(key)), "inner")
    return both.withColumn(turn, F.explode(F.sequence(F.lit(1), F.col(copies)))).select(*docs.columns)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of each row."""
    return sharding.shard(docs.select("doc_id", "text")).select("doc_id", "size", "text_crc32", "shard", "slot")


STAGES = [
    ("language ID", identified),
    ("near-dedup", deduplicated),
    ("decontamination", decontaminated),
    ("mixing", mixed),
    ("sharding", sharded),
]

#: Learned predictions and bin packing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = scratch(docs, "stage")
    return docs
