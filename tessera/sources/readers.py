"""Scans. Last-wins and first-wins rules are by file (path components) and line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SEED = ("id string, task_family string, prompt string, expected string, metadata map<string,string>, labels array<string>")
ITEM = (
    "id string, seed_id string, task_family string, target_language string, prompt string, expected string, metadata map<string,string>, "
    "generation struct<seed_id:string,target_language:string,teacher_model:string,temperature:double,max_tokens:int,prompt_template_name:string>, generated_at timestamp, raw_response string"
)
JUDGE_LOG = ("item_id string, seed_id string, lang string, task string, judge string, fluency double, faithfulness double, bias double, overall double, rationale string, ts timestamp")
BT_LOG = ("id string, seed_id string, lang string, task string, translator string, cos double, back_translation string, error string")


def load_seeds(spark: SparkSession, path: str) -> DataFrame:
    """Rows of ``{"seeds": [...]}``; ValueError without that key."""
    raw = spark.read.text(path, wholetext=True)
    doc = raw.select(F.from_json("value", "seeds array<struct<" + SEED.replace(" string", ":string").replace(" map<", ":map<").replace(" array<", ":array<") + ">>").alias("d"))
    if doc.where("d.seeds IS NOT NULL").isEmpty():
        raise ValueError(f"{path} has no seeds")
    return doc.select(F.posexplode("d.seeds").alias("pos", "s")).select("s.*", "pos")


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def json_lines(spark: SparkSession, path: str, schema: str, glob: str = "*.jsonl") -> DataFrame:
    """JSONL rows with their order (``file`` by path components, ``line`` by block of the
    file and row within it); blank and malformed lines are skipped, an absent path has
    none. Files are split as Spark splits them: no file is one row."""
    if not exists(spark, path):
        return spark.createDataFrame([], f"file array<string>, line struct<block:long,row:long>, r struct<{', '.join(_fields(schema))}>")
    raw = spark.read.text(path, pathGlobFilter=glob, recursiveFileLookup=True)
    line = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    lines = raw.select(F.split(F.col("_metadata.file_path"), "/").alias("file"), line.alias("line"), F.col("value").alias("text"))
    return lines.where(F.trim("text") != "").select("file", "line", F.from_json("text", schema).alias("r")).where("r IS NOT NULL")


def _fields(schema: str) -> list[str]:
    """``a string, b int`` as fields of a struct type."""
    from pyspark.sql.types import StructType

    return [f"{f.name}: {f.dataType.simpleString()}" for f in StructType.fromDDL(schema)]


def last_wins(rows: DataFrame, key: str) -> DataFrame:
    """One record per key, the last in file order, by partial aggregation."""
    return rows.where(F.col(f"r.{key}").isNotNull()).groupBy(F.col(f"r.{key}").alias("_k")).agg(F.max_by("r", F.struct("file", "line")).alias("r")).select("r.*")


def load_items(spark: SparkSession, path: str) -> DataFrame:
    return last_wins(json_lines(spark, path, ITEM), "id")


def load_scores(spark: SparkSession, path: str) -> DataFrame:
    return last_wins(json_lines(spark, path, JUDGE_LOG), "item_id")


def generated_seed_keys(spark: SparkSession, path: str) -> DataFrame:
    """Distinct (seed_id, target_language, task_family) already generated."""
    keys = json_lines(spark, path, ITEM).select("r.seed_id", "r.target_language", "r.task_family")
    return keys.dropna().distinct()


def existing_counts(items: DataFrame) -> DataFrame:
    return items.groupBy("target_language", "task_family").agg(F.countDistinct("id").alias("n"))


def done_pairs(log: DataFrame) -> DataFrame:
    return log.select("item_id", "judge").distinct()


def scored_ids(log: DataFrame) -> DataFrame:
    return log.select("id").distinct()


def without_translation(items: DataFrame) -> DataFrame:
    """On a table partitioned by task family this prunes partitions."""
    return items.where(F.col("task_family") != "translation")


def seed_pools(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The seeds of several files in file order, for ``merge_pools``; absent files have
    none."""
    out = None
    for i, path in enumerate(sorted(paths)):
        if exists(spark, path):
            one = load_seeds(spark, path).withColumn("file", F.lit(i))
            out = one if out is None else out.unionByName(one)
    if out is None:
        raise ValueError("none of the seed files exists")
    return out


def merge_pools(pools: DataFrame) -> DataFrame:
    """``pools`` (file, pos, seed columns): mock seeds out, the first file's id wins."""
    w = Window.partitionBy("id").orderBy("file", "pos")
    return pools.where(~F.col("prompt").contains("[mock")).withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def read_csv(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    return spark.read.csv(path, header=True, schema=schema) if schema else spark.read.csv(path, header=True, inferSchema=True)


def read_export(spark: SparkSession, source: str, schema: str | None = None, **jdbc: str) -> DataFrame:
    """Ratings from the database (a ``jdbc:`` url with ``dbtable`` or ``query``; a
    ``partitionColumn`` with bounds reads in parallel) or from its csv export."""
    if source.startswith("jdbc:"):
        return spark.read.format("jdbc").options(url=source, **jdbc).load()
    return read_csv(spark, source, schema)


def fetch_bundle(items: DataFrame, language: str, seed: str, limit: int = 20) -> DataFrame:
    """A rater's shuffled page of one language."""
    return items.where(F.col("language") == language).orderBy(F.md5(F.concat_ws(":", F.lit(seed), "task_id")), "task_id").limit(limit)
