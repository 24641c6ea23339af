"""Sinks. Small documents are written by the driver; tables by Spark, append-only."""

from __future__ import annotations

import json
from datetime import UTC, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def seeds_document(seeds: DataFrame) -> str:
    """The JSON document that ``load_seeds`` reads; a seed pool is small by definition."""
    rows = [json.loads(r[0]) for r in seeds.orderBy("id").select(F.to_json(F.struct("*"))).collect()]
    return json.dumps({"seeds": rows}, ensure_ascii=False, indent=2)


def stamp(at: datetime | None = None) -> str:
    return (at or datetime.now(UTC)).strftime("%Y%m%dT%H%M%S%f")


def append_items(items: DataFrame, path: str, fmt: str = "parquet") -> None:
    items.write.partitionBy("target_language", "task_family").mode("append").format(fmt).save(path)


def write_run(items: DataFrame, root: str, model: str, at: datetime | None = None) -> str:
    """Items of one model's run as JSON lines under ``<root>/model=<slug>/run=<time>``, by
    language and task; an earlier run is never overwritten."""
    path = f"{root}/model={model.replace('/', '_').replace(':', '_')}/run={stamp(at)}"
    items.select("*", F.col("target_language").alias("lang"), F.col("task_family").alias("task")).write.partitionBy("lang", "task").mode("errorifexists").json(path)
    return path


def append_log(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").json(path)


def write_scores(ensemble: DataFrame, per_judge: DataFrame, path: str) -> tuple[str, str]:
    """The ensemble's scores, and beside them those of each judge."""
    ensemble.write.mode("errorifexists").json(path)
    per_judge.write.mode("errorifexists").json(f"{path}.per_judge")
    return path, f"{path}.per_judge"


def write_verdicts(verdicts: DataFrame, path: str) -> None:
    rounded = F.transform("results", lambda r: r.withField("score", F.round(r["score"], 4)))
    verdicts.withColumn("results", rounded).write.mode("overwrite").json(path)


def rewrite_valid(spark, path: str, keep, reader, dry_run: bool = False) -> tuple[int, int]:
    """Keep the valid rows of a folder in place: (kept, removed). Spark can't overwrite its
    own input, so the valid rows go beside it and the folders are swapped; the former one
    is deleted last. A second run removes nothing."""
    rows = reader(spark, path)
    good = rows.where(keep)
    n, kept = rows.count(), good.count()
    if dry_run or n == kept:
        return kept, n - kept
    new, old = f"{path.rstrip('/')}.new-{stamp()}", f"{path.rstrip('/')}.old-{stamp()}"
    good.write.json(new)
    files = spark._jvm.org.apache.hadoop.fs
    fs = files.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    for a, b in ((path, old), (new, path)):
        if not fs.rename(files.Path(a), files.Path(b)):
            raise OSError(f"could not move {a} to {b}")
    fs.delete(files.Path(old), True)
    return kept, n - kept


def merge_ratings(spark, batch: DataFrame, path: str) -> None:
    """Merge a batch into the folder of current ratings by a new version, which ``current``
    names once it is whole."""
    now = current_ratings(spark, path)
    merged = upserted(batch if now is None else now.unionByName(batch, allowMissingColumns=True))
    merged.write.parquet(f"{path}/version={stamp()}")


def current_ratings(spark, path: str) -> DataFrame | None:
    """The newest whole version (one with a success mark), or None."""
    files = spark._jvm.org.apache.hadoop.fs
    p = files.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return None
    names = sorted(f.getPath().getName() for f in fs.listStatus(p) if fs.exists(files.Path(f.getPath(), "_SUCCESS")))
    return spark.read.parquet(f"{path}/{names[-1]}") if names else None


def upserted(ratings: DataFrame) -> DataFrame:
    """Latest rating per (rater, task); language, family and rubric stay as first given."""
    w = Window.partitionBy("rater_id", "task_id")
    first, last = w.orderBy("submitted_at", "seq"), w.orderBy(F.desc("submitted_at"), F.desc("seq"))
    frozen = [c for c in ("language", "task_family", "instructions_version") if c in ratings.columns]
    out = ratings.select("*", *[F.first(c).over(first.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias(f"_{c}") for c in frozen], F.row_number().over(last).alias("_rn"))
    out = out.where("_rn = 1").drop("_rn", *frozen)
    for c in frozen:
        out = out.withColumnRenamed(f"_{c}", c)
    return out


def markdown_table(header: list[str], rows: list[list]) -> str:
    line = lambda cells: "| " + " | ".join(str(c) for c in cells) + " |"
    return "\n".join([line(header), line(["---"] * len(header)), *map(line, rows)])


def write_text(spark, text: str, path: str) -> None:
    """A small document to any file system that Spark knows."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark._jsc.hadoopConfiguration()).create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def write_report(spark, title: str, body: str, path: str) -> None:
    write_text(spark, f"# {title}\n\n{body.rstrip()}\n", path)


def write_json(spark, document: dict, path: str) -> None:
    write_text(spark, json.dumps(document, ensure_ascii=False, indent=2), path)
