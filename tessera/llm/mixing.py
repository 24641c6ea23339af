"""Mixing sources to target weights by weighted fair queueing (DataFrame functions only).

Each source's documents are shuffled by a hash of their id and offered up to
``max_repeats`` times, one round after another. A copy's virtual finish time is the words
its source has sent up to its end, divided by the source's weight. All copies are sorted
globally by finish time and cut where the sum of sizes would pass the total budget, so that
sources are served in proportion to their weights, and one that runs out leaves its share
to the others.

The global prefix sum never gathers rows: sums per range of finish times find the range in
which the budget ends, which is split again into ranges, ``LEVELS`` times; only the last
range, about ``RANGES ** LEVELS`` times smaller than the table, is sorted as a whole. The
words of a source before a document are a two-level prefix sum likewise.

Cases: a null text has size 0; null is a source of its own, after all others; an empty
table gives an empty result; repeated rows are separate documents ordered by id and size;
a null doc_id comes after all others of its source; copies that finish at the same time go
by round, source, shuffle key, id and size; other columns are kept out of the way by
selecting only what is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import scratch

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
ROWS_PER_CHUNK = 4_000
RANGES, LEVELS = 1024, 2


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, size (words) and shuffle key ``mix_key``."""
    size = F.coalesce(F.regexp_count("text", F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")
    return docs.select("doc_id", "source", size.alias("size"), F.coalesce(F.md5(F.col("doc_id").cast("string")), F.lit("f" * 32 + "~")).alias("mix_key"))


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS, budget: float = 1.0) -> DataFrame:
    """Per source: source_size, rows, weight, target.

    Shares ``budget`` times all sizes by weight; a target stops at ``max_repeats`` times
    its source's size and the excess goes to the others by weight. Sources by growing
    ``cap / weight``: the first ones are capped as long as the level that the rest would
    reach lies above them.
    """
    n = len(weights)
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("source_rows"))
    by_name = Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())
    pick = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(by_name) - 1) % n + 1).cast("int"))
    per = per.withColumn("weight", pick)
    every = Window.partitionBy(F.lit(0))
    order = every.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, onward = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    per = (
        per.withColumn("cap", F.col("source_size") * max_repeats)
        .withColumn("total", F.sum("source_size").over(every) * F.lit(float(budget)))
        .withColumn("left", F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("reach", F.col("left") / F.sum("weight").over(onward))
        .withColumn("capped", F.col("cap") / F.col("weight") <= F.col("reach"))
    )
    # the level is what the first source that is not capped would reach
    level = F.min(F.when(~F.col("capped"), F.struct(F.col("cap") / F.col("weight"), F.col("source").isNull(), F.col("source"), F.col("reach").alias("reach")))).over(every)["reach"]
    target = F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(F.col("weight") * F.col("level"))
    return per.withColumn("level", level).select("source", "source_size", "source_rows", "weight", target.alias("target"))


def schedule(sized: DataFrame, shares: DataFrame) -> DataFrame:
    """Every document with the words of its source before it: columns of ``sized`` and
    ``shares`` plus ``before``. The prefix sum is two-level: totals of key ranges of
    about ROWS_PER_CHUNK rows meet in a window, documents only within their range."""
    key = F.conv(F.substring("mix_key", 1, 8), 16, 10).cast("long")
    s, t = sized.alias("s"), shares.withColumnRenamed("source", "share_source").alias("t")
    both = s.join(t, F.col("s.source").eqNullSafe(F.col("t.share_source")), "inner").drop("share_source")
    both = both.withColumn("chunk", F.floor(key * F.ceil(F.col("source_rows") / ROWS_PER_CHUNK) / F.lit(float(2**32))).cast("long"))
    sums = both.groupBy("source", "chunk").agg(F.sum("size").alias("chunk_size"))
    w = Window.partitionBy("source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("source").alias("c_source"), F.col("chunk").alias("c_chunk"), F.coalesce(F.sum("chunk_size").over(w), F.lit(0)).alias("chunk_before"))
    both = both.join(sums, F.col("source").eqNullSafe(F.col("c_source")) & (F.col("chunk") == F.col("c_chunk")), "inner")
    inside = Window.partitionBy("source", "chunk").orderBy("mix_key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    return both.withColumn("before", F.col("chunk_before") + F.coalesce(F.sum("size").over(inside), F.lit(0))).drop("c_source", "c_chunk", "chunk_before", "chunk")


def finish(round_):
    """Virtual finish time of a document's copy of a round."""
    return (round_ * F.col("source_size") + F.col("before") + F.col("size")) / F.col("weight")


def offered(planned: DataFrame, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """Every copy with its ``round`` (from 0) and ``finish`` time."""
    return planned.withColumn("round", F.explode(F.sequence(F.lit(0), F.lit(max_repeats - 1)))).withColumn("finish", finish(F.col("round")))


def place(round_, finish):
    """What sorts copies globally, as one comparable struct."""
    source, doc = F.col("source"), F.col("doc_id")
    return F.struct(finish.alias("finish"), round_.alias("round"), source.isNull().alias("no_source"), source.alias("source"), F.col("mix_key").alias("mix_key"), doc.isNull().alias("no_doc"), doc.alias("doc"), F.col("size").alias("size"))


def last_sent(planned: DataFrame, budget: int, max_repeats: int = MAX_REPEATS):
    """The ``place`` of the last copy within ``budget`` words as a column, or None if there
    is none. Only sums per range of finish times come to the driver."""
    offers = offered(planned, max_repeats)
    now, left = offers, budget
    low, high = offers.agg(F.min("finish"), F.max("finish")).first()
    for _ in range(LEVELS):
        if low is None or low == high:
            break
        at = F.floor((F.col("finish") - low) / ((high - low) / RANGES))
        sums = sorted(now.groupBy(at.alias("at")).agg(F.min("finish"), F.max("finish"), F.sum("size")).collect())
        for _, low, high, n in sums:
            if n > left:
                break
            left -= n
        else:
            left += n  # all fit: the last range is sorted as any other
        now = offers.where(F.col("finish").between(low, high))
    spot = place(F.col("round"), F.col("finish"))
    edge = now.withColumn("place", spot).withColumn("sent", F.sum("size").over(Window.orderBy("place").rowsBetween(Window.unboundedPreceding, 0)))
    last = edge.where(F.col("sent") <= left).agg(F.max("place")).first()[0]
    if last is None:  # none of this range: the one before it is the last
        last = offers.where(F.col("finish") < low).agg(F.max(spot)).first()[0]
    if last is None:
        return None
    kinds = edge.schema["place"].dataType
    return F.struct(*[F.lit(last[f.name]).cast(f.dataType).alias(f.name) for f in kinds])


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = MAX_REPEATS, budget: float = 1.0) -> DataFrame:
    """doc_id, source, size, source_size, target, weight, before, copies, taken for each
    document; ``copies`` of it are in the mix."""
    sized = scratch(sizes(docs), "mix")
    planned = scratch(schedule(sized, targets(sized, weights, max_repeats, budget)), "queue")
    words = planned.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    last = last_sent(planned, int(words * budget), max_repeats)
    copies = F.lit(0)
    if last is not None:
        copies = sum((place(F.lit(e), finish(F.lit(e))) <= last).cast("int") for e in range(max_repeats))
    done = planned.withColumn("copies", copies)
    return done.select("doc_id", "source", "size", "source_size", "target", "weight", "before", "copies", (F.col("size") * F.col("copies")).alias("taken"))


def sequence(mixed: DataFrame) -> DataFrame:
    """The mix itself: one row per copy taken, range-sorted globally by finish time."""
    rows = mixed.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    return rows.withColumn("finish", finish(F.col("copy"))).orderBy("finish", "copy", F.col("source").asc_nulls_last(), "doc_id")


def op5_mixing(spark, sf_dir: str) -> DataFrame:
    mixed = mix(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


#: {docs} is the table; the steps of the module in one statement.
SQL_TEMPLATE = """
WITH sized AS (
  SELECT doc_id, source, CAST(CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) END AS BIGINT) AS size,
         md5(CAST(doc_id AS VARCHAR)) AS mix_key
  FROM {docs}),
named AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, ((row_number() OVER (ORDER BY source ASC NULLS LAST)) - 1) % 3 AS k
  FROM sized GROUP BY source),
weighed AS (
  SELECT source, source_size, CASE k WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight,
         3 * source_size AS cap, CAST(sum(source_size) OVER () AS DOUBLE) AS total FROM named),
ranked AS (SELECT *, row_number() OVER (ORDER BY cap / weight, source ASC NULLS LAST) AS rk FROM weighed),
reached AS (
  SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY rk ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS reach FROM ranked),
levels AS (SELECT *, cap / weight <= reach AS capped FROM reached),
targets AS (
  SELECT source, source_size, weight, CASE WHEN capped THEN CAST(cap AS DOUBLE)
         ELSE weight * (SELECT arg_min(reach, rk) FROM levels WHERE NOT capped) END AS target FROM levels),
placed AS (
  SELECT s.*, t.source_size, t.target, t.weight,
         CAST(coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.mix_key, s.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
offers AS (
  SELECT *, (e * source_size + before + size) / weight AS finish FROM placed, range(0, 3) r(e)),
sent AS (
  SELECT *, sum(size) OVER (ORDER BY finish, e, source NULLS LAST, mix_key, doc_id NULLS LAST, size ROWS UNBOUNDED PRECEDING) AS upto, sum(CASE WHEN e = 0 THEN size END) OVER () AS budget FROM offers)
SELECT doc_id, size, source_size, target, CAST(coalesce(sum(size) FILTER (upto <= budget), 0) AS BIGINT) AS taken
FROM sent GROUP BY doc_id, size, source_size, target, source, mix_key, before
"""

SQL = SQL_TEMPLATE.format(docs="documents")
