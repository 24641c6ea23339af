"""Sharding by best-fit-decreasing bin packing over indivisible groups (equal texts).

Groups of one size are interchangeable, so packing needs only the histogram of group
sizes: from the largest size down, the bin with the least room that still fits takes as
many groups of that size as it can, found by bisection in a sorted list of free room.
The histogram has one row per distinct size, at most as many as the largest group has
bytes, however many documents there are; it is the only thing the driver sees. The
packing's answer, ranges of ranks per size, is joined back to the groups.

Cases: a null text has no bytes and forms one group, apart from empty texts; a group
larger than an even share gets a shard of its own, and the rest is packed evenly into
the others; an empty table gives an empty result; repeated rows share their group.
"""

from __future__ import annotations

import bisect

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import numbered, scratch

SHARDS = 8


def pack(histogram: list[tuple[int, int]], shards: int) -> list[tuple[int, int, int, int]]:
    """Best-fit-decreasing of ``(size, count)`` into ``shards`` bins of the smallest
    capacity at which all fit: ``(size, first rank, end rank, shard)`` runs."""
    left = sorted(((s, n) for s, n in histogram if n), reverse=True)
    out: list[tuple[int, int, int, int]] = []
    skip: dict[int, int] = {}
    used, total = 0, sum(s * n for s, n in left)
    while left and used < shards - 1 and left[0][0] * (shards - used) >= total:
        size, n = left[0]
        out.append((size, skip.get(size, 0), skip.get(size, 0) + 1, used))
        skip[size] = skip.get(size, 0) + 1
        total -= size
        used += 1
        left[0] = (size, n - 1)
        if n == 1:
            left.pop(0)
    if not left:
        return out
    low = -(-total // (shards - used))
    high = low + left[0][0]
    best = None
    while best is None or low < high:
        at = (low + high) // 2 if best is not None else high
        runs = _fit(left, shards - used, at)
        if runs is None:
            low, high = at + 1, max(high, at + 1 if best is not None else 2 * at)
        else:
            best, high = runs, at
    return out + [(s, a + skip.get(s, 0), b + skip.get(s, 0), k + used) for s, a, b, k in best]


def _fit(items: list[tuple[int, int]], bins: int, capacity: int) -> list[tuple[int, int, int, int]] | None:
    """One best-fit-decreasing pass at a capacity, None if something is left over."""
    room = [(capacity, k) for k in range(bins)]  # sorted by free room
    runs = []
    for size, n in items:
        at = 0
        while at < n:
            i = bisect.bisect_left(room, (size, -1))
            if i == len(room):
                return None
            free, k = room.pop(i)
            take = min(n - at, free // size)
            runs.append((size, at, at + take, k))
            at += take
            bisect.insort(room, (free - take * size, k))
    return runs


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, group_id, shard, slot for each row of ``docs``."""
    spark = docs.sparkSession
    raw = F.col("text").cast("string").cast("binary")
    sized = scratch(
        docs.select(
            "doc_id",
            (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
            F.coalesce(F.crc32(raw), F.lit(0)).cast("long").alias("text_crc32"),
            F.coalesce(F.md5(raw), F.lit("null")).alias("group_id"),
        ),
        "shard",
    )
    groups = scratch(sized.groupBy("group_id").agg(F.sum("size").alias("group_size")), "groups")
    histogram = [(r[0], r[1]) for r in groups.groupBy("group_size").count().collect()]
    runs = spark.createDataFrame(pack(histogram, shards), "run_size long, low long, high long, shard int")
    ranked = numbered(groups, ["group_size"], ["group_id"], "rk")
    placed = ranked.join(runs, (F.col("group_size") == F.col("run_size")) & (F.col("rk") >= F.col("low")) & (F.col("rk") < F.col("high")), "inner")
    placed = scratch(sized.join(placed.select("group_id", "shard"), "group_id", "inner"), "placed")
    return numbered(placed, ["shard"], ["doc_id", "group_id"], "slot")


def op7_sharding(spark, sf_dir: str) -> DataFrame:
    done = shard(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return done.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
