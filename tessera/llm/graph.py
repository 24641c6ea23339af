"""Connected components of an edge table, without gathering a component anywhere."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_scratch, lean, scratch


@lean
def _forest(batches):
    """Union-find over one partition's edges: each node with its smallest reachable id."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while parent.setdefault(root, root) != root:
            root = parent[root]
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    def flush():
        ids = np.fromiter(parent, np.int64, len(parent))
        roots = np.fromiter((find(int(x)) for x in ids), np.int64, len(ids))
        keep = ids != roots
        parent.clear()
        return pa.RecordBatch.from_arrays([pa.array(ids[keep]), pa.array(roots[keep])], ["a", "b"])

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            x, y = find(a), find(b)
            if x != y:
                parent[max(x, y)] = min(x, y)
        if len(parent) > 1_000_000:  # bounded memory; the rest is joined across partitions
            yield flush()
    if parent:
        yield flush()


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b) of ids. Returns id, component (smallest id reachable) for each
    node other than its component's smallest. Contracts each partition by union-find,
    then alternates large-star and small-star rounds until nothing changes."""
    now = scratch(edges.select("a", "b").where("a <> b").mapInArrow(_forest, "a long, b long"), "forest")
    mark = None
    while True:
        both = now.select("a", "b").union(now.select("b", "a"))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
        large = both.join(low, F.col("a") == F.col("n")).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), "m")
        small = large.join(low, F.col("a") == F.col("n")).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        new = scratch(small.union(low.select("n", "m")).distinct(), "stars")
        drop_scratch(now)
        now = new
        was, mark = mark, now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == was:
            return now.select(F.col("a").alias("id"), F.col("b").alias("component"))
