"""Nearest neighbours by multi-index hashing.

Codes are the signs of learned rotations (iterative quantisation, fitted on a bounded
sample of ``SAMPLE`` vectors), cut into 16-bit substrings. In each block of rows every
substring is indexed by value. A code within Hamming radius R of a query agrees with it
to within R // substrings bits in at least one substring, so probing every substring to
that radius retrieves every such code; the full distance is then checked and the vectors
themselves give the order. R is the Hamming distance within which ``RECALL`` of the
sample's own nearest neighbours lie; in more data neighbours are nearer, so R holds. A
query with fewer than k rows within R is searched again with R doubled.

The queries are the stated set and go to the blocks of rows in chunks of at most
``CHUNK``, a bound on what is broadcast. Each task returns its k nearest per query.

Cases: vectors that are null, zero, of another dimension, or hold null or non-finite
components take no part, nor do rows without vec_id; ties go to the smaller vec_id; with
fewer candidates all are returned; an empty table gives an empty result. Rows that share a
vec_id count once among a query's neighbours, at their smallest distance; a query that
shares its vec_id is asked once, with the smallest of its vectors.
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import scratch, small_batches

BITS, SUB = 128, 16
SAMPLE = 8192
RECALL = 0.985
CHUNK = 20_000
BLOCK = 32_768


def usable(table: DataFrame, vector: str = "embedding") -> DataFrame:
    """Rows (vec_id, v) whose vectors take part, as doubles."""
    v = F.transform(F.col(vector), lambda x: x.cast("double"))
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return table.select(F.col("vec_id").cast("long"), v.alias("v")).where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & fine)


def learn_rotations(x: np.ndarray, bits: int = BITS, rounds: int = 20, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Mean and projection (dim, bits): as many iterative-quantisation rotations of the
    principal axes as it takes to fill the bits."""
    r = np.random.default_rng(seed)
    mean = x.mean(axis=0)
    x = x - mean
    d = x.shape[1]
    _, axes = np.linalg.eigh(x.T @ x)
    out, made = [], 0
    while made < bits:
        take = min(d, bits - made)
        basis = axes[:, ::-1][:, :take]
        p = x @ basis
        rot, _ = np.linalg.qr(r.normal(size=(take, take)))
        for _ in range(rounds):
            u, _, vt = np.linalg.svd(np.where(p @ rot >= 0, 1.0, -1.0).T @ p)
            rot = (u @ vt).T
        out.append(basis @ rot)
        made += take
    return mean, np.concatenate(out, axis=1)


def encode(x: np.ndarray, mean: np.ndarray, proj: np.ndarray) -> np.ndarray:
    """(n, substrings) codes."""
    return np.packbits((x - mean) @ proj >= 0, axis=1).view(np.uint16)


def hamming(codes: np.ndarray, code: np.ndarray) -> np.ndarray:
    return np.bitwise_count(codes ^ code).sum(axis=1, dtype=np.int64)


class MultiIndex:
    """Rows by the value of each substring of their codes."""

    def __init__(self, codes: np.ndarray):
        self.codes, self.tables = codes, []
        for s in range(codes.shape[1]):
            order = np.argsort(codes[:, s], kind="stable")
            values, at = np.unique(codes[order, s], return_index=True)
            self.tables.append((values, np.append(at, len(order)), order))

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """All rows whose code lies within ``radius``: probe, then check."""
        near = min(SUB, radius // len(self.tables))
        seen = np.zeros(len(self.codes), bool)
        for s, (values, at, order) in enumerate(self.tables):
            if probes(near) < len(values):
                want = np.intersect1d(values, masks(near) ^ code[s], assume_unique=True)
                hit = np.searchsorted(values, want)
            else:  # fewer buckets than probes: look at each
                hit = np.flatnonzero(np.bitwise_count(values ^ code[s]) <= near)
            n = at[hit + 1] - at[hit]
            rows = np.arange(int(n.sum())) + np.repeat(at[hit] - (np.cumsum(n) - n), n)
            seen[order[rows]] = True
        rows = np.flatnonzero(seen)
        return rows[hamming(self.codes[rows], code) <= radius]


def probes(near: int) -> int:
    return sum(math.comb(SUB, k) for k in range(near + 1))


_masks: dict[int, np.ndarray] = {}


def masks(near: int) -> np.ndarray:
    """All substring differences of at most ``near`` bits."""
    if near not in _masks:
        _masks[near] = np.array([sum(1 << b for b in c) for k in range(near + 1) for c in combinations(range(SUB), k)], np.uint16)
    return _masks[near]


def radius_for(x: np.ndarray, codes: np.ndarray, k: int, recall: float = RECALL) -> int:
    """Hamming distance that holds ``recall`` of the k nearest of some sample rows."""
    far = []
    for i in range(0, len(x), max(1, len(x) // 256)):
        d = ((x - x[i]) ** 2).sum(axis=1)
        d[i] = np.inf
        near = np.argsort(d)[: min(k, len(x) - 1)]
        far.append(hamming(codes[near], codes[i]))
    return int(np.quantile(np.concatenate(far), recall)) if far else BITS


def search(vectors: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """``vectors`` and ``queries`` (vec_id, v); the k nearest other rows of each query:
    query_id, rank, vec_id, score (Euclidean distance)."""
    spark = vectors.sparkSession
    small_batches(spark, 4096)
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dims = vectors.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if dims is None:
        return empty
    dim = dims["d"]
    vectors, queries = vectors.where(F.size("v") == dim), queries.where(F.size("v") == dim)
    rows = vectors.orderBy(F.md5(F.col("vec_id").cast("string"))).limit(SAMPLE).collect()
    sample = np.array([r["v"] for r in rows])
    mean, proj = learn_rotations(sample)
    radius = radius_for(sample, encode(sample, mean, proj), k)
    queries = queries.groupBy("vec_id").agg(F.min("v").alias("v"))
    n = queries.count()
    chunks = max(1, math.ceil(n / CHUNK))
    parts = []
    for c in range(chunks):
        todo = queries.where(F.pmod(F.xxhash64("vec_id"), F.lit(chunks)) == c).orderBy("vec_id").collect()
        ids, q = np.array([r["vec_id"] for r in todo], np.int64), np.array([r["v"] for r in todo]).reshape(-1, dim)
        r = radius
        while len(ids):
            found = scratch(_best(_pass(vectors, ids, q, encode(q, mean, proj), mean, proj, r, k), k), "nearest")
            if r >= BITS:
                parts.append(found)
                break
            counts = {x[0]: x[1] for x in found.groupBy("query_id").count().collect()}  # of this chunk's queries
            lack = np.array([counts.get(int(i), 0) < k for i in ids])
            again = spark.createDataFrame([(int(i),) for i in ids[lack]], "query_id long")  # at most CHUNK
            parts.append(found.join(again, "query_id", "left_anti") if lack.any() else found)
            ids, q, r = ids[lack], q[lack], min(BITS, 2 * r + 1)
    out = empty
    for p in parts:
        out = out.union(p)
    return out


def _best(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy("score", "vec_id")
    found = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))  # an id once
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _pass(vectors, ids, q, q_codes, mean, proj, radius: int, k: int) -> DataFrame:
    def run(batches):
        top_d, top_i = [np.zeros(0)] * len(ids), [np.zeros(0, np.int64)] * len(ids)

        def block(vec_ids, x):
            index = MultiIndex(encode(x, mean, proj))
            for j in range(len(ids)):
                rows = index.within(q_codes[j], radius)
                rows = rows[vec_ids[rows] != ids[j]]
                d = np.sqrt(((x[rows] - q[j]) ** 2).sum(axis=1))
                d, i = np.concatenate([top_d[j], d]), np.concatenate([top_i[j], vec_ids[rows]])
                best = np.lexsort((i, d))
                first = np.sort(np.unique(i[best], return_index=True)[1])[:k]  # an id once
                top_d[j], top_i[j] = d[best[first]], i[best[first]]

        held_i, held_x, n = [], [], 0
        for b in batches:
            if not b.num_rows:
                continue
            held_i.append(b.column(0).to_numpy(zero_copy_only=False))
            held_x.append(b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1))
            n += b.num_rows
            if n >= BLOCK:
                block(np.concatenate(held_i), np.concatenate(held_x))
                held_i, held_x, n = [], [], 0
        if n:
            block(np.concatenate(held_i), np.concatenate(held_x))
        sizes = [len(x) for x in top_i]
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, sizes)), pa.array(np.concatenate([*top_i, np.zeros(0, np.int64)])), pa.array(np.concatenate([*top_d, np.zeros(0)]))], ["query_id", "vec_id", "score"])

    return vectors.mapInArrow(run, "query_id long, vec_id long, score double")


def op6_nearest(spark, sf_dir: str) -> DataFrame:
    vectors = usable(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))
    return search(vectors, vectors.where("vec_id % 100 = 0"))
