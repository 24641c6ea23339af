"""What the operators share: a folder all executors see, packed Arrow batches, a
vectorised byte tokenizer and gapless numbering without one-task windows."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import math
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Bytes of text that one numpy step takes at a time; bounds a Python worker's memory.
SLICE_BYTES = 2 << 20

_own_dirs: dict[str, str] = {}


# --------------------------------------------------------------------- shared tables
def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a temporary one only where a single
    local JVM runs everything (tests)."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if at:
        return at.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_dirs:
        _own_dirs[app] = "file://" + tempfile.mkdtemp(prefix="tessera-")
    return _own_dirs[app]


def scratch(df: DataFrame, name: str = "t") -> DataFrame:
    """Cut the lineage: write ``df`` to the shared folder and read it again. A lost
    executor then costs a re-read, not the computation."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tessera/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def drop_scratch(df: DataFrame) -> None:
    """Delete a table made by ``scratch`` that no pending result reads any more."""
    spark, path = df.sparkSession, df._scratch_path
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def small_batches(spark: SparkSession, rows: int = 2048) -> None:
    """Arrow batches that keep a worker's memory small however long the texts are."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# --------------------------------------------------------------------- memory of processes that stay
def give_back() -> None:
    """Return what this process has freed to the system. Spark keeps Python workers, more of
    them than there are cores, and each would stay as large as its largest task."""
    global _pow, _inv
    if len(_pow) > POWERS:
        _pow, _inv = _pow[:POWERS].copy(), _inv[:POWERS].copy()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # glibc only
        ctypes.CDLL(None).malloc_trim(0)


def lean(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A task over Arrow batches that gives its memory back when it ends."""

    @functools.wraps(run)
    def task(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return task


# --------------------------------------------------------------------- numbering
def numbered(df: DataFrame, group: list[str], order: list[str], out: str, rows_per_task: int = 20_000) -> DataFrame:
    """Add ``out``: 0, 1, 2... within each ``group``, without gaps.

    ``order`` must be unique within the group. A hot group is dealt to hash chunks of
    about ``rows_per_task`` rows; only the chunks' counts meet in a window. ``df`` is
    read twice, so pass a stored table.
    """
    chunks = max(1, math.ceil(df.count() / rows_per_task))
    salted = df.withColumn("_chunk", F.pmod(F.xxhash64(*order), F.lit(chunks)).cast("int"))
    counts = salted.groupBy(*group, "_chunk").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*group).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*group, "_chunk", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    same = [salted[c].eqNullSafe(starts[c]) for c in [*group, "_chunk"]]
    cond = same[0]
    for s in same[1:]:
        cond = cond & s
    joined = salted.join(starts, cond, "inner").drop(*[starts[c] for c in [*group, "_chunk"]])
    within = Window.partitionBy(*group, "_chunk").orderBy(*order)
    return joined.withColumn(out, (F.col("_start") + F.row_number().over(within) - 1).cast("long")).drop("_chunk", "_start")


# --------------------------------------------------------------------- Arrow batches
def text_slices(batch: pa.RecordBatch, col: str | int = "text", limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of consecutive row ranges of about ``limit``
    bytes of text; one longer text makes a range of its own. Null counts as empty."""
    arr = batch.column(col)
    if pa.types.is_string(arr.type) or pa.types.is_binary(arr.type):
        kind = np.int32
    else:
        arr, kind = arr.cast(pa.large_string()), np.int64
    if arr.null_count:
        arr = arr.fill_null("")
    n = len(arr)
    if not n:
        return
    _, offs, data = arr.buffers()
    off = np.frombuffer(offs, kind, n + 1, arr.offset * np.dtype(kind).itemsize).astype(np.int64)
    buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    a = 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(off, off[a] + limit, side="right")) - 1)
        b = min(b, n)
        yield a, b, buf[off[a] : off[b]], off[a : b + 1] - off[a]
        a = b


def binary_column(parts: list[bytes]) -> pa.Array:
    return pa.array(parts, pa.binary())


# --------------------------------------------------------------------- tokenizer
WS = np.zeros(256, bool)
WS[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_rng = np.random.default_rng(0x5EED)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_P = 0x9E3779B97F4A7C15 | 1
_PINV = pow(_P, -1, 1 << 64)
#: Powers that a worker keeps; longer tables are made anew by the tasks that need them.
POWERS = (1 << 19) + 1
_pow = np.ones(1, np.uint64)
_inv = np.ones(1, np.uint64)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit words."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def _powers(n: int) -> None:
    global _pow, _inv
    if len(_pow) < n:
        n = POWERS if n <= POWERS else max(n, 1 << 21)
        for name, base in (("_pow", _P), ("_inv", _PINV)):
            x = np.full(n, base, np.uint64)
            x[0] = 1
            globals()[name] = np.cumprod(x, dtype=np.uint64)


def words(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends (exclusive) and counts per text of the words ``[^\\x20\\x09-\\x0D]+``."""
    if not len(buf):
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(off) - 1, np.int64)
    body = ~WS[buf]
    edge = np.zeros(len(buf) + 1, bool)
    edge[off] = True
    first = body.copy()
    first[1:] &= ~body[:-1] | edge[1:-1]
    last = body.copy()
    last[:-1] &= ~body[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.diff(np.searchsorted(starts, off))


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word, A-Z lower-cased: differences of a polynomial prefix
    sum, so the cost is a few array passes over the bytes."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    _powers(len(buf) + 1)
    sums = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_BYTE[LOWER[buf]] * _pow[: len(buf)], out=sums[1:])
    return mix64((sums[ends] - sums[starts]) * _inv[starts])


def owner(counts: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(counts)), counts)
