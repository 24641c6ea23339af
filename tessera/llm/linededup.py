"""Substring dedup by hashing the parts of lines.

A text is cut into pieces at line ends (``\\n``) and sentence ends (``.``, ``!``, ``?``
before white space), whatever comes before; a sentence of over ``LONG`` words also at the
word pairs with the least hash among ``WINDOW`` pairs in a row, so that copies amid other
words are cut alike. Units are the pieces of at least ``MIN_WORDS`` words; for each shorter
piece the shortest runs of consecutive pieces, across lines, that begin and that end with
it and reach ``MIN_WORDS`` words; and whole lines of ``LINE_WORDS`` words or more. Units
thus overlap, and any repeated run of pieces that holds ``MIN_WORDS`` words is covered by
units. Units are normalised by lower-casing A-Z and joining their words
``[^\\x20\\x09-\\x0D]+`` with single spaces. Over the whole corpus the occurrence of a unit
in the smallest doc_id (then the smallest unit index, which is by start and end) is kept
and all others are removed: of every word removed, an earlier copy stays. Offsets are code
points of the original text.

A caller that names ``min_words`` gets units that do not overlap: each line cut after
sentence ends into units of at least so many words, greedily from its start; what is left
at a line's end joins its last unit, and a line with fewer words has none.

Cases: null and empty texts have no units; a unit repeated within one document is removed
after its first occurrence; a very frequent unit is one digest whose minimum is found by
partial aggregation, and its rows are dealt to several tasks where they meet the minimum;
rows with one doc_id are one document, so a repeated row is no copy of itself (where their
texts differ, units of equal index are taken for one); a null doc_id comes after all others, and
``deduplicate`` leaves its texts whole, as the rows cannot be told apart.
"""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import scratch, small_batches

MIN_WORDS = 8
LINE_WORDS = 5
LONG, WINDOW = 32, 8
DIGEST = 12
_SPACE = " \t\x0b\x0c\r"
_END = re.compile(r"[.!?](?=[ \t\x0b\x0c\r])")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def long_pieces(start: int, text: str, words: list[bytes]) -> list[tuple[int, int, list[bytes]]]:
    """(start, end, words) of the pieces of a sentence of over LONG words."""
    pairs = np.array([zlib.crc32(b" ".join(words[k : k + 2])) for k in range(len(words) - 1)])
    least = np.lib.stride_tricks.sliding_window_view(pairs, WINDOW).argmin(axis=1)
    cuts = [0, *(np.unique(least + np.arange(len(least))) + 1).tolist(), len(words)]
    spans = [m.span() for m in _WORD.finditer(text)]
    return [(start + spans[a][0], start + spans[b - 1][1], words[a:b]) for a, b in zip(cuts, cuts[1:])]


def rolling_units(text: str) -> list[tuple[int, int, int, bytes]]:
    """(index, start, end, digest) of the units of a text."""
    pieces: list[tuple[int, int, list[bytes]]] = []
    found: dict[tuple[int, int], list[bytes]] = {}
    base = 0
    for line in text.split("\n"):
        at, before = 0, len(pieces)
        for end in [*(m.end() for m in _END.finditer(line)), len(line)]:
            part = line[at:end]
            words = part.encode("utf-8", "surrogatepass").translate(_LOWER).split()
            if len(words) > LONG:
                pieces += long_pieces(base + at, part, words)
            elif words:
                pieces.append((base + end - len(part.lstrip(_SPACE)), base + at + len(part.rstrip(_SPACE)), words))
            at = end
        if len(pieces) > before:
            whole = [w for p in pieces[before : before + MIN_WORDS] for w in p[2]]
            if LINE_WORDS <= len(whole) < MIN_WORDS:
                found[pieces[before][0], pieces[-1][1]] = whole
        base += len(line) + 1
    for i, (s, e, words) in enumerate(pieces):
        if len(words) >= MIN_WORDS:
            found[s, e] = words
            continue
        j, run = i, words
        while len(run) < MIN_WORDS and j + 1 < len(pieces):
            j += 1
            run = run + pieces[j][2]
        if len(run) >= MIN_WORDS:
            found[s, pieces[j][1]] = run
        j, run = i, words
        while len(run) < MIN_WORDS and j > 0:
            j -= 1
            run = pieces[j][2] + run
        if len(run) >= MIN_WORDS:
            found[pieces[j][0], e] = run
    return [(k, s, e, hashlib.blake2b(b" ".join(w), digest_size=DIGEST).digest()) for k, ((s, e), w) in enumerate(sorted(found.items(), key=lambda x: x[0]))]


def units_of(text: str, min_words: int = MIN_WORDS) -> list[tuple[int, int, int, bytes]]:
    """The same of the units that do not overlap, of at least ``min_words`` words."""
    out: list[tuple[int, int, int, bytes]] = []
    base = 0
    for line in text.split("\n"):
        if len(line) >= 2 * min_words - 1:
            found: list[tuple[int, int, list[bytes]]] = []
            start = at = 0
            words: list[bytes] = []
            for end in [*(m.end() for m in _END.finditer(line)), len(line)]:
                words += line[at:end].encode("utf-8", "surrogatepass").translate(_LOWER).split()
                at = end
                if len(words) >= min_words:
                    found.append((start, at, words))
                    start, words = at, []
            if words and found:
                s, _, w = found[-1]
                found[-1] = (s, len(line), w + words)
            for s, e, w in found:
                s += len(line[s:e]) - len(line[s:e].lstrip(_SPACE))
                e -= len(line[s:e]) - len(line[s:e].rstrip(_SPACE))
                out.append((len(out), base + s, base + e, hashlib.blake2b(b" ".join(w), digest_size=DIGEST).digest()))
        base += len(line) + 1
    return out


def units(docs: DataFrame, min_words: int | None = None) -> DataFrame:
    """doc_id, unit, start, length and digest (key_a, key_b) of every unit of ``docs``;
    ``times`` its document holds the unit, on the first of them, and 0 on the others."""
    small_batches(docs.sparkSession)

    def cut(batches):
        for b in batches:
            ids: list = []
            rows: list[tuple[int, int, int]] = []
            digests: list[bytes] = []
            times: list[int] = []
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                first: dict[bytes, int] = {}
                for unit, start, end, digest in rolling_units(text or "") if min_words is None else units_of(text or "", min_words):
                    at = first.setdefault(digest, len(digests))
                    times.append(1 if at == len(digests) else 0)
                    times[at] += at != len(digests)
                    ids.append(doc_id)
                    rows.append((unit, start, end))
                    digests.append(digest)
            if not rows:
                continue
            x, key = np.array(rows, np.int64), np.frombuffer(b"".join(digests), np.dtype([("a", "<i8"), ("b", "<i4")]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(x[:, 0].astype(np.int32)), pa.array(x[:, 1]), pa.array((x[:, 2] - x[:, 1]).astype(np.int32)), pa.array(key["a"].copy()), pa.array(key["b"].copy()), pa.array(np.array(times, np.int32))],
                ["doc_id", "unit", "start", "length", "key_a", "key_b", "times"],
            )

    return docs.select("doc_id", "text").mapInArrow(cut, "doc_id long, unit int, start long, length int, key_a long, key_b int, times int")


def duplicates(docs: DataFrame, min_words: int | None = None) -> DataFrame:
    """The occurrences to remove: doc_id, unit, start, end, kept_doc_id, kept_unit."""
    every = scratch(units(docs, min_words), "units")
    last = F.lit(2**63 - 1)
    doc = F.coalesce("doc_id", last)
    first = every.where("times > 0").groupBy("key_a", "key_b").agg(F.min(doc).alias("kept"), F.min_by("unit", doc).alias("kept_unit"), F.sum("times").alias("n")).where("n > 1")
    # stored, so that a frequent digest is split in the join by adaptive execution
    first = scratch(first.select(F.col("key_a").alias("a"), F.col("key_b").alias("b"), "kept", "kept_unit"), "first")
    hit = every.drop("times").join(first, (F.col("key_a") == F.col("a")) & (F.col("key_b") == F.col("b")), "inner")
    again = hit.where((doc != F.col("kept")) | (F.col("unit") != F.col("kept_unit")))
    return again.select("doc_id", "unit", "start", (F.col("start") + F.col("length")).alias("end"), F.when(F.col("kept") < last, F.col("kept")).alias("kept_doc_id"), F.col("kept_unit"))


def deduplicate(docs: DataFrame, min_words: int | None = None) -> DataFrame:
    """``docs`` with ``removed``, the (unit, start, end) that went, and ``clean_text``,
    what lies outside of them; columns of these names are replaced."""
    clash = {"removed", "clean_text"} & {c.lower() for c in docs.columns}
    docs = docs.drop(*clash)
    gone = duplicates(docs, min_words).groupBy(F.col("doc_id").alias("_gone")).agg(F.sort_array(F.collect_set(F.struct("unit", "start", "end"))).alias("removed"))
    joined = docs.join(gone, docs["doc_id"] == gone["_gone"], "left").drop(gone["_gone"])
    kept = F.aggregate(
        "removed",
        F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at")),
        lambda acc, r: F.struct(F.concat(acc["out"], F.substring("text", (acc["at"] + 1).cast("int"), F.greatest(r["start"] - acc["at"], F.lit(0)).cast("int"))).alias("out"), F.greatest(acc["at"], r["end"]).alias("at")),
        lambda acc: F.concat(acc["out"], F.substring("text", (acc["at"] + 1).cast("int"), F.length("text"))),
    )
    return joined.withColumn("clean_text", F.when(F.col("removed").isNull(), F.col("text")).otherwise(kept))


def op3_line_dedup(spark, sf_dir: str) -> DataFrame:
    return duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))

