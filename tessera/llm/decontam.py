"""Benchmark decontamination by latent semantic retrieval.

Passages are cells of ``CELL`` tokens, terms are tokens hashed to ``TERMS`` numbers, of the
whole vocabulary. The latent space is a randomised SVD of the corpus' TF-IDF passages A,
together with a sketch of the benchmark's own passages, as rare words of a benchmark are in
no leading singular vector of a corpus:

1. A pass over the corpus counts the cells that hold each term and sums ``A'A W`` for a
   random matrix W of ``SKETCH`` columns (a range finder with one power iteration). Idf only
   scales the terms, so it is applied afterwards.
2. ``ITEM_SKETCH`` random combinations of the benchmark's passages join that range, and an
   orthonormal basis Q of both is taken. A second pass sums the Gram matrix of ``A Q``; its
   eigenvectors and values are A's singular vectors and squared singular values within Q.
   Directions are scaled down by the root of their spread over the corpus, so that what
   all texts share weighs little.
3. A third pass projects every window of two cells and compares it with the probes of each
   item: its passages of at most two cells, and the item as a whole where one window can
   hold ``SHARE`` of it. Windows within the cosine ``COSINE`` of a probe are candidates, and
   those within ``RELATED`` by the corpus' leading singular vectors alone, which bring
   related words together, as in paraphrases. The exact checks follow: a window must hold ``SHARE`` of the probe's tokens,
   and in the text around it the longest common subsequence must cover ``COVER`` of the
   whole item's tokens, or ``COVER_ANSWERED`` of them if the answer is there too: most of
   the ``ANSWER`` tokens that close the item.

The space has ``SKETCH`` dimensions of the corpus and at most ``ITEM_SKETCH`` of the
benchmark, half as many as it has passages, so what it retrieves differs from plain TF-IDF.
Pass 1 is taken once; passes 2 and 3 once for each ``ITEMS`` items.

Cases: null or empty texts and items have no tokens and match nothing; a null item_id is
left out; items under ``LEAST`` tokens match where a document holds all their tokens in a
row, so an item of one word is found in every document with that word; ties go to the
smaller item_id; repeated rows are reported each; a null doc_id is reported as null; an
empty benchmark gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import give_back, lean, mix64, owner, small_batches, text_slices, word_hashes, words

CELL = 16
SKETCH, ITEM_SKETCH = 32, 96
LEADING = slice(SKETCH // 2, SKETCH)  # the best half of what the sketch spans
TERM_BITS = 15
TERMS = 1 << TERM_BITS
ITEMS = 4096
COSINE, RELATED, SHARE = 0.4, 0.95, 0.3
DAMP, RIDGE = 0.25, 0.3
BITMAP, REGIONS, NEAR = 2048, 1 << 18, 1024
SLICE = 1 << 19
COVER, COVER_ANSWERED = 0.75, 0.5
ANSWER, ANSWERED = 5, 0.6
LEAST = 8


def terms(hashes: np.ndarray) -> np.ndarray:
    """Term numbers of tokens."""
    return (hashes >> np.uint64(64 - TERM_BITS)).astype(np.int64)


def text_hashes(texts: list[str]) -> list[np.ndarray]:
    out = []
    for t in texts:
        buf = np.frombuffer((t or "").encode("utf-8", "surrogatepass"), np.uint8)
        s, e, _ = words(buf, np.array([0, len(buf)]))
        out.append(word_hashes(buf, s, e))
    return out


def cells(counts: np.ndarray, n_tokens: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cell of each token, and the text and first token of each cell."""
    per = -(-counts // CELL)
    doc = owner(per)
    rank = np.arange(len(doc)) - np.repeat(np.cumsum(per) - per, per)
    start = (np.cumsum(counts) - counts)[doc] + rank * CELL
    return np.repeat(np.arange(len(start)), np.diff(np.append(start, n_tokens))), doc, start


def cell_sums(matrix: np.ndarray, t: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Sum of ``matrix``'s rows ``t`` over each cell (at most CELL tokens from ``start`` on):
    the k-th tokens of all cells at once."""
    size = np.diff(np.append(start, len(t)))
    order = np.argsort(-size, kind="stable")
    size, first = size[order], start[order]
    sums = np.zeros((len(start), matrix.shape[1]), np.float32)
    for k in range(int(size[0]) if len(start) else 0):
        live = int(np.searchsorted(-size, -k))
        sums[:live] += matrix[t[first[:live] + k]]
    out = np.empty_like(sums)
    out[order] = sums
    return out


def cell_counts(t: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Cells that hold each term."""
    at = start[:, None] + np.arange(CELL)
    inside = at < np.append(start[1:], len(t))[:, None]
    rows = np.where(inside, np.append(t, 0).astype(np.uint16)[np.minimum(at, len(t))], np.uint16(TERMS))
    rows.sort(axis=1)
    new = np.ones(rows.shape, bool)
    new[:, 1:] = rows[:, 1:] != rows[:, :-1]
    return np.bincount(rows[new], minlength=TERMS + 1)[:TERMS]


# --------------------------------------------------------------------- passes over the corpus
def _summed(docs: DataFrame, add, shapes: list[tuple[int, ...]], parts: int = 16) -> list[np.ndarray]:
    """Sums over the corpus of what ``add(totals, h, counts)`` adds to float64 arrays of
    ``shapes``, from packed partial sums of the tasks, merged in two steps."""
    small_batches(docs.sparkSession)
    sizes = [math.prod(s) for s in shapes]

    @lean
    def local(batches):
        totals = [np.zeros(s) for s in shapes]
        for b in batches:
            for _, _, buf, off in text_slices(b, 0, SLICE):
                s, e, counts = words(buf, off)
                if len(s):
                    add(totals, word_hashes(buf, s, e), counts)
        whole = np.concatenate([x.reshape(-1) for x in totals]).astype(np.float32)  # a task's counts fit
        yield pa.RecordBatch.from_arrays([pa.array(range(parts), pa.int32()), pa.array([x.tobytes() for x in np.array_split(whole, parts)], pa.binary()), pa.array([False] * parts)], ["part", "sums", "wide"])

    def total(table: pa.Table) -> pa.Table:
        rows = zip(table.column("sums").to_pylist(), table.column("wide").to_pylist(), strict=True)
        x = sum(np.frombuffer(s, np.float64 if wide else np.float32).astype(np.float64) for s, wide in rows)
        return pa.table({"part": table.column("part").slice(0, 1), "sums": pa.array([x.tobytes()], pa.binary()), "wide": [True]})

    schema = "part int, sums binary, wide boolean"
    some = docs.select("text").mapInArrow(local, schema).withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(32)))
    got = sorted(some.groupBy("part", "salt").applyInArrow(total, schema).groupBy("part").applyInArrow(total, schema).collect())
    if not got:
        return [np.zeros(s) for s in shapes]
    whole = np.concatenate([np.frombuffer(r[1], np.float64) for r in got])
    return [x.reshape(s) for x, s in zip(np.split(whole, np.cumsum(sizes)[:-1]), shapes, strict=True)]


def range_sketch(docs: DataFrame, seed: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Idf of each term and the sketch ``A'A W`` (TERMS, SKETCH) of the TF-IDF cells A."""

    def add(totals, h, counts):
        df, sketch, n = totals
        w = _gaussian(seed)
        t = terms(h)
        cell, doc, start = cells(counts, len(h))
        n += len(doc)
        p = np.ascontiguousarray(cell_sums(w, t, start).T)
        df += cell_counts(t, start)
        for j in range(SKETCH):
            sketch[j] += np.bincount(t, p[j][cell], TERMS)

    df, sketch, n = _summed(docs, add, [(TERMS,), (SKETCH, TERMS), (1,)])
    idf = np.log((n[0] + 1) / (df + 1))
    return idf, idf[:, None] * sketch.T


_drawn: dict[int, np.ndarray] = {}


def _gaussian(seed: int) -> np.ndarray:
    if seed not in _drawn:
        _drawn[seed] = np.random.default_rng(seed).normal(size=(TERMS, SKETCH)).astype(np.float32)
    return _drawn[seed]


def gram(docs: DataFrame, project: np.ndarray) -> tuple[np.ndarray, float]:
    """Gram matrix of the projected cells, and their number."""
    d = project.shape[1]

    def add(totals, h, counts):
        _, _, start = cells(counts, len(h))
        p = cell_sums(project, terms(h), start)
        totals[0] += p.T @ p
        totals[1] += len(start)

    g, n = _summed(docs, add, [(d, d), (1,)])
    return g, float(n[0])


# --------------------------------------------------------------------- the latent space
def probes(item: np.ndarray) -> list[np.ndarray]:
    """What windows are compared with: the item, where one window can hold SHARE of it,
    and its passages of at most two cells, cut evenly."""
    passages = np.array_split(item, -(-len(item) // (2 * CELL)))
    if len(passages) == 1 or SHARE * len(item) > 2 * CELL:
        return passages
    return [item, *passages]


def weighted(group: list[np.ndarray], idf: np.ndarray) -> np.ndarray:
    """TF-IDF rows (probes, terms in use) and those terms."""
    numbers = [terms(p) for p in group]
    used = np.unique(np.concatenate(numbers))
    own = np.zeros((len(group), len(used)), np.float32)
    for i, t in enumerate(numbers):
        np.add.at(own[i], np.searchsorted(used, t), 1.0)
    return own * idf[used].astype(np.float32), used


def basis(group: list[np.ndarray], idf: np.ndarray, sketch: np.ndarray, seed: int = 5) -> np.ndarray:
    """Orthonormal columns (TERMS, rank): the corpus' range and random combinations of the
    probes, fewer than there are probes."""
    own, used = weighted(group, idf)
    mine = np.zeros((TERMS, min(ITEM_SKETCH, max(1, len(group) // 2))))
    mine[used] = own.T @ np.random.default_rng(seed).normal(size=(len(group), mine.shape[1]))
    mine /= max(1e-12, np.linalg.norm(mine))
    both = np.concatenate([sketch / max(1e-12, np.linalg.norm(sketch)), mine], axis=1)
    del mine
    return np.linalg.qr(both)[0]


class Space:
    """Projection of tokens to the scaled latent space, and the probes in it. The first
    ``SKETCH`` dimensions are the corpus' leading singular vectors."""

    def __init__(self, group: list[tuple[int, np.ndarray]], idf: np.ndarray, q: np.ndarray, g: np.ndarray, n: float):
        self.item = np.array([i for i, _ in group])
        self.length = np.array([len(p) for _, p in group])
        own, used = weighted([p for _, p in group], idf)
        v, squares = np.zeros_like(g), np.zeros(len(g))
        for part in (slice(0, SKETCH), slice(SKETCH, len(g))):  # squares of singular values; q @ v are the vectors
            squares[part], v[part, part] = np.linalg.eigh(g[part, part])
        own = own @ (q[used] @ v)
        spread = np.maximum(squares, 0) / max(1.0, n) + RIDGE * max(1e-12, float((own**2).mean()))
        scale = spread**-DAMP
        self.project = (idf[:, None] * (q @ v) * scale).astype(np.float32)
        own = (own * scale).astype(np.float32)
        self.related, self.probes = (np.ascontiguousarray(_unit(x).T) for x in (own[:, LEADING], own))
        self.held = np.zeros((len(group), BITMAP), bool)  # an upper bound of which tokens a probe holds
        for k, (_, p) in enumerate(group):
            self.held[k, bit(p)] = True

    def near(self, h: np.ndarray, counts: np.ndarray):
        """(first token, tokens, text, probe numbers, cosines) of the windows that have
        probes within COSINE in the space, or RELATED by the leading singular vectors."""
        _, doc, start = cells(counts, len(h))
        v = cell_sums(self.project, terms(h), start)
        end = np.append(start[1:], len(h))
        pair = np.flatnonzero(doc[1:] == doc[:-1])
        v[pair] += v[pair + 1]  # a cell and the next of its text
        last = end.copy()
        last[pair] = end[pair + 1]
        topic, v = _unit(v[:, LEADING]), _unit(v)
        for a in range(0, len(v), NEAR):
            cos = v[a : a + NEAR] @ self.probes
            close = cos >= COSINE
            close |= topic[a : a + NEAR] @ self.related >= RELATED
            i, k = np.divmod(np.flatnonzero(close), close.shape[1])
            if len(i):
                yield start[a + i], last[a + i] - start[a + i], doc[a + i], k, cos[i, k]

    def share(self, h: np.ndarray, x: np.ndarray, n: np.ndarray, k: np.ndarray) -> np.ndarray:
        """Whether windows can hold SHARE of their probes' tokens."""
        width = 2 * CELL
        b = np.lib.stride_tricks.sliding_window_view(np.append(bit(h), np.zeros(width, np.int32)), width)
        held, out = self.held.reshape(-1), np.zeros(len(x), bool)
        for a in range(0, len(x), 1 << 14):
            some = slice(a, a + (1 << 14))
            at = b[x[some]] + (k[some] * BITMAP).astype(np.int64)[:, None]
            hit = held.take(at) & (np.arange(width) < n[some, None])
            out[some] = hit.sum(axis=1) >= SHARE * self.length[k[some]]
        return out


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def bit(h: np.ndarray) -> np.ndarray:
    return (h & np.uint64(BITMAP - 1)).astype(np.int32)


# --------------------------------------------------------------------- exact checks
def in_a_row(h: np.ndarray, length: int) -> np.ndarray:
    """Hash of the ``length`` tokens from each token on."""
    n = max(0, len(h) - length + 1)
    key = h[:n].copy()
    for k in range(1, length):
        key = mix64(key) + h[k : n + k]
    return key


class Short:
    """Exact search for items of fewer than LEAST tokens."""

    def __init__(self, items: list[np.ndarray]):
        self.keys: dict[int, dict[int, list[int]]] = {}
        for j, h in enumerate(items):
            if len(h) < LEAST:
                self.keys.setdefault(len(h), {}).setdefault(int(in_a_row(h, len(h))[0]), []).append(j)

    def find(self, h: np.ndarray, counts: np.ndarray):
        """(text, item, first token in the text, token after the last) of the first
        occurrence of each item in each text."""
        doc, end = owner(counts), np.cumsum(counts)
        for length, items in self.keys.items():
            known = np.array(sorted(items), np.uint64)
            key = in_a_row(h, length)
            at = np.flatnonzero(np.isin(key, known))
            at = at[at + length <= end[doc[at]]]
            _, first = np.unique(doc[at] * len(known) + np.searchsorted(known, key[at]), return_index=True)
            for i in at[first].tolist():
                d = int(doc[i])
                x = i - int(end[d] - counts[d])
                for j in items[int(key[i])]:
                    yield d, j, x, x + length


def masks_of(item: np.ndarray) -> dict[int, int]:
    """Positions of each token of an item as bits."""
    masks: dict[int, int] = {}
    for i, x in enumerate(item.tolist()):
        masks[x] = masks.get(x, 0) | 1 << i
    return masks


def lcs(masks: dict[int, int], length: int, region: list[int]) -> int:
    """Length of the longest common subsequence, bit-parallel."""
    full = (1 << length) - 1
    v = full
    for x in region:
        m = masks.get(x)
        if m is not None:
            u = v & m
            v = ((v + u) | (v - u)) & full
    return length - v.bit_count()


class Item:
    """What the exact checks need of an item."""

    def __init__(self, h: np.ndarray):
        self.length, self.masks, self.answer = len(h), masks_of(h), set(h[-ANSWER:].tolist())
        self.bits = bit(h)

    def covered(self, region: np.ndarray) -> float | None:
        """Share of the item that the region holds in order, if that makes it a leak."""
        tokens = region.tolist()
        cover = lcs(self.masks, self.length, tokens) / self.length
        if cover >= COVER or cover >= COVER_ANSWERED and len(self.answer.intersection(tokens)) >= ANSWERED * len(self.answer):
            return cover
        return None


class Bits:
    """The tokens of all items as bits of BITMAP, one item after the other."""

    def __init__(self, items: list[Item]):
        self.length = np.array([i.length for i in items], np.int64)
        self.first = np.cumsum(self.length) - self.length
        self.bits = np.concatenate([i.bits for i in items]) if items else np.zeros(0, np.int32)

    def holds(self, bits: np.ndarray, j: np.ndarray, a: np.ndarray, z: np.ndarray) -> np.ndarray:
        """Whether the regions ``a`` to ``z`` of token ``bits`` can hold COVER_ANSWERED of the
        tokens of their items ``j``; as many regions at once as have about REGIONS tokens."""
        out = np.zeros(len(j), bool)
        size = np.cumsum(z - a + self.length[j])
        at = 0
        while at < len(j):
            end = max(at + 1, int(np.searchsorted(size, size[at] + REGIONS)))
            end = min(end, at + REGIONS // 128)
            some = slice(at, end)
            seen = np.zeros((end - at) * BITMAP, bool)
            own, token = ragged(a[some], z[some] - a[some])
            seen[own * BITMAP + bits[token]] = True
            own, token = ragged(self.first[j[some]], self.length[j[some]])
            held = np.bincount(own, seen[own * BITMAP + self.bits[token]], end - at)
            out[some] = held >= COVER_ANSWERED * self.length[j[some]]
            at = end
        return out


def ragged(first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the range and position, for all positions of ranges."""
    own = owner(size)
    return own, np.arange(len(own)) + (first - np.cumsum(size) + size)[own]


# --------------------------------------------------------------------- the operator
def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text), ``benchmark`` (item_id, text): doc_id, item_id, cosine,
    coverage, word_start, word_end of each item that a document leaks."""
    schema = "doc_id long, item_id long, cosine double, coverage double, word_start long, word_end long"
    out = None
    chunks = math.ceil(benchmark.count() / ITEMS)
    corpus = None
    for c in range(chunks):
        rows = benchmark.where(F.pmod(F.xxhash64("item_id"), F.lit(chunks)) == c).where("item_id IS NOT NULL").select("item_id", "text").orderBy("item_id").collect()
        pairs = [(r["item_id"], h) for r, h in zip(rows, text_hashes([r["text"] for r in rows]), strict=True) if len(h)]
        if not pairs:
            continue
        ids, items = [i for i, _ in pairs], [h for _, h in pairs]
        group = [(j, p) for j, h in enumerate(items) if len(h) >= LEAST for p in probes(h)]
        space = None
        if group:
            corpus = corpus or range_sketch(docs)
            space = latent_space(docs, group, *corpus)
        found = _search(docs, ids, items, space, schema)
        out = found if out is None else out.union(found)
        give_back()
    if out is None:  # not a list of no rows, which would start Python workers of another kind
        return docs.limit(0).select(*[F.lit(None).cast(kind).alias(name) for name, kind in map(str.split, schema.split(", "))])
    return out


def latent_space(docs: DataFrame, group: list[tuple[int, np.ndarray]], idf: np.ndarray, sketch: np.ndarray) -> Space:
    q = basis([p for _, p in group], idf, sketch)
    give_back()  # of the factorisation
    g, n = gram(docs, (idf[:, None] * q).astype(np.float32))
    return Space(group, idf, q, g, n)


def _search(docs: DataFrame, ids: list[int], items: list[np.ndarray], space: Space | None, schema: str) -> DataFrame:
    small_batches(docs.sparkSession)
    short = Short(items)
    exact = [Item(h) for h in items]
    flat = Bits(exact)

    def candidates(h, counts, best):
        first = np.cumsum(counts) - counts
        bits = bit(h)
        tried: set[tuple[int, int, int, int]] = set()
        for x, n, doc, k, cos in space.near(h, counts):
            ok = np.flatnonzero(space.share(h, x, n, k))
            d, j = doc[ok], space.item[k[ok]]
            own = flat.length[j]
            a = np.maximum(first[d], x[ok] - own)
            z = np.minimum(first[d] + counts[d], x[ok] + 2 * CELL + own)
            fits = flat.holds(bits, j, a, z)
            for d, j, a, z, c in zip(d[fits].tolist(), j[fits].tolist(), a[fits].tolist(), z[fits].tolist(), cos[ok[fits]].tolist(), strict=True):
                known = best.get((d, j))
                if known and known[1] >= 1.0 or (d, j, a, z) in tried:
                    continue
                tried.add((d, j, a, z))
                cover = exact[j].covered(h[a:z])
                if cover is not None and (known is None or cover > known[1]):
                    best[d, j] = (c, cover, a - int(first[d]), z - int(first[d]))

    @lean
    def run(batches):
        for b in batches:
            for lo, hi, buf, off in text_slices(b, 1, SLICE):
                s, e, counts = words(buf, off)
                best: dict[tuple[int, int], tuple[float, float, int, int]] = {}
                if len(s):
                    h = word_hashes(buf, s, e)
                    for d, j, x, y in short.find(h, counts):
                        best[d, j] = (1.0, 1.0, x, y)
                    if space is not None:
                        candidates(h, counts, best)
                found = sorted(best.items())
                doc_ids = b.column(0).slice(lo, hi - lo).to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([doc_ids[d] for (d, _), _ in found], pa.int64()), pa.array([ids[j] for (_, j), _ in found], pa.int64()), *[pa.array([x[k] for _, x in found], kind) for k, kind in enumerate((pa.float64(), pa.float64(), pa.int64(), pa.int64()))]],
                    ["doc_id", "item_id", "cosine", "coverage", "word_start", "word_end"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def op4_decontaminate(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text"))
