"""Language-model scoring by a hashed maximum-entropy model.

The probability of a token is class-factored: P(class | history) * P(token | class,
history). The class softmax is a maximum-entropy model over hashed features of the history:
the token before (bigram), the one before that (skip), and the pair (trigram). Frequent
tokens are binned into classes of equal mass, all others share ``TAIL`` classes by hash. The
softmax within a class of frequent tokens has as features the token with the class of the
token before and with that of the one before that, upon its smoothed count; its normaliser
is exact. A rare token has its smoothed count within its class.

Fitting: one pass counts all tokens of the training texts, packed per task and merged in
hash buckets; then rounds of distributed gradient updates, in which each task runs
Adagrad mini-batches over its share of the texts and the tasks' weights are averaged by
tokens. The rounds also sum how often the features of the softmax within classes occur;
its full gradient needs no more of the texts, and its steps follow at once. Scoring: one pass runs the class softmax in numpy batches; the counts of tail
tokens stay in their buckets: each block of documents sends its distinct tail tokens
there, packed, and gets sums per document back, so no table that grows with the corpus is
broadcast. The ``TOP`` most frequent tokens are the only vocabulary on every task.

Cases: a null text is empty and consists of its end token; an empty training set leaves
all counts 0; repeated rows are scored each for itself (they are told apart by block and
position); very long texts are read whole.
"""

from __future__ import annotations

import math
import os

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_scratch, mix64, scratch, small_batches, tasks, text_slices, word_hashes, words

TOP = 4096
CLASSES, TAIL = 32, 8
ROWS = (TOP + 1024, TOP + 1024, 8192)  # of the bigram, skip and trigram tables
BLOCK_TOKENS, BLOCK_DOCS = 3_000_000, 60_000
STEP = 16_384
CONTEXTS = CLASSES + 1  # classes of a token before, and the start of a text
INNER_STEPS, PRIOR = 40, 0.5
RATE = 0.15
ALPHA = 0.1
END = np.uint64(0x0123456789ABCDEF)
_PAIR = np.uint64(0xC2B2AE3D27D4EB4F)


# --------------------------------------------------------------------- tokens
def tokens(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's words followed by its end token, and tokens per text."""
    starts, ends, counts = words(buf, off)
    h = word_hashes(buf, starts, ends)
    return np.insert(h, np.cumsum(counts), END), counts + 1


def bucket_of(h: np.ndarray, buckets: int) -> np.ndarray:
    return ((h >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def runs(sorted_: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal values, and the length."""
    return np.concatenate([[0], np.flatnonzero(sorted_[1:] != sorted_[:-1]) + 1, [len(sorted_)]]).astype(np.int64) if len(sorted_) else np.zeros(1, np.int64)


def merged(h: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(h, kind="stable")
    h, c = h[order], c[order]
    at = runs(h)
    return (h[at[:-1]], np.add.reduceat(c, at[:-1])) if len(h) else (h, c)


# --------------------------------------------------------------------- counting
def count_tokens(docs: DataFrame, buckets: int) -> DataFrame:
    """(bucket, hashes, counts): sorted token hashes and their counts, packed."""

    def partial(batches):
        h, c, loose, size = np.zeros(0, np.uint64), np.zeros(0, np.int64), [], 0

        def fold():
            u, n = np.unique(np.concatenate(loose), return_counts=True)
            return merged(np.concatenate([h, u]), np.concatenate([c, n]))

        def out():
            where = bucket_of(h, buckets)
            at = runs(where)
            return pa.RecordBatch.from_arrays([pa.array(where[at[:-1]].astype(np.int32)), pa.array([h[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)], pa.binary()), pa.array([c[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)], pa.binary())], ["bucket", "hashes", "counts"])

        for b in batches:
            for _, _, buf, off in text_slices(b):
                t, _ = tokens(buf, off)
                loose.append(t)
                size += len(t)
                if size > 1_000_000:
                    h, c = fold()
                    loose, size = [], 0
                    if len(h) > 2_000_000:
                        yield out()
                        h, c = h[:0], c[:0]
        if loose:
            h, c = fold()
        if len(h):
            yield out()

    def merge(table: pa.Table) -> pa.Table:
        h, c = (np.frombuffer(b"".join(table.column(i).to_pylist()), t) for i, t in ((1, np.uint64), (2, np.int64)))
        h, c = merged(h, c)
        return pa.table({"bucket": table.column(0).slice(0, 1), "hashes": pa.array([h.tobytes()], pa.binary()), "counts": pa.array([c.tobytes()], pa.binary())})

    schema = "bucket int, hashes binary, counts binary"
    return scratch(docs.select("text").mapInArrow(partial, schema).groupBy("bucket").applyInArrow(merge, schema), "counts")


class Vocabulary:
    """What every task knows: the most frequent tokens with counts and classes, sums of
    the tail classes, and totals."""

    def __init__(self, top_h: np.ndarray, top_c: np.ndarray, total: int, distinct: int, tail_n: np.ndarray, tail_v: np.ndarray):
        self.total, self.distinct = total, distinct
        mass = np.cumsum(top_c) - top_c / 2 if len(top_c) else top_c
        cls = np.minimum((mass * (CLASSES - TAIL) / max(1, top_c.sum())).astype(np.int64), CLASSES - TAIL - 1) if len(top_c) else np.zeros(0, np.int64)
        n = np.concatenate([np.bincount(cls, top_c, CLASSES - TAIL), tail_n])
        v = np.concatenate([np.bincount(cls, minlength=CLASSES - TAIL), tail_v + 1.0])  # a tail class also holds what was never seen
        self.log_class = np.log10(np.maximum(n + ALPHA * v, ALPHA))
        order = np.argsort(top_h)
        self.h, self.c, self.cls = top_h[order], top_c[order], cls[order]
        self.log_count = np.log10(self.c + ALPHA)
        self.inner = Inner(self)

    def look_up(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index among the frequent tokens (-1: none) and class of each token."""
        if not len(self.h):
            return np.full(len(h), -1), (CLASSES - TAIL + (h % np.uint64(TAIL)).astype(np.int64))
        at = np.minimum(np.searchsorted(self.h, h), len(self.h) - 1)
        hit = self.h[at] == h
        return np.where(hit, at, -1), np.where(hit, self.cls[at], CLASSES - TAIL + (h % np.uint64(TAIL)).astype(np.int64))


class Inner:
    """The softmax within the classes of frequent tokens. ``theta`` (2, contexts, tokens)
    are the weights for the class before and the one before that."""

    def __init__(self, vocab: Vocabulary):
        self.base, self.cls = np.log(vocab.c + ALPHA), vocab.cls
        self.order = np.argsort(vocab.cls, kind="stable")  # tokens by class
        self.used, self.at = np.unique(vocab.cls[self.order], return_index=True)
        self.theta = np.zeros((2, CONTEXTS, len(vocab.h)), np.float32)
        self.log_z = np.zeros((CONTEXTS, CONTEXTS, CLASSES), np.float32)
        if len(self.used):
            self.normalise()

    def shapes(self) -> list[tuple[int, ...]]:
        """Of the counts: token by class before, by the one before that, and classes by both."""
        return [(CONTEXTS, len(self.base)), (CONTEXTS, len(self.base)), (CONTEXTS, CONTEXTS, CLASSES)]

    def count(self, totals: list[np.ndarray], at: np.ndarray, cls: np.ndarray, one: np.ndarray, two: np.ndarray) -> None:
        hit = np.flatnonzero(at >= 0)
        at, cls, one, two = at[hit], cls[hit], one[hit], two[hit]
        for total, key in zip(totals, (one * len(self.base) + at, two * len(self.base) + at, (one * CONTEXTS + two) * CLASSES + cls), strict=True):
            total += np.bincount(key, minlength=total.size).reshape(total.shape)

    def _exponents(self, one: int) -> np.ndarray:
        """exp of the scores (contexts two before, tokens by class) for a class before."""
        return np.exp((self.base + self.theta[0, one])[self.order] + self.theta[1][:, self.order])

    def normalise(self) -> None:
        for one in range(CONTEXTS):
            self.log_z[one][:, self.used] = np.log(np.add.reduceat(self._exponents(one), self.at, axis=1))

    def fit(self, by_one: np.ndarray, by_two: np.ndarray, classes: np.ndarray) -> list[float]:
        """Gradient steps on the likelihood with a quadratic prior, each scaled by the
        expected counts; the likelihood before each."""
        seen: list[float] = []
        if not len(self.used):
            return seen
        sizes = np.diff(np.append(self.at, len(self.order)))
        for _ in range(INNER_STEPS):
            self.normalise()
            seen.append(float((by_one * (self.base + self.theta[0])).sum() + (by_two * self.theta[1]).sum() - (classes * self.log_z).sum()))
            expected = np.zeros_like(self.theta, np.float64)
            for one in range(CONTEXTS):
                e = self._exponents(one)
                e *= np.repeat(classes[one][:, self.used] * np.exp(-self.log_z[one][:, self.used]), sizes, axis=1)
                expected[0, one, self.order] = e.sum(axis=0)
                expected[1][:, self.order] += e
            for k, counts in enumerate((by_one, by_two)):
                self.theta[k] += (0.5 * (counts - expected[k] - PRIOR * self.theta[k]) / (expected[k] + counts + PRIOR)).astype(np.float32)
        self.normalise()
        return seen

    def log_probability(self, at: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """log10 P(token | class, history) of frequent tokens."""
        x = self.base[at] + self.theta[0][one, at] + self.theta[1][two, at] - self.log_z[one, two, self.cls[at]]
        return x / math.log(10)


def vocabulary(counts: DataFrame) -> Vocabulary:
    def sums(batches):
        for b in batches:
            c = [np.frombuffer(x, np.int64) for x in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([int(x.sum()) for x in c], pa.int64()), pa.array([len(x) for x in c], pa.int64())], ["n", "v"])

    total, distinct = counts.mapInArrow(sums, "n long, v long").agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("v"), F.lit(0))).first()
    least = max(1, total // (TOP * 64))  # so frequent are at most TOP * 64 tokens

    def often(batches):
        for b in batches:
            for h, c in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                h, c = np.frombuffer(h, np.uint64), np.frombuffer(c, np.int64)
                i = np.flatnonzero(c >= least)
                if len(i) > TOP:
                    i = i[np.argsort(-c[i], kind="stable")[:TOP]]  # no other of this bucket can be among the first TOP
                yield pa.RecordBatch.from_arrays([pa.array(h[i].view(np.int64)), pa.array(c[i])], ["h", "c"])

    top = counts.mapInArrow(often, "h long, c long").orderBy(F.desc("c"), "h").limit(TOP).collect()
    top_h, top_c = np.array([r[0] for r in top], np.int64).view(np.uint64), np.array([r[1] for r in top], np.float64)
    known = np.sort(top_h)

    def tails(batches):
        for b in batches:
            n, v = np.zeros(TAIL), np.zeros(TAIL)
            for h, c in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                h, c = np.frombuffer(h, np.uint64), np.frombuffer(c, np.int64)
                rest = ~np.isin(h, known)
                k = (h[rest] % np.uint64(TAIL)).astype(np.int64)
                n += np.bincount(k, c[rest], TAIL)
                v += np.bincount(k, minlength=TAIL)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(TAIL)), pa.array(n), pa.array(v)], ["k", "n", "v"])

    tail = {r[0]: (r[1], r[2]) for r in counts.mapInArrow(tails, "k long, n double, v double").groupBy("k").agg(F.sum("n"), F.sum("v")).collect()}
    n, v = (np.array([tail.get(k, (0.0, 0.0))[i] for k in range(TAIL)]) for i in (0, 1))
    return Vocabulary(top_h, top_c, int(total), int(distinct), n, v)


# --------------------------------------------------------------------- class softmax
def histories(h: np.ndarray, per: np.ndarray, vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """Frequent index and class of each token, its three feature rows, and the classes of
    the token before and of the one before that."""
    at, cls = vocab.look_up(h)
    row = np.where(at >= 0, at, TOP + (h % np.uint64(1023)).astype(np.int64))
    first = np.cumsum(per) - per
    second = first[per > 1] + 1

    def before(x: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
        """``x`` of the token before and of the one before that; ``start`` before a text."""
        one, two = np.full(len(h), start), np.full(len(h), start)
        one[1:], two[2:] = x[:-1], x[:-2]
        one[first] = start
        two[first] = start
        two[second] = start
        return one, two

    prev, skip = before(row, ROWS[0] - 1)
    pair = mix64(prev.astype(np.uint64) * _PAIR + skip.astype(np.uint64))
    return at, cls, [prev, skip, (pair % np.uint64(ROWS[2])).astype(np.int64)], before(cls, CLASSES)


def class_logits(weights: list[np.ndarray], rows: list[np.ndarray], a: int, b: int) -> np.ndarray:
    out = weights[3] + weights[0][rows[0][a:b]]
    out += weights[1][rows[1][a:b]]
    out += weights[2][rows[2][a:b]]
    out -= out.max(axis=1, keepdims=True)
    return out


def adagrad(weights: list[np.ndarray], memory: list[np.ndarray], rows: list[np.ndarray], cls: np.ndarray) -> float:
    """Mini-batch updates in place; the summed log-likelihood before them."""
    seen = 0.0
    for a in range(0, len(cls), STEP):
        y = cls[a : a + STEP]
        g = class_logits(weights, rows, a, a + STEP)
        np.exp(g, out=g)
        g /= g.sum(axis=1, keepdims=True)
        i = np.arange(len(y))
        seen += float(np.log(g[i, y] + 1e-12).sum())
        g[i, y] -= 1
        for k in range(3):
            own = rows[k][a : a + STEP].astype(np.int16)  # radix-sorted
            order = np.argsort(own, kind="stable")
            own = own[order]
            at = runs(own)[:-1]
            d = np.add.reduceat(g[order], at, axis=0)
            u = own[at].astype(np.int64)
            m = memory[k][u] + (d * d).sum(axis=1, keepdims=True) / CLASSES
            memory[k][u] = m
            weights[k][u] -= RATE * d / np.sqrt(m + 1e-6)
        d = g.sum(axis=0)
        memory[3] += d * d
        weights[3] -= RATE * d / np.sqrt(memory[3] + 1e-6)
    return seen


def start_weights() -> list[np.ndarray]:
    return [np.zeros((r, CLASSES), np.float32) for r in ROWS] + [np.zeros(CLASSES, np.float32)]


def gradient_round(docs: DataFrame, vocab: Vocabulary, weights: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Each task updates its own copy of the weights; the mean of their changes, weighted by
    tokens. Also the counts that the softmax within classes learns from, summed."""
    parts = 16
    shapes = vocab.inner.shapes()

    def local(batches):
        own, memory = [w.copy() for w in weights], [np.zeros((r, 1), np.float32) for r in ROWS] + [np.zeros(CLASSES, np.float32)]
        totals = [np.zeros(x, np.int64) for x in shapes]
        n = 0
        for b in batches:
            for _, _, buf, off in text_slices(b):
                h, per = tokens(buf, off)
                at, cls, rows, (one, two) = histories(h, per, vocab)
                adagrad(own, memory, rows, cls)
                vocab.inner.count(totals, at, cls, one, two)
                n += len(h)
        if n:
            change = np.concatenate([(w - v).reshape(-1) for w, v in zip(own, weights, strict=True)])
            counts = np.concatenate([x.reshape(-1) for x in totals])
            sent = [x.astype(np.float16).tobytes() for x in np.array_split(change, parts)] + [x.astype(np.float64).tobytes() for x in np.array_split(counts, parts)]
            yield pa.RecordBatch.from_arrays([pa.array(range(2 * parts), pa.int32()), pa.array([n] * 2 * parts, pa.int64()), pa.array(sent, pa.binary())], ["part", "n", "change"])

    def merge(table: pa.Table) -> pa.Table:
        """Mean of the changes, sum of the counts."""
        counts = table.column("part")[0].as_py() >= parts
        kind = np.float64 if counts else np.float16
        total, size = 0.0, 0
        for n, x in zip(table.column("n").to_pylist(), table.column("change").to_pylist(), strict=True):
            total, size = total + np.frombuffer(x, kind).astype(np.float64) * (1 if counts else n), size + n
        return pa.table({"part": table.column("part").slice(0, 1), "n": pa.array([size], pa.int64()), "change": pa.array([(total if counts else total / size).astype(kind).tobytes()], pa.binary())})

    schema = "part int, n long, change binary"
    some = docs.select("text").mapInArrow(local, schema).withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(32)))  # so that no task reads every task's weights
    got = sorted(some.groupBy("part", "salt").applyInArrow(merge, schema).groupBy("part").applyInArrow(merge, schema).collect())
    if not got:
        return weights, [np.zeros(x) for x in shapes]
    change = np.concatenate([np.frombuffer(r[2], np.float16) for r in got if r[0] < parts]).astype(np.float32)
    counts = np.concatenate([np.frombuffer(r[2], np.float64) for r in got if r[0] >= parts])
    out, at = [], 0
    for w in weights:
        out.append((w + change[at : at + w.size].reshape(w.shape)).astype(np.float32))
        at += w.size
    ends = np.cumsum([math.prod(x) for x in shapes])[:-1]
    return out, [x.reshape(shape) for x, shape in zip(np.split(counts, ends), shapes, strict=True)]


# --------------------------------------------------------------------- scoring
_DOC = "block long, bucket int, a binary, b binary, c binary, d binary, e binary, f binary"


def _row_batch(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), *[pa.array(c, pa.binary()) for c in cols[2:]]], ["block", "bucket", *"abcdef"])


def score(docs: DataFrame, counts: DataFrame, vocab: Vocabulary, weights: list[np.ndarray], buckets: int) -> DataFrame:
    """``docs``: doc_id, held_out, text. One row per document: doc_id, held_out,
    n_tokens, n_known, train_tokens, base_score, score."""
    small_batches(docs.sparkSession)

    def blocks(batches):
        held: list[tuple] = []
        n_tok = n_doc = 0

        def flush():
            block = int.from_bytes(os.urandom(8), "little", signed=True)
            cols = [np.concatenate(x) for x in zip(*[h[:6] for h in held], strict=True)]
            yield _row_batch([(block, -1, *[c.tobytes() for c in cols])])
            th = np.concatenate([h[6] for h in held])
            td = np.concatenate([h[7] + d for h, d in zip(held, np.cumsum([0] + [len(h[0]) for h in held[:-1]]), strict=True)])
            if not len(th):
                return
            order = np.argsort(th, kind="stable")  # by token, then document
            th, td = th[order], td[order]
            new = np.ones(len(th), bool)
            new[1:] = (th[1:] != th[:-1]) | (td[1:] != td[:-1])
            pair = np.flatnonzero(new)
            tf = np.diff(np.concatenate([pair, [len(th)]])).astype(np.uint32)
            ph, pd_ = th[pair], td[pair].astype(np.uint16)
            at = runs(ph)
            u, n = ph[at[:-1]], np.diff(at).astype(np.uint32)
            cut = runs(bucket_of(u, buckets))
            out = []
            for a, b in zip(cut[:-1], cut[1:], strict=True):
                x, y = at[a], at[b]
                out.append((block, int(bucket_of(u[a : a + 1], buckets)[0]), u[a:b].tobytes(), n[a:b].tobytes(), pd_[x:y].tobytes(), tf[x:y].tobytes(), b"", b""))
            yield _row_batch(out)

        for b in batches:
            for lo, hi, buf, off in text_slices(b, 2):
                h, per = tokens(buf, off)
                at, cls, rows, (one, two) = histories(h, per, vocab)
                lp = np.empty(len(h))
                for a in range(0, len(h), STEP):
                    g = class_logits(weights, rows, a, a + STEP)
                    own = g[np.arange(len(g)), cls[a : a + STEP]]
                    np.exp(g, out=g)
                    lp[a : a + STEP] = own - np.log(g.sum(axis=1))
                hit = at >= 0
                known = np.flatnonzero(hit)
                lp /= math.log(10)
                lp -= np.where(hit, 0.0, vocab.log_class[cls])
                lp[known] += vocab.inner.log_probability(at[known], one[known], two[known])
                known = np.where(hit, vocab.log_count[at], 0.0) if len(vocab.h) else np.zeros(len(h))
                doc = np.repeat(np.arange(hi - lo), per)
                tail = ~hit
                unknown = b.column(0).slice(lo, hi - lo).is_null().to_numpy(zero_copy_only=False).astype(np.int8)
                held_out = b.column(1).slice(lo, hi - lo).to_numpy(zero_copy_only=False).astype(np.int8)
                held.append((
                    b.column(0).slice(lo, hi - lo).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), held_out + 2 * unknown, per.astype(np.int64),
                    np.bincount(doc, hit, hi - lo), np.bincount(doc, known, hi - lo), np.bincount(doc, lp, hi - lo), h[tail], doc[tail].astype(np.int64),
                ))
                n_tok, n_doc = n_tok + len(h), n_doc + hi - lo
                if n_tok > BLOCK_TOKENS or n_doc > BLOCK_DOCS:
                    yield from flush()
                    held, n_tok, n_doc = [], 0, 0
        if held:
            yield from flush()

    def answer(table: pa.Table) -> pa.Table:
        kind = table.column("block").is_null().to_numpy()
        i = np.flatnonzero(kind)
        h = np.frombuffer(table.column("a")[int(i[0])].as_py(), np.uint64) if len(i) else np.zeros(0, np.uint64)
        c = np.frombuffer(table.column("b")[int(i[0])].as_py(), np.int64) if len(i) else np.zeros(0, np.int64)
        out = []
        for j in np.flatnonzero(~kind).tolist():
            u, n, d, tf = (np.frombuffer(table.column(x)[j].as_py(), t) for x, t in zip("abcd", (np.uint64, np.uint32, np.uint16, np.uint32), strict=True))
            own = np.zeros(len(u), np.int64)
            if len(h):
                at = np.minimum(np.searchsorted(h, u), len(h) - 1)
                own = np.where(h[at] == u, c[at], 0)
            own = np.repeat(own, n)
            docs_, k = np.unique(d, return_inverse=True)
            out.append((table.column("block")[j].as_py(), 0, docs_.tobytes(), np.bincount(k, tf * np.log10(own + ALPHA)).tobytes(), np.bincount(k, tf * (own > 0)).astype(np.uint32).tobytes(), b"", b"", b""))
        return pa.Table.from_batches([_row_batch(out)]) if out else pa.schema([("block", pa.int64()), ("bucket", pa.int32()), *[(x, pa.binary()) for x in "abcdef"]]).empty_table()

    def finish(table: pa.Table) -> pa.Table:
        kind = table.column("bucket").to_numpy()
        i = int(np.flatnonzero(kind == -1)[0])
        ids, held, n, known, base, lp = (np.frombuffer(table.column(x)[i].as_py(), t).copy() for x, t in zip("abcdef", (np.int64, np.int8, np.int64, np.float64, np.float64, np.float64), strict=True))
        for j in np.flatnonzero(kind != -1).tolist():
            d, s, k = (np.frombuffer(table.column(x)[j].as_py(), t) for x, t in zip("abc", (np.uint16, np.float64, np.uint32), strict=True))
            base[d] += s
            lp[d] += s
            known[d] += k
        base -= n * math.log10(vocab.total + ALPHA * (vocab.distinct + 1))
        return pa.table({"doc_id": pa.array(ids, mask=held >= 2), "held_out": (held % 2).astype(bool), "n_tokens": n, "n_known": known.astype(np.int64), "train_tokens": np.full(len(ids), vocab.total, np.int64), "base_score": base, "score": lp})

    asked = scratch(docs.select("doc_id", "held_out", "text").mapInArrow(blocks, _DOC), "asked")
    blank = F.lit(None).cast("binary")
    table = counts.select(F.lit(None).cast("long").alias("block"), "bucket", F.col("hashes").alias("a"), F.col("counts").alias("b"), *[blank.alias(x) for x in "cdef"])
    told = asked.where("bucket >= 0").union(table).groupBy("bucket").applyInArrow(answer, _DOC)
    return asked.where("bucket = -1").union(told).groupBy("block").applyInArrow(finish, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def fit(train: DataFrame, buckets: int) -> tuple[DataFrame, Vocabulary, list[np.ndarray]]:
    """Counts, vocabulary and weights from the texts of ``train`` (doc_id, text). The
    first round takes a quarter of the texts, the second the rest."""
    small_batches(train.sparkSession)
    counts = count_tokens(train, buckets)
    vocab = vocabulary(counts)
    weights = start_weights()
    quarter = F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0
    seen = [np.zeros(x) for x in vocab.inner.shapes()]
    for share in (quarter, ~quarter):
        weights, more = gradient_round(train.where(share), vocab, weights)
        seen = [a + b for a, b in zip(seen, more, strict=True)]
    vocab.inner.fit(*seen)
    return counts, vocab, weights


def score_corpus(docs: DataFrame, held_out) -> DataFrame:
    """Fit on the rows that ``held_out`` leaves, score all rows of ``docs``."""
    docs = docs.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "text")
    buckets = max(48, tasks(docs.sparkSession))
    counts, vocab, weights = fit(docs.where(~F.col("held_out")).select("doc_id", "text"), buckets)
    return score(docs, counts, vocab, weights, buckets)


def op1_maxent(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return score_corpus(docs, F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(10)) == 0)
