"""Language identification by a bidirectional GRU over bytes, trained in numpy.

The network reads a word's bytes between two boundary marks in both directions and
labels every byte; a document's probabilities are the mean over all bytes of its words
that hold a letter. Words are segments of at most ``SEGMENT`` bytes, so a text of any
length is read whole, and equal words of a task are run once. Training is
backpropagation through time with Adam on a bounded sample of rows, read whole: the
``SAMPLE_DOCS`` documents of each label with the smallest hashes of doc_id.

Cases: a null text, or one without a letter, is ``und`` with score 0; without labelled
documents every document is ``und``; ties go to the smaller label; null labels are never
learned from; repeated rows are predicted alike.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import LOWER, lean, owner, small_batches, text_slices, word_hashes, words

HIDDEN = 16
SEGMENT = 30
SAMPLE_DOCS = 200
EPOCHS, LEAST_STEPS = 3, 350
BATCH = 256
CACHE = 300_000
MARK = 256

LETTERISH = np.zeros(256, bool)
LETTERISH[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


# ------------------------------------------------------------------------- network
def init(labels: int, seed: int = 7) -> dict[str, np.ndarray]:
    r = np.random.default_rng(seed)
    p = {}
    for d in "fb":
        p["E" + d] = r.normal(0, 0.3, (257, 3 * HIDDEN))
        p["U" + d] = r.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, 3 * HIDDEN))
        p["W" + d] = r.normal(0, 0.3, (HIDDEN, labels))
    p["c"] = np.zeros(labels)
    return {k: v.astype(np.float32) for k, v in p.items()}


def _sigmoid(x):
    return 0.5 * (1 + np.tanh(0.5 * x))


def _gru(E, U, seq):
    """States (T, B, H) over ``seq`` (B, T) and what backpropagation needs."""
    H = HIDDEN
    h = np.zeros((len(seq), H), np.float32)
    out, kept = [], []
    for t in range(seq.shape[1]):
        x, u = E[seq[:, t]], h @ U
        zr = _sigmoid(x[:, : 2 * H] + u[:, : 2 * H])
        z, r = zr[:, :H], zr[:, H:]
        n = np.tanh(x[:, 2 * H :] + r * u[:, 2 * H :])
        kept.append((h, z, r, n, u[:, 2 * H :]))
        h = n + z * (h - n)
        out.append(h)
    return np.stack(out), kept


def _gru_back(E, U, seq, kept, dout):
    H = HIDDEN
    dE, dU = np.zeros_like(E), np.zeros_like(U)
    dh = np.zeros_like(kept[0][0])
    for t in range(seq.shape[1] - 1, -1, -1):
        h, z, r, n, un = kept[t]
        dh = dh + dout[t]
        dn = dh * (1 - z) * (1 - n * n)
        dz = dh * (h - n) * z * (1 - z)
        dr = dn * un * r * (1 - r)
        du = np.concatenate([dz, dr, dn * r], axis=1)
        np.add.at(dE, seq[:, t], np.concatenate([dz, dr, dn], axis=1))
        dU += h.T @ du
        dh = dh * z + du @ U.T
    return dE, dU


def _padded(segments: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Marked byte sequences, the same reversed (padding stays at the end), lengths."""
    n = np.array([len(s) + 2 for s in segments])
    seq = np.full((len(segments), n.max()), MARK, np.int64)
    for i, s in enumerate(segments):
        seq[i, 1 : n[i] - 1] = np.frombuffer(s, np.uint8)
    turn = np.maximum(n[:, None] - 1 - np.arange(seq.shape[1]), 0)
    return seq, np.take_along_axis(seq, turn, 1), n


def loss_and_grads(p, seq, rev, n, y):
    """Mean cross-entropy over all byte positions and its gradients."""
    T = seq.shape[1]
    hf, kf = _gru(p["Ef"], p["Uf"], seq)
    hb, kb = _gru(p["Eb"], p["Ub"], rev)
    turn = np.maximum(n[:, None] - 1 - np.arange(T), 0).T  # (T, B)
    cols = np.arange(len(seq))[None, :]
    aligned = hb[turn, cols]
    logits = hf @ p["Wf"] + aligned @ p["Wb"] + p["c"]
    logits -= logits.max(axis=2, keepdims=True)
    q = np.exp(logits)
    q /= q.sum(axis=2, keepdims=True)
    t = np.arange(T)[:, None]
    inside = ((t >= 1) & (t < n[None, :] - 1)).astype(np.float32)
    total = inside.sum()
    loss = -(np.log(q[t, cols, y[None, :]] + 1e-9) * inside).sum() / total
    d = q.copy()
    d[t, cols, y[None, :]] -= 1
    d *= (inside / total)[:, :, None]
    g = {"c": d.sum(axis=(0, 1)), "Wf": np.einsum("tbh,tbl->hl", hf, d), "Wb": np.einsum("tbh,tbl->hl", aligned, d)}
    dhb = np.zeros_like(hb)
    np.add.at(dhb, (turn, cols), d @ p["Wb"].T)
    g["Ef"], g["Uf"] = _gru_back(p["Ef"], p["Uf"], seq, kf, d @ p["Wf"].T)
    g["Eb"], g["Ub"] = _gru_back(p["Eb"], p["Ub"], rev, kb, dhb)
    return loss, g


def train(samples: list[tuple[bytes, str]], seed: int = 7) -> tuple[list[str], dict[str, np.ndarray]]:
    """Labels and weights from (word, label) pairs."""
    labels = sorted({y for _, y in samples})
    r = np.random.default_rng(seed)
    words_of = {name: sorted({w for w, y in samples if y == name}) for name in labels}
    most = max(map(len, words_of.values()), default=0)
    data = []
    for k, name in enumerate(labels):  # labels of fewer words repeat them, so that all weigh alike
        data += [(words_of[name][i], k) for i in np.resize(r.permutation(len(words_of[name])), most)]
    p = init(max(1, len(labels)), seed)
    if len(labels) < 2:
        return labels, p
    m, v = ({k: np.zeros_like(x) for k, x in p.items()} for _ in range(2))
    step = 0
    epochs = max(EPOCHS, -(-LEAST_STEPS * BATCH // max(1, len(data))))  # small samples are read more often
    for epoch in range(epochs):
        order = r.permutation(len(data))
        order = order[np.argsort([len(data[i][0]) // 3 for i in order], kind="stable")]
        chunks = [order[i : i + BATCH] for i in range(0, len(order), BATCH)]
        for c in r.permutation(len(chunks)):
            seq, rev, n = _padded([data[i][0] for i in chunks[c]])
            _, g = loss_and_grads(p, seq, rev, n, np.array([data[i][1] for i in chunks[c]]))
            step += 1
            rate = 0.01 * 0.3 ** (EPOCHS * epoch // epochs)
            for k in p:
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                v[k] = 0.99 * v[k] + 0.01 * g[k] * g[k]
                p[k] -= (rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
    return labels, p


def word_probabilities(p, buf: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sum over each segment's bytes of the label probabilities. Segments are taken by
    falling length, so that a step runs only those still going."""
    out = np.zeros((len(starts), len(p["c"])), np.float32)
    order = np.argsort(-lengths, kind="stable")
    H = HIDDEN
    for i in range(0, len(order), 8192):
        some = order[i : i + 8192]
        s, n = starts[some], lengths[some]
        T, B = int(n[0]) + 2, len(some)
        pos = np.arange(T - 2)
        body = np.full((T, B), MARK, np.int16)
        body[1:-1] = np.where(pos[:, None] < n[None, :], LOWER[buf[np.minimum(s[None, :] + pos[:, None], len(buf) - 1)]].astype(np.int16), np.int16(MARK))
        logits = np.zeros((T, B, len(p["c"])), np.float32)
        for d in "fb":
            E, U, W = p["E" + d], p["U" + d], p["W" + d]
            h = np.zeros((B, H), np.float32)
            for t in range(T - 1):
                live = int(np.searchsorted(-n, -(t - 1), side="right")) if t > 1 else B  # n + 2 > t, at least
                if not live:
                    break
                at = np.full(live, t) if d == "f" else n[:live] + 1 - t
                x, u = E[body[at, np.arange(live)]], h[:live] @ U
                zr = _sigmoid(x[:, : 2 * H] + u[:, : 2 * H])
                nn = np.tanh(x[:, 2 * H :] + zr[:, H:] * u[:, 2 * H :])
                h[:live] = nn + zr[:, :H] * (h[:live] - nn)
                logits[at, np.arange(live)] += h[:live] @ W
        logits += p["c"]
        logits -= logits.max(axis=2, keepdims=True)
        np.exp(logits, out=logits)
        logits /= logits.sum(axis=2, keepdims=True)
        inside = pos[:, None] < n[None, :]
        out[some] = (logits[1:-1] * inside[:, :, None]).sum(axis=0)
    return out


# ------------------------------------------------------------------------- Spark side
def segments(buf: np.ndarray, off: np.ndarray):
    """Starts, lengths and text index of the segments that hold a letter-like byte."""
    starts, ends, counts = words(buf, off)
    if not len(starts):
        return starts, ends, owner(counts)
    hold = np.logical_or.reduceat(LETTERISH[buf], starts)
    starts, ends, doc = starts[hold], ends[hold], owner(counts)[hold]
    parts = -(-(ends - starts) // SEGMENT)
    if (parts > 1).any():
        i = np.repeat(np.arange(len(parts)), parts)
        k = np.arange(len(i)) - np.repeat(np.cumsum(parts) - parts, parts)
        starts, ends, doc = starts[i] + k * SEGMENT, np.minimum(ends[i], starts[i] + (k + 1) * SEGMENT), doc[i]
    return starts, ends - starts, doc


def crc_mod(n: int):
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(n))


def sample(docs: DataFrame) -> list[tuple[bytes, str]]:
    """Distinct (word, label) pairs of the bounded training sample of ``docs`` (doc_id,
    text, lang)."""
    small_batches(docs.sparkSession)
    known = docs.where("text IS NOT NULL AND lang IS NOT NULL")
    w = Window.partitionBy("lang").orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id")
    ids = known.select("doc_id", "lang").withColumn("rk", F.row_number().over(w)).where(F.col("rk") <= SAMPLE_DOCS).select("doc_id").distinct()
    picked = known.join(F.broadcast(ids), "doc_id", "left_semi").select("text", "lang")  # SAMPLE_DOCS a label

    @lean
    def pick(batches):
        for b in batches:
            for lo, hi, buf, off in text_slices(b):
                s, n, doc = segments(buf, off)
                lang = b.column(1).slice(lo, hi - lo).to_pylist()
                low = LOWER[buf].tobytes()
                pairs = sorted({(low[a : a + k], lang[d]) for a, k, d in zip(s.tolist(), n.tolist(), doc.tolist(), strict=True)})
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in pairs], pa.binary()), pa.array([x[1] for x in pairs], pa.string())], ["word", "lang"])

    rows = picked.mapInArrow(pick, "word binary, lang string").distinct().collect()
    return sorted((bytes(r[0]), r[1]) for r in rows)


def has_letter(text: bytes) -> bool:
    return any(c.isalpha() for c in text.decode("utf-8", "replace"))


def predict(docs: DataFrame, labels: list[str], p: dict[str, np.ndarray], keep: list[str], out: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """The columns ``keep`` of ``docs`` with the predicted label and its probability."""
    small_batches(docs.sparkSession)
    schema = docs.select(*keep).schema
    ascii_letter = np.zeros(256, bool)
    ascii_letter[[*range(65, 91), *range(97, 123)]] = True
    L, extra = len(labels), int("text" not in keep)

    @lean
    def run(batches):
        cache_h, cache_p = np.zeros(0, np.uint64), np.zeros((0, L), np.float32)
        for b in batches:
            for lo, hi, buf, off in text_slices(b):
                n_docs = hi - lo
                total, size = np.zeros((n_docs, L)), np.zeros(n_docs)
                s, n, doc = segments(buf, off)
                if L and len(s):
                    h = word_hashes(buf, s, s + n)
                    h, first, inv = np.unique(h, return_index=True, return_inverse=True)
                    at = np.minimum(np.searchsorted(cache_h, h), max(0, len(cache_h) - 1))
                    known = cache_h[at] == h if len(cache_h) else np.zeros(len(h), bool)
                    probs = np.zeros((len(h), L), np.float32)
                    probs[known] = cache_p[at[known]]
                    new = ~known
                    probs[new] = word_probabilities(p, buf, s[first[new]], n[first[new]])
                    if len(cache_h) + int(new.sum()) > CACHE:
                        cache_h, cache_p = np.zeros(0, np.uint64), np.zeros((0, L), np.float32)
                    cache_h = np.concatenate([cache_h, h[new]])
                    order = np.argsort(cache_h, kind="stable")
                    cache_h, cache_p = cache_h[order], np.concatenate([cache_p, probs[new]])[order]
                    for k in range(L):
                        total[:, k] = np.bincount(doc, probs[inv, k], n_docs)
                    size = np.bincount(doc, n, n_docs).astype(float)
                plain = np.zeros(n_docs, bool)
                if len(buf):
                    full = np.flatnonzero(np.diff(off))
                    plain[full] = np.logical_or.reduceat(ascii_letter[buf], off[full])
                    for i in full[~plain[full]]:
                        plain[i] = has_letter(buf[off[i] : off[i + 1]].tobytes())
                best = total.argmax(axis=1) if L else np.zeros(n_docs, int)
                ok = plain & (size > 0) & bool(L)
                score = np.where(ok, (total[np.arange(n_docs), best] if L else 0) / np.maximum(size, 1), 0.0)
                pred = [labels[k] if good else "und" for k, good in zip(best, ok, strict=True)]
                cols = [b.column(i).slice(lo, n_docs) for i in range(extra, b.num_columns)]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(pred, pa.string()), pa.array(score)], names=[*b.schema.names[extra:], *out])

    ddl = schema.add(out[0], "string").add(out[1], "double")
    sent = docs.select(*keep) if "text" in keep else docs.select("text", *keep)
    return sent.mapInArrow(run, ddl)


def identify(docs: DataFrame, train_on, keep: list[str]) -> DataFrame:
    """Train on the rows of ``docs`` that ``train_on`` selects, then label all rows."""
    labels, p = train(sample(docs.where(train_on).select("doc_id", "text", "lang")))
    return predict(docs, labels, p, keep)


def op10_language_id(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    out = identify(docs, crc_mod(4) != 2, ["doc_id"])
    return out.select("doc_id", (crc_mod(4) == 2).alias("held_out"), "lang_pred", "score")
