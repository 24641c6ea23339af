"""Secret scan: three base patterns, and a linear-chain conditional random field.

The field tags words as secret begin, inside or outside. A word's features are bits of
its shape (kinds of characters, length, digits, a leading keyword), alone and combined,
of itself and both neighbours, and whether its text is rich in digits. It is trained in
numpy, by gradient steps on the exact likelihood, on windows around base matches, around
other words with digits (numbers, addresses: no secrets) and elsewhere in a bounded sample
of ``SAMPLE_DOCS`` documents. As base matches teach only what the patterns know, each of
the other windows is learned once more with a word put in whose shape is that of a key of
no listed kind: long, with digits among letters of both cases, capitals, or marks. Decoding is Viterbi; words
whose best tag can't beat "outside" bound the stretches that need it, so most of a text
costs one table look-up a word. The field adds spans to those of the patterns.

Cases: a null text is empty and has none; very long texts are read whole; an overlapping
field span is left out; repeated rows are scanned each for itself; without a text to learn
from the field adds nothing.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, owner, small_batches, text_slices, words

KINDS = ("assign", "access", "hex", "crf")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = {"assign": 6, "access": 20, "hex": 24}
KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

SAMPLE_DOCS = 4000
WINDOW = 8
STEPS = 120
O, B, I = 0, 1, 2
NEVER = -50.0

# bits of a character's kind
_KIND = np.full(256, 32, np.uint8)  # other marks
_KIND[ord("g") : ord("z") + 1] = 1
_KIND[ord("A") : ord("Z") + 1] = 2
_KIND[ord("0") : ord("9") + 1] = 4
_KIND[[ord("="), ord(":")]] = 8
_KIND[[ord('"'), ord("'"), ord("`")]] = 16
_KIND[128:] = 64
_KIND[ord("a") : ord("f") + 1] = 128
_KIND[[0x20, *range(0x09, 0x0E)]] = 0
_DIGIT = (np.arange(256) >= 48) & (np.arange(256) <= 57)
_STARTS = {int.from_bytes(k[:4], "little") for k in KEYWORDS}
LENGTHS = np.array([2, 4, 8, 12, 16, 20, 24, 32, 48, 80])
_LOW, _UP, _NUM, _MARK = 1 | 128, 2, 4, 32
#: Kinds of characters and classes of digits of keys beside the base kinds.
KEY_SHAPES = [(_LOW | _UP | _NUM, 2), (_LOW | _UP | _NUM, 3), (_LOW | _UP | _NUM | _MARK, 2), (_LOW | _UP | _NUM | _MARK, 3), (_UP | _NUM, 2), (_UP | _NUM, 3), (_UP | _NUM | _MARK, 3), (_LOW | _NUM | _MARK, 3), (_LOW | _NUM, 3)]
#: kind bits, length class (11), digit count class (4), keyword, AKIA
CODES = 256 * 16 * 4 * 2 * 2


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base patterns, by start, then kind as listed."""
    out = []
    low = text.lower()
    if any(k.decode() in low for k in KEYWORDS):
        out += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    out += [(m.start(), m.end(), "hex") for m in re.finditer(r"[0-9a-f]{24,}", text)]  # whole runs of enough characters
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


# --------------------------------------------------------------------- features
def shape_codes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One number per word for all its own features."""
    if not len(starts):
        return np.zeros(0, np.int64)
    kind = np.bitwise_or.reduceat(_KIND[buf], starts).astype(np.int64)
    n = ends - starts
    digits = np.add.reduceat(_DIGIT[buf].astype(np.int32), starts)
    padded = np.concatenate([buf, np.zeros(4, np.uint8)]).astype(np.uint32)
    raw = padded[starts] | padded[starts + 1] << 8 | padded[starts + 2] << 16 | padded[starts + 3] << 24
    low = np.concatenate([LOWER[buf], np.zeros(4, np.uint8)]).astype(np.uint32)
    first = low[starts] | low[starts + 1] << 8 | low[starts + 2] << 16 | low[starts + 3] << 24
    quoted = low[starts + 1] | low[starts + 2] << 8 | low[starts + 3] << 16  # after a quote or brace
    keyword = np.isin(first, np.array(sorted(_STARTS), np.uint32)) | np.isin(quoted, np.array([s & 0xFFFFFF for s in sorted({int.from_bytes(k[:3], "little") for k in KEYWORDS})], np.uint32))
    akia = raw == np.uint32(int.from_bytes(b"AKIA", "little"))
    length = np.searchsorted(LENGTHS, n)
    many = np.searchsorted(np.array([1, 4, 10]), digits, side="right")
    return (((kind * 16 + length) * 4 + many) * 2 + keyword) * 2 + akia


def features(code: np.ndarray) -> np.ndarray:
    """(n, features) indicators of a code: single bits, classes and pairs with digits."""
    akia, keyword, many = code & 1, code >> 1 & 1, code >> 2 & 3
    length, kind = code >> 4 & 15, code >> 8
    cols = [(kind >> b & 1) for b in range(8)]
    cols += [(length == k) for k in range(len(LENGTHS) + 1)] + [(many == k) for k in range(4)] + [keyword, akia]
    only_hex = (kind & ~(4 | 128)) == 0
    letters, both = (kind & (1 | 2 | 128)) > 0, ((kind & (1 | 128)) > 0) & ((kind & 2) > 0)
    cols += [only_hex & (length >= 6), (kind & 4 > 0) & (length >= 4), (many >= 2) & (length >= 4), (kind & 8 > 0) & (many >= 2), (kind & 8 > 0) & keyword.astype(bool), (length == 0) & (kind & 8 > 0)]
    cols += [both & (many >= 2) & (length >= 5), letters & (many >= 2) & (length >= 5), letters & (many == 3) & (length >= 5), (kind & 64 > 0) & (length >= 5)]
    return np.stack(cols, axis=1).astype(np.float64)


N_FEATURES = features(np.zeros(1, np.int64)).shape[1]


class Field:
    """Weights (3 positions, features, tags), text weights (2, tags), transitions."""

    def __init__(self):
        self.w, self.doc, self.t = np.zeros((3, N_FEATURES, 3)), np.zeros((2, 3)), np.zeros((3, 3))
        self.t[O, I] = NEVER
        self.trained = False

    def tables(self) -> list[np.ndarray]:
        """Scores per code for the word before, itself, and the word after."""
        f = features(np.arange(CODES))
        return [(f @ self.w[k]).astype(np.float32) for k in range(3)]


def emissions(tables, doc_weights, codes: np.ndarray, first: np.ndarray, last: np.ndarray, rich: np.ndarray) -> np.ndarray:
    """Scores (n, tags) of words given their neighbours within the text."""
    e = tables[1][codes]
    e[1:] += np.where(first[1:, None], 0, tables[0][codes[:-1]])
    e[:-1] += np.where(last[:-1, None], 0, tables[2][codes[1:]])
    return e + doc_weights[rich.astype(int)]


def log_likelihood_gradient(e: np.ndarray, t: np.ndarray, y: np.ndarray, mask: np.ndarray):
    """Forward-backward over (batch, steps): gradients of the mean log-likelihood by
    emissions and transitions. ``mask`` marks words; sequences start at step 0."""
    n, T, K = e.shape
    start = np.array([0.0, 0.0, NEVER])
    alpha, beta = np.zeros((n, T, K)), np.zeros((n, T, K))
    alpha[:, 0] = e[:, 0] + start
    lse = lambda x, axis: (m := x.max(axis=axis, keepdims=True)).squeeze(axis) + np.log(np.exp(x - m).sum(axis=axis))
    for k in range(1, T):
        a = lse(alpha[:, k - 1, :, None] + t[None], 1) + e[:, k]
        alpha[:, k] = np.where(mask[:, k, None], a, alpha[:, k - 1])
    z = lse(alpha[:, -1], 1)
    for k in range(T - 2, -1, -1):
        b = lse(t[None] + (e[:, k + 1] + beta[:, k + 1])[:, None, :], 2)
        beta[:, k] = np.where(mask[:, k + 1, None], b, 0.0)
    p = np.exp(alpha + beta - z[:, None, None]) * mask[:, :, None]
    pair = np.exp(alpha[:, :-1, :, None] + t[None, None] + (e[:, 1:] + beta[:, 1:])[:, :, None, :] - z[:, None, None, None]) * mask[:, 1:, None, None]
    gold = np.eye(K)[y] * mask[:, :, None]
    steps = gold[:, :-1, :, None] * gold[:, 1:, None, :]
    return (gold - p) / n, (steps - pair).sum(axis=(0, 1)) / n


def key_like(code: np.ndarray) -> np.ndarray:
    """Words that may be keys of a kind no pattern knows: not to be learned as others."""
    return ((code >> 8 & (1 | 2 | 128)) > 0) & ((code >> 4 & 15) >= 5)


def planted(windows: list[tuple[np.ndarray, np.ndarray, bool]], seed: int = 13) -> list[tuple[np.ndarray, np.ndarray, bool]]:
    """The windows without a secret, three times with one word of a key's shape put in and
    once with a long number among marks, which is none."""
    r = np.random.default_rng(seed)
    out = []
    for codes, tags, rich in windows:
        if not len(codes) or (tags != O).any():
            continue
        for tag in (B, B, B, O):
            kind, many = KEY_SHAPES[int(r.integers(0, len(KEY_SHAPES)))] if tag == B else (_NUM | _MARK, 3)
            at = int(r.integers(0, len(codes)))
            own, told = codes.copy(), tags.copy()
            own[at] = ((kind * 16 + int(r.integers(5, len(LENGTHS) + 1))) * 4 + many) * 4
            told[at] = tag
            out.append((own, told, rich))
    return out


def train(windows: list[tuple[np.ndarray, np.ndarray, bool]]) -> Field:
    """``windows``: codes, tags, text rich in digits."""
    field = Field()
    windows = windows + planted(windows)
    if not any((y != O).any() for _, y, _ in windows):
        return field
    n, T = len(windows), max(len(c) for c, _, _ in windows)
    x, y, mask = np.zeros((n, T, N_FEATURES)), np.zeros((n, T), int), np.zeros((n, T), bool)
    rich = np.array([r for _, _, r in windows]).astype(int)
    for i, (c, tags, _) in enumerate(windows):
        x[i, : len(c)], y[i, : len(c)], mask[i, : len(c)] = features(c), tags, True
    near = [np.zeros_like(x), x, np.zeros_like(x)]
    near[0][:, 1:], near[2][:, :-1] = x[:, :-1], x[:, 1:]
    names = ("w", "doc", "t")
    m, v = ({k: np.zeros_like(getattr(field, k)) for k in names} for _ in range(2))
    for step in range(1, STEPS + 1):
        e = sum(near[k] @ field.w[k] for k in range(3)) + field.doc[rich][:, None, :]
        de, dt = log_likelihood_gradient(e, field.t, y, mask)
        dt[O, I] = 0
        g = {"w": np.stack([np.einsum("ntf,ntk->fk", near[k], de) for k in range(3)]) - 1e-4 * field.w, "doc": np.stack([de[rich == r].sum(axis=(0, 1)) for r in (0, 1)]), "t": dt}
        for k in names:
            m[k] = 0.9 * m[k] + 0.1 * g[k]
            v[k] = 0.99 * v[k] + 0.01 * g[k] ** 2
            setattr(field, k, getattr(field, k) + 0.1 * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8))
    field.trained = True
    return field


def viterbi(e: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Best tags of one stretch that stands between words outside."""
    best, back = e[0] + t[O], []
    for row in e[1:]:
        both = best[:, None] + t
        back.append(both.argmax(axis=0))
        best = both.max(axis=0) + row
    tag = int((best + t[:, O]).argmax())
    out = [tag]
    for b in reversed(back):
        out.append(tag := int(b[tag]))
    return np.array(out[::-1])


def stretches(e: np.ndarray, t: np.ndarray, first: np.ndarray, reach: int = 8):
    """(start, end) of word ranges that can hold a secret: each has a word whose best
    tag, with the most that its transitions can add, beats "outside"."""
    gain = max(0.0, float(max(t[O, B] + t[B, O], t[O, B] + t[B, I], t[I, I] + t[I, O], t[B, I] + t[I, O], t[I, I]) - 2 * t[O, O]), float(t[I, I] - t[O, O]), float(t[B, I] - t[O, O]))
    hot = np.flatnonzero(np.maximum(e[:, B], e[:, I]) - e[:, O] + gain > 0)
    if not len(hot):
        return
    text = np.cumsum(first)
    cut = np.flatnonzero((np.diff(hot) > 2 * reach) | (np.diff(text[hot]) > 0))
    begins = np.concatenate([[0], cut + 1])
    ends = np.concatenate([cut, [len(hot) - 1]])
    for a, b in zip(hot[begins], hot[ends], strict=True):
        lo = max(a - reach, int(np.searchsorted(text, text[a])))
        hi = min(b + reach + 1, int(np.searchsorted(text, text[b], side="right")))
        yield lo, hi


# --------------------------------------------------------------------- Spark side
def _tables_of(buf, off):
    starts, ends, counts = words(buf, off)
    codes = shape_codes(buf, starts, ends)
    edge = np.cumsum(counts)
    first, last = np.zeros(len(starts), bool), np.zeros(len(starts), bool)
    some = counts > 0
    first[(edge - counts)[some]] = True
    last[edge[some] - 1] = True
    rich = np.zeros(len(counts), bool)
    if len(starts):
        doc = owner(counts)
        rich = np.bincount(doc, (codes >> 2 & 3) > 0, len(counts)) > 0.1 * counts
        rich_word = rich[doc]
    else:
        rich_word = np.zeros(0, bool)
    return starts, ends, counts, codes, first, last, rich, rich_word


def sample_windows(docs: DataFrame) -> list[tuple[np.ndarray, np.ndarray, bool]]:
    """Training windows of the bounded sample: around base matches (up to four a
    document), around other words with four digits or more that are no longer words with letters (up
    to two), and one elsewhere
    in every fourth document."""
    small_batches(docs.sparkSession)
    ids = docs.where("text IS NOT NULL").select("doc_id").orderBy(F.md5(F.col("doc_id").cast("string"))).limit(SAMPLE_DOCS)
    picked = docs.join(F.broadcast(ids), "doc_id", "left_semi").select("doc_id", "text")

    def pick(batches):
        for b in batches:
            for lo, hi, buf, off in text_slices(b):
                starts, ends, counts, codes, _, _, rich, _ = _tables_of(buf, off)
                edge, out = np.concatenate([[0], np.cumsum(counts)]), []
                for i in range(hi - lo):
                    a, z = int(edge[i]), int(edge[i + 1])
                    if a == z:
                        continue
                    raw = buf[off[i] : off[i + 1]].tobytes().decode("utf-8", "replace")
                    tags = np.zeros(z - a, np.int8)
                    for s, e, _ in base_spans(raw):
                        s, e = len(raw[:s].encode()) + off[i], len(raw[:e].encode()) + off[i]
                        hit = np.flatnonzero((ends[a:z] > s) & (starts[a:z] < e))
                        tags[hit] = np.where(tags[hit] == B, B, I)
                        if len(hit) and not (hit[0] and tags[hit[0] - 1] != O):
                            tags[hit[0]] = B
                    plain = np.flatnonzero((tags == O) & ((codes[a:z] >> 2 & 3) >= 2) & ~key_like(codes[a:z]))
                    centres = [*np.flatnonzero(tags == B)[:4].tolist(), *plain[:2].tolist(), *([hash_place(i, z - a)] if i % 4 == 0 else [])]
                    for c in centres:
                        p, q = max(0, c - WINDOW), min(z - a, c + WINDOW + 1)
                        while p > 0 and tags[p] == I:
                            p -= 1
                        out.append((codes[a + p : a + q].astype(np.int64).tobytes(), tags[p:q].tobytes(), bool(rich[i])))
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.binary()), pa.array([x[1] for x in out], pa.binary()), pa.array([x[2] for x in out], pa.bool_())], ["codes", "tags", "rich"])

    rows = sorted(picked.mapInArrow(pick, "codes binary, tags binary, rich boolean").collect())
    return [(np.frombuffer(r[0], np.int64), np.frombuffer(r[1], np.int8).astype(int), r[2]) for r in rows]


def hash_place(i: int, n: int) -> int:
    return (i * 2654435761 + 12345) % n


def scan(docs: DataFrame, field: Field) -> DataFrame:
    """doc_id, counts by base kind, base_sha256, spans for each row of ``docs``."""
    small_batches(docs.sparkSession)
    doc_weights, t = field.doc.astype(np.float32), field.t
    weights = field.w

    def run(batches):
        f = Field()
        f.w = weights
        tables = f.tables()
        for b in batches:
            for lo, hi, buf, off in text_slices(b, 1):
                starts, ends, counts, codes, first, last, _, rich = _tables_of(buf, off)
                edge = np.concatenate([[0], np.cumsum(counts)])
                found: dict[int, list[tuple[int, int]]] = {}
                if field.trained and len(starts):
                    e = emissions(tables, doc_weights, codes, first, last, rich)
                    for a, z in stretches(e, t, first):
                        tags = viterbi(e[a:z], t)
                        begin = None
                        for k, tag in enumerate([*tags.tolist(), O]):
                            if begin is not None and tag != I:
                                doc = int(np.searchsorted(edge, a + begin, side="right")) - 1
                                found.setdefault(doc, []).append((int(starts[a + begin] - off[doc]), int(ends[a + k - 1] - off[doc])))
                                begin = None
                            if tag == B:
                                begin = k
                suspect = _suspects(buf, off, starts, ends, counts)
                suspect[list(found)] = True
                cols: tuple[list, ...] = ([], [], [], [], [])
                for i in range(hi - lo):
                    spans: list[tuple[int, int, str]] = []
                    extra: list[tuple[int, int, str]] = []
                    if suspect[i]:
                        raw = buf[off[i] : off[i + 1]].tobytes()
                        text = raw.decode("utf-8", "replace")
                        spans = base_spans(text)
                        for s, z in found.get(i, ()):
                            s, z = len(raw[:s].decode("utf-8", "replace")), len(raw[:z].decode("utf-8", "replace"))
                            if not any(s < y and x < z for x, y, _ in spans):
                                extra.append((s, z, "crf"))
                    told = lambda some: ",".join(f"{k}:{s}:{z}" for s, z, k in sorted(some, key=lambda x: (x[0], KINDS.index(x[2]))))
                    for c, kind in zip(cols, KINDS[:3], strict=False):
                        c.append(sum(k == kind for _, _, k in spans))
                    cols[3].append(hashlib.sha256(told(spans).encode()).hexdigest())
                    cols[4].append(told(spans + extra))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo).cast(pa.int64()), *[pa.array(c, pa.int64()) for c in cols[:3]], *[pa.array(c, pa.string()) for c in cols[3:]]], ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def _suspects(buf, off, starts, ends, counts) -> np.ndarray:
    """Texts in which a base pattern can match: they hold a keyword, AKIA, or a word long
    enough for a hex run."""
    out = np.zeros(len(off) - 1, bool)
    long_ = np.flatnonzero(ends - starts >= LEAST["hex"])
    if len(long_):
        out[np.searchsorted(off, starts[long_], side="right") - 1] = True
    low, raw = LOWER[buf].tobytes(), buf.tobytes()
    for data, keys in ((low, KEYWORDS), (raw, (b"AKIA",))):
        for k in keys:
            at = data.find(k)
            while at >= 0:
                i = int(np.searchsorted(off, at, side="right")) - 1
                out[i] = True
                at = data.find(k, int(off[i + 1]))
    return out


def find_secrets(docs: DataFrame) -> DataFrame:
    return scan(docs, train(sample_windows(docs)))


def op9_secret_scan(spark, sf_dir: str) -> DataFrame:
    return find_secrets(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
