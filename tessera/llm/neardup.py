"""Near-duplicate documents by SuperMinHash signatures, banding, exact verification and
union-find grouping.

1. One pass over the texts makes each document's set of distinct word shingles, its
   fingerprint and its SuperMinHash signature: an element visits registers in a random
   permutation, its rank at step j being j plus a fraction, and a document stops as soon
   as no register can still fall, which long documents reach after one step.
2. Documents with equal sets collapse to the smallest doc_id.
3. Signatures are cut into bands. In a band's bucket the member most like all others is
   compared with the rest by signature; members it doesn't resemble get a pivot of their
   own. That yields a few pairs per member, not all pairs of a bucket.
4. Pairs are confirmed on the full sets (``100 * both >= 75 * any``), linked, and joined
   to components.
5. Buckets that still hold several components are dealt to blocks: members outside a
   bucket's largest component ask, in blocks, every block of the bucket. A first pass over
   signatures finds who has a candidate in another component, a pair counting in its first
   shared band only; a second compares those on their full sets inside the tasks. Only
   links leave a task, at most one per member and block, and join the components.

No candidate is left out: a pair of similarity 0.75 shares no band with probability
(1 - 0.75**3)**24 = 2e-6, and comparing signatures drops it with a probability of the same
order.

Cases: null or empty texts, and texts without words, have an empty set and are linked
with nothing; fewer words than a shingle make one shingle; ties go to the smallest
doc_id. Rows that share a doc_id are one document and each is returned: if their texts
differ, the one with words and the least fingerprint is compared and ``n_shingles`` is each row's
own. A row without doc_id is linked with nothing: its component is null and it is kept.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import binary_column, drop_scratch, lean, mix64, owner, scratch, small_batches, text_slices, word_hashes, words
from .graph import components

SHINGLE = 5
REGISTERS, ROWS = 72, 3
BANDS = REGISTERS // ROWS
THRESHOLD = 75  # per cent
BUCKET = 2048
#: A signature's similarity below which a pair is not worth confirming, five standard deviations below the threshold.
LIKE = 0.5
#: Members and shingles of a block in step 5.
BLOCK, BLOCK_SHINGLES = 1024, 1 << 22

_C = np.random.default_rng(20).integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SPREAD = 0x9E3779B97F4A7C15


def shingle_sets(buf: np.ndarray, off: np.ndarray, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, end to end, and their counts."""
    starts, ends, counts = words(buf, off)
    h = word_hashes(buf, starts, ends)
    docs = len(counts)
    if len(h) >= n:
        all_ = np.zeros(len(h) - n + 1, np.uint64)
        for i in range(n):
            all_ += h[i : len(h) - n + 1 + i] * _C[i]
        own = owner(counts)
        keys, key_doc = mix64(all_[same := own[: len(all_)] == own[n - 1 :]]), own[: len(all_)][same]
    else:
        keys, key_doc = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    per = np.bincount(key_doc, minlength=docs)
    short = np.flatnonzero((counts > 0) & (counts < n))
    if len(short):
        first = np.cumsum(counts) - counts
        extra = np.array([np.sum(h[first[d] : first[d] + counts[d]] * _C[8 : 8 + counts[d]], dtype=np.uint64) + np.uint64(counts[d]) for d in short], np.uint64)
        order = np.argsort(np.concatenate([key_doc, short]), kind="stable")
        keys = np.concatenate([keys, mix64(extra)])[order]
        per[short] = 1
    at = np.concatenate([[0], np.cumsum(per)])
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        keys[a:b].sort()
    if not len(keys):
        return keys, per
    own = owner(per)
    fresh = np.ones(len(keys), bool)
    fresh[1:] = (keys[1:] != keys[:-1]) | (own[1:] != own[:-1])
    return keys[fresh], np.bincount(own[fresh], minlength=docs)


def superminhash(keys: np.ndarray, counts: np.ndarray, m: int = REGISTERS) -> np.ndarray:
    """(texts, m) registers; each holds step and fraction of its smallest rank as one
    number. Texts without elements keep the largest number."""
    regs = np.full((len(counts), m), np.iinfo(np.uint64).max, np.uint64)
    flat, el, doc = regs.reshape(-1), keys, owner(counts)
    perm = None
    for j in range(m):
        r = mix64(el + np.uint64(_SPREAD * (j + 1) % 2**64))
        k = j + ((r & np.uint64(0xFFFFFFFF)) * np.uint64(m - j) >> np.uint64(32)).astype(np.int64)
        rows = np.arange(len(el))
        at = k if perm is None else perm[rows, k].astype(np.int64)
        np.minimum.at(flat, doc * m + at, (np.uint64(j) << np.uint64(32)) | (r >> np.uint64(32)))
        going = (regs.max(axis=1) >= np.uint64(j + 1) << np.uint64(32)) & (counts > 0)
        stay = going[doc]
        if not stay.any():
            break
        if perm is None:
            perm = np.tile(np.arange(m, dtype=np.uint8), (int(stay.sum()), 1))
            perm[np.arange(len(perm)), k[stay]] = 0
        else:
            perm[rows, k] = perm[:, j]
            perm = perm[stay]
        el, doc = el[stay], doc[stay]
    return regs


def _fingerprint(keys: np.ndarray, counts: np.ndarray, c: int) -> np.ndarray:
    """One number for each text's set; 0 for an empty one."""
    some, out = np.flatnonzero(counts), np.zeros(len(counts), np.uint64)
    if len(some):
        out[some] = np.add.reduceat(mix64(keys ^ _C[c]), (np.cumsum(counts) - counts)[some])
    return out


@lean
def _signatures(batches):
    for batch in batches:
        ids = batch.column(0)
        for a, b, buf, off in text_slices(batch):
            keys, counts = shingle_sets(buf, off)
            regs = superminhash(keys, counts)
            f1, f2 = _fingerprint(keys, counts, 40), _fingerprint(keys, counts, 41)
            bands = mix64((regs.reshape(b - a, BANDS, ROWS) * _C[50 : 50 + ROWS]).sum(axis=2, dtype=np.uint64))
            low = (regs & np.uint64(0xFFFF)).astype(np.uint16)
            yield pa.RecordBatch.from_arrays(
                [
                    ids.slice(a, b - a).cast(pa.int64()), pa.array(counts.astype(np.int64)), pa.array(f1.view(np.int64)), pa.array(f2.view(np.int64)),
                    binary_column([x.tobytes() for x in low]), pa.ListArray.from_arrays(pa.array(np.arange(b - a + 1, dtype=np.int32) * BANDS), pa.array(bands.view(np.int64).reshape(-1))),
                ],
                ["doc_id", "n_shingles", "f1", "f2", "sig", "bands"],
            )


@lean
def _sets(batches):
    for batch in batches:
        ids = batch.column(0)
        for a, b, buf, off in text_slices(batch):
            keys, counts = shingle_sets(buf, off)
            at = np.concatenate([[0], np.cumsum(counts)])
            yield pa.RecordBatch.from_arrays(
                [ids.slice(a, b - a).cast(pa.int64()), pa.array(_fingerprint(keys, counts, 40).view(np.int64)), binary_column([keys[x:y].tobytes() for x, y in zip(at[:-1], at[1:], strict=True)])],
                ["doc_id", "f1", "shingles"],
            )


def _buckets(batches):
    """Complete buckets of a partition sorted by bucket, as a table and their bounds."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([*held, batch]).combine_chunks()
        where = np.column_stack([table.column(c).to_numpy() for c in ("band", "key", "part")])
        cuts = np.flatnonzero((where[1:] != where[:-1]).any(axis=1)) + 1
        if len(cuts):
            yield table.slice(0, cuts[-1]), [0, *cuts.tolist()]
            held = table.slice(cuts[-1]).combine_chunks().to_batches()
        else:
            held = table.to_batches()
    if held:
        table = pa.Table.from_batches(held)
        yield table, [0, table.num_rows]


def _members(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids, signatures, components and set sizes."""
    sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), np.uint16).reshape(-1, REGISTERS)
    return table.column("id").to_numpy(), sig, table.column("component").to_numpy(), table.column("m").to_numpy()


def _candidates(block: pa.Table):
    """Each asker of a block with the members of other components that may be linked with
    it: sets of like size, like signatures, and no earlier band that both share. Two
    askers meet once."""
    ids, sig, comp, size = _members(block)
    band, ask, small = block.column("band")[0].as_py(), block.column("ask").to_numpy(), block.column("small").to_numpy()
    asked = np.flatnonzero(~ask)
    for i in np.flatnonzero(ask):
        t = asked[(comp[asked] != comp[i]) & (~small[asked] | (ids[asked] > ids[i]))]
        t = t[100 * np.minimum(size[t], size[i]) >= THRESHOLD * np.maximum(size[t], size[i])]
        same = sig[t] == sig[i]
        t = t[(same.mean(axis=1) >= LIKE) & (same.reshape(-1, BANDS, ROWS).all(axis=2).argmax(axis=1) == band)]
        if len(t):
            yield i, t


def _pairs(ids: np.ndarray, other: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(ids, other).astype(np.int64)), pa.array(np.maximum(ids, other).astype(np.int64))], ["a", "b"])


@lean
def _star_pairs(batches):
    """Pairs of each bucket's pivots with the members they resemble."""
    for table, bounds in _buckets(batches):
        (ids, sig, _, _), cuts = _members(table), np.array(bounds)
        sizes = np.diff(cuts)
        two = cuts[:-1][sizes == 2]
        if len(two):
            like = (sig[two] == sig[two + 1]).mean(axis=1) >= LIKE
            yield _pairs(ids[two[like]], ids[two[like] + 1])
        for a, n in zip(cuts[:-1][sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
            s, own = sig[a : a + n], ids[a : a + n]
            score = np.zeros(n, np.int64)
            for c in range(REGISTERS):
                _, inv, cnt = np.unique(s[:, c], return_inverse=True, return_counts=True)
                score += cnt[inv]
            rest = np.lexsort((own, -score))
            while len(rest) > 1:
                like = (s[rest[1:]] == s[rest[0]]).mean(axis=1) >= LIKE
                near = rest[1:][like]
                if len(near):
                    yield _pairs(np.full(len(near), own[rest[0]]), own[near])
                rest = rest[1:][~like]


@lean
def _hopeful(batches):
    """Members of each block that have a candidate, or are one."""
    for table, bounds in _buckets(batches):
        hit = np.zeros(table.num_rows, bool)
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            for i, t in _candidates(table.slice(a, b - a)):
                hit[a + i] = hit[a + t] = True
        yield from table.select(["band", "key", "id", "sig", "m", "component"]).filter(pa.array(hit)).to_batches()


@lean
def _block_links(batches):
    """Pairs of components linked by candidates of a block, checked on the full sets; none
    between components that links found in the block connect already."""
    for table, bounds in _buckets(batches):
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            block = table.slice(a, b - a)
            _, _, comp, size = _members(block)
            sets = [np.frombuffer(x, np.uint64) for x in block.column("shingles").to_pylist()]
            label = np.unique(comp, return_inverse=True)[1]
            x, y = [], []
            for i, t in _candidates(block):
                t = t[label[t] != label[i]]
                if not len(t):
                    continue
                flat, own = np.concatenate([sets[j] for j in t]), sets[i]
                held = own[np.minimum(np.searchsorted(own, flat), len(own) - 1)] == flat
                both = np.bincount(owner(size[t]), held, len(t))
                for j in t[100 * both >= THRESHOLD * (size[t] + size[i] - both)]:
                    if label[j] != label[i]:
                        label[label == label[j]] = label[i]
                        x.append(comp[i])
                        y.append(comp[j])
            if x:
                yield _pairs(np.array(x), np.array(y))


@lean
def _confirm(batches):
    for batch in batches:
        a, b = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        keep = np.zeros(len(a), bool)
        for i, (x, y) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            if THRESHOLD * max(len(x), len(y)) > 100 * min(len(x), len(y)):
                continue
            both = np.concatenate([x, y])
            both.sort()
            n = int((both[1:] == both[:-1]).sum())
            keep[i] = 100 * n >= THRESHOLD * (len(x) + len(y) - n)
        yield pa.RecordBatch.from_arrays([pa.array(a[keep]), pa.array(b[keep])], ["a", "b"])


def _blocks(rows: DataFrame) -> DataFrame:
    """``rows`` of buckets, dealt to blocks (``part``): a member outside its bucket's
    largest component asks in every block of all members, and each member is asked in
    every block of askers."""
    sizes = rows.groupBy("band", "key", "component").agg(F.count(F.lit(1)).alias("n"), F.sum("m").alias("m")).groupBy("band", "key")
    order = F.struct("n", "component")
    sizes = sizes.agg(F.max_by("component", order).alias("top"), F.sum("n").alias("n"), F.sum("m").alias("all"), F.max("n").alias("top_n"), F.max_by("m", order).alias("top_m"))
    count = lambda n, m: F.ceil(F.greatest(F.lit(1), n / BLOCK, m / BLOCK_SHINGLES))
    sizes = sizes.select("band", "key", "top", count(F.col("n"), F.col("all")).alias("k"), count(F.col("n") - F.col("top_n"), F.col("all") - F.col("top_m")).alias("q"))
    rows = rows.join(scratch(sizes, "sizes"), ["band", "key"]).withColumn("small", F.col("component") != F.col("top"))
    upto = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.col(c) - 1))
    asking = rows.where("small").withColumn("g", upto("k")).withColumn("s", F.pmod(F.xxhash64("id", F.lit(1)), "q")).withColumn("ask", F.lit(True))
    asked = rows.withColumn("g", F.pmod(F.xxhash64("id", F.lit(2)), "k")).withColumn("s", upto("q")).withColumn("ask", F.lit(False))
    return asking.unionByName(asked).withColumn("part", F.col("s") * F.col("k") + F.col("g"))


def _of_one_id(docs: DataFrame, sigs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Signatures of the text that stands for each id, and the ids of several texts with
    that text's n, f1, f2 (None if there is no such id)."""
    named = sigs.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("f1").alias("lo"), F.max("f1").alias("hi"), F.min(F.when(F.col("n_shingles") > 0, F.col("f1"))).alias("own"))
    several = scratch(named.where("lo <> hi").select("doc_id", "own"), "several")
    sigs = sigs.where("doc_id IS NOT NULL AND n_shingles > 0")
    if several.isEmpty():
        return sigs, None
    main = sigs.join(several, "doc_id", "left").where("own IS NULL OR f1 = own").drop("own")
    found = several.join(sigs, "doc_id").where("f1 = own").groupBy("doc_id").agg(*[F.min(c).alias(f"own_{c}") for c in ("n_shingles", "f1", "f2")])
    return main, scratch(found, "several")


def _full_sets(docs: DataFrame, active: DataFrame, several: DataFrame | None) -> DataFrame:
    """The shingle set of each active id."""
    known = docs.join(active, "doc_id", "left_semi")
    schema = "doc_id long, f1 long, shingles binary"
    one = known if several is None else known.join(several, "doc_id", "left_anti")
    sets = one.dropDuplicates(["doc_id"]).mapInArrow(_sets, schema).drop("f1")
    if several is None:
        return sets
    own = known.join(several, "doc_id", "left_semi").mapInArrow(_sets, schema).join(several, "doc_id").where("f1 = own_f1")
    return sets.union(own.dropDuplicates(["doc_id"]).select("doc_id", "shingles"))


def group(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sigs = scratch(docs.mapInArrow(_signatures, "doc_id long, n_shingles long, f1 long, f2 long, sig binary, bands array<long>"), "sigs")
    main, several = _of_one_id(docs, sigs)
    same = ["n_shingles", "f1", "f2"]
    sets = scratch(main.groupBy(*same).agg(F.min("doc_id").alias("rep")), "classes")
    reps = main.join(sets.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi")
    banded = reps.select("doc_id", F.posexplode("bands").alias("band", "key"))
    # stored, so that a crowded bucket is split in the join by adaptive execution
    shared = scratch(banded.groupBy("band", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "shared")
    members = scratch(banded.join(shared, ["band", "key"]).select("band", "key", "n", "doc_id"), "members")
    drop_scratch(shared)
    active = members.select("doc_id").distinct()
    shingles = scratch(_full_sets(docs, active, several), "sets")
    buckets = scratch(members.join(reps.select("doc_id", "sig", F.col("n_shingles").alias("m")), "doc_id").select("band", "key", "n", F.col("doc_id").alias("id"), "sig", "m"), "buckets")
    drop_scratch(members)

    def dealt(rows: DataFrame, *more: str) -> DataFrame:
        chosen = rows.select("band", "key", "part", "id", "sig", "m", "component", *more)
        return chosen.repartition("band", "key", "part").sortWithinPartitions("band", "key", "part", "id")

    part = F.pmod(F.xxhash64("id"), F.ceil(F.col("n") / BUCKET))
    pairs = dealt(buckets.withColumn("component", F.col("id")).withColumn("part", part)).mapInArrow(_star_pairs, "a long, b long").distinct()
    x, y = shingles.select(F.col("doc_id").alias("a"), F.col("shingles").alias("x")), shingles.select(F.col("doc_id").alias("b"), F.col("shingles").alias("y"))
    found = components(pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(_confirm, "a long, b long"))

    named = buckets.join(found.withColumnRenamed("component", "c"), "id", "left").withColumn("component", F.coalesce("c", "id"))
    split = named.groupBy("band", "key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi")
    mixed = scratch(named.join(split, ["band", "key"], "left_semi").select("band", "key", "id", "sig", "m", "component"), "mixed")
    drop_scratch(buckets)
    hopeful = scratch(dealt(_blocks(mixed), "ask", "small").mapInArrow(_hopeful, "band int, key long, id long, sig binary, m long, component long").distinct(), "hopeful")
    drop_scratch(mixed)
    met = dealt(_blocks(hopeful).join(shingles.withColumnRenamed("doc_id", "id"), "id"), "ask", "small", "shingles")
    again = components(met.mapInArrow(_block_links, "a long, b long"))
    drop_scratch(hopeful)
    drop_scratch(shingles)
    first = sets.join(found.withColumnRenamed("id", "rep"), "rep", "left").select(*same, F.coalesce("component", "rep").alias("first"))
    named = scratch(first.join(again.withColumnRenamed("id", "first"), "first", "left").select(*same, F.coalesce("component", "first").alias("component_id")), "named")
    rows = sigs.select("doc_id", *same)
    if several is None:
        keyed = rows.select("doc_id", F.col("n_shingles").alias("own_size"), *same)
    else:
        keyed = rows.join(several, "doc_id", "left").select("doc_id", F.col("n_shingles").alias("own_size"), *[F.coalesce(f"own_{c}", c).alias(c) for c in same])
    # a text without words has no class: its keys are spread by id
    keyed = keyed.withColumn("f1", F.when(F.col("n_shingles") > 0, F.col("f1")).otherwise(F.xxhash64("doc_id")))
    out = keyed.join(named, same, "left").withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")))
    return out.select("doc_id", F.col("own_size").alias("n_shingles"), "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def op2_near_dedup(spark, sf_dir: str) -> DataFrame:
    return group(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


#: The contract in DuckDB: pairs by shared shingles, then reachability. For small tables.
SQL = """
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
         ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM words),
flat AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM flat a JOIN flat b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id
  HAVING 100 * count(*) >= 75 * (any_value(a.n) + any_value(b.n) - count(*))),
edges AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
reach AS (SELECT doc_id, doc_id AS other FROM sets UNION SELECT r.doc_id, e.b FROM reach r JOIN edges e ON e.a = r.other)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, min(r.other) AS component_id, s.doc_id = min(r.other) AS kept
FROM sets s JOIN reach r USING (doc_id) GROUP BY s.doc_id, len(s.s)
"""
