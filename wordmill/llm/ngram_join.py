"""N-gram Jaccard self-join by MinHash banding, with verification on full n-gram sets.

1. Each document's words (lower-cased runs of letters, digits and non-ASCII characters)
   give its set of five-word shingles; a text of one to four words has all its words as
   its only shingle. Documents of equal sets are one *class*, named by the set's digests;
   its smallest id stands for it in the graph.
2. MinHash signatures of the classes are cut into bands; rows and bands follow from the
   threshold and the target recall (:func:`choose_bands`). Classes are shuffled on the
   band hashes; buckets of one class, and buckets that hold the same classes as a bucket
   of an earlier band, have nothing to add and go.
3. The remaining buckets get the full shingle sets, and every pair of classes is verified
   in exactly one place: the bucket of the first band that both share. A bucket of more
   than ``BLOCK`` classes is dealt out as pairs of blocks, so no task holds more than two
   blocks. Tasks don't return pairs but, for each class, the number of linked documents
   and a spanning edge to the smallest class it is linked with, so results stay linear in
   the input whatever the size of a group.
4. Connected components of the edges are the groups of near-duplicates.

Defined results: documents without words (null, empty, punctuation) link to nothing, not
even to each other, and are groups of their own; rows that repeat an id are one node of
the graph, which has the edges of all their texts, and are returned each, with the links
and copies of their own text; a null id acts as the smallest id; very long texts give all
their shingles, compared as 64-bit hashes; a pair exactly at the threshold is linked; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordmill.llm import words as W
from wordmill.llm.components import connected_components
from wordmill.llm.pretokens import bounds
from wordmill.llm.scratch import free_name, one_of_repeats, stored

BLOCK = 512
SLICE_BYTES = 8 << 20
NULL_ID = -(1 << 63)

SIGNED = "id long, n_shingles int, key1 long, key2 long, bands array<long>"


def choose_bands(threshold: float, recall: float, most: int = 128) -> tuple[int, int]:
    """(rows, bands): the most selective banding of at most ``most`` hashes that finds a pair at
    the threshold with probability ``recall``."""
    for rows in range(most, 0, -1):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold ** rows))
        if rows * bands <= most:
            return rows, bands
    raise ValueError("the recall needs more hashes")


def mix(x: np.ndarray) -> np.ndarray:
    """The SplitMix64 finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of the distinct shingles of each text, sorted; bounds of the texts)."""
    found, counts = W.word_runs(pc.utf8_lower(pc.fill_null(texts, "")))
    distinct, codes = W.encode(found)
    known = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in distinct.to_pylist()), np.uint64, len(distinct))
    hashed = known[codes] if len(codes) else np.zeros(0, np.uint64)
    doc = bounds(counts)
    size = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))  # shingles of each text
    owner = np.repeat(np.arange(len(counts)), size)
    begin = np.arange(len(owner)) - np.repeat(bounds(size)[:-1], size) + doc[owner]
    end = doc[1:][owner]
    value = np.zeros(len(owner), np.uint64)
    for k in range(n):
        at = begin + k
        word = np.where(at < end, hashed[np.minimum(at, max(0, len(hashed) - 1))] if len(hashed) else np.uint64(0),
                        np.uint64(0x9E3779B97F4A7C15))  # what stands for words a short text lacks
        value = mix(value * np.uint64(0xD6E8FEB86659FD93) + word)
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    return value[new], bounds(np.bincount(owner[new], minlength=len(counts)))


def set_keys(values: np.ndarray, cut: np.ndarray, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit digests of the sets of the (non-empty) texts ``some``."""
    keys = []
    for salt in (0x243F6A8885A308D3, 0x13198A2E03707344):
        key = np.zeros(len(cut) - 1, np.uint64)
        if len(some):
            key[some] = mix(np.add.reduceat(mix(values ^ np.uint64(salt)), cut[some]) + np.diff(cut)[some].astype(np.uint64))
        keys.append(key.view(np.int64))
    return tuple(keys)


def signatures(docs: DataFrame, n: int, rows: int, bands: int) -> DataFrame:
    """Rows of :data:`SIGNED` for the columns ``id``, ``text``."""
    rng = np.random.default_rng(20240501)
    factors = rng.integers(0, 1 << 63, rows * bands, np.uint64) * np.uint64(2) + np.uint64(1)
    shifts = rng.integers(0, 1 << 63, rows * bands, np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.byte_slices(batch, "text", SLICE_BYTES):
                values, cut = shingle_sets(part.column(1), n)
                size = np.diff(cut)
                some = np.flatnonzero(size > 0)
                key1, key2 = set_keys(values, cut, some)
                band = np.zeros((len(some), bands), np.uint64)
                if len(some):
                    for b in range(bands):
                        key = np.full(len(some), b + 1, np.uint64)
                        for k in range(b * rows, (b + 1) * rows):
                            least = np.minimum.reduceat(values * factors[k] + shifts[k], cut[some])
                            key = mix(key * np.uint64(0xD6E8FEB86659FD93) + least)
                        band[:, b] = key
                offsets = bounds(np.where(size > 0, bands, 0)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(size.astype(np.int32)), pa.array(key1), pa.array(key2),
                     pa.ListArray.from_arrays(pa.array(offsets), pa.array(band.reshape(-1).view(np.int64)))],
                    names=["id", "n_shingles", "key1", "key2", "bands"])

    return docs.mapInArrow(run, SIGNED)


def link_sets(sets: list[np.ndarray], threshold: float) -> np.ndarray:
    """The symmetric matrix of Jaccard >= threshold, without the diagonal."""
    n = len(sets)
    size = np.array([len(s) for s in sets], np.int64)
    owner = np.repeat(np.arange(n), size)
    _, code, seen = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = seen[code] > 1
    owner, code = owner[shared], code[shared]
    _, code = np.unique(code, return_inverse=True)
    common = np.zeros((n, n), np.float32)
    order = np.argsort(code, kind="stable")
    owner, code = owner[order], code[order]
    width = 4096
    for first in range(0, int(code[-1]) + 1 if len(code) else 0, width):
        lo, hi = np.searchsorted(code, [first, first + width])
        has = np.zeros((n, int(code[hi - 1]) - first + 1), np.float32)
        has[owner[lo:hi], code[lo:hi] - first] = 1
        common += has @ has.T
    linked = common >= threshold * (size[:, None] + size[None, :] - common) - 1e-6
    linked &= common > 0
    np.fill_diagonal(linked, False)
    return linked


def verify(ids: np.ndarray, copies: np.ndarray, bands: np.ndarray, sets: list[np.ndarray], band: int,
           half: np.ndarray, same_block: bool, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(linked documents of each class, smallest class of its links) for one bucket or pair of blocks."""
    linked = link_sets(sets, threshold)
    for b in range(band):  # such a pair is verified in the earlier band
        linked &= bands[:, b][:, None] != bands[:, b][None, :]
    if not same_block:
        linked &= half[:, None] != half[None, :]
    links = linked @ copies
    label = ids.copy()
    while True:
        near = np.where(linked, label[None, :], np.iinfo(np.int64).max).min(axis=1)
        now = np.minimum(label, near)
        if (now == label).all():
            return links, label
        label = now


def _verified(threshold: float):
    schema = pa.schema([(c, pa.int64()) for c in ("key1", "key2", "id", "links", "near")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing = object()
        task, rows = nothing, []

        def done(rows: list[tuple]) -> pa.RecordBatch:
            rows = list({r[6]: r for r in rows}.values())  # a repeated row's class came twice
            ids = np.array([r[0] for r in rows], np.int64)
            links, near = verify(ids, np.array([r[1] for r in rows], np.int64), np.array([r[2] for r in rows]),
                                 [r[3] for r in rows], rows[0][4], np.array([r[5] for r in rows]),
                                 task[2] == task[3], threshold)
            hit = links > 0
            keys = np.array([r[6] for r in rows], np.int64)[hit]
            return pa.RecordBatch.from_arrays([pa.array(keys[:, 0]), pa.array(keys[:, 1]), pa.array(ids[hit]),
                                               pa.array(links[hit]), pa.array(near[hit])], schema=schema)

        for batch in batches:
            col = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
            keys = list(zip(*(col[c].to_pylist() for c in ("band", "key", "p", "q"))))
            names = zip(col["key1"].to_pylist(), col["key2"].to_pylist())
            for i, (ident, copies, block, name) in enumerate(zip(
                    *(col[c].to_pylist() for c in ("id", "copies", "block")), names)):
                if keys[i] != task:
                    if len(rows) > 1:
                        yield done(rows)
                    task, rows = keys[i], []
                rows.append((ident, copies, col["bands"][i].values.to_numpy(),
                             np.frombuffer(col["shingles"][i].as_buffer(), np.uint64), keys[i][0], block, name))
        if len(rows) > 1:
            yield done(rows)

    return run


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5,
                    threshold: float = 0.8, recall: float = 0.9995) -> DataFrame:
    """One row per document: doc_id, class_id (smallest id of its group), n_links, n_copies, kept."""
    rows, bands = choose_bands(threshold, recall)
    texts = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NULL_ID)).alias("id"),
                        F.col(f"`{text_col}`").alias("text"))
    signed = stored(signatures(texts, n, rows, bands), "signatures")
    some = signed.where("n_shingles > 0")
    classes = stored(some.groupBy("key1", "key2").agg(F.min("id").alias("class"), F.count(F.lit(1)).alias("copies"),
                                                      F.any_value("bands").alias("bands")), "classes")
    dealt = classes.select("key1", "key2", F.posexplode("bands").alias("band", "key"))
    # buckets of several classes; of buckets with the same classes the one of the first band
    buckets = (dealt.groupBy("band", "key")
               .agg(F.count(F.lit(1)).alias("size"), F.sum(F.xxhash64("key1", "key2").cast("decimal(20,0)")).alias("s1"),
                    F.bit_xor(F.xxhash64(F.lit(1), "key1", "key2")).alias("s2"))
               .where("size > 1").groupBy("size", "s1", "s2").agg(F.min(F.struct("band", "key")).alias("b"))
               .select("size", "b.band", "b.key"))
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    members = stored(dealt.join(buckets, ["band", "key"]).withColumn("blocks", blocks)
                     .withColumn("block", F.pmod(F.xxhash64(F.lit(2), "key1", "key2"), F.col("blocks")).cast("int")), "members")
    wanted = members.select("key1", "key2").distinct().join(classes, ["key1", "key2"])

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.byte_slices(batch, "text", SLICE_BYTES):
                values, cut = shingle_sets(part.column(0), n)
                key1, key2 = set_keys(values, cut, np.flatnonzero(np.diff(cut) > 0))
                same = pa.array((key1 == part.column(1).to_numpy()) & (key2 == part.column(2).to_numpy()))
                stored_sets = pa.Array.from_buffers(
                    pa.binary(), len(cut) - 1, [None, pa.py_buffer((cut * 8).astype(np.int32)),
                                                pa.py_buffer(np.ascontiguousarray(values))])
                yield pa.RecordBatch.from_arrays([*part.columns[1:], stored_sets],
                                                 names=[*part.schema.names[1:], "shingles"]).filter(same)

    full = (texts.join(wanted.withColumnRenamed("class", "id"), "id")
            .select("text", "key1", "key2", "id", "copies", "bands")
            .mapInArrow(sets, "key1 long, key2 long, id long, copies long, bands array<long>, shingles binary"))
    other = F.sequence(F.lit(0), F.col("blocks") - 1)
    tasks = (members.withColumn("other", F.explode(other))
             .select("band", "key", "block", F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q"),
                     "key1", "key2"))
    found = stored(tasks.join(full, ["key1", "key2"]).repartition("band", "key", "p", "q")
                   .sortWithinPartitions("band", "key", "p", "q", "id")
                   .mapInArrow(_verified(threshold), "key1 long, key2 long, id long, links long, near long"), "links")
    text_key = F.struct("key1", "key2", "n_shingles")
    repeated = signed.groupBy("id").agg(F.min(text_key).alias("lo"), F.max(text_key).alias("hi")).where("lo != hi")
    texts_of = signed.join(repeated.select("id"), "id").select("id", "key1", "key2").distinct()
    same_id = texts_of.join(classes, ["key1", "key2"])  # ids of several texts are a node with all their classes
    groups = connected_components(
        found.select(F.col("id").alias("a"), F.col("near").alias("b"))
        .unionByName(same_id.select(F.col("id").alias("a"), F.col("class").alias("b"))))
    links = found.groupBy("key1", "key2").agg(F.sum("links").alias("links"))
    named = (classes.select("key1", "key2", F.col("class").alias("node"), "copies").join(groups, "node", "left")
             .join(links, ["key1", "key2"], "left")
             .select("key1", "key2", "copies", F.coalesce("component", "node").alias("class_id"),
                     (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    null_id = lambda c: F.when(F.col(c) != NULL_ID, F.col(c))
    wordless = same_id.select("id").distinct().join(groups.withColumnRenamed("node", "id"), "id")
    out = (signed.join(named, ["key1", "key2"], "left").join(wordless, "id", "left")
           .withColumn("class_id", F.coalesce("class_id", "component", "id")))
    return out.select(null_id("id").alias("doc_id"), null_id("class_id").alias("class_id"),
                      F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("copies", F.lit(1)).alias("n_copies"),
                      (F.col("id") == F.col("class_id")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The documents of the smallest id of each group, all columns unchanged. Rows that repeat both id and text
    stay once; different texts under one id, or without one, are different documents and stay."""
    keep, rows = free_name(docs, "_keep"), free_name(docs, "_rows")
    kept = (near_duplicates(docs, id_col, text_col, **how).where("kept")
            .groupBy(F.col("doc_id").alias(keep)).agg(F.count(F.lit(1)).alias(rows)))
    found = docs.join(kept, F.col(f"`{id_col}`").eqNullSafe(F.col(keep)))
    once, more = found.where(F.col(rows) == 1), found.where(F.col(rows) > 1)
    return once.drop(keep, rows).unionByName(one_of_repeats(
        more.drop(keep, rows), id_col, text_col, F.sha2(F.col(f"`{text_col}`"), 256)))
