"""Benchmark decontamination with a distributed positional inverted index.

:func:`build_index` cuts the training documents into segments (a bounded number of text
bytes each), lays the words of a segment on one axis of positions with a gap behind every
document, and stores for each term of the segment its sorted positions, gap-encoded: the
postings are never shuffled for storing.

:func:`search` keeps the benchmark in tables as well. Its distinct texts are cut into pieces of
at most ``piece_words`` words. Every window of a piece must occur around its rarest term, so
the rarest terms alone are joined to the postings: what comes out are the (segment, piece)
pairs worth a look. Only their lists are fetched (where they are too many to name in a broadcast, those of
the blocks' terms in segments with a candidate), brought together by segment and block of pieces, and intersected offset-adjusted, beginning with the rarest
term of that segment. The result is exact phrases and, with ``slop`` > 0, proximity matches:
alignments at which every word of the window occurs at most ``slop`` positions off its place.

Nothing of the benchmark passes the driver. A task holds one segment's lists for one block
of pieces (``block_words`` words), whatever the size of either side; items of equal text are searched once.

Defined results: null and word-less documents keep a row with no matches; null and
word-less items never match; an item of fewer words than the window is one window; very
long texts are indexed and searched whole; ties for the rarest term go to the first;
repeated documents are documents of their own; repeated items match under their id; empty
tables give empty results; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordmill.llm import words as W
from wordmill.llm.scratch import free_name, scratch_path, stored

GAP = 64  # free positions between documents; a window's alignment with slop cannot bridge it
DOC_STARTS = ""  # the "term" whose positions are the documents' first positions; no word is empty

INDEX = "kind string, seg long, ord int, doc_id long, n_words long, term string, n long, width int, gaps binary"
MATCHES = "seg long, ord int, piece long, item_start int, doc_start long, length int, exact boolean"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PIECE_WORDS = 4096        # words of an item that are searched at once
FEW_LISTS = 200_000       # lists up to which just those of the candidates are fetched, by a broadcast of their names
BLOCK_WORDS = 1 << 20     # words of the pieces that one task looks for in a segment


@dataclass
class Index:
    documents: DataFrame  # seg, ord, doc_id, n_words
    postings: DataFrame   # seg, term, n, width, gaps


def pack(positions: np.ndarray, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(order of the lists, their widths, their gaps) of the sorted lists that ``cut`` bounds.

    A list's first position and the gaps behind it get the narrowest width that holds them
    all; lists of one width come together.
    """
    gaps = np.diff(positions, prepend=0)
    gaps[cut[:-1]] = positions[cut[:-1]]
    top = np.maximum.reduceat(gaps, cut[:-1])
    width = np.where(top < 1 << 8, 1, np.where(top < 1 << 16, 2, np.where(top < 1 << 32, 4, 8)))
    size = np.diff(cut)
    wide = np.repeat(width, size)
    order, parts = [], []
    for w in (1, 2, 4, 8):
        lists = np.flatnonzero(width == w)
        if len(lists):
            ends = np.zeros(len(lists) + 1, np.int32)
            np.cumsum(size[lists] * w, out=ends[1:])
            order.append(lists)
            parts.append(pa.Array.from_buffers(pa.binary(), len(lists), [
                None, pa.py_buffer(ends), pa.py_buffer(gaps[wide == w].astype(f"<u{w}"))]))
    order = np.concatenate(order)
    return order, width[order], pa.concat_arrays(parts)


def unpack(width: int, gaps: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(gaps, f"<u{width}"), dtype=np.int64)


def _segment(seg: int, ids: pa.Array, texts: pa.Array) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("kind", pa.string()), ("seg", pa.int64()), ("ord", pa.int32()), ("doc_id", pa.int64()),
                        ("n_words", pa.int64()), ("term", pa.string()), ("n", pa.int64()), ("width", pa.int32()),
                        ("gaps", pa.binary())])
    found, counts = W.word_runs(texts)
    n = len(counts)
    base = np.zeros(n, np.int64)
    np.cumsum(counts[:-1] + GAP, out=base[1:])
    yield pa.RecordBatch.from_arrays(
        [pa.array(["documents"] * n), pa.array(np.full(n, seg)), pa.array(np.arange(n, dtype=np.int32)),
         ids, pa.array(counts), *(pa.nulls(n, f.type) for f in list(schema)[5:])], schema=schema)
    first = np.zeros(n, np.int64)
    np.cumsum(counts[:-1], out=first[1:])
    terms, codes = W.encode(found)
    where = np.arange(len(found), dtype=np.int64) + np.repeat(base - first, counts)
    order = np.argsort(codes, kind="stable")
    sizes = np.concatenate([[n], np.bincount(codes, minlength=len(terms))])
    lists, width, gaps = pack(np.concatenate([base, where[order]]), np.concatenate([[0], np.cumsum(sizes)]))
    del found, codes, where, order  # not held while Spark takes what follows
    rows = len(lists)
    yield pa.RecordBatch.from_arrays(
        [pa.array(["postings"]).take(pa.array(np.zeros(rows, np.int32))), pa.array(np.full(rows, seg)),
         *(pa.nulls(rows, f.type) for f in list(schema)[2:5]),
         pa.concat_arrays([pa.array([DOC_STARTS]), terms.cast(pa.string())]).take(pa.array(lists)),
         pa.array(sizes[lists].astype(np.int64)), pa.array(width.astype(np.int32)), gaps], schema=schema)


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                segment_bytes: int = 8 << 20) -> Index:
    """Tokenise once and store the positional postings, one segment after the other."""

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seg = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in W.byte_slices(batch, "text", segment_bytes):
                yield from _segment(seg, part.column(0), part.column(1))
                seg += 1

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.col(f"`{text_col}`").alias("text")).mapInArrow(segments, INDEX)
    path = scratch_path(docs.sparkSession, "postings")
    rows.write.partitionBy("kind").parquet(path)
    index = docs.sparkSession.read.schema(INDEX).parquet(path)
    return Index(index.where("kind = 'documents'").select("seg", "ord", "doc_id", "n_words"),
                 index.where("kind = 'postings'").select("seg", "term", "n", "width", "gaps"))


def _present(positions: np.ndarray, at: np.ndarray, slop: int) -> np.ndarray:
    """For each sorted or unsorted ``at``: does the list hold a position within ``slop``?"""
    k = np.searchsorted(positions, at - slop)
    return positions[np.minimum(k, len(positions) - 1)] <= at + slop if slop else \
        positions[np.minimum(k, len(positions) - 1)] == at


def align(lists: list[np.ndarray | None], window: int, slop: int) -> tuple[np.ndarray, np.ndarray]:
    """(window starts in the item, positions of the item's first word) of all matches.

    ``lists[p]`` holds the sorted positions of the item's word ``p`` (None: nowhere).
    Windows that share their rarest word are intersected together: its list, moved back
    by its offset, gives the alignments, and the other words strike out windows, the
    rarest first, until no window of an alignment is left.
    """
    total = len(lists)
    window = min(window, total)
    sizes = np.array([0 if x is None else len(x) for x in lists])
    n_windows = total - window + 1
    view = np.lib.stride_tricks.sliding_window_view(sizes, window)
    anchor = view.argmin(axis=1) + np.arange(n_windows)
    possible = view.min(axis=1) > 0
    starts, bases = [], []
    first = 0
    while first < n_windows:
        last = first
        while last + 1 < n_windows and anchor[last + 1] == anchor[first] and possible[last + 1] == possible[first]:
            last += 1
        if possible[first]:
            base = lists[anchor[first]] - anchor[first]
            alive = np.ones((len(base), last - first + 1), bool)
            span = np.arange(first, last + window)
            for p in span[np.argsort(sizes[span], kind="stable")]:
                if p == anchor[first]:
                    continue
                lost = ~_present(lists[p], base + p, slop)
                alive[lost, max(0, p - window + 1 - first):p - first + 1] = False
                keep = alive.any(axis=1)
                base, alive = base[keep], alive[keep]
                if not len(base):
                    break
            row, col = np.nonzero(alive)
            starts.append(col + first)
            bases.append(base[row])
        first = last + 1
    if not starts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(starts), np.concatenate(bases)


def _runs(starts: np.ndarray, bases: np.ndarray, window: int) -> list[tuple[int, int, int]]:
    """Overlapping or touching windows of one alignment as (item start, base, length)."""
    order = np.lexsort((starts, bases))
    starts, bases = starts[order], bases[order]
    new = np.concatenate([[True], (bases[1:] != bases[:-1]) | (starts[1:] > starts[:-1] + window)])
    at = np.flatnonzero(new)
    end = np.append(at[1:], len(starts)) - 1
    return list(zip(starts[at].tolist(), bases[at].tolist(), (starts[end] - starts[at] + window).tolist()))


def _search_segment(window: int, slop: int):
    def run(postings: pa.Table, pieces: pa.Table) -> pa.Table:
        raw = dict(zip(postings["term"].to_pylist(), zip(postings["width"].to_pylist(), postings["gaps"].to_pylist())))
        read: dict[str, np.ndarray | None] = {}

        def positions(term: str) -> np.ndarray | None:
            if term not in read:
                read[term] = unpack(*raw[term]) if term in raw else None
            return read[term]

        docs = positions(DOC_STARTS)
        out = []
        for seg, piece, first, words in zip(*(pieces[c].to_pylist() for c in ("seg", "piece", "first", "words"))):
            lists = [positions(w) for w in words]
            size = min(window, len(words))
            for off in sorted({0, slop}):
                starts, bases = align(lists, window, off)
                if len(starts):
                    for s, b, n in _runs(starts, bases, size):
                        k = int(np.searchsorted(docs, b + s, "right")) - 1
                        out.append((seg, k, piece, first + s, b + s - int(docs[k]), n, off == 0))
        types = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.bool_()]
        names = ["seg", "ord", "piece", "item_start", "doc_start", "length", "exact"]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 7, types)],
                                    names=names)
    return run


def benchmark_pieces(items: DataFrame, id_col: str, text_col: str, window: int, piece_words: int
                     ) -> tuple[DataFrame, DataFrame]:
    """(item_id and text key of every item, (piece, key, first, words) of the distinct texts).

    Pieces overlap by a window less one word, so every window lies in one piece.
    """
    words = F.regexp_extract_all(F.translate(F.col(f"`{text_col}`"), UPPER, LOWER), F.lit(WORD), F.lit(0))
    listed = items.select(F.col(f"`{id_col}`").cast("long").alias("item_id"), F.sha2(F.col(f"`{text_col}`"), 256).alias("key"),
                          words.alias("words")).where("size(words) > 0")
    texts = listed.groupBy("key").agg(F.any_value("words").alias("words"))    # equal keys, equal words
    last = F.greatest(F.size("words") - window, F.lit(0))
    cut = texts.select("key", "words", F.explode(F.sequence(F.lit(0), last, F.lit(piece_words))).alias("first"))
    pieces = cut.select("key", "first", F.slice("words", F.col("first") + 1, piece_words + window - 1).alias("words"))
    return (listed.select("item_id", "key"),
            stored(pieces.withColumn("piece", F.monotonically_increasing_id()), "pieces"))


def _anchors(pieces: DataFrame, postings: DataFrame, window: int) -> DataFrame:
    """(piece, term): the rarest term of every window whose terms all occur, each once a piece."""
    listed = pieces.select("piece", F.posexplode("words").alias("at", "term"))
    terms = stored(listed.select("term").distinct(), "benchmark-terms")
    often = (postings.select("term", "n").join(terms, "term", "left_semi")
             .groupBy("term").agg(F.sum("n").alias("n")))
    place = F.struct(F.coalesce("n", F.lit(0)).alias("n"), "at", "term")
    lists = (listed.join(often, "term", "left").groupBy("piece")
             .agg(F.sort_array(F.collect_list(F.struct("at", place.alias("place")))).alias("places")))
    spots = F.transform("places", lambda x: x["place"])
    starts = F.sequence(F.lit(0), F.greatest(F.size("places") - window, F.lit(0)))
    rarest = F.transform(starts, lambda k: F.array_min(F.slice(spots, k + 1, F.lit(window))))
    return (lists.select("piece", F.explode(F.array_distinct(rarest)).alias("r")).where("r.n > 0")
            .select("piece", "r.term").distinct())


def search(index: Index, items: DataFrame, id_col: str = "item_id", text_col: str = "text",
           window: int = 10, slop: int = 0, piece_words: int = PIECE_WORDS, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Matches of all items: the runs of matched words, as seg, ord, item_id, item_start, doc_start, length, exact.

    ``exact`` rows are phrase matches; with ``slop`` the proximity matches (which include
    the exact places) follow as rows of their own with ``exact`` false. A run that goes on
    over a piece's end comes in parts.
    """
    if window < 1 or not 0 <= 2 * slop < GAP:
        raise ValueError(f"window must be positive and slop below {GAP // 2}")
    ids, pieces = benchmark_pieces(items, id_col, text_col, window, piece_words)
    total = pieces.agg(F.sum(F.size("words").cast("long"))).first()[0] or 0
    blocks = max(1, -(-total // block_words))
    block = F.pmod(F.xxhash64("piece"), F.lit(blocks)).alias("block")
    # stored tables have a known size: below Spark's threshold they are broadcast, and the postings stay where
    # they are until their lists go to the segments, once
    anchors = stored(_anchors(pieces, index.postings, window), "anchors")
    worth = stored(index.postings.select("seg", "term").join(anchors, "term").select("seg", "piece", block).distinct(),
                   "candidates")
    terms = pieces.select("piece", block, F.explode(F.array_distinct("words")).alias("term"))
    starts = worth.select("block").distinct().withColumn("term", F.lit(DOC_STARTS))
    known = stored(terms.select("block", "term").distinct().unionByName(starts), "known-terms")
    lists = (index.postings.join(known, "term").join(worth.select("seg", "block").distinct(), ["seg", "block"], "left_semi")
             .select("seg", "block", "term", "width", "gaps"))
    wanted = (worth.join(terms.drop("block"), "piece").select("seg", "block", "term")
              .unionByName(worth.select("seg", "block", F.lit(DOC_STARTS).alias("term"))).distinct())
    few = wanted.limit(FEW_LISTS + 1).count()
    if few <= FEW_LISTS:
        lists = lists.join(F.broadcast(wanted), ["seg", "block", "term"], "left_semi")
    asked = worth.join(pieces, "piece").select(     # under names of their own: both sides come from ``worth``
        F.col("seg").alias("seg"), F.col("block").alias("block"), "piece", "first", "words")
    found = (lists.groupBy("seg", "block").cogroup(asked.groupBy("seg", "block"))
             .applyInArrow(_search_segment(window, slop), MATCHES))
    return (found.join(pieces.select("piece", "key"), "piece").join(ids, "key")
            .select("seg", "ord", "item_id", "item_start", "doc_start", "length", "exact"))


def contamination(docs: DataFrame, items: DataFrame, window: int = 10, slop: int = 0, id_col: str = "doc_id",
                  text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", **how) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, item_ids (sorted as strings), n_near_items."""
    index = build_index(docs, id_col, text_col)
    found = search(index, items, item_id_col, item_text_col, window, slop, **how)
    places = F.sequence(F.col("doc_start"), F.col("doc_start") + F.col("length") - 1)
    hits = found.groupBy("seg", "ord").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list(F.when(F.col("exact"), places))))).cast("long")
        .alias("n_hit"),
        F.sort_array(F.collect_set(F.when(F.col("exact"), F.col("item_id").cast("string")))).alias("item_ids"),
        F.count_distinct(F.when(~F.col("exact"), F.col("item_id"))).alias("n_near_items"))
    return index.documents.join(hits, ["seg", "ord"], "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        F.coalesce("n_near_items", F.lit(0)).cast("long").alias("n_near_items"))


def drop_contaminated(docs: DataFrame, items: DataFrame, window: int = 10, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """The documents that hold no window of an item, all columns unchanged.

    Only the ids of documents with matches are joined. Rows that repeat an id go together.
    """
    index = build_index(docs, id_col, text_col)
    found = search(index, items, window=window).select("seg", "ord").distinct()
    name = free_name(docs, "_hit")
    hit = (index.documents.join(found, ["seg", "ord"], "left_semi").select(F.col("doc_id").alias(name)).distinct())
    return docs.join(hit, F.col(f"`{id_col}`").eqNullSafe(F.col(name)), "left_anti")
