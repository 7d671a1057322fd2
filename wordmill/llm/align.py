"""Cross-tokenizer alignment by pointer jumping.

Two tokenizers A and B cut the same bytes. Every token points to the farthest-right token
that overlaps it (itself if none reaches farther); the pointers of a batch are doubled as
one vector, ``next = next[next]``, until they stand still. Each token then points to the
terminal token of its component, the one that ends where A and B both end, and equal
terminals label the groups. Doubling takes log2 of the longest chain steps, whatever its length.

The corpus side counts, for every pair of ids linked in some group, the documents that hold
it. Documents carry their distinct pairs with the number of links, so neither a long
document nor a frequent pair is spelled out. The pairs of many documents (at most ``FREQUENT`` of
them) are sent to the tasks; the rest, each in few documents, is joined by pair.

Defined results: null and empty texts have no tokens, nor has a text whose joined token
bytes of either side differ from a space and the text (for example one that holds U+2581);
very long texts are aligned whole; rows that repeat count as documents of their own; pairs that tie
for an A id's highest count are all best; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordmill.llm import words as W
from wordmill.llm.pretokens import bounds
from wordmill.llm.scratch import stored

SLICE_BYTES = 1 << 20    # text bytes that are aligned at once
PAIR_CHUNK = 1 << 21     # pairs that are spelled out at once
FREQUENT = 1 << 18       # pairs sent to every task


def byte_letters() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies: character -> byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def _flat(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """(all ids, bounds of the lists in them)."""
    cut = bounds(np.array([len(x) for x in ids], np.int64))
    return np.fromiter(chain.from_iterable(ids), np.int32, int(cut[-1])), cut


class ByteLevel:
    """Side A: a byte-level vocabulary file of the public ``tokenizers`` library.

    Where its merges stand in the order of the ids they make, the ids are ranks and the public ``tiktoken``
    library encodes the same faster. It cannot cut long runs of white space; such a text is cut
    by the pattern here and encoded by pre-tokens. Other files are encoded by their own library.
    """

    def __init__(self, path: str, pattern: str):
        import tiktoken
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        letters, vocabulary = byte_letters(), model["vocab"]
        plain = {bytes(letters[c] for c in t): i for t, i in vocabulary.items() if all(c in letters for c in t)}
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        made = [vocabulary[a + b] for a, b in merges]
        specials = set(vocabulary.values()) - {*made, *(plain.get(bytes([b]), -1) for b in range(256))}
        ranks = {t: i for t, i in plain.items() if i not in specials}
        self.find, self.ranked, self.tokenizer = regex.compile(pattern).findall, None, None
        if all(x < y for x, y in zip(made, made[1:])) and len(ranks) == len(vocabulary) - len(specials):
            self.ranked = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        else:
            from tokenizers import Tokenizer
            self.tokenizer = Tokenizer.from_file(path)
            self.tokenizer.encode_special_tokens = True
        self.bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in plain.items():
            self.bytes[i] = token

    def _ids(self, text: str) -> list[int]:
        try:
            return self.ranked.encode_ordinary(text)
        except ValueError:      # its cutting ran out of stack
            return [i for word in self.find(text) for i in self.ranked._encode_single_piece(word)]

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, bounds of the texts in them)."""
        if self.ranked is not None:
            return _flat([self._ids(t) for t in texts])
        return _flat([e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)])


class Pieces:
    """Side B: a model of the public ``sentencepiece`` library, which adds the first space itself."""

    def __init__(self, path: str):
        import sentencepiece
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            self.bytes.append(bytes([int(piece[3:5], 16)]) if self.model.is_byte(i)
                              else b"" if self.model.is_control(i) else piece.replace("\u2581", " ").encode())

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return _flat(self.model.encode(texts, num_threads=1))


def terminals(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The terminal token (an index into B) of every token of A and of B; both end at the same byte.

    Tokens of a side lie one after the other; nodes are A's tokens, then B's.
    """
    n = len(ends_a)
    # the token of the other side that holds my last byte is the farthest one that overlaps me
    over_a = np.searchsorted(ends_b, ends_a - 1, "right")
    over_b = np.searchsorted(ends_a, ends_b - 1, "right")
    after = np.empty(n + len(ends_b), np.int64)
    after[:n] = n + over_a
    after[n:] = np.where(ends_a[over_b] > ends_b, over_b, n + np.arange(len(ends_b)))
    while True:
        further = after[after]
        if np.array_equal(further, after):
            return after[:n] - n, after[n:] - n
        after = further


def _pairs(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray, doc: np.ndarray, width: int,
           chunk: int) -> tuple[np.ndarray, np.ndarray]:
    """(key, links): the distinct pairs of each document, as document * width**2 + a * width + b, in order.

    ``size_*`` and ``doc`` are per group. Groups are spelled out in chunks of ``chunk`` pairs;
    of a larger group the distinct ids of A are crossed with the distinct ids of B, a chunk at a time.
    """
    found: list[tuple[np.ndarray, np.ndarray]] = []
    start_a, start_b, many = bounds(size_a), bounds(size_b), size_a * size_b

    def add(keys: np.ndarray, links: np.ndarray | None) -> None:
        if links is None:
            keys = np.sort(keys)
        else:
            order = np.argsort(keys)
            keys, links = keys[order], links[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        found.append((keys[first], np.diff(np.append(first, len(keys))) if links is None else np.add.reduceat(links, first)))

    normal = np.flatnonzero(many <= chunk)
    total = np.cumsum(many[normal])
    at = 0
    while at < len(normal):
        before = total[at - 1] if at else 0
        upto = max(at + 1, int(np.searchsorted(total, before + chunk, "right")))
        g = normal[at:upto]
        k = many[g]
        inside = np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)
        wide = np.repeat(size_b[g], k)
        x = a[np.repeat(start_a[g], k) + inside // wide]
        y = b[np.repeat(start_b[g], k) + inside % wide]
        add(np.repeat(doc[g] * (width * width), k) + x * np.int64(width) + y, None)
        at = upto
    for g in np.flatnonzero(many > chunk):
        x, n_x = np.unique(a[start_a[g]:start_a[g + 1]], return_counts=True)
        y, n_y = np.unique(b[start_b[g]:start_b[g + 1]], return_counts=True)
        rows = max(1, chunk // len(y))
        for k in range(0, len(x), rows):
            pairs = (x[k:k + rows, None] * np.int64(width) + y[None, :]).ravel()
            add(doc[g] * (width * width) + pairs, np.outer(n_x[k:k + rows], n_y).ravel())
    if len(found) > 1:
        parts = [np.concatenate(x) for x in zip(*found)]
        found.clear()
        add(*parts)
    return found[0] if found else (np.zeros(0, np.int64), np.zeros(0, np.int64))


class Aligner:
    def __init__(self, path_a: str, pattern: str, path_b: str, chunk: int = PAIR_CHUNK):
        self.a, self.b, self.chunk = ByteLevel(path_a, pattern), Pieces(path_b), chunk
        self.size_a = np.array([len(x) for x in self.a.bytes], np.int64)
        self.size_b = np.array([len(x) for x in self.b.bytes], np.int64)
        top = max(len(self.size_a), len(self.size_b))
        self.width = top       # a pair of ids and a row of a slice fit into 63 bits
        # an id as text with what follows it: the next id, the end of A, the end of a group, nothing
        self.text = np.array([[f"{i}{end}" for i in range(top)] for end in (",", "|", ";", "")], object)

    def __call__(self, texts: list[str]) -> dict[str, list | np.ndarray]:
        """Of every text (none null) n_a, n_b, n_groups, n_links, the groups' text, and its distinct pairs with links."""
        ids_a, at_a = self.a([f" {t}" if t else "" for t in texts])
        ids_b, at_b = self.b(texts)
        good = np.array([t != "" for t in texts], bool)
        for table, ids, at in ((self.a.bytes, ids_a.tolist(), at_a.tolist()), (self.b.bytes, ids_b.tolist(), at_b.tolist())):
            for k, t in enumerate(texts):
                good[k] &= not t or b"".join(map(table.__getitem__, ids[at[k]:at[k + 1]])) == b" " + t.encode()
        ids_a, n_a = ids_a[np.repeat(good, np.diff(at_a))], np.where(good, np.diff(at_a), 0)
        ids_b, n_b = ids_b[np.repeat(good, np.diff(at_b))], np.where(good, np.diff(at_b), 0)
        last_a, last_b = terminals(np.cumsum(self.size_a[ids_a]), np.cumsum(self.size_b[ids_b]))
        is_end = last_b == np.arange(len(last_b))      # one terminal a group, in order
        ends, label = np.flatnonzero(is_end), np.cumsum(is_end) - 1
        group_a, group_b = label[last_a], label[last_b]
        size_a, size_b = np.bincount(group_a, minlength=len(ends)), np.bincount(group_b, minlength=len(ends))
        doc = np.searchsorted(bounds(n_b), ends, "right") - 1
        keys, links = _pairs(ids_a, ids_b, size_a, size_b, doc, self.width, self.chunk)
        cut = np.searchsorted(keys, np.arange(len(texts) + 1) * self.width ** 2)
        x, y = np.divmod(keys % self.width ** 2, self.width)
        # A's tokens of a group stand before B's: a token moves by the other side's tokens before it
        end_a, end_b = np.cumsum(size_a), np.cumsum(size_b)
        mark_a, mark_b = np.zeros(len(ids_a), np.int64), np.zeros(len(ids_b), np.int64)
        mark_a[end_a - 1], mark_b[end_b - 1] = 1, 2
        mark_b[bounds(n_b)[1:][n_b > 0] - 1] = 3
        out = np.empty(len(ids_a) + len(ids_b), object)
        out[np.arange(len(ids_a)) + (end_b - size_b)[group_a]] = self.text[mark_a, ids_a]
        out[np.arange(len(ids_b)) + end_a[group_b]] = self.text[mark_b, ids_b]
        both = bounds(n_a + n_b)
        return {"n_a": n_a, "n_b": n_b, "n_groups": np.bincount(doc, minlength=len(texts)),
                "n_links": np.bincount(doc, size_a * size_b, minlength=len(texts)).astype(np.int64),
                "groups": ["".join(out[both[k]:both[k + 1]]) for k in range(len(texts))],
                "cut": cut, "pairs": x << 32 | y, "links": links}


def alignments(docs: DataFrame, path_a: str, pattern: str, path_b: str, id_col: str = "doc_id", text_col: str = "text",
               groups: bool = True, chunk: int = PAIR_CHUNK) -> DataFrame:
    """Per document: id, n_a, n_b, n_groups, n_links, groups_sha256, pairs and links (arrays), and with ``groups``
    the groups themselves as text (``a1,a2|b1;a3|b2,b3``)."""
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = (f"id {id_type}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
              "pairs array<bigint>, links array<bigint>" + (", groups string" if groups else ""))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align = Aligner(path_a, pattern, path_b, chunk)
        for batch in batches:
            for part in W.byte_slices(batch, 1, SLICE_BYTES):
                x = align([t or "" for t in part.column(1).to_pylist()])
                cut = pa.array(x["cut"], pa.int32())
                columns = [part.column(0), *(pa.array(x[c], pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")),
                           pa.array([hashlib.sha256(g.encode()).hexdigest() if g else "" for g in x["groups"]], pa.string()),
                           pa.ListArray.from_arrays(cut, pa.array(x["pairs"], pa.int64())),
                           pa.ListArray.from_arrays(cut, pa.array(x["links"], pa.int64()))]
                names = ["id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "links"]
                if groups:
                    columns.append(pa.array(x["groups"], pa.string()))
                    names.append("groups")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")).mapInArrow(run, schema)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, n_docs, best): documents that hold a pair linked, and whether no pair of its A id has more."""
    counts = aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n_docs"))
    counts = stored(counts, "align-counts")
    # one row an id of A: bounded by the vocabulary
    most = counts.groupBy(F.shiftright("pair", 32).alias("a")).agg(F.max("n_docs").alias("most"))
    return (counts.join(F.broadcast(most), F.shiftright("pair", 32) == F.col("a"))
            .select("pair", "n_docs", (F.col("n_docs") == F.col("most")).alias("best")))


def _frequent(counts: DataFrame, limit: int) -> int:
    """The smallest document count that at most ``limit`` pairs reach; the histogram has 64 rows a power of two."""
    step = F.floor(F.log2(F.col("n_docs").cast("double")) * 64)
    hist = sorted(counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("n"), F.min("n_docs").alias("least"))
                  .collect(), key=lambda r: -r["step"])
    total, least = 0, 1 << 62
    for r in hist:
        total += r["n"]
        if total > limit:
            return least
        least = r["least"]
    return 0


def scored(aligned: DataFrame, counts: DataFrame, frequent: int = FREQUENT) -> DataFrame:
    """Per row of ``aligned`` (with ``row``, a key): n_best, links whose pair is best for its A id, and count_sum."""
    least = _frequent(counts, frequent)
    known = counts.where(F.col("n_docs") >= least).orderBy("pair").toArrow()   # at most ``frequent`` rows
    sent = aligned.sparkSession.sparkContext.broadcast(
        (known["pair"].to_numpy(), known["n_docs"].to_numpy(), known["best"].to_numpy(zero_copy_only=False)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n_docs, best = sent.value
        for batch in batches:
            lists, times = batch.column(1), batch.column(2).flatten().to_numpy(zero_copy_only=False)
            have = lists.flatten().to_numpy(zero_copy_only=False)
            cut = bounds(lists.value_lengths().to_numpy(zero_copy_only=False))
            at = np.minimum(np.searchsorted(pair, have), max(len(pair) - 1, 0))
            hit = pair[at] == have if len(pair) else np.zeros(len(have), bool)
            at = at[hit]
            sums = []
            for value in (best[at], n_docs[at]):
                full = np.zeros(len(have) + 1, np.int64)
                full[1:][hit] = value * times[hit]
                total = np.cumsum(full)
                sums.append(total[cut[1:]] - total[cut[:-1]])
            left = pa.array(bounds(~hit)[cut], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sums[0]), pa.array(sums[1]),
                 pa.ListArray.from_arrays(left, pa.array(have[~hit])), pa.ListArray.from_arrays(left, pa.array(times[~hit]))],
                names=["row", "n_best", "count_sum", "pairs", "links"])

    part = stored(aligned.select("row", "pairs", "links").mapInArrow(
        run, "row long, n_best long, count_sum long, pairs array<bigint>, links array<bigint>"), "align-known")
    sums = [F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")]
    rest = (part.select("row", F.explode(F.arrays_zip("pairs", "links")).alias("p"))
            .select("row", F.col("p.pairs").alias("pair"), F.col("p.links").alias("links"))
            .join(counts.where(F.col("n_docs") < least), "pair")
            .select("row", F.when(F.col("best"), F.col("links")).otherwise(0).alias("n_best"),
                    (F.col("links") * F.col("n_docs")).alias("count_sum")))
    return part.select("row", "n_best", "count_sum").unionByName(rest).groupBy("row").agg(*sums)


def aligned_documents(docs: DataFrame, path_a: str, pattern: str, path_b: str, id_col: str = "doc_id",
                      text_col: str = "text", frequent: int = FREQUENT, chunk: int = PAIR_CHUNK) -> DataFrame:
    """Per document: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    found = stored(alignments(docs, path_a, pattern, path_b, id_col, text_col, False, chunk)
                   .withColumn("row", F.monotonically_increasing_id()), "align-docs")
    marks = scored(found, pair_counts(found), frequent)
    return (found.drop("pairs", "links").join(marks, "row")
            .select(F.col("id").alias(id_col), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"))
