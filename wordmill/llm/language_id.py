"""Language identification by segmentation-marginalised unigrams.

For each language a probability for every piece of a fixed public byte vocabulary is
learned. The probability of a word is the sum, over all its segmentations into pieces, of
the product of the pieces' probabilities: a forward algorithm, run down a trie of the
distinct words so that common prefixes are summed once. A text's log-likelihood is the sum
over its words (lower-cased runs of letters and non-ASCII characters, each with a space in
front, as the vocabulary's word-initial pieces have it); the score is the posterior of the
best language under equal priors.

Training is expectation-maximisation on the word counts of all labelled documents: the forward
sums and, back through the same trie, the expected piece counts. The counts of distinct words
are a table; a round is one job over its parts, which sends back the expected uses of each piece
in each language as whole numbers of 1 / ``UNITS``, so their sums do not depend on the order. Parts follow
the words alone, so every run learns the same. The model has one row a language and one column a piece.

Defined results: null texts and texts without a letter (Unicode category L; number signs are
none) are ``und`` with score 0, and so is every text when there is nothing to learn from;
very long texts are scored whole; equal likelihoods go to the language that
sorts first; repeated rows are predicted each; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wordmill.llm import lattice, words as W
from wordmill.llm.positions import numbered
from wordmill.llm.pretokens import bounds, rank_file
from wordmill.llm.scratch import stored, temporary

UNKNOWN = "und"
SLICE_BYTES = 4 << 20
PART_BYTES = 4 << 20     # bytes of distinct words that a task of a round takes, about
UNITS = 1 << 20          # expected uses are summed in these fractions
_LETTER = regex.compile(r"\p{L}")


@dataclass
class Model:
    languages: list[str]
    pieces: list[bytes]
    log_p: np.ndarray  # piece x language


def spaced_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct words with a space in front, index of each word among them, words per text)."""
    found, counts = W.word_runs(pc.utf8_lower(pc.fill_null(texts, "")), W.LETTERS)
    distinct, codes = W.encode(found)
    return pc.binary_join_element_wise(pa.scalar("", pa.large_string()), distinct.cast(pa.large_string()),
                                       pa.scalar(" ", pa.large_string())), codes, counts


class Forward:
    """The lattice of some distinct words."""

    def __init__(self, distinct: pa.Array, pieces: lattice.Pieces):
        self.trie = lattice.build(distinct)
        self.at, self.source, self.piece = lattice.arcs(self.trie, pieces)

    def sums(self, log_p: np.ndarray) -> np.ndarray:
        """Node x language: log of the summed probabilities of all segmentations of the prefix."""
        out = np.zeros((len(self.trie.parent), log_p.shape[1]))
        for a, b in zip(self.trie.levels[:-1], self.trie.levels[1:]):
            lo, hi = self.at[a], self.at[b]
            first = self.at[a:b] - lo
            reached = out[self.source[lo:hi]] + log_p[self.piece[lo:hi]]
            top = np.maximum.reduceat(reached, first, axis=0)
            reached -= np.repeat(top, np.diff(self.at[a:b + 1]), axis=0)
            out[a:b] = top + np.log(np.add.reduceat(np.exp(reached), first, axis=0))
        return out

    def expected(self, log_p: np.ndarray, counts: np.ndarray, n_pieces: int) -> np.ndarray:
        """Piece x language: expected uses, given ``counts`` (word x language)."""
        sums = self.sums(log_p)
        weight = np.zeros_like(sums)
        np.add.at(weight, self.trie.terminal, counts)
        used = np.zeros((len(self.piece), log_p.shape[1]))
        for a, b in reversed(list(zip(self.trie.levels[:-1], self.trie.levels[1:]))):
            lo, hi = self.at[a], self.at[b]
            source, piece = self.source[lo:hi], self.piece[lo:hi]
            many = np.diff(self.at[a:b + 1])
            share = np.exp(sums[source] + log_p[piece] - np.repeat(sums[a:b], many, axis=0))
            share *= np.repeat(weight[a:b], many, axis=0)
            used[lo:hi] = share
            first = source.min()    # a piece is short, so its sources are near
            for k in range(share.shape[1]):
                more = np.bincount(source - first, share[:, k])
                weight[first:first + len(more), k] += more
        return np.stack([np.bincount(self.piece, used[:, k], n_pieces) for k in range(used.shape[1])], axis=1)


def _first_guess(vocabulary: list[bytes], n_languages: int) -> np.ndarray:
    size = np.array([len(p) for p in vocabulary])
    return np.repeat((-np.log(size.max() + 1.0) * size - np.log(2.0))[:, None], n_languages, axis=1)


def fit(counted: pa.Table, vocabulary: list[bytes], rounds: int = 4, smoothing: float = 0.02) -> Model:
    """Piece probabilities from rows (lang, word, n): counts of (spaced) words in each language."""
    languages = sorted(pc.unique(counted["lang"]).to_pylist())
    if not languages:
        return Model([], vocabulary, np.zeros((len(vocabulary), 0)))
    words = counted["word"].combine_chunks().dictionary_encode()
    which = pc.index_in(counted["lang"], pa.array(languages, pa.string())).to_numpy()
    counts = np.zeros((len(words.dictionary), len(languages)))
    np.add.at(counts, (words.indices.to_numpy(), which), counted["n"].to_numpy())
    pieces = lattice.Pieces(vocabulary)
    forward = Forward(words.dictionary, pieces)
    log_p = _first_guess(vocabulary, len(languages))
    for _ in range(rounds):
        uses = forward.expected(log_p, counts, len(vocabulary)) + smoothing
        log_p = np.log(uses) - np.log(uses.sum(axis=0))
    return Model(languages, vocabulary, log_p)


def learn(counted: DataFrame, vocabulary: list[bytes], rounds: int = 4, smoothing: float = 0.02) -> Model:
    """:func:`fit` on a table (lang, word, n) of any size: a job per round, the driver gets one row per piece and language."""
    with temporary(counted.sparkSession):
        return _learn(stored(counted, "word-counts"), vocabulary, rounds, smoothing)


def _learn(counted: DataFrame, vocabulary: list[bytes], rounds: int, smoothing: float) -> Model:
    found = counted.groupBy("lang").agg(F.sum(F.octet_length("word") + F.lit(8)).alias("size")).collect()  # a row a label
    languages = sorted(r["lang"] for r in found)
    if not languages:
        return Model([], vocabulary, np.zeros((len(vocabulary), 0)))
    parts = -(-sum(r["size"] for r in found) // PART_BYTES)
    words = stored(counted.repartition(parts, "word").sortWithinPartitions("word", "lang")
                   .select("lang", "word", "n", F.spark_partition_id().alias("part")), "training-words")
    context = counted.sparkSession.sparkContext
    names, n_pieces = pa.array(languages, pa.string()), len(vocabulary)
    slice_bytes = max(1 << 16, SLICE_BYTES // len(languages))
    pieces = context.broadcast(lattice.Pieces(vocabulary))
    log_p = _first_guess(vocabulary, len(languages))
    for _ in range(rounds):
        sent = context.broadcast(log_p)

        def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            whole = np.zeros((n_pieces, len(names)), np.int64)
            for rows in _by_part(batches):
                uses = np.zeros((n_pieces, len(names)))
                for some in W.byte_slices(rows, "word", slice_bytes):
                    coded = some.column(1).dictionary_encode()
                    counts = np.zeros((len(coded.dictionary), len(names)))
                    np.add.at(counts, (coded.indices.to_numpy(zero_copy_only=False),
                                       pc.index_in(some.column(0), names).to_numpy(zero_copy_only=False)),
                              some.column(2).to_numpy(zero_copy_only=False))
                    uses += Forward(coded.dictionary, pieces.value).expected(sent.value, counts, n_pieces)
                whole += np.rint(uses * UNITS).astype(np.int64)
            piece, lang = np.nonzero(whole)
            yield pa.RecordBatch.from_arrays([pa.array(piece.astype(np.int32)), pa.array(lang.astype(np.int32)),
                                              pa.array(whole[piece, lang])], names=["piece", "lang", "n"])

        rows = (words.mapInArrow(expect, "piece int, lang int, n long")
                .groupBy("piece", "lang").agg(F.sum("n").alias("n")).toArrow())
        uses = np.full((n_pieces, len(names)), smoothing)
        uses[rows["piece"].to_numpy(), rows["lang"].to_numpy()] += rows["n"].to_numpy() / UNITS
        log_p = np.log(uses) - np.log(uses.sum(axis=0))
        sent.destroy()
    pieces.destroy()
    return Model(languages, vocabulary, log_p)


def _by_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, word, n, part) put together by part; a part is one file, so its rows come one after the other."""
    held, at = [], None
    for batch in batches:
        part = batch.column(3).to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            if a < b:
                if held and part[a] != at:
                    yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                    held = []
                held.append(batch.slice(a, b - a))
                at = part[a]
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def train(docs: DataFrame, vocabulary_path: str, text_col: str = "text", lang_col: str = "lang", rounds: int = 4) -> Model:
    """Learn from all documents of ``docs`` with a label that is not null."""
    ranks = rank_file(vocabulary_path)
    vocabulary = sorted(ranks, key=ranks.get)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.byte_slices(batch, "text", SLICE_BYTES):
                langs = part.column(0).dictionary_encode()
                distinct, codes, counts = spaced_words(part.column(1))
                lang = np.repeat(langs.indices.to_numpy(zero_copy_only=False).astype(np.int64), counts)
                size = max(1, len(distinct))
                pairs, n = np.unique(lang * size + codes, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [langs.dictionary.take(pa.array(pairs // size)), distinct.take(pa.array(pairs % size))
                     .cast(pa.string()), pa.array(n.astype(np.int64))], names=["lang", "word", "n"])

    labelled = docs.select(F.col(f"`{lang_col}`").cast("string").alias("lang"), F.col(f"`{text_col}`").alias("text")).where(
        F.col("lang").isNotNull())
    return learn(labelled.mapInArrow(count, "lang string, word string, n long").groupBy("lang", "word").agg(
        F.sum("n").alias("n")), vocabulary, rounds)


def least_fit(per_byte: DataFrame) -> float:
    """The log-likelihood per byte below which a text is of none of the languages.

    ``per_byte`` has one column, that of every training document. One of them in a hundred lies
    below the range's low end, so odd documents do not set it; the limit lies as far below that end as the
    median lies above it. The quantiles are exact (interpolated, as ``percentile`` does), by places in
    the sorted order.
    """
    n = per_byte.count()
    if not n:
        return -np.inf
    at = [share * (n - 1) for share in (0.01, 0.5)]
    wanted = sorted({int(f(x)) for x in at for f in (np.floor, np.ceil)})
    placed = numbered(per_byte.toDF("_v").withColumn("_all", F.lit(0)), "_all", ["_v"], "_at", name="least-fit")
    value = {r["_at"]: r["_v"] for r in placed.where(F.col("_at").isin(wanted)).select("_at", "_v").collect()}
    low, middle = ((1 - x % 1) * value[int(x)] + x % 1 * value[int(np.ceil(x))] for x in at)
    return low - (middle - low)


def predict(docs: DataFrame, model: Model, text_col: str = "text", out=("lang_pred", "score")) -> DataFrame:
    """All columns of ``docs``, and the predicted language with its posterior (columns of these names are replaced).

    Two further names in ``out`` get the log-likelihood in that language and the bytes of the words.
    """
    docs = docs.drop(*out)
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(model)  # languages x vocabulary, both fixed by the model
    names = docs.columns
    schema = T.StructType([*docs.schema.fields, T.StructField(out[0], T.StringType()),
                           T.StructField(out[1], T.DoubleType()),
                           *(T.StructField(c, kind) for c, kind in zip(out[2:], (T.DoubleType(), T.LongType())))])
    at = names.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        pieces = lattice.Pieces(m.pieces)
        labels = np.array([*m.languages, UNKNOWN], object)
        for batch in batches:
            for part in W.byte_slices(batch, text_col, SLICE_BYTES):
                texts = part.column(at)
                distinct, codes, counts = spaced_words(texts)
                score, fit = np.zeros(part.num_rows), np.zeros(part.num_rows)
                size = np.concatenate([[0], np.cumsum(pc.binary_length(distinct).to_numpy()[codes])])[bounds(counts)]
                best = np.full(part.num_rows, len(m.languages))
                if m.languages:
                    known = Forward(distinct, pieces)
                    per_word = known.sums(m.log_p)[known.trie.terminal]
                    total = np.zeros((part.num_rows, len(m.languages)))
                    doc = bounds(counts)
                    some = np.flatnonzero(counts > 0)
                    if len(some):
                        for k in range(len(m.languages)):
                            total[some, k] = np.add.reduceat(per_word[codes, k], doc[some])
                    letters = np.array([t is not None and bool(_LETTER.search(t)) for t in texts.to_pylist()], bool)
                    ok = letters & (counts > 0)
                    best[ok] = total[ok].argmax(axis=1)
                    top = total[ok] - total[ok].max(axis=1, keepdims=True)
                    score[ok] = 1 / np.exp(top).sum(axis=1)
                    fit[ok] = total[ok].max(axis=1)
                more = [pa.array(fit), pa.array(np.diff(size).astype(np.int64))][:len(out) - 2]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(labels[best], pa.string()), pa.array(score), *more], names=[*names, *out])

    return docs.mapInArrow(run, schema)


def held_out(id_col: str = "doc_id") -> F.Column:
    """The quarter of the documents whose labels are never learned from."""
    return F.coalesce(F.pmod(F.crc32(F.col(f"`{id_col}`").cast("string")), F.lit(4)) == 2, F.lit(False))
