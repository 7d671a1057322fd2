"""Token counts under a unigram model, by dynamic programming over a shared trie.

The distinct pre-tokens of a slice of documents are put into one trie. Going down level by
level, each node gets the score and the token count of the best segmentation of its
prefix: the best of (score of an ancestor + score of the piece between), so a prefix that
many pre-tokens share is scored once. The counts at the terminal nodes are the token
counts of the pre-tokens, and a document's count is their sum over its pre-tokens.

Pieces are a fixed public byte vocabulary; their probabilities are learned
(:func:`learn_scores`) by expectation-maximisation on the pre-tokens of all documents, a job per
round over the table of distinct ones. A score is a log-probability in whole
micro-units, so that sums are exact and ties are ties. Of equal scores the segmentation of
fewer tokens counts. All 256 single bytes are pieces, so every text has a segmentation.

Defined results: null and empty texts have no tokens; very long texts are learned from and counted
whole; where there is nothing to learn from, all pieces score alike; repeated rows are counted each; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordmill.llm import lattice, words as W
from wordmill.llm.language_id import learn
from wordmill.llm.pretokens import PreTokens, bounds, rank_file

SLICE_BYTES = 8 << 20
ROUNDS = 3


def learn_scores(docs: DataFrame, path: str, pattern: str, text_col: str = "text", rounds: int = ROUNDS) -> np.ndarray:
    """Log-probability of every piece in whole micro-units, learned from all of ``docs``."""
    ranks = rank_file(path)
    vocabulary = sorted(ranks, key=ranks.get)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = PreTokens(pattern)
        for batch in batches:
            for part in W.byte_slices(batch, 0, SLICE_BYTES):
                distinct, codes, _ = cut(part.column(0))
                yield pa.RecordBatch.from_arrays(
                    [distinct, pa.array(np.bincount(codes, minlength=len(distinct)).astype(np.int64))], names=["word", "n"])

    words = (docs.select(F.col(f"`{text_col}`").alias("text")).mapInArrow(count, "word string, n long")
             .groupBy("word").agg(F.sum("n").alias("n")).select(F.lit("").alias("lang"), "word", "n"))
    model = learn(words, vocabulary, rounds)
    if not model.languages:
        return np.full(len(vocabulary), -1_000_000, np.int64)
    return np.round(model.log_p[:, 0] * 1e6).astype(np.int64)


def terminal_counts(distinct: pa.Array, pieces: lattice.Pieces, scores: np.ndarray) -> np.ndarray:
    """The number of tokens of each distinct pre-token."""
    trie = lattice.build(distinct)
    at, source, piece = lattice.arcs(trie, pieces)
    score = np.zeros(len(trie.parent), np.int64)
    count = np.zeros(len(trie.parent), np.int64)
    for a, b in zip(trie.levels[:-1], trie.levels[1:]):
        lo, hi = at[a], at[b]
        first = at[a:b] - lo
        reached = score[source[lo:hi]] + scores[piece[lo:hi]]
        best = np.maximum.reduceat(reached, first)
        tokens = count[source[lo:hi]] + 1
        tokens[reached < np.repeat(best, np.diff(at[a:b + 1]))] = np.iinfo(np.int64).max
        score[a:b], count[a:b] = best, np.minimum.reduceat(tokens, first)
    return count[trie.terminal]


def token_counts(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
                 scores: np.ndarray | None = None) -> DataFrame:
    """doc_id, n_pretokens, n_tokens of every document; without ``scores`` they are learned from ``docs``."""
    if scores is None:
        scores = learn_scores(docs, path, pattern, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = rank_file(path)
        ordered = sorted(ranks, key=ranks.get)
        pieces, cut = lattice.Pieces(ordered), PreTokens(pattern)
        for batch in batches:
            for part in W.byte_slices(batch, "text", SLICE_BYTES):
                distinct, codes, counts = cut(part.column(1))
                tokens = np.concatenate([[0], np.cumsum(terminal_counts(distinct, pieces, scores)[codes])])
                doc = bounds(counts)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(counts), pa.array(np.diff(tokens[doc]).astype(np.int64))],
                    names=["doc_id", "n_pretokens", "n_tokens"])

    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text")
                       ).mapInArrow(run, "doc_id long, n_pretokens long, n_tokens long")
