"""Byte-level BPE encoding and decoding by recursive DuckDB queries inside Spark tasks.

Spark partitions the documents; each task cuts its texts into pre-tokens and hands the
distinct ones it has not met to DuckDB as token-position rows (one a byte). A recursive
query joins adjacent rows to the merge table and contracts, word by word, the leftmost
pair of the smallest rank until no pair of a word can merge. An ordered aggregation over
the resulting rows decodes them. Documents are put together from their words' ids in order.

A pre-token that is itself a token is that token, as in the public library: it enters the
recursion as one row. All ids are decoded by the vocabulary, these too. Words longer
than ``LONG_WORD`` bytes are contracted by the same rule, but in one step all
non-overlapping places of the smallest pair, left to right: the ids are the same (a merge never makes a pair of a
smaller rank), and the number of steps no longer grows with the word's length.

Words go to DuckDB in batches of ``BATCH_BYTES``; a batch that still outgrows its memory limit is
halved and tried again, down to a single word.

Defined results: null text is empty, which has no ids; very long texts are encoded whole;
pairs of one rank merge from the left; repeated rows are encoded each; an empty table
gives an empty result; other columns are ignored or, by ``keep``, carried.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import duckdb
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wordmill.llm import words as W
from wordmill.llm.pretokens import PreTokens, bounds, gather, rank_file

LONG_WORD = 256
SLICE_BYTES = 8 << 20   # text bytes that are encoded at once
BATCH_BYTES = 1 << 20   # bytes of words that one DuckDB query contracts
MEMO_WORDS = 300_000    # words a task keeps between slices; beyond that it forgets them, results are the same

#: Rows (word, pos, tok); rows of a word that can't merge any more leave with live = false.
ENCODE = """
WITH RECURSIVE state(id, tok, live) AS (
  SELECT (word::BIGINT << 32) | pos, tok, true FROM start
  UNION ALL
  (WITH pairs AS MATERIALIZED (
     SELECT id, tok, lead(id) OVER (ORDER BY id) AS next_id, lead(tok) OVER (ORDER BY id) AS next_tok
     FROM state WHERE live),
   merging AS MATERIALIZED (
     SELECT p.id, p.next_id, (m.merged::BIGINT << 32) | (p.id & 4294967295) AS place
     FROM pairs p JOIN merges m ON m.l = p.tok AND m.r = p.next_tok
     WHERE p.id >> 32 = p.next_id >> 32),
   best AS MATERIALIZED (
     SELECT id >> 32 AS word, min(place) AS place, arg_min(next_id, place) AS gone FROM merging GROUP BY 1)
   SELECT p.id,
          CASE WHEN p.id & 4294967295 = b.place & 4294967295 THEN (b.place >> 32)::INT ELSE p.tok END,
          b.word IS NOT NULL
   FROM pairs p LEFT JOIN best b ON b.word = p.id >> 32
   WHERE b.gone IS NULL OR p.id <> b.gone)
)
SELECT (id >> 32)::INT AS word, (id & 4294967295)::INT AS pos, tok FROM state WHERE NOT live
"""

#: The same for long words: all places of the word's smallest pair; of places that overlap
#: (runs of one token) every second one, from the left. The keyed recursion keeps one row a
#: place, and a step returns the changed places only, so memory stays linear in the word.
ENCODE_LONG = """
WITH RECURSIVE state(id, tok) USING KEY (id) AS (
  SELECT (word::BIGINT << 32) | pos, tok FROM start
  UNION
  (WITH touched AS MATERIALIZED (SELECT DISTINCT id >> 32 AS word FROM state),
   pairs AS MATERIALIZED (
     SELECT id, tok, row_number() OVER (ORDER BY id) AS k,
            lead(id) OVER (ORDER BY id) AS next_id, lead(tok) OVER (ORDER BY id) AS next_tok
     FROM recurring.state WHERE tok IS NOT NULL AND id >> 32 IN (SELECT word FROM touched)),
   merging AS MATERIALIZED (
     SELECT p.id, p.k, p.next_id, m.merged, min(m.merged) OVER (PARTITION BY p.id >> 32) AS least
     FROM pairs p JOIN merges m ON m.l = p.tok AND m.r = p.next_tok
     WHERE p.id >> 32 = p.next_id >> 32),
   runs AS MATERIALIZED (
     SELECT *, k - row_number() OVER (PARTITION BY id >> 32 ORDER BY k) AS run FROM merging WHERE merged = least),
   taken AS MATERIALIZED (
     SELECT id, next_id, merged
     FROM (SELECT *, row_number() OVER (PARTITION BY id >> 32, run ORDER BY k) AS nth FROM runs) WHERE nth % 2 = 1)
   SELECT id, merged FROM taken UNION ALL SELECT next_id, NULL FROM taken)
)
SELECT (id >> 32)::INT AS word, (id & 4294967295)::INT AS pos, tok FROM state WHERE tok IS NOT NULL
"""

DECODE = """
SELECT word, string_agg(hex, '' ORDER BY pos) AS hex
FROM {rows} JOIN vocabulary ON vocabulary.id = {rows}.tok GROUP BY word
"""


class Codec:
    """One task's DuckDB connection with the merge table, and the words it has encoded."""

    def __init__(self, ranks: dict[bytes, int], memo_words: int = MEMO_WORDS):
        self.ranks, self.memo_words = ranks, memo_words
        self.memo: dict[str, tuple[bytes, bytes]] = {}
        self.byte_id = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        triples = [(ranks[t[:k]], ranks[t[k:]], i) for t, i in ranks.items() for k in range(1, len(t))
                   if t[:k] in ranks and t[k:] in ranks]
        merges = pa.table(dict(zip(("l", "r", "merged"), (pa.array(c, pa.int32()) for c in zip(*triples)))) if triples
                          else {c: pa.array([], pa.int32()) for c in ("l", "r", "merged")})
        vocabulary = pa.table({"id": pa.array(list(ranks.values()), pa.int32()),
                               "hex": pa.array([t.hex() for t in ranks])})
        self.db = duckdb.connect()
        self.db.execute("SET threads = 1")
        self.db.execute("SET memory_limit = '400MB'")
        self.db.execute("SET temp_directory = ''")
        for name, rows in (("merges", merges), ("vocabulary", vocabulary)):
            self.db.register("given", rows)
            self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
            self.db.unregister("given")

    def _contract(self, words: list[bytes], sql: str) -> list[tuple[bytes, bytes]]:
        known = np.array([self.ranks.get(w, -1) for w in words], np.int32)
        whole = known >= 0
        sizes = np.where(whole, 1, np.array([len(w) for w in words], np.int64))
        tok = np.empty(int(sizes.sum()), np.int32)
        of_whole = np.repeat(whole, sizes)
        tok[of_whole] = known[whole]
        tok[~of_whole] = self.byte_id[np.frombuffer(b"".join(w for w, k in zip(words, whole.tolist()) if not k), np.uint8)]
        start = pa.table({"word": np.repeat(np.arange(len(words), dtype=np.int32), sizes),
                          "pos": gather(sizes, np.zeros(len(words), np.int64), np.arange(len(words))).astype(np.int32),
                          "tok": tok})
        try:
            self.db.register("start", start)
            rows = self.db.sql(f"SELECT * FROM ({sql}) ORDER BY word, pos").to_arrow_table()
            self.db.register("tokens", rows)
            decoded = self.db.execute(f"SELECT hex FROM ({DECODE.format(rows='tokens')}) ORDER BY word").fetchall()
        except duckdb.OutOfMemoryException:
            if len(words) == 1:
                raise
            half = len(words) // 2
            return self._contract(words[:half], sql) + self._contract(words[half:], sql)
        cut = bounds(np.bincount(rows["word"].to_numpy(), minlength=len(words)))
        ids = rows["tok"].to_numpy().astype("<u4")
        return [(ids[a:b].tobytes(), bytes.fromhex(h)) for a, b, (h,) in zip(cut[:-1], cut[1:], decoded)]

    def words(self, distinct: list[str]) -> list[tuple[bytes, bytes]]:
        """(ids as little-endian unsigned 32-bit integers, decoded bytes) of each word."""
        if len(self.memo) + len(distinct) > self.memo_words:
            self.memo = {}
        short, long = [], []
        for w in distinct:
            if w not in self.memo:
                raw = w.encode()
                (short if len(raw) <= LONG_WORD else long).append((w, raw))
        for group, sql in ((short, ENCODE), (long, ENCODE_LONG)):
            ends = bounds(np.array([len(r) for _, r in group], np.int64))
            at = 0
            while at < len(group):
                upto = max(at + 1, int(np.searchsorted(ends, ends[at] + BATCH_BYTES, "right")) - 1)
                part = group[at:upto]
                self.memo.update(zip((w for w, _ in part), self._contract([r for _, r in part], sql)))
                at = upto
        return [self.memo[w] for w in distinct]

    def slice(self, texts: pa.Array, cut: PreTokens):
        """(flat ids, bounds of the texts in them, flat decoded bytes, bounds of the texts in those)."""
        distinct, codes, counts = cut(texts)
        coded = self.words(distinct.to_pylist())
        doc = bounds(counts)
        out = []
        for k, dtype in ((0, "<u4"), (1, np.uint8)):
            flat = np.frombuffer(b"".join(c[k] for c in coded), dtype)
            sizes = np.array([len(c[k]) for c in coded], np.int64) // np.dtype(dtype).itemsize
            out += [flat[gather(sizes, bounds(sizes)[:-1], codes)], bounds(sizes[codes])[doc]]
        return out


def _sliced(batches: Iterator[pa.RecordBatch], column: int, path: str, pattern: str):
    codec, cut = Codec(rank_file(path)), PreTokens(pattern)
    for batch in batches:
        for part in W.byte_slices(batch, column, SLICE_BYTES):
            yield part, codec.slice(part.column(column), cut)


def encode(docs: DataFrame, path: str, pattern: str, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)
           ) -> DataFrame:
    """The ``keep`` columns, n_tokens and token_ids of every document."""
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField("n_tokens", T.LongType()),
                                                            T.StructField("token_ids", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, (ids, at, _, _) in _sliced(batches, len(keep), path, pattern):
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:len(keep)], pa.array(np.diff(at)),
                 pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids.astype(np.int32)))],
                names=[*keep, "n_tokens", "token_ids"])

    return docs.select(*(F.col(f"`{c}`") for c in keep), F.col(f"`{text_col}`").alias("_text")).mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str, ids_col: str = "token_ids", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns and the bytes of each id list, by an ordered aggregation over its token rows."""
    schema = T.StructType([encoded.schema[c] for c in keep] + [T.StructField("decoded", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(rank_file(path))
        for batch in batches:
            lists = batch.column(len(keep))
            sizes = np.array([0 if v is None else v for v in lists.value_lengths().to_pylist()], np.int64)
            rows = pa.table({"word": np.repeat(np.arange(len(sizes)), sizes), "pos": np.arange(int(sizes.sum())),
                             "tok": lists.flatten()})
            codec.db.register("tokens", rows)
            found = dict(codec.db.execute(DECODE.format(rows="tokens")).fetchall())
            codec.db.unregister("tokens")
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(keep)],
                 pa.array([bytes.fromhex(found.get(i, "")) for i in range(len(sizes))], pa.binary())],
                names=[*keep, "decoded"])

    return encoded.select(*(F.col(f"`{c}`") for c in keep), F.col(f"`{ids_col}`")).mapInArrow(run, schema)


def round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document the digests of its ids and of the bytes they decode to, in one pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, (ids, at, raw, cut) in _sliced(batches, 1, path, pattern):
            digest = [[hashlib.sha256(x[a:b].tobytes()).hexdigest() for a, b in zip(y[:-1], y[1:])]
                      for x, y in ((ids, at), (raw, cut))]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.diff(at)), pa.array(digest[0], pa.string()),
                                              pa.array(digest[1], pa.string())],
                                             names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("_text")
                       ).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
