"""Byte-pair vocabulary: learning (K1-K6), encoding/decoding (K7-K9) and the
tokenizer diagnostics (K10-K16).

Learning keeps the word-frequency table (one row per distinct pre-token) on Spark and
decides merges in epochs. A symbol is its vocabulary id, and a word a string of one
character per symbol, in id order. An epoch

1. counts adjacent pairs weighted by frequency and takes the first ``k`` in the trainer's
   order (count down, left id, right id): the hot pairs;
2. cuts every word where a pair is not hot and sums the frequencies of the distinct
   runs that are left. ``k`` is chosen so that at most ``RUN_LIMIT`` runs come back;
3. replays the trainer on these runs, merge by merge, until the best pair would rank
   after the last hot one;
4. rewrites the words by the new form of each run.

That gives the merges of one-at-a-time training. A merged token has one derivation, so a
new pair over a cut lies where the cut pair lay: it counts no more, and on a tie it
ranks after, because its ids are not smaller. So no pair over a cut can rank before the
last hot pair, and every other pair has all its places inside the runs. Only a merge whose
string is a token already breaks that (its pairs have places elsewhere): it ends its epoch.
One hot pair alone leaves a single run (or runs of one symbol), so an epoch always gets on.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as TY

from wordmill.functions import text as T
from wordmill.session import checkpoint_dir

# --- fixed values -------------------------------------------------------------------
SPECIALS = ("<unk>", "<s>", "</s>", "<pad>")    # ids 0..3
UNK = "<unk>"
VOCAB_SIZE = 32_000
MIN_FREQUENCY = 2
FERTILITY_EXCELLENT = 1.5    # tokens/word at or below: EXCELLENT
FERTILITY_GOOD = 2.0         # at or below: GOOD, else HIGH
UNK_WARN_PCT = 1.0           # unknown-token rate above this: warning
STRONG_GAIN = 0.85           # custom <= 0.85 x base tokens: strong signal
# --------------------------------------------------------------------------------------

RUN_LIMIT = 50_000           # distinct runs (bounded collect) an epoch is decided on
FIRST_HOT = 256              # hot pairs of the first epoch; later ones follow the number of runs
MOST_HOT = 1 << 16           # hot pairs fetched and sent to the tasks at most (bounded collect)
CHECKPOINT_EVERY = 10        # cut the lineage of the word table every N epochs
WORDS_PER_PARTITION = 100_000
MEMO_WORDS = 200_000         # encoded words a task keeps between batches
SLICE_PIECES = 250_000       # pre-tokens that a task puts together at once
SHORT_WORD = 32              # characters up to which a word is encoded without a heap
NO_MERGE = (1 << 62, -1)     # after every (rank, new id)
FIRST_CHAR = 0x20            # the character of id 0; surrogates are passed over


def chars(col) -> F.Column:
    """Characters (code points) of a string as an array of 1-char strings."""
    c = F.col(col) if isinstance(col, str) else col
    return F.regexp_extract_all(c, F.lit("(?s)."), F.lit(0))


def word_frequencies(df: DataFrame, text_col: str = "text") -> DataFrame:
    """K1 + K2: pre-tokens of every text and their corpus frequency.

    Tasks count the words of each Arrow batch, so the aggregate gets a row per distinct word of a batch: an
    exploded row per word would be sorted and spilled where a task's distinct words outgrow its memory.
    """
    def run(batches):
        for batch in batches:
            n = pc.value_counts(batch.column(0).flatten())
            yield pa.RecordBatch.from_arrays([n.field(0), n.field(1)], names=["word", "freq"])

    counted = df.select(T.pretokens(text_col).alias("_p")).mapInArrow(
        run, "word string, freq bigint")
    return counted.groupBy("word").agg(F.sum("freq").alias("freq"))


def _doc_slices(batch: pa.RecordBatch):
    """A batch of (key, pieces) cut into runs of documents of at most ``SLICE_PIECES`` pieces (one document at least)."""
    sizes = pc.fill_null(batch.column(1).value_lengths(), 0).to_numpy(zero_copy_only=False)
    ends, start = np.cumsum(sizes, dtype=np.int64), 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(int(np.searchsorted(ends, before + SLICE_PIECES, "right")), start + 1)
        yield batch.column(0).slice(start, stop - start), batch.column(1).slice(start, stop - start)
        start = stop


def alphabet(wf: DataFrame) -> DataFrame:
    """K3: every character seen, with its id (specials first, then code-point order)."""
    ch = wf.select(F.explode(chars("word")).alias("ch")).distinct()
    return ch.select("ch", F.ascii("ch").alias("cp"))


def pair_frequencies(wf: DataFrame, min_frequency: int = MIN_FREQUENCY) -> DataFrame:
    """K4: adjacent character pairs weighted by word frequency, count >= min."""
    s = wf.select("freq", chars("word").alias("c"))
    n = F.size("c")
    z = s.select("freq", F.explode(F.arrays_zip(F.slice("c", 1, n - 1).alias("left"),
                                                F.slice("c", 2, n - 1).alias("right")))
                 .alias("p"))
    g = z.groupBy(F.col("p.left").alias("left"), F.col("p.right").alias("right")).agg(
        F.sum("freq").alias("freq"))
    return g.where(F.col("freq") >= min_frequency)


@dataclass
class BpeModel:
    vocab: dict[str, int]                       # token -> id
    merges: list[tuple[str, str]] = field(default_factory=list)   # rank order
    rounds: int = 0

    @property
    def id_to_token(self) -> list[str]:
        out = [""] * len(self.vocab)
        for t, i in self.vocab.items():
            out[i] = t
        return out

    def merge_table(self) -> dict[tuple[int, int], tuple[int, int]]:
        """(left id, right id) -> (rank, new id)."""
        v = self.vocab
        return {(v[a], v[b]): (r, v[a + b]) for r, (a, b) in enumerate(self.merges)}


def symbol(i: int) -> str:
    """The character that stands for a vocabulary id; characters sort as the ids do."""
    code = i + FIRST_CHAR
    return chr(code if code < 0xD800 else code + 0x800)


def symbol_id(code: int) -> int:
    return (code if code < 0xD800 else code - 0x800) - FIRST_CHAR


def _adjacent(words: pa.Array) -> tuple[str, np.ndarray, np.ndarray, np.ndarray]:
    """All words as one string, its pairs as keys (left << 32 | right), the words' ends, and which pairs lie in a word."""
    joined = "".join(words.to_pylist())
    codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32).astype(np.int64)
    ends = np.cumsum(pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64))
    inside = np.ones(max(len(codes) - 1, 0), bool)
    inside[ends[:-1] - 1] = False
    return joined, codes[:-1] << 32 | codes[1:], ends, inside


def _count_pairs(batches):
    """Partial pair counts of each batch of (s, freq)."""
    for batch in batches:
        _, keys, ends, inside = _adjacent(batch.column(0))
        freq = batch.column(1).to_numpy(zero_copy_only=False)
        weight = np.repeat(freq, np.diff(ends, prepend=0))[:-1]
        pairs, at = np.unique(keys[inside], return_inverse=True)
        # whole numbers: bincount would sum in doubles
        n = np.zeros(len(pairs), np.int64)
        np.add.at(n, at, weight[inside])
        yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(n)], names=["pair", "n"])


def _pieces(joined: str, keys: np.ndarray, ends: np.ndarray, inside: np.ndarray, hot: np.ndarray
            ) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the words' pieces in the joined string (cut where a pair is not hot) and the first piece of each word."""
    at = np.minimum(np.searchsorted(hot, keys), len(hot) - 1)
    held = inside & (hot[at] == keys)
    cut = np.concatenate([[0], np.flatnonzero(~held) + 1, [len(joined)]])
    return cut, np.concatenate([[0], np.searchsorted(cut, ends)])


def _runs_of(hot: np.ndarray):
    def run(batches):
        for batch in batches:
            joined, keys, ends, inside = _adjacent(batch.column(0))
            cut, first = _pieces(joined, keys, ends, inside, hot)
            freq = np.repeat(batch.column(1).to_numpy(zero_copy_only=False), np.diff(first))
            long = np.flatnonzero(np.diff(cut) > 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array([joined[a:b] for a, b in zip(cut[long].tolist(), cut[long + 1].tolist())], pa.string()),
                 pa.array(freq[long])], names=["run", "freq"])
    return run


def _rewritten(sent, hot: np.ndarray):
    def run(batches):
        new = sent.value
        for batch in batches:
            joined, keys, ends, inside = _adjacent(batch.column(0))
            cut, first = _pieces(joined, keys, ends, inside, hot)
            pieces = [joined[a:b] for a, b in zip(cut[:-1].tolist(), cut[1:].tolist())]
            pieces = [new.get(x, x) for x in pieces]
            words = pa.array(["".join(pieces[a:b]) for a, b in zip(first[:-1].tolist(), first[1:].tolist())], pa.string())
            out = pa.RecordBatch.from_arrays([words, batch.column(1)], names=["s", "freq"])
            yield out.filter(pc.greater(pc.utf8_length(words), 1))
    return run


class _Replay:
    """The trainer on the distinct runs of an epoch, with their pairs' counts and places."""

    def __init__(self, runs: list[tuple[str, int]]):
        self.before = [r for r, _ in runs]
        self.words = [[symbol_id(ord(c)) for c in r] for r, _ in runs]
        self.freq = [n for _, n in runs]
        self.counts: dict[tuple[int, int], int] = {}
        self.where: dict[tuple[int, int], set[int]] = {}
        self.changed: set[int] = set()
        for k, w in enumerate(self.words):
            self._count(k, w, self.freq[k])
        self.heap = [(-n, *p) for p, n in self.counts.items()]
        heapq.heapify(self.heap)

    def _count(self, k: int, word: list[int], n: int) -> None:
        for p in zip(word, word[1:]):
            self.counts[p] = self.counts.get(p, 0) + n
            if n > 0:
                self.where.setdefault(p, set()).add(k)

    def best(self) -> tuple[int, int, int] | None:
        """(-count, left, right) of the best pair."""
        while self.heap:
            n, l, r = self.heap[0]
            now = self.counts.get((l, r), 0)
            if now == -n:
                return self.heap[0]
            heapq.heappop(self.heap)
            if now > 0:
                heapq.heappush(self.heap, (-now, l, r))
        return None

    def merge(self, l: int, r: int, new: int) -> None:
        touched = set()
        for k in self.where.pop((l, r), ()):
            old, word, i = self.words[k], [], 0
            while i < len(old):
                if old[i] == l and i + 1 < len(old) and old[i + 1] == r:
                    word.append(new)
                    i += 2
                else:
                    word.append(old[i])
                    i += 1
            if len(word) < len(old):
                self._count(k, old, -self.freq[k])
                self._count(k, word, self.freq[k])
                self.words[k] = word
                self.changed.add(k)
                touched.update(zip(word, word[1:]))
        for p in touched:
            heapq.heappush(self.heap, (-self.counts[p], *p))

    def rewrites(self) -> dict[str, str]:
        return {self.before[k]: "".join(map(symbol, self.words[k])) for k in self.changed}


class _Words:
    """The word table of (s, freq): cached from epoch to epoch, checkpointed every few."""

    def __init__(self, wf: DataFrame, vocab: dict[str, int], n_parts: int):
        letters = wf.sparkSession.sparkContext.broadcast(
            {ord(c): symbol(i) for c, i in vocab.items() if len(c) == 1})

        def spell(batches):
            for batch in batches:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([w.translate(letters.value) for w in batch.column(0).to_pylist()], pa.string()),
                     batch.column(1)], names=["s", "freq"])

        self.spark = wf.sparkSession
        self.state = (wf.select("word", F.col("freq").cast("bigint")).mapInArrow(spell, "s string, freq bigint")
                      .where(F.length("s") >= 2).repartition(n_parts).checkpoint(eager=True))
        self.prev, self.epochs = None, 0

    def ranked(self, min_frequency: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The first ``k`` pairs in the trainer's order, and their counts."""
        rows = (self.state.mapInArrow(_count_pairs, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))
                .where(F.col("n") >= min_frequency).orderBy(F.desc("n"), F.asc("pair")).limit(k).toArrow())
        if self.prev is not None:
            self.prev.unpersist()
            self.prev = None
        return rows["pair"].to_numpy(), rows["n"].to_numpy()

    def runs(self, hot: np.ndarray) -> list[tuple[str, int]] | None:
        """The distinct runs and their frequencies; None if they are more than ``RUN_LIMIT``."""
        found = (self.state.mapInArrow(_runs_of(hot), "run string, freq bigint").groupBy("run")
                 .agg(F.sum("freq").alias("freq")))
        if len(hot) > 1:
            found = found.limit(RUN_LIMIT + 1)
        rows = found.toArrow()
        if len(hot) > 1 and rows.num_rows > RUN_LIMIT:
            return None
        return list(zip(rows["run"].to_pylist(), rows["freq"].to_pylist()))

    def rewrite(self, hot: np.ndarray, new: dict[str, str]) -> None:
        sent = self.spark.sparkContext.broadcast(new)
        state = self.state.mapInArrow(_rewritten(sent, hot), "s string, freq bigint")
        self.epochs += 1
        if self.epochs % CHECKPOINT_EVERY == 0:
            state = state.checkpoint(eager=True)     # cuts the lineage (reliable storage)
            self.state.unpersist()
        else:
            state = state.cache()
            self.prev = self.state
        self.state = state

    def close(self) -> None:
        self.state.unpersist()
        if self.prev is not None:
            self.prev.unpersist()


def learn_bpe(wf: DataFrame, vocab_size: int = VOCAB_SIZE, min_frequency: int = MIN_FREQUENCY,
              first_hot: int = FIRST_HOT, partitions: int | None = None) -> BpeModel:
    """K5: merge list and vocabulary, equal to the classic trainer's result.

    ``wf`` is (word, freq). Best pair = highest count, ties by smaller
    (left id, right id); stops at ``vocab_size`` tokens or when the best count
    drops below ``min_frequency``. A merge whose string already exists reuses
    that id (the merge is recorded, the vocabulary does not grow).
    """
    spark = wf.sparkSession
    checkpoint_dir(spark)
    # the (word, freq) table is read several times: compute the corpus pass once
    wf = wf.checkpoint(eager=True)
    vocab: dict[str, int] = {t: i for i, t in enumerate(SPECIALS)}
    # bounded by the number of distinct characters
    for r in alphabet(wf).orderBy("cp").collect():
        vocab.setdefault(r["ch"], len(vocab))
    model = BpeModel(vocab)
    tokens = list(vocab)
    # about WORDS_PER_PARTITION words per task, at least half the cores
    n_parts = partitions or min(int(spark.conf.get("spark.sql.shuffle.partitions")),
                                max(spark.sparkContext.defaultParallelism // 2,
                                    -(-wf.count() // WORDS_PER_PARTITION)))
    words = _Words(wf, vocab, n_parts)
    k = first_hot
    while len(vocab) < vocab_size:
        pairs, counts = words.ranked(min_frequency, k)
        if not len(pairs):
            break
        k = min(k, len(pairs))
        while (runs := words.runs(np.sort(pairs[:k]))) is None:
            k = max(1, k // 4)
        hot = np.sort(pairs[:k])
        last = (-int(counts[k - 1]), *(symbol_id(c) for c in divmod(int(pairs[k - 1]), 1 << 32)))
        replay = _Replay(runs)
        model.rounds += 1
        while len(vocab) < vocab_size and (best := replay.best()) is not None and best <= last:
            _, l, r = best
            text = tokens[l] + tokens[r]
            known = vocab.get(text)
            new = len(vocab) if known is None else known
            model.merges.append((tokens[l], tokens[r]))
            replay.merge(l, r, new)
            if known is not None:
                break
            vocab[text] = new
            tokens.append(text)
        words.rewrite(hot, replay.rewrites())
        if len(runs) < RUN_LIMIT // 2:
            k = min(2 * k, MOST_HOT)
    words.close()
    return model


# ----------------------------------------------------------------------------- encode
def _encode_short(ids: list[int], table: dict, ranks: list[int] | None) -> list[int]:
    """The merges of a short word: the lowest rank, leftmost place of all neighbours, until none is left."""
    found = [table.get(p, NO_MERGE) for p in zip(ids, ids[1:])]
    while found:
        best = min(found)
        if best is NO_MERGE:
            break
        if ranks is not None:
            ranks.append(best[0])
        k = found.index(best)
        ids[k:k + 2] = [best[1]]
        del found[k]
        if k:
            found[k - 1] = table.get((ids[k - 1], ids[k]), NO_MERGE)
        if k < len(found):
            found[k] = table.get((ids[k], ids[k + 1]), NO_MERGE)
    return ids


def encode_word(word: str, vocab: dict[str, int], table: dict, unk_id: int, ranks: list[int] | None = None) -> list[int]:
    """K7: characters -> ids (unknown -> <unk>, not fused), then lowest-rank merges first.

    Neighbours are linked and candidate merges wait in a heap by (rank, place), so a
    word of n characters takes n log n steps; a short one takes the first of its merges from a list,
    in the same order. ``ranks`` gets the rank of every merge, in turn.
    """
    ids = [vocab.get(ch, unk_id) for ch in word]
    n = len(ids)
    if n <= SHORT_WORD:
        return _encode_short(ids, table, ranks)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = []

    def offer(k: int) -> None:
        if k >= 0 and after[k] < n:
            m = table.get((ids[k], ids[after[k]]))
            if m is not None:
                heapq.heappush(heap, (m[0], k, ids[k], ids[after[k]], m[1]))

    for k in range(n - 1):
        offer(k)
    while heap:
        rank, k, left, right, new = heapq.heappop(heap)
        gone = after[k]
        if ids[k] != left or gone >= n or ids[gone] != right:
            continue  # one of the two has merged meanwhile
        if ranks is not None:
            ranks.append(rank)
        ids[k], ids[gone] = new, None
        after[k] = after[gone]
        if after[k] < n:
            before[after[k]] = k
        offer(before[k])
        offer(k)
    return [i for i in ids if i is not None]


def _encoder(spark, model: BpeModel):
    return spark.sparkContext.broadcast(
        (model.vocab, model.merge_table(), model.vocab.get(UNK, 0)))


def encode_words(words: DataFrame, model: BpeModel, word_col: str = "word") -> DataFrame:
    """K7 over a table of distinct words: (word, ids array<int>)."""
    bc = _encoder(words.sparkSession, model)

    def run(it):
        vocab, table, unk = bc.value
        for pdf in it:
            yield pd.DataFrame({word_col: pdf[word_col],
                                "ids": [encode_word(w, vocab, table, unk) for w in pdf[word_col]]})

    schema = TY.StructType([TY.StructField(word_col, TY.StringType()),
                            TY.StructField("ids", TY.ArrayType(TY.IntegerType()))])
    return words.select(word_col).mapInPandas(run, schema)


def doc_tokens(df: DataFrame, model: BpeModel, key: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """(key, input_ids) per document, no truncation, no padding.

    The JVM pre-tokenizer splits the text; tasks encode the distinct words of each Arrow
    batch and put the documents together from them by index, slice by slice, so no shuffle and no loop
    over tokens is needed, and the arrays of a task's Python stay small.
    """
    bc = _encoder(df.sparkSession, model)

    def run(batches):
        vocab, table, unk = bc.value
        memo: dict[str, list[int]] = {}
        for batch in batches:
            coded = batch.column(1).flatten().dictionary_encode()
            distinct = coded.dictionary.to_pylist()
            if len(memo) + len(distinct) > MEMO_WORDS:
                memo = {}
            for w in distinct:
                if w not in memo:
                    memo[w] = encode_word(w, vocab, table, unk)
            size = np.fromiter((len(memo[w]) for w in distinct), np.int64, len(distinct))
            store = np.fromiter((i for w in distinct for i in memo[w]), np.int32, int(size.sum()))
            begin, place = np.cumsum(size) - size, 0
            for keys, pieces in _doc_slices(batch):
                counts = pc.fill_null(pieces.value_lengths(), 0).to_numpy(zero_copy_only=False)
                n = int(counts.sum())
                codes = coded.indices.slice(place, n).to_numpy(zero_copy_only=False)
                place += n
                end = np.concatenate([[0], np.cumsum(size[codes])])
                at = np.arange(end[-1]) + np.repeat(begin[codes] - end[:-1], size[codes])
                doc = end[np.concatenate([[0], np.cumsum(counts)])]
                yield pa.RecordBatch.from_arrays(
                    [keys, pa.ListArray.from_arrays(pa.array(doc, pa.int32()), pa.array(store[at], pa.int32()))],
                    names=[key, "input_ids"])

    schema = TY.StructType([TY.StructField(key, df.schema[key].dataType),
                            TY.StructField("input_ids", TY.ArrayType(TY.IntegerType()))])
    return df.select(key, T.pretokens(text_col).alias("_p")).mapInArrow(run, schema)


def merges_at(model: BpeModel, vocab_size: int) -> int:
    """How many of the model's merges a training to ``vocab_size`` would have made."""
    size = len(model.vocab) - len({a + b for a, b in model.merges})
    if size >= vocab_size:
        return 0
    seen = set()
    for k, (a, b) in enumerate(model.merges):
        seen.add(a + b)
        if size + len(seen) == vocab_size:
            return k + 1
    return len(model.merges)


def token_counts_at(df: DataFrame, model: BpeModel, vocab_sizes: list[int], key: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(key, bpe_<size>, ...): tokens of every text under the vocabularies of smaller trainings.

    The first merges of one training are the merges of a smaller one, and a word's encoding
    takes the lowest rank first. So until the first merge of a rank that the smaller
    vocabulary lacks both encode alike: words are encoded once, and each size reads off how
    many merges come before that.
    """
    limits = np.array([merges_at(model, n) for n in vocab_sizes], np.int64)
    bc = _encoder(df.sparkSession, model)
    names = [f"bpe_{n}" for n in vocab_sizes]

    def run(batches):
        vocab, table, unk = bc.value
        for batch in batches:
            pieces = batch.column(1)
            doc = np.concatenate([[0], np.cumsum(pc.fill_null(pieces.value_lengths(), 0).to_numpy(zero_copy_only=False))])
            coded = pieces.flatten().dictionary_encode()
            counts = np.zeros((len(coded.dictionary), len(limits)), np.int64)
            for k, w in enumerate(coded.dictionary.to_pylist()):
                ranks: list[int] = []
                encode_word(w, vocab, table, unk, ranks)
                # the running maximum: a merge behind a missing one is missing too
                counts[k] = len(w) - np.searchsorted(np.maximum.accumulate(np.array(ranks, np.int64)), limits)
            total = np.zeros((len(coded.indices) + 1, len(limits)), np.int64)
            np.cumsum(counts[coded.indices.to_numpy(zero_copy_only=False)], axis=0, out=total[1:])
            per = total[doc[1:]] - total[doc[:-1]]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(per[:, k]) for k in range(len(limits)))],
                                             names=[key, *names])

    schema = TY.StructType([TY.StructField(key, df.schema[key].dataType),
                            *(TY.StructField(n, TY.LongType()) for n in names)])
    return df.select(key, T.pretokens(text_col).alias("_p")).mapInArrow(run, schema)


def decode(df: DataFrame, model: BpeModel, ids_col: str = "input_ids",
           key: str = "doc_id", skip_special: bool = True) -> DataFrame:
    """K9: ids -> text (tokens joined, no word-end suffix; specials skipped)."""
    skipped = SPECIALS if skip_special else ()
    bc = df.sparkSession.sparkContext.broadcast(["" if t in skipped else t for t in model.id_to_token])

    def run(batches):
        tokens = pa.array(bc.value, pa.string())
        for batch in batches:
            ids = batch.column(1)
            ends = np.cumsum(pc.fill_null(ids.value_lengths(), 0).to_numpy(zero_copy_only=False))
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), tokens.take(ids.flatten()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pc.binary_join(lists, "")], names=[key, "text"])

    schema = TY.StructType([TY.StructField(key, df.schema[key].dataType),
                            TY.StructField("text", TY.StringType())])
    return df.select(key, ids_col).mapInArrow(run, schema)


def vocab_frame(spark, model: BpeModel) -> DataFrame:
    """(token, id), bounded by the vocabulary size."""
    return spark.createDataFrame(list(model.vocab.items()), "token string, id int")


def merges_frame(spark, model: BpeModel) -> DataFrame:
    return spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(model.merges)],
                                 "rank int, left string, right string")


def save_model(spark, model: BpeModel, path: str) -> None:
    """Vocabulary and merges as Parquet."""
    vocab_frame(spark, model).coalesce(1).write.mode("overwrite").parquet(f"{path}/vocab")
    merges_frame(spark, model).coalesce(1).write.mode("overwrite").parquet(f"{path}/merges")


def load_model(spark, path: str) -> BpeModel:
    vocab = {r["token"]: r["id"] for r in spark.read.parquet(f"{path}/vocab").collect()}
    merges = [(r["left"], r["right"]) for r in
              spark.read.parquet(f"{path}/merges").orderBy("rank").collect()]
    return BpeModel(vocab, merges)


# ------------------------------------------------------------------------ diagnostics
def fertility(df: DataFrame, tokens: DataFrame, key: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """K10 + K11: tokens per whitespace word and its grade (null when no words)."""
    w = df.select(key, F.size(T.words(text_col)).cast("bigint").alias("n_words"))
    t = tokens.select(key, F.size("input_ids").cast("bigint").alias("n_tokens"))
    j = w.join(t, key)
    agg = j.agg(F.sum("n_words").alias("total_words"), F.sum("n_tokens").alias("total_tokens"))
    fert = F.try_divide(F.col("total_tokens"), F.col("total_words"))
    return agg.select("total_words", "total_tokens", fert.alias("fertility"),
                      F.when(fert <= FERTILITY_EXCELLENT, "EXCELLENT")
                      .when(fert <= FERTILITY_GOOD, "GOOD").when(fert.isNotNull(), "HIGH")
                      .alias("grade"))


def unk_rate(tokens: DataFrame, model: BpeModel, ids_col: str = "input_ids") -> DataFrame:
    """100 * unknown / max(1, total) over all token lists."""
    unk = model.vocab.get(UNK)
    if unk is None:
        return tokens.sparkSession.createDataFrame([(0.0,)], "unk_rate double")
    c = tokens.select(F.size(ids_col).alias("n"),
                      F.size(F.filter(ids_col, lambda x: x == F.lit(unk))).alias("u"))
    return c.agg((F.coalesce(F.sum("u"), F.lit(0)) * 100.0
                  / F.greatest(F.lit(1), F.coalesce(F.sum("n"), F.lit(0)))).alias("unk_rate"))


# Token counts of tokenizers that need no trained model (K16 comparison set).
def simple_token_counts(text_col: str = "text") -> dict[str, F.Column]:
    t = F.col(text_col)
    return {
        "bytes": F.octet_length(t).cast("bigint"),
        "chars": F.length(t).cast("bigint"),
        "words": F.size(T.words(t)).cast("bigint"),
        "pretokens": F.size(T.pretokens(t)).cast("bigint"),
    }


def compare_tokenizers(df: DataFrame, counts: dict[str, F.Column], baseline: str,
                       label_col: str = "label") -> DataFrame:
    """(label, tokenizer, tokens, ratio vs baseline) with max(baseline, 1) guard."""
    names = list(counts)
    wide = df.select(label_col, *[c.alias(n) for n, c in counts.items()])
    stack = F.expr("stack({}, {})".format(
        len(names), ", ".join(f"'{n}', `{n}`" for n in names))).alias("tokenizer", "tokens")
    long = wide.select(label_col, F.col(baseline).alias("_base"), stack)
    return long.select(label_col, "tokenizer", "tokens",
                       (F.col("tokens") / F.greatest(F.col("_base"), F.lit(1))).alias("ratio"))


def avg_tokens(df: DataFrame, counts: dict[str, F.Column]) -> DataFrame:
    """Per tokenizer, sum / max(1, n) and the number of texts."""
    aggs = []
    for n, c in counts.items():
        aggs.append((F.sum(c) / F.greatest(F.lit(1), F.count("*"))).alias(f"avg_{n}"))
    return df.agg(F.count("*").alias("n_texts"), *aggs)


def token_reduction(base_avg: F.Column, custom_avg: F.Column, unk_pct: F.Column):
    """K14 + K15: reduction % and the A/B signal."""
    red = (base_avg - custom_avg) / F.greatest(base_avg, F.lit(1e-9)) * 100.0
    sig = (F.when(unk_pct > UNK_WARN_PCT, "warning_high_unk")
           .when(custom_avg <= base_avg * STRONG_GAIN, "strong")
           .otherwise("small"))
    return red, sig
