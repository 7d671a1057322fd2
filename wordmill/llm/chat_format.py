"""Chat formatting with offset-aligned loss masks.

A conversation is rendered as ``<|turn|>role\\ntext<|end|>`` per turn. Inside roles and
texts ``\\`` becomes ``\\\\`` and ``<|`` becomes ``<\\|``, so no text can forge a marker and
the original comes back exactly (in roles a line feed becomes ``\\n``). The markers are
single added tokens of the tokenizer; tokens never reach across them. Headers, with their
line feed, are encoded apart from the texts, so no token lies over both, whatever white
space a text begins with.

Rows are dealt by ranges of (conversation, turn), so a conversation of any share of the rows
covers as many tasks as it needs. Tasks stream their turns in order and return parts of about
``part_chars`` characters that end at turns; ``part`` numbers grow along a conversation. Encoding
parts separately equals encoding the whole, because the tokenizer cuts at the markers and headers
first. Each part is encoded once; its tokens' character offsets follow from their byte lengths, and the
sorted spans of the trained turns are intersected with the sorted token spans by binary
search. :func:`read_back` reads every part where it lies and brings only what it found there
together by conversation, for the running digests: a SHA-256 is one chain, hashing is all that one task does.

Defined results: null text and null role are empty; turns order by (turn, role, text),
nulls first; repeated rows are repeated turns; rows without conversation id form one
conversation; texts of any length and of any run of white space are encoded whole; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordmill.llm.pretokens import bounds, rank_file

MEMO_WORDS = 100_000    # encoded pre-tokens a task keeps

TURN, END = "<|turn|>", "<|end|>"
_TURNS = re.compile(re.escape(TURN) + r"([^\n]*)\n(.*?)" + re.escape(END), re.S)
_MARK = re.compile(f"({re.escape(TURN)}|{re.escape(END)})")
_HEADER = re.compile(re.escape(TURN) + r"[^\n]*\n")
_ESCAPED = re.compile(r"\\(.)", re.S)

FORMATTED = ("conv_id long, part long, formatted string, token_ids array<int>, token_starts array<int>, "
             "token_ends array<int>, loss_mask array<boolean>")
#: What a part gives to the digests of its conversation.
READ = "conv_id long, part long, n_turns long, turns string, loss string, chars long, n_tokens long, n_loss_tokens long"
DIGESTS = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
           "formatted_chars long, n_tokens long, n_loss_tokens long")


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<|", "<\\|")


def escape_role(role: str) -> str:
    return escape(role).replace("\n", "\\n")


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: "\n" if m[1] == "n" else m[1], text)


class Tokenizer:
    """A public rank file with the two markers as single tokens, and the offsets of its tokens."""

    def __init__(self, path: str, pattern: str):
        import tiktoken
        ranks = rank_file(path)
        first = max(ranks.values()) + 1
        self.encoding = tiktoken.Encoding("chat", pat_str=pattern, mergeable_ranks=ranks,
                                          special_tokens={TURN: first, END: first + 1})
        self.marks = {TURN: first, END: first + 1}
        self.cut, self.memo = regex.compile(pattern).findall, {}
        self.size = np.zeros(first + 2, np.int64)
        self.size[list(ranks.values())] = [len(t) for t in ranks]
        self.size[first:] = len(TURN), len(END)

    def _word(self, word: str) -> list[int]:
        """The ids of one pre-token. The library's own cutting fails on long runs of white space, its merging does not."""
        found = self.memo.get(word)
        if found is None:
            if len(self.memo) >= MEMO_WORDS:
                self.memo.clear()
            found = self.memo[word] = self.encoding._encode_single_piece(word)
        return found

    def __call__(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, first characters, end characters); tokens of one character's bytes share its place."""
        ids, at = [], 0
        for cut in (*(m.end() for m in _HEADER.finditer(text)), len(text)):
            for piece in _MARK.split(text[at:cut]):
                if piece in self.marks:
                    ids.append(self.marks[piece])
                else:
                    for word in self.cut(piece):
                        ids += self._word(word)
            at = cut
        ids = np.array(ids, np.int64)
        lead = (np.frombuffer(text.encode(), np.uint8) & 0xC0) != 0x80
        chars = np.zeros(len(lead) + 1, np.int32)
        np.cumsum(lead, out=chars[1:])
        end = np.cumsum(self.size[ids])
        return ids.astype(np.int32), chars[end - self.size[ids] + 1] - 1, chars[end]


def render(turns: list[tuple[str, str]], trained: frozenset[str]) -> tuple[str, np.ndarray]:
    """(formatted text, sorted spans of the texts of trained roles)."""
    out, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{TURN}{escape_role(role)}\n", escape(text)
        if role in trained and body:
            spans.append((at + len(head), at + len(head) + len(body)))
        out += [head, body, END]
        at += len(head) + len(body) + len(END)
    return "".join(out), np.array(spans, np.int64).reshape(-1, 2)


def loss_mask(spans: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Tokens that share at least one character with a span; all inputs sorted."""
    if not len(spans):
        return np.zeros(len(starts), bool)
    k = np.searchsorted(spans[:, 1], starts, "right")  # the first span that ends behind the token's start
    inside = k < len(spans)
    return inside & (spans[np.minimum(k, len(spans) - 1), 0] < ends)


def format_conversations(conversations: DataFrame, rank_path: str, pattern: str, trained=("assistant",),
                         part_chars: int = 1 << 20) -> DataFrame:
    """Rows of :data:`FORMATTED`: the parts of each conversation, in order of ``part``."""
    trained = frozenset(trained)

    def parts(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Tokenizer(rank_path, pattern)
        number = itertools.count(TaskContext.get().partitionId() << 32)   # tasks are ranges, in order
        schema = pa.schema([("conv_id", pa.int64()), ("part", pa.int64()), ("formatted", pa.string()),
                            ("token_ids", pa.list_(pa.int32())), ("token_starts", pa.list_(pa.int32())),
                            ("token_ends", pa.list_(pa.int32())), ("loss_mask", pa.list_(pa.bool_()))])

        def encoded(found: list[tuple]) -> pa.RecordBatch:
            drawn = [render(turns, trained) for _, _, turns in found]
            coded = [encode(text) for text, _ in drawn]
            masks = [loss_mask(spans, start, end) for (_, spans), (_, start, end) in zip(drawn, coded)]
            at = pa.array(bounds(np.array([len(c[0]) for c in coded])).astype(np.int32))
            lists = [pa.ListArray.from_arrays(at, pa.array(np.concatenate(c))) for c in (*zip(*coded), masks)]
            return pa.RecordBatch.from_arrays(
                [pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64()),
                 pa.array([text for text, _ in drawn], pa.string()), *lists], schema=schema)

        nothing = object()
        conv, turns, size = nothing, [], 0
        ready, waiting = [], 0
        for batch in rows:
            for c, role, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if c != conv or size >= part_chars:
                    if turns:
                        ready.append((conv, next(number), turns))
                        waiting += size
                    conv, turns, size = c, [], 0
                    if waiting >= part_chars:
                        yield encoded(ready)
                        ready, waiting = [], 0
                turns.append((role, text))
                size += len(text) + len(role) + 16
        if turns:
            ready.append((conv, next(number), turns))
        if ready:
            yield encoded(ready)

    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"), F.col("turn").alias("turn"))
    return (rows.repartitionByRange("conv_id", "turn").sortWithinPartitions("conv_id", "turn", "role", "text")
            .select("conv_id", "role", "text").mapInArrow(parts, FORMATTED))


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a formatted part, exactly as they went in."""
    return [(unescape(m[1]), unescape(m[2])) for m in _TURNS.finditer(formatted)]


def masked_text(formatted: str, starts: np.ndarray, ends: np.ndarray, mask: np.ndarray) -> list[str]:
    """The unescaped texts under the mask, one for each run of masked tokens."""
    starts, ends = starts[mask], ends[mask]
    if not len(starts):
        return []
    new = np.concatenate([[True], starts[1:] > np.maximum.accumulate(ends)[:-1]])
    firsts = np.flatnonzero(new)
    lasts = np.append(firsts[1:], len(starts)) - 1
    return [unescape(formatted[a:b]) for a, b in zip(starts[firsts], ends[lasts])]


def read_back(formatted: DataFrame) -> DataFrame:
    """One row per conversation: digests from its formatted parts, their offsets and masks alone."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            conv, part, text, _, starts, ends, mask = batch.columns
            for i in range(batch.num_rows):
                t, m = text[i].as_py(), mask[i].values.to_numpy(zero_copy_only=False)
                turns = read_turns(t)
                loss = masked_text(t, starts[i].values.to_numpy(), ends[i].values.to_numpy(), m)
                out.append((len(turns), "".join(f"{role}\n{said}\n" for role, said in turns), "".join(loss), len(t), len(m),
                            int(m.sum())))
            columns = list(zip(*out)) or [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [conv, part, pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.string()),
                 pa.array(columns[2], pa.string()), *(pa.array(c, pa.int64()) for c in columns[3:])],
                names=["conv_id", "part", "n_turns", "turns", "loss", "chars", "n_tokens", "n_loss_tokens"])

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                            ("loss_chars", pa.int64()), ("loss_sha256", pa.string()),
                            ("formatted_chars", pa.int64()), ("n_tokens", pa.int64()),
                            ("n_loss_tokens", pa.int64())])
        state = None

        def rows(found: list) -> pa.RecordBatch:
            done = [(s[0], s[1], s[2].hexdigest(), s[3], s[4].hexdigest(), *s[5:]) for s in found]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), schema.types)], schema=schema)

        for batch in batches:
            ended = []
            for c, n, turns, loss, chars, tokens, masked in zip(*(x.to_pylist() for x in batch.columns)):
                if state is None or state[0] != c:
                    if state is not None:
                        ended.append(state)
                    state = [c, 0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0, 0]
                state[2].update(turns.encode())
                state[4].update(loss.encode())
                for k, more in ((1, n), (3, len(loss)), (5, chars), (6, tokens), (7, masked)):
                    state[k] += more
            if ended:
                yield rows(ended)
        if state is not None:
            yield rows([state])

    found = formatted.mapInArrow(read, READ)
    return (found.repartition("conv_id").sortWithinPartitions("conv_id", "part").drop("part").mapInArrow(digests, DIGESTS))
