"""Vectorised word runs of Arrow string columns.

Separators are ASCII bytes only, so cutting UTF-8 text at byte level gives the same
words as the code-point pattern ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` on text whose
A-Z are lower-cased: digits, a-z and everything outside ASCII.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def _byte_table(digits: bool) -> np.ndarray:
    """Byte -> byte kept in a word (A-Z lower-cased), 0 for separators."""
    table = np.zeros(256, np.uint8)
    table[0x80:] = np.arange(0x80, 0x100)
    table[ord("a"):ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
    table[ord("A"):ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
    if digits:
        table[ord("0"):ord("9") + 1] = np.arange(ord("0"), ord("9") + 1)
    return table


WORDS = _byte_table(digits=True)
LETTERS = _byte_table(digits=False)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a string array, nulls as empty texts; offsets start at 0."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    off = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    if not len(off):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    raw = np.frombuffer(data, np.uint8)[off[0]:off[-1]] if data is not None else np.zeros(0, np.uint8)
    return off - off[0], raw


def byte_slices(batch: pa.RecordBatch, column: str | int, limit: int) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows of at most ``limit`` text bytes (one row at least)."""
    off, _ = text_bytes(batch.column(batch.schema.get_field_index(column) if isinstance(column, str) else column))
    start = 0
    while start < batch.num_rows:
        end = int(np.searchsorted(off, off[start] + limit, "right")) - 1
        end = min(max(end, start + 1), batch.num_rows)
        yield batch.slice(start, end - start)
        start = end


def word_runs(texts: pa.Array, table: np.ndarray = WORDS) -> tuple[pa.Array, np.ndarray]:
    """(all words in order, number of words of each text)."""
    off, raw = text_bytes(texts)
    if not len(raw):
        return pa.array([], pa.string()), np.zeros(len(off) - 1, np.int64)
    low = table[raw]
    inside = low != 0
    first = np.empty(len(inside), bool)
    first[0] = True
    np.logical_not(inside[:-1], out=first[1:])
    begins = off[:-1][off[:-1] < len(raw)]
    first[begins] = True  # a text never continues the word of the text before it
    first &= inside
    last = np.empty(len(inside), bool)
    last[-1] = True
    np.logical_not(inside[1:], out=last[:-1])
    last[begins[begins > 0] - 1] = True
    last &= inside
    starts = np.flatnonzero(first)
    ends = np.flatnonzero(last) + 1
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    words = pa.LargeStringArray.from_buffers(
        len(starts), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(low[inside])))
    counts = np.diff(np.searchsorted(starts, off))
    return words, counts


def encode(words: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(distinct words, index of each word among them)."""
    coded = words.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)
