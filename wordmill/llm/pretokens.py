"""Pre-tokens of texts by a fixed public pattern, dictionary-encoded slice by slice."""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
import regex


def rank_file(path: str) -> dict[bytes, int]:
    """A public rank file: token bytes -> id."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class PreTokens:
    """Cuts texts by ``pattern``; every match is one pre-token, in order."""

    def __init__(self, pattern: str):
        self._find = regex.compile(pattern).findall

    def __call__(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """(distinct pre-tokens, index of each pre-token among them, pre-tokens per text)."""
        found, counts = [], []
        for text in texts.to_pylist():
            here = self._find(text) if text else []
            found += here
            counts.append(len(here))
        coded = pa.array(found, pa.string()).dictionary_encode()
        return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False), np.array(counts, np.int64)


def bounds(counts: np.ndarray) -> np.ndarray:
    """0 and the running totals of ``counts``."""
    out = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(counts, out=out[1:])
    return out


def gather(lengths: np.ndarray, begins: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Positions in a flat store of the runs ``codes`` name, one run after the other."""
    size = lengths[codes]
    end = np.cumsum(size)
    return np.arange(end[-1] if len(end) else 0) + np.repeat(begins[codes] - (end - size), size)
