"""Prefix tries over words and the vocabulary pieces that end at each of their nodes.

A trie shares the work on common prefixes; :func:`arcs` finds for every node all pieces of
a fixed vocabulary that are a suffix of its path, by walking up from all nodes at once
through a trie of the reversed pieces.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from wordmill.llm.words import text_bytes


class Pieces:
    """A byte vocabulary as a trie of its reversed pieces; ids are positions in the list."""

    def __init__(self, pieces: list[bytes]):
        step: dict[int, int] = {}
        ends = {}
        for i, piece in enumerate(pieces):
            state = 0
            for byte in reversed(piece):
                state = step.setdefault(state << 8 | byte, len(step) + 1)
            ends[state] = i
        self.size = len(pieces)
        self.keys = np.array(sorted(step), np.int64)
        self.next = np.array([step[k] for k in self.keys.tolist()], np.int64)
        self.piece = np.full(len(step) + 1, -1, np.int32)
        self.piece[list(ends)] = list(ends.values())


@dataclass
class Trie:
    parent: np.ndarray    # of each node; node 0 is the root, children come after their parents
    byte: np.ndarray
    levels: np.ndarray    # bounds of the nodes of each depth, from depth 1
    terminal: np.ndarray  # the node of each word


def build(words: pa.Array) -> Trie:
    """The trie of the words' bytes, level by level."""
    off, raw = text_bytes(words)
    size = np.diff(off)
    here = np.zeros(len(words), np.int64)
    active = np.flatnonzero(size > 0)
    parents, letters, levels, n, depth = [np.zeros(1, np.int32)], [np.zeros(1, np.uint8)], [1], 1, 0
    while len(active):
        nodes, which = np.unique(here[active] << 8 | raw[off[active] + depth], return_inverse=True)
        parents.append((nodes >> 8).astype(np.int32))
        letters.append((nodes & 255).astype(np.uint8))
        here[active] = n + which
        n += len(nodes)
        levels.append(n)
        depth += 1
        active = active[size[active] > depth]
    return Trie(np.concatenate(parents), np.concatenate(letters), np.array(levels), here)


def arcs(trie: Trie, pieces: Pieces) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bounds by node, ancestor, piece): all pieces that lead from an ancestor to the node."""
    node = np.arange(1, len(trie.parent), dtype=np.int32)
    at, state = node, np.zeros(len(node), np.int64)
    found = []
    while len(node):
        key = state << 8 | trie.byte[at]
        k = np.minimum(np.searchsorted(pieces.keys, key), len(pieces.keys) - 1)
        alive = pieces.keys[k] == key
        node, at, state = node[alive], trie.parent[at[alive]], pieces.next[k[alive]]
        piece = pieces.piece[state]
        hit = piece >= 0
        found.append((node[hit], at[hit], piece[hit]))
        inner = at > 0
        node, at, state = node[inner], at[inner], state[inner]
    nodes, sources, piece = (np.concatenate(c) for c in zip(*found)) if found else (np.zeros(0, np.int32),) * 3
    found.clear()
    order = np.argsort(nodes, kind="stable")
    bounds = np.zeros(len(trie.parent) + 1, np.int64)
    np.cumsum(np.bincount(nodes, minlength=len(trie.parent)), out=bounds[1:])
    return bounds, sources[order], piece[order]
