"""Merkle manifest of a table, whose parents keep their hash states (SHA midstate tree).

A leaf is the digest of a row's fields. Per group (source) the leaves stand in order of
the id; every ``FAN`` consecutive nodes become a parent, the SHA-256 of their digests as
hex text, until one node, the subroot, remains. The subroots, in order of the group,
become the root in the same way.

A parent's message is one 64-byte block a child, so the state before each child slot is a
SHA-256 chaining value of 32 bytes. The manifest stores it for every slot. To fold another
version of a row into the tree, the state before its slot goes on with the new digest and
the siblings right of it only; what lies left is in the state already.

On Spark: leaves are numbered inside their group by range partitioning, and
``FAN ** levels`` consecutive nodes are one block, built by one bounded grouped task; a
group of any size is as many blocks as it needs, and a table of N rows takes about
log N / log (FAN ** levels) jobs. The states and siblings above a block (its path) are handed
down block by block, so no join has a key of more rows than a block has nodes.

Defined results: null fields count as ``-`` (a null id stands before all others, a null
group before all groups); null, empty and very long texts are hashed whole on the JVM;
rows that repeat are leaves of their own, next to each other, in no fixed order; rows of
one id in one group stand in order of their leaf; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordmill.llm import sha256 as S
from wordmill.llm.positions import numbered
from wordmill.llm.scratch import stored

FAN = 16
LEVELS = 3               # levels of a block: 4096 nodes
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

STEP = "array<struct<slot: int, run: binary, state: binary>>"
BLOCK = "key string, blk long, n long, nodes array<binary>, states array<binary>, root binary"
PATH = f"key string, blk long, steps {STEP}, subroot binary, root binary"


def leaf(fields: list[F.Column]) -> F.Column:
    """Lowercase hex SHA-256 of the fields: ``-`` for null, else UTF-8 byte count, ``:``, value."""
    def part(value: F.Column) -> F.Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))
    return F.sha2(F.concat(*map(part, fields)), 256)


# --- one block: at most FAN ** levels nodes of a group --------------------------------------------
def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, 32)


def _depth(total: int, levels: int) -> int:
    """Levels that a block of a group of ``total`` nodes has."""
    depth = 0
    while depth < levels and total > FAN ** depth:
        depth += 1
    return depth


def parents(nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(digests of the parents, their states before each child slot, zero where there is no child)."""
    count = np.minimum(FAN, len(nodes) - FAN * np.arange(-(-len(nodes) // FAN)))
    words = S.hex_block(nodes)
    now = np.tile(S.START, (len(count), 1))
    states = np.zeros((len(count), FAN, 8), np.uint32)
    for slot in range(FAN):
        have = np.flatnonzero(count > slot)
        states[have, slot] = now[have]
        now[have] = S.compress(now[have], words[have * FAN + slot])
    return S.digest(S.compress(now, S.end_block(count))), states


def _builder(depth_of_block: int):
    def build_block(table: pa.Table) -> pa.Table:
        order = np.argsort(table["pos"].to_numpy(), kind="stable")
        levels, states = [_matrix(table["digest"])[order]], []
        total = table["n"][0].as_py()
        for _ in range(_depth(total, depth_of_block)):
            above, state = parents(levels[-1])
            levels.append(above)
            states.append(S.state_bytes(state))
        return pa.table({"key": table["key"][:1], "blk": table["blk"][:1], "n": pa.array([total], pa.int64()),
                         "nodes": pa.array([[x.tobytes() for x in levels[:-1]]], pa.list_(pa.binary())),
                         "states": pa.array([states], pa.list_(pa.binary())),
                         "root": pa.array([levels[-1].tobytes()], pa.binary())})
    return build_block


class Block:
    """A stored block, read back."""

    def __init__(self, row: dict):
        self.nodes = [np.frombuffer(x, np.uint8).reshape(-1, 32) for x in row["nodes"]]
        self.states = [S.states_of(x).reshape(-1, FAN, 8) for x in row["states"]]

    def step(self, level: int, at: int) -> dict:
        """Slot, run and state of one node of a level."""
        run, slot = divmod(at, FAN)
        return {"slot": slot, "run": self.nodes[level][run * FAN:(run + 1) * FAN].tobytes(),
                "state": S.state_bytes(self.states[level][run, slot])}


def _hander(span: int):
    def hand_down(blocks: pa.Table, paths: pa.Table) -> pa.Table:
        """The path of every child of a block: its steps inside the block, then the block's own path."""
        row, path = blocks.to_pylist()[0], paths.to_pylist()[0]
        block = Block(row)
        n = len(block.nodes[0]) if block.nodes else 1
        steps = [[block.step(k, i // FAN ** k) for k in range(len(block.nodes))] + path["steps"] for i in range(n)]
        return pa.table({"key": pa.array([row["key"]] * n), "pos": pa.array(row["blk"] * span + np.arange(n)),
                         "steps": pa.array(steps, STEP_TYPE), "subroot": pa.array([path["subroot"]] * n, pa.binary()),
                         "root": pa.array([path["root"]] * n, pa.binary())})
    return hand_down


STEP_TYPE = pa.list_(pa.struct([("slot", pa.int32()), ("run", pa.binary()), ("state", pa.binary())]))


def resume(states: np.ndarray, digests: np.ndarray, right: list[tuple[np.ndarray, np.ndarray]], count: np.ndarray
           ) -> np.ndarray:
    """Digests of parents whose ``states`` go on with ``digests``, then with their right siblings.

    ``right`` lists, for the first, second, ... sibling, the rows that have one and its digest.
    """
    now = S.compress(states, S.hex_block(digests))
    for rows, nodes in right:
        now[rows] = S.compress(now[rows], S.hex_block(nodes))
    return S.digest(S.compress(now, S.end_block(count)))


def fold(block: Block, steps: list[dict], at: np.ndarray, digests: np.ndarray) -> np.ndarray:
    """The root that each row's tree has when its leaf, at position ``at`` of the block, is ``digests``."""
    for nodes, states in zip(block.nodes, block.states):
        run, slot = np.divmod(at, FAN)
        count = np.minimum(FAN, len(nodes) - run * FAN)
        right = [(rows, nodes[at[rows] + k]) for k in range(1, FAN)
                 if len(rows := np.flatnonzero(slot + k < count))]
        digests, at = resume(states[run, slot], digests, right, count), run
    # rows of a block share the steps above it, and so does every row whose block root is equal
    distinct, back = np.unique(digests, axis=0, return_inverse=True)
    for step in steps:
        run = np.frombuffer(step["run"], np.uint8).reshape(-1, 32)
        every = np.arange(len(distinct))
        right = [(every, np.broadcast_to(run[k], distinct.shape)) for k in range(step["slot"] + 1, len(run))]
        distinct = resume(np.broadcast_to(S.states_of(step["state"]), (len(distinct), 8)), distinct, right,
                          np.full(len(distinct), len(run)))
    return distinct[back.reshape(-1)]


def proofs(block: Block, steps: list[dict], at: np.ndarray) -> list[str]:
    """SHA-256 of the siblings' digests as hex text, level by level, left to right."""
    runs = [[nodes[k:k + FAN].tobytes().hex().encode() for k in range(0, len(nodes), FAN)] for nodes in block.nodes]
    above = b""
    for step in steps:
        run, k = step["run"].hex().encode(), 64 * step["slot"]
        above += run[:k] + run[k + 64:]
    out = []
    for i in at.tolist():
        h = hashlib.sha256()
        for level in runs:
            i, slot = divmod(i, FAN)
            h.update(level[i][:64 * slot])
            h.update(level[i][64 * (slot + 1):])
        h.update(above)
        out.append(h.hexdigest())
    return out


def _auditor(span: int):
    def audit_block(leaves: pa.Table, blocks: pa.Table) -> pa.Table:
        row = blocks.to_pylist()[0]
        block, at = Block(row), leaves["pos"].to_numpy() % span
        root = row["root"].hex()
        folded = [x.tobytes().hex() for x in fold(block, row["steps"], at, _matrix(leaves["version"]))]
        n = len(at)
        return pa.table({"id": leaves["id"], "leaf": pa.array([x.hex() for x in leaves["digest"].to_pylist()], pa.string()),
                         "subroot": pa.array([row["subroot"].hex()] * n, pa.string()),
                         "root": pa.array([root] * n, pa.string()),
                         "proof_sha256": pa.array(proofs(block, row["steps"], at), pa.string()),
                         "folded_root": pa.array(folded, pa.string()), "verified": pa.array([x == root for x in folded])})
    return audit_block


# --- the trees ------------------------------------------------------------------------------
def _tiers(nodes: DataFrame, levels: int, name: str) -> list[DataFrame]:
    """The stored blocks over (key, pos, digest, n), tier by tier, until every key has one node."""
    tiers, span = [], FAN ** levels
    while True:
        blocks = stored(nodes.select("key", F.expr(f"pos div {span}").alias("blk"), "pos", "digest", "n")
                        .groupBy("key", "blk").applyInArrow(_builder(levels), BLOCK), name)
        tiers.append(blocks)
        nodes = blocks.where(F.col("n") > span).select(
            "key", F.col("blk").alias("pos"), F.col("root").alias("digest"),
            F.expr(f"(n + {span - 1}) div {span}").alias("n"))
        if nodes.isEmpty():
            return tiers


def _tops(tiers: list[DataFrame], levels: int) -> DataFrame:
    """(key, digest) of the node that remains of each key."""
    out = None
    for blocks in tiers:
        done = blocks.where(F.col("n") <= FAN ** levels).select("key", F.col("root").alias("digest"))
        out = done if out is None else out.unionByName(done)
    return out


def _children(blocks: DataFrame, paths: DataFrame, levels: int) -> DataFrame:
    """(key, pos, steps, subroot, root): the paths of the blocks' children."""
    return (blocks.groupBy("key", "blk").cogroup(paths.groupBy("key", "blk"))
            .applyInArrow(_hander(FAN ** levels), PATH.replace("blk", "pos")))


def _block_paths(tiers: list[DataFrame], above: DataFrame, levels: int) -> DataFrame:
    """(key, blk, steps, subroot, root) of the lowest tier's blocks, handed down from ``above`` (per key)."""
    paths = None
    for k in range(len(tiers) - 1, -1, -1):
        tops = tiers[k].where(F.col("n") <= FAN ** levels).select(
            F.col("key").alias("_key"), F.col("blk").alias("_blk")).join(above, F.col("_key") == F.col("key"))
        tops = tops.select(F.col("_key").alias("key"), F.col("_blk").alias("blk"), "steps", "subroot", "root")
        if paths is not None:
            below = _children(tiers[k + 1], paths, levels)
            tops = tops.unionByName(below.withColumnRenamed("pos", "blk"))
        paths = tops
    return paths


@dataclass
class Manifest:
    """The stored tree: leaves (key, pos, id, digest, version) and blocks with paths (key, blk, ...)."""

    leaves: DataFrame
    blocks: DataFrame
    levels: int


def build(docs: DataFrame, fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id", group_col: str = "source",
          versions: dict[str, F.Column] | None = None, levels: int = LEVELS) -> Manifest:
    """The manifest of ``docs``; ``versions`` gives other values of some fields, kept as second leaf digests."""
    ident, group = F.col(f"`{id_col}`"), F.col(f"`{group_col}`").cast("string")
    own = [F.col(f"`{f}`") for f in fields]
    digest = leaf(own)
    version = leaf([versions.get(f, c) for f, c in zip(fields, own)]) if versions else digest
    # a null group stands first, and no key is null
    rows = docs.select(F.coalesce(F.concat(F.lit("="), group), F.lit("")).alias("key"), ident.alias("id"),
                       F.unhex(digest).alias("digest"), F.unhex(version).alias("version"))
    leaves = stored(numbered(rows, "key", ["id", "digest"], "pos", "n", "merkle-rows"), "merkle-leaves")
    tiers = _tiers(leaves, levels, "merkle-blocks")
    tops = stored(numbered(_tops(tiers, levels).select(F.col("key").alias("group"), "digest", F.lit("").alias("key")),
                           "key", ["group"], "pos", "n", "merkle-tops"), "merkle-groups")
    upper = _tiers(tops, levels, "merkle-roots")
    top = _tops(upper, levels).select("key", F.array().cast(STEP).alias("steps"),
                                      F.lit(None).cast("binary").alias("subroot"), F.col("digest").alias("root"))
    found = _children(upper[0], _block_paths(upper, top, levels), levels).drop("subroot")
    above = (tops.select("group", "key", "pos", F.col("digest").alias("subroot")).join(found, ["key", "pos"])
             .select(F.col("group").alias("key"), "steps", "subroot", "root"))
    blocks = tiers[0].drop("n", "root").join(_block_paths(tiers, above, levels), ["key", "blk"])
    return Manifest(leaves, stored(blocks, "merkle-manifest"), levels)


def audit(manifest: Manifest, id_col: str = "doc_id") -> DataFrame:
    """Per leaf: id, leaf, subroot, root, proof_sha256, folded_root of its version, verified."""
    leaves, span = manifest.leaves, FAN ** manifest.levels
    schema = (f"id {leaves.schema['id'].dataType.simpleString()}, leaf string, subroot string, root string, "
              "proof_sha256 string, folded_root string, verified boolean")
    grouped = leaves.withColumn("blk", F.expr(f"pos div {span}")).groupBy("key", "blk")
    return (grouped.cogroup(manifest.blocks.groupBy("key", "blk")).applyInArrow(_auditor(span), schema)
            .withColumnRenamed("id", id_col))
