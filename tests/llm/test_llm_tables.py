"""Sharding, cross-tokenizer alignment and the Merkle manifest against brute force, and their edges."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import tokenizers
from pyspark.sql import functions as F
from test_llm_operators import CLASH, EDGES, clashing, edges, empty

from wordmill.llm import align, merkle, shards
from wordmill.llm import sha256 as S
from wordmill.llm.positions import numbered

DOCS = "doc_id long, text string"
FULL = "doc_id long, source string, lang string, n_chars long, text string"


# --- positions -------------------------------------------------------------------------

def test_numbered_is_dense_per_key(spark):
    df = spark.range(5000).select((F.col("id") % 7).cast("string").alias("k"), (F.lit(9999) - F.col("id")).alias("v"),
                                  F.lit(1).alias("_part"), F.lit(2).alias("_PLACE"))
    got = numbered(df, "k", ["v"], "at", "n").collect()
    by = defaultdict(list)
    for r in got:
        assert (r["_part"], r["_PLACE"]) == (1, 2)
        by[r.k].append((r["at"], r.v, r.n))
    for found in by.values():
        found.sort()
        assert [x[0] for x in found] == list(range(len(found))) and {x[2] for x in found} == {len(found)}
        assert [x[1] for x in found] == sorted(x[1] for x in found)


# --- sharding --------------------------------------------------------------------------

def test_place_takes_the_highest_dot_product():
    rng = np.random.default_rng(3)
    vectors = rng.random((300, 3)) / 40
    got = shards.place(vectors, 8)
    residual, weight = np.ones((8, 3)), np.array([4.0, 1.0, 1.0])
    for k in sorted(range(300), key=lambda k: (-max(vectors[k]), k)):
        best = max(range(8), key=lambda s: (float((vectors[k] * weight) @ residual[s]).__round__(12), -s))
        assert got[k] == best
        residual[best] -= vectors[k]


def check_shards(rows, docs, n_shards):
    assert sorted((r.doc_id is None, r.doc_id) for r in rows) == sorted((i is None, i) for i, _ in docs)
    texts = defaultdict(list)
    for i, t in docs:
        texts[i].append(t or "")
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
        assert (r["size"], r.text_crc32) in {(len(t.encode()) + 16, zlib.crc32(t.encode())) for t in texts[r.doc_id]}
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < n_shards
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


@pytest.mark.parametrize("fine,slice_groups,spread", [(256, 100_000, 0.03), (2, 400, 0.15)])
def test_sharding_balances_and_keeps_groups(spark, monkeypatch, fine, slice_groups, spread):
    """At other bounds many groups go through slices and a few coarse bins instead of being packed one by one."""
    monkeypatch.setattr(shards, "FINE", fine)
    monkeypatch.setattr(shards, "SLICE_GROUPS", slice_groups)
    rng = random.Random(5)
    docs = [(k, " ".join(rng.choices(["alpha", "b", "gamma delta", "é"], k=1 + int(rng.paretovariate(1.2)) % 300)) + str(k % 1700))
            for k in range(2000)]
    docs += [(10_000 + k, "the hot copy of a third of all rows") for k in range(1000)]
    n = 10
    rows = shards.assign(spark.createDataFrame(docs, DOCS), n_shards=n).collect()
    check_shards(rows, docs, n)
    size, count, where = Counter(), Counter(), defaultdict(set)
    texts = dict(docs)
    for r in rows:
        size[r.shard] += r["size"]
        count[r.shard] += 1
        where[texts[r.doc_id]].add(r.shard)
    assert max(size.values()) - min(size.values()) < spread * sum(size.values()) / n
    assert max(count.values()) - min(count.values()) < 0.2 * len(rows) / n    # bytes weigh more
    assert len(where["the hot copy of a third of all rows"]) > 1
    assert all(len(s) == 1 for t, s in where.items() if not t.startswith("the hot"))


def test_sharding_edges(spark):
    rows = shards.assign(edges(spark), n_shards=4).collect()
    check_shards(rows, EDGES, 4)
    assert shards.assign(empty(spark), n_shards=4).count() == 0
    same = shards.assign(edges(spark).repartition(7), n_shards=4).collect()
    assert sorted(map(repr, same)) == sorted(map(repr, rows))
    counted = shards.assign(edges(spark), n_shards=4, tokens=F.length("text")).collect()
    check_shards(counted, EDGES, 4)


# --- alignment -------------------------------------------------------------------------

PATHS = (P.path("byte_bpe_50k.json"), P.PATTERN, P.path("piece_bpe_32k.model"))
TEXTS = [None, "", "Plain words here.", "Plain words here.", "a▁b", "日本語テキスト、漢字", "  lead\n\n\ttrail  ", "é" * 60,
         "<|endoftext|> <s> </s> <0x41>", "ﬁne ① ½ 👩‍👩‍👧", " " * 3000 + "a", "x" * 5000, "id=Zx9_+kQ/7f==", "\u0000\u0001 control"]


LIBRARY = tokenizers.Tokenizer.from_file(PATHS[0])
LIBRARY.encode_special_tokens = True


def brute_groups(a, b, text):
    """Groups by the set of byte offsets where tokens of both sides end."""
    raw = b" " + (text or "").encode()
    ids_a = LIBRARY.encode(" " + text, add_special_tokens=False).ids if text else []
    ids_b = b.model.encode(text) if text else []
    if not text or b"".join(a.bytes[i] for i in ids_a) != raw or b"".join(b.bytes[i] for i in ids_b) != raw:
        return []

    def ends(ids, table):
        at, out = 0, []
        for i in ids:
            at += len(table[i])
            out.append(at)
        return out
    end_a, end_b = ends(ids_a, a.bytes), ends(ids_b, b.bytes)
    groups, low = [], 0
    for cut in sorted(set(end_a) & set(end_b)):
        groups.append(([i for i, e in zip(ids_a, end_a) if low < e <= cut], [i for i, e in zip(ids_b, end_b) if low < e <= cut]))
        low = cut
    return groups


@pytest.mark.parametrize("frequent,chunk", [(1 << 18, 1 << 21), (3, 5), (0, 1)])
def test_alignment_equals_brute_force(spark, frequent, chunk):
    a, b = align.ByteLevel(*PATHS[:2]), align.Pieces(PATHS[2])
    docs = clashing(spark.createDataFrame(list(enumerate(TEXTS)), DOCS))
    got = {r.doc_id: r for r in align.aligned_documents(docs, *PATHS, frequent=frequent, chunk=chunk).collect()}
    assert len(got) == len(TEXTS)
    groups = [brute_groups(a, b, t) for t in TEXTS]
    links = [Counter((x, y) for p, q in g for x in p for y in q) for g in groups]
    held = Counter(pair for c in links for pair in c)
    most = defaultdict(int)
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    for k, (g, c) in enumerate(zip(groups, links)):
        text = ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in g)
        r = got[k]
        assert (r.n_a, r.n_b, r.n_groups) == (sum(len(p) for p, _ in g), sum(len(q) for _, q in g), len(g))
        assert r.groups_sha256 == (hashlib.sha256(text.encode()).hexdigest() if text else "")
        assert r.n_links == sum(c.values())
        assert r.count_sum == sum(n * held[pair] for pair, n in c.items())
        assert r.n_best == sum(n for pair, n in c.items() if held[pair] == most[pair[0]])


def test_ranks_of_the_file_encode_like_its_library():
    """Side A by ranks equals the library's own encoding, also for every plane's letters, signs and white space."""
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(PATHS[0])
    lib.encode_special_tokens = True
    side = align.ByteLevel(*PATHS[:2])
    assert side.ranked is not None
    texts = [t for t in TEXTS if t] + [" " * 300_000 + "x", "\n" * 300_000 + "x"]
    texts += [f"a{c}1{c} {c}b\n{c}" for k in range(0, 0x110000, 7) if not 0xD800 <= k < 0xE000 for c in [chr(k)]]
    ids, at = side(texts)
    for k, e in enumerate(lib.encode_batch_fast(texts, add_special_tokens=False)):
        assert ids[at[k]:at[k + 1]].tolist() == e.ids, texts[k][:20]


def test_alignment_returns_the_groups(spark):
    r = align.alignments(spark.createDataFrame([(1, "Plain words")], DOCS), *PATHS).first()
    assert hashlib.sha256(r.groups.encode()).hexdigest() == r.groups_sha256 and r.groups.count(";") == r.n_groups - 1
    assert align.aligned_documents(empty(spark), *PATHS).count() == 0


def test_pointer_jumping_over_a_long_chain():
    """Tokens that overlap in one chain of 100,000 links are one group."""
    n = 100_000
    ends_a = np.append(np.arange(2, 2 * n, 2), 2 * n)
    ends_b = np.append(np.arange(1, 2 * n, 2), 2 * n)
    a, b = align.terminals(ends_a, ends_b)
    assert set(a.tolist()) == {n} and set(b.tolist()) == {n}


# --- Merkle manifest -------------------------------------------------------------------

def test_sha256_states_resume():
    rng = np.random.default_rng(1)
    digests = rng.integers(0, 256, (50, 32)).astype(np.uint8)
    state = np.tile(S.START, (50, 1))
    text = [""] * 50
    for k in range(5):
        blocks = np.roll(digests, k, axis=0)
        state = S.states_of(S.state_bytes(S.compress(state, S.hex_block(blocks))))
        text = [t + x.tobytes().hex() for t, x in zip(text, blocks)]
    got = S.digest(S.compress(state, S.end_block(np.full(50, 5))))
    assert [x.tobytes().hex() for x in got] == [hashlib.sha256(t.encode()).hexdigest() for t in text]


def brute_audit(rows, tampered):
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r: digest("".join(map(field, r)))

    def tree(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            levels.append([digest("".join(levels[-1][k:k + 16])) for k in range(0, len(levels[-1]), 16)])
        return levels
    groups = defaultdict(list)
    for r in rows:
        groups[r[1]].append(r)
    names = sorted(groups, key=lambda k: (k is not None, (k or "").encode()))
    trees = {}
    for k in names:
        groups[k].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[k] = tree([leaf(r) for r in groups[k]])
    top = tree([trees[k][-1][0] for k in names])
    for at, k in enumerate(names):
        for i, r in enumerate(groups[k]):
            now, kin = leaf(tampered(r)), ""
            for levels, pos in ((trees[k], i), (top, at)):
                for nodes in levels[:-1]:
                    first, slot = pos // 16 * 16, pos % 16
                    run = nodes[first:first + 16]
                    kin += "".join(run[:slot] + run[slot + 1:])
                    now, pos = digest("".join(run[:slot] + [now] + run[slot + 1:])), pos // 16
            yield (r[0], leaf(r), trees[k][-1][0], top[-1][0], digest(kin), now, now == top[-1][0])


def audited(df, levels=3):
    hit = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0
    return merkle.audit(merkle.build(df, versions={"text": F.when(hit, F.lower("text")).otherwise(F.col("text"))}, levels=levels))


def tampered(r):
    hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
    return (*r[:4], r[4].lower() if hit and r[4] else r[4])


@pytest.mark.parametrize("levels", [3, 1])
def test_merkle_equals_brute_force(spark, levels):
    """With one level a block, trees of a few hundred rows have several tiers."""
    rng = random.Random(2)
    rows = [(k, None if k % 13 == 0 else "hot" if k % 3 else f"s{k % 29}", None if k % 5 else "en", k * 3,
             rng.choice([None, "", f"Text {k} Ä", "Equal"])) for k in range(300)]
    rows += [(7, "dup", "x", 1, "Same")] * 3 + [(None, "dup", None, None, "N")] * 2 + [(99_999, "solo", "l", 2, "A b")]
    rows += [(7, "dup", "x", 1, "Other text of one id"), (5, "big", None, None, "w " * 50_000)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, FULL).select("*", *(F.lit(1).alias(c) for c in [*CLASH, "key", "pos", "digest", "blk"]))
    got = [tuple(r) for r in audited(df, levels).collect()]
    assert sorted(got, key=repr) == sorted(brute_audit(rows, tampered), key=repr)
    assert {r[6] for r in got} == {True, False}


def test_merkle_edges(spark):
    one = [(1, "s", None, None, None)]
    assert [tuple(r) for r in audited(spark.createDataFrame(one, FULL)).collect()] == list(brute_audit(one, tampered))
    assert audited(spark.createDataFrame([], FULL)).count() == 0
