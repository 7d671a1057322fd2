"""The operators against brute-force versions, and their defined results at the edges."""

import hashlib
import itertools
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from wordmill.llm import (bpe_duckdb, chat_format, decontaminate, exact_dedup, html_text, language_id, lattice,
                          line_dedup, ngram_join, secret_scan, token_counts)
from wordmill.llm.components import connected_components
from wordmill.llm.pretokens import PreTokens, rank_file

RANKS = P.path("byte_bpe_multi_50k.tiktoken")
DOCS = "doc_id long, text string"
LONG = "lorem ipsum dolor " * 6000
#: Nulls, empty, blank, very long, non-ASCII, repeated rows and equal texts.
EDGES = [(1, None), (2, ""), (3, " \t\n "), (4, LONG), (5, "Ünïcode — 中文 text"), (6, "same words here"),
         (7, "same  words here"), (7, "same  words here"), (None, "same words here"), (8, "\n\n"), (9, "x" * 3000),
         (10, "!!! 123 ???")]
#: Extra columns, among them names that the operators use inside.
CLASH = ["_id", "_norm", "_keep", "_rows", "_doc", "_row", "_cut", "_some", "_hit", "row", "kind", "id", "seg", "_text",
         "class", "_lang_pred", "_score", "n_tokens", "word"]


def clashing(df):
    return df.select("*", *(F.lit(k).alias(c) for k, c in enumerate(CLASH)))


def edges(spark):
    return clashing(spark.createDataFrame(EDGES, DOCS))


def empty(spark):
    return clashing(spark.createDataFrame([], DOCS))


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def test_number_signs_are_no_letters(spark):
    docs = [(1, "½ ② Ⅷ"), (2, "٣٤ 12"), (3, "the word")]
    model = language_id.train(spark.createDataFrame([(9, "the word and more", "en")], DOCS + ", lang string"), RANKS)
    got = {r.doc_id: (r.lang_pred, r.score) for r in language_id.predict(spark.createDataFrame(docs, DOCS), model).collect()}
    assert got[1] == got[2] == ("und", 0.0) and got[3][0] == "en"


# --- exact dedup -----------------------------------------------------------------------

def test_exact_dedup_edges(spark):
    got = exact_dedup.duplicate_groups(edges(spark)).collect()
    assert len(got) == len(EDGES)
    by = defaultdict(list)
    for r in got:
        by[r.text_sha256].append(r)
    groups = defaultdict(list)
    for i, t in EDGES:
        groups[re.sub(r"[\x20\x09-\x0d]+", " ", t or "")].append(i)
    assert len(by) == len(groups)
    for norm, ids in groups.items():
        here = by[hashlib.sha256(norm.encode()).hexdigest()]
        keep = min(i for i in ids if i is not None)
        assert {(r.keep_id, r.group_size) for r in here} == {(keep, len(ids))}
        assert sorted((r.doc_id is None, r.doc_id) for r in here) == sorted((i is None, i) for i in ids)
        assert all(r.kept == (r.doc_id == keep) for r in here)
    assert exact_dedup.duplicate_groups(empty(spark)).count() == 0
    kept = exact_dedup.drop_duplicates(edges(spark))
    assert kept.columns == edges(spark).columns
    assert rows(kept, "doc_id") == rows(spark.createDataFrame([(i,) for i in (1, 3, 4, 5, 6, 9, 10)], "doc_id long"), "doc_id")


def test_different_texts_under_one_id_stay(spark):
    """Rows without an id or with the same one, but other texts, are other documents; the rows kept do not hang on partitions."""
    docs = [(None, "alpha text one"), (None, "quite other words here"), (1, "a b c"), (1, "x y z"), (1, "x y z"),
            (2, "x  y z"), (3, "lone")]
    df = clashing(spark.createDataFrame(docs, DOCS))
    want = [(None, "alpha text one"), (None, "quite other words here"), (1, "a b c"), (1, "x y z"), (3, "lone")]
    for parts in (1, 5):
        again = df.repartition(parts)
        assert rows(exact_dedup.drop_duplicates(again), "doc_id", "text") == sorted(want, key=repr)
        near = ngram_join.drop_near_duplicates(again)
        assert near.columns == df.columns and rows(near, "doc_id", "text") == sorted(want, key=repr)


@pytest.mark.parametrize("salts", [1, 3, 64])
def test_exact_dedup_hot_group(spark, salts):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot copy")
                                  .otherwise(F.concat(F.lit("doc "), F.col("id").cast("string"))).alias("text"))
    got = exact_dedup.duplicate_groups(df, salts=salts)
    assert got.where("group_size = 1000 and keep_id = 0").count() == 1000
    assert got.where("kept").count() == 2001


# --- decontamination -------------------------------------------------------------------

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_hits(docs, items, window):
    out = {}
    for d, t in docs:
        w, hit, ids = words(t), set(), set()
        for i, s in items:
            v = words(s)
            n = min(window, len(v))
            for a in range(len(v) - n + 1 if n else 0):
                for b in range(len(w) - n + 1):
                    if w[b:b + n] == v[a:a + n]:
                        hit |= set(range(b, b + n))
                        ids.add(str(i))
        out[d] = (len(w), len(hit), sorted(ids))
    return out


@pytest.mark.parametrize("how", [{}, {"piece_words": 2, "block_words": 5}])
def test_decontamination_random(spark, how):
    rng = random.Random(5)
    vocabulary = ["a", "b", "c", "Dé", "ee"]
    docs = [(i, " ".join(rng.choices(vocabulary, k=rng.randrange(0, 60)))) for i in range(60)]
    items = [(100 + i, "-".join(rng.choices(vocabulary, k=rng.randrange(0, 9)))) for i in range(12)] + [(7, None), (8, "?!")]
    docs += [(60 + k, f"x {items[k][1]} y, {items[k][1]}") for k in range(12)]
    got = decontaminate.contamination(spark.createDataFrame(docs, DOCS).repartition(3),
                                      spark.createDataFrame(items, "item_id long, text string"), window=4, **how)
    assert {r.doc_id: (r.n_words, r.n_hit, r.item_ids) for r in got.collect()} == brute_hits(docs, items, 4)


def test_decontamination_blocks_and_proximity(spark):
    docs = spark.createDataFrame([(1, "one two x three four five"), (2, "one two three four five"),
                                  (3, "two one four three five"), (4, "five four")], DOCS)
    items = spark.createDataFrame([(9, "one two three four five"), (10, "five four")], "item_id long, text string")
    index = decontaminate.build_index(docs)
    found = decontaminate.search(index, items, window=5, slop=1, piece_words=1, block_words=3).join(index.documents, ["seg", "ord"])
    assert rows(found.where("exact"), "doc_id", "item_id", "doc_start", "length") == [(2, 9, 0, 5), (4, 10, 0, 2)]
    near = {(r.doc_id, r.item_id) for r in found.where("not exact").collect()}
    assert {(1, 9), (2, 9), (3, 9), (4, 10)} <= near


def test_decontamination_edges(spark):
    items = spark.createDataFrame([(1, "same words here"), (1, "same words here"), (2, None), (3, ""), (None, "123")],
                                  "item_id long, text string")
    got = decontaminate.contamination(edges(spark), items)
    assert got.count() == len(EDGES)
    assert rows(got.where("n_hit > 0"), "doc_id", "n_hit") == sorted([(6, 3), (7, 3), (7, 3), (None, 3), (10, 1)], key=repr)
    assert decontaminate.contamination(empty(spark), items).count() == 0
    assert decontaminate.contamination(edges(spark), items.limit(0)).where("n_hit > 0").count() == 0
    left = decontaminate.drop_contaminated(edges(spark), items)
    assert left.columns == edges(spark).columns and left.count() == len(EDGES) - 5


def test_postings_pack():
    rng = np.random.default_rng(3)
    lists = [np.unique(rng.integers(0, 10 ** k, 1 + 5 * k)) for k in range(1, 11)]
    cut = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
    order, width, gaps = decontaminate.pack(np.concatenate(lists), cut)
    for k, w, g in zip(order, width, gaps.to_pylist()):
        assert (decontaminate.unpack(int(w), g) == lists[k]).all()


# --- line dedup ------------------------------------------------------------------------

def within_one(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def brute_lines(docs):
    seen, out = [], {}
    for d, text in sorted(docs):
        kept = []
        for line in (text or "").split("\n"):
            c = re.sub(r"[\x09-\x0d\x20]+", " ", line).strip(" ")
            drop = c != "" and any(c == s or (min(len(c), len(s)) >= line_dedup.MIN_EDIT and within_one(c, s)) for s in seen)
            if c:
                seen.append(c)
            if not drop:
                kept.append(line)
        out[d] = "\n".join(kept)
    return out


def edited(rng, line):
    k = rng.randrange(len(line))
    return rng.choice([line[:k] + line[k + 1:], line[:k] + "é" + line[k:], line[:k] + "Z" + line[k + 1:],
                       line[:k] + "Q" + line[k:] + "Q"])


def test_line_dedup_random(spark):
    rng = random.Random(11)
    base = ["".join(rng.choices("ab cé", k=n)) for n in (5, 14, 15, 16, 17, 18, 30, 47, 48, 49, 50, 64, 97, 300, 2000)]
    pool = list(base)
    for _ in range(120):
        pool.append(edited(rng, rng.choice(pool)))
    docs = [(d, "\n".join(rng.choice(pool + ["", "  "]) for _ in range(rng.randrange(1, 7)))) for d in range(60)]
    got = line_dedup.drop_duplicate_lines(spark.createDataFrame(docs, DOCS), counts=("n", "dropped"))
    want = brute_lines(docs)
    assert {r.doc_id: r.text for r in got.collect()} == want


def test_line_dedup_edges(spark):
    got = line_dedup.drop_duplicate_lines(edges(spark), counts=("n", "dropped"))
    assert got.columns == [*edges(spark).columns, "n", "dropped"] and got.count() == len(EDGES)
    kept = {(r.doc_id, r.text) for r in got.collect()}
    assert (1, None) in kept and (None, "same words here") in kept and (6, "") in kept
    left = line_dedup.drop_duplicate_lines(edges(spark))
    assert left.columns == edges(spark).columns and 6 not in {r.doc_id for r in left.collect()}
    assert line_dedup.drop_duplicate_lines(empty(spark)).count() == 0


def test_line_dedup_hot_line(spark):
    df = spark.range(900).select(F.col("id").alias("doc_id"), F.concat_ws(
        "\n", F.lit("the one line that every document has"), F.concat(F.lit("own "), F.md5(F.col("id").cast("string"))))
        .alias("text"))
    got = line_dedup.drop_duplicate_lines(df, counts=("n", "dropped"))
    assert rows(got.groupBy("dropped").count(), "dropped", "count") == [(0, 1), (1, 899)]


# --- language ID -----------------------------------------------------------------------

def brute_log_p(word, vocabulary, log_p):
    raw = word.encode()
    alpha = np.full((len(raw) + 1, log_p.shape[1]), -np.inf)
    alpha[0] = 0
    ids = {p: i for i, p in enumerate(vocabulary)}
    for e in range(1, len(raw) + 1):
        for s in range(e):
            if raw[s:e] in ids:
                alpha[e] = np.logaddexp(alpha[e], alpha[s] + log_p[ids[raw[s:e]]])
    return alpha[-1]


def test_forward_sums_all_segmentations():
    vocabulary = [bytes([b]) for b in range(256)] + [b"ab", b"abc", b"ca", b" a", b"bcab", "é".encode()]
    rng = np.random.default_rng(1)
    log_p = np.log(rng.dirichlet(np.ones(len(vocabulary)), 3).T)
    ws = [" a", " abcab", " abca", " é", " écabcabcabca", " z" * 40]
    forward = language_id.Forward(pa.array(ws), lattice.Pieces(vocabulary))
    got = forward.sums(log_p)[forward.trie.terminal]
    for w, g in zip(ws, got):
        assert np.allclose(g, brute_log_p(w, vocabulary, log_p))


def test_expected_counts_raise_the_likelihood():
    ranks = rank_file(RANKS)
    vocabulary = sorted(ranks, key=ranks.get)
    data = {"x": {" alpha": 3, " alphabet": 2, " beta": 1}, "y": {" gamma": 5, " gamut": 1}}
    rows_ = [(lang, w, n) for lang, c in data.items() for w, n in c.items()]
    counted = pa.table(dict(zip(("lang", "word", "n"), map(list, zip(*rows_)))))
    models = [language_id.fit(counted, vocabulary, rounds=k, smoothing=1e-6) for k in (1, 2, 5)]

    def total(m):
        f = language_id.Forward(pa.array([w for c in data.values() for w in c]), lattice.Pieces(vocabulary))
        s = f.sums(m.log_p)[f.trie.terminal]
        return 3 * s[0, 0] + 2 * s[1, 0] + s[2, 0] + 5 * s[3, 1] + s[4, 1]
    assert total(models[0]) < total(models[1]) < total(models[2])


def test_language_id_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = language_id.train(docs.where(~language_id.held_out()), RANKS)
    got = language_id.predict(docs.withColumn("h", language_id.held_out()), model).where("h").collect()
    assert got and sum(r.lang == r.lang_pred for r in got) >= 0.95 * len(got)
    assert all(0 <= r.score <= 1 for r in got)


def test_language_id_edges(spark):
    docs = edges(spark).withColumn("lang", F.when(F.col("doc_id") < 6, "la").when(F.col("doc_id") < 8, "en"))
    model = language_id.train(docs, RANKS)
    got = language_id.predict(docs, model)
    by = {r.doc_id: (r.lang_pred, r.score) for r in got.collect()}
    assert got.count() == len(EDGES) and all(by[i] == ("und", 0.0) for i in (1, 2, 3, 8, 10))
    assert by[4][0] == "la" and by[6][0] == "en"
    none = language_id.train(docs.withColumn("lang", F.lit(None).cast("string")), RANKS)
    assert {r.lang_pred for r in language_id.predict(docs, none).collect()} == {"und"}
    assert language_id.predict(docs.limit(0), language_id.train(docs.limit(0), RANKS)).count() == 0


def test_language_id_learns_from_all_documents(spark):
    # 1,500 short documents a label and one of 600,000 letters; each with a word of its own
    docs = [(k, f"{lang}word {lang}{k}x", lang) for lang, base in (("la", 0), ("en", 10_000)) for k in range(base, base + 1500)]
    docs.append((99_999, "longest " * 75_000, "la"))
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    counted = Counter((lang, w) for _, t, lang in docs for w in (" " + x for x in re.findall("[a-z]+", t)))
    ranks = rank_file(RANKS)
    table = pa.table(dict(zip(("lang", "word", "n"), map(list, zip(*((*k, n) for k, n in counted.items()))))))
    want = language_id.fit(table, sorted(ranks, key=ranks.get))
    got = language_id.train(df, RANKS)
    assert got.languages == want.languages and np.allclose(got.log_p, want.log_p, atol=1e-3)
    assert (got.log_p == language_id.train(df.repartition(5), RANKS).log_p).all()


def test_least_fit_is_exact(spark):
    values = np.random.default_rng(3).normal(-1.5, 0.2, 4_321)
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    low, middle = np.quantile(values, [0.01, 0.5])
    assert np.isclose(language_id.least_fit(df), low - (middle - low), rtol=0, atol=1e-12)
    assert language_id.least_fit(df.limit(0)) == -np.inf and language_id.least_fit(df.limit(1)) == df.first()[0]


# --- secret scans ----------------------------------------------------------------------

def brute_base(text):
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    spans = [(m.start(), 0, "assign", m.end()) for m in assign.finditer(text) if len(m[2]) >= 8]
    spans += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    spans += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(spans))


def test_secret_base_spans(spark):
    rng = random.Random(2)
    parts = ["password", "token", "Api_Key", "APIKEY", "secret", ":", "=", " ", '"', "'", "abc", "12345678", "AKIA", "é",
             "ABCDEFGHIJKL", "0123456789abcdef" * 2, "deadbeef", ".", "/+", "\n", "中"]
    docs = [(i, "".join(rng.choices(parts, k=rng.randrange(1, 25)))) for i in range(300)]
    got = secret_scan.scan_documents(spark.createDataFrame(docs, DOCS))
    assert {r.doc_id: r.base for r in got.collect()} == {i: brute_base(t) for i, t in docs}


def test_secret_markov_spans(spark):
    rng = random.Random(4)
    b64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    known = [(i, "token = " + "".join(rng.choices(b64, k=32))) for i in range(200)]
    part = "cus tom er or der to tal price get user name from ac count con nec tion pool size lim it val ue".split()
    plain = [(1000 + i, " ".join("".join(rng.choices(part, k=rng.randrange(2, 4))) + "_" + rng.choice(part) for _ in range(20))
              + " customer_order_total_price connection_pool_size_limit_2024") for i in range(100)]
    bare = "".join(rng.choices(b64, k=40))
    docs = known + plain + [(5000, f"see {bare} there"), (5001, f"see {bare} there"), (5002, "first_name_of_the_customer_order")]
    got = {r.doc_id: r for r in secret_scan.scan_documents(spark.createDataFrame(docs, DOCS)).collect()}
    assert got[5000].spans == got[5001].spans == "random:4:44"
    assert got[5002].spans == "" and all(got[i].n_random == 0 for i, _ in plain)
    assert all(got[i].n_assign == 1 and got[i].n_random == 0 for i, _ in known)


def test_secret_edges(spark):
    got = secret_scan.scan_documents(edges(spark))
    assert got.count() == len(EDGES) and got.where("base != '' or n_assign + n_access + n_hex > 0").count() == 0
    assert secret_scan.scan_documents(empty(spark)).count() == 0


def test_log_ratios_prefer_what_was_seen():
    r = secret_scan.log_ratios({"aZ": 50, "a9": 50}, {"ab": 100})
    assert r["aZ"] > 0 > r["ab"] and len(r) == 66 * 66


# --- n-gram join -----------------------------------------------------------------------

def brute_near(docs, n=5, threshold=0.8):
    sets = {}
    for i, t in docs:
        w = WORD.findall((t or "").lower())
        sets[i] = {tuple(w[k:k + n]) for k in range(max(1, len(w) - n + 1))} if w else set()
    low, links = {i: i for i in sets}, Counter()

    def find(x):
        while low[x] != x:
            x = low[x]
        return x
    ids = sorted(sets)
    for a in range(len(ids)):
        for b in range(a + 1, len(ids)):
            x, y = sets[ids[a]], sets[ids[b]]
            if x and y and 10 * len(x & y) >= 8 * len(x | y):
                links[ids[a]] += 1
                links[ids[b]] += 1
                p, q = sorted((find(ids[a]), find(ids[b])))
                low[q] = p
    return {i: (find(i), links[i]) for i in sets}


def near_fixture(seed, groups=30):
    rng, docs = random.Random(seed), []
    for _ in range(groups):
        w = [rng.choice("alpha beta gamma delta épsilon zeta eta theta".split()) + str(rng.randrange(40))
             for _ in range(rng.randrange(1, 120))]
        for _ in range(rng.randrange(1, 6)):
            v = list(w)
            for _ in range(rng.randrange(0, 3)):
                v[rng.randrange(len(v))] = "other"
            docs.append((len(docs), " ".join(v)))
    return docs


@pytest.mark.parametrize("block", [512, 2])
def test_ngram_join_random(spark, block, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", block)  # with 2, every bucket is dealt out as pairs of blocks
    docs = near_fixture(3)
    got = ngram_join.near_duplicates(spark.createDataFrame(docs, DOCS))
    assert {r.doc_id: (r.class_id, r.n_links) for r in got.collect()} == brute_near(docs)


def test_ngram_join_hot_group(spark):
    words_ = [f"w{k}" for k in range(200)]
    docs = [(i, " ".join(words_[:i % 40 + 1] + ["x"] + words_[i % 40 + 1:])) for i in range(400)]
    docs += [(1000 + i, f"entirely different text number {i} of the corpus") for i in range(200)]
    got = {r.doc_id: (r.class_id, r.n_links, r.n_copies) for r in ngram_join.near_duplicates(
        spark.createDataFrame(docs, DOCS)).collect()}
    assert all(got[i] == (0, 399, 10) for i in range(400))
    assert all(got[1000 + i] == (1000 + i, 0, 1) for i in range(200))


def test_ngram_join_edges(spark):
    got = ngram_join.near_duplicates(edges(spark))
    assert got.count() == len(EDGES)
    by = {r.doc_id: r for r in got.collect()}
    assert all(by[i].class_id == i and by[i].n_links == 0 and by[i].kept for i in (1, 2, 3, 4, 5, 8, 9))
    assert by[6].class_id is None and by[6].n_links == 3 and not by[6].kept  # the null id is the smallest
    left = ngram_join.drop_near_duplicates(edges(spark))
    assert left.columns == edges(spark).columns
    assert sorted((r.doc_id is None, r.doc_id) for r in left.collect()) == sorted(
        (i is None, i) for i in (1, 2, 3, 4, 5, None, 8, 9, 10))
    assert ngram_join.near_duplicates(empty(spark)).count() == 0


def test_ngram_join_ids_of_several_texts(spark):
    def text(name, changed=False):
        return " ".join(f"{name}{k}" for k in range(60)) + (" other" if changed else " last")
    docs = [(5, text("a")), (8, text("a", True)), (5, text("b")), (9, text("b", True)),  # 5 is the smallest of both
            (13, text("c")), (15, text("c")), (15, text("d")), (17, text("d")),  # 15 is not
            (20, text("e")), (21, text("e")), (21, ""), (22, None), (22, "!")]
    got = Counter(tuple(r) for r in ngram_join.near_duplicates(spark.createDataFrame(docs, DOCS).repartition(3))
                  .select("doc_id", "class_id", "n_links", "n_copies", "kept").collect())
    assert got == Counter([(5, 5, 1, 1, True)] * 2 + [(8, 5, 1, 1, False), (9, 5, 1, 1, False), (13, 13, 1, 2, True)]
                          + [(15, 13, 1, 2, False)] * 2 + [(17, 13, 1, 2, False), (20, 20, 1, 2, True),
                                                           (21, 20, 1, 2, False), (21, 20, 0, 1, False)]
                          + [(22, 22, 0, 1, True)] * 2)


def test_choose_bands():
    rows_, bands = ngram_join.choose_bands(0.8, 0.9995)
    assert 1 - (1 - 0.8 ** rows_) ** bands >= 0.9995 and rows_ * bands <= 128
    with pytest.raises(ValueError):
        ngram_join.choose_bands(0.01, 0.999999, 4)


def test_components(spark):
    edges_ = [(k, k + 1) for k in range(1, 60)] + [(100, 200), (200, 150), (300, 300)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges_, "a long, b long")).collect()}
    assert got == {k: 1 for k in range(1, 61)} | {100: 100, 200: 100, 150: 100}


# --- HTML extraction -------------------------------------------------------------------

PAGES = [
    ("<html><head><title>T</title></head><body><nav><a href=/>Home</a></nav><div id=main><h1>Head &amp; line</h1>"
     "<p>One,\n two <b>bold</b>.<p>Two<br>lines, &eacute;&#33;</p><ul><li>a<li>b</ul></div><div class='side-bar sidebar'>"
     "<p>Links, of, all, sorts, are, here</p></div><footer>foot</footer></body></html>",
     "Head & line\n\nOne, two bold.\n\nTwo lines, é!\n\na\n\nb"),
    ("<body><article><header><h1>Title</h1><p>By me</p></header><p>Body text.</p><form><p>Sign up</p></form>"
     "<script>var a='<p>no</p>';</script></article><section id='comments'><article class='comment'><p>I, the reader, "
     "say, a, lot, of, things, with, commas</p></article></section></body>", "Title\n\nBody text."),
    ("<div class='cookie-notice'>We use cookies</div><div><p>Short.</p></div>", "Short."),
    ("<table><tr><td>1<td>2</tr><tr><td>3</table>", "1 2\n\n3"),
    ("just &lt;text&gt; and <i>more", "just <text> and more"),
    ("<p>cut off in <a hre", "cut off in"),
    ("<p style='display:none'>hidden</p><p hidden>x</p><p>seen</p>", "seen"),
    (None, ""), ("", ""), ("<!-- c --><br>", ""),
]


def test_main_text():
    for html, want in PAGES:
        assert html_text.main_text(html) == want, html
    assert html_text.main_text("<div>" * 20000 + "deep") == "deep"


def test_main_text_keeps_what_lies_beside_the_best_container():
    paras = [f"Paragraph {k}, with a comma." for k in range(20)]
    body = "".join(f"<p>{p}</p>" for p in paras)
    text = "\n\n".join(paras)
    links = "<ul><li><a href=/a>More of this</a><li><a href=/b>And of that</a></ul>"
    pages = [
        (f"<div><h1>T</h1><p>lead</p><div>{body}</div><p>end</p></div>", f"T\n\nlead\n\n{text}\n\nend"),
        (f"<div>bare <b>run</b><pre>code</pre><div>{body}</div><blockquote>said</blockquote><h3>Last</h3>tail</div>",
         f"bare run\n\ncode\n\n{text}\n\nsaid\n\nLast\n\ntail"),
        (f"<div><section>{body}</section><section><p>a</p><p>b</p></section></div>", f"{text}\n\na\n\nb"),
        (f"<div><div class=row><section>{body}</section></div><div class=row><section><p>a</p></section></div></div>",
         f"{text}\n\na"),
        (f"<div><h1>T</h1><p>lead</p><div><div>{body}</div></div></div>", f"T\n\nlead\n\n{text}"),
        (f"<div>{links}<h1><a href=/>T</a></h1><div>{body}</div>{links}<p><a href=/n>next</a></p><a href=/x>x</a></div>",
         f"T\n\n{text}"),
    ]
    for html, want in pages:
        assert html_text.main_text(html) == want, html


def test_main_text_keeps_the_wrapper_of_the_page():
    body = "".join(f"<p>Paragraph {k}, with a comma.</p>" for k in range(20))
    text = "\n\n".join(f"Paragraph {k}, with a comma." for k in range(20))
    foot = "<div class=footer>(c) the owner</div>"
    side = "<div class=sidebar><p>Links, of, all, sorts</p></div>"
    for tag in ("div id=wrapper class='has-sidebar'", "form id=aspnetForm", "div role=form", "div class='post comments-open'"):
        name = tag.split()[0]
        for head in ("", "<h1>T</h1>"):
            html = f"<body><{tag}><div>{head}{body}{side}</div></{name}>{foot}<span>left</span></body>"
            got = html_text.main_text(html)
            assert text in got and "Links" not in got and got.startswith("T" if head else "Paragraph 0"), (html, got)
    # parts beside the text go, though they hold most of the page
    notice = f"<div class=consent>{body}</div>"
    for html in (f"<div><h1>T</h1><p>Short.</p></div>{notice}", f"{notice}<div><h1>T</h1><p>Short.</p></div>",
                 f"<div><h1>T</h1><p>Short.</p></div><div id=comments>{body}</div>"):
        assert html_text.main_text(html) == "T\n\nShort.", html
    assert html_text.main_text(f"<div><p>Short.</p></div><div id=comments>{body}</div>") == "Short."


def test_extract_query(spark):
    df = clashing(spark.createDataFrame([(k, f"u{k}", h) for k, (h, _) in enumerate(PAGES)] + [(0, "u0", PAGES[0][0])],
                                        "page_id long, url string, html string"))
    got = html_text.extract(df)
    assert rows(got, "page_id", "text", "n_chars") == sorted(
        [(k, t, len(t)) for k, (_, t) in enumerate(PAGES)] + [(0, PAGES[0][1], len(PAGES[0][1]))], key=repr)
    assert html_text.extract(df.limit(0)).count() == 0


# --- BPE and token counts --------------------------------------------------------------

BPE_TEXTS = ["Hello  world, it's 2024!\n\n  naïve café 中文字 🙂🙂", "aaaa" * 300 + "b", "ab" * 700 + " " + "x" * 999,
             "thestationthe" * 30, " ", "\n \n", "ñandú" * 200, "<|endoftext|>", "z" * 20000]


def encoding():
    import tiktoken
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=rank_file(RANKS), special_tokens={})


def test_bpe_equals_the_public_library(spark):
    docs = [(k, t) for k, t in enumerate(BPE_TEXTS)] + EDGES
    df = clashing(spark.createDataFrame(docs, DOCS))
    enc = encoding()
    got = bpe_duckdb.encode(df, RANKS, P.PATTERN)
    want = [(i, enc.encode_ordinary(t or "")) for i, t in docs]
    assert rows(got, "doc_id", "token_ids") == sorted(want, key=repr)
    back = bpe_duckdb.decode(got, RANKS)
    assert sorted((r.doc_id, bytes(r.decoded).decode()) for r in back.collect() if r.doc_id is not None) == sorted(
        (i, t or "") for i, t in docs if i is not None)
    digest = {(r.ids_sha256, r.decoded_sha256) for r in bpe_duckdb.round_trip(df, RANKS, P.PATTERN).collect()}
    assert digest == {(hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                       hashlib.sha256((t or "").encode()).hexdigest()) for (_, t), (_, ids) in zip(docs, want)}
    assert bpe_duckdb.encode(df.limit(0), RANKS, P.PATTERN).count() == 0


def test_bpe_both_recursions_agree(monkeypatch):
    ranks = rank_file(RANKS)
    texts = [w for t in BPE_TEXTS[:8] for w in re.findall(r"\S+", t)][:40] + ["aaa", "aaaaa", "abab", "ababa"]
    enc = encoding()
    got = []
    for limit in (0, 1 << 20):
        monkeypatch.setattr(bpe_duckdb, "LONG_WORD", limit)
        codec = bpe_duckdb.Codec(ranks, memo_words=3)
        got.append([codec.words([t])[0] for t in texts])
    assert got[0] == got[1]
    assert [np.frombuffer(i, "<u4").tolist() for i, _ in got[0]] == [
        enc._core_bpe.encode_single_piece(t.encode()) for t in texts]


def brute_tokens(word, ranks, scores):
    raw, best = word.encode(), [(0, 0)]
    for e in range(1, len(raw) + 1):
        options = [(best[s][0] + int(scores[ranks[raw[s:e]]]), -best[s][1] - 1) for s in range(e) if raw[s:e] in ranks]
        top = max(options)
        best.append((top[0], -top[1]))
    return best[-1][1]


def test_token_counts(spark):
    ranks = rank_file(RANKS)
    docs = [(k, t) for k, t in enumerate(BPE_TEXTS[:4] + BPE_TEXTS[4:7])] + [e for e in EDGES if e[0] != 4]
    df = clashing(spark.createDataFrame(docs, DOCS))
    scores = token_counts.learn_scores(df, RANKS, P.PATTERN)
    assert (scores == token_counts.learn_scores(df.repartition(5), RANKS, P.PATTERN)).all() and len(set(scores.tolist())) > 50
    got = token_counts.token_counts(df, RANKS, P.PATTERN)
    find = PreTokens(P.PATTERN)._find
    want = [(i, len(find(t or "")), sum(brute_tokens(w, ranks, scores) for w in find(t or ""))) for i, t in docs]
    assert rows(got, "doc_id", "n_pretokens", "n_tokens") == sorted(want, key=repr)
    assert token_counts.token_counts(empty(spark), RANKS, P.PATTERN).count() == 0


def test_token_scores_learn_from_all_documents(spark):
    # 3 MB in 1,500 documents and one text of 400,000 bytes: more than a sample would hold
    docs = [(k, f"common words again and a {k * 7919 % 1000}xy " * 60) for k in range(1500)] + [(9_999, "zebras grazed " * 28_600)]
    df = spark.createDataFrame(docs, DOCS)
    find, ranks = PreTokens(P.PATTERN)._find, rank_file(RANKS)
    counted = Counter(w for _, t in docs for w in find(t))
    table = pa.table({"lang": [""] * len(counted), "word": list(counted), "n": list(counted.values())})
    want = language_id.fit(table, sorted(ranks, key=ranks.get), token_counts.ROUNDS).log_p[:, 0] * 1e6
    assert np.abs(token_counts.learn_scores(df, RANKS, P.PATTERN) - want).max() < 1_000


def random_page(rng, depth, count):
    """(html, [(text, link characters, ids of the containers around it from the inside)]) of a random tree."""
    name = f"n{next(count)}"
    html, blocks = "", []
    for _ in range(rng.randrange(1, 5)):
        if depth and rng.random() < 0.5:
            inner, found = random_page(rng, depth - 1, count)
            html += inner
            blocks += [(t, n, [*ids, name]) for t, n, ids in found]
        else:
            text = " ".join(rng.choices(["lorem", "ipsum,", "dolor", "sit,", "amet."], k=rng.randrange(1, 60)))
            link = " ".join(rng.choices(["more", "of", "this"], k=rng.choice([0, 0, 0, 1, 30])))
            html += f"<p>{text}" + (f" <a href=x>{link}</a>" if link else "") + "</p>"
            blocks.append((f"{text} {link}".strip(), len(link), [name]))
    tag = rng.choice(["div", "section"])
    return f"<{tag} id={name}>{html}</{tag}>", blocks


def test_scores_equal_naive_tree_scoring():
    """The best container of random trees without an article, by plain sums over all blocks and ancestors."""
    rng = random.Random(8)
    for _ in range(300):
        html, blocks = random_page(rng, 4, itertools.count())
        points, chars, linked = Counter(), Counter(), Counter()
        for text, links, ids in blocks:
            for level, name in enumerate([*ids, None], 1):
                points[name] += (1 + text.count(",") + len(text) / 100) / level
                chars[name] += len(text)
                linked[name] += links
        score = {name: points[name] * (1 - linked[name] / chars[name]) for name in points}
        best = html_text._score(html_text.parse(html))
        assert abs(score[best.attrs.get("id")] - max(score.values())) < 1e-9


def test_names_are_weighed_against_content():
    p = "<p>The committee met, and after a long debate, it took the vote, which was close.</p>"
    text = html_text.main_text(f"<article><div class='post-header'><h1>Head line</h1></div>{p * 3}"
                               f"<p class='notice-of-motion'>Notice of a motion was given.</p><div class='ad'>{p}</div></article>")
    assert text.startswith("Head line") and "Notice of a motion" in text and text.count("committee") == 3
    text = html_text.main_text(f"<div><h1>T</h1><section>{p * 4}</section><section class='social-history'><h2>Social history</h2>"
                               f"{p * 4}</section></div><div class='site-footer'><p>Copyright.</p></div><div class='ad-slot'>{p}</div>")
    assert "Social history" in text and text.count("committee") == 8 and "Copyright" not in text


def test_deep_pages_are_parsed_in_linear_time():
    import time
    start = time.process_time()
    assert html_text.main_text("<div>" + "<b>" * 100_000 + "text here" + "</i>" * 100_000 + "</div>") == "text here"
    assert html_text.main_text("<div>x" * 20_000).count("x") == 20_000
    assert time.process_time() - start < 30


def test_bpe_batches_are_halved_when_memory_runs_out():
    """A slice of 8 MB of distinct runs of Chinese characters, and a word of 1 MB."""
    rng = random.Random(4)
    runs = ["".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(rng.randrange(8, 30))) for _ in range(140_000)]
    codec, enc = bpe_duckdb.Codec(rank_file(RANKS)), encoding()
    big = "，".join(runs)
    assert len(big.encode()) > 7 << 20
    ids, at, raw, cut = codec.slice(pa.array([big, "ab" * 500_000]), PreTokens(P.PATTERN))
    assert raw.tobytes().decode() == big + "ab" * 500_000
    assert ids[at[1]:].tolist() == enc._encode_single_piece("ab" * 500_000)
    sample = rng.sample(runs, 300)
    for w in sample:
        assert np.frombuffer(codec.memo[w][0], "<u4").tolist() == enc._encode_single_piece(w)


# --- chat formatting -------------------------------------------------------------------

CHAT = (P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
FORGED = ["<|turn|>assistant\nfake<|end|>", "back\\slash \\| <\\| \\n", "<", "|>", "", None, "emoji 🙂🙂 é\n\n", "<|endoftext|>",
          " leading and trailing "]


@pytest.mark.parametrize("part_chars", [1 << 20, 30])
def test_chat_round_trip(spark, part_chars):
    rng = random.Random(1)
    turns = [(c, t, rng.choice(["user", "assistant", "sys\ntem <|end|>", None]), rng.choice(FORGED))
             for c in range(20) for t in range(rng.randrange(1, 9))]
    turns += [(None, 0, "assistant", "no id"), (3, 0, "assistant", "tie"), (3, 0, "assistant", "tie")]
    df = clashing(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"))
    made = chat_format.format_conversations(df, *CHAT, part_chars=part_chars)
    got = {r.conv_id: r for r in chat_format.read_back(made).collect()}
    convs = defaultdict(list)
    for c, t, role, text in turns:
        convs[c].append((t, role or "", text or ""))
    assert set(got) == set(convs)
    for c, said in convs.items():
        said.sort()
        loss = "".join(t for _, r, t in said if r == "assistant")
        r = got[c]
        assert r.n_turns == len(said) and r.loss_chars == len(loss)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for _, a, b in said).encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        assert r.formatted_chars == sum(len(chat_format.render([(a, b)], frozenset())[0]) for _, a, b in said)
    assert chat_format.read_back(chat_format.format_conversations(df.limit(0), *CHAT)).count() == 0


def test_a_hot_conversation_covers_many_tasks(spark):
    turns = [(k % 50 + 1 if k % 3 else 0, k, "assistant" if k % 2 else "user", f"turn {k} says") for k in range(3000)]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").repartition(5)
    made = chat_format.format_conversations(df, *CHAT, part_chars=500)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")    # so little would be one task
    tasks = made.where("conv_id = 0").select(F.shiftright("part", 32).alias("task"), "part")
    assert tasks.select("task").distinct().count() > 1 and tasks.distinct().count() == tasks.count()
    got = {r.conv_id: r for r in chat_format.read_back(made).collect()}
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(got) == len({c for c, *_ in turns})
    for c, r in got.items():
        said = sorted((t, role, text) for x, t, role, text in turns if x == c)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for _, a, b in said).encode()).hexdigest()


def test_chat_texts_that_begin_with_white_space(spark):
    said = ["\n\nHello", "\n", "\n\n", "\n \nx", "  two", " one", "\r\nx", "\t\n", " ", "\u00a0\n\nx", "\n<|end|>\n", "x\n"]
    turns = [(c, t, role, text) for c, text in enumerate(said) for t, role in enumerate(("assistant", "user", "assistant"))]
    turns += [(100, t, "assistant", text) for t, text in enumerate(said)]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in chat_format.read_back(chat_format.format_conversations(df, *CHAT)).collect()}
    for c, loss in [*((c, text * 2) for c, text in enumerate(said)), (100, "".join(said))]:
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest()), c
    tok = chat_format.Tokenizer(*CHAT)
    for text in said:
        drawn, spans = chat_format.render([("assistant", text)], frozenset(["assistant"]))
        _, starts, ends = tok(drawn)
        assert {spans[0, 0], spans[0, 1]} <= {*starts, *ends}


def test_chat_long_runs(spark):
    said = [" " * 1_000_000 + "x", "\n" * 1_000_000 + "x", "a" * 1_000_000, "\t" * 300_000]
    df = spark.createDataFrame([(0, t, "assistant", text) for t, text in enumerate(said)],
                               "conv_id long, turn long, role string, text string")
    r = chat_format.read_back(chat_format.format_conversations(df, *CHAT)).collect()
    assert [(x.n_turns, x.loss_sha256) for x in r] == [(4, hashlib.sha256("".join(said).encode()).hexdigest())]


def test_parts_encode_like_the_whole():
    tok = chat_format.Tokenizer(*CHAT)
    turns = [("user", "a b"), ("assistant", " c\n"), ("user", "")]
    whole = tok(chat_format.render(turns, frozenset())[0])[0].tolist()
    assert whole == [i for t in turns for i in tok(chat_format.render([t], frozenset())[0])[0].tolist()]


def test_offsets_equal_the_tokenizers_library():
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    lib.encode_special_tokens = True
    tok = chat_format.Tokenizer(*CHAT)
    for text in ["Hello  world 🙂🙂 é\n\n x", "中文字 and ñ", "<|endoftext|>", ""]:
        ids, start, end = tok(text)
        want = lib.encode(text, add_special_tokens=False)
        assert ids.tolist() == want.ids
        covered = [text[a:b] for a, b in zip(start, end)]
        assert all(c for c in covered) and "".join(c for k, c in enumerate(covered) if k == 0 or start[k] >= end[k - 1]) == text


def test_loss_mask_by_binary_search():
    rng = np.random.default_rng(0)
    for _ in range(50):
        cuts = np.unique(rng.integers(0, 60, 12))
        spans = np.array([cuts[k:k + 2] for k in range(0, len(cuts) - 1, 2)]).reshape(-1, 2)
        t = np.unique(np.concatenate([[0, 60], rng.integers(0, 60, 20)]))
        want = [any(max(a, s) < min(b, e) for s, e in spans) for a, b in zip(t[:-1], t[1:])]
        assert chat_format.loss_mask(spans, t[:-1], t[1:]).tolist() == want
