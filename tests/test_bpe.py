"""BPE learning (K5) and encoding (K7) against the `tokenizers` library; K11 grades."""
import json

import duckdb
import pytest
from pyspark.sql import functions as F

from conftest import SF
from wordmill.operators import bpe as B

tokenizers = pytest.importorskip("tokenizers")


def _library(texts, vocab_size):
    from tokenizers import Tokenizer, models, pre_tokenizers, trainers
    tok = Tokenizer(models.BPE(unk_token="<unk>"))
    tok.pre_tokenizer = pre_tokenizers.Whitespace()
    tr = trainers.BpeTrainer(vocab_size=vocab_size, min_frequency=2,
                             special_tokens=list(B.SPECIALS), show_progress=False)
    tok.train_from_iterator(texts, trainer=tr)
    model = json.loads(tok.to_str())["model"]
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    return tok, model["vocab"], merges


def test_toy_corpus_merges(spark):
    df = spark.createDataFrame([("ab ab cd cd ac ac x",), ("z",)], "text string")
    m = B.learn_bpe(B.word_frequencies(df), vocab_size=100)
    assert m.merges == [("a", "b"), ("a", "c"), ("c", "d")]
    assert m.vocab["a"] == 4 and m.vocab["ab"] == 10 and m.vocab["ac"] == 11 and m.vocab["cd"] == 12
    table = m.merge_table()
    enc = [B.encode_word(w, m.vocab, table, 0) for w in ["ab", "q", "z", "!"]]
    assert enc == [[10], [0], [m.vocab["z"]], [0]]


@pytest.mark.parametrize("first_hot", [1, 7, 256])
def test_equals_library(spark, first_hot):
    texts = [r[0] for r in duckdb.sql(
        f"select text from '{SF}/documents.parquet' order by doc_id limit 40").fetchall()]
    tok, vocab, merges = _library(texts, 160)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    m = B.learn_bpe(B.word_frequencies(df), vocab_size=160, first_hot=first_hot)
    assert m.merges == merges
    assert m.vocab == vocab
    got = {r.doc_id: r.input_ids for r in B.doc_tokens(df, m).collect()}
    for i, t in enumerate(texts):
        assert got[i] == tok.encode(t).ids
    dec = {r.doc_id: r.text for r in B.decode(B.doc_tokens(df, m), m).collect()}
    assert dec[0] == "".join(tok.id_to_token(i) for i in tok.encode(texts[0]).ids)


def test_fertility_grade(spark):
    from pyspark.sql import functions as F  # noqa: F811
    for tokens, grade in ((15, "EXCELLENT"), (20, "GOOD"), (21, "HIGH")):
        words = spark.createDataFrame([(1, " ".join(["w"] * 10))], "doc_id long, text string")
        toks = spark.createDataFrame([(1, list(range(tokens)))], "doc_id long, input_ids array<int>")
        r = B.fertility(words, toks).first()
        assert r["grade"] == grade


def test_unk_rate(spark):
    m = B.BpeModel({"<unk>": 0, "<s>": 1, "</s>": 2, "<pad>": 3, "a": 4})
    toks = spark.createDataFrame([([0, 4, 4, 4],)], "input_ids array<int>")
    assert B.unk_rate(toks, m).first()["unk_rate"] == 25.0


def test_many_disjoint_pairs_train(spark):
    """A batch of thousands of merges that share no symbol: as wide alphabets give."""
    words = [(chr(0x4E00 + 2 * k) + chr(0x4E01 + 2 * k), 2 + k % 3) for k in range(2000)]
    wf = spark.createDataFrame(words, "word string, freq long")
    model = B.learn_bpe(wf, vocab_size=100_000)
    assert len(model.merges) == 2000 and sorted(a + b for a, b in model.merges) == sorted(w for w, _ in words)


def test_encode_word_equals_rescanning():
    import random
    rng = random.Random(9)
    vocab = {c: i for i, c in enumerate("abc")}
    table, rank = {}, 0
    for _ in range(12):
        names = list(vocab)
        a, b = rng.choice(names), rng.choice(names)
        if (vocab[a], vocab[b]) not in table:
            table[vocab[a], vocab[b]] = (rank, vocab.setdefault(a + b, len(vocab)))
            rank += 1

    def plain(word):
        ids = [vocab.get(c, 99) for c in word]
        while True:
            found = [(table[p][0], k) for k, p in enumerate(zip(ids, ids[1:])) if p in table]
            if not found:
                return ids
            k = min(found)[1]
            ids[k:k + 2] = [table[ids[k], ids[k + 1]][1]]
    for n in range(200):
        w = "".join(rng.choices("abcd", k=n % 40))
        assert B.encode_word(w, vocab, table, 99) == plain(w)


def test_doc_tokens_decode_round_trip(spark):
    docs = spark.createDataFrame([(1, "low lower lowest"), (2, None), (3, ""), (4, "slow low")] * 2, "doc_id long, text string")
    model = B.learn_bpe(B.word_frequencies(docs), vocab_size=40)
    toks = B.doc_tokens(docs, model)
    got = sorted((r.doc_id, r.text) for r in B.decode(toks, model).collect())
    want = sorted((i, "".join(p)) for i, p in [(1, ["low", "lower", "lowest"]), (2, []), (3, []), (4, ["slow", "low"])] * 2)
    assert got == want
    words = {w: B.encode_word(w, model.vocab, model.merge_table(), 0) for w in ("low", "lower", "lowest", "slow")}
    assert {r.doc_id: r.input_ids for r in toks.collect()}[4] == words["slow"] + words["low"]


def test_model_artifact_round_trip(spark, tmp_dir):
    wf = spark.createDataFrame([("banana", 3), ("bandana", 2)], "word string, freq long")
    model = B.learn_bpe(wf, vocab_size=20)
    B.save_model(spark, model, f"{tmp_dir}/m")
    back = B.load_model(spark, f"{tmp_dir}/m")
    assert back.vocab == model.vocab and back.merges == model.merges


def test_counts_at_smaller_vocabularies(spark):
    """One training read off at smaller sizes equals smaller trainings."""
    texts = [r[0] for r in duckdb.sql(f"select text from '{SF}/documents.parquet' order by doc_id limit 15").fetchall()]
    df = spark.createDataFrame([*enumerate(texts), (100, None), (101, "")], "doc_id long, text string")
    wf = B.word_frequencies(df)
    sizes = [90, 130, 300]
    full = B.learn_bpe(wf, sizes[-1])
    got = {r.doc_id: (r.bpe_90, r.bpe_130, r.bpe_300) for r in B.token_counts_at(df, full, sizes).collect()}
    models = [B.learn_bpe(wf, n) for n in sizes]
    for n, m in zip(sizes, models):
        assert full.merges[:B.merges_at(full, n)] == m.merges
    counts = [{r.doc_id: len(r.input_ids) for r in B.doc_tokens(df, m).collect()} for m in models]
    assert got == {i: tuple(c[i] for c in counts) for i in got} and len(got) == len(texts) + 2


def test_tokens_are_put_together_in_slices(spark, monkeypatch):
    """Documents are put together in slices of a batch, words counted per batch before they are aggregated."""
    import pyarrow as pa
    docs = [(k, "low lower " * n if n else None) for k, n in enumerate((0, 3, 1, 50, 2, 0, 7))]
    batch = pa.record_batch([pa.array([k for k, _ in docs]), pa.array([t and t.split() for _, t in docs], pa.list_(pa.string()))], names=["k", "p"])
    monkeypatch.setattr(B, "SLICE_PIECES", 10)
    got = list(B._doc_slices(batch))
    assert [len(k) for k, _ in got] == [3, 1, 2, 1] and [x for k, _ in got for x in k.to_pylist()] == list(range(7))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    wf = B.word_frequencies(df)
    assert sorted(map(tuple, wf.collect())) == [("low", 63), ("lower", 63)]
    assert "Generate" not in wf._jdf.queryExecution().optimizedPlan().toString()


def test_short_words_encode_as_long_ones(spark, monkeypatch):
    df = spark.createDataFrame([("banana bandana ananas aaaaaaa abab baba nananana cabana",)] * 3, "text string")
    m = B.learn_bpe(B.word_frequencies(df), vocab_size=60)
    table = m.merge_table()
    words = ["banana", "aaaaaaaa", "aaa", "a", "", "x", "bxanana", "nanabanabandana", "ab" * 40, "é𐍈na"]
    monkeypatch.setattr(B, "SHORT_WORD", 1 << 20)
    got = [(B.encode_word(w, m.vocab, table, 0, r := []), r) for w in words]
    monkeypatch.setattr(B, "SHORT_WORD", -1)
    assert got == [(B.encode_word(w, m.vocab, table, 0, r := []), r) for w in words]


@pytest.mark.parametrize("name", ["doc_tokens", "decode_tokens", "encode_words"])
def test_tokens_come_from_the_written_stage(spark, name):
    import __spark_entry__ as E
    plan = E.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


def test_fertility_query_learns_the_full_vocabulary(spark, tmp_path):
    import random

    from wordmill.plans import registry as R
    rnd = random.Random(5)
    words = ["".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(250)]
    rows = [(k, "s", "en", " ".join(words[25 * (k % 10):25 * (k % 10 + 1)]) + " end" * (k // 10)) for k in range(20)]
    spark.createDataFrame(rows, "doc_id long, source string, lang string, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in R.q_fertility(spark, str(tmp_path)).collect()]
    # more than 500 merges, until every word that comes twice is one token
    assert got == [(510, 510, 1.0, "EXCELLENT")]
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    con.execute("CREATE VIEW benchmark AS SELECT 1 AS item_id, 'one more' AS text")
    assert con.execute(R.REGISTRY["fertility"].sql).fetchall() == got
