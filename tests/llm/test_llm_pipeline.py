"""The pipeline's stages on planted documents, against brute-force versions, and at the edges."""

import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as C
from test_llm_operators import brute_hits, brute_lines, brute_near, encoding
from wordmill.llm.line_dedup import MIN_EDIT

SF = "/root/testdata/sf0.001"
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def document(i, text, lang="en", source="planted"):
    return (i, text, lang, source, None if text is None else len(text))


@pytest.fixture(scope="module")
def corpus(spark):
    """The small documents, and planted copies, leaks, junk, nulls and repeated rows."""
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select(
        "doc_id", "text", "lang", "source", "n_chars").collect()]
    item = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first()
    long = max((r for r in rows if r[2] == "en" and len(r[1]) < 6000), key=lambda r: len(r[1]))
    words = long[1].replace("\n", " ").split()
    own = [f"own{k} word{k * 7} of planted{k * 3} text" for k in range(60)]
    near = " ".join(own)
    rows += [
        document(90001, None), document(90002, ""), document(90003, "12 34 !!"), document(90004, "\n\n"),
        document(90010, "a new opening sentence here\n" + item.text + "\nand a closing one after it"),
        document(90020, near), document(90021, near.replace("own7 ", "changed ")), document(90022, near.replace("own9 ", "")),
        document(90030, " ".join(words[: len(words) // 2])),
        document(90040, "the licence line that two documents share here\nfirst own line of ninety thousand forty"),
        document(90041, "the licence line that two documents share here!\nother own line, of the second document"),
        document(90050, "some repeated row of the table with words", None), document(90050, "some repeated row of the table with words", None),
        document(90060, "texto de un documento sin fuente ni idioma", None, None),
    ]
    return spark.createDataFrame(rows, COLUMNS).withColumn("_keep", F.lit("x")).withColumn("_doc", F.lit(1))


def brute(rows, items):
    """The documents after stages 1 to 4, by plain loops."""
    docs = {}
    for r in rows:  # rows that repeat an id are equal here
        if r.text is not None and any(c.isalpha() for c in r.text):
            docs[r.doc_id] = r.text
    lines = brute_lines(list(docs.items()))
    docs = {i: t for i, t in lines.items() if any(x.strip() for x in t.split("\n"))}
    near = brute_near(list(docs.items()))
    docs = {i: t for i, t in docs.items() if near[i][0] == i}
    hits = brute_hits(list(docs.items()), items, 10)
    return {i: t for i, t in docs.items() if not hits[i][1]}


def test_run_equals_brute_force(spark, corpus, tmp_path):
    corpus.write.parquet(f"{tmp_path}/documents.parquet")
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    want = brute(corpus.collect(), [(r.item_id, r.text) for r in bench.collect()])
    enc = encoding()
    got = {r.doc_id: (r.n_tokens, r.token_ids) for r in C.run(spark, str(tmp_path)).collect()}
    assert set(got) == set(want)
    for i, text in want.items():
        ids = enc.encode_ordinary(text)
        assert got[i] == (len(ids), ids)
    assert not {90001, 90002, 90003, 90004, 90010, 90021, 90022} & set(got) and {90020, 90040, 90041, 90050} <= set(got)


def test_every_stage_keeps_columns_and_clean_documents(spark, corpus):
    docs, sizes = corpus, []
    for k, (name, stage) in enumerate(C.STAGES):
        docs = stage(spark, docs, SF).persist()
        sizes.append(docs.count())
        if k < 4:
            assert docs.columns == corpus.columns, name
    clean = {r.doc_id for r in corpus.where("doc_id in (90020, 90030, 90040, 90041, 90050, 90060)").collect()}
    assert clean - {90030} <= {r.doc_id for r in docs.collect()}
    assert sizes == sorted(sizes, reverse=True)


def test_line_stage_cuts_lines_and_counts_characters(spark, corpus):
    out = {r.doc_id: r for r in C.drop_lines(spark, corpus, SF).collect()}
    assert out[90041].text == "other own line, of the second document" and out[90041].n_chars == len(out[90041].text)
    assert out[90040].text.count("\n") == 1 and MIN_EDIT <= len("the licence line that two documents share here")


@pytest.mark.parametrize("name,stage", C.STAGES)
def test_stages_take_nulls_and_empty_tables(spark, corpus, name, stage):
    assert stage(spark, corpus.limit(0), SF).count() == 0
    nulls = spark.createDataFrame([(None, None, None, None, None), (1, None, None, None, None), (2, "", None, None, 0),
                                   (None, "a text without an id", None, None, None)], COLUMNS)
    assert stage(spark, nulls, SF).count() <= 4


def test_registered_last_stage_decodes(spark, corpus):
    from wordmill.llm import bpe_duckdb
    docs = corpus.where("doc_id >= 90000 and doc_id != 90050")
    out = bpe_duckdb.decode(C.encode(spark, docs, SF), P.path("byte_bpe_multi_50k.tiktoken"))
    assert {r.doc_id: bytes(r.decoded).decode() for r in out.collect()} == {r.doc_id: r.text or "" for r in docs.collect()}


def test_texts_of_no_known_language_go(spark):
    import random

    import corpus_pipeline
    from pyspark.sql import functions as F
    rng = random.Random(1)
    noise = [" ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randrange(2, 10))) for _ in range(60))
             for _ in range(20)]
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    extra = spark.createDataFrame([(-1 - k, t, None) for k, t in enumerate(noise)] + [(-100, "Zxq", None)], docs.schema)
    kept = {r.doc_id for r in corpus_pipeline.identify_language(spark, docs.unionByName(extra), "").collect()}
    assert kept == {r.doc_id for r in docs.where(F.col("text").rlike("[a-zA-Z]")).collect()} | {-100}
