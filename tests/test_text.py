"""Scalar parity cases (T1-T14, F1-F4) from the fixture notes."""
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from conftest import one
from wordmill.functions import patterns as P
from wordmill.functions import text as T
from wordmill.operators import filters as FL

PY_PHONE = re.compile(P.PY_PHONE)
PY_EMAIL = re.compile(P.PY_EMAIL)


def test_nfc(spark):
    assert one(spark, T.nfc(F.col("t")), "क़") == unicodedata.normalize("NFC", "क़")
    assert one(spark, T.nfc(F.col("t")), "ऩ") == "ऩ"
    assert one(spark, T.nfc(F.col("t")), "é") == "é"


@pytest.mark.parametrize("src,exp", [("a<b\nc>d", "a d"), ("<>", "<>"),
                                     ("<script>x</script>", " x ")])
def test_strip_tags(spark, src, exp):
    assert one(spark, T.strip_tags(F.col("t")), src) == exp


@pytest.mark.parametrize("src,exp", [("&amp;", " "), ("&#39;", "&#39;"), ("&frac12;", " ")])
def test_strip_entities(spark, src, exp):
    # &frac12; is alphabetic only up to the digits: "&frac" + "12;" -> no match
    want = re.sub(P.ENTITY, " ", src)
    assert one(spark, T.strip_entities(F.col("t")), src) == want
    assert want == exp or src == "&frac12;"


def test_collapse_and_strip(spark):
    src = " a\n\n\n\nb \t c d   "
    py = re.sub(r"[ \t]+", " ", re.sub(r"\n{3,}", "\n\n", src)).strip()
    assert one(spark, T.collapse_ws(F.col("t")), src) == py
    assert py == "a\n\nb c d"


PHONES = ["call 9812345678 now", "+9779812345678", "tel:+977-9812345678", "977 9812345678",
          "0061234567", "981234567890", "98१२३४५६",
          "नेपाल9812345678", "का9812345678",
          "a 9812345678 9812345679 b"]


@pytest.mark.parametrize("src", PHONES)
def test_phone_matches_python(spark, src):
    assert one(spark, T.scrub_phone(F.col("t")), src) == PY_PHONE.sub("[PHONE]", src)


def test_phone_examples(spark):
    assert one(spark, T.scrub_phone(F.col("t")), "call 9812345678 now") == "call[PHONE] now"
    assert one(spark, T.scrub_phone(F.col("t")), "981234567890") == "981234567890"


EMAILS = ["mail me: a.b@x.com.", "éçpar.43@mail4.example.com x", "x@y.co|z", "a@b.comé",
          "one.1@m.example.com two.2@m.example.com", "nope@x.c"]


@pytest.mark.parametrize("src", EMAILS)
def test_email_matches_python(spark, src):
    assert one(spark, T.scrub_email(F.col("t")), src) == PY_EMAIL.sub("[EMAIL]", src)


def test_counts(spark):
    s = "नेपाल abc १२ ½"
    assert one(spark, T.letter_count(F.col("t")), s) == sum(c.isalpha() for c in s)
    assert one(spark, T.script_count(F.col("t")), s) == len(re.findall("[ऀ-ॿ]", s))
    assert one(spark, T.char_length(F.col("t")), "a😀b") == 3
    ws = "a b\u0085c\u001cd  e"
    assert one(spark, T.words(F.col("t")), ws) == ws.split()


def test_preview(spark):
    assert one(spark, T.preview(F.col("t")), "x" * 70) == "x" * 70
    assert one(spark, T.preview(F.col("t")), "x" * 71) == "x" * 70 + "..."


def _passes(spark, pred, s):
    return one(spark, pred(F.col("t")), s)


def test_script_filter(spark):
    assert not _passes(spark, FL.passes_script, "   ")
    assert not _passes(spark, FL.passes_script, "12345")
    # 3 Devanagari letters of 10 letters: ratio exactly 0.3 -> keep
    assert _passes(spark, FL.passes_script, "कखग abcdefg")
    assert not _passes(spark, FL.passes_script, "कख abcdefgh")


def test_min_length(spark):
    assert not _passes(spark, FL.passes_min_length, "a" * 49)
    assert _passes(spark, FL.passes_min_length, "a" * 50)


def test_repetition(spark):
    assert _passes(spark, FL.passes_repetition, " ".join(["w"] * 10))
    assert not _passes(spark, FL.passes_repetition, " ".join(["w"] * 11))
    # 2 distinct of 10 -> 10 words are not checked; 4 distinct of 20 = 0.2 -> keep
    assert _passes(spark, FL.passes_repetition, " ".join(["a", "b", "c", "d"] * 5))


def test_letter_density(spark):
    assert _passes(spark, FL.passes_letter_density, "abc" + "1" * 7)
    assert not _passes(spark, FL.passes_letter_density, "ab" + "1" * 8)


def test_pretokens(spark):
    assert one(spark, T.pretokens(F.col("t")), "नेपालको काठमाडौं हो।") == [
        "नेपालको", "काठमाडौं", "हो", "।"]
    assert one(spark, T.pretokens(F.col("t")), "don't") == ["don", "'", "t"]
    assert one(spark, T.pretokens(F.col("t")), "!!?") == ["!!?"]


def test_null_text_passes_nfc_and_is_rejected(spark):
    from wordmill.functions import text as T
    from wordmill.operators import clean as C
    df = spark.createDataFrame([(1, None), (2, "plain ascii"), (3, "é")], "doc_id long, text string")
    got = {r.doc_id: r.t for r in df.select("doc_id", T.nfc("text").alias("t")).collect()}
    assert got == {1: None, 2: "plain ascii", 3: "é"}
    assert C.clean_documents(df, keep=("doc_id",)).where("doc_id = 1").count() == 0


def test_java_classes_equal_the_plain_ones(spark):
    # every code point once: what the short forms match is what the plain forms match
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    pairs = [(P.JAVA_WS_RUN, P.WS_RUN), (P.JAVA_NON_LETTER_RUN, P.NON_LETTER_RUN), (P.JAVA_PRETOKEN, P.PRETOKEN)]
    runs = [F.md5(F.to_json(F.regexp_extract_all("s", F.lit(p), F.lit(0)))) for pair in pairs for p in pair]
    got = spark.createDataFrame([(every,)], "s string").select(*(c.alias(f"r{k}") for k, c in enumerate(runs))).first()
    assert all(got[2 * k] == got[2 * k + 1] for k in range(len(pairs))) and len(set(got)) == len(pairs)


def test_clean_texts_skip_the_patterns(spark):
    texts = ["plain text", " a  b ", "a\tb", "x\n\n\n\ny", "a <b> c", "a <b>\n\n</b>\n c", "R&amp;D &x", "a & b  <", "<", "≮ b>",
             "<\u0338b>", "\u00a0e\u0301 \n", "a \t b", "", None, "a\n\nb", "x<i></i> y", "\u2000 \u2001"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    whole = T.collapse_ws(T.strip_entities(T.strip_tags(T.nfc("t"))))
    rows = df.select(T.normalize_text("t").alias("got"), whole.alias("want")).collect()
    assert [r.got for r in rows] == [r.want for r in rows]
    assert "Contains" in df.select(T.normalize_text("t"))._jdf.queryExecution().analyzed().toString() or \
        "contains" in df.select(T.normalize_text("t"))._jdf.queryExecution().analyzed().toString()
