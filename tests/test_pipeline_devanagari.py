"""F5 with its default Devanagari script parameter: inputs and the outputs the rules give."""
import hashlib

import pytest

from wordmill.operators import clean as C

SENTENCE = "आज बिहानै हाम्रो टोलमा पानी पर्यो र बाटो हिलो भयो तर बजार खुल्यो।"
#: (name, input, cleaned text or None when a filter rejects it)
CASES = [
    ("tags and entities become single spaces",
     f"<div class='x'>{SENTENCE}</div>&nbsp;&amp;<br/>समाप्त", f"{SENTENCE} समाप्त"),
    ("a tag may span lines", f"{SENTENCE}<a\nhref='#'>पछि", f"{SENTENCE} पछि"),
    ("three or more line feeds become two", f"{SENTENCE}\n\n\n\n\nदोस्रो अनुच्छेद", f"{SENTENCE}\n\nदोस्रो अनुच्छेद"),
    ("two line feeds stay", f"{SENTENCE}\n\nदोस्रो", f"{SENTENCE}\n\nदोस्रो"),
    ("spaces and tabs collapse, ends are stripped", f" \t {SENTENCE} \t\t अन्त 　 ", f"{SENTENCE} अन्त"),
    ("a decomposed nukta consonant is composed where NFC composes it", f"{SENTENCE} ऩ", f"{SENTENCE} ऩ"),
    ("an e-mail address is scrubbed", f"{SENTENCE} ram.k+1@post.example.np", f"{SENTENCE} [EMAIL]"),
    ("a phone number is scrubbed", f"{SENTENCE} 9841234567 हो", f"{SENTENCE} [PHONE] हो"),
    ("no letters at all", "१२३ ४५६ !!! --- १२३ ४५६ !!! --- १२३ ४५६ !!! --- १२३", None),
    ("another script", "The market opened late because the road was muddy after the rain of this morning.", None),
    ("under fifty characters", "बजार खुल्यो।", None),
    ("few distinct words", " ".join(["खुल्यो"] * 24 + ["बजार"]), None),
    ("few letters for its length", "बजार र बाटो " + "०१२३४५६७८९ " * 12, None),
    ("nothing", "", None),
    ("null", None, None),
]


@pytest.fixture(scope="module")
def cleaned(spark):
    df = spark.createDataFrame([(k, text) for k, (_, text, _) in enumerate(CASES)], "doc_id long, text string")
    return {r.doc_id: r for r in C.clean_documents(df, keep=("doc_id",)).collect()}


@pytest.mark.parametrize("k", range(len(CASES)), ids=[name for name, _, _ in CASES])
def test_cleaning_case(cleaned, k):
    want = CASES[k][2]
    assert (cleaned[k].text if k in cleaned else None) == want


def test_hash_is_md5_of_the_cleaned_text(cleaned):
    assert all(r.hash == hashlib.md5(r.text.encode()).hexdigest() for r in cleaned.values())
