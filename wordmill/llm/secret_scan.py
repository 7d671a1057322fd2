"""Secret scans: fixed patterns, and character Markov models of random strings and identifiers.

DataFrame operations only. Base spans are the leftmost non-overlapping matches of three
patterns (assignments, access keys, hex strings) that pass a length check. The method adds
spans of kind ``random``: runs of key characters (:data:`CANDIDATE`) that a first-order
character Markov model of random strings explains better than one of ordinary
identifiers, by ``margin`` nats a transition at least, and that touch no base span.

Both models are learned from labelled samples of the corpus itself. Random strings are the
distinct values inside the base spans of *all* documents. Ordinary identifiers are the
distinct words, shorter than a candidate, of about ``sample_docs`` documents (an md5 of the
id decides which) that are not such a value. A model is a table over 66 x 66 characters; the log-likelihood ratios are kept as whole thousandths, so sums are exact.

Offsets are code points, ends exclusive. Defined results: null text is empty and has no
spans; very long texts are scanned whole; spans that start together stand in the order of the
kinds, and a ratio that equals the margin counts as random; rows that repeat id and text get the same result each; without
any labelled value the random model is uniform; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wordmill.llm.scratch import stored


def either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


# Fixed patterns. ``[...]{32,}`` and ``AKIA[...]{12,}`` match what the patterns with ``+`` and a
# length check match, for their runs are maximal; an assignment's length check comes after the match.
KEYWORDS = ("password", "passwd", "secret", "token", "api_?key")
ASSIGN = (f"({'|'.join(either_case(k) for k in KEYWORDS)})" + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = "AKIA[A-Z0-9]{12,}"
HEX = "[0-9a-f]{32,}"
LEAST_CANDIDATE = 20
CANDIDATE = f"[A-Za-z0-9+/_-]{{{LEAST_CANDIDATE},}}={{0,2}}"
IDENTIFIER = "[A-Za-z0-9+/_-]{4,}"

KINDS = {"assign": ASSIGN, "access": ACCESS, "hex": HEX, "random": CANDIDATE}
ORDER = {"assign": 0, "access": 1, "hex": 2, "random": 3}
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
ASSIGN_VALUE = 8
PRIOR = 10


def _document(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc"), F.xxhash64(text).alias("row"), text.alias("text"))


def _hits(docs: DataFrame) -> DataFrame:
    """Documents with any match: for each kind the lengths of the texts between matches, and the matches."""
    columns, some = [], []
    for kind, pattern in KINDS.items():
        there = F.col("text").rlike(pattern)
        some.append(there)
        columns += [F.when(there, F.transform(F.split("text", pattern, -1), F.length)).alias(f"{kind}_gaps"),
                    F.when(there, F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).alias(f"{kind}_found")]
    values = F.when(some[0], F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(2))).alias("assign_value")
    return docs.where(reduce(Column.__or__, some)).select("doc", "row", *columns, values).dropDuplicates(["doc", "row"])


def _spans(hits: DataFrame, kind: str) -> DataFrame:
    """doc, row, kind, start, end, value of the matches of one kind."""
    value = "assign_value" if kind == "assign" else f"{kind}_found"
    rows = hits.where(F.col(f"{kind}_found").isNotNull()).select(
        "doc", "row", F.posexplode(F.arrays_zip(F.slice(f"{kind}_gaps", 1, F.size(f"{kind}_found")).alias("gap"),
                                                F.col(f"{kind}_found").alias("found"), F.col(value).alias("value")))
        .alias("k", "m")).select("doc", "row", "k", F.col("m.gap").alias("gap"), F.length("m.found").alias("size"),
                                 F.col("m.value").alias("value"))
    before = Window.partitionBy("doc", "row").orderBy("k")
    rows = rows.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(before))
    if kind == "assign":
        rows = rows.where(F.length("value") >= ASSIGN_VALUE)
    return rows.select("doc", "row", F.lit(kind).alias("kind"), (F.col("end") - F.col("size")).alias("start"), "end", "value")


def _transitions(tokens: DataFrame) -> dict[str, int]:
    """How often each pair of neighbouring characters occurs in the distinct tokens (at most 66 x 66 rows)."""
    chars = F.split("value", "")
    pairs = tokens.select("value").distinct().select(F.explode(F.transform(
        F.sequence(F.lit(0), F.length("value") - 2),
        lambda i: F.concat(F.get(chars, i), F.get(chars, i + 1)))).alias("pair"))
    letters = "".join(ALPHABET[:-1]) + "\\-"
    counted = pairs.where(F.col("pair").rlike(f"^[{letters}]{{2}}$")).groupBy("pair").count()
    return {r["pair"]: r["count"] for r in counted.collect()}


def log_ratios(random: dict[str, int], ordinary: dict[str, int]) -> dict[str, int]:
    """Thousandths of log P(second | first, random) - log P(second | first, ordinary).

    Transitions are smoothed by ``PRIOR`` observations of the characters' own frequencies
    (add-one smoothed), so what follows a rare character is judged by those.
    """
    def log_p(counts: dict[str, int]) -> dict[str, float]:
        total = {a: sum(counts.get(a + b, 0) for b in ALPHABET) for a in ALPHABET}
        often = {b: sum(counts.get(a + b, 0) for a in ALPHABET) for b in ALPHABET}
        every = sum(total.values())
        return {a + b: math.log((counts.get(a + b, 0) + PRIOR * (often[b] + 1) / (every + len(ALPHABET)))
                                / (total[a] + PRIOR)) for a in ALPHABET for b in ALPHABET}
    p, q = log_p(random), log_p(ordinary)
    return {pair: round(1000 * (p[pair] - q[pair])) for pair in p}


def train(hits: DataFrame, docs: DataFrame, sample_docs: int) -> dict[str, int]:
    known = reduce(DataFrame.unionByName, (_spans(hits, k) for k in ("assign", "access", "hex"))).select("value")
    known = known.where("length(value) >= 2").distinct()
    total = docs.count()
    cut = (1 << 28) if total <= sample_docs else (sample_docs << 28) // total
    sample = docs.where(F.conv(F.substring(F.md5(F.col("doc").cast("string").cast("binary")), 1, 7), 16, 10)
                        .cast("long") < cut)
    words = sample.select(F.explode(F.regexp_extract_all("text", F.lit(IDENTIFIER), F.lit(0))).alias("value"))
    words = words.where(F.length("value") < LEAST_CANDIDATE)  # longer ones are what is to be told apart
    return log_ratios(_transitions(known), _transitions(words.distinct().join(known, "value", "left_anti")))


def _weights(ratios: dict[str, int]) -> Column:
    """The model as an array literal, indexed by 128 * first + second."""
    table = [0] * (128 * 128)
    for pair, w in ratios.items():
        table[128 * ord(pair[0]) + ord(pair[1])] = w
    return F.split(F.lit(",".join(map(str, table))), ",").cast("array<int>")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", margin: float = 0.5,
         sample_docs: int = 2000) -> DataFrame:
    """One row per span: doc, row (hash of the text), kind, start, end, value."""
    texts = _document(docs, id_col, text_col)
    hits = stored(_hits(texts), "secret-hits")
    ratios = train(hits, texts, sample_docs)
    base = reduce(DataFrame.unionByName, (_spans(hits, k) for k in ("assign", "access", "hex")))
    found = _spans(hits, "random").withColumn("chars", F.split("value", "")).withColumn("weights", _weights(ratios))
    score = F.aggregate(F.sequence(F.lit(0), F.length("value") - 2), F.lit(0).cast("long"), lambda acc, i: acc + F.get(
        "weights", F.ascii(F.get("chars", i)) * 128 + F.ascii(F.get("chars", i + 1))))
    random = found.where(score >= F.lit(int(margin * 1000)) * (F.length("value") - 1)).drop("chars", "weights")
    ordered = Window.partitionBy("doc", "row").orderBy("start")
    is_base = F.col("kind") != "random"
    return (base.unionByName(random)
            .withColumn("reach", F.max(F.when(is_base, F.col("end"))).over(ordered.rangeBetween(Window.unboundedPreceding, 0)))
            .withColumn("next", F.min(F.when(is_base, F.col("start"))).over(ordered.rangeBetween(0, Window.unboundedFollowing)))
            .where(is_base | ((F.coalesce("reach", F.lit(0)) <= F.col("start"))
                              & (F.coalesce("next", F.col("end")) >= F.col("end"))))
            .drop("reach", "next"))


def scan_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, n_random, base and all spans as strings."""
    found = scan(docs, id_col, text_col, **how)
    rank = F.element_at(F.create_map(*(F.lit(x) for kv in ORDER.items() for x in kv)), F.col("kind"))
    text = F.concat_ws(":", "kind", "start", "end")
    spans = F.sort_array(F.collect_list(F.struct(F.col("start"), rank.alias("rank"), text.alias("text"))))
    per = found.groupBy("doc", "row").agg(spans.alias("spans")).select(
        "doc", "row", F.filter("spans", lambda s: s["rank"] < 3)["text"].alias("base"), F.col("spans.text").alias("all"),
        *(F.size(F.expr(f"filter(spans, s -> s.rank = {r})")).cast("long").alias(f"n_{k}") for k, r in ORDER.items()))
    every = _document(docs, id_col, text_col).select("doc", "row").alias("d")
    return every.join(per.alias("p"), F.expr("d.doc <=> p.doc AND d.row = p.row"), "left").select(
        F.col("d.doc").alias("doc_id"), *(F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in ORDER),
        F.coalesce(F.concat_ws(",", "base"), F.lit("")).alias("base"),
        F.coalesce(F.concat_ws(",", "all"), F.lit("")).alias("spans"))
