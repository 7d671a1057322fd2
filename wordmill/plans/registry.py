"""Registered queries: one per operator of the inventory.

Each entry pairs a Spark builder ``(spark, sf_dir) -> DataFrame`` with the DuckDB
SQL that computes the same rows independently (or ``None`` where no SQL form
exists). Column names and types are aligned on both sides.

Driver tables: ``documents`` is the corpus (``source`` is the corpus label and
``doc_id`` the ordinal), ``pages`` carries markup, ``benchmark`` and
``conversations`` are two further corpora for the cross-corpus union.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordmill.functions import patterns as P
from wordmill.functions import text as T
from wordmill.operators import clean as C
from wordmill.operators import filters as FL
from wordmill.operators import stats as G
from wordmill.plans import oracle as O


@dataclass
class Query:
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None):
    def deco(fn):
        REGISTRY[name] = Query(fn, sql)
        return fn
    return deco


# Text tables and their document keys: scans of these are spread over the cores.
TEXT_TABLE_KEYS = {"documents": "doc_id", "pages": "page_id", "conversations": "conv_id"}


def table(spark: SparkSession, sf_dir: str, name: str, spread: bool = True) -> DataFrame:
    """A driver table; text tables feeding CPU-heavy work are spread over the cores."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    if spread and name in TEXT_TABLE_KEYS:
        from wordmill.sources.readers import ensure_parallelism
        df = ensure_parallelism(df, TEXT_TABLE_KEYS[name])
    return df


# --- fixed values for the fixture transforms ---------------------------------------
# Latin letters play the part of the target script on the driver tables, which
# hold no Devanagari; the `translate` map turns French rows into Devanagari.
CORPUS_BLOCK = P.LATIN
TRANSLIT_FROM = "abcdefghijklmnopqrstuvwxyz"
TRANSLIT_TO = "अबचदएफगहइजकलमनओपठरसतउवधखयझ"
# -------------------------------------------------------------------------------------


def documents(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "documents")


def cleaned(spark, sf_dir) -> DataFrame:
    """F5 over ``documents``: (doc_id, source, text, hash)."""
    return C.clean_documents(documents(spark, sf_dir), keep=("doc_id", "source"),
                             block=CORPUS_BLOCK)


def cleaned_stage(spark, sf_dir) -> DataFrame:
    """The cleaned corpus, written once per state of ``documents``."""
    from wordmill.sources.cache import stage
    return stage(spark, "cleaned", [f"{sf_dir}/documents.parquet"], lambda: cleaned(spark, sf_dir))


def deduped(spark, sf_dir) -> DataFrame:
    """D1 per source over the cleaned corpus."""
    return C.exact_dedup(cleaned_stage(spark, sf_dir), scope=("source",), order_col="doc_id",
                         strategy="winners")


CLEAN_CTE = O.cleaned_cte("documents", "doc_id, source", CORPUS_BLOCK)
DEDUP_CTE = CLEAN_CTE + ",\n" + O.dedup_cte("cleaned", "source", "doc_id")


def translit_sql(x: str) -> str:
    return f"translate(lower({x}), {O.q(TRANSLIT_FROM)}, {O.q(TRANSLIT_TO)})"


def devanagari_docs(spark, sf_dir) -> DataFrame:
    """``documents`` with French rows transliterated into Devanagari."""
    d = documents(spark, sf_dir)
    return d.select("doc_id", "source", F.when(F.col("lang") == "fr", F.translate(
        F.lower("text"), TRANSLIT_FROM, TRANSLIT_TO)).otherwise(F.col("text")).alias("text"))


DEVA_SQL = (f"SELECT doc_id, source, CASE WHEN lang = 'fr' THEN {translit_sql('text')} "
            f"ELSE text END AS text FROM documents")


# ===================================== sources ========================================
@register("src_parquet", "SELECT doc_id, coalesce(text, 'None') AS text, "
          "coalesce(source, 'None') AS source FROM documents")
def q_src_parquet(spark, sf_dir):
    from wordmill.sources.readers import parquet_corpus
    return parquet_corpus(documents(spark, sf_dir), text_col="text", source_col="source",
                          keep=("doc_id",))


@register("src_parquet_nulls", "SELECT doc_id, CASE WHEN lang = 'fr' THEN 'None' ELSE text END AS text, "
          "'iriisnepal' AS source FROM documents")
def q_src_parquet_nulls(spark, sf_dir):
    """S3 where the rules bite: null cells become 'None', the missing column takes its default."""
    from wordmill.sources.readers import parquet_corpus
    d = documents(spark, sf_dir)
    d = d.select("doc_id", F.when(F.col("lang") != "fr", F.col("text")).alias("Article"))
    return parquet_corpus(d, keep=("doc_id",))


@register("src_lines",
          "SELECT doc_id, CAST(line_no AS BIGINT) AS line_no, "
          f"{O.strip_sql('line0')} AS line FROM (SELECT doc_id, "
          "unnest(generate_series(0, len(parts) - 1)) AS line_no, unnest(parts) AS line0 FROM ("
          "SELECT doc_id, regexp_split_to_array(regexp_replace(text, '(?:\\r\\n|\\r|\\n)\\z', ''), "
          "'\\r\\n|\\r|\\n') AS parts FROM documents WHERE text <> ''))")
def q_src_lines(spark, sf_dir):
    """S1 on in-table text: every document's lines (universal newlines), stripped."""
    from wordmill.sources.readers import lines_of
    return lines_of(documents(spark, sf_dir), "text", "doc_id")


_LINES_SQL = ("SELECT doc_id, source, CAST(line_no AS BIGINT) AS line_no, "
              f"{O.strip_sql('line0')} AS line FROM (SELECT doc_id, source, "
              "unnest(generate_series(0, len(parts) - 1)) AS line_no, unnest(parts) AS line0 FROM ("
              "SELECT doc_id, source, regexp_split_to_array(regexp_replace(text, '(?:\\r\\n|\\r|\\n)\\z', ''), "
              "'\\r\\n|\\r|\\n') AS parts FROM documents WHERE text <> ''))")
SPLITS = 256                 # splits that the line files are read in, where they are small


@register("src_lines_files", "SELECT row_number() OVER (ORDER BY source, doc_id, line_no) - 1 AS row_no, line AS text, "
          f"'oscar' AS source FROM ({_LINES_SQL})")
def q_src_lines_files(spark, sf_dir):
    """documents' lines written as many text files, read in many splits, numbered over all files."""
    from wordmill.sources.readers import file_table, lines_of, read_lines, with_row_numbers
    path = scratch(spark, "lines")
    docs = documents(spark, sf_dir)
    lines = lines_of(docs, "text", "doc_id").join(docs.select("doc_id", "source"), "doc_id")
    (lines.repartitionByRange("source", "doc_id", "line_no").sortWithinPartitions("source", "doc_id", "line_no")
     .select("source", F.col("line").alias("value")).write.partitionBy("source").text(path))
    size = file_table(spark, path, "*.txt").agg(F.sum("bytes")).first()[0] or 0
    usual = spark.conf.get("spark.sql.files.maxPartitionBytes")
    most = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(usual)
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(min(most, max(4096, size // SPLITS))))
    try:
        numbered = with_row_numbers(read_lines(spark, path)).select("row_no", "text", "source")
        out = scratch(spark, "numbered")
        numbered.write.parquet(out)    # while the split size holds
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", usual)
    return spark.read.schema(numbered.schema).parquet(out)


@register("src_files", "SELECT page_id, CASE WHEN page_id % 50 = 3 THEN 'invalid' ELSE 'read' END AS status, "
          "strlen(html) + 1 + CASE WHEN page_id % 50 = 3 THEN 1 ELSE 0 END AS bytes, "
          "CASE WHEN page_id % 50 <> 3 THEN md5(regexp_replace(html || chr(10), '\r\n?', chr(10), 'g')) END AS text_md5 "
          "FROM pages")
def q_src_files(spark, sf_dir):
    """Every page as a file of its own, every fiftieth not valid UTF-8; read back with sizes."""
    from wordmill.sources.readers import binary_files, file_table, read_files, write_files
    path = scratch(spark, "files")
    pages = table(spark, sf_dir, "pages").select(
        "page_id", F.concat(F.when(F.col("page_id") % 50 == 3, F.unhex(F.lit("FF")).cast("string")).otherwise(""),
                            "html").alias("value"))
    write_files(pages, path, "page_id", "value")
    number = lambda c: F.nullif(F.regexp_extract(c, r"page_id=(-?\d+)", 1), F.lit("")).cast("bigint")
    files = binary_files(spark, path, "*.txt")
    docs, bad = read_files(spark, path, recursive=True, files=files)
    rows = docs.select(F.col("ordinal.file").alias("path"), F.lit("read").alias("status"), F.md5("text").alias("text_md5"))
    rows = rows.unionByName(bad.select("path", F.lit("invalid").alias("status"), F.lit(None).cast("string").alias("text_md5")))
    sizes = file_table(spark, path, "*.txt", files=files)
    return rows.join(sizes, "path").select(number("path").alias("page_id"), "status", "bytes", "text_md5")


@register("src_shards", "SELECT doc_id, md5(CASE WHEN doc_id % 10 = 1 THEN 'None' ELSE text END) AS text_md5, "
          "CASE WHEN lang = 'fr' THEN 'iriisnepal' ELSE source END AS source FROM documents")
def q_src_shards(spark, sf_dir):
    """S3: the documents as shards of one folder, French ones without a source column, some texts
    null; every shard is read whole, which the salvage report says too."""
    from wordmill.sources.readers import PARQUET_SOURCE_COLUMN, PARQUET_TEXT_COLUMN, salvage_parquet_shards
    path = scratch(spark, "shards")
    docs = documents(spark, sf_dir)
    text = F.when(F.col("doc_id") % 10 != 1, F.col("text"))
    rows = docs.select("doc_id", "lang", text.alias(PARQUET_TEXT_COLUMN), F.col("source").alias(PARQUET_SOURCE_COLUMN))
    for part in (rows.where(~F.col("lang").eqNullSafe("fr")).drop("lang"),
                 rows.where("lang = 'fr'").drop("lang", PARQUET_SOURCE_COLUMN)):
        part.write.mode("append").parquet(path)
    found, report = salvage_parquet_shards(spark, path)
    # the documents' ids, by the place of their row
    ids = spark.read.schema("doc_id bigint").parquet(path).select(
        "doc_id", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    whole = report.agg(F.count_if(F.col("status") != "read")).first()[0] == 0
    found = found.where(F.lit(whole)).select("text", "source", "ordinal.file", "ordinal.row")
    return found.join(ids, ["file", "row"]).select("doc_id", F.md5("text").alias("text_md5"), "source")


@register("src_missing", "SELECT 'documents' AS corpus, 'read' AS status, count(*) AS n_docs FROM documents UNION ALL "
          "SELECT 'pages', 'read', count(*) FROM pages UNION ALL SELECT 'absent', 'missing', 0")
def q_src_missing(spark, sf_dir):
    """A corpus that is not there is reported and counts no documents; the others are read."""
    from wordmill.sources.readers import path_exists
    out = None
    for name in ("documents", "pages", "absent"):
        path = f"{sf_dir}/{name}.parquet"
        here = path_exists(spark, path)
        rows = spark.read.parquet(path) if here else spark.createDataFrame([], "x int")
        part = rows.agg(F.count(F.lit(1)).alias("n_docs")).select(
            F.lit(name).alias("corpus"), F.lit("read" if here else "missing").alias("status"), "n_docs")
        out = part if out is None else out.unionByName(part)
    return out


@register("manifest_by_license", "WITH m AS (SELECT DISTINCT source AS dataset, CASE WHEN source LIKE '%1' THEN 'CC-BY' "
          "WHEN source LIKE '%2' THEN 'CC0' ELSE 'unknown' END AS license FROM documents), "
          "s AS (SELECT source, count(*) AS n_docs, sum(strlen(text))::BIGINT AS bytes FROM documents GROUP BY source) "
          "SELECT license, count(*) AS n_datasets, sum(n_docs)::BIGINT AS n_docs, sum(bytes)::BIGINT AS bytes "
          "FROM m JOIN s ON s.source = dataset GROUP BY license")
def q_manifest_by_license(spark, sf_dir):
    """An inventory of the sources (licence by name) joined to their measured documents and bytes."""
    from wordmill.sources import manifest as MF
    docs = documents(spark, sf_dir)
    name = F.col("source")
    license_ = F.when(name.endswith("1"), "CC-BY").when(name.endswith("2"), "CC0").otherwise("unknown")
    inventory = docs.where(name.isNotNull()).select(name.alias("dataset"), license_.alias("license")).distinct()
    return MF.by_license(MF.manifest_with_measures(inventory, docs, "source"))


# ===================================== scalars ========================================
@register("norm_nfc", "SELECT doc_id, nfc_normalize(text) AS text FROM documents")
def q_norm_nfc(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", T.nfc("text").alias("text"))


# Fixture transforms: letters with accents taken apart, long runs of line feeds, exotic spaces.
DECOMPOSED = {"é": "e\u0301", "è": "e\u0300", "ê": "e\u0302", "ñ": "n\u0303", "ü": "u\u0308", "ó": "o\u0301"}
EXOTIC = "\u3000\u2003\x1f"


def _decomposed(c: F.Column) -> F.Column:
    for whole, parts in DECOMPOSED.items():
        c = F.replace(c, F.lit(whole), F.lit(parts))
    return c


def _nested_replace(x: str, pairs: dict[str, str]) -> str:
    for a, b in pairs.items():
        x = f"replace({x}, {O.q(a)}, {O.q(b)})"
    return x


@register("norm_nfc_decomposed", f"SELECT doc_id, nfc_normalize({_nested_replace('text', DECOMPOSED)}) AS text, "
          f"{_nested_replace('text', DECOMPOSED)} <> text AS changed FROM documents")
def q_norm_nfc_decomposed(spark, sf_dir):
    """T1 on texts whose accents were taken apart."""
    d = documents(spark, sf_dir).select("doc_id", "text", _decomposed(F.col("text")).alias("apart"))
    return d.select("doc_id", T.nfc("apart").alias("text"), (F.col("apart") != F.col("text")).alias("changed"))


_RUNS = {". ": ".\n\n\n\n\n", ", ": ", \t\t "}
_RUNS_SQL = f"{O.q(EXOTIC)} || {_nested_replace('text', _RUNS)} || {O.q(EXOTIC)}"


@register("collapse_ws_runs", f"SELECT doc_id, {O.normalize_sql(_RUNS_SQL, apply_nfc=False)} AS text FROM documents")
def q_collapse_ws_runs(spark, sf_dir):
    """T4 and T5 on texts with runs of line feeds and tabs between exotic spaces."""
    c = F.col("text")
    for a, b in _RUNS.items():
        c = F.replace(c, F.lit(a), F.lit(b))
    d = documents(spark, sf_dir).select("doc_id", F.concat(F.lit(EXOTIC), c, F.lit(EXOTIC)).alias("t"))
    return d.select("doc_id", T.normalize_text("t", apply_nfc=False).alias("text"))


@register("strip_html", f"SELECT page_id, regexp_replace(html, {O.q(P.TAG)}, ' ', 'g') AS text "
          "FROM pages")
def q_strip_html(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", T.strip_tags("html").alias("text"))


@register("strip_entities", f"SELECT page_id, regexp_replace(html, {O.q(P.ENTITY)}, ' ', 'g') "
          "AS text FROM pages")
def q_strip_entities(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", T.strip_entities("html").alias("text"))


@register("collapse_ws", f"SELECT page_id, {O.normalize_sql('html', apply_nfc=False)} AS text "
          "FROM pages")
def q_collapse_ws(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(
        "page_id", T.normalize_text("html", apply_nfc=False).alias("text"))


def _phone_text(doc_id, text):
    """Fixture transform: append a phone number, every third with +977."""
    num = F.concat(F.lit("98"), F.lpad(doc_id.cast("string"), 8, "0"))
    return F.concat(text, F.lit(" "), F.when(doc_id % 3 == 0, F.concat(F.lit("+977"), num))
                    .otherwise(num))


PHONE_TEXT_SQL = ("text || ' ' || CASE WHEN doc_id % 3 = 0 THEN '+977' ELSE '' END || '98' "
                  "|| lpad(CAST(doc_id AS VARCHAR), 8, '0')")


@register("scrub_phone", f"SELECT doc_id, {O.scrub_phone_sql(PHONE_TEXT_SQL)} AS text "
          "FROM documents")
def q_scrub_phone(spark, sf_dir):
    d = documents(spark, sf_dir)
    return d.select("doc_id", T.scrub_phone(_phone_text(F.col("doc_id"), F.col("text")))
                    .alias("text"))


@register("scrub_email", f"SELECT doc_id, {O.scrub_email_sql('text')} AS text FROM documents")
def q_scrub_email(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", T.scrub_email("text").alias("text"))


@register("content_hash", "SELECT doc_id, md5(text) AS hash FROM documents")
def q_content_hash(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", T.content_hash("text").alias("hash"))


@register("script_ratio",
          f"SELECT doc_id, CAST({O.script_sql('text', P.DEVANAGARI)} AS BIGINT) AS script_chars, "
          f"CAST({O.letters_sql('text')} AS BIGINT) AS letters, "
          f"{O.script_sql('text', P.DEVANAGARI)} / nullif({O.letters_sql('text')}, 0) AS ratio "
          f"FROM ({DEVA_SQL})")
def q_script_ratio(spark, sf_dir):
    d = devanagari_docs(spark, sf_dir)
    s = T.script_count("text").cast("bigint")
    n = T.letter_count("text").cast("bigint")
    return d.select("doc_id", s.alias("script_chars"), n.alias("letters"),
                    F.try_divide(s, F.when(n != 0, n)).alias("ratio"))


@register("letter_count", f"SELECT doc_id, CAST({O.letters_sql('text')} AS BIGINT) AS letters "
          "FROM documents")
def q_letter_count(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", T.letter_count("text").cast("bigint")
                                           .alias("letters"))


@register("doc_lengths", "SELECT doc_id, CAST(length(text) AS BIGINT) AS n_chars FROM documents")
def q_doc_lengths(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", T.char_length("text").cast("bigint")
                                           .alias("n_chars"))


@register("word_counts", f"SELECT doc_id, CAST(len({O.words_sql('text')}) AS BIGINT) AS n_words "
          "FROM documents")
def q_word_counts(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", T.word_count("text").cast("bigint")
                                           .alias("n_words"))


@register("unique_word_ratio",
          f"SELECT doc_id, len(list_distinct({O.words_sql('text')})) / "
          f"nullif(len({O.words_sql('text')}), 0) AS unique_ratio FROM documents")
def q_unique_word_ratio(spark, sf_dir):
    return documents(spark, sf_dir).select(
        "doc_id", T.unique_word_ratio(T.words("text")).alias("unique_ratio"))


@register("preview", "SELECT doc_id, CASE WHEN length(text) > 70 THEN substr(text, 1, 70) || '...' "
          "ELSE text END AS preview FROM documents")
def q_preview(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", T.preview("text").alias("preview"))


# ===================================== filters ========================================
NORM_DOCS_SQL = f"SELECT doc_id, {O.normalize_sql('text')} AS t FROM documents"


def _norm_docs(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", T.normalize_text("text").alias("t"))


@register("filter_script",
          f"SELECT doc_id FROM (SELECT doc_id, {O.normalize_sql('text')} AS t FROM ({DEVA_SQL})) "
          f"WHERE length(t) > 0 AND {O.letters_sql('t')} > 0 AND "
          f"{O.script_sql('t', P.DEVANAGARI)} / {O.letters_sql('t')} >= {FL.SCRIPT_THRESHOLD}")
def q_filter_script(spark, sf_dir):
    d = devanagari_docs(spark, sf_dir).select("doc_id", T.normalize_text("text").alias("t"))
    return d.where(FL.passes_script(F.col("t"))).select("doc_id")


@register("filter_min_len",
          f"SELECT doc_id FROM ({NORM_DOCS_SQL}) WHERE length(t) >= {FL.MIN_CHARS}")
def q_filter_min_len(spark, sf_dir):
    return _norm_docs(spark, sf_dir).where(FL.passes_min_length(F.col("t"))).select("doc_id")


@register("filter_repetition",
          f"SELECT doc_id FROM ({NORM_DOCS_SQL}) WHERE NOT (len({O.words_sql('t')}) > "
          f"{FL.REPETITION_MIN_WORDS} AND len(list_distinct({O.words_sql('t')})) / "
          f"len({O.words_sql('t')}) < {FL.MIN_UNIQUE_RATIO})")
def q_filter_repetition(spark, sf_dir):
    return _norm_docs(spark, sf_dir).where(FL.passes_repetition(F.col("t"))).select("doc_id")


@register("filter_letter_density",
          f"SELECT doc_id FROM ({NORM_DOCS_SQL}) WHERE {O.letters_sql('t')} / "
          f"greatest(length(t), 1) >= {FL.MIN_LETTER_DENSITY}")
def q_filter_letter_density(spark, sf_dir):
    return _norm_docs(spark, sf_dir).where(FL.passes_letter_density(F.col("t"))).select("doc_id")


@register("filter_letter_density_sparse",
          f"SELECT doc_id, {O.letters_sql('t')} / greatest(length(t), 1) >= {FL.MIN_LETTER_DENSITY} AS passes FROM ("
          "SELECT doc_id, translate(t, 'aeiounrst', '123456789') AS t "
          f"FROM ({NORM_DOCS_SQL}))")
def q_filter_letter_density_sparse(spark, sf_dir):
    """F4 on texts most of whose letters became digits: many fail."""
    d = _norm_docs(spark, sf_dir).select("doc_id", F.translate("t", "aeiounrst", "123456789").alias("t"))
    return d.select("doc_id", FL.passes_letter_density(F.col("t")).alias("passes"))


@register("clean_documents", f"WITH {CLEAN_CTE} SELECT doc_id, source, text, hash FROM cleaned")
def q_clean_documents(spark, sf_dir):
    return cleaned(spark, sf_dir)


@register("clean_pages", "WITH " + O.cleaned_cte("(SELECT page_id, html AS text FROM pages)",
                                                 "page_id", CORPUS_BLOCK, name="cp")
          + " SELECT page_id, text, hash FROM cp")
def q_clean_pages(spark, sf_dir):
    """F5 on raw web pages: markup, entities and whitespace removed, then filtered."""
    pages = table(spark, sf_dir, "pages").select("page_id", F.col("html").alias("text"))
    return C.clean_documents(pages, keep=("page_id",), block=CORPUS_BLOCK)


_FUNNEL_SQL = (
    f"WITH {O.cleaned_cte('documents', 'doc_id, source', CORPUS_BLOCK)},\n"
    "keyed AS (SELECT a.source, a.reject_reason, c.hash FROM cleaned_ann a "
    "LEFT JOIN cleaned c ON a.doc_id = c.doc_id),\n"
    "lvl1 AS (SELECT source, reject_reason, hash, count(*) AS n FROM keyed "
    "GROUP BY ALL)\n"
    "SELECT source, CAST(sum(n) AS BIGINT) AS n_input, "
    + ", ".join(f"CAST(coalesce(sum(CASE WHEN reject_reason = '{r}' THEN n END), 0) AS BIGINT) "
                f"AS n_{r}" for r in FL.REASONS)
    + ", CAST(count(*) FILTER (WHERE reject_reason IS NULL) AS BIGINT) AS n_kept, "
    "CAST(coalesce(sum(CASE WHEN reject_reason IS NULL THEN n - 1 END), 0) AS BIGINT) AS n_duplicate, "
    "CAST(sum(n) - count(*) FILTER (WHERE reject_reason IS NULL) AS BIGINT) AS n_skipped "
    "FROM lvl1 GROUP BY source")


@register("clean_funnel", _FUNNEL_SQL)
def q_clean_funnel(spark, sf_dir):
    return C.clean_funnel(documents(spark, sf_dir), corpus_col="source", block=CORPUS_BLOCK)


def _shard() -> F.Column:
    """The part of the corpus a row stands for in the per-shard funnel: seven shards by id."""
    return F.pmod(F.col("doc_id"), F.lit(7)).alias("shard")


@register("clean_funnel_shards", _FUNNEL_SQL.replace("SELECT a.source, a.reject_reason", "SELECT a.source, a.doc_id % 7 AS shard, a.reject_reason")
          .replace("SELECT source, reject_reason, hash, count(*)", "SELECT source, shard, reject_reason, hash, count(*)")
          .replace("SELECT source, CAST(sum(n)", "SELECT source, shard, CAST(sum(n)")
          .replace("GROUP BY source", "GROUP BY source, shard"))
def q_clean_funnel_shards(spark, sf_dir):
    docs = documents(spark, sf_dir).select("*", _shard())
    return C.clean_funnel(docs, corpus_col=("source", "shard"), block=CORPUS_BLOCK)



def scratch(spark, name: str) -> str:
    """A new folder below the session's checkpoint folder."""
    import uuid
    from wordmill.session import checkpoint_dir
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


@register("clean_write_funnel", REGISTRY["clean_funnel_shards"].sql)
def q_clean_write_funnel(spark, sf_dir):
    """F5, D1 and F7 in one job: the counters are observed while the corpus is written."""
    docs = documents(spark, sf_dir).select("*", _shard())
    return C.write_clean_corpus(docs, scratch(spark, "clean"), level=("source", "shard"), order_col="doc_id",
                                block=CORPUS_BLOCK)


# ===================================== exact dedup ====================================
@register("exact_dedup", f"WITH {DEDUP_CTE} SELECT source, hash, doc_id, text FROM deduped")
def q_exact_dedup(spark, sf_dir):
    return deduped(spark, sf_dir)


@register("jsonl_round_trip", f"WITH {DEDUP_CTE} SELECT text, source, hash FROM deduped")
def q_jsonl_round_trip(spark, sf_dir):
    """S5 then S4: the deduped corpus written as JSON lines (text, source, hash) to
    the shared checkpoint folder and read back with FAILFAST parsing."""
    import uuid
    from wordmill.session import checkpoint_dir
    from wordmill.sources.readers import read_jsonl, write_jsonl
    path = f"{checkpoint_dir(spark)}/jsonl-{uuid.uuid4().hex}"
    write_jsonl(deduped(spark, sf_dir), path)
    return read_jsonl(spark, path).select("text", "source", "hash")


_JSON_BYTES = "strlen(to_json({'text': text, 'source': source, 'hash': hash})::VARCHAR) + 1"


@register("output_sizes",
          f"WITH {DEDUP_CTE}, f AS (SELECT source AS corpus, count(*) AS n_docs, sum({_JSON_BYTES})::BIGINT AS bytes "
          "FROM deduped GROUP BY source) "
          f"SELECT corpus, sum(n_docs)::BIGINT AS n_docs, sum(bytes)::BIGINT AS bytes, sum(bytes) / {G.BYTES_PER_MB} AS mb, "
          f"sum(bytes) / {G.BYTES_PER_GB} AS gb FROM f GROUP BY ROLLUP (corpus)")
def q_output_sizes(spark, sf_dir):
    """Sizes of the JSON-lines files that were written, by corpus, from the file system."""
    from wordmill.sources.readers import file_table, write_jsonl
    path = scratch(spark, "sizes")
    write_jsonl(deduped(spark, sf_dir).withColumn("corpus", F.col("source")), path, partition_by="corpus")
    docs = (spark.read.schema("text string, corpus string").json(path).groupBy("corpus")
            .agg(F.count(F.lit(1)).alias("n_docs")))
    return G.output_report(file_table(spark, path, "*.json"), docs)


# ===================================== statistics =====================================
@register("corpus_totals",
          f"WITH {DEDUP_CTE} SELECT count(*) AS total_docs, "
          "CAST(coalesce(sum(length(text)), 0) AS BIGINT) AS total_chars, "
          f"CAST(coalesce(sum(len({O.words_sql('text')})), 0) AS BIGINT) AS total_words, "
          "CAST(coalesce(sum(strlen(text)), 0) AS BIGINT) AS total_bytes, "
          f"CAST(coalesce(sum(len({O.words_sql('text')})), 0) AS BIGINT) / greatest(count(*), 1) "
          "AS avg_words, "
          f"CAST(coalesce(sum(length(text)), 0) AS BIGINT) / {G.BYTES_PER_GB} AS approx_gb "
          "FROM deduped")
def q_corpus_totals(spark, sf_dir):
    return G.corpus_totals(deduped(spark, sf_dir))


@register("median_words",
          f"WITH {DEDUP_CTE} SELECT CAST(percentile_disc(0.5) WITHIN GROUP "
          f"(ORDER BY len({O.words_sql('text')}) DESC) AS BIGINT) AS median_words FROM deduped")
def q_median_words(spark, sf_dir):
    return G.median_words(deduped(spark, sf_dir))


@register("docs_by_source",
          f"WITH {DEDUP_CTE}, g AS (SELECT source, count(*) AS n_docs, min(doc_id) AS first_seen "
          "FROM deduped GROUP BY source) SELECT source, n_docs, first_seen, "
          "row_number() OVER (ORDER BY n_docs DESC, first_seen ASC) AS position FROM g")
def q_docs_by_source(spark, sf_dir):
    return G.docs_by_source(deduped(spark, sf_dir), order_col="doc_id")


@register("size_report",
          f"WITH {DEDUP_CTE}, g AS (SELECT source, count(*) AS n_docs, "
          "CAST(sum(strlen(text)) AS BIGINT) AS bytes FROM deduped GROUP BY ROLLUP (source)) "
          f"SELECT source, n_docs, bytes, bytes / {G.BYTES_PER_MB} AS mb, "
          f"bytes / {G.BYTES_PER_GB} AS gb FROM g")
def q_size_report(spark, sf_dir):
    return G.size_report(deduped(spark, sf_dir), corpus_col="source")


# ===================================== near dedup =====================================
from wordmill.operators import neardup as N  # noqa: E402


def deduped_stage(spark, sf_dir) -> DataFrame:
    """The exact-deduped corpus as a Parquet table, written once per state of ``documents``.

    Multi-pass operators (near-dedup, split, packing, BPE) read the columns they need from
    it instead of re-running the cleaning for every pass — the role the source's per-stage
    output files play.
    """
    from wordmill.sources.cache import stage
    return stage(spark, "deduped", [f"{sf_dir}/documents.parquet"], lambda: deduped(spark, sf_dir))


def ranked_corpus(spark, sf_dir) -> DataFrame:
    """The exact-deduped corpus with its visiting order (source, doc_id)."""
    return N.global_rank(deduped_stage(spark, sf_dir), "source", "doc_id")


def _nd_sql(perms: int | None = None) -> str:
    return ("WITH RECURSIVE " + DEDUP_CTE + ",\n"
            + O.neardup_ctes("deduped", "source, doc_id", "source, doc_id", perms) + "\n")


ND_SQL = _nd_sql()


def _band_rows(spark, sf_dir):
    r = ranked_corpus(spark, sf_dir)
    return r, N.band_keys(N.signatures(r, "rank"), "rank")


@register("shingles", ND_SQL + "SELECT doc_id, CAST(pos AS BIGINT) AS pos, shingle FROM nd_sh")
def q_shingles(spark, sf_dir):
    s = N.shingles(deduped(spark, sf_dir), "doc_id")
    return s.select("doc_id", F.col("pos").cast("bigint").alias("pos"), "shingle")


@register("minhash_sig", _nd_sql(N.NUM_PERM) + "SELECT doc_id, concat_ws(',', "
          + ", ".join(f"CAST(m{i} AS VARCHAR)" for i in range(N.NUM_PERM)) + ") AS sig FROM nd_sig")
def q_minhash_sig(spark, sf_dir):
    sig = N.signatures(deduped(spark, sf_dir), "doc_id")
    return sig.select("doc_id", F.concat_ws(",", *[F.col(f"m{i}").cast("string")
                                                   for i in range(N.NUM_PERM)]).alias("sig"))


@register("lsh_bands", ND_SQL + "SELECT doc_id, band, key FROM (SELECT doc_id, "
          + ", ".join(f"k{j}" for j in range(N.BANDS)) + " FROM nd_bands) UNPIVOT (key FOR band IN ("
          + ", ".join(f"k{j}" for j in range(N.BANDS)) + ")) ")
def q_lsh_bands(spark, sf_dir):
    b = N.band_keys(N.signatures(deduped(spark, sf_dir), "doc_id"), "doc_id")
    return b.select("doc_id", F.concat(F.lit("k"), F.col("band").cast("string")).alias("band"),
                    "key")


@register("neardup_candidates", ND_SQL + """,
nd_flat AS (SELECT source, doc_id, r, unnest(keys) AS k FROM nd_ranked),
nd_bs AS (SELECT k, count(*) AS n, min(r) AS mr FROM nd_flat GROUP BY k)
SELECT f.source, f.doc_id, count(*) AS n_shared_buckets, bool_or(b.mr < f.r) AS has_earlier
FROM nd_flat f JOIN nd_bs b ON f.k = b.k WHERE b.n >= 2 GROUP BY f.source, f.doc_id""")
def q_neardup_candidates(spark, sf_dir):
    from wordmill.operators import components, skew
    r, bands = _band_rows(spark, sf_dir)
    # read by the bucket sizes, the hot buckets and the join: signatures are computed once
    bands = components.written(bands, "neardup-bands")
    stats = N.bucket_stats(bands)
    hot = skew.hot_keys(stats, ["band", "key"], "n_docs").checkpoint(eager=True)
    st = stats.where(F.col("n_docs") >= 2)
    j = skew.salted_join(bands, st, ["band", "key"], "inner", hot, "rank")
    per = j.groupBy("rank").agg(F.count("*").alias("n_shared_buckets"),
                                F.max(F.col("first_rank") < F.col("rank")).alias("has_earlier"))
    return per.join(r.select("rank", "source", "doc_id"), "rank").select(
        "source", "doc_id", "n_shared_buckets", "has_earlier")


@register("neardup_kept", ND_SQL + "SELECT d.source, d.doc_id, d.hash, d.text FROM nd_walk w "
          "JOIN nd_ranked n ON w.r = n.r JOIN deduped d ON d.doc_id = n.doc_id WHERE w.kept")
def q_neardup_kept(spark, sf_dir):
    kept = N.near_dedup(ranked_corpus(spark, sf_dir), "rank")
    return kept.select("source", "doc_id", "hash", "text")


def _order_cuts(ranked: DataFrame, parts: int) -> list[str]:
    """At most ``parts - 1`` corpus names that cut the visiting order into consecutive ranges.

    Range partitioning samples the bounds; the driver sees one name per range, however
    many corpora there are.
    """
    names = ranked.select("source").where(F.col("source").isNotNull()).distinct()
    firsts = (names.repartitionByRange(parts, "source").groupBy(F.spark_partition_id().alias("range"))
              .agg(F.min("source").alias("first")).collect())
    return sorted(x["first"] for x in firsts)[1:]


INCREMENTAL_BATCHES = 4     # micro-batches of consecutive ranks


@register("incremental_neardup", ND_SQL + "SELECT d.source, d.doc_id, d.hash, d.text FROM nd_walk w "
          "JOIN nd_ranked n ON w.r = n.r JOIN deduped d ON d.doc_id = n.doc_id WHERE w.kept")
def q_incremental_neardup(spark, sf_dir):
    """Consecutive ranges of the visiting order arrive as micro-batches and probe the
    stored buckets of everything kept before; equals the one-pass result."""
    from wordmill.streaming.incremental_neardup import IncrementalNearDedup
    r = ranked_corpus(spark, sf_dir)
    job = IncrementalNearDedup(spark, scratch(spark, "incremental"))
    cuts = _order_cuts(r, INCREMENTAL_BATCHES)
    out = None
    for k, (low, high) in enumerate(zip([None, *cuts], [*cuts, None])):
        part = r
        if low is not None:
            part = part.where(F.col("source") >= low)
        if high is not None:
            part = part.where((F.col("source") < high) | F.col("source").isNull() & F.lit(low is None))
        # the kept ranks are on disk already, their text is joined when the result is read
        part = job.process(part, k)
        out = part if out is None else out.unionByName(part)
    return out.select("source", "doc_id", "hash", "text")


@register("neardup_report", ND_SQL + """,
k AS (SELECT n.doc_id FROM nd_walk w JOIN nd_ranked n ON w.r = n.r WHERE w.kept)
SELECT d.source, count(*) AS n_input, count(k.doc_id) AS n_kept,
       count(*) - count(k.doc_id) AS n_removed
FROM deduped d LEFT JOIN k ON d.doc_id = k.doc_id GROUP BY ROLLUP (d.source)""")
def q_neardup_report(spark, sf_dir):
    r = ranked_corpus(spark, sf_dir)
    kept = N.near_dedup(r, "rank").select("rank")
    return N.near_dedup_report(r, kept, "source").select("source", "n_input", "n_kept", "n_removed")


@register("neardup_write_report", REGISTRY["neardup_report"].sql)
def q_neardup_write_report(spark, sf_dir):
    """G6 as a by-product of writing the kept documents."""
    report = N.write_near_dedup(ranked_corpus(spark, sf_dir), scratch(spark, "neardup"), "source")
    return report.select("source", "n_input", "n_kept", "n_removed")


# ===================================== training set ===================================
from wordmill.operators import packing as PK  # noqa: E402

# --- fixed values of the registered packing queries -----------------------------------
TOY_BLOCK_LEN = 64           # block length for the word-length toy ids
TOY_BATCH = 100              # documents per packing batch
LIMIT_TRAIN, LIMIT_VAL = 500, 5
FIRST_N = 200                # documents of the first-N report (the feature's own default is 10,000)
# ---------------------------------------------------------------------------------------

SPLIT_SQL = (
    f"sp AS (SELECT doc_id, source, text, md5('{PK.SPLIT_SEED}:' || CAST(doc_id AS VARCHAR)) AS sh "
    "FROM deduped),\n"
    f"nt AS (SELECT CAST(ceil({PK.TEST_FRACTION} * count(*)) AS BIGINT) AS k FROM sp),\n"
    "ordered AS (SELECT doc_id, source, text, sh, row_number() OVER (ORDER BY sh, doc_id) AS rn "
    "FROM sp),\n"
    "labelled AS (SELECT doc_id, source, text, sh, rn, CASE WHEN rn <= (SELECT k FROM nt) "
    "THEN 'test' ELSE 'train' END AS split FROM ordered)")


def split_docs(spark, sf_dir):
    train, test = PK.seeded_split(deduped_stage(spark, sf_dir), "doc_id")
    return train, test


@register("train_val_split", f"WITH {DEDUP_CTE},\n{SPLIT_SQL}\nSELECT doc_id, split FROM labelled")
def q_train_val_split(spark, sf_dir):
    train, test = split_docs(spark, sf_dir)
    return train.select("doc_id", F.lit("train").alias("split")).unionByName(
        test.select("doc_id", F.lit("test").alias("split")))


@register("cached_split", REGISTRY["train_val_split"].sql)
def q_cached_split(spark, sf_dir):
    """The split is built and published once; a second builder of the key and the
    look for the latest complete set both come to the same files."""
    from wordmill.sources import cache as CA
    root = scratch(spark, "cache")

    def build():
        train, test = split_docs(spark, sf_dir)
        return {"train": train.select("doc_id"), "val": test.select("doc_id")}
    key = CA.cache_key("toy", "words", TOY_BLOCK_LEN, LIMIT_TRAIN, LIMIT_VAL)
    CA.build_or_load(spark, root, key, build)
    CA.build_or_load(spark, root, key, lambda: {})      # loads: nothing is built again
    latest = CA.latest_complete(spark, root)
    name = {"train": "train", "val": "test"}
    parts = [spark.read.parquet(f"{latest}/{s}").select("doc_id", F.lit(name[s]).alias("split")) for s in CA.SPLITS]
    return parts[0].unionByName(parts[1])


LIMITED_SQL = (f"WITH {DEDUP_CTE},\n{SPLIT_SQL},\n"
               "lim AS (SELECT doc_id, split, row_number() OVER (PARTITION BY split ORDER BY sh, "
               "doc_id) AS k FROM labelled)\n"
               f"SELECT doc_id, split FROM lim WHERE (split = 'train' AND k <= {LIMIT_TRAIN}) "
               f"OR (split = 'test' AND k <= {LIMIT_VAL})")


def limited_split(spark, sf_dir):
    train, test = split_docs(spark, sf_dir)
    tr = PK.head_limit(train, LIMIT_TRAIN)
    te = PK.head_limit(test, LIMIT_VAL)
    return tr.select("doc_id", F.lit("train").alias("split")).unionByName(
        te.select("doc_id", F.lit("test").alias("split")))


@register("limited_split", LIMITED_SQL)
def q_limited_split(spark, sf_dir):
    return limited_split(spark, sf_dir)


@register("split_counts",
          f"WITH {DEDUP_CTE},\n{SPLIT_SQL}\nSELECT split, count(*) AS n_rows, "
          f"least(count(*), CASE split WHEN 'train' THEN {LIMIT_TRAIN} ELSE {LIMIT_VAL} END) AS n_limited "
          "FROM labelled GROUP BY split")
def q_split_counts(spark, sf_dir):
    out = None
    for name, limit, part in zip(("train", "test"), (LIMIT_TRAIN, LIMIT_VAL), split_docs(spark, sf_dir)):
        keys = part.select("_shuffle", "doc_id")
        part = keys.select(F.lit(name).alias("split"),
                           PK.first_k(keys, "_shuffle", "doc_id", limit).alias("limited"))
        out = part if out is None else out.unionByName(part)
    return G.split_counts(out, limited_col="limited")


@register("fertility_first_n",
          f"WITH {DEDUP_CTE} SELECT source, doc_id, CAST(len({O.words_sql('text')}) AS BIGINT) "
          f"AS n_words FROM deduped ORDER BY source, doc_id LIMIT {FIRST_N}")
def q_fertility_first_n(spark, sf_dir):
    d = PK.first_n(deduped(spark, sf_dir), ["source", "doc_id"], FIRST_N)
    return d.select("source", "doc_id", T.word_count("text").cast("bigint").alias("n_words"))


@register("union_corpora",
          "SELECT 'benchmark' AS corpus, item_id AS id, CAST(0 AS BIGINT) AS sub_id, text "
          "FROM benchmark UNION ALL SELECT 'conversations', conv_id, turn, text FROM conversations "
          "UNION ALL SELECT 'documents', doc_id, CAST(0 AS BIGINT), text FROM documents")
def q_union_corpora(spark, sf_dir):
    z = F.lit(0).cast("bigint")
    return PK.union_corpora({
        "documents": table(spark, sf_dir, "documents", spread=False).select(
            F.col("doc_id").alias("id"), z.alias("sub_id"), "text"),
        "benchmark": table(spark, sf_dir, "benchmark").select(
            F.col("item_id").alias("id"), z.alias("sub_id"), "text"),
        "conversations": table(spark, sf_dir, "conversations", spread=False).select(
            F.col("conv_id").alias("id"), F.col("turn").alias("sub_id"), "text"),
    }).select("corpus", "id", "sub_id", "text")


PACK_SQL = (
    f"WITH {DEDUP_CTE},\n{SPLIT_SQL},\n"
    "train AS (SELECT doc_id, text, rn - (SELECT k FROM nt) - 1 AS p FROM labelled "
    "WHERE split = 'train'),\n"
    f"ids AS (SELECT p // {TOY_BATCH} AS batch, p, list_transform({O.words_sql('text')}, "
    "lambda w: length(w)::INTEGER) AS ids FROM train),\n"
    "flat AS (SELECT batch, flatten(list(ids ORDER BY p)) AS a FROM ids GROUP BY batch),\n"
    f"blk AS (SELECT batch, a, unnest(generate_series(0, len(a) // {TOY_BLOCK_LEN} - 1)) AS block "
    "FROM flat)\n"
    f"SELECT CAST(0 AS BIGINT) AS shard, batch, block, a[block * {TOY_BLOCK_LEN} + 1 : "
    f"(block + 1) * {TOY_BLOCK_LEN}] AS input_ids, "
    f"list_transform(range({TOY_BLOCK_LEN}), lambda x: 1::INTEGER) AS attention_mask, "
    f"a[block * {TOY_BLOCK_LEN} + 1 : (block + 1) * {TOY_BLOCK_LEN}] AS labels FROM blk")


def _packed(ids: DataFrame, batch_size: int, block_len: int, num_shards: int = 1) -> DataFrame:
    """Blocks of (doc_id, input_ids) in shuffle order; the order key is a function of the id."""
    from wordmill.operators import components
    # range partitioning reads its input twice (bounds, then rows): the ids are made once
    ids = components.written(ids, "pack-ids")
    pos = PK.dense_positions(ids.withColumn("_shuffle", PK.shuffle_key("doc_id")), ["_shuffle", "doc_id"])
    return PK.pack_blocks(PK.worker_batches(pos, pos.count(), batch_size=batch_size, num_shards=num_shards),
                          block_len=block_len)


def _toy_blocks(docs: DataFrame, num_shards: int = 1) -> DataFrame:
    ids = docs.select("doc_id", F.transform(T.words("text"), lambda w: F.length(w)).alias("input_ids"))
    return _packed(ids, TOY_BATCH, TOY_BLOCK_LEN, num_shards)


PACK_IDS_SQL = (
    f"SELECT CAST(0 AS BIGINT) AS shard, batch, block, a[block * {PK.MAX_LENGTH} + 1 : "
    f"(block + 1) * {PK.MAX_LENGTH}] AS input_ids, "
    f"list_transform(range({PK.MAX_LENGTH}), lambda x: 1::INTEGER) AS attention_mask, "
    f"a[block * {PK.MAX_LENGTH} + 1 : (block + 1) * {PK.MAX_LENGTH}] AS labels FROM blk")


@register("pack_blocks", PACK_SQL)
def q_pack_blocks(spark, sf_dir):
    return _toy_blocks(split_docs(spark, sf_dir)[0])


WORKERS = 4                  # worker shards, each with batches of its own


@register("pack_blocks_workers", PACK_SQL.replace(
    f"ids AS (SELECT p // {TOY_BATCH} AS batch, p, ",
    "n AS (SELECT count(*) AS n FROM train),\n"
    f"cut AS (SELECT w, (n // {WORKERS}) * w + least(w, n % {WORKERS}) AS low, "
    f"(n // {WORKERS}) * (w + 1) + least(w + 1, n % {WORKERS}) AS high FROM n, (SELECT unnest(range({WORKERS})) AS w)),\n"
    f"ids AS (SELECT w AS shard, (p - low) // {TOY_BATCH} AS batch, p, ").replace(
    "AS ids FROM train)", "AS ids FROM train JOIN cut ON p >= low AND p < high)").replace(
    "flat AS (SELECT batch, flatten", "flat AS (SELECT shard, batch, flatten").replace(
    "FROM ids GROUP BY batch)", "FROM ids GROUP BY shard, batch)").replace(
    "blk AS (SELECT batch, a,", "blk AS (SELECT shard, batch, a,").replace(
    "SELECT CAST(0 AS BIGINT) AS shard, batch, block,", "SELECT shard, batch, block,"))
def q_pack_blocks_workers(spark, sf_dir):
    """P3 over four worker shards."""
    return _toy_blocks(split_docs(spark, sf_dir)[0], WORKERS)


PACK_VAL_SQL = (PACK_SQL.replace("WHERE split = 'train'", "WHERE split = 'test'")
                .replace("rn - (SELECT k FROM nt) - 1 AS p", "rn - 1 AS p"))


@register("pack_blocks_val", PACK_VAL_SQL)
def q_pack_blocks_val(spark, sf_dir):
    return _toy_blocks(split_docs(spark, sf_dir)[1])


@register("block_counts", "SELECT split, count(*) AS n_blocks, CAST(sum(len(input_ids)) AS BIGINT) AS n_ids FROM ("
          f"SELECT 'train' AS split, input_ids FROM ({PACK_SQL}) UNION ALL "
          f"SELECT 'test', input_ids FROM ({PACK_VAL_SQL})) GROUP BY split")
def q_block_counts(spark, sf_dir):
    train, test = split_docs(spark, sf_dir)
    return G.block_counts(_toy_blocks(train).withColumn("split", F.lit("train")).unionByName(
        _toy_blocks(test).withColumn("split", F.lit("test"))))


# ===================================== tokenizer ======================================
from wordmill.operators import bpe as BP  # noqa: E402

# --- fixed values of the registered tokenizer queries ----------------------------------
BPE_VOCAB = 500              # vocabulary size trained by the registered queries
# ----------------------------------------------------------------------------------------

def bpe_model(spark, sf_dir, vocab_size: int = BPE_VOCAB) -> BP.BpeModel:
    """The model of the deduped docs: trained and saved (S9) once per state of ``documents``,
    then loaded from the session's checkpoint folder."""
    from wordmill.session import checkpoint_dir
    from wordmill.sources import cache
    state = cache.fingerprint(spark, [f"{sf_dir}/documents.parquet"])
    path = f"{checkpoint_dir(spark)}/bpe-{vocab_size}-{state}"
    if not all(cache._complete(spark, f"{path}/{part}") for part in ("vocab", "merges")):
        BP.save_model(spark, BP.learn_bpe(BP.word_frequencies(deduped_stage(spark, sf_dir)), vocab_size), path)
    return BP.load_model(spark, path)


WF_SQL = (f"wf AS (SELECT word, count(*) AS freq FROM (SELECT unnest({O.pretokens_sql('text')}) "
          "AS word FROM documents) GROUP BY word)")


@register("pretokenize", f"SELECT doc_id, CAST(pos - 1 AS BIGINT) AS pos, piece FROM (SELECT doc_id, "
          f"unnest({O.pretokens_sql('text')}) AS piece, unnest(generate_series(1, "
          f"len({O.pretokens_sql('text')}))) AS pos FROM documents)")
def q_pretokenize(spark, sf_dir):
    d = documents(spark, sf_dir)
    return d.select("doc_id", F.posexplode(T.pretokens("text")).alias("pos", "piece")).select(
        "doc_id", F.col("pos").cast("bigint").alias("pos"), "piece")


@register("word_freq", f"WITH {WF_SQL} SELECT word, freq FROM wf")
def q_word_freq(spark, sf_dir):
    return BP.word_frequencies(documents(spark, sf_dir))


@register("alphabet", f"WITH {WF_SQL}, c AS (SELECT DISTINCT unnest({O.chars_sql('word')}) AS ch "
          f"FROM wf) SELECT ch, CAST(row_number() OVER (ORDER BY ch) + {len(BP.SPECIALS) - 1} "
          "AS BIGINT) AS id FROM c")
def q_alphabet(spark, sf_dir):
    from pyspark.sql import Window
    a = BP.alphabet(BP.word_frequencies(documents(spark, sf_dir)))
    return a.select("ch", (F.row_number().over(Window.orderBy("cp")) + len(BP.SPECIALS) - 1)
                    .cast("bigint").alias("id"))


@register("pair_freq", f"WITH {WF_SQL}, c AS (SELECT freq, {O.chars_sql('word')} AS c FROM wf), "
          "p AS (SELECT freq, c[i] AS \"left\", c[i + 1] AS \"right\" FROM (SELECT freq, c, "
          "unnest(generate_series(1, len(c) - 1)) AS i FROM c WHERE len(c) >= 2)) "
          f'SELECT "left", "right", CAST(sum(freq) AS BIGINT) AS freq FROM p GROUP BY "left", "right" '
          f"HAVING sum(freq) >= {BP.MIN_FREQUENCY}")
def q_pair_freq(spark, sf_dir):
    return BP.pair_frequencies(BP.word_frequencies(documents(spark, sf_dir)))


def _bpe_sql(select: str, more: str = "", vocab_size: int = BPE_VOCAB) -> str:
    ctes = O.bpe_ctes("deduped", ("benchmark",), vocab_size, BP.MIN_FREQUENCY, len(BP.SPECIALS))
    return f"WITH RECURSIVE {DEDUP_CTE},\n{ctes},\ndt AS ({O.bpe_docs_sql('deduped', 'doc_id')}){more}\n{select}"


_SPECIAL_ROWS = ", ".join(f"({O.q(t)}, {i})" for i, t in enumerate(BP.SPECIALS))


@register("bpe_merges", _bpe_sql('SELECT rank, "left", "right" FROM merged'))
def q_bpe_merges(spark, sf_dir):
    return BP.merges_frame(spark, bpe_model(spark, sf_dir))


@register("vocab", _bpe_sql(f"SELECT token, id::INTEGER AS id FROM (VALUES {_SPECIAL_ROWS}) AS s(token, id) "
                           "UNION ALL SELECT str, id::INTEGER FROM token"))
def q_vocab(spark, sf_dir):
    return BP.vocab_frame(spark, bpe_model(spark, sf_dir))


@register("encode_words", _bpe_sql("SELECT word, ids FROM coded WHERE freq > 0"))
def q_encode_words(spark, sf_dir):
    m = bpe_model(spark, sf_dir)
    return BP.encode_words(BP.word_frequencies(deduped_stage(spark, sf_dir)).select("word"), m)


def _doc_tokens(spark, sf_dir):
    # the model's training has written this stage: the documents are not joined with the losers again
    return BP.doc_tokens(deduped_stage(spark, sf_dir), bpe_model(spark, sf_dir))


@register("doc_tokens", _bpe_sql("SELECT doc_id, len(input_ids)::BIGINT AS n_tokens, input_ids FROM dt"))
def q_doc_tokens(spark, sf_dir):
    t = _doc_tokens(spark, sf_dir)
    return t.select("doc_id", F.size("input_ids").cast("bigint").alias("n_tokens"), "input_ids")


@register("decode_tokens", _bpe_sql(
    "SELECT doc_id, coalesce(string_agg(t.str, '' ORDER BY i), '') AS text FROM (SELECT doc_id, "
    "unnest(CASE WHEN len(input_ids) > 0 THEN input_ids ELSE [NULL] END) AS id, "
    "unnest(range(1, greatest(len(input_ids), 1) + 1)) AS i FROM dt) d LEFT JOIN token t ON t.id = d.id GROUP BY doc_id"))
def q_decode_tokens(spark, sf_dir):
    return BP.decode(_doc_tokens(spark, sf_dir), bpe_model(spark, sf_dir))


@register("fertility", _bpe_sql(
    "SELECT total_words, total_tokens, total_tokens / total_words AS fertility, "
    f"CASE WHEN total_tokens / total_words <= {BP.FERTILITY_EXCELLENT} THEN 'EXCELLENT' "
    f"WHEN total_tokens / total_words <= {BP.FERTILITY_GOOD} THEN 'GOOD' ELSE 'HIGH' END AS grade FROM ("
    f"SELECT (SELECT sum(len({O.words_sql('text')}))::BIGINT FROM deduped) AS total_words, "
    "(SELECT sum(len(input_ids))::BIGINT FROM dt) AS total_tokens)", vocab_size=BP.VOCAB_SIZE))
def q_fertility(spark, sf_dir):
    """K10 and K11 of the vocabulary of full size, over all documents."""
    docs = deduped_stage(spark, sf_dir)
    return BP.fertility(docs, BP.doc_tokens(docs, bpe_model(spark, sf_dir, BP.VOCAB_SIZE)))


_FIRST_DOCS = f"(SELECT doc_id, text FROM deduped ORDER BY source, doc_id LIMIT {FIRST_N})"


@register("fertility_first", _bpe_sql(
    "SELECT total_words, total_tokens, total_tokens / total_words AS fertility, "
    f"CASE WHEN total_tokens / total_words <= {BP.FERTILITY_EXCELLENT} THEN 'EXCELLENT' "
    f"WHEN total_tokens / total_words <= {BP.FERTILITY_GOOD} THEN 'GOOD' ELSE 'HIGH' END AS grade FROM ("
    f"SELECT (SELECT sum(len({O.words_sql('text')}))::BIGINT FROM {_FIRST_DOCS}) AS total_words, "
    f"(SELECT sum(len(input_ids))::BIGINT FROM dt JOIN {_FIRST_DOCS} USING (doc_id)) AS total_tokens)"))
def q_fertility_first(spark, sf_dir):
    """K10 as it is defined: over the first documents in corpus order."""
    docs = PK.first_n(deduped_stage(spark, sf_dir), ["source", "doc_id"], FIRST_N).checkpoint(eager=True)
    return BP.fertility(docs, BP.doc_tokens(docs, bpe_model(spark, sf_dir)))


BENCH_IDS = f", bt AS ({O.bpe_docs_sql('benchmark', 'item_id')})"


@register("unk_rate", _bpe_sql(
    "SELECT coalesce(sum(len(list_filter(input_ids, lambda x: x = 0))), 0) * 100.0::DOUBLE "
    "/ greatest(1, coalesce(sum(len(input_ids)), 0)) AS unk_rate FROM bt", BENCH_IDS))
def q_unk_rate(spark, sf_dir):
    b = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("doc_id"), "text")
    return BP.unk_rate(BP.doc_tokens(b, bpe_model(spark, sf_dir)), bpe_model(spark, sf_dir))


def _simple_counts_sql(x: str) -> dict[str, str]:
    return {"bytes": f"CAST(strlen({x}) AS BIGINT)", "chars": f"CAST(length({x}) AS BIGINT)",
            "words": f"CAST(len({O.words_sql(x)}) AS BIGINT)",
            "pretokens": f"CAST(len({O.pretokens_sql(x)}) AS BIGINT)"}


@register("avg_tokens", "SELECT count(*) AS n_texts, " + ", ".join(
    f"sum({e}) / greatest(1, count(*)) AS avg_{n}" for n, e in _simple_counts_sql("text").items())
    + " FROM benchmark")
def q_avg_tokens(spark, sf_dir):
    return BP.avg_tokens(table(spark, sf_dir, "benchmark"), BP.simple_token_counts())


@register("token_lengths", "SELECT item_id, " + ", ".join(
    f"{e} AS {n}" for n, e in _simple_counts_sql("text").items()) + " FROM benchmark")
def q_token_lengths(spark, sf_dir):
    """K12's list: the token count of every text under each tokenizer."""
    counts = BP.simple_token_counts()
    return table(spark, sf_dir, "benchmark").select("item_id", *[c.alias(n) for n, c in counts.items()])


@register("token_reduction_bpe", _bpe_sql(
    "SELECT base_avg, custom_avg, unk_pct, (base_avg - custom_avg) / greatest(base_avg, 1e-9) * 100.0 AS reduction_pct, "
    f"CASE WHEN unk_pct > {BP.UNK_WARN_PCT} THEN 'warning_high_unk' WHEN custom_avg <= base_avg * {BP.STRONG_GAIN} "
    "THEN 'strong' ELSE 'small' END AS signal FROM (SELECT sum(strlen(text)) / greatest(1, count(*)) AS base_avg, "
    "sum(len(input_ids)) / greatest(1, count(*)) AS custom_avg, "
    "sum(len(list_filter(input_ids, lambda x: x = 0))) * 100.0::DOUBLE / greatest(1, sum(len(input_ids))) AS unk_pct "
    "FROM benchmark JOIN bt USING (item_id))", BENCH_IDS))
def q_token_reduction_bpe(spark, sf_dir):
    """K14 + K15 on the learned vocabulary: bytes against its tokens, with the measured unknown rate."""
    model = bpe_model(spark, sf_dir)
    docs = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("doc_id"), "text")
    toks = BP.doc_tokens(docs, model)
    unk = model.vocab[BP.UNK]
    per = toks.select("doc_id", F.size("input_ids").alias("n"), F.size(F.filter("input_ids", lambda x: x == unk)).alias("u"))
    a = docs.join(per, "doc_id").agg(
        (F.sum(F.octet_length("text")) / F.greatest(F.lit(1), F.count("*"))).alias("base_avg"),
        (F.sum("n") / F.greatest(F.lit(1), F.count("*"))).alias("custom_avg"),
        (F.coalesce(F.sum("u"), F.lit(0)) * 100.0 / F.greatest(F.lit(1), F.coalesce(F.sum("n"), F.lit(0)))).alias("unk_pct"))
    red, sig = BP.token_reduction(F.col("base_avg"), F.col("custom_avg"), F.col("unk_pct"))
    return a.select("base_avg", "custom_avg", "unk_pct", red.alias("reduction_pct"), sig.alias("signal"))


@register("token_reduction", "SELECT avg_bytes AS base_avg, avg_pretokens AS custom_avg, "
          "(avg_bytes - avg_pretokens) / greatest(avg_bytes, 1e-9) * 100.0 AS reduction_pct, "
          f"CASE WHEN 0.0 > {BP.UNK_WARN_PCT} THEN 'warning_high_unk' WHEN avg_pretokens <= "
          f"avg_bytes * {BP.STRONG_GAIN} THEN 'strong' ELSE 'small' END AS signal FROM ("
          "SELECT " + ", ".join(f"sum({e}) / greatest(1, count(*)) AS avg_{n}"
                                for n, e in _simple_counts_sql("text").items()) + " FROM benchmark)")
def q_token_reduction(spark, sf_dir):
    a = BP.avg_tokens(table(spark, sf_dir, "benchmark"), BP.simple_token_counts())
    red, sig = BP.token_reduction(F.col("avg_bytes"), F.col("avg_pretokens"), F.lit(0.0))
    return a.select(F.col("avg_bytes").alias("base_avg"), F.col("avg_pretokens").alias("custom_avg"),
                    red.alias("reduction_pct"), sig.alias("signal"))


@register("tokenizer_compare", "SELECT item_id AS label, tokenizer, tokens, tokens / "
          "greatest(base, 1) AS ratio FROM (SELECT item_id, " + ", ".join(
              f"{e} AS {n}" for n, e in _simple_counts_sql("text").items())
          + ", pretokens AS base FROM benchmark) UNPIVOT (tokens FOR tokenizer IN "
          "(bytes, chars, words, pretokens))")
def q_tokenizer_compare(spark, sf_dir):
    b = table(spark, sf_dir, "benchmark").withColumnRenamed("item_id", "label")
    return BP.compare_tokenizers(b, BP.simple_token_counts(), "pretokens")


SMALL_VOCAB = 250            # a smaller vocabulary read off the same training


def _bench_counts(size: int) -> str:
    return "(" + _bpe_sql(f"SELECT item_id, len(input_ids)::BIGINT AS bpe_{size} FROM bt", BENCH_IDS, size) + ")"


@register("tokenizer_compare_bpe", "SELECT label, tokenizer, tokens, tokens / greatest(base, 1) AS ratio FROM ("
          "SELECT item_id AS label, " + ", ".join(f"{e} AS {n}" for n, e in _simple_counts_sql("text").items())
          + f", bpe_{SMALL_VOCAB}, bpe_{BPE_VOCAB}, bpe_{BPE_VOCAB} AS base FROM benchmark "
          f"JOIN {_bench_counts(SMALL_VOCAB)} USING (item_id) JOIN {_bench_counts(BPE_VOCAB)} USING (item_id)) "
          f"UNPIVOT (tokens FOR tokenizer IN (bytes, chars, words, pretokens, bpe_{SMALL_VOCAB}, bpe_{BPE_VOCAB}))")
def q_tokenizer_compare_bpe(spark, sf_dir):
    """K16 with learned vocabularies: one training serves both sizes."""
    b = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("label"), "text")
    sizes = [SMALL_VOCAB, BPE_VOCAB]
    learned = BP.token_counts_at(b, bpe_model(spark, sf_dir), sizes, key="label")
    counts = BP.simple_token_counts() | {f"bpe_{n}": F.col(f"bpe_{n}") for n in sizes}
    return BP.compare_tokenizers(b.join(learned, "label"), counts, f"bpe_{BPE_VOCAB}")


@register("pack_blocks_bpe", _bpe_sql(PACK_IDS_SQL, f""",
{SPLIT_SQL},
train AS (SELECT doc_id, rn - (SELECT k FROM nt) - 1 AS p FROM labelled WHERE split = 'train'),
flat AS (SELECT p // {PK.PACK_BATCH} AS batch, flatten(list(input_ids ORDER BY p)) AS a
         FROM train JOIN dt USING (doc_id) GROUP BY batch),
blk AS (SELECT batch, a, unnest(generate_series(0, len(a) // {PK.MAX_LENGTH} - 1)) AS block FROM flat)"""))
def q_pack_blocks_bpe(spark, sf_dir):
    """The source's training-set flow: split, BPE-tokenize, pack 512-id blocks per 1,000 docs."""
    train, _ = split_docs(spark, sf_dir)
    toks = BP.doc_tokens(train.select("doc_id", "text"), bpe_model(spark, sf_dir))
    return _packed(toks.select("doc_id", "input_ids"), PK.PACK_BATCH, PK.MAX_LENGTH)
