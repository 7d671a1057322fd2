"""Corpus statistics G1-G5 and G7.

All are plain aggregates with map-side partial aggregation; nothing is
collected to the driver. The median is exact (``percentile_disc`` keeps a
value -> count map, bounded by the number of distinct word counts).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordmill.functions import text as T

# --- fixed values ---------------------------------------------------------------
BYTES_PER_GB = 1024 ** 3     # G4 "approx size" divides characters by this
BYTES_PER_MB = 1024 ** 2
# ---------------------------------------------------------------------------------


def with_word_count(df: DataFrame, text_col: str = "text") -> DataFrame:
    return df.withColumn("n_words", F.size(T.words(F.col(text_col))).cast("bigint"))


def corpus_totals(df: DataFrame, text_col: str = "text") -> DataFrame:
    """G1 + G2 + G4: docs, chars, words, mean words/doc, approx GB, UTF-8 bytes."""
    t = F.col(text_col)
    agg = df.agg(F.count("*").alias("total_docs"),
                 F.coalesce(F.sum(F.length(t)), F.lit(0)).cast("bigint").alias("total_chars"),
                 F.coalesce(F.sum(F.size(T.words(t))), F.lit(0)).cast("bigint").alias("total_words"),
                 F.coalesce(F.sum(F.octet_length(t)), F.lit(0)).cast("bigint").alias("total_bytes"))
    return agg.select(
        "total_docs", "total_chars", "total_words", "total_bytes",
        (F.col("total_words") / F.greatest(F.col("total_docs"), F.lit(1))).alias("avg_words"),
        (F.col("total_chars") / F.lit(BYTES_PER_GB)).alias("approx_gb"))


def median_words(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Upper median ``sorted(words)[n // 2]``; null for an empty corpus.

    ``percentile_disc(0.5)`` over the descending order picks exactly that
    element for odd and even n.
    """
    w = with_word_count(df, text_col)
    return w.agg(F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY n_words DESC)")
                 .cast("bigint").alias("median_words"))


def docs_by_source(df: DataFrame, source_col: str = "source",
                   order_col: str = "ordinal") -> DataFrame:
    """Documents per source, most common first, ties in first-seen order.

    ``position`` is a dense position by ranges, so any number of sources (one per host,
    say) is ranked without a single task that holds them all.
    """
    from wordmill.operators.packing import dense_positions
    g = df.groupBy(source_col).agg(F.count("*").alias("n_docs"),
                                   F.min(order_col).alias("first_seen"))
    ranked = dense_positions(g.withColumn("_fewer", -F.col("n_docs")), ["_fewer", "first_seen"])
    return ranked.select(source_col, "n_docs", "first_seen", (F.col("position") + 1).alias("position"))


def size_report(df: DataFrame, corpus_col: str = "corpus", text_col: str = "text") -> DataFrame:
    """UTF-8 megabytes per corpus plus a grand-total row (corpus null)."""
    g = df.rollup(corpus_col).agg(F.count("*").alias("n_docs"),
                                  F.sum(F.octet_length(text_col)).cast("bigint").alias("bytes"))
    return g.select(corpus_col, "n_docs", "bytes",
                    (F.col("bytes") / F.lit(BYTES_PER_MB)).alias("mb"),
                    (F.col("bytes") / F.lit(BYTES_PER_GB)).alias("gb"))


def output_report(files: DataFrame, docs: DataFrame, corpus_col: str = "corpus") -> DataFrame:
    """Documents and megabytes of written files per corpus (a ``corpus=`` folder each), and in all
    (corpus null). ``files`` is (path, bytes), ``docs`` has n_docs per corpus."""
    name = F.regexp_extract("path", f"{corpus_col}=([^/]*)", 1)
    sizes = files.groupBy(name.alias(corpus_col)).agg(F.sum("bytes").alias("bytes"))
    per = docs.join(sizes, corpus_col)
    g = per.rollup(corpus_col).agg(F.sum("n_docs").alias("n_docs"), F.sum("bytes").alias("bytes"))
    return g.select(corpus_col, "n_docs", "bytes", (F.col("bytes") / F.lit(BYTES_PER_MB)).alias("mb"),
                    (F.col("bytes") / F.lit(BYTES_PER_GB)).alias("gb"))


def split_counts(df: DataFrame, split_col: str = "split", limited_col: str | None = None) -> DataFrame:
    """Rows per split, and how many of them a limit leaves (``limited_col``: true for those)."""
    aggs = [F.count("*").alias("n_rows")]
    if limited_col:
        aggs.append(F.count_if(F.col(limited_col)).alias("n_limited"))
    return df.groupBy(split_col).agg(*aggs)


def block_counts(blocks: DataFrame, split_col: str = "split") -> DataFrame:
    """Packed blocks and ids per split."""
    return blocks.groupBy(split_col).agg(F.count("*").alias("n_blocks"),
                                         F.sum(F.size("input_ids")).cast("bigint").alias("n_ids"))
