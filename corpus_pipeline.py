"""The corpus pipeline: five stages, each written as Parquet and read again by the next.

1. language ID: documents without a letter, or whose best language is less likely than the
   others together, go, and so do those that no language explains: their log-likelihood per
   byte lies far below the range of the training documents (:func:`language_id.least_fit`);
2. line dedup: lines that are equal to or within one edit of an earlier line of the corpus
   are cut out; documents of such lines only go;
3. n-gram Jaccard join: of each group of near-duplicates the smallest id stays;
4. benchmark decontamination: documents that hold a window of a benchmark item go;
5. byte-level BPE: the ids of every remaining document.

Stages 1 to 4 return the columns of ``documents``; the last one the ids. Nulls, empty and
repeated rows are treated as the operators' docstrings say; documents of null text have no
letter and go in stage 1; empty tables give empty results; further columns are carried
through stages 1 to 4.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordmill.llm import bpe_duckdb, decontaminate, language_id, line_dedup, ngram_join
from wordmill.llm.scratch import free_name, remove, scratch_path, stored, temporary

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
LEAST_SCORE = 0.5
#: Nats that a text may lie below the range: a rare word or two say nothing about a short text.
SLACK = 50

#: A trained language model and DuckDB inside tasks have no SQL form; tests hold the stages
#: against brute-force versions.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language_id.train(docs.where(~language_id.held_out()), RANKS)
    out = tuple(free_name(docs, name) for name in ("_lang_pred", "_score", "_fit", "_bytes"))
    scored = stored(language_id.predict(docs, model, out=out), "pipeline-scored")
    pred, score, fit, size = (F.col(name) for name in out)
    learned = scored.where(~language_id.held_out() & F.col("lang").isNotNull() & (size > 0))
    least = language_id.least_fit(learned.select(fit / size))
    known = (pred != language_id.UNKNOWN) & (score >= LEAST_SCORE) & (fit >= size * F.lit(float(least)) - SLACK)
    return scored.where(known).drop(*out)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = line_dedup.drop_duplicate_lines(docs)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.drop_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.drop_contaminated(docs, items)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe_duckdb.encode(docs, RANKS, public_tokenizers.PATTERN)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_lines),
    ("ngram_join", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("byte_bpe", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the ``documents`` of ``sf_dir``.

    What a stage stores for itself goes when its result is written, and its input (an earlier
    stage's result) goes as well, so a run leaves its last table only; a failed one leaves nothing.
    """
    docs, given = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        result = scratch_path(spark, f"pipeline-{name}")
        try:
            with temporary(spark):
                found = stage(spark, docs, sf_dir)
                found.write.parquet(result)
        except BaseException:
            remove(spark, result)
            raise
        finally:
            if given is not None:
                remove(spark, given)
        docs, given = spark.read.schema(found.schema).parquet(result), result
    return docs
