"""Dataset manifest (S10): inventory rows joined to measured corpus sizes.

The inventory is descriptive metadata (a handful of rows); the measured side is
an aggregate over the corpus, so the join is one small table against one row
per corpus.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST_SCHEMA = ("dataset string, location string, approx_size string, license string, "
                   "type string, notes string, priority string, phase string")


def manifest_frame(spark: SparkSession, rows: list[dict]) -> DataFrame:
    cols = [c.split()[0] for c in MANIFEST_SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(r.get(c) for c in cols) for r in rows], MANIFEST_SCHEMA)


def manifest_with_measures(manifest: DataFrame, corpus: DataFrame, corpus_col: str = "corpus",
                           text_col: str = "text") -> DataFrame:
    """Each manifest row with the measured documents and UTF-8 bytes of its corpus."""
    m = corpus.groupBy(corpus_col).agg(F.count("*").alias("n_docs"),
                                       F.sum(F.octet_length(text_col)).alias("bytes"))
    return manifest.join(m, manifest["dataset"] == m[corpus_col], "left").drop(corpus_col)


def by_license(df: DataFrame) -> DataFrame:
    return df.groupBy("license").agg(F.count("*").alias("n_datasets"),
                                     F.coalesce(F.sum("n_docs"), F.lit(0)).alias("n_docs"),
                                     F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"))
