"""Exact dedup by skew-safe combining.

Texts are equal when identical after every run of ASCII white space becomes one
space. Copies are combined in three steps, each grouping by the *whole* content next
to its SHA-256, so equal digests alone never merge two texts:

1. inside each map task (the partial aggregate of step 2),
2. per (digest, salt, content), where the salt is a hash of the document id, so that
   one group of copies, however large, is spread over ``salts`` tasks,
3. per (digest, content) over the at most ``salts`` salt winners of each group.

The result goes back to the documents along the same salted groups: the winners of
step 3 are joined to the salt groups (at most ``salts`` rows a digest) and those to the
documents on (digest, salt), so no join key holds more than its salted share.

Defined results: null text counts as empty; a null id never wins while its group holds
another id; rows that repeat both id and text are reported one by one with the same
``keep_id``; very long texts are compared whole; an empty table gives an empty result; other columns are ignored by
:func:`duplicate_groups` and carried unchanged by :func:`drop_duplicates`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordmill.llm.scratch import free_name, one_of_repeats

WHITE_RUN = r"[\x20\x09-\x0D]+"


def normalised(text: str) -> F.Column:
    return F.regexp_replace(F.coalesce(F.col(f"`{text}`"), F.lit("")), WHITE_RUN, " ")


SALTS = 64  # at most 64: the salts a digest occurs with are one bit each of a long


def duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     salts: int = SALTS) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256."""
    read = docs.select(
        F.col(f"`{id_col}`").alias("_id"), normalised(text_col).alias("_norm"),
        F.pmod(F.xxhash64(F.col(f"`{id_col}`")), F.lit(salts)).cast("int").alias("_salt"),
    ).withColumn("_sha", F.sha2("_norm", 256))
    salted = (read.groupBy("_sha", "_salt", "_norm")
              .agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
              .withColumn("_bit", F.expr("shiftleft(1L, _salt)")))
    final = (salted.groupBy("_sha", "_norm")
             .agg(F.min("_first").alias("keep_id"), F.sum("_n").alias("group_size"),
                  F.bit_or("_bit").alias("_bits")))
    seen = F.filter(F.sequence(F.lit(0), F.lit(salts - 1)),
                    lambda i: F.expr("_bits").bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), i)) != 0)
    members = (final.select("_sha", F.xxhash64("_norm").alias("_check"), F.length("_norm").alias("_len"),
                            "keep_id", "group_size", F.explode(seen).alias("_salt")))
    narrow = read.select("_id", "_sha", "_salt", F.xxhash64("_norm").alias("_check"),
                         F.length("_norm").alias("_len"))
    return (narrow.join(members, ["_sha", "_salt", "_check", "_len"])
            .select(F.col("_id").alias(id_col), "keep_id", "group_size",
                    F.col("_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                    F.col("_sha").alias("text_sha256")))


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    salts: int = SALTS) -> DataFrame:
    """The rows that stay, all columns unchanged. Rows that repeat both id and (normalised) text stay once;
    different texts under one id, or without one, are different documents."""
    keep, sha, rows = (free_name(docs, c) for c in ("_keep", "_sha", "_rows"))
    kept = (duplicate_groups(docs, id_col, text_col, salts).where("kept")
            .groupBy(F.col(f"`{id_col}`").alias(keep), F.col("text_sha256").alias(sha)).agg(F.count(F.lit(1)).alias(rows)))
    digest = F.sha2(normalised(text_col), 256)
    found = docs.join(kept, F.col(f"`{id_col}`").eqNullSafe(F.col(keep)) & (digest == F.col(sha)))
    once, more = found.where(F.col(rows) == 1), found.where(F.col(rows) > 1)
    return once.drop(keep, sha, rows).unionByName(
        one_of_repeats(more.drop(keep, sha, rows), id_col, text_col, digest))
