"""F5 document cleaning pipeline, D1 exact dedup, F7 funnel.

Plan shape of the cleaning (one scan, no shuffle):
  Scan -> Project(T1..T5)  [reflect() is a barrier: filters are not pushed below it]
       -> Filter(reject_reason is null) -> Project(T6, T7, T8)
The bound measures (``let``) and ``reflect`` are interpreted, the rest is generated code.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordmill.functions import patterns as P
from wordmill.functions import text as T
from wordmill.operators import components as K
from wordmill.operators import metrics as M
from wordmill.operators.filters import REASONS, SCRIPT_THRESHOLD, reject_reason

BROADCAST_LOSERS = 100_000   # losing rows (a few dozen bytes each) up to which their list is broadcast


def annotate(df: DataFrame, text_col: str = "text", keep: tuple[str, ...] = (),
             block: str = P.DEVANAGARI, threshold: float = SCRIPT_THRESHOLD,
             apply_nfc: bool = True) -> DataFrame:
    """Normalised text ``_t`` plus ``reject_reason`` for every input row; null text is empty."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    norm = df.select(*keep, T.normalize_text(text, apply_nfc).alias("_t"))
    return norm.select(*keep, "_t", reject_reason(F.col("_t"), block, threshold)
                       .alias("reject_reason"))


def clean_documents(df: DataFrame, text_col: str = "text", keep: tuple[str, ...] = (),
                    block: str = P.DEVANAGARI, threshold: float = SCRIPT_THRESHOLD,
                    scrub: bool = True) -> DataFrame:
    """T1-T5, F1-F4 (on unscrubbed text), then T6-T7 and the T8 hash.

    Output: ``keep`` columns + ``text`` + ``hash``.
    """
    ann = annotate(df, text_col, keep, block, threshold)
    passed = ann.where(F.col("reject_reason").isNull())
    cleaned = passed.select(*keep, (T.scrub_pii("_t") if scrub else F.col("_t")).alias("text"))
    return cleaned.select(*keep, "text", T.content_hash("text").alias("hash"))


def exact_dedup(df: DataFrame, scope: tuple[str, ...] = ("corpus",),
                order_col: str = "ordinal", hash_col: str = "hash",
                strategy: str = "min_by") -> DataFrame:
    """Per scope, the first document (lowest ``order_col``) per hash wins.

    ``min_by`` (one pass) over a struct aggregates map-side first, so a hash that
    holds a third of all rows collapses to one row per task before the shuffle;
    the winner is deterministic, unlike ``dropDuplicates``. Its buffer holds the
    text, so it plans as a sort-based aggregate.

    ``winners`` suits an input that is already written (a stage table): narrow hash
    aggregates over the key columns find the first ordinal of the keys that occur more
    than once. The losing (scope, ordinal) keys are written to the checkpoint folder and counted before
    the text is touched: a short list is broadcast, a longer one becomes the hash tables of a shuffled join,
    so the text is shuffled only when the losers are many, and never sorted. It needs distinct ordinals.
    """
    if strategy == "winners":
        keys = df.select(*scope, hash_col, order_col)
        several = (keys.groupBy(*scope, hash_col).agg(F.min(order_col).alias("_first"), F.count("*").alias("_n"))
                   .where("_n > 1").select("_first", *[F.col(c).alias("_k_" + c) for c in (*scope, hash_col)]))
        same = [F.col(c).eqNullSafe(F.col("_k_" + c)) for c in (*scope, hash_col)]
        losers = keys.join(several, same).where(F.col(order_col) > F.col("_first")).select(
            *[F.col(c).alias("_l_" + c) for c in (*scope, order_col)])
        losers = K.written(losers, "dedup-losers")
        losers = F.broadcast(losers) if losers.count() <= BROADCAST_LOSERS else losers.hint("shuffle_hash")
        out = [F.col(c).eqNullSafe(F.col("_l_" + c)) for c in (*scope, order_col)]
        kept = df.join(losers, out, "left_anti")
        return kept.select(*scope, hash_col,
                           *[c for c in df.columns if c not in scope and c != hash_col])
    rest = [c for c in df.columns if c not in scope and c != hash_col]
    agg = df.groupBy(*scope, hash_col).agg(
        F.min_by(F.struct(*rest), F.col(order_col)).alias("_w"))
    return agg.select(*[F.col(c) for c in scope], F.col(hash_col),
                      *[F.col("_w." + c).alias(c) for c in rest])


def clean_funnel(df: DataFrame, text_col: str = "text", corpus_col: str | tuple[str, ...] = "corpus",
                 block: str = P.DEVANAGARI, threshold: float = SCRIPT_THRESHOLD) -> DataFrame:
    """per corpus (or corpus and shard: several columns), input rows, rejects per reason,
    duplicates, kept.

    Two aggregates, both partial-combined: (corpus, reason, hash) -> count,
    then per corpus. Duplicates = passed - distinct hashes.
    """
    level = (corpus_col,) if isinstance(corpus_col, str) else tuple(corpus_col)
    ann = annotate(df, text_col, level, block, threshold)
    keyed = ann.select(*level, "reject_reason",
                       F.when(F.col("reject_reason").isNull(),
                              T.content_hash(T.scrub_pii("_t"))).alias("hash"))
    lvl1 = keyed.groupBy(*level, "reject_reason", "hash").agg(F.count("*").alias("n"))
    aggs = [F.sum("n").alias("n_input")]
    for r in REASONS:
        aggs.append(F.coalesce(F.sum(F.when(F.col("reject_reason") == r, F.col("n"))),
                               F.lit(0)).alias("n_" + r))
    aggs.append(F.count_if(F.col("reject_reason").isNull()).alias("n_kept"))
    aggs.append(F.coalesce(F.sum(F.when(F.col("reject_reason").isNull(), F.col("n") - 1)),
                           F.lit(0)).alias("n_duplicate"))
    out = lvl1.groupBy(*level).agg(*aggs)
    return out.withColumn("n_skipped", F.col("n_input") - F.col("n_kept"))


def write_clean_corpus(df: DataFrame, path: str, text_col: str = "text", level: tuple[str, ...] = ("corpus",),
                       order_col: str = "ordinal", block: str = P.DEVANAGARI,
                       threshold: float = SCRIPT_THRESHOLD) -> DataFrame:
    """F5, D1 and F7 in one job: write the cleaned corpus (level, order, text, hash), return its funnel.

    Exact dedup is per ``level``, as in :func:`clean_funnel`, whose rows and columns come back.
    The counters are observed on the write, so the cleaning runs once; only the labels are
    read before. Rejected rows go through the same aggregate without their text.
    """
    labels = M.labels_of(df, level)
    ann = annotate(df, text_col, (*level, order_col), block, threshold)
    passed = F.col("reject_reason").isNull()
    text = ann.withColumn("text", F.when(passed, T.scrub_pii("_t"))).withColumn("hash", T.content_hash("text"))
    first = F.min_by(F.struct(order_col, "text"), F.col(order_col))
    groups = text.groupBy(*level, "reject_reason", "hash").agg(F.count(F.lit(1)).alias("_n"), first.alias("_first"))
    if labels is None:    # too many labels to count on the write
        read = None
    else:
        groups, read = M.observe_counts(groups, level, labels, {
            "n_input": F.col("_n"), **{"n_" + r: F.when(F.col("reject_reason") == r, F.col("_n")) for r in REASONS},
            "n_kept": F.when(passed, 1), "n_duplicate": F.when(passed, F.col("_n") - 1)})
    (groups.where(passed).select(*level, f"_first.{order_col}", "_first.text", "hash").write.mode("overwrite").parquet(path))
    if read is None:
        return clean_funnel(df, text_col, level, block, threshold)
    names = ["n_input", *("n_" + r for r in REASONS), "n_kept", "n_duplicate"]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*level).schema]
                       + [f"{n} bigint" for n in names])
    return df.sparkSession.createDataFrame(read(), schema).withColumn("n_skipped", F.col("n_input") - F.col("n_kept"))
