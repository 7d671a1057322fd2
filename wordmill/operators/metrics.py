"""Counters per corpus or shard as a by-product of a write (``DataFrame.observe``)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

MOST_LABELS = 5_000      # labels that are counted on the write; each measure of each is one metric


def labels_of(df: DataFrame, level: tuple[str, ...]) -> list[tuple] | None:
    """The distinct labels, or None if they are more than ``MOST_LABELS``. Only these columns are read."""
    found = df.select(*level).distinct().limit(MOST_LABELS + 1).collect()
    return None if len(found) > MOST_LABELS else [tuple(r) for r in found]


def observe_counts(df: DataFrame, level: tuple[str, ...], labels: list[tuple], measures: dict[str, Column]
                   ) -> tuple[DataFrame, Callable[[], list[tuple]]]:
    """``df`` with the sum of each measure per label observed, and what reads them after the action.

    Put on the last stage of a write, every row counts once: only the results of tasks whose
    output is committed reach the driver, so retried and speculative tasks add nothing.
    """
    if not labels:
        return df, list
    key = F.to_json(F.struct(*level), {"ignoreNullFields": "false"})
    schema = df.select(*level).schema
    named = df.sparkSession.createDataFrame(labels, schema).select(key.alias("key"), F.struct(*level).alias("label")).collect()
    place = F.element_at(F.create_map(*(F.lit(x) for k, r in enumerate(named) for x in (r["key"], k))), key)
    seen = Observation()
    marked = df.withColumn("_label", place)
    metrics = [F.sum(F.when(F.col("_label") == k, c)).alias(f"{name}_{k}")
               for k in range(len(named)) for name, c in measures.items()]
    out = marked.observe(seen, F.count(F.lit(1)).alias("rows"), *metrics).drop("_label")

    def read() -> list[tuple]:
        got = seen.get
        return [(*r["label"], *(int(got.get(f"{name}_{k}") or 0) for name in measures)) for k, r in enumerate(named)]
    return out, read
