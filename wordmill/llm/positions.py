"""Dense positions inside every key without a window over all rows of a key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wordmill.llm.scratch import free_name, stored


def numbered(df: DataFrame, key: str, order: list[str], out: str, total: str | None = None,
             name: str = "numbered") -> DataFrame:
    """``df`` with ``out``: 0, 1, ... inside each ``key`` in ``order``; ``total``: rows of the key.

    Rows are dealt by ranges of (key, order), so a key of any size covers as many tasks as
    its rows need. The sorted rows are written once with their task and place; what is
    counted and joined after that has one row per (task, key). ``key`` must not be null;
    rows that are equal in ``order`` are numbered in no fixed order among themselves.
    """
    part, place = free_name(df, "_part"), free_name(df, "_place")
    first, shift = free_name(df, "_first"), free_name(df, "_shift")
    tagged = stored(df.repartitionByRange(key, *order).sortWithinPartitions(key, *order)
                    .withColumn(part, F.spark_partition_id())
                    .withColumn(place, F.monotonically_increasing_id()), name)
    runs = tagged.groupBy(part, key).agg(F.min(place).alias(first), F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy(key)
    before = whole.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(part, key, (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col(first)).alias(shift),
                       *([F.sum("_n").over(whole).alias(total)] if total else []))
    return (tagged.join(runs, [part, key])
            .withColumn(out, F.col(place) + F.col(shift)).drop(part, place, shift))
