"""Salted joins for keys that may hold a large share of all rows.

A bucket (or any key) may hold a third of the data. Aggregates absorb that with
map-side partial aggregation; joins do not, so the rows of *hot* keys are spread
over as many tasks as keep each below ``HOT_ROWS`` rows, and only the hot keys' rows
on the one-row-per-key side are replicated. The list of hot keys is broadcast only
when it was counted to be short; a longer one is joined like any other table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- tuning values (not source semantics) -------------------------------------------
HOT_ROWS = 1_000_000     # a key with more rows than this is split, so that no task gets more
BROADCAST_KEYS = 50_000  # hot keys (a few dozen bytes each) up to which their list is broadcast
# ---------------------------------------------------------------------------------------


def hot_keys(sizes: DataFrame, key_cols: list[str], count_col: str = "n",
             threshold: int | None = None) -> DataFrame:
    """Keys of more rows than the threshold, with the number of salts their count asks for."""
    t = HOT_ROWS if threshold is None else threshold
    return sizes.where(F.col(count_col) > t).select(
        *key_cols, F.ceil(F.col(count_col) / t).cast("int").alias("_salts"))


def salted_join(big: DataFrame, small: DataFrame, key_cols: list[str], how: str,
                hot: DataFrame, spread_col: str) -> DataFrame:
    """``big.join(small, key_cols, how)`` with hot keys split over their salts.

    ``small`` must hold at most one row per key (a per-key aggregate), ``hot`` comes from
    ``hot_keys`` (materialised: it is counted here). ``how`` is "inner", "left" or
    "left_semi"/"left_anti". ``spread_col`` (a column of ``big``) picks the salt of a row.
    """
    n_hot = hot.count()
    if n_hot == 0:
        return big.join(small, key_cols, how)
    flag = F.broadcast(hot) if n_hot <= BROADCAST_KEYS else hot
    b = big.join(flag, key_cols, "left").withColumn(
        "_salt", F.when(F.col("_salts").isNotNull(), F.pmod(F.xxhash64(spread_col), F.col("_salts")))
        .otherwise(F.lit(0)).cast("int")).drop("_salts")
    sm = small.join(flag, key_cols, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1))).drop("_salts")
    return b.join(sm, key_cols + ["_salt"], how).drop("_salt")
