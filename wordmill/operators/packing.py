"""Training-set preparation: seeded split (P1), head limits (W3, W4), dense
positions, packing into fixed-length blocks (P3-P5), corpus union (W5).

Nothing here sorts the whole data set into one task:
* the exact k-smallest selection (split, limits) uses a 65,536-bucket histogram
  over an md5 prefix to find the one row at the cut, and is a filter from then on;
* dense positions come from range partitioning + per-partition offsets;
* packing cuts each document into the pieces that fall into each block, so a
  block group holds exactly ``block_len`` ids, whatever the document sizes.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wordmill.session import checkpoint_dir

# --- fixed values (defaults of the source preparation step) -----------------------
TEST_FRACTION = 0.01
SPLIT_SEED = 42
MAX_LENGTH = 512             # tokens per packed block
PACK_BATCH = 1000            # documents per packing batch
TRAIN_DOC_LIMIT = 350_000
VAL_DOC_LIMIT = 4_500
FERTILITY_SAMPLE = 10_000    # first-N documents for fertility
# ------------------------------------------------------------------------------------

PREFIX_HEX = 4               # histogram resolution: 16 bits
BOUNDARY_LIMIT = 2_000_000   # refine the histogram while the boundary bucket is larger


def shuffle_key(id_col, seed: int = SPLIT_SEED) -> F.Column:
    """Seeded pseudo-random order: md5 of ``'{seed}:{id}'`` (ties broken by id)."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))


def first_k(df: DataFrame, key: str, tie: str, k: int) -> F.Column:
    """A predicate for the ``k`` rows of ``df`` with the smallest (key, tie); ``key`` is a hex string.

    A histogram over key prefixes (bounded: 16**PREFIX_HEX rows a level) locates the bucket
    that holds the k-th row; only that bucket is ordered, after it was refined by more
    digits until it is small. What is returned compares with that one row, so selecting is
    a filter without any shuffle. ``df`` should hold just the two columns.
    """
    if k <= 0:
        return F.lit(False)
    prefix_len, cur, need = 0, df, k
    while True:
        prefix_len += PREFIX_HEX
        pref = F.substring(F.col(key), 1, prefix_len)
        hist = cur.groupBy(pref.alias("_p")).count().orderBy("_p").collect()
        if need >= sum(r["count"] for r in hist):
            if prefix_len == PREFIX_HEX:
                return F.lit(True)
            boundary, before, size = hist[-1]["_p"], sum(r["count"] for r in hist[:-1]), hist[-1]["count"]
        else:
            before = 0
            for r in hist:
                boundary, size = r["_p"], r["count"]
                if before + size >= need:
                    break
                before += size
        need -= before
        cur = cur.where(pref == F.lit(boundary))
        if size <= BOUNDARY_LIMIT or prefix_len >= 32:
            last = cur.orderBy(key, tie).limit(need).agg(F.max(F.struct(key, tie)).alias("m")).first()["m"]
            c, t = F.col(key), F.col(tie)
            return F.coalesce((c < last[key]) | ((c == last[key]) & (t <= last[tie])), F.lit(False))


def k_smallest(df: DataFrame, key: str, tie: str, k: int) -> DataFrame:
    """The ``k`` rows with the smallest (key, tie)."""
    return df.where(first_k(df.select(key, tie), key, tie, k))


def seeded_split(df: DataFrame, id_col: str, test_fraction: float = TEST_FRACTION,
                 seed: int = SPLIT_SEED) -> tuple[DataFrame, DataFrame]:
    """(train, test); test holds ceil(fraction * n) rows picked by the seeded order.

    Both outputs carry ``_shuffle`` (the order key) for later head limits. The passes that
    find the cut read the ids only; both outputs are filters over ``df``.
    """
    keyed = df.withColumn("_shuffle", shuffle_key(id_col, seed))
    keys = keyed.select(id_col, "_shuffle")
    is_test = first_k(keys, "_shuffle", id_col, math.ceil(test_fraction * keys.count()))
    return keyed.where(~is_test), keyed.where(is_test)


def head_limit(df: DataFrame, limit: int, key: str = "_shuffle", tie: str = "doc_id") -> DataFrame:
    """The first ``limit`` rows of a shuffled split, only if limit > 0 and exceeded."""
    return k_smallest(df, key, tie, limit) if limit > 0 else df


def first_n(df: DataFrame, order_cols: list[str], n: int = FERTILITY_SAMPLE) -> DataFrame:
    """The first ``n`` documents in corpus order (a fixed-size top-n)."""
    return df.orderBy(*order_cols).limit(n)


def dense_positions(df: DataFrame, order_cols: list[str], pos_col: str = "position",
                    partitions: int | None = None) -> DataFrame:
    """0-based dense position in ``order_cols`` order without a one-partition window.

    Range-partition + sort within partitions; per-partition counts (one row per
    partition) give the offsets. The tagged data is checkpointed first so the
    count and the numbering see the same partitioning.
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    n_parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    tagged = (df.repartitionByRange(n_parts, *order_cols).sortWithinPartitions(*order_cols)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_mid", F.monotonically_increasing_id())).checkpoint(eager=True)
    counts = sorted((r["_pid"], r["count"]) for r in tagged.groupBy("_pid").count().collect())
    offsets, acc = {}, 0
    for pid, c in counts:
        offsets[pid] = acc
        acc += c
    if not offsets:
        return tagged.drop("_pid", "_mid").withColumn(pos_col, F.lit(0).cast("bigint"))
    offs = spark.createDataFrame(list(offsets.items()), "_pid int, _off long")  # one row per partition
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("bigint"), 33)
    return tagged.join(F.broadcast(offs), "_pid").withColumn(
        pos_col, (F.col("_off") + local).cast("bigint")).drop("_pid", "_mid", "_off")


def worker_batches(df: DataFrame, n_rows: int, pos_col: str = "position",
                   batch_size: int = PACK_BATCH, num_shards: int = 1) -> DataFrame:
    """Batch id of each row: contiguous worker shards, then batches inside a shard."""
    div, mod = divmod(n_rows, num_shards)
    p = F.col(pos_col)
    # shard index of a position, inverse of start(i) = div*i + min(i, mod)
    big = (div + 1) * mod
    shard = F.when(p < F.lit(big), p / F.lit(max(div + 1, 1))).otherwise(
        F.lit(mod) + (p - F.lit(big)) / F.lit(max(div, 1))).cast("bigint")
    start = F.lit(div) * shard + F.least(shard, F.lit(mod))
    return df.withColumn("shard", shard).withColumn(
        "batch", ((p - start) / F.lit(batch_size)).cast("bigint"))


def pack_blocks(df: DataFrame, ids_col: str = "input_ids", pos_col: str = "position",
                batch_cols: tuple[str, ...] = ("shard", "batch"),
                block_len: int = MAX_LENGTH) -> DataFrame:
    """Concatenate ids per batch, cut into ``block_len`` blocks, drop the rest.

    Output: batch cols, ``block``, ``input_ids``, ``attention_mask``, ``labels``.
    The per-batch running offset is a window over at most one batch of (small)
    rows; each block is assembled from the pieces of the documents it overlaps.
    """
    L = block_len
    wb = Window.partitionBy(*batch_cols)
    wo = wb.orderBy(pos_col).rowsBetween(Window.unboundedPreceding, -1)
    n = F.size(ids_col).cast("bigint")
    d = df.select(*batch_cols, pos_col, F.col(ids_col).alias("_ids"), n.alias("_n"))
    d = d.withColumn("_off", F.coalesce(F.sum("_n").over(wo), F.lit(0)).cast("bigint"))
    d = d.withColumn("_nblk", (F.sum("_n").over(wb) / F.lit(L)).cast("bigint"))
    first_blk = (F.col("_off") / F.lit(L)).cast("bigint")
    last_blk = F.least(((F.col("_off") + F.col("_n") - 1) / F.lit(L)).cast("bigint"),
                       F.col("_nblk") - 1)
    d = d.where((F.col("_n") > 0) & (first_blk <= last_blk))
    d = d.withColumn("block", F.explode(F.sequence(first_blk, last_blk)))
    lo = F.greatest(F.col("block") * L, F.col("_off"))
    hi = F.least((F.col("block") + 1) * L, F.col("_off") + F.col("_n"))
    pieces = d.select(*batch_cols, "block", lo.alias("_start"),
                      F.slice("_ids", (lo - F.col("_off") + 1).cast("int"),
                              (hi - lo).cast("int")).alias("_piece"))
    blocks = pieces.groupBy(*batch_cols, "block").agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("_start", "_piece"))),
                              lambda s: s["_piece"])).alias("input_ids"))
    return blocks.select(*batch_cols, "block", "input_ids",
                         F.array_repeat(F.lit(1), L).alias("attention_mask"),
                         F.col("input_ids").alias("labels"))


def union_corpora(parts: dict[str, DataFrame]) -> DataFrame:
    """Concatenate corpora in name order with a ``corpus`` column."""
    out = None
    for name in sorted(parts):
        p = parts[name].withColumn("corpus", F.lit(name))
        out = p if out is None else out.unionByName(p)
    return out
