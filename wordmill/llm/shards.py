"""Sharding by vector bin packing: bytes, tokens and rows balanced jointly.

The unit is a group of equal texts, a vector of bytes, tokens and rows in shares (1 is
what each shard would get of the whole). Groups are placed largest first, each on the
shard where the dot product of its vector with the residual capacity is highest; bytes
weigh ``BYTES_WEIGHT`` times as much, so that their sizes end nearly equal (law ``bytes``).

On Spark, in two levels:

* a group over 1/``FINE`` of a share in any of the three is packed on its own. At most
  3 x ``FINE`` x shards groups can be that large, whatever the input. A group over one whole
  share is first dealt by a hash of the id into pieces of about 1/``PIECES`` of a share; every other
  group stays in one shard;
* the small groups are dealt by their digest into slices, and each slice is packed into as
  many bins as there are shards by one task. The bins (at most ``MOST_SLICES`` a shard)
  are then packed together with the large groups.

So the driver sees a summary of bounded size only, and no join has a key of more rows than
a piece or a small group. Slots number the rows of a shard in order of the id, by range partitions.

Defined results: null text counts as an empty one (16 bytes of size, no tokens) and is
equal to it; very long texts count whole, and one that exceeds a share stays whole; ties go to the
lower shard, equally large groups in order of their digest; rows that repeat id and text stay together
and are numbered in no fixed order; null ids come first in a shard; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordmill.llm.positions import numbered
from wordmill.llm.scratch import stored

ROW_BYTES = 16           # what a row costs besides its text
TOKEN = r"[\p{L}\p{N}]+|[^\p{L}\p{N}\x00-\x20]"
BYTES_WEIGHT = 4.0
FINE = 256
PIECES = 8
SLICE_GROUPS = 100_000
MOST_SLICES = 4096
DIMS = ("bytes", "tokens", "rows")


def place(vectors: np.ndarray, n_shards: int) -> np.ndarray:
    """The shard of every vector (n, 3), given in shares; largest first, ties by row."""
    weight = np.array([BYTES_WEIGHT, 1.0, 1.0])
    residual = np.ones((3, n_shards))
    out = np.zeros(len(vectors), np.int32)
    largest = vectors.max(axis=1) if len(vectors) else np.zeros(0)
    for k in np.lexsort((np.arange(len(vectors)), -largest)):
        v = vectors[k]
        w = v * weight
        s = int(np.argmax(w[0] * residual[0] + w[1] * residual[1] + w[2] * residual[2]))
        out[k] = s
        residual[:, s] -= v
    return out


def _shares(rows: np.ndarray, totals: np.ndarray, n_shards: int) -> np.ndarray:
    return rows * n_shards / np.maximum(totals, 1.0)


def _pack_slice(n_shards: int):
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("digest")
        rows = np.stack([table[d].to_numpy() for d in DIMS], axis=1).astype(float)
        bins = place(_shares(rows, rows.sum(axis=0), n_shards), n_shards)
        return table.append_column("bin", pa.array(bins))
    return run


def measured(docs: DataFrame, id_col: str, text_col: str, tokens: F.Column | None) -> DataFrame:
    """id, text_crc32, digest of the text, and the row's bytes, tokens and rows (1)."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    count = F.regexp_count(text, F.lit(TOKEN)) if tokens is None else F.coalesce(tokens, F.lit(0))
    return docs.select(F.col(f"`{id_col}`").alias("id"), F.crc32(text).alias("text_crc32"),
                       F.unhex(F.sha2(text, 256)).alias("digest"),
                       (F.octet_length(text).cast("long") + ROW_BYTES).alias("bytes"),
                       count.cast("long").alias("tokens"))


def assign(docs: DataFrame, n_shards: int = 40, id_col: str = "doc_id", text_col: str = "text",
           tokens: F.Column | None = None) -> DataFrame:
    """One row per document: id, size, text_crc32, law, shard, slot, grown_shard (null: no such law).

    ``tokens`` is the token count of a row as a column of ``docs``; by default words
    and single other visible characters are counted.
    """
    spark = docs.sparkSession
    rows = stored(measured(docs, id_col, text_col, tokens), "shards-rows")
    groups = stored(rows.groupBy("digest").agg(
        F.sum("bytes").alias("bytes"), F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows")), "shards-groups")
    total = groups.agg(*(F.coalesce(F.sum(d), F.lit(0)).alias(d) for d in DIMS), F.count(F.lit(1)).alias("n")).first()
    totals = np.array([float(total[d]) for d in DIMS])
    share = F.greatest(*(F.col(d) * F.lit(n_shards / max(t, 1.0)) for d, t in zip(DIMS, totals)))
    groups = groups.withColumn("share", share)

    large = groups.where(F.col("share") * FINE > 1).withColumn(
        "pieces", F.when(F.col("share") > 1, F.ceil(F.col("share") * PIECES)).otherwise(1).cast("int"))
    large = stored(large.select("digest", "pieces", *DIMS), "shards-large")     # at most 3 x FINE x n_shards rows
    piece = F.pmod(F.xxhash64("id"), F.col("pieces")).cast("int")
    in_large = rows.join(F.broadcast(large.select("digest", "pieces")), "digest").withColumn("piece", piece)
    pieces = (large.where("pieces = 1").select("digest", F.lit(0).alias("piece"), *DIMS)
              .unionByName(in_large.where("pieces > 1").groupBy("digest", "piece").agg(
                  F.sum("bytes").alias("bytes"), F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows"))))

    n_slices = min(MOST_SLICES, max(1, -(-total["n"] // SLICE_GROUPS)))
    small = groups.where(F.col("share") * FINE <= 1).select(
        "digest", *DIMS, F.pmod(F.xxhash64("digest"), F.lit(n_slices)).cast("int").alias("slice"))
    packed = stored(small.groupBy("slice").applyInArrow(
        _pack_slice(n_shards), "digest binary, bytes long, tokens long, rows long, slice int, bin int"), "shards-bins")
    bins = packed.groupBy("slice", "bin").agg(*(F.sum(d).alias(d) for d in DIMS))

    items = [*sorted(pieces.collect(), key=lambda r: (bytes(r["digest"]), r["piece"])),
             *sorted(bins.collect(), key=lambda r: (r["slice"], r["bin"]))]
    vectors = np.array([[r[d] for d in DIMS] for r in items], float).reshape(-1, 3)
    shards = place(_shares(vectors, totals, n_shards), n_shards).tolist()
    where_large = spark.createDataFrame([(r["digest"], r["piece"], s) for r, s in zip(items, shards) if "digest" in r],
                                        "digest binary, piece int, shard int")
    where_small = spark.createDataFrame([(r["slice"], r["bin"], s) for r, s in zip(items, shards) if "slice" in r],
                                        "slice int, bin int, shard int")
    # the rows of large groups stay out of the join by digest
    in_small = rows.join(F.broadcast(large.select("digest")), "digest", "left_anti")
    put = (in_large.join(F.broadcast(where_large), ["digest", "piece"]).select("id", "bytes", "text_crc32", "shard")
           .unionByName(in_small.join(packed.select("digest", "slice", "bin"), "digest")
                        .join(F.broadcast(where_small), ["slice", "bin"]).select("id", "bytes", "text_crc32", "shard")))
    return (numbered(put, "shard", ["id", "text_crc32", "bytes"], "slot", name="shards-put")
            .select(F.col("id").alias(id_col), F.col("bytes").alias("size"), "text_crc32", F.lit("bytes").alias("law"),
                    "shard", "slot", F.lit(None).cast("int").alias("grown_shard")))
