"""Incremental near-dedup (D8): new batches probe a stored table of kept buckets.

Each micro-batch (Structured Streaming ``foreachBatch`` or a plain call):
  1. signatures and LSH buckets of the batch (same hash family as the batch job);
  2. documents sharing any bucket with an already kept document are duplicates
     (left-semi join against the bucket table — no pairs, one equi-join, hot buckets
     salted);
  3. the rest run the greedy keep among themselves, in rank order;
  4. buckets of the newly kept documents are stored.

The state is keyed. A batch is stored as a run of Parquet folders, ``part`` = a hash prefix
of the bucket, about ``part_rows`` rows each, and a Bloom filter per part (a table of
64-bit words). A probe reads the filter words of the parts its own buckets fall into, and
of the bucket table only the parts in which some bucket passed the filter: what it reads
follows the batch and its duplicates, not the state. Every ``fan`` runs of one level are
compacted into one run of the next, so a state of n batches is at most ``fan`` x log n runs
and a row is rewritten log n times.

A run counts once its list of batch ids is written, its last step, and a compacted run
replaces the runs it covers, which are then deleted; a failure in between leaves either
the old runs or both, never half a state. A batch only probes smaller ids and overwrites its
own run and its own part of the sink, so a batch that is delivered again (``foreachBatch``
is at-least-once) gives the same state and the same sink, also after its run was compacted.
One writer at a time.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordmill.operators import neardup as N
from wordmill.operators import skew as S

PART_ROWS = 200_000      # bucket rows a part holds
FAN = 8                  # runs of one level that are compacted into one
BITS_PER_ROW = 16        # Bloom filter size; two bits are set a row (about 1.4 % false positives)


@dataclass(frozen=True)
class Run:
    """The stored buckets of the batches ``low`` to ``high``, in ``parts`` parts."""

    low: int
    high: int
    parts: int

    @property
    def name(self) -> str:
        return f"r{self.low}_{self.high}_{self.parts}"


class IncrementalNearDedup:
    def __init__(self, spark: SparkSession, state_dir: str, rank_col: str = "rank",
                 text_col: str = "text", part_rows: int = PART_ROWS, fan: int = FAN):
        self.spark = spark
        self.state_path = state_dir.rstrip("/")
        self.rank_col = rank_col
        self.text_col = text_col
        self.part_rows, self.fan = part_rows, fan
        self.next_id = 0
        #: Of the last probe: parts of the state, parts whose filter was read, parts whose rows were read.
        self.last_probe = {"parts": 0, "filters": 0, "read": 0}

    # --- runs ----------------------------------------------------------------------
    def _folder(self, kind: str, run: Run | None = None) -> str:
        return f"{self.state_path}/{kind}" + (f"/run={run.name}" if run else "")

    def _fs(self, path: str):
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def _exists(self, path: str) -> bool:
        fs, p = self._fs(path)
        return fs.exists(p)

    def runs(self) -> list[Run]:
        """The complete runs that no complete run of more batches covers, oldest first."""
        fs, p = self._fs(self._folder("ids"))
        if not fs.exists(p):
            return []
        found = []
        for st in fs.listStatus(p):
            m = re.fullmatch(r"run=r(\d+)_(\d+)_(\d+)", st.getPath().getName())
            if m and self._exists(f"{st.getPath().toString()}/_SUCCESS"):
                found.append(Run(*map(int, m.groups())))
        return sorted((r for r in found if not any(
            o != r and o.low <= r.low and r.high <= o.high for o in found)), key=lambda r: r.low)

    def _ids(self, run: Run) -> set[int]:
        return {r["batch"] for r in self.spark.read.schema("batch long").parquet(self._folder("ids", run)).collect()}

    def _table(self, kind: str, columns: str, where: dict[Run, set[int]]) -> DataFrame:
        """The stored rows of some parts of some runs: only their folders are read."""
        wanted = F.lit(False)
        for run, parts in where.items():
            wanted = wanted | ((F.col("run") == run.name) & F.col("part").isin(sorted(parts)))
        return (self.spark.read.schema(f"{columns}, run string, part int").parquet(self._folder(kind)).where(wanted))

    def _store(self, rows: DataFrame, ids: set[int], low: int, high: int) -> Run:
        """Write (band, k1, k2, batch) as one run: buckets, then filters, then the ids that make it count."""
        rows = rows.checkpoint(eager=True)
        run = Run(low, high, max(1, -(-rows.count() // self.part_rows)))
        parted = rows.withColumn("part", _part(F.lit(run.parts)))
        (parted.repartition("part").sortWithinPartitions("part", "k1")
         .write.mode("overwrite").partitionBy("part").parquet(self._folder("buckets", run)))
        bits = parted.select("part", F.explode(F.array(*self._bits())).alias("bit"))
        (bits.groupBy("part", F.shiftright("bit", 6).alias("word"))
         .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits"))
         .repartition("part").write.mode("overwrite").partitionBy("part").parquet(self._folder("filters", run)))
        self.spark.createDataFrame([(i,) for i in sorted(ids)], "batch long").coalesce(1).write.mode(
            "overwrite").parquet(self._folder("ids", run))
        return run

    def _bits(self) -> list[F.Column]:
        """The two filter bits of a bucket inside its part."""
        size = F.lit(self.part_rows * BITS_PER_ROW)
        return [F.pmod(F.xxhash64(F.lit(seed), *N.BUCKET), size).cast("int") for seed in (11, 12)]

    def _drop(self, run: Run) -> None:
        """Delete a run that a complete one covers; its ids go first, so it stops counting at once."""
        for kind in ("ids", "filters", "buckets"):
            fs, p = self._fs(self._folder(kind, run))
            fs.delete(p, True)

    def _compact(self, batch_id: int) -> None:
        size = self.fan
        while (batch_id + 1) % size == 0:
            low = batch_id + 1 - size
            members = [r for r in self.runs() if low <= r.low and r.high <= batch_id]
            if len(members) > 1:
                rows = self._table("buckets", "band int, k1 long, k2 long, batch long",
                                   {r: set(range(r.parts)) for r in members}).select(*N.BUCKET, "batch")
                self._store(rows, set().union(*map(self._ids, members)), low, batch_id)
                for r in members:
                    self._drop(r)
            size *= self.fan

    # --- probing ---------------------------------------------------------------------
    def _known(self, B: DataFrame, batch_id: int) -> DataFrame | None:
        """Buckets of ``B`` that a document kept by an earlier batch holds."""
        live = [r for r in self.runs() if r.low < batch_id]
        self.last_probe = {"parts": sum(r.parts for r in live), "filters": 0, "read": 0}
        if not live:
            return None
        by_name = {r.name: r for r in live}
        # a bucket asks every run (few: they are compacted)
        ask = F.explode(F.array(*(F.struct(F.lit(r.name).alias("run"), F.lit(r.parts).alias("parts")) for r in live)))
        asked = (B.select(*N.BUCKET).distinct().withColumn("_r", ask)
                 .select(*N.BUCKET, "_r.run", _part(F.col("_r.parts")).alias("part"),
                         *(b.alias(f"b{k}") for k, b in enumerate(self._bits())))).checkpoint(eager=True)
        touched = self._parts(asked, by_name)
        passed = asked
        for k in (0, 1):
            words = self._table("filters", "word int, bits long", touched)
            passed = passed.withColumn("word", F.shiftright(f"b{k}", 6)).join(words, ["run", "part", "word"]).where(
                F.expr(f"bits & shiftleft(1L, b{k} & 63) != 0")).drop("word", "bits")
        passed = passed.select(*N.BUCKET, "run", "part").checkpoint(eager=True)
        read = self._parts(passed, by_name)
        self.last_probe |= {"filters": sum(map(len, touched.values())), "read": sum(map(len, read.values()))}
        if not read:
            return None
        rows = self._table("buckets", "band int, k1 long, k2 long, batch long", read)
        return (rows.where(F.col("batch") < batch_id)
                .join(passed, [*N.BUCKET, "run", "part"], "left_semi").select(*N.BUCKET))

    @staticmethod
    def _parts(asked: DataFrame, by_name: dict[str, Run]) -> dict[Run, set[int]]:
        """The parts that the rows fall into (bounded by the parts of the state)."""
        out: dict[Run, set[int]] = {}
        for r in asked.select("run", "part").distinct().collect():
            out.setdefault(by_name[r["run"]], set()).add(r["part"])
        return out

    # --- batches ---------------------------------------------------------------------
    def _free_id(self) -> int:
        """The first id after all batches that this object has seen or the state holds."""
        return max([self.next_id, *(r.high + 1 for r in self.runs())])

    @staticmethod
    def _check_id(batch_id: int, run: Run, ids: set[int]) -> None:
        if batch_id not in ids:
            raise ValueError(f"batch {batch_id} is older than the compacted run {run.low} to {run.high}")

    def process(self, batch: DataFrame, batch_id: int | None = None) -> DataFrame:
        """Kept rows of ``batch``; also records their buckets under the batch id.

        Without an id, batches count on from the last one stored. An id that lies inside
        a compacted run but was never part of it is an error: ids must grow.
        """
        batch_id = self._free_id() if batch_id is None else batch_id
        over = next((r for r in self.runs() if r.low <= batch_id <= r.high and r.low < r.high), None)
        if over is not None:
            self._check_id(batch_id, over, self._ids(over))
        self.next_id = max(self.next_id, batch_id + 1)
        r, key = self.rank_col, list(N.BUCKET)
        bands = N.band_keys(N.signatures(batch, r, self.text_col), r)
        if r != "rank":
            bands = bands.withColumnRenamed(r, "rank")
        B = N.buckets(bands)
        prior = self._known(B, batch_id)
        if prior is not None:
            hot = S.hot_keys(B.groupBy(*key).agg(F.count("*").alias("n")), key).checkpoint(eager=True)
            hit = S.salted_join(B, prior, key, "left_semi", hot, "rank")
            B = B.join(hit.select("rank").distinct(), "rank", "left_anti").checkpoint(eager=True)
        kept = N.greedy_keep_buckets(B).checkpoint(eager=True)
        if over is None:
            for old in self.runs():    # a replay may come out in another number of parts
                if old.low == old.high == batch_id:
                    self._drop(old)
            self._store(B.join(kept, "rank", "left_semi").select(*key, F.lit(batch_id).cast("long").alias("batch")),
                        {batch_id}, batch_id, batch_id)
            self._compact(batch_id)
        # hash tables of the narrow side: the batch's text is not sorted for the join
        return batch.join(kept.withColumnRenamed("rank", r).hint("shuffle_hash"), r, "left_semi")

    def foreach_batch(self, sink_path: str):
        """A ``foreachBatch`` function that writes kept rows to ``sink_path/batch=<id>``."""
        def fn(df: DataFrame, batch_id: int) -> None:
            self.process(df, batch_id).write.mode("overwrite").parquet(f"{sink_path}/batch={batch_id}")
        return fn


def _part(parts: F.Column) -> F.Column:
    """The part of a bucket in a run of so many parts."""
    return F.pmod(F.xxhash64(*N.BUCKET), parts).cast("int")


def start_stream(spark: SparkSession, source_dir: str, schema: str, state_dir: str,
                 sink_path: str, checkpoint_location: str, rank_col: str = "rank",
                 files_per_batch: int | None = None):
    """Run D8 over a folder of Parquet files with Structured Streaming.

    Files are taken in arrival (modification-time) order; ranks must grow from
    one file to the next for the result to equal a single pass.
    """
    job = IncrementalNearDedup(spark, state_dir, rank_col)
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    stream = reader.parquet(source_dir)
    return (stream.writeStream.foreachBatch(job.foreach_batch(sink_path))
            .option("checkpointLocation", checkpoint_location)
            .trigger(availableNow=True).start())
