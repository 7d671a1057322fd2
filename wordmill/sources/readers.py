"""Corpus sources and sinks.

Each reader returns ``(text, source, ordinal)`` style DataFrames. The ordinal
is a sortable struct ``(file, block_start, row)`` taken from the hidden
``_metadata`` columns, so "first seen" is file order, never Spark's packing
of splits into partitions.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as TY

from wordmill.functions import text as T

CLEANED_SCHEMA = TY.StructType([
    TY.StructField("text", TY.StringType(), True),
    TY.StructField("source", TY.StringType(), True),
    TY.StructField("hash", TY.StringType(), True),
])

# --- fixed values: labels and column defaults of the three raw corpora ---------------
LINE_CORPUS_LABEL = "oscar"
FILE_CORPUS_LABEL = "wikipedia"
PARQUET_TEXT_COLUMN = "Article"
PARQUET_SOURCE_COLUMN = "Source"
PARQUET_TEXT_DEFAULT = ""
PARQUET_SOURCE_DEFAULT = "iriisnepal"
NULL_AS_STRING = "None"      # str(None) of a present-but-null cell
SPREAD_BYTES = 1 << 30       # scans above this are never repartitioned for parallelism
FILE_TASK_BYTES = 16 << 20   # content of small files that a task reads
FILE_FOLDERS = 256           # folders that many small files are dealt over; Spark lists more than 32 in tasks
# ----------------------------------------------------------------------------------------


def path_exists(spark: SparkSession, path: str) -> bool:
    """Ask the Hadoop file system (works for any shared store)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf).exists(p)


def has_files(spark: SparkSession, path: str, suffix: str) -> bool:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(conf)
    if not fs.exists(p):
        return False
    for st in fs.listStatus(p):
        if st.isFile() and st.getPath().getName().endswith(suffix):
            return True
    return False


def binary_files(spark: SparkSession, path: str, glob: str = "*", recursive: bool = True) -> DataFrame:
    """The files of ``path`` as Spark's binaryFile rows; listed once for all frames made of it.

    Spark counts some MB for opening a file, so a task would read a few of many small ones: a task gets about
    ``FILE_TASK_BYTES`` of content, where every core has some tasks.
    """
    if not path_exists(spark, path):
        return spark.createDataFrame([], "path string, modificationTime timestamp, length bigint, content binary")
    files = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
             .option("recursiveFileLookup", str(recursive).lower()).load(path))
    size = int(str(files._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return files.coalesce(max(8 * spark.sparkContext.defaultParallelism, size // FILE_TASK_BYTES))


def file_table(spark: SparkSession, path: str, glob: str = "*", files: DataFrame | None = None) -> DataFrame:
    """(path, bytes) of every file below ``path``, from the file system; no content is read.

    ``files`` is a :func:`binary_files` of the path that is at hand already.
    """
    files = binary_files(spark, path, glob) if files is None else files
    return files.select("path", F.col("length").alias("bytes"))


def _mounted(spark: SparkSession, path: str) -> str | None:
    """The folder of a path on a mounted file system; None in any other store."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.makeQualified(p).toUri().getPath() if fs.getUri().getScheme() == "file" else None


def write_files(df: DataFrame, path: str, key: str, value: str) -> None:
    """Every key's rows as a text file of their own below ``path``: its path ends in ``key=<the key>``, then
    ``.txt`` or a part's name. A line per row; a null is an empty line.

    On a mounted file system (the checkpoint folder is one that all executors share) the tasks
    write the files themselves, under a hidden name until they are whole, dealt over ``FILE_FOLDERS``
    folders. Spark's writer would make two folders and a checksum per file there, and Hadoop starts a
    process for the mode of each. In other stores Spark's writer is used. Values are not shuffled,
    but for keys that repeat.
    """
    folder = _mounted(df.sparkSession, path)
    rows = df.select(key, F.col(value).cast("string").alias("value"))
    if folder is None:
        # tasks move their files to their places; by the first algorithm the driver would move every folder, one by one
        (rows.repartition(key).write.option("mapreduce.fileoutputcommitter.algorithm.version", "2").partitionBy(key).text(path))
        return

    def run(batches):
        import os
        from urllib.parse import quote

        from pyspark import TaskContext
        attempt, n = TaskContext.get().taskAttemptId(), 0
        name = out = None

        def finish():
            if out is not None:
                out.close()
                os.replace(out.name, name)

        for batch in batches:
            for at, k, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                there = f"{folder}/{at}/{key}={'' if k is None else quote(str(k), safe='')}.txt"
                if there != name:
                    finish()
                    os.makedirs(f"{folder}/{at}", exist_ok=True)
                    head, tail = os.path.split(there)
                    name, out, n = there, open(f"{head}/.{tail}.{attempt}", "wb"), n + 1
                out.write((line.as_py() or b"") + b"\n")
        finish()
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["files"])

    def write(part: DataFrame) -> None:
        part = part.select(F.pmod(F.hash(key), F.lit(FILE_FOLDERS)).alias("folder"), key, F.col("value").cast("binary").alias("value"))
        part.mapInArrow(run, "files bigint").agg(F.sum("files")).collect()

    # only the rows of a key that repeats have to meet in a task
    rows.groupBy(key).count().where("count > 1").select(F.col(key).alias("_key")).write.parquet(f"{path}-repeated")
    repeated = df.sparkSession.read.schema(df.select(F.col(key).alias("_key")).schema).parquet(f"{path}-repeated")
    if repeated.isEmpty():
        write(rows)
        return
    same = rows[key].eqNullSafe(repeated["_key"])
    write(rows.join(repeated, same, "left_anti"))
    write(rows.join(repeated, same, "left_semi").repartition(key).sortWithinPartitions(key))


def empty_corpus(spark: SparkSession) -> DataFrame:
    schema = "text string, source string, ordinal struct<file:string,block:bigint,row:bigint>"
    return spark.createDataFrame([], schema)


def _ordinal(row_col) -> F.Column:
    return F.struct(F.col("_metadata.file_path").alias("file"),
                    F.col("_metadata.file_block_start").alias("block"),
                    row_col.cast("bigint").alias("row"))


def read_lines(spark: SparkSession, path: str, label: str = LINE_CORPUS_LABEL) -> DataFrame:
    """One document per line (``\\n``, ``\\r\\n``, ``\\r``), each line stripped."""
    if not path_exists(spark, path):
        return empty_corpus(spark)
    df = spark.read.text(path)
    return df.select(T.py_strip("value").alias("text"), F.lit(label).alias("source"),
                     _ordinal(F.monotonically_increasing_id()).alias("ordinal"))


def with_row_numbers(df: DataFrame, out: str = "row_no", ordinal: str = "ordinal") -> DataFrame:
    """``df`` with the 0-based number of each row over all files, in order of their paths.

    ``ordinal`` is a reader's (file, block, row). Rows of a split come in file order, so a
    row's number is its distance from the first row of its split plus the rows of all
    splits before it: a prefix sum over one row per split, then one per file. Nothing
    is sorted but these, and the rows are not shuffled unless the splits are too
    many to broadcast.
    """
    from pyspark.sql import Window
    o = F.col(ordinal)
    keys = df.select(o["file"].alias("_file"), o["block"].alias("_block"), o["row"].alias("_row"))
    splits = keys.groupBy("_file", "_block").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n"))
    files = splits.groupBy("_file").agg(F.sum("_n").alias("_n"))
    before_files = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("_file", F.coalesce(F.sum("_n").over(before_files), F.lit(0)).alias("_before_file"))
    in_file = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("_before", F.coalesce(F.sum("_n").over(in_file), F.lit(0))).join(files, "_file").select(
        "_file", "_block", (F.col("_before_file") + F.col("_before") - F.col("_first")).alias("_shift"))
    return (df.join(splits, (o["file"] == F.col("_file")) & (o["block"] == F.col("_block")))
            .withColumn(out, (o["row"] + F.col("_shift")).cast("bigint")).drop("_file", "_block", "_shift"))


def split_lines(text_col) -> F.Column:
    """S1 applied to an in-table text: universal-newline split, no trailing empty line."""
    t = F.col(text_col) if isinstance(text_col, str) else text_col
    body = F.regexp_replace(t, r"(?:\r\n|\r|\n)\z", "")
    return F.when(t == "", F.array().cast("array<string>")).otherwise(
        F.split(body, r"\r\n|\r|\n"))


def lines_of(df: DataFrame, text_col: str = "text", key: str = "doc_id") -> DataFrame:
    """Explode every text into its stripped lines with a line number."""
    ex = df.select(key, F.posexplode(split_lines(text_col)).alias("line_no", "line"))
    return ex.select(key, F.col("line_no").cast("bigint").alias("line_no"),
                     T.py_strip("line").alias("line"))


def read_files(spark: SparkSession, path: str, label: str = FILE_CORPUS_LABEL,
               glob: str = "*.txt", recursive: bool = False,
               files: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """One document per ``*.txt`` file (non-recursive unless asked), sorted by name.

    Returns ``(docs, bad_files)``: files that are not valid UTF-8 are routed to
    the second frame (path, bytes) instead of failing the job. ``files`` is a
    :func:`binary_files` of the path that is at hand already.
    """
    raw = binary_files(spark, path, glob, recursive) if files is None else files
    dec = raw.select("path", F.col("length").alias("bytes"), F.col("content").cast("string").alias("s"))
    ok = F.is_valid_utf8("s")
    docs = dec.where(ok).select(
        F.regexp_replace("s", r"\r\n?", "\n").alias("text"), F.lit(label).alias("source"),
        F.struct(F.col("path").alias("file"), F.lit(0).cast("bigint").alias("block"),
                 F.lit(0).cast("bigint").alias("row")).alias("ordinal"))
    bad = dec.where(~ok).select("path", "bytes")
    return docs, bad


def parquet_corpus(df: DataFrame, text_col: str = PARQUET_TEXT_COLUMN,
                   source_col: str = PARQUET_SOURCE_COLUMN, keep: tuple[str, ...] = (),
                   text_default: str = PARQUET_TEXT_DEFAULT,
                   source_default: str = PARQUET_SOURCE_DEFAULT) -> DataFrame:
    """S3 column rules: a missing column takes its default, a null cell becomes 'None'."""
    cols = set(df.columns)
    text = (F.coalesce(F.col(text_col).cast("string"), F.lit(NULL_AS_STRING))
            if text_col in cols else F.lit(text_default))
    src = (F.coalesce(F.col(source_col).cast("string"), F.lit(NULL_AS_STRING))
           if source_col in cols else F.lit(source_default))
    return df.select(*keep, text.alias("text"), src.alias("source"))


@dataclass(frozen=True)
class Shard:
    """What the footer of a Parquet shard says."""

    columns: frozenset[str]
    rows: int


def shard_footers(spark: SparkSession, path: str) -> dict[str, Shard | str]:
    """For every ``*.parquet`` shard of a folder its columns and rows, or what is wrong with its footer.

    Only footers are read, by a few driver threads through the Hadoop file system.
    """
    from concurrent.futures import ThreadPoolExecutor

    from py4j.protocol import Py4JJavaError
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(conf)
    if not fs.exists(folder):
        return {}
    files = sorted((st.getPath() for st in fs.listStatus(folder)
                    if st.isFile() and st.getPath().getName().endswith(".parquet")), key=lambda p: p.toString())

    def footer(p):
        try:
            reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(
                jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(p, conf))
            try:
                return Shard(frozenset(f.getName() for f in reader.getFileMetaData().getSchema().getFields()),
                             reader.getRecordCount())
            finally:
                reader.close()
        except Py4JJavaError as e:
            return str(e.java_exception.getMessage()).splitlines()[0]

    with ThreadPoolExecutor(8) as pool:
        return dict(zip((p.toString() for p in files), pool.map(footer, files)))


def shard_report(spark: SparkSession, path: str) -> DataFrame:
    """One row per shard, ``status`` read or corrupt, or one row ``missing`` for the folder."""
    rows = [(p, "corrupt" if isinstance(c, str) else "read", c if isinstance(c, str) else None)
            for p, c in shard_footers(spark, path).items()]
    return spark.createDataFrame(rows or [(path, "missing", "no shards found")],
                                 "path string, status string, detail string")


def _shard_rows(spark: SparkSession, footers: dict[str, Shard | str], salvage: bool) -> DataFrame | None:
    """(text, source, _file, _row) of all shards with a footer; shards with the same columns are read together."""
    groups: dict[frozenset[str], list[str]] = {}
    for p, shard in footers.items():
        if isinstance(shard, Shard):
            groups.setdefault(shard.columns & {PARQUET_TEXT_COLUMN, PARQUET_SOURCE_COLUMN}, []).append(p)
    out = None
    for columns, files in groups.items():
        reader = spark.read.option("mergeSchema", "false")
        if salvage:
            # a split ends at its first broken page instead of failing; page checksums are used where they exist
            reader = (reader.option("ignoreCorruptFiles", "true").option("parquet.page.verify-checksum.enabled", "true"))
        df = reader.parquet(*files).select(*sorted(columns), F.col("_metadata.file_path").alias("_file"),
                                           F.col("_metadata.row_index").alias("_row"))
        part = parquet_corpus(df, keep=("_file", "_row"))
        out = part if out is None else out.unionByName(part)
    return out


def _with_ordinal(rows: DataFrame) -> DataFrame:
    return rows.select("text", "source", F.struct(
        F.col("_file").alias("file"), F.lit(0).cast("bigint").alias("block"),
        F.col("_row").cast("bigint").alias("row")).alias("ordinal"))


def read_parquet_shards(spark: SparkSession, path: str) -> DataFrame:
    """S3: all ``*.parquet`` shards of a folder.

    The column rules hold shard by shard: shards with the same columns are read together, so a
    shard that lacks a column gets its default whatever the others have. Shards without a
    readable footer are left out; ``shard_report`` lists them, and so does a warning. A page
    that turns out to be corrupt while reading fails the job; ``salvage_parquet_shards`` keeps
    what stands before it.
    """
    import warnings
    footers = shard_footers(spark, path)
    for p, shard in footers.items():
        if isinstance(shard, str):
            warnings.warn(f"shard {p} is left out: {shard}", stacklevel=2)
    rows = _shard_rows(spark, footers, salvage=False)
    return empty_corpus(spark) if rows is None else empty_corpus(spark).unionByName(_with_ordinal(rows))


def salvage_parquet_shards(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """S3 with what broken shards still hold: (documents, report).

    Of every shard the rows before its first broken page stay, in whatever splits it was read; the
    rows behind it go, even if other splits could read them. The report has one row per shard: path, status (read,
    partial, corrupt footer, or missing for the folder), the rows its footer names and the rows kept.
    One more pass over the shards' columns finds out which are broken; only those are ordered by row.
    """
    from pyspark.sql import Window
    footers = shard_footers(spark, path)
    schema = "path string, status string, rows bigint, kept bigint, detail string"
    rows = _shard_rows(spark, footers, salvage=True)
    if rows is None:
        found = [(p, "corrupt", None, 0, c) for p, c in footers.items()]
        return empty_corpus(spark), spark.createDataFrame(found or [(path, "missing", None, 0, "no shards found")], schema)
    # asking for the sizes reads all pages of both columns
    sized = rows.withColumn("_size", F.octet_length("text") + F.octet_length("source"))
    seen = {_plain(r["_file"]): (r["_file"], r["n"]) for r in sized.groupBy("_file").agg(
        F.count(F.lit(1)).alias("n"), F.sum("_size").alias("_size")).collect()}    # one row per shard
    kept = {p: seen.get(_plain(p), (p, 0))[1] for p, f in footers.items() if isinstance(f, Shard)}
    broken = {p: seen[_plain(p)][0] for p, n in kept.items() if 0 < n < footers[p].rows}
    if broken:
        order = Window.partitionBy("_file").orderBy("_row")
        prefix = (sized.where(F.col("_file").isin(list(broken.values())) & (F.col("_size") >= 0)).select("_file", "_row")
                  .withColumn("_at", F.row_number().over(order) - 1)
                  .groupBy("_file").agg(F.count_if(F.col("_at") == F.col("_row")).alias("kept")).collect())
        lengths = {r["_file"]: r["kept"] for r in prefix}
        kept |= {p: lengths.get(name, 0) for p, name in broken.items()}
        limits = F.create_map(*(F.lit(x) for p, name in broken.items() for x in (name, kept[p])))
        rows = rows.where(F.coalesce(F.col("_row") < F.element_at(limits, F.col("_file")), F.lit(True)))
    report = [(p, "corrupt", None, 0, f) if isinstance(f, str) else
              (p, "read", f.rows, kept[p], None) if kept[p] == f.rows else
              (p, "partial", f.rows, kept[p], f"{f.rows - kept[p]} rows lost") for p, f in footers.items()]
    return empty_corpus(spark).unionByName(_with_ordinal(rows)), spark.createDataFrame(report, schema)


def _plain(path: str) -> str:
    """A file's path without what differs between a listing and ``_metadata``: scheme slashes, escapes."""
    from urllib.parse import unquote
    return unquote(path).replace(":///", ":/")


def read_jsonl(spark: SparkSession, path: str, schema: TY.StructType = CLEANED_SCHEMA) -> DataFrame:
    """Cleaned JSON-lines documents; a malformed line fails the job."""
    df = (spark.read.schema(schema).option("mode", "FAILFAST")
          .option("pathGlobFilter", "{*.jsonl,part-*.json}").json(path))
    return df.select("*", F.struct(F.col("_metadata.file_path").alias("file"),
                                   F.col("_metadata.file_block_start").alias("block"),
                                   F.monotonically_increasing_id().alias("row"))
                     .alias("ordinal"))


def write_jsonl(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Overwrite, raw UTF-8, keys in order text, source, hash."""
    w = df.select("text", "source", "hash", *([partition_by] if partition_by else []))
    writer = w.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.json(path)


def ensure_parallelism(df: DataFrame, key: str | None = None,
                       min_partitions: int | None = None) -> DataFrame:
    """Spread a scan that arrives in too few partitions over the cluster's cores.

    The per-document work (regexes, normalisation) is CPU-bound; a corpus stored
    as one large row group would otherwise run in a single task. Inputs of many files or
    row groups have enough splits, and inputs over ``SPREAD_BYTES`` are never shuffled for
    this: both pass through unchanged. Rows are the same either way. A hash partitioning
    on ``key`` (not round-robin) keeps retries deterministic.
    """
    spark = df.sparkSession
    want = min_partitions or 2 * spark.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size > SPREAD_BYTES or df.rdd.getNumPartitions() >= want:
        return df
    return df.repartition(want, key) if key else df.repartition(want)
