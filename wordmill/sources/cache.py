"""Keyed build-or-load cache of prepared splits (S7) and latest complete cache.

Paths go through the Hadoop file system API, so the cache can live on any shared
store the cluster mounts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

SPLITS = ("train", "val")


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _complete(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path + "/_SUCCESS")
    return fs.exists(p)


def fingerprint(spark: SparkSession, paths: list[str]) -> str:
    """Digest of the names, sizes and modification times of the files below ``paths``."""
    import hashlib
    seen = []
    for path in paths:
        fs, p = _fs(spark, path)
        todo = [fs.getFileStatus(p)]
        while todo:
            st = todo.pop()
            if st.isDirectory():
                todo += list(fs.listStatus(st.getPath()))
            else:
                seen.append(f"{st.getPath()}:{st.getLen()}:{st.getModificationTime()}")
    return hashlib.md5("\n".join(sorted(seen)).encode()).hexdigest()


def stage(spark: SparkSession, name: str, inputs: list[str], build: Callable[[], DataFrame]) -> DataFrame:
    """A Parquet table in the session's checkpoint folder, written once per state of its inputs.

    Later passes read the columns they need; a changed input gives another table. The
    folder belongs to the session, so a table never outlives the code that wrote it.
    """
    from wordmill.session import checkpoint_dir
    path = f"{checkpoint_dir(spark)}/stage-{name}-{fingerprint(spark, inputs)}"
    if not _complete(spark, path):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def cache_key(model: str, tokenizer_tag: str, max_length: int, n_train: int, n_val: int) -> str:
    """Key of one prepared set: model, tokenizer tag, block length and doc counts."""
    return f"{model}-{tokenizer_tag}-block{max_length}-train{n_train}-val{n_val}"


MANIFEST = "_MANIFEST"


def _manifest(spark: SparkSession, path: str) -> str:
    """One line per data file of the splits below ``path``: its place and length."""
    fs, p = _fs(spark, path)
    lines, todo = [], [fs.getFileStatus(fs.makeQualified(p).suffix(f"/{s}")) for s in SPLITS]
    base = fs.makeQualified(p).toString()
    while todo:
        st = todo.pop()
        if st.isDirectory():
            todo += list(fs.listStatus(st.getPath()))
        else:
            lines.append(f"{st.getPath().toString()[len(base) + 1:]}\t{st.getLen()}")
    return "\n".join(sorted(lines))


def _write_manifest(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, f"{path}/{MANIFEST}")
    out = fs.create(p, True)
    try:
        out.write(bytearray(_manifest(spark, path).encode()))
    finally:
        out.close()


def is_complete(spark: SparkSession, path: str) -> bool:
    """Both splits are there, and exactly with the files that the manifest names."""
    if not all(_complete(spark, f"{path}/{s}") for s in SPLITS):
        return False
    fs, p = _fs(spark, f"{path}/{MANIFEST}")
    if not fs.exists(p):
        return False
    jvm = spark.sparkContext._jvm
    stream = fs.open(p)
    try:
        text = jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return text == _manifest(spark, path)


def _publish(spark: SparkSession, staging: str, path: str) -> bool:
    """Move a built set to its place in one step; False if another builder's set is there already."""
    from py4j.protocol import Py4JJavaError
    jvm = spark.sparkContext._jvm
    hadoop = jvm.org.apache.hadoop.fs
    source, target = hadoop.Path(staging), hadoop.Path(path)
    options = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    fs = target.getFileSystem(conf)
    try:
        # unlike FileSystem.rename this fails where the target exists, and never moves into it
        hadoop.FileContext.getFileContext(fs.getUri(), conf).rename(
            fs.makeQualified(source), fs.makeQualified(target), options)
        return True
    except Py4JJavaError:
        if not fs.exists(target):
            raise
        return False


def build_or_load(spark: SparkSession, root: str, key: str,
                  build: Callable[[], dict[str, DataFrame]]) -> dict[str, DataFrame]:
    """Load both splits if the set under ``root/key`` is complete, else build and save it.

    A set is built in a staging folder of its own and gets a manifest of its files; then it
    is renamed to its key in one step. So a set under a key is whole, however many sessions build it
    at once: the first one to finish publishes, the others drop theirs and load that one. A folder that
    does not agree with its manifest (a failed copy, say) is set aside and built anew.
    """
    import uuid
    path = f"{root}/{key}"
    fs, target = _fs(spark, path)
    if not is_complete(spark, path):
        staging = f"{root}/_staging-{key}-{uuid.uuid4().hex}"
        built = build()
        for s in SPLITS:
            built[s].write.parquet(f"{staging}/{s}")
        _write_manifest(spark, staging)
        if not _publish(spark, staging, path) and not is_complete(spark, path):
            aside = _fs(spark, f"{root}/_broken-{key}-{uuid.uuid4().hex}")[1]
            fs.rename(target, aside)
            _publish(spark, staging, path)
        fs.delete(_fs(spark, staging)[1], True)
    return {s: spark.read.parquet(f"{path}/{s}") for s in SPLITS}


def latest_complete(spark: SparkSession, root: str) -> str | None:
    """The complete set with the newest modification time; staging folders and broken sets do not count."""
    fs, p = _fs(spark, root)
    if not fs.exists(p):
        return None
    best, best_t = None, -1
    for st in fs.listStatus(p):
        if not st.isDirectory() or st.getPath().getName().startswith("_"):
            continue
        d = st.getPath().toString()
        if st.getModificationTime() > best_t and is_complete(spark, d):
            best, best_t = d, st.getModificationTime()
    return best
