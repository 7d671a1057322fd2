"""Intermediate tables in the folder that the cluster shares (``spark.checkpoint.dir``)."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordmill.session import checkpoint_dir


#: The paths handed out inside each open :func:`temporary` block, innermost last.
_OPEN: list[list[str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared checkpoint folder; never a machine-local one on a cluster."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if _OPEN:
        _OPEN[-1].append(path)
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder, if it is there."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Tables that operators store inside the block go at its end, also when it fails.

    Their names are unique to this run, so a retry or another run never loses a table. What is
    read from them must be written elsewhere before the block ends.
    """
    _OPEN.append([])
    try:
        yield
    finally:
        for path in _OPEN.pop():
            remove(spark, path)


def free_name(docs: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``docs`` has it."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet and read again: lineage ends at files every executor sees."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def one_of_repeats(docs: DataFrame, id_col: str, text_col: str, digest: F.Column) -> DataFrame:
    """Of rows with the same id and digest the one whose text, then whose row as JSON, is smallest."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    smallest = F.min_by(F.struct(*columns), F.struct(F.col(f"`{text_col}`"), F.to_json(F.struct(*columns))))
    found = docs.groupBy(F.col(f"`{id_col}`"), digest).agg(smallest.alias("_row")).select("_row.*")
    return docs.sparkSession.createDataFrame([], docs.schema).unionByName(found)
