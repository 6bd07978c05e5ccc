"""Shared helpers of the operators: staging, words, clashing columns."""

from __future__ import annotations

import os
import uuid

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sftforge import session
from sftforge.sources.tables import table

#: Words are maximal runs of anything but ASCII white space (space, \t \n \v \f \r).
WHITE = " \t\n\x0b\x0c\r"
#: Rows of an Arrow batch between Spark and a task's Python: texts of a few
#: kilobytes make batches of a megabyte or two, on both sides.
BATCH_ROWS = 500
BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def bounded_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small, so that two tasks' buffers and Python lists fit
    beside an executor's heap. A smaller setting of the session's own stays."""
    if int(spark.conf.get(BATCH_SETTING)) > BATCH_ROWS:
        spark.conf.set(BATCH_SETTING, BATCH_ROWS)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder that ``spark.checkpoint.dir`` names."""
    return os.path.join(session.scratch_dir(spark), f"{name}-{uuid.uuid4().hex}")


#: Folders that this process has staged; results may still read them.
STAGED: list[str] = []


def stage(df: DataFrame, name: str, compact: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, and
    what later steps read twice is computed once. Survives lost executors.
    ``compact``: by one task a core at most, for small rows that many shuffle
    partitions would scatter over as many files."""
    bounded_batches(df.sparkSession)
    path = scratch(df.sparkSession, name)
    STAGED.append(path)
    if compact:  # a shuffle of its own: a coalesced task would hold the sorts of many partitions at once
        df = df.repartition(df.sparkSession.sparkContext.defaultParallelism)
    df.write.option("compression", "zstd").parquet(path)
    staged = df.sparkSession.read.schema(df.schema).parquet(path)
    staged._staged_at = path
    return staged


def release(*frames: DataFrame) -> None:
    """Delete the folders of results of :func:`stage` that nothing reads any more."""
    for df in frames:
        if df is not None and df._staged_at in STAGED:
            STAGED.remove(df._staged_at)
            path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._staged_at)
            path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def without(df: DataFrame, names) -> DataFrame:
    """Drop input columns whose names an operator's output columns take."""
    taken = {n.lower() for n in names}
    return df.drop(*[c for c in df.columns if c.lower() in taken])


def slim(df: DataFrame, *cols: str) -> DataFrame:
    """Only the named columns, by exact reference (extra columns may clash)."""
    bounded_batches(df.sparkSession)
    return df.select(*[df[c] for c in cols])


def text_or_empty(col) -> Column:
    return F.coalesce(col, F.lit(""))


def words(text: str | None) -> list[bytes]:
    """Words of a text as UTF-8; ``bytes.split`` splits at exactly ``WHITE``."""
    return text.encode().split() if text else []


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def held(docs: DataFrame) -> DataFrame:
    """One column ``row`` with all of ``docs``' columns, so that helper columns
    beside it clash with none; ``select("row.*")`` gives them back."""
    bounded_batches(docs.sparkSession)
    return docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))


def hold(df: DataFrame) -> DataFrame:
    """Keep a small result that is read several times, in memory or on disk. A
    lost executor's part is computed again from staged tables. Released with
    ``spark.catalog.clearCache()`` once the results are written. Not for loops:
    what is held within a held result makes plans grow."""
    bounded_batches(df.sparkSession)
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def once_a_worker(name: str, make):
    """In a task: what ``make()`` gives, kept for the later tasks of the same
    Python worker (Spark uses workers again), such as a tokenizer and the words
    it has seen. Only for what is the same under one name and of bounded size."""
    import sys
    import types
    kept = sys.modules.setdefault("_sftforge_worker", types.ModuleType("_sftforge_worker")).__dict__
    if name not in kept:
        kept[name] = make()
    return kept[name]


def remove_staged(spark: SparkSession) -> None:
    """Delete every staged folder; call it once all results are written."""
    while STAGED:
        path = spark._jvm.org.apache.hadoop.fs.Path(STAGED.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
