"""Partition layout helpers. None of them runs a job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Hash buckets of :func:`hash_rank`: a bounded table of counts.
RANK_BUCKETS = 1 << 16


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows of a table with fewer splits than the session has cores over
    all of them, before work that is heavy for each row. A table of more splits,
    as any large one, is left as it is: its rows do not move."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def hash_rank(df: DataFrame, key: Column, *ties: Column | str, out: str = "rank",
              counted: DataFrame | None = None) -> DataFrame:
    """Add the 0-based rank of each row by the hexadecimal hash ``key`` (then
    ``ties``), without a global sort: ranks inside each of ``RANK_BUCKETS``
    leading-digit buckets, plus the number of rows in earlier buckets. ``counted``
    is a cheaper table that gives the same keys (as often), to count them in."""
    def keyed(t):
        return t.withColumn("_key", key).withColumn("_bucket", F.conv(F.substring("_key", 1, 4), 16, 10).cast("int"))

    x = keyed(df)
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = ((x if counted is None else keyed(counted)).groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
            .select("_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base")))
    inside = F.row_number().over(Window.partitionBy("_bucket").orderBy("_key", *ties)) - 1
    return (x.withColumn("_inside", inside).join(base, "_bucket")
            .withColumn(out, (F.col("_base") + F.col("_inside")).cast("bigint"))
            .drop("_key", "_bucket", "_base", "_inside"))
