"""Operator 8, sharding by a Feistel permutation over global row numbers.

Rows of a table are numbered through its files in a fixed order (a file's rows
by their place in it). A Feistel network over two digits of about the square
root of N permutes the numbers 0 to N-1; the few results beyond N - 1 walk on
along their cycle until they fall below N. Row number r then goes to shard
p(r) mod S, slot p(r) div S: a reproducible shuffle whose shards differ by at
most one row, and from a row number, N and the key, shard and slot can be
computed (and back, with :func:`inverse`) without looking at any other row.

The walk is bounded exactly, not by a guess: every number on it but the first
lies beyond N - 1, and a job over those (at most about sqrt N) numbers counts
how many are followed by another; no walk is longer than that count plus two.

Only DataFrame functions are used. Nothing is shuffled but one count for each
file; rows with equal keys, texts or sources are nothing special.

Defined results: any column may be null (a null text has size 1 and checksum 0
of the empty text); repeated rows get places of their own; an empty table gives
no rows; input columns named like an output column are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sftforge.llm.common import STAGED, hold, scratch, text_or_empty, without

SHARDS = 16
KEY = 20241
ROUNDS = 6
#: Groups of files whose counts are summed on their own, so that no task orders all files.
FILE_GROUPS = 256


def numbered(spark: SparkSession, path: str) -> tuple[DataFrame, int]:
    """A Parquet table with ``row_number`` (from 0, gapless), and its number of rows."""
    table = spark.read.parquet(path)
    place = table.metadataColumn("_metadata")
    rows = table.select(*[table[c] for c in without(table, ["row_number"]).columns],
                        place["file_path"].alias("__op8_file"), place["row_index"].alias("__op8_index"))
    per_file = rows.groupBy("__op8_file").agg(F.count("*").alias("n")).withColumn(
        "g", F.pmod(F.xxhash64(F.element_at(F.split("__op8_file", "/"), -1)), F.lit(FILE_GROUPS)))
    before = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    groups = per_file.groupBy("g").agg(F.sum("n").alias("n"))  # FILE_GROUPS rows at most
    groups = groups.select("g", before(Window.orderBy("g")).alias("base"))
    files = per_file.select("g", "__op8_file", "n", before(Window.partitionBy("g").orderBy("__op8_file")).alias("own"))
    files = hold(files.join(groups, "g").select("__op8_file", "n", (F.col("base") + F.col("own")).alias("__op8_base")))
    total = files.agg(F.sum("n")).first()[0] or 0  # its size is known from here on: Spark broadcasts it if it is small
    files = files.drop("n")
    out = rows.join(files, "__op8_file").withColumn("row_number", F.col("__op8_base") + F.col("__op8_index"))
    return out.drop("__op8_file", "__op8_index", "__op8_base"), total


def digits(n: int) -> tuple[int, int]:
    """Two bases whose product is at least ``n`` and exceeds it by less than the first."""
    a = 1
    while a * a < n:
        a = max(a + 1, int(n ** 0.5))
    return a, max(1, -(-n // a))


def _rounds(a: int, b: int) -> list[int]:
    """The base of the digit that each round replaces."""
    return [a if i % 2 == 0 else b for i in range(ROUNDS)]


def feistel(x: Column, n: int, key: int = KEY) -> Column:
    """One pass of the network: a permutation of 0 .. a * b - 1."""
    a, b = digits(n)
    steps = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(base).cast("long").alias("base"))
                      for i, base in enumerate(_rounds(a, b))])
    start = F.struct((x % a).alias("l"), F.floor(x / a).cast("long").alias("r"))
    end = F.aggregate(steps, start, lambda s, k: F.struct(
        s["r"].alias("l"),
        F.pmod(s["l"] + F.pmod(F.xxhash64(F.lit(key), k["i"], s["r"]), k["base"]), k["base"]).alias("r")))
    return end["l"] + end["r"] * a if ROUNDS % 2 == 0 else end["r"] + end["l"] * a


def inverse_feistel(x: Column, n: int, key: int = KEY) -> Column:
    """Undo one pass."""
    a, b = digits(n)
    steps = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(base).cast("long").alias("base"))
                      for i, base in reversed(list(enumerate(_rounds(a, b))))])
    l, r = (x % a).alias("l"), F.floor(x / a).cast("long").alias("r")
    start = F.struct(l, r) if ROUNDS % 2 == 0 else F.struct(r.alias("l"), l.alias("r"))
    end = F.aggregate(steps, start, lambda s, k: F.struct(
        F.pmod(s["r"] - F.pmod(F.xxhash64(F.lit(key), k["i"], s["l"]), k["base"]), k["base"]).alias("l"),
        s["l"].alias("r")))
    return end["l"] + end["r"] * a


def longest_walk(spark: SparkSession, n: int, key: int = KEY, step=feistel) -> int:
    """Passes after which every walk from below ``n`` has come back below ``n``."""
    a, b = digits(n)
    beyond = spark.range(n, a * b)
    return beyond.filter(step(F.col("id"), n, key) >= n).count() + 2


def _walk(x: Column, n: int, passes: int, key: int, step) -> Column:
    turns = F.sequence(F.lit(1), F.lit(passes))
    return F.aggregate(turns, x, lambda at, i: F.when((i > 1) & (at < n), at).otherwise(step(at, n, key)))


def permuted(x: Column, n: int, passes: int, key: int = KEY) -> Column:
    """The place of row number ``x`` among ``n``; ``passes`` from :func:`longest_walk`."""
    return _walk(x.cast("long"), n, passes, key, feistel)


def inverse(place: Column, n: int, passes: int, key: int = KEY) -> Column:
    """The row number at a place; ``passes`` from :func:`longest_walk` with :func:`inverse_feistel`."""
    return _walk(place.cast("long"), n, passes, key, inverse_feistel)


def shard_table(spark: SparkSession, path: str, shards: int = SHARDS, key: int = KEY) -> DataFrame:
    """The table's columns with ``shard`` and ``slot``."""
    rows, n = numbered(spark, path)
    rows = without(rows, ["shard", "slot"])
    passes = longest_walk(spark, max(n, 1), key)
    rows = rows.withColumn("__op8_place", permuted(F.col("row_number"), max(n, 1), passes, key))
    return (rows.withColumn("shard", (F.col("__op8_place") % shards).cast("int"))
            .withColumn("slot", F.floor(F.col("__op8_place") / shards).cast("long")).drop("__op8_place", "row_number"))


def shard_rows(df: DataFrame, shards: int = SHARDS, key: int = KEY) -> DataFrame:
    """:func:`shard_table` of any DataFrame, which is written to the shared folder first."""
    path = scratch(df.sparkSession, "op8-rows")
    STAGED.append(path)
    df.write.parquet(path)
    return shard_table(df.sparkSession, path, shards, key)


def digest(rows: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of sharded documents."""
    text = text_or_empty(rows["text"])
    return rows.select(rows["doc_id"], (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("rows").alias("law"),
                       rows["shard"], rows["slot"], F.lit(None).cast("int").alias("grown_shard"))
