"""Conversation sources and sinks (S1, S2, S3) and physical line numbering (L1).

A conversation is ``ARRAY<STRUCT<role, content, reasoning_content>>``. A field
missing from the JSON reads as ``""`` (the default the readers apply); an
explicit JSON ``null`` stays ``NULL`` so that it can be rejected (the
preparation crashes on it, the audit skips it).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sftforge.functions.text import json_kind, last_key_wins, one_json_value, py_strip

MESSAGE_TYPE = T.StructType([
    T.StructField("role", T.StringType()),
    T.StructField("content", T.StringType()),
    T.StructField("reasoning_content", T.StringType()),
])
CONVERSATION_TYPE = T.ArrayType(MESSAGE_TYPE)
TEXT_FIELDS = ("content", "reasoning_content")


#: Bytes of files that :func:`last_file_of` counts at first, and files that it lists at a time.
FIRST_WAVE_BYTES = 64 << 20
LISTED_FILES = 1024


def read_lines(spark: SparkSession, path: str, first: int | None = None) -> DataFrame:
    """Physical lines of UTF-8 text files, with their file-order keys.

    ``_file``/``_block`` come from the file-source metadata; ``_mid`` increases
    by one per line inside a block, so (file, block, mid) is the physical order.
    With ``first``, only the files that hold the first so many lines are read,
    whole (see :func:`last_file_of`).
    """
    files = spark.read.text(path)
    if first is not None:
        last = last_file_of(spark, path, first)
        if last is not None:
            files = files.filter(F.col("_metadata.file_path") <= last)  # prunes the list of files
    return (files
            .select("value",
                    F.col("_metadata.file_path").alias("_file"),
                    F.col("_metadata.file_block_start").alias("_block"),
                    F.monotonically_increasing_id().alias("_mid")))


def last_file_of(spark: SparkSession, path: str, n: int, first_bytes: int = FIRST_WAVE_BYTES) -> str | None:
    """The file, in the order of paths, in which the first ``n`` lines under
    ``path`` end; null if there are no more than those.

    Files are counted in waves in their order: the first of ``first_bytes``, the
    others as large as the lines still missing should need by the lines counted
    so far. No file behind the last wave is opened. The driver holds at most
    ``LISTED_FILES`` paths with their counts at a time. Jobs run when it is called.
    """
    name = F.col("_metadata.file_path")
    listed = spark.read.format("binaryFile").load(path).select(
        name.alias("file"), F.col("_metadata.file_size").alias("size"))  # the contents are not read
    after, lines, size, budget = "", 0, 0, first_bytes
    while True:
        files = listed.filter(F.col("file") > after).orderBy("file").limit(LISTED_FILES).collect()
        while files:
            wave, total = 0, 0
            while wave < len(files) and (wave == 0 or total + files[wave].size <= budget):
                total += files[wave].size
                wave += 1
            upto = files[wave - 1].file
            counts = dict(spark.read.text(path).filter((name > after) & (name <= upto))
                          .groupBy(name.alias("file")).agg(F.count(F.lit(1))).collect())  # a row a file of the wave
            for f in files[:wave]:
                lines += counts.get(f.file, 0)
                if lines >= n:
                    return f.file
            size += total
            budget = max(first_bytes, int(1.25 * (n - lines) * size / max(lines, 1)))
            after, files = upto, files[wave:]
        if not listed.filter(F.col("file") > after).limit(1).collect():
            return None


def number_lines(lines: DataFrame) -> DataFrame:
    """Add ``line_no`` (0-based, physical order: files by path, blank lines
    counted). Lines are counted by file block; running totals are taken inside
    each file and over one row a file, and go to the lines by a broadcast."""
    blocks = lines.groupBy("_file", "_block").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first_mid"))
    before = lambda w: F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    files = blocks.groupBy("_file").agg(F.sum("_n").alias("_n"))
    files = files.select("_file", before(Window.orderBy("_file")).alias("_base"))
    offsets = (blocks.withColumn("_own", before(Window.partitionBy("_file").orderBy("_block")))
               .join(files, "_file").select("_file", "_block", "_first_mid",
                                            (F.col("_base") + F.col("_own")).alias("_offset")))
    return (lines.join(F.broadcast(offsets), ["_file", "_block"])  # one row a block; the lines stay where they are
            .withColumn("line_no", F.col("_offset") + F.col("_mid") - F.col("_first_mid"))
            .drop("_first_mid", "_offset"))


def messages_of(value: Column) -> Column:
    """The messages of a line, as an array of VARIANT; null if it is no JSON array."""
    return F.when(value.startswith("["), F.try_variant_get(one_json_value(value), "$", "array<variant>"))


def parse_conversation(messages: Column) -> tuple[Column, Column, Column]:
    """(conversation, malformed, errors) from one stripped text line's
    :func:`messages_of`, which should be a column of its own, so that it is
    parsed once.

    A line must hold one JSON *array* of objects and nothing else; a bare
    object, an array of non-objects, a null element, single quotes, text after
    the array or bad JSON is malformed. ``errors`` names texts that are no text
    ("1: content is BIGINT"); they read as null, so a conversation that needs
    one of them is rejected, and one that does not is used. Where an object repeats
    a key, its last value holds (see ``functions.text.last_key_wins``)."""
    def field(m, name):
        return F.try_variant_get(m, f"$.{name}", "variant")

    def text(m, name, missing=""):
        kind = json_kind(field(m, name))
        return (F.when(kind.isNull(), F.lit(missing)).when(kind == "STRING", F.try_variant_get(m, f"$.{name}", "string"))
                .otherwise(F.lit(None).cast("string")))

    conv = F.transform(messages, lambda m: F.struct(
        F.coalesce(text(m, "role"), F.lit("")).alias("role"), text(m, "content").alias("content"),
        text(m, "reasoning_content").alias("reasoning_content")))
    malformed = messages.isNull() | F.exists(messages, lambda m: F.coalesce(json_kind(m), F.lit("")) != "OBJECT")
    wrong = F.transform(messages, lambda m, i: F.array_compact(F.array(*[
        F.when(~json_kind(field(m, name)).isin("STRING", "VOID"),
               F.concat(i.cast("string"), F.lit(f": {name} is "), json_kind(field(m, name)))) for name in TEXT_FIELDS])))
    conv = F.when(~malformed, conv).cast(CONVERSATION_TYPE)
    return conv, malformed, F.when(~malformed, F.flatten(wrong))


def read_conversations(spark: SparkSession, path: str, max_lines: int | None = None,
                       numbered: bool = False) -> DataFrame:
    """JSONL conversations -> DF(line_no?, value, conversation, malformed, errors).

    Lines are stripped; blank lines are dropped. Bad lines are kept with
    ``malformed = true`` instead of failing the job. ``line_no`` (asked for with
    ``numbered``, or by the physical line cap ``max_lines``, which counts blank
    lines as the audit does) tells every line apart, equal ones too. With a cap,
    only the files that hold its lines are read; finding them runs jobs.
    """
    last_key_wins(spark)
    lines = read_lines(spark, path, max_lines)
    if numbered or max_lines is not None:
        lines = number_lines(lines)
    if max_lines is not None:
        lines = lines.filter(F.col("line_no") < max_lines)
    v = py_strip(F.col("value"))
    conv, malformed, errors = parse_conversation(F.col("_messages"))
    keep = [c for c in ("line_no",) if c in lines.columns]
    return (lines.withColumn("value", v)
            .filter(F.col("value") != "").withColumn("_messages", messages_of(F.col("value")))
            .select(*keep, "value", conv.alias("conversation"), malformed.alias("malformed"), errors.alias("errors")))


def conversation_json(conv: Column) -> Column:
    """One JSON array per conversation, keys in order role, content,
    reasoning_content; nulls written as "" (``to_json`` would drop them)."""
    return F.to_json(F.transform(conv, lambda m: F.struct(
        F.coalesce(m["role"], F.lit("")).alias("role"),
        F.coalesce(m["content"], F.lit("")).alias("content"),
        F.coalesce(m["reasoning_content"], F.lit("")).alias("reasoning_content"))))


def write_conversations(df: DataFrame, path: str, mode: str = "overwrite", col: str = "conversation",
                        compression: str | None = None, file_lines: int = 0) -> None:
    """Write one JSON array per line (overwrite = truncate first), as plain
    text or with a ``compression`` of Spark's text writer (``gzip``: the readers
    tell it by the files' names). A file ends after ``file_lines`` lines, if that
    is given; leave it out where the order of the files counts, as the number of
    a task's files is no part of their names' order beyond 1,000."""
    lines = df.select(conversation_json(F.col(col)).alias("value"))
    lines.write.mode(mode).option("maxRecordsPerFile", file_lines).text(path, compression=compression)


def fold_turns(turns: DataFrame, reasoning: str = "none") -> DataFrame:
    """S3: turn table (conv_id, turn, role, text) -> (conv_id, conversation).

    ``reasoning='previous_assistant'`` fills each assistant message's
    ``reasoning_content`` with the text of the assistant message before it (how
    the test tables get a reasoning part); ``'none'`` leaves it ``""``.
    One row per conversation: the group is one conversation, which is bounded.
    """
    if reasoning == "previous_assistant":
        # one shuffle: the window and the grouping share the partitioning
        same = Window.partitionBy("conv_id", "role").orderBy("turn")
        before = F.when(F.col("role") == "assistant", F.coalesce(F.lag("text").over(same), F.lit("")))
        turns = turns.repartition("conv_id").withColumn("reasoning", F.coalesce(before, F.lit("")))
    elif reasoning == "none":
        turns = turns.withColumn("reasoning", F.lit(""))
    else:
        raise ValueError(f"unknown reasoning mode {reasoning!r}")
    g = turns.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "text", "reasoning"))).alias("_t"))
    conv = F.transform("_t", lambda x: F.struct(
        x["role"].alias("role"), x["text"].alias("content"), x["reasoning"].alias("reasoning_content")))
    return g.select("conv_id", conv.cast(CONVERSATION_TYPE).alias("conversation"))
