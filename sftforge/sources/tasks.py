"""Task record codec (S4): task table <-> JSON lines, with the record defaults."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sftforge.functions.text import each, json_kind, last_key_wins, one_json_value, py_strip

METADATA_TYPE = T.StructType([
    T.StructField("seed", T.LongType()),
    T.StructField("trace_id", T.StringType()),
    T.StructField("full_sequence", T.StringType()),
    T.StructField("question_sequence", T.StringType()),
    T.StructField("closing_sequence", T.StringType()),
    T.StructField("n_types", T.IntegerType()),
    T.StructField("total_length", T.IntegerType()),
    T.StructField("fill_length", T.IntegerType()),
    T.StructField("nesting_depth", T.IntegerType()),
])
TASK_TYPE = T.StructType([
    T.StructField("question", T.StringType()),
    T.StructField("answer", T.StringType()),
    T.StructField("difficulty", T.IntegerType()),
    T.StructField("metadata", METADATA_TYPE),
    T.StructField("gpt_response", T.StringType()),
])


def empty_metadata() -> Column:
    """The ``{}`` default: a metadata struct with every field null."""
    return F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in METADATA_TYPE.fields])


#: JSON kinds that a column of each type takes.
KINDS = {"string": ("STRING",), "int": ("BIGINT",), "bigint": ("BIGINT",)}


def is_record(v: Column) -> Column:
    """Whether a line's VARIANT is an object."""
    return F.coalesce(json_kind(v) == "OBJECT", F.lit(False))


def parse_task(v: Column) -> Column:
    """The VARIANT of a line (a column of its own, so that it is parsed once) -> task struct with defaults question "", answer "",
    difficulty 1, metadata {} (all fields null), gpt_response "" for what is
    missing or null, ``metadata_json``, the metadata object's text with all its
    keys, and ``errors``, which name the fields whose value is of another type
    ("difficulty is STRING"; such a field reads as null). Null unless the text
    is one JSON object and nothing else. Where an object repeats a key, its last
    value holds (see ``functions.text.last_key_wins``)."""
    return F.when(is_record(v), F.struct(*[c.alias(name) for name, c in task_fields(v).items()]))


def task_fields(v: Column) -> dict[str, Column]:
    """The fields of :func:`parse_task` by name, each an expression of its own, so
    that a reader of some of them computes no others."""
    def get(path, kind):
        return F.try_variant_get(v, path, kind)

    def wrong(name, kinds):
        kind = json_kind(get(f"$.{name}", "variant"))
        return F.when(~kind.isin(*kinds, "VOID"), F.concat(F.lit(f"{name} is "), kind))

    def typed(name, kind, default=None):
        found = json_kind(get(f"$.{name}", "variant"))
        ok = F.when(found.isin(*KINDS[kind]), get(f"$.{name}", kind))
        return ok if default is None else F.when(found.isNull() | (found == "VOID"), F.lit(default)).otherwise(ok)

    inner = [(f.name, f.dataType.simpleString()) for f in METADATA_TYPE.fields]
    is_object = json_kind(get("$.metadata", "variant")) == "OBJECT"
    errors = [wrong(name, KINDS[kind]) for name, kind in
              (("question", "string"), ("answer", "string"), ("difficulty", "int"), ("gpt_response", "string"))]
    errors.append(wrong("metadata", ("OBJECT",)))
    errors += [F.when(is_object, wrong(f"metadata.{name}", KINDS[kind])) for name, kind in inner]
    metadata = F.struct(*[F.when(is_object, typed(f"metadata.{name}", kind)).alias(name) for name, kind in inner])
    return {"question": typed("question", "string", ""), "answer": typed("answer", "string", ""),
            "difficulty": typed("difficulty", "int", 1), "metadata": metadata,
            "gpt_response": typed("gpt_response", "string", ""),
            "metadata_json": F.coalesce(F.when(is_object, F.to_json(get("$.metadata", "variant"))), F.lit("{}")),
            "errors": F.array_compact(F.array(*errors))}


def task_json(df: DataFrame) -> Column:
    """Task columns -> JSON text (key order question, answer, difficulty,
    metadata, gpt_response). A ``metadata_json`` column is written as it is, so
    keys of the caller's own survive; else the ``metadata`` struct is."""
    def get(name, default):
        return F.col(name) if name in df.columns else default

    head = F.to_json(F.struct(get("question", F.lit("")).alias("question"), get("answer", F.lit("")).alias("answer"),
                              get("difficulty", F.lit(1)).alias("difficulty")))
    tail = F.to_json(F.struct(get("gpt_response", F.lit("")).alias("gpt_response")))
    metadata = F.coalesce(get("metadata_json", F.lit(None).cast("string")),
                          F.to_json(get("metadata", empty_metadata())), F.lit("{}"))
    return F.concat(F.left(head, F.length(head) - 1), F.lit(',"metadata":'), metadata, F.lit(","),
                    F.substring(tail, 2, F.length(tail)))


def write_tasks(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.select(task_json(df).alias("value")).write.mode(mode).text(path)


def read_tasks(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines -> task table; lines that are no record get ``malformed = true``
    (and keep their text in ``value``). ``reason`` says why a row is a reject:
    malformed, or its ``errors``; null for a good record. Lines are parsed below a
    generator, so that no filter on the result parses them again."""
    last_key_wins(spark)
    v, good = F.col("_v"), ~F.col("malformed")
    lines = spark.read.text(path).select(py_strip(F.col("value")).alias("value"))
    return (lines.filter(F.col("value") != "")
            .select("value", each(F.array(F.when(F.col("value").startswith("{"), one_json_value(F.col("value"))))).alias("_v"))
            .select("value", "_v", (~is_record(v)).alias("malformed"))
            .select("value", *[F.when(good, c).alias(name) for name, c in task_fields(v).items()], "malformed")
            .withColumn("reason", F.when(F.col("malformed"), F.lit("malformed")).when(
                F.size("errors") > 0, F.array_join("errors", "; "))))
