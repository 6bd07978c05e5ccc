"""Conversation files as a stream.

The pipeline being rebuilt has no streaming part (no watermark, window, late
data or state). What a stream needs is only a source: new JSONL files dropped
into a folder, parsed exactly as the batch reader does (S1). Every row-wise
operator (P1-P5, L2, T2-T8) then works on the streaming DataFrame unchanged;
aggregate reports (L3, T10) run per micro-batch through ``foreachBatch``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sftforge.functions.text import py_strip
from sftforge.sources.conversations import messages_of, parse_conversation


def read_conversation_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None
                             ) -> DataFrame:
    """Streaming S1: (value, conversation, malformed, errors) for every non-blank line
    of the files that arrive under ``path``."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    v = py_strip(F.col("value"))
    conv, malformed, errors = parse_conversation(F.col("_messages"))
    return (r.load(path).withColumn("value", v).filter(F.col("value") != "")
             .withColumn("_messages", messages_of(F.col("value")))
             .select("value", conv.alias("conversation"), malformed.alias("malformed"), errors.alias("errors")))


__all__ = ["read_conversation_stream"]
