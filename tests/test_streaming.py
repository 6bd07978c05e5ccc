"""The streaming source parses like the batch reader and feeds row-wise operators."""

import json

from pyspark.sql import functions as F

from sftforge.operators import chat, lengths
from sftforge.streaming import read_conversation_stream


def test_stream_audit(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    lines = [json.dumps([{"role": "user", "content": "hello there"}, {"role": "assistant", "content": "hi"}]),
             "", "not json"]
    (src / "part-0.jsonl").write_text("\n".join(lines) + "\n", encoding="utf-8")
    s = read_conversation_stream(spark, str(src)).withColumn("conv_id", F.xxhash64("value"))
    texts, _ = chat.prepare_texts(s)
    out = lengths.sequence_lengths(texts).select("length")
    q = (out.writeStream.format("memory").queryName("stream_lengths")
            .option("checkpointLocation", str(tmp_path / "ckpt"))
            .trigger(availableNow=True).start())
    q.awaitTermination(120)
    got = [r.length for r in spark.sql("SELECT length FROM stream_lengths").collect()]
    assert got == [len(["<|user|>", "hello", " ", "there", "<|assistant|>", "hi", "<|end|>"])]
