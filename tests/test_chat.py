"""S1, S3, P1-P4, L1-L4 on hand-made rows."""

import json
import os

from pyspark.sql import functions as F

from sftforge.operators import chat, lengths
from sftforge.sources import fold_turns, last_file_of, read_conversations, read_lines, write_conversations
from sftforge.functions.text import py_strip


def _write(path, lines):
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")


LINES = [
    json.dumps([{"role": "user", "content": "q1"}, {"role": "assistant", "content": "a1", "reasoning_content": "r1"}]),
    "",
    "   ",
    "not json",
    json.dumps({"role": "user", "content": "bare object"}),
    "version https://git-lfs.github.com/spec/v1",
    json.dumps([{"role": "user", "content": "only user"}]),
    json.dumps([{"role": "assistant", "content": "only assistant"}]),
    json.dumps([{"role": "system", "content": "s"}, {"role": "user", "content": "u"},
                {"role": "assistant", "content": "a"}]),
    json.dumps([{"role": "user", "content": "u1"}, {"role": "assistant", "content": "a1"},
                {"role": "user", "content": "u2"}]),
    json.dumps([{"role": "user", "content": "u"}, {"role": "assistant", "content": None}]),
    json.dumps([{"role": "user", "content": "u"}, {"role": "assistant", "content": "c", "reasoning_content": ""}]),
    json.dumps([{"role": "user", "content": "u"}, {"role": "assistant", "content": "", "reasoning_content": "r"}]),
    json.dumps([{"role": "user", "content": "u"},
                {"role": "assistant", "content": " c ", "reasoning_content": "think\n\t"}]),
]
BAD = [
    json.dumps([{"role": "user", "content": "u"}]) + " trailing",
    "[{'role': 'user', 'content': 'single quotes'}]",
    '[{"role": "user"}], [{"role": "user"}]',
    '[{"role": "user"}]], [[{"role": "user"}]',
    '[{"role": "user"}], "d": 1',
    "[1, 2]",
    "[null]",
]


def test_read_and_classify(spark, tmp_out):
    p = f"{tmp_out}/c.jsonl"
    _write(p, LINES)
    df = read_conversations(spark, p).withColumn("conv_id", F.monotonically_increasing_id())
    rows = df.collect()
    assert len(rows) == len(LINES) - 2  # blank and spaces-only lines dropped
    bad = [r.value for r in rows if r.malformed]
    assert set(bad) == {"not json", LINES[4], LINES[5]}
    lm = chat.reject_reason(chat.last_messages(df)).collect()
    reasons = sorted(r.reason for r in lm if r.reason)
    assert reasons == sorted(["malformed"] * 3 + ["missing_assistant", "missing_user", "null_text"])


def test_reader_is_strict_and_numbers_lines(spark, tmp_out):
    p = f"{tmp_out}/bad.jsonl"
    _write(p, BAD + ["", LINES[0], LINES[0]])
    rows = read_conversations(spark, p, numbered=True).collect()
    assert {r.value for r in rows if r.malformed} == set(BAD)
    assert sorted(r.line_no for r in rows) == [*range(len(BAD)), len(BAD) + 1, len(BAD) + 2]


def test_strip_is_linear(spark):
    import time
    df = spark.createDataFrame([(" a" + " " * 100_000 + "b \t",)], "v string")
    began = time.time()
    assert df.select(F.length(py_strip(F.col("v")))).first()[0] == 100_002
    assert time.time() - began < 5


def test_previous_assistant_forms_agree(spark):
    t = spark.createDataFrame(
        [(1, 0, "user", "u1"), (1, 1, "assistant", "a1"), (1, 2, "user", "u2"), (1, 3, "assistant", "a2"),
         (2, 0, "user", "u"), (2, 1, "assistant", "a"), (3, 0, "system", "s"), (4, 1, "assistant", "x")],
        "conv_id long, turn long, role string, text string")
    cols = ["conv_id", "user", "assistant", "reasoning", "user_after_assistant"]
    direct = {r.conv_id: tuple(r) for r in chat.last_messages(t, reasoning="previous_assistant").select(*cols).collect()}
    folded = chat.last_messages(fold_turns(t, "previous_assistant")).select(*cols).collect()
    assert direct[1] == (1, "u2", "a2", "a1", False)
    usable = {r.conv_id: tuple(r) for r in folded if r.user is not None and r.assistant is not None}
    assert {i: direct[i] for i in usable} == usable and set(direct) == {1, 2, 3, 4}


def test_scratch_needs_a_shared_folder(spark):
    import pytest
    from sftforge.session import scratch_dir

    class Cluster:  # stands in for a session on a cluster
        class sparkContext:
            master = "spark://host:7077"
            getCheckpointDir = staticmethod(lambda: None)
            getConf = staticmethod(lambda: {})

        class conf:
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(ValueError):
        scratch_dir(Cluster)
    assert scratch_dir(spark)


def test_last_wins_pairs_later_user_with_earlier_assistant(spark):
    t = spark.createDataFrame([(1, 0, "user", "u1"), (1, 1, "assistant", "a1"), (1, 2, "user", "u2"),
                               (2, 0, "system", "s"), (2, 1, "user", "u"), (2, 2, "assistant", "a")],
                              "conv_id long, turn long, role string, text string")
    r = {x.conv_id: x for x in chat.last_messages(t).collect()}
    assert (r[1].user, r[1].assistant, r[1].user_after_assistant) == ("u2", "a1", True)
    assert (r[2].user, r[2].assistant, r[2].user_after_assistant) == ("u", "a", False)


def test_compose_strip(spark):
    df = spark.createDataFrame([("think\n\t", " c "), ("", "c"), ("r", ""), ("　r ", "c\x1f")],
                               "reasoning string, assistant string")
    out = [r.assistant_text for r in chat.compose_assistant(df).collect()]
    assert out == ["think\n\nFINAL ANSWER: c", "c", "r", "r\n\nFINAL ANSWER: c"]
    s = spark.createDataFrame([(x,) for x in [" a b ", "\t\n", "x "]], "v string")
    assert [r[0] for r in s.select(py_strip(F.col("v"))).collect()] == [" a b ".strip(), "", "x"]


def test_render(spark):
    df = spark.createDataFrame([("u", "a")], "user string, assistant_text string")
    r = chat.render_chat(df).first()
    assert r.full_text == "<|user|>u<|assistant|>a<|end|>"
    assert r.user_text == "<|user|>u" and r.request_text == "<|user|>u<|assistant|>"


def _stats(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "length long")
    return lengths.length_stats(df).collect()


def test_percentiles(spark):
    for n, exp in [(1, (1, 1, 1)), (19, (10, 19, 19)), (20, (11, 20, 20)), (99, (50, 95, 99)),
                   (100, (51, 96, 100))]:
        r = _stats(spark, list(range(1, n + 1)))[0]
        assert (r.p50, r.p95, r.p99) == exp, n
    empty = spark.createDataFrame([], "length long")
    assert lengths.length_stats(empty).collect() == []


def test_minimum_slice_matches_fixture(spark):
    import __spark_entry__ as E
    r = E.entry(spark).first()
    assert (r.n, r.n_skipped, r.min, r.max, r.p50, r.p95, r.p99) == (16, 4, 131, 693, 404, 693, 693)
    assert round(r.mean, 1) == 388.4


def test_line_cap_counts_blank_lines(spark, tmp_out):
    p = f"{tmp_out}/l.txt"
    _write(p, ["a", "", "b", "", "c", "d"])
    capped = lengths.cap_lines(read_lines(spark, p), 3).orderBy("line_no").collect()
    assert [(r.line_no, r.value) for r in capped] == [(0, "a"), (1, ""), (2, "b")]
    assert lengths.cap_lines(read_lines(spark, p), None).count() == 6


def test_line_cap_reads_leading_files_only(spark, tmp_out):
    sizes = [3, 0, 5, 1, 4, 7, 2]
    names = ["a", "b c", "d[1]", "d{2}", "e*", "f%20", "g"]
    for name, size in zip(names, sizes):
        with open(f"{tmp_out}/{name}.txt", "w") as f:
            f.writelines(f"{name}-{i}\n" if i % 2 else "\n" for i in range(size))
    want = [f"{name}-{i}" if i % 2 else "" for name, size in sorted(zip(names, sizes)) for i in range(size)]
    ends = dict(zip(range(1, 23), "aaa" + "ddddd" + "d" + "eeee" + "fffffff" + "gg"))
    for n in (1, 3, 4, 8, 9, 10, 13, 20, 21, 22, 30):
        lines = read_lines(spark, tmp_out, n)
        got = lengths.cap_lines(lines, n).orderBy("line_no").collect()
        assert [(r.line_no, r.value) for r in got] == list(enumerate(want))[:n], n
        for first_bytes in (1, 20):
            last = last_file_of(spark, tmp_out, n, first_bytes)
            assert last is None if n > 22 else os.path.basename(last).startswith(ends[n]), (n, last)
    back = read_conversations(spark, tmp_out, max_lines=22)
    assert back.filter("malformed").count() == sum(x != "" for x in want)
    few = read_lines(spark, tmp_out, 4)
    assert len(few.select("_file").distinct().collect()) == 2
    assert few.rdd.getNumPartitions() < spark.read.text(tmp_out).rdd.getNumPartitions()
    # files behind the last wave are not opened: one that cannot be read does no harm
    with open(f"{tmp_out}/z.txt.gz", "wb") as f:
        f.write(b"no gzip file" * 100)
    assert os.path.basename(last_file_of(spark, tmp_out, 13, 1)).startswith("e")


def test_numbered_lines_stay_where_they_are(spark, tmp_out):
    for name in "ab":
        _write(f"{tmp_out}/{name}.txt", [f"{name}{i}" for i in range(4)])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if no table were small
    try:
        lines = lengths.cap_lines(read_lines(spark, tmp_out))
        moved = [x for x in lines._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Join" in x and "broadcast" in x]
        assert len(moved) == 1 and "rightHint=(strategy=broadcast)" in moved[0]
        assert [(r.line_no, r.value) for r in lines.orderBy("line_no").collect()] == list(
            enumerate([f"{name}{i}" for name in "ab" for i in range(4)]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_line_cap_sorts_rows_before_texts_are_made(spark, tmp_out):
    from sftforge.plans import QUERIES, synth_queries
    keys = [5, 3, 900, 3, 17, 250, 1, 44, 44, 8] * 4
    spark.createDataFrame([(k,) for k in keys], "o_orderkey long").repartition(3).write.parquet(f"{tmp_out}/orders.parquet")
    made = synth_queries.synthesized(spark, tmp_out, in_order=True)
    plan = made.select("conversation")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.index("ArrowEvalPython") < plan.index("Exchange")
    want = [r.full_sequence for r in made.select("task_row", "full_sequence").orderBy("task_row").collect()]
    for name in ("line_cap", "line_cap_head"):
        got = QUERIES[name](spark, tmp_out).orderBy("line_no").collect()
        assert [(r.line_no, r.full_sequence) for r in got] == list(enumerate(want)), name


def test_compressed_files_of_few_lines_hold_all(spark, tmp_out):
    t = spark.createDataFrame([(i, 0, "user", f"{i} é") for i in range(10)], "conv_id long, turn long, role string, text string")
    folded = fold_turns(t).coalesce(1)
    write_conversations(folded, f"{tmp_out}/few", compression="gzip", file_lines=4)
    files = [x for x in os.listdir(f"{tmp_out}/few") if x.startswith("part-")]
    assert len(files) == 3 and all(x.endswith(".txt.gz") for x in files)
    back = read_conversations(spark, f"{tmp_out}/few")
    assert sorted(r.conversation[0].content for r in back.collect()) == [f"{i} é" for i in range(10)]


def test_round_trip_jsonl(spark, tmp_out):
    t = spark.createDataFrame([(1, 0, "user", "é ü 😀"), (1, 1, "assistant", 'x"y')],
                              "conv_id long, turn long, role string, text string")
    p = f"{tmp_out}/rt"
    write_conversations(fold_turns(t), p)
    raw = spark.read.text(p).first().value
    assert "é ü 😀" in raw  # non-ASCII unescaped
    back = read_conversations(spark, p).first()
    assert not back.malformed
    assert [(m.role, m.content, m.reasoning_content) for m in back.conversation] == [
        ("user", "é ü 😀", ""), ("assistant", 'x"y', "")]


def test_wrongly_typed_texts_are_rejected_with_a_reason(spark, tmp_out):
    lines = ['[{"role":"user","content":"a"},{"role":"assistant","content":5}]',
             '[{"role":"user","content":{"x":1}},{"role":"user","content":"a"},{"role":"assistant","content":"b"}]',
             '[{"role":"user","content":"a"},{"role":"assistant","content":"b","content":"c"}]',
             '[{"role":"user","content":"a"},{"role":"assistant","content":"b","reasoning_content":[1]}]',
             '[{"role":"user","content":null},{"role":"assistant","content":"b"}]', '[1]', '[{}] [{}]', '[{}],[{}]', "[null]"]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{tmp_out}/lines")
    back = read_conversations(spark, f"{tmp_out}/lines", numbered=True)
    got = {r.line_no: (r.reason, r.assistant, r.errors)
           for r in chat.reject_reason(chat.last_messages(back, "line_no")).collect()}
    assert got == {0: ("wrong_type", None, ["1: content is BIGINT"]), 1: (None, "b", ["0: content is OBJECT"]),
                   2: (None, "c", []), 3: ("wrong_type", "b", ["1: reasoning_content is ARRAY"]),
                   4: ("null_text", "b", []), **{i: ("malformed", None, None) for i in range(5, 9)}}
