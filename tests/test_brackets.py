"""B1-B6 golden rows and cross-form properties."""

import random

from pyspark.sql import functions as F

from sftforge.operators import brackets as B

GOLDEN = [(0, "([{<", ">}])", False), (1, "([]", ")", False), (2, "()[]", "", True), (3, "(]", "", False),
          (4, ")(", ")", False), (5, "<[<⟨{(<[((", "))]>)}>]>", False), (6, "a", "", False)]


def _df(spark, rows):
    return spark.createDataFrame([(i, s) for i, s, *_ in rows], "seq_id long, seq string")


def test_golden(spark):
    df = _df(spark, GOLDEN + [(7, "", "", None)])
    for method in ("fold", "relational"):
        comp = {r.seq_id: r.completion for r in B.complete_brackets(df, method=method).collect()}
        assert comp == {i: c for i, _, c, _ in GOLDEN} | {7: ""}, method
    v = {r.seq_id: r for r in B.check_brackets(df).collect()}
    assert {i: v[i].balanced for i in v} == {i: b for i, _, _, b in GOLDEN} | {7: True}
    assert v[3].fault == "mismatch" and v[4].fault == "ignored" and v[6].fault == "other"
    ev = {(r.seq_id, r.pos): r.event for r in B.bracket_events(df).collect()}
    assert [ev[(1, p)] for p in range(3)] == ["open", "open", "match"]
    assert [ev[(4, p)] for p in range(2)] == ["ignored", "open"]
    assert ev[(5, 3)] == "other"


def _random_rows(n, seed=7):
    rnd = random.Random(seed)
    alphabet = "()[]{}<>⟨"
    return [(i, "".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 40)))) for i in range(n)]


def test_cross_forms_and_properties(spark):
    rows = _random_rows(300)
    df = spark.createDataFrame(rows, "seq_id long, seq string")
    fold = {r.seq_id: tuple(r) for r in B.complete_brackets(df, method="fold").collect()}
    rel = {r.seq_id: tuple(r) for r in B.complete_brackets(df, method="relational").collect()}
    assert fold == rel
    texts = {(r.seq_id, r.pos): r.stack for r in B.stack_texts(df).collect()}
    links = {(r.seq_id, r.pos): r for r in B.stack_states(df).collect()}
    assert links.keys() == texts.keys()

    def followed(key):  # the whole stack, from the linked form
        out, r = "", links.get(key)
        while r is not None and r.depth:
            out, r = r.top + out, links.get((r.seq_id, r.parent_pos - 1))
        return out

    assert all(followed(k) == t and links[k].depth == len(t) for k, t in texts.items())
    last = {}
    for (sid, pos), st in sorted(texts.items()):
        last[sid] = st
    assert all(last[i][::-1] == fold[i][1] for i in fold)
    # the completed word of a fault-free prefix is balanced
    comp = spark.createDataFrame([(i, fold[i][2]) for i in fold], "seq_id long, seq string")
    chk = {r.seq_id: r for r in B.check_brackets(comp).collect()}
    faulty = {r.seq_id for r in B.bracket_events(df).collect() if r.event in ("mismatch", "ignored", "other")}
    clean = [i for i in fold if i not in faulty]
    assert clean
    assert all(chk[i].balanced for i in clean)


def test_partition_invariance(spark):
    rows = _random_rows(120, seed=3)
    base = spark.createDataFrame(rows, "seq_id long, seq string")
    outs = [sorted(tuple(r) for r in B.bracket_events(base.repartition(n)).collect()) for n in (1, 4, 17)]
    assert outs[0] == outs[1] == outs[2]


def test_completion_of_valid_word_is_empty(spark):
    rows = _random_rows(200, seed=11)
    df = spark.createDataFrame(rows, "seq_id long, seq string")
    completed = B.complete_brackets(df).select("seq_id", F.col("completed").alias("seq"))
    twice = {r.seq_id: r.completion for r in B.complete_brackets(completed).collect()}
    assert set(twice.values()) == {""}


def test_empty_and_null_sequences_keep_their_row(spark):
    df = spark.createDataFrame([("x", ""), ("y", None), ("z", "(")], "seq_id string, seq string")
    for method in ("fold", "relational"):
        comp = {r.seq_id: (r.completion, r.completed) for r in B.complete_brackets(df, method=method).collect()}
        assert comp == {"x": ("", ""), "y": (None, None), "z": (")", "()")}
    v = {r.seq_id: r for r in B.check_brackets(df, length=0, cut=0).collect()}
    assert (v["x"].balanced, v["x"].length, v["x"].length_ok, v["x"].cut_ok) == (True, 0, True, True)
    assert v["y"].balanced is None and v["z"].fault == "unclosed"
    assert {r.seq_id for r in B.stack_states(df).collect()} == {"z"}


def _all_forms(df):
    return [sorted(map(str, f.collect())) for f in (
        B.bracket_depth(df), B.bracket_events(df), B.stack_states(df), B.check_brackets(df, length=30, cut=12, min_depth=4),
        B.complete_brackets(df, method="relational"), B.explode_brackets(df))]


def test_segments_give_what_whole_sequences_give(spark, monkeypatch):
    rows = _random_rows(40, 5) + [(i, s + s) for i, s in _random_rows(20, 6)]  # ids repeat
    rows += [(1, "(["), (1, ")]"), (None, "(()"), (None, "(()"), (7, "((((((((((((" + "))))))))))))))"), (7, None), (7, "")]
    df = spark.createDataFrame(rows, "seq_id long, seq string").repartition(3)
    whole = _all_forms(df)
    for size in (3, 10):
        monkeypatch.setattr(B, "SEGMENT", size)
        assert _all_forms(df) == whole


def test_rows_that_share_an_id_stay_apart(spark):
    df = spark.createDataFrame([(1, "(["), (1, ")]"), (1, ")]")], "seq_id long, seq string")
    got = sorted((r.pos, r.ch, r.event, r.partner_pos) for r in B.bracket_events(df).collect())
    assert got == [(0, "(", "open", None), (0, ")", "ignored", None), (0, ")", "ignored", None),
                   (1, "[", "open", None), (1, "]", "ignored", None), (1, "]", "ignored", None)]
    assert sorted((r.length, r.max_depth, r.fault) for r in B.check_brackets(df).collect()) == [
        (2, 0, "ignored"), (2, 0, "ignored"), (2, 2, "unclosed")]


def test_a_long_sequence_is_walked_by_many_tasks(spark):
    n = 300_000
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    times = F.col("id").cast("int") + n  # no constant, which would be folded into the plan
    df = spark.range(1).select(F.lit(5).alias("seq_id"), F.concat(
        F.repeat(F.lit("(["), times), F.repeat(F.lit("])"), times), F.lit(">x")).alias("seq"))
    e = B.bracket_events(df).withColumn("task", F.spark_partition_id()).agg(
        F.count("*").alias("n"), F.count_if(F.col("event") == "match").alias("match"), F.max("depth").alias("depth"),
        F.count_if((F.col("event") == "open") & (F.col("partner_pos") != 4 * n - 1 - F.col("pos"))).alias("wrong"),
        F.countDistinct("task").alias("tasks")).first()
    assert (e.n, e.match, e.depth, e.wrong) == (4 * n + 2, 2 * n, 2 * n, 0) and e.tasks > 1
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_a_batch_is_walked_in_slices(spark, monkeypatch):
    import tracemalloc

    import pyarrow as pa
    df = spark.createDataFrame(_random_rows(60, 9) + [(3, ""), (4, None), (None, ")(")], "seq_id long, seq string").repartition(2)
    whole = _all_forms(df)
    monkeypatch.setattr(B, "SLICE", 70)
    assert _all_forms(df) == whole
    monkeypatch.undo()
    # the memory of a batch of 10 million characters does not follow their number
    batch = pa.array(["([{<>x)]" * 625] * 2000)
    tracemalloc.start()
    found = B._check_kernel(3)(batch)
    assert tracemalloc.get_traced_memory()[1] < 100 << 20
    tracemalloc.stop()
    assert set(map(str, found.to_pylist())) == {str({"max_depth": 628, "pos": 0, "fault": "unclosed", "dcut": 3})}
