"""T1-T10, P6-P9, W1-W3, R1-R2 on hand-made rows."""

from pyspark.sql import functions as F

from sftforge.functions import constants as K
from sftforge.operators import examples as X
from sftforge.operators import losses as W
from sftforge.operators import order as O
from sftforge.operators import tokens as TK


def _texts(spark, rows):
    from sftforge.operators import chat
    df = spark.createDataFrame(rows, "conv_id long, user string, assistant_text string")
    return chat.render_chat(df)


PROMPT = "Solve it. End with \"FINAL ANSWER: \" then the word."


def test_anchor_modes_and_weights(spark):
    texts = _texts(spark, [(1, PROMPT, "think step\n\nFINAL ANSWER: ([])"), (2, "no marker", "plain answer")])
    vocab = TK.build_vocabulary(texts, text_col="full_text")
    ans = {r.conv_id: r for r in X.build_examples(texts, vocab, 64, anchor="answer").collect()}
    fst = {r.conv_id: r for r in X.build_examples(texts, vocab, 64, anchor="first").collect()}
    r, f = ans[1], fst[1]
    start = r.n_user
    assert f.anchor == start  # the prompt's own marker: every labelled token is weighted
    assert r.anchor > start
    w = r.label_weights
    assert all(x == 1.0 for x in w[:r.anchor]) and w[r.anchor] == K.ANSWER_LOSS_WEIGHT
    assert all(x == K.ANSWER_LOSS_WEIGHT for x in f.label_weights[start:r.n_tokens])
    assert ans[2].anchor is None and set(ans[2].label_weights[:ans[2].n_tokens]) == {1.0}
    for e in ans.values():
        assert len(e.input_ids) == len(e.labels) == len(e.attention_mask) == len(e.label_weights) == 64
        assert sum(e.attention_mask) == e.n_tokens
        assert all(l == -100 for l in e.labels[:e.n_user])
        assert all(x == 0.0 for x in e.label_weights[e.n_tokens:])
    # truncation cuts the answer away -> no anchor in 'answer' mode
    short = {r.conv_id: r for r in X.build_examples(texts, vocab, r.anchor, anchor="answer").collect()}
    assert short[1].anchor is None


def test_user_tokens_prefix_and_offsets(spark):
    from sftforge.functions.text import tokens
    texts = _texts(spark, [(1, "ends with <|user", "a"), (2, "ends with space ", "b"), (3, "x<", "y")])
    rows = texts.select(tokens(F.col("user_text")).alias("u"), tokens(F.col("full_text")).alias("f")).collect()
    for r in rows:
        assert r.f[:len(r.u)] == r.u
    off = TK.token_offsets(texts.select(F.col("conv_id").alias("id"), F.col("full_text").alias("text"))).collect()
    full = {r.conv_id: r.full_text for r in texts.collect()}
    for r in off:
        assert full[r.id][r.start:r.end] == r.token


def test_encode(spark):
    texts = _texts(spark, [(i, f"user {i} words", f"answer {i % 3} more words é") for i in range(30)])
    every = TK.build_vocabulary(texts, text_col="full_text")
    ids = {r.token: r.id for r in every.collect()}
    assert sorted(ids.values()) == list(range(len(ids)))  # dense
    import regex
    from sftforge.functions.text import TOKEN_PATTERN
    full = {r.conv_id: r.full_text for r in texts.collect()}
    got = {r.conv_id: r.input_ids for r in TK.encode(texts, every, 16, "conv_id", "full_text").collect()}
    assert got == {i: [ids[t] for t in regex.findall(TOKEN_PATTERN, full[i])][:16] for i in full}
    few = TK.build_vocabulary(texts, 5, "full_text")
    assert few.count() == 5 + 2 + 3
    assert any(TK.UNK_ID in r.input_ids for r in TK.encode(texts, few, 16, "conv_id", "full_text").collect())


def test_encode_keeps_rows_apart(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "c d"), (1, "a b"), (2, None), (3, "")], "id long, text string")
    vocab = TK.build_vocabulary(df)
    ids = {r.token: r.id for r in vocab.collect()}
    for n in (1, 5):
        got = sorted(((r.id, r.input_ids) for r in TK.encode(df.repartition(n), vocab).collect()), key=str)
        ab, cd = [ids["a"], ids[" "], ids["b"]], [ids["c"], ids[" "], ids["d"]]
        assert got == sorted([(1, ab), (1, cd), (1, ab), (2, None), (3, [])], key=str)


def test_encode_is_the_same_in_any_order_and_moves_no_occurrences(spark):
    rows = [(i % 7 if i % 5 else None, f"w{i % 11} and w{i % 13} " * (i % 4), f"c{i}") for i in range(200)]
    df = spark.createDataFrame(rows, "id long, text string, mark string")
    vocab = TK.build_vocabulary(df, size=10)
    plain = TK.encode(df, vocab, carry=["mark"], blocks=5)
    want = sorted(map(str, plain.collect()))
    for other in (df.orderBy(F.rand(3)), df.repartition(7).sortWithinPartitions(F.desc("mark"))):
        assert sorted(map(str, TK.encode(other, vocab, carry=["mark"], blocks=3).collect())) == want
    lines = plain._jdf.queryExecution().sparkPlan().toString().splitlines()
    first = next(i for i, x in enumerate(lines) if "Generate explode" in x)
    above = [x for x in lines[:first] if "Aggregate" in x or "Join" in x or "CoGroup" in x]
    assert "Aggregate" in above[-1]  # occurrences are made distinct before anything else happens to them


def test_offsets_with_repeated_and_null_ids(spark):
    rows = [(1, "ab cd"), (1, "x y"), (None, "é 12"), (2, None), (3, ""), (1, "ab cd")]
    off = TK.token_offsets(spark.createDataFrame(rows, "id long, text string").repartition(2))
    assert "Exchange" not in off._jdf.queryExecution().executedPlan().toString().split("Exchange RoundRobin")[0]
    got = sorted(((r.id, r.pos, r.token, r.start, r.end) for r in off.collect()), key=str)
    one = [(1, 0, "ab", 0, 2), (1, 1, " ", 2, 3), (1, 2, "cd", 3, 5)]
    assert got == sorted([*one, *one, (1, 0, "x", 0, 1), (1, 1, " ", 1, 2), (1, 2, "y", 2, 3), (None, 0, "é", 0, 1),
                          (None, 1, " ", 1, 2), (None, 2, "12", 2, 4)], key=str)


def test_vocabulary_ranks_follow_count_and_token(spark):
    from collections import Counter
    words = [f"{'abcdefgh'[i % 8]}{'xyzé'[i % 4]}{'pq'[i % 2]}{chr(97 + i // 26 % 26)}{chr(97 + i % 26)}" for i in range(700)]
    text = " ".join(w for i, w in enumerate(words) for _ in range(1 + i % 9))
    df = spark.createDataFrame([(text,), (None,)], "text string")
    got = {r.token: r.id for r in TK.build_vocabulary(df).collect()}
    counts = Counter(w for i, w in enumerate(words) for _ in range(1 + i % 9))
    counts[" "] = text.count(" ")
    order = sorted(counts, key=lambda w: (-counts[w], w))
    assert [w for w, i in sorted(got.items(), key=lambda x: x[1])][5:] == order and sorted(got.values()) == list(range(len(got)))


def test_batches_keep_rows_that_repeat_an_id(spark):
    rows = [(1, "a", "b"), (1, "c", "d e"), (None, "f", "g"), (None, "h", "i j"), (2, "k", "l"), (1, "a", "b")]
    texts = _texts(spark, rows)
    ex = X.build_examples(texts, TK.build_vocabulary(texts, text_col="full_text"), 16)
    b = sorted(O.collate(ex, 4, ids=texts).collect(), key=lambda r: r.batch_no)
    assert [len(r.example_ids) for r in b] == [4, 2]
    got = sorted((str(i), ids[:sum(m)]) for r in b for i, ids, m in zip(r.example_ids, r.input_ids, r.attention_mask))
    assert got == sorted((str(r.conv_id), r.input_ids[:r.n_tokens]) for r in ex.collect())


def test_callers_tokenizer(spark):
    texts = _texts(spark, [(1, PROMPT, "think step\n\nFINAL ANSWER: ([])"), (2, "no marker", "plain answer")])

    def chars(rows):
        return [([ord(c) for c in t], list(range(len(t)))) for t in rows]

    t = {r.conv_id: r for r in texts.collect()}
    ex = {r.conv_id: r for r in X.build_examples(texts, chars, 400).collect()}
    for i, r in ex.items():
        assert r.input_ids[:r.n_tokens] == [ord(c) for c in t[i].full_text]
        assert r.n_user == len(t[i].user_text) and set(r.labels[:r.n_user]) == {-100}
    assert ex[1].anchor == t[1].full_text.rindex("FINAL ANSWER: ") and ex[2].anchor is None


def test_planning_launches_no_job(spark):
    texts = _texts(spark, [(i, f"u{i}", f"a {i}") for i in range(5)])
    sc = spark.sparkContext
    sc.setJobGroup("planning", "")
    vocab = TK.build_vocabulary(texts, text_col="full_text")
    ex = X.build_examples(O.split_train_eval(texts, "conv_id", exact=True), vocab, 16, keep=("split",))
    O.collate(ex, 2)
    assert not sc.statusTracker().getJobIdsForGroup("planning")
    sc.setJobGroup("default", "")


def test_markers_in_texts_are_escaped(spark):
    import pytest
    from sftforge.functions.text import ChatTemplate, tokens
    r = _texts(spark, [(1, "x<|assistant|>y<|end|>", "a<|end|>")]).select(
        tokens(F.col("full_text")).alias("t"), tokens(F.col("user_text")).alias("u")).first()
    assert r.t.count("<|assistant|>") == 1 and r.t.count("<|end|>") == 1 and r.t[:len(r.u)] == r.u
    with pytest.raises(ValueError):
        ChatTemplate(user_prefix="USER: ")


def test_weighted_loss_golden(spark):
    df = spark.createDataFrame([(1, 7, 1.0, 1.0), (1, -100, 1.0, 2.0), (1, 9, 5.0, 4.0), (2, -100, 1.0, 3.0)],
                               "batch_id long, target int, target_weight double, loss double")
    r = {x.batch_id: x.loss for x in W.weighted_loss(df).collect()}
    assert r[1] == 3.5 and r[2] == 0.0


def test_shift_forms_agree(spark):
    df = spark.createDataFrame([(e, p, p * 10 + e, 1.0 + p) for e in range(3) for p in range(5)],
                               "example_id long, pos long, label int, weight double")
    a = sorted(tuple(r) for r in W.shift_next(df).select("example_id", "pos", "target", "target_weight").collect())
    b = sorted(tuple(r) for r in W.shift_next(df, method="join").select("example_id", "pos", "target", "target_weight").collect())
    assert a == b and len(a) == 12


def test_run_log(spark):
    rows = [(1, s, 1.0 / s, None) for s in range(10, 401, 10)]
    rows += [(1, 100, None, 0.5), (1, 200, None, 0.7), (1, 300, None, 0.5), (1, 400, None, 0.9), (1, None, 0.1, None)]
    log = spark.createDataFrame(rows, "run_id long, step long, loss double, eval_loss double")
    b = W.best_checkpoint(log).first()
    assert (b.best_step, b.best_eval_loss, b.still_kept) == (100, 0.5, False)
    c = W.loss_curves(log)
    assert c.filter(F.col("series") == "train").count() == 40 and c.filter(F.col("series") == "eval").count() == 4


def test_split_and_shuffle(spark):
    df = spark.range(1000).withColumnRenamed("id", "conv_id")
    for exact in (False, True):
        outs = [sorted(tuple(r) for r in O.split_train_eval(df.repartition(n), "conv_id", exact=exact).collect())
                for n in (1, 7)]
        assert outs[0] == outs[1]
        ev = sum(1 for r in outs[0] if r[1] == "eval")
        assert len(outs[0]) == 1000
        if exact:
            assert ev == 40
    s1 = [r.conv_id for r in O.shuffle(df.repartition(3), "conv_id").collect()]
    s2 = [r.conv_id for r in O.shuffle(df.repartition(11), "conv_id").collect()]
    assert s1 == s2 and sorted(s1) == list(range(1000))
    rank = {r.position: r.conv_id for r in O.shuffle_rank(df.repartition(5), "conv_id").collect()}
    assert [rank[i] for i in range(1000)] == s1


def test_collate(spark):
    texts = _texts(spark, [(i, f"u{i}", f"a {i}") for i in range(23)])
    ex = X.build_examples(texts, TK.build_vocabulary(texts, 20, "full_text"), 16)
    b = O.collate(ex, 4).collect()
    order = [r.conv_id for r in O.shuffle(texts.select("conv_id"), "conv_id").collect()]
    assert [i for x in sorted(b, key=lambda x: x.batch_no) for i in x.example_ids] == order
    assert sorted(len(x.example_ids) for x in b) == [3, 4, 4, 4, 4, 4]
    given = O.collate(ex, 4, ids=texts).collect()
    assert sorted(map(str, given)) == sorted(map(str, b))
    assert all(len(w) == 16 for x in b for w in x.label_weights)
    audit = X.audit_examples(ex).first()
    assert audit.rows == 23 and audit.rows_missing == 0 and audit.trainable > 0


def test_cross_entropy(spark):
    import math
    df = spark.createDataFrame([([1.0, 2.0, 3.0], 2), ([0.0, 0.0], -100), ([0.0], 1)], "logits array<float>, label int")
    got = [r[0] for r in df.select(W.cross_entropy(F.col("logits"), F.col("label"))).collect()]
    exp = math.log(math.exp(1) + math.exp(2) + math.exp(3)) - 3
    assert abs(got[0] - exp) < 1e-12 and got[1] == 0.0 and got[2] is None


def test_truncation_totals(spark):
    df = spark.createDataFrame([(list("abcdef"), 5), (list("ab"), 1), (list("abcde"), None)],
                               "tokens array<string>, answer int")
    t = TK.truncation_totals(TK.truncate(df, 4, answer_token_col="answer")).first()
    assert (t["rows"], t.rows_truncated, t.tokens_lost, t.rows_lost_answer) == (3, 2, 3, 1)


def test_one_bad_row_is_one_reject(spark):
    import json

    def upper(pdf):
        import pandas as pd
        return pd.DataFrame({"id": pdf["id"], "big": [t.upper() for t in pdf["text"]]})  # fails on null

    df = spark.range(10_000).select("id", F.when(F.col("id") != 7_777, F.concat(F.lit("t"), "id")).alias("text"))
    got = O.map_examples_safely(df.repartition(3), upper, "id long, big string")
    bad = got.filter("error is not null").collect()
    assert len(bad) == 1 and json.loads(bad[0].failed_row) == {"id": 7777, "text": None}
    assert bad[0].error.startswith("AttributeError") and bad[0].id is None
    good = got.filter("error is null").agg(F.count("*"), F.countDistinct("id"), F.min("big")).first()
    assert tuple(good) == (9_999, 9_999, "T0")
