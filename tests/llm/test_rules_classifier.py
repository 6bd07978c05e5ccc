"""Operators 7 and 4."""

import random
import zlib
from collections import Counter

import numpy as np
from helpers import hard_rows, prose, table, words

from sftforge.llm import op4_quality_classifier as op4
from sftforge.llm import op7_quality_rules as op7


def plain_statistics(text):
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if words(x)]
    seen = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    covered = {j for i in range(len(w) - 2) if seen[tuple(w[i:i + 3])] > 1 for j in range(i, i + 3)}
    return (len(w), sum(len(x.decode()) for x in w), sum(c in "#*$%&|<>" for c in text),
            len(lines) - len(set(lines)), len(covered))


def test_statistics_and_verdicts(spark):
    rows = hard_rows() + [(60, "same line here\n" * 30 + "a|b"), (61, "ABC DEF " * 40 + " ".join(map(str, range(60))))]
    got = sorted((tuple(r) for r in op7.measure_and_judge(table(spark, rows)).collect()), key=str)
    want = []
    for i, text in rows:
        s = plain_statistics(text)
        failed = s[0] < 50 or 100 * s[4] > 50 * s[0]
        t = op7.TextView(text)
        want.append((i, *s, failed, not failed and not any(r.rejects(t) for r in op7.RULES)))
    assert got == sorted(want, key=str)


def test_cascade_order_never_changes_a_verdict(spark):
    docs = table(spark, hard_rows())
    kept = []
    for order in (op7.RULES, op7.RULES[::-1]):
        r = docs.withColumn("by", op7.verdict(order)(docs["text"])).collect()
        kept.append(sorted(str((x.doc_id, x.text)) for x in r if x.by is None))
    out = op7.keep_good(docs, op7.RULES)
    assert out.columns == docs.columns
    assert kept[0] == kept[1] == sorted(str((x.doc_id, x.text)) for x in out.collect())
    assert kept[0] and len(kept[0]) < docs.count()
    by = op7.apply_rules(docs).select("rejected_by").distinct().collect()
    assert {r[0] for r in by} <= {x.name for x in op7.RULES} | {None}


def test_corpus_rules_keep_short_texts(spark):
    long = prose(random.Random(1), 90, 5000)
    rows = [(1, "A short clean line."), (2, None), (3, " \n\t"), (4, long), (5, "a b c a b c"), (6, "a###"), (7, long),
            (None, "One more.")]
    kept = sorted((x.doc_id or 0) for x in op7.keep_good(table(spark, rows)).collect())
    assert kept == [0, 1, 4, 7]


def test_each_shape_rule():
    good = "plain words in a line\nand then another one\nthe last of three"
    bad = {"symbols": "a # b", "exclaims": "hey! you!", "braces": "if (x) { y }", "garbled": "ab\ufffdc \x01 words",
           "capitals": "ALL OF it", "dup_lines": "x y\nx y\nx y\nx y\nz", "dup_line_chars": "a\nb\nlong line of it\n" * 3,
           "bullets": "- one\n* two\n\u2022 three", "ellipses": "and so on...\nmore", "word_length": "a" * 21,
           "lettered_words": "1 2 3 four"}
    rules = {x.name: x for x in op7.SHAPE_RULES}
    assert set(rules) == set(bad)
    for name, text in bad.items():
        assert rules[name].rejects(op7.TextView(text)), name
        assert not rules[name].rejects(op7.TextView(good)), name


def test_sample_is_of_the_whole_table(spark):
    docs = table(spark, [(i, "word " * 60 if i < 3000 else "too short") for i in range(4000)] + [(4000, None)])
    measured = op7.estimate(docs, op7.RULES[:1])
    assert 0.1 < measured["min_words"][1] < 0.45  # the first 200 rows would give 0
    assert op7.estimate(table(spark, []))["min_words"][1] == 0


def test_order_is_by_rejections_per_second():
    order = op7.cascade_order(op7.RULES[:3], {"min_words": (1.0, 0.1), "repeat_words": (0.1, 0.2), "symbols": (1.0, 0.9)})
    assert [x.name for x in order] == ["repeat_words", "symbols", "min_words"]


def quality_rows(n, seed=3):
    """(doc_id, text, label): prose against three kinds of junk."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        text, good = prose(rng, rng.randint(60, 120), 5000), i % 4 != 0
        if not good:
            text = [text.upper().replace(" ", "!! "), text.replace(" ", "### "), "spam words " * 50][i // 4 % 3]
        out.append((i, text, int(good)))
    return out


def test_classifier_on_held_out_rows(spark):
    rows = quality_rows(600)
    # labels of held-out rows are wrong on purpose: they must not be learned from
    held = lambda i: zlib.crc32(str(i).encode()) % 3 == 1
    labels = spark.createDataFrame([(i, 1 - y if held(i) else y) for i, _, y in rows] + [(0, None), (None, 1), (5, 1)],
                                   "doc_id long, quality int")
    docs = table(spark, [(i, t) for i, t, _ in rows] + [(9000, None), (9001, ""), (None, "x y"), (0, rows[0][1])])
    out = op4.classify(docs, labels).collect()
    assert len(out) == len(rows) + 4 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out)
    truth = {i: y for i, _, y in rows}
    tested = [r for r in out if r.held_out and r.doc_id in truth]
    assert len(tested) > 100 and all(held(r.doc_id) for r in tested)
    assert np.mean([r.predicted == truth[r.doc_id] for r in tested]) > 0.97
    kept = op4.keep_good(docs, labels)
    assert kept.columns == docs.columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids == Counter(r.doc_id for r in out if r.predicted)


def test_classifier_without_anything_to_learn(spark):
    docs = table(spark, hard_rows()[:5])
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in op4.classify(docs, none).collect()} == {0.5}
    ones = spark.createDataFrame([(i, 1) for i in range(5)], "doc_id long, quality int")
    assert {r.predicted for r in op4.classify(docs, ones).collect()} == {1}
    assert op4.classify(table(spark, []), ones).count() == 0
    assert op7.measure_and_judge(table(spark, [])).count() == 0


def test_normal_equations_approximate_a_kernel():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(40, 15))
    w, b = rng.normal(size=(15, 4096)) / np.sqrt(15), rng.uniform(0, 2 * np.pi, 4096)
    m = op4.Model(np.zeros(15), np.ones(15), w, b, None, None, None)
    z = op4.fourier(x, m)[:, :-1]
    kernel = np.exp(-((x[:, None] - x[None]) ** 2).sum(-1) / 30)
    assert abs(z @ z.T - kernel).max() < 0.12
    assert list(op4._isotonic(np.array([0.0, 1, 0, 1]), np.ones(4))) == [0, 0.5, 0.5, 1]
