"""Operators 5 and 6 against brute force."""

import random
from collections import Counter

import pytest
from helpers import hard_rows, prose, table, words

from sftforge.llm import op5_minhash_dedup as op5
from sftforge.llm import op6_substring_dedup as op6
from sftforge.llm.automaton import SuffixAutomaton
from sftforge.llm.components import components


def shingle_set(text):
    w = words(text)
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute_classes(rows):
    """(doc_id, text) -> least doc_id of the class."""
    texts = sorted({t for _, t in rows if words(t)})
    sets = {t: shingle_set(t) for t in texts}
    boss = {t: t for t in texts}

    def find(t):
        while boss[t] != t:
            t = boss[t]
        return t

    for i, a in enumerate(texts):
        for b in texts[:i]:
            both = len(sets[a] & sets[b])
            if both >= 0.8 * (len(sets[a]) + len(sets[b]) - both):
                boss[find(a)] = find(b)
    least = {}
    for i, t in rows:
        if words(t) and i is not None:
            least[find(t)] = min(i, least.get(find(t), i))
    return {(i, t): least.get(find(t)) if words(t) else i for i, t in rows}


def test_classes_match_brute_force(spark):
    rows = hard_rows()
    docs = table(spark, rows)
    want = brute_classes(rows)
    got = op5.classes(docs)
    digest = {op5_md5(t): t for _, t in rows}
    pairs = Counter()
    for r in got.collect():
        t = digest[r.node]
        pairs[(r.doc_id, t or "", r.class_id)] += 1
    assert pairs == Counter((i, t or "", want[i, t]) for i, t in rows)
    assert len({c for c in want.values()}) < len(rows)

    kept = op5.keep_one(docs)
    assert kept.columns == docs.columns
    ids = Counter((r.doc_id, r.text) for r in kept.collect())
    expected = Counter((i, t) for i, t in rows if not words(t))
    expected += Counter({(i, t) for i, t in rows if words(t) and want[i, t] == i})
    assert ids == expected


def op5_md5(text):
    import hashlib
    return hashlib.md5((text or "").encode()).hexdigest()


def test_groups_of_near_copies_meet_through_many_hubs(spark):
    import random
    rng = random.Random(5)
    base = [f"w{i}" for i in range(100)]
    rows = []
    for i in range(120):  # pairwise often below the threshold, linked by chains
        w = list(base)
        for _ in range(rng.randint(1, 3)):
            w[rng.randrange(100)] = f"e{i}"
        rows.append((i, " ".join(w)))
    want = brute_classes(rows)
    got = {r.doc_id: r.class_id for r in op5.classes(table(spark, rows)).collect()}
    assert got == {i: want[i, t] for i, t in rows}


def test_classes_without_or_with_the_same_least_doc_id_stay_apart(spark):
    import random
    rng = random.Random(9)
    from helpers import prose
    text = [prose(rng, 80) for _ in range(6)]
    near = text[0] + " more"
    rows = [(None, text[0]), (None, near), (None, text[1]), (None, ""), (None, None)]  # no id in the class
    rows += [(7, text[2]), (7, text[3]), (8, text[3]), (9, text[4]), (9, " "), (None, text[5]), (3, text[5])]
    docs = table(spark, rows)
    kept = Counter((r.doc_id, r.text) for r in op5.keep_one(docs).collect())
    first = min(text[0], near, key=op5_md5)
    assert kept == Counter([(None, first), (None, text[1]), (None, ""), (None, None), (7, text[2]), (7, text[3]),
                            (9, text[4]), (9, " "), (3, text[5])])
    got = {(r.doc_id, r.node): r.class_id for r in op5.classes(docs).collect()}
    named = {(i, t): got[i, op5_md5(t)] for i, t in rows}
    assert named[None, text[0]] == named[None, near] < 0 and named[None, text[1]] < 0
    assert named[7, text[3]] == named[8, text[3]] and {named[7, text[2]], named[7, text[3]]} > {7}
    assert named[9, " "] == 9 and named[9, text[4]] < 0 and named[None, text[5]] == 3 and named[None, ""] is None
    assert len({named[i, t] for i, t in rows if words(t)}) == 6


def repeated_passage_rows():
    """Pairs of set similarity 0.8 or more, one text or both with a passage repeated many times."""
    import random
    rng = random.Random(3)
    rows = []
    for k in range(12):
        shared = [f"s{k}x{rng.randrange(10 ** 6)}" for _ in range(220)]
        own = [[f"o{k}s{side}x{i}" for i in range(15)] for side in range(2)]
        times = (20, 1 if k % 2 else 20)
        rows += [(2 * k + side, " ".join(shared + own[side] * times[side])) for side in range(2)]
    return rows


def test_repeated_passages_do_not_hide_links(spark):
    rows = repeated_passage_rows()
    want = brute_classes(rows)
    assert len(set(want.values())) == 12
    got = {r.doc_id: r.class_id for r in op5.classes(table(spark, rows)).collect()}
    assert got == {i: want[i, t] for i, t in rows}


def test_registers_estimate_the_similarity_of_sets():
    import pyarrow as pa
    rows = repeated_passage_rows()
    codes = [r["code"] for r in op5._sketch_of(pa.array([t for _, t in rows])).to_pylist()]
    for k in range(0, len(rows), 2):
        x, y = shingle_set(rows[k][1]), shingle_set(rows[k + 1][1])
        assert len(x & y) >= 0.8 * len(x | y)
        bits = [[z >> 4 * j & 15 for z in codes[k + side] for j in range(16)] for side in range(2)]
        assert sum(a == b for a, b in zip(*bits)) - 3 >= op5.min_agree(op5.THRESHOLD)


@pytest.mark.parametrize("threshold", [0.3, 0.5, 0.8, 0.9])
def test_cuts_before_the_exact_sets_keep_their_promise(threshold):
    from math import comb
    rows, least = op5.band_rows(threshold), op5.min_agree(threshold)
    assert 1 - (1 - threshold ** rows) ** (125 // rows) >= op5.RECALL
    p = threshold + (1 - threshold) / 16
    assert sum(comb(125, j) * p ** j * (1 - p) ** (125 - j) for j in range(least)) <= 1 - op5.RECALL


def test_empty_table(spark):
    assert op5.classes(table(spark, [])).count() == 0
    assert op6.remove_repeats(table(spark, [])).count() == 0


def test_prob_minhash_estimates_probability_jaccard():
    import numpy as np
    rng = np.random.default_rng(1)
    ids = rng.integers(1, 1 << 62, 60, dtype=np.uint64)
    a, b = rng.uniform(0.2, 3, 60), rng.uniform(0.2, 3, 60)
    a[:15], b[45:] = 0, 0
    exact = sum(1 / sum(max(a[j] / a[i], b[j] / b[i]) for j in range(60)) for i in range(60) if a[i] and b[i])
    m = 4000
    doc = np.zeros(45, np.int64)
    x = op5.prob_minhash(ids[a > 0], doc, a[a > 0], 1, m)
    y = op5.prob_minhash(ids[b > 0], doc, b[b > 0], 1, m)
    assert abs((x == y).mean() - exact) < 4 * (exact * (1 - exact) / m) ** 0.5


def test_components(spark):
    edges = [("b", "a"), ("b", "c"), ("d", "c"), ("x", "y")] + [(f"n{i:03}", f"n{i + 1:03}") for i in range(60)]
    e = spark.createDataFrame(edges, "a string, b string")
    got = {r.node: r.comp for r in components(e).collect()}
    assert {got[x] for x in "abcd"} == {"a"} and got["y"] == "x" and {got[f"n{i:03}"] for i in range(61)} == {"n000"}
    more = components(spark.createDataFrame([("y", "d")], "a string, b string"), components(e))
    got = {r.node: r.comp for r in more.collect()}
    assert {got[x] for x in "abcdxy"} == {"a"} and got["n060"] == "n000"


def brute_kept(rows):
    starts = Counter()
    for _, t in rows:
        w = words(t)
        for i in range(len(w) - 34):
            starts[tuple(w[i:i + 35])] += 1
    out = []
    for i, t in rows:
        w = words(t)
        gone = {j for k in range(len(w) - 34) if starts[tuple(w[k:k + 35])] > 1 for j in range(k, k + 35)}
        out.append((i, len(w), len(gone), b" ".join(x for j, x in enumerate(w) if j not in gone).decode()))
    return sorted(out, key=str)


@pytest.mark.parametrize("gathered", [1000, 1])
def test_removed_words_match_brute_force(spark, monkeypatch, gathered):
    """Also with every anchor beyond the size that a shard gathers."""
    monkeypatch.setattr(op6, "SHARD_PASSAGES", gathered)
    rows = hard_rows()
    got = sorted((tuple(r) for r in op6.remove_repeats(table(spark, rows)).collect()), key=str)
    assert got == brute_kept(rows)
    assert sum(r[2] for r in got) > 500


def test_pipeline_form_keeps_rows_and_untouched_texts(spark):
    rows = hard_rows()
    docs = table(spark, rows)
    out = op6.keep_unrepeated(docs)
    assert out.columns == docs.columns
    kept = {(i, n): (gone, text) for i, n, gone, text in brute_kept(rows)}
    want = Counter()
    for i, t in rows:
        gone, text = kept[i, len(words(t))]
        want[i, text if gone else t] += 1
    assert Counter((r.doc_id, r.text) for r in out.collect()) == want
    assert all(r.n_chars == len(r.text) for r in out.collect() if r.text is not None)


def test_reference_is_streamed_past_broadcast_automata(spark):
    rows = hard_rows()
    reference = spark.createDataFrame([(" ".join(rows[0][1].split()[5:50]),), (None,)], "text string")
    got = {r.doc_id: r for r in op6.remove_reference_spans(table(spark, rows), reference).collect()}
    assert got[0].n_removed == 45 and got[1].n_removed == 0 and got[41].n_words == 0


def test_automaton_counts_places():
    a = SuffixAutomaton()
    a.add("abcabcd", range(7))
    a.add("zabcy", range(100, 105))
    a.add("cabcd", range(2, 7))  # places 2 to 6 again
    a.close()
    assert list(a.repeated_windows("xabcdx", 3)) == [3]  # abc at three places, bcd at one
    assert [n for _, n in a.matches("zabq")] == [1, 2, 3, 0]


def edited_copies(seed, n, length=60):
    """Copies of one text with edits around the threshold; some share edits, some are longer."""
    rng = random.Random(seed)
    base = prose(rng, length, 3000).split()
    rows = []
    for i in range(n):
        w = list(base)
        for at in rng.sample(range(length), rng.randint(0, 6)):
            w[at] = f"edit{at}" if rng.random() < 0.4 else f"own{i}x{at}"
        if rng.random() < 0.3:
            w += prose(random.Random(seed + i % 5), rng.randint(1, 20), 3000).split()
        rows.append((i, " ".join(w)))
    return rows


@pytest.mark.parametrize("small", [0, op5.SMALL])
def test_edited_copies_around_the_threshold(spark, monkeypatch, small):
    monkeypatch.setattr(op5, "SMALL", small)
    monkeypatch.setattr(op5, "HUB_ROUNDS", 1)
    rows = hard_rows() + [(1000 + i, t) for i, t in edited_copies(1, 90)] + [(2000 + i, t) for i, t in edited_copies(2, 60, 45)]
    docs = table(spark, rows)
    want = brute_classes(rows)
    digest = {op5_md5(t): t for _, t in rows}
    got = Counter((r.doc_id, digest[r.node] or "", r.class_id) for r in op5.classes(docs).collect())
    assert got == Counter((i, t or "", want[i, t]) for i, t in rows)
    assert len({c for (i, _), c in want.items() if i is not None and (i < 30 or i >= 1000)}) > 20


def test_pairs_follow_the_links_not_the_square(spark, monkeypatch):
    counts, verified = [], op5.verified

    def counted(pairs, sets, threshold):
        pairs = pairs.persist()
        counts[-1] += pairs.count()
        return verified(pairs, sets, threshold)

    monkeypatch.setattr(op5, "verified", counted)
    for n in (100, 200, 400):
        counts.append(0)
        op5.classes(table(spark, edited_copies(3, n, 120))).count()
    assert counts[2] < 3 * counts[1] and counts[2] < 400 * 40
