"""Operators 2, 3 and 8, and the pipeline."""

import base64
import hashlib
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from helpers import hard_rows, table, words
from pyspark.sql import functions as F

import corpus_pipeline
from sftforge.llm import op2_hilbert_ann as op2
from sftforge.llm import op3_warc as op3
from sftforge.llm import op7_quality_rules as op7
from sftforge.llm import op8_sharding as op8
from sftforge.llm import op9_best_fit_packing as op9

VECTORS = "vec_id long, embedding array<float>, label int, point string, rank string, score string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, None, "x", "x", "x") for i, v in rows], VECTORS).repartition(3)


def brute_nearest(rows, k=20):
    good = {}
    for i, v in rows:
        if i is not None and v is not None and len(v) == 8 and None not in v and np.isfinite(v).all() and any(v):
            good[i] = np.array(v, np.float32).astype(float)
    out = {}
    for q in (i for i in good if i % 20 == 0):
        scored = sorted((-float((good[q] * good[i]).sum()), i) for i in good if i != q)
        out[q] = [i for _, i in scored[:k]]
    return out


def test_small_tables_are_searched_in_full(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(120)]
    rows += [(200 + i, rows[20][1]) for i in range(60)]  # ties: one vector many times
    rows += [(300, None), (320, [0.0] * 8), (340, [1.0, None] + [0.0] * 6), (360, [float("nan")] * 8),
             (380, [float("inf")] + [0.0] * 7), (400, [1.0, 2.0]), (None, rows[0][1]), rows[40], rows[40]]
    got: dict = {}
    for r in op2.search(vectors(spark, rows), lambda x: x % 20 == 0).collect():
        got.setdefault(r.query_id, {})[r.rank] = r.vec_id
    want = brute_nearest(rows)
    assert {q: [x[k] for k in sorted(x)] for q, x in got.items()} == want
    assert all(sorted(x) == list(range(1, len(x) + 1)) for x in got.values())
    few = op2.search(vectors(spark, rows[:3]), lambda x: x % 20 == 0).collect()
    assert [r.vec_id for r in sorted(few, key=lambda r: r.rank)] == brute_nearest(rows[:3])[0]
    assert op2.search(vectors(spark, []), lambda x: x % 20 == 0).count() == 0


def test_ties_go_to_the_smaller_id_and_an_id_is_asked_once(spark):
    rng = np.random.default_rng(6)
    bits = [[float(b) for b in f"{i:08b}"] for i in range(1, 256)]
    rows = [(i, v) for i, v in zip(rng.permutation(255).tolist(), bits)]  # scores are whole numbers: many ties
    got: dict = {}
    for r in op2.search(vectors(spark, rows), lambda x: x % 20 == 0).collect():
        got.setdefault(r.query_id, {})[r.rank] = r.vec_id
    want = brute_nearest(rows)
    assert {q: [x[k] for k in sorted(x)] for q, x in got.items()} == want
    again = rows + [(20, [9.0] * 8), (20, [0.5] * 8)]
    found = [(r.query_id, r.rank) for r in op2.search(vectors(spark, again), lambda x: x % 20 == 0).collect()]
    assert len(found) == len(set(found)) == 13 * 20
    x, y, low = np.array([[1.0, 1.0]]), np.array([[1.0, 0.0], [0.0, 1.0], [3.0, 0.0], [0.5, 0.5]]), np.array([9, 4, 7, 5])
    assert [a.tolist() for a in op2.best_of(x, y, low, 3)] == [[0, 0, 0], [2, 1, 3], [3.0, 1.0, 1.0]]


def test_windows_find_most_neighbours(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(40, 8)) * 2
    rows = [(i, (centres[i % 40] + rng.normal(size=8) * 0.3).tolist()) for i in range(6000)]
    got: dict = {}
    for r in op2.search(vectors(spark, rows), lambda x: x % 200 == 0).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    want = brute_nearest([x for x in rows])
    recall = np.mean([len(got[q] & set(want[q])) / 20 for q in got])
    assert len(got) == 30 and recall > 0.9


def test_hilbert_curve_steps_to_neighbouring_cells():
    for dims, bits in ((2, 4), (3, 3)):
        side = 1 << bits
        cells = np.stack(np.meshgrid(*[np.arange(side)] * dims, indexing="ij"), -1).reshape(-1, dims)
        keys = op2.hilbert_keys(cells, bits)
        assert sorted(keys) == list(range(side ** dims))
        path = cells[np.argsort(keys)]
        assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def pages(spark, rows):
    data = [(i, u, h, "x", "x", "x") for i, u, h in rows]
    return spark.createDataFrame(data, "page_id long, url string, html string, original string, value string, "
                                       "record_type string").repartition(3)


PAGES = [(5, "http://a/5", "<p>same</p>"), (3, "http://a/3", "<p>same</p>"), (9, None, "<p>same</p>"),
         (1, "http://a/ \r\nx: y", "WARC/1.1\r\n\r\nContent-Length: 3\r\n\r\n\r\n\r\né日本"), (2, "u", None), (4, "u", ""),
         (6, "u", "x" * 100_000), (None, "u", "<p>same</p>"), (7, "u", "\r\n\r\n"), (8, "u", "once"), (8, "u", "once")]


def test_archives_round_trip(spark, tmp_path):
    got = Counter(tuple(r) for r in op3.archive_round_trip(pages(spark, PAGES)).collect())
    want = Counter()
    for i, _, h in PAGES:
        data = (h or "").encode()
        first = min(j for j, _, x in PAGES if (x or "") == (h or "") and j is not None)
        revisit = i is not None and i != first
        want[i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
             "revisit" if revisit else "response", first if revisit else None] += 1
    assert got == want
    path = str(tmp_path / "archives")
    op3.write_archives(pages(spark, PAGES), path, min_bytes=5)
    records = op3.read_archives(spark, path).collect()
    assert {bytes(r.payload).decode() for r in records if r.record_type == "response"} == {h or "" for _, _, h in PAGES}
    assert sum(r.record_type == "revisit" for r in records) == 2  # short payloads are all responses
    assert op3.archive_round_trip(pages(spark, [])).count() == 0


def test_broken_archives_are_noticed():
    with pytest.raises(ValueError):
        list(op3.parse(b"not a record\r\n\r\n"))
    with pytest.raises(ValueError):
        list(op3.parse(b"WARC/1.1\r\nContent-Length: 3\r\n\r\nabcd\r\n\r\n"))


@pytest.mark.parametrize("n", [1, 2, 3, 10, 97, 1000])
def test_permutation_and_inverse(spark, n):
    forward, back = op8.longest_walk(spark, n), op8.longest_walk(spark, n, step=op8.inverse_feistel)
    rows = spark.range(n).withColumn("p", op8.permuted(F.col("id"), n, forward)).withColumn(
        "q", op8.inverse(F.col("p"), n, back)).collect()
    assert sorted(r.p for r in rows) == list(range(n)) and all(r.q == r.id for r in rows)
    assert n < 97 or sum(r.p == r.id for r in rows) < n / 10


def test_shards_are_even_and_reproducible(spark, tmp_path):
    rows = hard_rows() + [(7, "copy")] * 400  # one key holds most rows
    path = str(tmp_path / "documents.parquet")
    table(spark, rows, 5).write.parquet(path)
    out = op8.shard_table(spark, path)
    assert {"doc_id", "text", "row_number", "shard", "slot"} - set(out.columns) == {"row_number"}
    got = out.collect()
    shards: dict = {}
    for r in got:
        shards.setdefault(r.shard, []).append(r.slot)
    assert len(shards) == 16 and all(sorted(x) == list(range(len(x))) for x in shards.values())
    assert max(map(len, shards.values())) - min(map(len, shards.values())) <= 1
    assert Counter((r.doc_id, r.text) for r in got) == Counter(rows)
    again = op8.shard_table(spark, path).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    d = op8.digest(out).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in d) == Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    assert op8.shard_rows(table(spark, [])).count() == 0
    assert "Python" not in out._jdf.queryExecution().toString() and "Arrow" not in out._jdf.queryExecution().toString()


def test_pipeline_stages(spark):
    from test_duplicates import brute_classes, brute_kept
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    cols, n = docs.columns, docs.count()
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality rules", "quality classifier", "MinHash near-dedup", "substring dedup", "best-fit packing"]
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        before = [(r.doc_id, r.text) for r in docs.collect()]
        docs = corpus_pipeline.stage(stage(spark, docs, sf_dir), "test")
        after = docs.collect()
        seen.append(len(after))
        if name == "quality rules":
            assert {r.doc_id for r in after} == {i for i, t in before
                                                 if not any(x.rejects(op7.TextView(t)) for x in op7.CORPUS_RULES)}
        if name == "MinHash near-dedup":
            want = brute_classes(before)
            assert {r.doc_id for r in after} == {i for i, t in before if want[i, t] == i}
        if name == "substring dedup":
            kept = {i: (gone, text) for i, _, gone, text in brute_kept(before)}
            assert {r.doc_id: r.text for r in after} == {
                i: kept[i][1] if kept[i][0] else t for i, t in before}
        if name != "best-fit packing":
            assert docs.columns == cols
    assert n > seen[0] >= seen[1] >= seen[2] == seen[3] > 0
    e = op9.WordEncoder(open(public_tokenizers.path("word_bpe_49k.json"), "rb").read())
    assert sum(r.length for r in after) == sum(len(e.whole(t or "")) // 4 + 1 for _, t in before)
    assert corpus_pipeline.run(spark, sf_dir).count() == seen[-1]
    assert words("a b") == [b"a", b"b"]
    import os
    from sftforge.llm import common
    paths = [p.removeprefix("file:") for p in common.STAGED]
    assert any(os.path.isdir(p) for p in paths)
    common.remove_staged(spark)
    assert not common.STAGED and not any(os.path.isdir(p) for p in paths)
