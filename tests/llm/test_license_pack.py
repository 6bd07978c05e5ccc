"""Operators 1, 9 and 10."""

import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from helpers import hard_rows, prose, table
from pyspark.sql import functions as F

from sftforge.llm import op1_license_scan as op1
from sftforge.llm import op9_best_fit_packing as op9
from sftforge.llm import op10_sentencepiece as op10
from sftforge.llm.sentencepiece_model import Model

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", "   ", " a", "a  b   c ", "日本語😀 é\n\tx", "▁▁x ▁", "x\x00y", "á", "\x85\xa0 ﬁ Ⅷ ①", "<s> </s> <unk> <0x41>",
       "ÿ" * 50, "don't <|endoftext|>x", "İstanbul ΣΑΣ ǅ ³²½ Straße", "x\ty\r\n\x0b \x0c", "aªbºcµ", "! !! 4.5 a1b2"]


def folded(text):
    return [x.lower() for x in re.findall(rb"[0-9A-Za-z\x80-\xff]+", (text or "").encode())]


def grams(text):
    w = folded(text)
    return list(zip(w, w[1:], w[2:]))


def test_licenses_match_brute_force(spark):
    rng = random.Random(2)
    rows = hard_rows()[:50]
    for k, (_, text) in enumerate(op1.TEMPLATES):
        w = text.split()
        near = w[:-1] + ["changed"]
        for j, body in enumerate((text, text.upper(), " ".join(near), " ".join(w[:len(w) // 2]))):
            rows.append((100 + 10 * k + j, prose(rng, rng.randint(0, 90)) + "\n" + body + " " + prose(rng, 30)))
    rows.append((500, " ".join(f"{op1.TEMPLATES[2][1]} {prose(rng, 40)}" for _ in range(3))))
    rows.append((501, op1.TEMPLATES[9][1]))
    got = {(r.doc_id, r.template): r for r in op1.scan(table(spark, rows)).collect()}
    want = {}
    for i, text in rows:
        held = grams(text)
        for k, (_, t) in enumerate(op1.TEMPLATES):
            own, n = set(grams(t)), len(folded(t))
            best = max((len(own & set(held[a:a + n])) / len(own) for a in range(max(1, len(held)))), default=0)
            if best >= 0.8:
                want[i, k] = best
    assert got.keys() == want.keys() and len(want) >= 20
    assert all(got[x].containment >= want[x] - 1e-9 for x in want)
    r, text = got[501, 9], op1.TEMPLATES[9][1].encode()
    assert text[r.first_byte:r.end_byte] == text.rstrip(b".") and (r.first_word, r.last_word) == (0, 6)
    assert got[500, 2].occurrences == 3
    assert op1.scan(table(spark, [])).count() == 0


def test_words_put_into_a_notice_are_found_at_every_offset():
    import pyarrow as pa
    from sftforge.llm.wordhash import chunks
    rng, known = random.Random(4), op1.prepare()
    for number, run in ((1, 10), (3, 9), (4, 7), (6, 14)):
        t = known[number]
        words = folded(op1.TEMPLATES[number][1])
        words[len(words) // 2:len(words) // 2] = [b"in%d" % i for i in range(run)]
        notice = b" ".join(words).decode()
        texts = [" ".join(["pad"] * k + [notice, prose(rng, 60)]) for k in range(2 * t.n_words)]
        for offset, _, w in chunks(pa.array(texts), folded=True):
            best: dict = {}
            for doc, hit, part, a, z in op1._matches(w, known, op1.THRESHOLD):
                if hit.number == number:
                    best[doc] = max(best.get(doc, (0,)), (part, a - w.first[doc], z - w.first[doc]))
            assert offset == 0 and {k: x[1:] for k, x in best.items()} == {
                k: (k, k + len(words) - 1) for k in range(len(texts))}


def test_production_templates_find_bodies_and_notices_anywhere(spark):
    rng, known = random.Random(6), op1.production()
    assert known[:len(op1.TEMPLATES)] == op1.TEMPLATES and len({x for x, _ in known}) >= 35
    for t in op1.prepare(known):
        similar = 0.8 * len(t.shingles) / (op1.WINDOW * t.block + 0.2 * len(t.shingles))
        assert not t.rows or 1 - (1 - similar ** t.rows) ** (op1.HASHES // t.rows) >= op1.RECALL
        assert (op1.WINDOW - 1) * t.block + 1 >= op1.STRETCH * t.n_words - op1.SHINGLE + 1
    rows = [(k, prose(rng, rng.randint(0, 900)) + "\n" + text + "\n" + prose(rng, 40)) for k, (_, text) in enumerate(known)]
    got = {(r.doc_id, r.template) for r in op1.scan(table(spark, rows), known).collect()}
    assert {(k, k) for k in range(len(known))} <= got
    asked = spark.createDataFrame([("X", "one two three four"), ("A", "some other short notice")], "license string, text string")
    assert [t.license for t in op1.prepare(asked)] == ["A", "X"]
    with pytest.raises(ValueError):
        op1.prepare([("X", "a b c")] * (op1.MAX_TEMPLATES + 1))


def test_band_settings_keep_their_promise():
    for s in (0.2, 0.3, 0.5, 0.8):
        r = op1.band_rows(s)
        assert r == 1 or 1 - (1 - s ** r) ** (op1.HASHES // r) >= op1.RECALL
    assert all(1 - (1 - op1.THRESHOLD * len(t.shingles) / (2 * t.n_words + 0.2 * len(t.shingles))) ** op1.HASHES
               >= op1.RECALL for t in op1.prepare())


def test_word_encoder_is_the_tokenizer():
    e = op9.WordEncoder(open(WORD_BPE, "rb").read())
    assert e.by_word
    for text in [t or "" for _, t in hard_rows()] + ODD:
        assert e.encode(text) == e.whole(text), text[:60]


@pytest.mark.parametrize("seed", range(30))
def test_plans_fill_sequences_without_gaps(seed):
    rng = random.Random(seed)
    lengths = [rng.choice([2048, 1024, 683, 682, rng.randint(1, 2048), rng.randint(1, 300)])
               for _ in range(rng.choice([0, 1, 3, 40, 3000]))]
    histogram = {n: lengths.count(n) for n in set(lengths)}
    p = op9.plan(histogram)
    held: dict = {}
    for n, count in histogram.items():
        own = p[p[:, 0] == n]
        for rank in range(count):
            _, first, seq, each, at = own[np.searchsorted(own[:, 1], rank, side="right") - 1]
            held.setdefault(seq + (rank - first) // each, []).append((at + (rank - first) % each * n, n))
    for pieces in held.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at <= 2048
    least = max(-(-sum(lengths) // 2048), sum(n > 1024 for n in lengths))
    assert len(held) <= max(least * 1.25, least + 1)
    large = [n for n in lengths if 3 * n > 2048]
    if large and len(large) == len(lengths):  # matching is optimal for large pieces
        assert len(held) >= least


def test_documents_are_packed(spark):
    rows = hard_rows()
    pieces = op9.tokenize_pieces(table(spark, rows), WORD_BPE)
    e = op9.WordEncoder(open(WORD_BPE, "rb").read())
    want = []
    for i, t in rows:
        ids = e.whole(t or "") + bytes(4)
        for k in range(0, len(ids), 8192):
            part = ids[k:k + 8192]
            want.append((i, k // 8192, k // 4, len(part) // 4, zlib.crc32(part)))
    got = op9.pack(pieces.withColumn("crc", F.crc32("ids")).drop("ids")).collect()
    assert sorted((tuple(r)[:5] for r in got), key=str) == sorted(want, key=str)
    held: dict = {}
    for r in got:
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for x in held.values():
        at = 0
        for offset, n in sorted(x):
            assert offset == at
            at += n
        assert at <= 2048
    assert op9.pack_documents(table(spark, []), WORD_BPE).count() == 0


def test_pieces_and_texts_are_the_librarys(spark):
    rows = hard_rows() + [(900 + i, t) for i, t in enumerate(ODD)]
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    coded = op10.encode(table(spark, rows), PIECES)
    out = coded.withColumn("back", op10.decode(coded, PIECES)("ids")).collect()
    want = sorted(((i, sp.encode(t or ""), sp.decode(sp.encode(t or ""))) for i, t in rows), key=str)
    assert sorted(((r.doc_id, r.ids, r.back) for r in out), key=str) == want
    texts = {i: (t or "").encode() for i, t in rows if i is not None}
    for r in out:
        if r.doc_id in texts and r.ids:  # the spans cover the text, in order
            assert r.starts[0] == 0 and r.ends[-1] == len(texts[r.doc_id])
            assert all(a <= b for a, b in zip(r.starts, r.ends)) and r.starts[1:] == r.ends[:-1]
    assert op10.encode(table(spark, []), PIECES).count() == 0


def test_decoding_any_ids_is_the_librarys():
    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    d, rng = op10.Decoder(open(PIECES, "rb").read()), random.Random(0)
    for _ in range(2000):
        ids = [rng.choice([rng.randrange(32000), rng.randrange(260), 0, 1, 2, 29871]) for _ in range(rng.randint(0, 6))]
        assert d.decode(ids) == sp.decode(ids), ids


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc", "nfkc_cf", "nmt_nfkc_cf", "identity"])
def test_character_maps_with_alignment(rule):
    library = sentencepiece.SentencePieceNormalizer(rule_name=rule)
    own = op10.Normalizer(Model.parse(library.serialized_model_proto()))
    for text in ODD + ["Ⅷ  ①②ﬁ ｶﾞ  x", "​x　y", " lead and trail  ", "ガギ" * 5] + [t or "" for _, t in hard_rows()[:20]]:
        norm, origin = own(text)
        assert norm.decode() == library.normalize(text)
        assert len(origin) == len(norm) + 1 and all(np.diff(origin) >= 0) and origin[-1] <= len(text.encode())
