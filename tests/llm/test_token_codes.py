"""Operator 11: directly addressable codes and their files."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from helpers import hard_rows, table
from hypothesis import given, settings
from hypothesis import strategies as st

from sftforge.llm import op11_token_codes as op11
from sftforge.llm.bytebpe import ByteEncoder, packed

FILE = public_tokenizers.path("byte_bpe_50k.json")


def tokenizer(plain=False):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(FILE)
    t.encode_special_tokens = plain
    return t


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 50256), st.integers(0, 2**32 - 1)), max_size=400))
def test_any_id_is_reached(ids):
    data = op11.write_codes(np.array(ids, np.uint32), [None, 7], [len(ids), 0])
    codes = op11.Codes(data + b"\n")
    assert codes.n == len(ids) and codes.doc_ids == [None, 7]
    assert [codes[i] for i in range(len(ids))] == ids
    assert codes.span(0, len(ids)).tolist() == ids and codes.document(1).tolist() == []
    assert [x.tolist() for x in codes.documents()] == [ids, []]


def test_long_files_have_ranks_beyond_a_block():
    rng = np.random.default_rng(5)
    ids = np.minimum(rng.pareto(0.4, 300_000) * 3, 50256).astype(np.uint32)
    codes = op11.Codes(op11.write_codes(ids, [1], [len(ids)]))
    assert len(codes.levels) > 1
    at = rng.integers(0, len(ids), 5000)
    assert (codes.at(at) == ids[at]).all()
    for start, n in ((0, 300_000), (65_535, 3), (131_071, 70_000), (299_999, 1), (64, 64), (5, 0)):
        assert (codes.span(start, n) == ids[start:start + n]).all()
    for bad in (lambda: codes[300_000], lambda: codes.at([-1]), lambda: codes.span(299_999, 2)):
        with pytest.raises(IndexError):
            bad()


def test_widths_are_the_cheapest():
    rng = random.Random(2)

    def splits(n):
        yield from ([w, *rest] for w in range(1, min(n, 8) + 1) for rest in (splits(n - w) if n > w else [[]]))

    for _ in range(10):
        lengths = np.array([rng.choice([0, 1, 10, 100, 5000]) for _ in range(10)])
        top = max([b for b in range(10) if lengths[b]] + [1])

        def cost(widths):
            at, total = 0, 0.0
            for w in widths:
                n = lengths.sum() if at == 0 else lengths[at + 1:].sum()
                at += w
                total += n * (w + (1.25 if at < top else 0))
            return total

        assert cost(op11.widths_of(lengths)) == min(map(cost, splits(top)))


def test_words_give_the_tokenizers_ids():
    rng = random.Random(3)
    parts = ["a", "bc", " ", "  ", "\n", "\n\n", "\t", "'s", "'", "é", "日", "1", ".", ",", "<|endoftext|>", "\x85", "\xa0",
             "\x1c", "\r", "x y", "　", "!", " \n", "A's", "​"]
    for plain in (False, True):
        t = tokenizer(plain)
        with open(FILE, "rb") as f:
            encoder = ByteEncoder(f.read(), plain)
        assert encoder.by_word
        for text in ["".join(rng.choices(parts, k=rng.randint(0, 12))) for _ in range(3000)]:
            assert encoder.encode(text) == packed(t.encode(text, add_special_tokens=False).ids), text


@pytest.mark.parametrize("file_ids", [1, 700, op11.FILE_IDS])
def test_files_hold_every_document_in_order(spark, file_ids):
    rng = random.Random(4)
    rows = hard_rows() + [(70, "long " + "".join(rng.choices("abcde \n", k=2_000_000)))] + [(None, None)] * 40
    got = op11.round_trip(table(spark, rows), FILE, file_ids=file_ids).collect()
    t = tokenizer()
    want = {}
    for i, text in rows:
        ids = t.encode(text or "", add_special_tokens=False).ids + [2]
        want.setdefault(i, []).append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    seen: dict = {}
    for r in got:
        seen.setdefault(r.doc_id, []).append((r.n_tokens, r.ids_crc32))
    assert {k: sorted(v) for k, v in seen.items()} == {k: sorted(v) for k, v in want.items()}
    at, last = 0, -1
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at and (-1 if r.doc_id is None else r.doc_id) >= last
        at, last = at + r.n_tokens, -1 if r.doc_id is None else r.doc_id


def test_no_rows(spark):
    assert op11.round_trip(table(spark, []), FILE).collect() == []
