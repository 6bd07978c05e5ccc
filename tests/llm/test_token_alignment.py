"""Operator 13 against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from helpers import hard_rows, table

from sftforge.llm import op13_token_alignment as op13

FILE_A, FILE_B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def spans(parts):
    at = 0
    for p in parts:
        yield at, at + len(p)
        at += len(p)


def brute(rows):
    import sentencepiece
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(FILE_A)
    t.encode_special_tokens = True
    s = sentencepiece.SentencePieceProcessor(model_file=FILE_B)
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in kept} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in kept)}

    def bytes_b(piece):
        if len(piece) == 6 and piece.startswith("<0x"):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode()

    docs, counts = [], Counter()
    for doc_id, text in rows:
        a = t.encode(" " + (text or ""), add_special_tokens=False)
        ids_b = s.encode(text or "")
        bytes_a = [bytes(letters[c] for c in x) for x in a.tokens]
        parts_b = [bytes_b(s.id_to_piece(i)) for i in ids_b]
        whole = b" " + (text or "").encode()
        if not text or b"".join(bytes_a) != whole or b"".join(parts_b) != whole:
            docs.append((doc_id, 0, 0, 0, [], ""))
            continue
        sa, sb = list(spans(bytes_a)), list(spans(parts_b))
        links, j0 = [], 0
        for i, (x, y) in enumerate(sa):
            while sb[j0][1] <= x:
                j0 += 1
            j = j0
            while j < len(sb) and sb[j][0] < y:
                links.append((a.ids[i], ids_b[j]))
                j += 1
        cuts = sorted({y for _, y in sa} & {y for _, y in sb})
        names, last = [], 0
        for c in cuts:
            names.append(",".join(str(n) for n, (x, y) in zip(a.ids, sa) if last < y <= c) + "|"
                         + ",".join(str(n) for n, (x, y) in zip(ids_b, sb) if last < y <= c))
            last = c
        docs.append((doc_id, len(sa), len(sb), len(cuts), links,
                     hashlib.sha256(";".join(names).encode()).hexdigest()))
        counts.update(set(links))
    most = {}
    for (a, _), n in counts.items():
        most[a] = max(most.get(a, 0), n)
    return Counter((d, x, y, g, len(l), sum(counts[p] == most[p[0]] for p in l), sum(counts[p] for p in l), h)
                   for d, x, y, g, l, h in docs)


def odd_rows():
    rng = random.Random(8)
    parts = ["a", "the ", " ", "  ", "\n", "\t", "é", "日本", "▁", "<s>", "</s>", "<unk>", "<0x41>", "<|endoftext|>",
             "\x85", "\xa0", "\x00", "​", "don't", "100 ", ".", "🙂", "́", "ﬁ"]
    return [(500 + i, "".join(rng.choices(parts, k=rng.randint(1, 15)))) for i in range(300)]


@pytest.mark.parametrize("block_bytes", [300, op13.BLOCK_BYTES])
def test_alignment_equals_brute_force(spark, monkeypatch, block_bytes):
    rows = [r for r in hard_rows() if len(r[1] or "") < 20_000] + odd_rows() + [(900, "hot copy of a text")] * 60
    if block_bytes == 300:
        monkeypatch.setattr(op13, "PART_BYTES", 200)
    got = op13.align(table(spark, rows), FILE_A, FILE_B, block_bytes)
    names = "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256".split()
    assert got.columns == names
    assert Counter(tuple(r[c] for c in names) for r in got.collect()) == brute(rows)


def test_long_chains_of_overlaps_and_no_rows(spark):
    ends_a, ends_b = np.arange(2, 2002, 2), np.r_[np.arange(1, 2000, 2), 2000]  # one group of all
    a, b = op13.groups_of(ends_a, ends_b)
    assert set(a) == set(b) == {len(ends_a) - 1}
    i, j = op13.links_of(ends_a, ends_b)
    want = [(x, y) for x in range(1000) for y in range(1001)
            if max([0, *ends_a][x], [0, *ends_b][y]) < min(ends_a[x], ends_b[y])]
    assert list(zip(i, j)) == want
    assert op13.align(table(spark, []), FILE_A, FILE_B).collect() == []
    r = op13.align(table(spark, [(1, "word " * 400_000), (2, None)]), FILE_A, FILE_B).collect()
    assert sorted((x.doc_id, x.n_a > 400_000, x.n_best == x.n_links) for x in r) == [(1, True, True), (2, False, True)]
