"""Operator 12 against brute force."""

import random
import zlib
from collections import Counter
import re

import pytest
from helpers import hard_rows, table

from sftforge.llm import op12_spelling_variants as op12


def near(x, y):
    if len(x) > len(y):
        x, y = y, x
    if x == y or len(y) - len(x) > 1:
        return False
    if len(x) == len(y):
        return sum(a != b for a, b in zip(x, y)) == 1
    return any(y[:i] + y[i + 1:] == x for i in range(len(y)))


def lower(word):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in word)


def brute(rows):
    total = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            total[run] += 1
    words = {w: n for w, n in total.items() if len(w) >= 6 and n >= 5}
    form, out = {}, {}
    for w, n in words.items():
        close = [v for v in words if near(w, v)]
        best = min(close, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 5 * n else None
        out[w] = (n, len(close))
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, *out[w], words.get(form[w]))
    return out


def texts(seed, n_words=60, n_rows=60):
    """Words, their variants, and chains of variants, in many documents."""
    rng = random.Random(seed)
    letters = "abcdeéÿ÷"
    words = ["".join(rng.choices(letters, k=rng.randint(5, 9))) for _ in range(n_words)]
    for w in list(words):
        for _ in range(3):
            at = rng.randrange(len(w))
            words.append(rng.choice([w[:at] + w[at + 1:], w[:at] + rng.choice(letters) + w[at:],
                                     w[:at] + rng.choice(letters) + w[at + 1:]]))
    weights = [5 ** rng.randint(0, 4) for _ in words]
    return [(i, " ".join(w.upper() if w.isascii() and rng.random() < 0.1 else w
                         for w in rng.choices(words, weights, k=400))) for i in range(n_rows)]


@pytest.mark.parametrize("tile", [3, op12.TILE])
def test_variants_equal_brute_force(spark, tile):
    rows = texts(1) + [(None, texts(2)[0][1])] + [(7, "aaaaaaa aaaaaa aaaaaaaa " * 9), (7, "aaaaaaa " * 90)] + hard_rows()
    rows += [(9, "word" * 5000 + " " + ("word" * 5000)[:-1] + " ")] * 5
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n)
           for r in op12.group_variants(table(spark, rows), tile).collect()}
    want = brute(rows)
    assert got == want
    assert sum(x[0] is not None for x in want.values()) > 20 and any(x[1] not in (x[0], w) for w, x in want.items())


def test_no_words(spark):
    for rows in ([], [(1, None), (2, ""), (3, "short words only"), (4, "one two")]):
        assert op12.group_variants(table(spark, rows)).collect() == []
