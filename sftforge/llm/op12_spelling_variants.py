"""Operator 12, spelling variants by dense prefix-suffix tiling.

Two words are near if one inserted, deleted or replaced character makes one of
the other: exactly if their common prefix and their common suffix together are
as long as the longer word less one. Words become rows of padded code-point
matrices, one aligned left and one right, and blocks of words are compared
densely, pair by pair of a tile.

Which blocks must meet: let L be the longer length of a near pair, and cut
0 .. L - 1 into ``SEGMENTS`` ranges. The edit lies in one of them, and both
words share what is before and after that range. So a word of n characters goes
to one group for each range at L = n and at L = n + 1, by the characters outside
the range. A pair counts in the group of its leftmost possible edit alone, so
none counts twice. A group of over ``TILE`` words is cut into tiles by word
hash, and each pair of its tiles is a task's work of its own; so no group is held
whole, and none is cut short.

Tiles give each word's number of near words and its most frequent one, never
the pairs. A word's form is that one, if it is ``RATIO`` times as frequent at
least; so a chain of forms is never longer than the logarithm of the greatest
count, and successor doubling finds its end in a few joins.

Words are counted in tasks first (a word that a third of all rows holds sends one
number a task). Very long words are rows of their own wide matrix.

Defined results: a null text has no words; a null doc_id reads as the empty
text; repeated rows count each; ties of form go to the smaller word by code
points; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
import re
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sftforge.llm.common import shuffle_width, slim, stage

# Fixed values of the task: runs of letters, the typing slips it plants, and what makes a word.
RUN = "[A-Za-zÀ-ÿ]+"
SLIP = 199
MIN_LENGTH = 6
MIN_COUNT = 5
RATIO = 5
#: Ranges in which the edit may lie, and words of a tile.
SEGMENTS = 3
TILE = 1024
#: Words that a task counts before it hands the counts on.
MEMO_WORDS = 500_000
#: Cells of a dense comparison at once.
CELLS = 1 << 22


def _counts(batches):
    """(doc_id, text) -> word, n: partial counts."""
    from collections import Counter

    import pyarrow as pa
    run, crc = re.compile(RUN), zlib.crc32

    def out():
        return pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())],
                                          names=["word", "n"])

    total: Counter = Counter()
    for b in batches:
        for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
            text = text.as_py()
            if not text:
                continue
            words = run.findall(text.encode().lower().decode())  # bytes lower A-Z alone
            total.update(words)
            base = crc(f"{'' if doc_id is None else doc_id}:".encode())
            slips = {w: h for w in set(words) if not (h := crc(w.encode(), base)) % SLIP}
            if slips:
                here = Counter(w for w in words if w in slips)
                for w, h in slips.items():
                    total[w] -= here[w]
                    at = h % len(w)
                    total[w[:at] + w[at + 1:]] += here[w]
        if len(total) > MEMO_WORDS:
            yield out()
            total = Counter()
    if total:
        yield out()


def count_words(docs: DataFrame) -> DataFrame:
    """word, n: the words of ``docs`` that are long and frequent enough."""
    parts = slim(docs, "doc_id", "text").mapInArrow(_counts, "word string, n long")
    return (parts.filter(F.length("word") >= MIN_LENGTH).groupBy("word").agg(F.sum("n").alias("n"))
            .filter(F.col("n") >= MIN_COUNT))


def ranges(length: int) -> list[tuple[int, int]]:
    """The ranges of places into which a longer word's edit is dealt."""
    edges = [length * k // SEGMENTS for k in range(SEGMENTS + 1)]
    return list(zip(edges, edges[1:]))


def _groups(batches):
    """(word, n) -> longer length, range, key (a hash of them and of the
    characters outside of the range), word, n."""
    from hashlib import blake2b

    import pyarrow as pa
    for b in batches:
        longer, part, key, row = [], [], [], []
        for i, word in enumerate(b.column(0).to_pylist()):
            for length in (len(word), len(word) + 1):
                for k, (start, end) in enumerate(ranges(length)):
                    outside = f"{length},{k},{word[:start]},{word[len(word) - (length - end):]}"
                    key.append(int.from_bytes(blake2b(outside.encode(), digest_size=8).digest(), "big", signed=True))
                    longer.append(length)
                    part.append(k)
                    row.append(i)
        at = pa.array(row, pa.int32())
        yield pa.RecordBatch.from_arrays(
            [pa.array(longer, pa.int32()), pa.array(part, pa.int32()), pa.array(key, pa.int64()),
             b.column(0).take(at), b.column(1).take(at)], names=["longer", "part", "key", "word", "n"])


def matrices(words: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the words (all below 256), aligned left and right, with zeros."""
    left = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(-1, width)
    right = np.frombuffer(b"".join(w.rjust(width, b"\0") for w in words), np.uint8).reshape(-1, width)
    return left, right


def first_difference(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Columns before the first in which rows differ."""
    differ = x != y
    return np.where(differ.any(axis=1), differ.argmax(axis=1), x.shape[1])


def near_pairs(left, right, size, x, y, width: int, part: int) -> np.ndarray:
    """Which of the row pairs (x, y) are near with their leftmost edit in the
    range ``part`` of the longer length ``width``."""
    hit = np.zeros(len(x), bool)
    start, end = ranges(width)[part]
    for at in range(0, len(x), max(1, CELLS // width)):
        i, j = x[at:at + max(1, CELLS // width)], y[at:at + max(1, CELLS // width)]
        prefix = np.minimum(first_difference(left[i], left[j]), np.minimum(size[i], size[j]))
        suffix = np.minimum(first_difference(right[i, ::-1], right[j, ::-1]), np.minimum(size[i], size[j]))
        edit = np.maximum(width - 1 - suffix, 0)
        hit[at:at + len(i)] = ((prefix + suffix >= width - 1) & (np.maximum(size[i], size[j]) == width)
                               & (start <= edit) & (edit < end))
    return hit


def _tiles(batches):
    """Rows sorted by (longer, part, key, i, j), ``tile`` of each word -> word,
    near (its near words met here), best (the most frequent of them) and best_n."""
    import pyarrow as pa

    def compare(rows):
        """Groups of one longer length and range, whole."""
        width, part = rows["longer"][0].as_py(), rows["part"][0].as_py()
        word = [w.encode("latin-1") for w in rows["word"].to_pylist()]
        n, tile = rows["n"].to_numpy(), rows["tile"].to_numpy()
        key, a, b = (rows[c].to_numpy() for c in ("key", "i", "j"))
        size = np.array([len(w) for w in word])
        left, right = matrices(word, width)
        edge = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1]), True])
        xs, ys = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for s, e in zip(edge[:-1], edge[1:]):
            if e - s == 1:
                continue
            if a[s] == b[s]:
                x, y = (t + s for t in np.triu_indices(e - s, 1))
            else:
                one, two = s + np.flatnonzero(tile[s:e] == a[s]), s + np.flatnonzero(tile[s:e] == b[s])
                x, y = np.repeat(one, len(two)), np.tile(two, len(one))
            hit = near_pairs(left, right, size, x, y, width, part) if len(x) > 64 else np.ones(len(x), bool)
            xs.append(x[hit])
            ys.append(y[hit])
        x, y = np.concatenate(xs), np.concatenate(ys)
        hit = near_pairs(left, right, size, x, y, width, part)  # of the small groups, all at once
        x, y = np.r_[x[hit], y[hit]], np.r_[y[hit], x[hit]]
        if not len(x):
            return None
        rank = np.empty(len(word), np.int64)
        rank[sorted(range(len(word)), key=word.__getitem__)] = np.arange(len(word))
        order = np.lexsort((rank[y], -n[y], x))
        x, y = x[order], y[order]
        top = np.flatnonzero(np.r_[True, x[1:] != x[:-1]])
        return pa.RecordBatch.from_arrays(
            [rows["word"].take(pa.array(x[top])).combine_chunks(), pa.array(np.diff(np.r_[top, len(x)])),
             rows["word"].take(pa.array(y[top])).combine_chunks(), pa.array(n[y[top]])],
            names=["word", "near", "best", "best_n"])

    def whole(table):
        """Compare a table's rows, by longer length and range."""
        longer, part = table["longer"].to_numpy(), table["part"].to_numpy()
        edge = np.flatnonzero(np.r_[True, (longer[1:] != longer[:-1]) | (part[1:] != part[:-1]), True])
        for s, e in zip(edge[:-1], edge[1:]):
            found = compare(table.slice(s, e - s))
            if found is not None:
                yield found

    rest = None
    for b in batches:
        table = pa.Table.from_batches([b])
        if rest is not None:
            table = pa.concat_tables([rest, table])
        # the last group may go on in the next batch
        same = np.ones(table.num_rows, bool)
        for c in ("longer", "part", "key", "i", "j"):
            values = table[c].to_numpy()
            same &= values == values[-1]
        keep = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
        rest = table.slice(keep)
        if keep:
            yield from whole(table.slice(0, keep))
    if rest is not None and rest.num_rows:
        yield from whole(rest)


def near_words(words: DataFrame, tile: int = TILE) -> DataFrame:
    """word, n_near, best, best_n of the words (word, n) that have a near word."""
    spark = words.sparkSession
    rows = stage(words.mapInArrow(_groups, "longer int, part int, key long, word string, n long"), "op12-groups")
    # Groups of one word compare nothing; those of over a tile are cut.
    sizes = rows.groupBy("longer", "part", "key").agg(F.count("*").alias("m")).filter("m > 1")
    rows = rows.join(sizes, ["longer", "part", "key"])
    rows = rows.withColumn("tiles", F.ceil(F.col("m") / tile)).withColumn(
        "tile", F.pmod(F.xxhash64("word"), F.col("tiles")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), (F.col("tiles") - 1).cast("int")))
    rows = rows.select("longer", "part", "key", "word", "n", "tile", other.alias("other"))
    rows = rows.select("longer", "part", "key", F.least("tile", "other").alias("i"),
                       F.greatest("tile", "other").alias("j"), "word", "n", "tile")
    group = ["longer", "part", "key", "i", "j"]
    found = (rows.repartition(shuffle_width(spark), *group).sortWithinPartitions(*group)
             .mapInArrow(_tiles, "word string, near long, best string, best_n long"))
    first = F.min(F.struct((-F.col("best_n")).alias("n"), "best"))
    return (found.groupBy("word").agg(F.sum("near").alias("n_near"), first.alias("b"))
            .select("word", "n_near", F.col("b.best").alias("best"), (-F.col("b.n")).alias("best_n")))


def roots(forms: DataFrame, longest: int) -> DataFrame:
    """word, root of (word, form): the ends of chains of at most ``longest``
    steps, by successor doubling."""
    now = stage(forms.select("word", F.col("form").alias("root")), "op12-roots", compact=True)
    for _ in range(math.ceil(math.log2(max(longest, 1)))):
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        now = stage(now.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root")),
                    "op12-roots", compact=True)
    return now


def group_variants(docs: DataFrame, tile: int = TILE) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of ``docs``."""
    words = stage(count_words(docs), "op12-words")
    near = near_words(words, tile)
    is_form = F.col("best_n") >= RATIO * F.col("n")
    rows = stage(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n")), "op12-forms")
    most = words.agg(F.max("n")).first()[0] or 1
    ends = roots(rows.filter("form is not null"), int(math.log(max(most / MIN_COUNT, 1), RATIO)) + 1)
    return rows.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
