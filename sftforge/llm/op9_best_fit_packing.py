"""Operator 9, best-fit packing by large-item matching.

Documents become pieces of at most ``capacity`` tokens; pieces become sequences.
Pieces longer than a third of the capacity can meet at most twice in a
sequence: the longest is matched with the longest that still fits, again and
again, which uses the fewest sequences for them. Shorter pieces, longest first,
go into the tightest gap that is left, else into new sequences.

Pieces of one length are alike to the packer, so it plans on the histogram of
lengths (``capacity`` numbers, whatever the size of the corpus): each step
places a run of equal pieces into a run of equal gaps. The plan is a short
table (length, first rank, sequence, pieces a sequence, offset); each piece
finds its place from its rank among the pieces of its length. Ranks come from
counts by (length, salt), so a length that a third of all pieces share is
numbered by many tasks, and token ids never move through a shuffle.

Defined results: a very long text is cut into as many pieces as it needs;
a null text is an empty document, which is one piece of the
single token 0; repeated rows are packed each; null ids stay null; an empty
table gives no rows; other columns are dropped.
"""

from __future__ import annotations

import bisect
import json
import re
import sys
from array import array
from collections import defaultdict

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sftforge.llm.common import shuffle_width, slim, stage

CAPACITY = 2048
END_ID = 0
#: Words whose ids a task remembers at most; beyond it, it forgets them all.
MEMO_WORDS = 300_000

# The parts of a tokenizer file under which no token spans a white space.
SPACE_NORMALIZERS = ["NFC", "Replace", "Lowercase"]
SPLIT_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def packed(ids: list[int]) -> bytes:
    """Little-endian 32-bit numbers."""
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


class WordEncoder(dict):
    """word -> its ids as little-endian 32-bit numbers. Under the tokenizer
    files this accepts, white space separates tokens, so a text's ids are its
    words' ids in a row. Plain Latin words with trailing punctuation go straight
    to the merge model (lower case by character, bytes spelled as the file
    spells them); any other word goes through the whole tokenizer."""

    PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?#*$%&]*)")

    def __init__(self, file: bytes):
        from tokenizers import Tokenizer
        super().__init__()
        self.tokenizer = Tokenizer.from_str(file.decode())
        self.model = self.tokenizer.model
        config = json.loads(file)
        steps = config["normalizer"].get("normalizers", [])
        split = config["pre_tokenizer"].get("pretokenizers", [{}])[0]
        self.by_word = [x["type"] for x in steps] == SPACE_NORMALIZERS and split.get("pattern") == {
            "Regex": SPLIT_PATTERN} and all(" " not in x["content"] for x in config["added_tokens"])
        kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in set(kept)]
        self.spelling = {b: chr(256 + i) for i, b in enumerate(rest)}  # the other bytes spell themselves
        self.parts: dict[str, bytes] = {}

    def part(self, text: str) -> bytes:
        """Ids of a run of letters or of punctuation."""
        ids = self.parts.get(text)
        if ids is None:
            spelled = text if text.isascii() else text.encode().decode("latin-1").translate(self.spelling)
            ids = self.parts[text] = packed([t.id for t in self.model.tokenize(spelled)])
        return ids

    def __missing__(self, word: str) -> bytes:
        if len(self) >= MEMO_WORDS:
            self.clear()
            self.parts.clear()
        if m := self.PLAIN.fullmatch(word):
            ids = self.part(m[1].lower()) + (self.part(m[2]) if m[2] else b"")
        else:
            ids = self.whole(word)
        self[word] = ids
        return ids

    def whole(self, text: str) -> bytes:
        return packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def encode(self, text: str) -> bytes:
        if not self.by_word:
            return self.whole(text)
        return b"".join([self[w] for w in text.replace("\n", " ").split(" ") if w])


def tokenize_pieces(docs: DataFrame, tokenizer_file: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length and ``ids`` (little-endian 32-bit) of every
    document's pieces. The tokenizer file (a fixed, small one) is broadcast."""
    spark = docs.sparkSession
    with open(tokenizer_file, "rb") as f:
        file = spark.sparkContext.broadcast(f.read())

    def cut(batches):
        import pyarrow as pa
        encoder = WordEncoder(file.value)
        end = packed([END_ID])
        for b in batches:
            rows, pieces, starts, lengths, ids = [], [], [], [], []
            for i, text in enumerate(b.column(1).to_pylist()):
                data = encoder.encode(text or "") + end
                for k, at in enumerate(range(0, len(data), 4 * capacity)):
                    part = data[at:at + 4 * capacity]
                    rows.append(i)
                    pieces.append(k)
                    starts.append(at // 4)
                    lengths.append(len(part) // 4)
                    ids.append(part)
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(rows)).cast(pa.int64()), pa.array(pieces, pa.int32()),
                     pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), pa.array(ids, pa.binary())],
                    names=["doc_id", "piece", "start", "length", "ids"])

    return slim(docs, "doc_id", "text").mapInArrow(
        cut, "doc_id long, piece int, start long, length long, ids binary")


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Rows (length, first rank, first sequence, pieces a sequence, offset) by
    length and rank, from the number of pieces of each length."""
    left = dict(histogram)
    rank: dict[int, int] = defaultdict(int)
    gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)  # gap -> runs of sequences (first, count)
    sizes: list[int] = []  # gaps that have runs, rising
    out: list[tuple[int, int, int, int, int]] = []
    n_seq = 0

    def place(length: int, n: int, first: int, each: int, offset: int) -> None:
        out.append((length, rank[length], first, each, offset))
        rank[length] += n
        left[length] -= n

    def leave(gap: int, first: int, count: int) -> None:
        if gap and count:
            if not gaps[gap]:
                bisect.insort(sizes, gap)
            gaps[gap].append((first, count))

    large = sorted((x for x in left if 3 * x > capacity), reverse=True)
    for a in large:
        mates = iter(b for b in large if b <= min(a, capacity - a))
        while left[a]:
            b = next((b for b in mates if left[b] and (b != a or left[a] > 1)), None)
            if b is None:
                m = left[a]
                place(a, m, n_seq, 1, 0)
                leave(capacity - a, n_seq, m)
            elif b == a:
                m = left[a] // 2
                place(a, 2 * m, n_seq, 2, 0)
                leave(capacity - 2 * a, n_seq, m)
            else:
                m = min(left[a], left[b])
                place(a, m, n_seq, 1, 0)
                place(b, m, n_seq, 1, a)
                leave(capacity - a - b, n_seq, m)
            n_seq += m
    for length in sorted((x for x in left if 3 * x <= capacity), reverse=True):
        while n := left[length]:
            at = bisect.bisect_left(sizes, length)
            if at == len(sizes):
                gap, first, count = capacity, n_seq, -(-n // (capacity // length))
                n_seq += count
            else:
                gap = sizes[at]
                first, count = gaps[gap].pop()
                if not gaps[gap]:
                    sizes.pop(at)
            each = gap // length
            m = min(n, count * each)
            full, rest = divmod(m, each)
            place(length, m, first, each, capacity - gap)
            leave(gap - each * length, first, full)
            leave(gap - rest * length, first + full, int(rest > 0))
            used = full + (rest > 0)
            leave(gap, first + used, count - used)
    return np.array(sorted(out), dtype=np.int64).reshape(-1, 5)


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (any columns, with ``length`` from 1 to ``capacity``) with
    ``sequence_id`` and ``offset``."""
    salts = 4 * shuffle_width(pieces.sparkSession)
    cols = pieces.columns
    fixed = stage(pieces.withColumn("_salt", F.monotonically_increasing_id() % salts), "op9-pieces")
    by_salt = fixed.groupBy("length", "_salt").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    base = by_salt.select("length", "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    histogram = {x["length"]: x["n"] for x in
                 fixed.groupBy("length").agg(F.count("*").alias("n")).collect()}  # capacity rows at most
    table = plan(histogram, capacity)
    wide = np.int64(1) << 40  # ranks of one length stay below
    starts = table[:, 0] * wide + table[:, 1]

    @F.arrow_udf("struct<sequence_id: long, offset: long>")
    def place(length, rank):
        import pyarrow as pa
        n, r = length.to_numpy(zero_copy_only=False), rank.to_numpy(zero_copy_only=False)
        row = table[np.searchsorted(starts, n * wide + r, side="right") - 1] if len(n) else table[:0]
        j = r - row[:, 1]
        return pa.StructArray.from_arrays(
            [pa.array(row[:, 2] + j // np.maximum(row[:, 3], 1), pa.int64()),
             pa.array(row[:, 4] + j % np.maximum(row[:, 3], 1) * n, pa.int64())], ["sequence_id", "offset"])

    own = Window.partitionBy("length", "_salt").orderBy(F.xxhash64(*cols))
    ranked = (fixed.withColumn("_r", F.row_number().over(own) - 1).join(base, ["length", "_salt"])
              .withColumn("_place", place(F.col("length"), (F.col("_base") + F.col("_r")).cast("long"))))
    return ranked.select(*cols, "_place.sequence_id", "_place.offset")


def pack_documents(docs: DataFrame, tokenizer_file: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece.
    (For the ids themselves, call :func:`tokenize_pieces` and :func:`pack`.)"""
    pieces = tokenize_pieces(docs, tokenizer_file, capacity).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return pack(pieces, capacity)
