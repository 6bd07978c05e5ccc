"""Operator 11, token ids on disk as directly addressable codes.

An id's bits are split into chunks, lowest first. Level 1 holds the first chunk
of every id, level 2 the second chunk of the ids that have one, and so on. Each
level but the last has a bitmap that says which of its entries continue, and a
directory of ranks (64-bit counts before each 65,536 bits, 16-bit counts before
each 64 bits inside): the number of continuing entries before one is its place
in the next level. So the id at any position is found with one step a level,
and nothing before it is decoded. The chunk widths of a file are those of least
total size for its own ids, from the histogram of their lengths in bits.

Writing: rows are range-partitioned and sorted by doc_id; each task encodes its
texts in order and closes a file as soon as it holds ``FILE_IDS`` ids, always at
the end of a document. Files go through Spark's own text writer, one a record,
so a lost task writes its files again. Their names order them.

Reading: :class:`Codes` opens a file's bytes; ``codes[i]`` is any id,
``codes.at(positions)`` many, ``codes.span(start, n)`` a run. A file names its
documents and where each starts; starts across files are running sums over one
number for each file.

Defined results: a null or empty text has the end id alone; very long texts are
whole documents of one file, which then is longer; rows that repeat a doc_id
follow each other in the order of their texts' hashes, repeated rows are kept
each; rows without doc_id come first and keep a null; an empty table writes no
file and gives no rows; other columns are dropped.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sftforge.llm.bytebpe import ByteEncoder
from sftforge.llm.common import STAGED, scratch, shuffle_width, slim, stage, text_or_empty

END_ID = 2
#: A file is closed by the document with which it holds so many ids.
FILE_IDS = 1 << 21
# Fixed values of the format: mark, header, numbers a block of work.
MAGIC = b"DACODES1"
HEADER = "<8sQQQ"  # mark, ids, documents, levels
LEVEL = "<QQ"  # width, entries
SUPER, WORD = 1 << 16, 64
STEP = 1 << 16


def widths_of(lengths: np.ndarray) -> list[int]:
    """Chunk widths of least total size; ``lengths[b]`` ids have b bits. A
    level of width w costs w bits an entry, and 1.25 more if another follows
    (its bitmap and directory). At most 8 bits a chunk."""
    top = max([b for b in range(len(lengths)) if lengths[b]] + [1])
    over = [int(lengths.sum())] + [int(lengths[b + 1:].sum()) for b in range(1, top + 1)]  # ids longer than b bits
    best: list = [None] * top + [(0.0, [])]
    for b in range(top - 1, -1, -1):
        for w in range(1, min(8, top - b) + 1):
            rest = best[b + w]
            if rest is not None:
                cost = over[b] * (w + (1.25 if b + w < top else 0)) + rest[0]
                if best[b] is None or cost < best[b][0]:
                    best[b] = (cost, [w, *rest[1]])
    return best[0][1]


def pack_bits(values: np.ndarray, width: int) -> bytes:
    """Numbers of ``width`` bits (8 at most) one after the other, highest bit
    first: eight of them make ``width`` bytes."""
    out = []
    for at in range(0, len(values), STEP):
        part = values[at:at + STEP]
        eights = np.zeros((-(-len(part) // 8), 8), np.uint64)
        eights.ravel()[:len(part)] = part
        line = np.zeros(len(eights), np.uint64)
        for i in range(8):
            line |= eights[:, i] << np.uint64(width * (7 - i))
        out.append(line.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - width:].tobytes())
    return b"".join(out) + b"\0"


def packed_size(n: int, width: int) -> int:
    return -(-n // 8) * width + 1  # one more, so that two bytes can be read from any number on


def unpack_at(data: np.ndarray, width: int, places: np.ndarray) -> np.ndarray:
    """The numbers at the given places."""
    bit = places * width
    byte = bit >> 3
    two = (data[byte].astype(np.uint32) << 8) | data[byte + 1]
    return (two >> (16 - width - (bit & 7)).astype(np.uint32)) & np.uint32((1 << width) - 1)


def unpack_run(data: np.ndarray, width: int, start: int, n: int) -> np.ndarray:
    """``n`` numbers from a place on."""
    first, last = start // 8, -(-(start + n) // 8)
    wide = np.zeros((last - first, 8), np.uint8)
    wide[:, 8 - width:] = data[first * width:last * width].reshape(-1, width)
    line, out = wide.view(">u8").ravel().astype(np.uint64), np.empty((last - first, 8), np.uint32)
    for i in range(8):
        out[:, i] = line >> np.uint64(width * (7 - i)) & np.uint64((1 << width) - 1)
    return out.ravel()[start - 8 * first:][:n]


class Bitmap:
    """Bits with a rank directory."""

    def __init__(self, words: np.ndarray, sums: np.ndarray, inside: np.ndarray):
        self.words, self.sums, self.inside = words, sums, inside

    @staticmethod
    def build(bits: np.ndarray) -> "Bitmap":
        n_words = len(bits) // WORD + 1  # one more, so that the rank after the last bit has a place
        raw = np.zeros(n_words * WORD // 8, np.uint8)
        packed = np.packbits(bits, bitorder="little")
        raw[:len(packed)] = packed
        words = raw.view("<u8")
        before = np.zeros(n_words, np.uint64)
        np.cumsum(np.bitwise_count(words[:-1]), out=before[1:])
        sums = before[::SUPER // WORD]
        inside = (before - np.repeat(sums, SUPER // WORD)[:n_words]).astype("<u2")
        return Bitmap(words, sums.astype("<u8"), inside)

    def tobytes(self) -> bytes:
        return self.words.tobytes() + self.sums.tobytes() + self.inside.tobytes()

    @staticmethod
    def read(data: bytes, at: int, n: int) -> tuple["Bitmap", int]:
        n_words = n // WORD + 1
        n_sums = -(-n_words // (SUPER // WORD))
        words = np.frombuffer(data, "<u8", n_words, at)
        sums = np.frombuffer(data, "<u8", n_sums, at + 8 * n_words)
        inside = np.frombuffer(data, "<u2", n_words, at + 8 * n_words + 8 * n_sums)
        return Bitmap(words, sums, inside), at + 10 * n_words + 8 * n_sums

    def get(self, places: np.ndarray) -> np.ndarray:
        return (self.words[places >> 6] >> (places & 63).astype(np.uint64)) & np.uint64(1) != 0

    def rank(self, places: np.ndarray) -> np.ndarray:
        """Set bits before each place."""
        word = places >> 6
        low = self.words[word] & ((np.uint64(1) << (places & 63).astype(np.uint64)) - np.uint64(1))
        return (self.sums[places >> 16] + self.inside[word] + np.bitwise_count(low)).astype(np.int64)


def write_codes(ids: np.ndarray, doc_ids: list, sizes: list[int]) -> bytes:
    """A file's bytes: ids of documents in a row, their doc_ids (null allowed) and numbers of ids."""
    ids = ids.astype(np.uint32)
    different, times = ids, None
    if len(ids) and ids.max() < 1 << 22:  # count ids before their bits
        times = np.bincount(ids)
        different = np.arange(len(times))
    lengths = np.bincount(np.frexp(different.astype(np.float64))[1], times, 2).astype(np.int64)  # bits of each id
    widths = widths_of(lengths)
    parts = [struct.pack(HEADER, MAGIC, len(ids), len(doc_ids), len(widths)),
             np.array([i or 0 for i in doc_ids], "<i8").tobytes(),
             np.array([i is not None for i in doc_ids], np.uint8).tobytes(),
             np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]).astype("<i8").tobytes()]
    rest = ids
    for k, w in enumerate(widths):
        parts += [struct.pack(LEVEL, w, len(rest)), pack_bits(rest & np.uint32((1 << w) - 1), w)]
        if k < len(widths) - 1:
            more = rest >> np.uint32(w)
            parts.append(Bitmap.build(more > 0).tobytes())
            rest = more[more > 0]
    return b"".join(parts)


class Codes:
    """Random access to a file of :func:`write_codes`."""

    def __init__(self, data: bytes):
        mark, self.n, n_docs, n_levels = struct.unpack_from(HEADER, data)
        if mark != MAGIC:
            raise ValueError(f"no file of token codes: {mark!r}")
        at = struct.calcsize(HEADER)
        known = np.frombuffer(data, np.uint8, n_docs, at + 8 * n_docs)
        self.doc_ids = [int(i) if k else None for i, k in zip(np.frombuffer(data, "<i8", n_docs, at), known)]
        at += 9 * n_docs
        self.edges = np.frombuffer(data, "<i8", n_docs + 1, at)
        at += 8 * (n_docs + 1)
        self.levels = []
        for k in range(n_levels):
            width, n = struct.unpack_from(LEVEL, data, at)
            at += struct.calcsize(LEVEL)
            size = packed_size(n, width)
            chunk, at = np.frombuffer(data, np.uint8, size, at), at + size
            bitmap = None
            if k < n_levels - 1:
                bitmap, at = Bitmap.read(data, at, n)
            self.levels.append((width, chunk, bitmap))

    def at(self, places) -> np.ndarray:
        """The ids at the given positions."""
        places = np.asarray(places, np.int64)
        if len(places) and (places.min() < 0 or places.max() >= self.n):
            raise IndexError(f"a position is not in 0 .. {self.n - 1}")
        out = np.zeros(len(places), np.uint32)
        open_, shift = np.arange(len(places)), 0
        for width, chunk, bitmap in self.levels:
            out[open_] |= unpack_at(chunk, width, places) << np.uint32(shift)
            if bitmap is None or not len(places):
                break
            more = bitmap.get(places)
            open_, places, shift = open_[more], bitmap.rank(places[more]), shift + width
        return out

    def __getitem__(self, place: int) -> int:
        return int(self.at([place])[0])

    def span(self, start: int, n: int) -> np.ndarray:
        """``n`` ids from a position on. Only the first one's rank is looked up on a level; those after it follow."""
        if not 0 <= start <= start + n <= self.n:
            raise IndexError(f"{start} .. {start + n} is not within 0 .. {self.n}")
        out, open_, shift = np.zeros(n, np.uint32), None, 0
        for width, chunk, bitmap in self.levels:
            values = unpack_run(chunk, width, start, n) << np.uint32(shift)
            if open_ is None:
                out = values
            else:
                out[open_] |= values
            if bitmap is None or not n:
                break
            words = bitmap.words[start >> 6:(start + n + 63) >> 6]
            more = np.unpackbits(words.view(np.uint8), bitorder="little")[start & 63:][:n].view(bool)
            start = int(bitmap.rank(np.array([start]))[0])
            open_ = np.flatnonzero(more) if open_ is None else open_[more]
            n, shift = len(open_), shift + width
        return out

    def document(self, k: int) -> np.ndarray:
        return self.span(int(self.edges[k]), int(self.edges[k + 1] - self.edges[k]))

    def documents(self):
        """Every document's ids, in order; short ones are read in runs of about ``STEP`` ids."""
        k, n_docs = 0, len(self.doc_ids)
        while k < n_docs:
            first = self.edges[k]
            end = max(k + 1, int(np.searchsorted(self.edges, first + STEP, "right")) - 1)
            run = self.span(int(first), int(self.edges[end] - first))
            for at in range(k, end):
                yield run[self.edges[at] - first:self.edges[at + 1] - first]
            k = end


def write_files(docs: DataFrame, path: str, tokenizer_file: str, end_id: int = END_ID,
                file_ids: int = FILE_IDS) -> None:
    """Write the ids of ``docs`` (doc_id, text; read from files, so that a task
    that runs again finds its rows in the same order) in ascending doc_id order."""
    spark = docs.sparkSession
    with open(tokenizer_file, "rb") as f:
        file = spark.sparkContext.broadcast(f.read())

    def run(batches):
        import pyarrow as pa
        encoder, end = ByteEncoder.of(file.value), struct.pack("<I", end_id)
        doc_ids, sizes, data, total = [], [], [], 0

        def closed():
            ids = np.frombuffer(b"".join(data), "<u4")
            return pa.RecordBatch.from_arrays([pa.array([write_codes(ids, doc_ids, sizes)], pa.binary())], ["codes"])

        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
                ids = encoder.encode(text.as_py()) + end
                doc_ids.append(doc_id)
                sizes.append(len(ids) // 4)
                data.append(ids)
                total += sizes[-1]
                if total >= file_ids:
                    yield closed()
                    doc_ids, sizes, data, total = [], [], [], 0
        if doc_ids:
            yield closed()

    # Copies of a row are dealt out by their place in the input, so that none fills a task.
    keys = "doc_id", "hash", "place"
    rows = slim(docs, "doc_id", "text").select("doc_id", text_or_empty(F.col("text")).alias("text"))
    rows = rows.withColumn("hash", F.xxhash64("text")).withColumn("place", F.monotonically_increasing_id())
    rows = rows.repartitionByRange(shuffle_width(spark), *keys).sortWithinPartitions(*keys)
    (rows.select("doc_id", "text").mapInArrow(run, "codes binary").select(F.col("codes").cast("string").alias("value"))
     .write.option("maxRecordsPerFile", 1).text(path))


def read_files(spark: SparkSession, path: str, per_document) -> DataFrame:
    """file (part and number, which order the files), k (place in the file),
    doc_id, first (ids before it in the file), n_tokens and ``value``, a long that
    the function ``per_document`` makes of each document's ids."""
    def run(batches):
        import os
        import re

        import pyarrow as pa
        names = ["part", "number", "k", "doc_id", "first", "n_tokens", "value"]
        kinds = [pa.int64()] * 7
        for b in batches:
            for file, content in zip(b.column(0).to_pylist(), b.column(1)):
                part, number = map(int, re.match(r"part-(\d+)-.*-c(\d+)", os.path.basename(file)).groups())
                codes = Codes(content.as_py())
                sizes = np.diff(codes.edges)
                n = len(sizes)
                columns = [[part] * n, [number] * n, range(n), codes.doc_ids, codes.edges[:-1], sizes,
                           [per_document(ids) for ids in codes.documents()]]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
    return files.mapInArrow(run, "part long, number long, k long, doc_id long, first long, n_tokens long, value long")


def crc_of(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def round_trip(docs: DataFrame, tokenizer_file: str, end_id: int = END_ID, file_ids: int = FILE_IDS) -> DataFrame:
    """Write ``docs`` to the shared folder and read the files back: doc_id,
    start (ids of all documents before it), n_tokens, ids_crc32."""
    spark = docs.sparkSession
    path = scratch(spark, "op11-codes")
    STAGED.append(path)
    write_files(docs, path, tokenizer_file, end_id, file_ids)
    rows = stage(read_files(spark, path, crc_of), "op11-documents", compact=False)
    before = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    files = rows.groupBy("part", "number").agg(F.sum("n_tokens").alias("n"))
    parts = files.groupBy("part").agg(F.sum("n").alias("n"))  # one row for each partition written
    parts = parts.select("part", before(Window.orderBy("part")).alias("base"))
    files = files.select("part", "number", before(Window.partitionBy("part").orderBy("number")).alias("own"))
    files = files.join(parts, "part").select("part", "number", (F.col("base") + F.col("own")).alias("base"))
    return rows.join(files, ["part", "number"]).select(
        "doc_id", (F.col("base") + F.col("first")).cast("long").alias("start"), "n_tokens",
        F.col("value").alias("ids_crc32"))
