"""Operator 13, alignment of two tokenizers by pointer jumping.

Both tokenizers cut the same bytes, so their tokens are intervals, and two
tokens of different tokenizers are linked if their intervals overlap. Every
token points to its farthest-right overlapping token (one of the other
tokenizer; the token of A itself where both end); replacing each pointer by its
pointer's pointer doubles the steps, so after a logarithm of rounds every token
points to the terminal token of its component, which labels its group. All
documents of a block of text do this in the same arrays.

Counts of id pairs are corpus-wide and come back to the documents through
dictionaries: a block of about ``BLOCK_BYTES`` of text is one row that holds its
documents' links as places in the block's own sorted list of different pairs.
Only that list is exploded, joined with the counts and handed back, once a pair
and block, however often the pair occurs there; links never move on their own,
and no list grows with a group of copies.

Defined results: texts that are null, empty, or not given back byte for byte by
both tokenizers have no tokens and zeros; a very long text is a block of its own;
repeated rows count as documents each, a null doc_id stays null; an empty table
gives no rows; other columns are dropped.
"""

from __future__ import annotations

import hashlib
import json
import struct

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sftforge.llm.bytebpe import MEMO_WORDS, ByteEncoder, packed
from sftforge.llm.common import bounded_batches, once_a_worker, slim, stage
from sftforge.llm.op10_sentencepiece import Encoder
from sftforge.llm.sentencepiece_model import BYTE, SPACE

#: Bytes of text of a block, and of the part of it that is worked on at once.
BLOCK_BYTES = 16 << 20
PART_BYTES = 1 << 20


class SideA:
    """Ids and token bytes of the byte-level tokenizer."""

    def __init__(self, file: bytes):
        self.encoder = ByteEncoder.of(file, plain_specials=True)
        back = {self.encoder.spelling.get(b, chr(b)): b for b in range(256)}
        config = json.loads(file)
        vocab = dict(config["model"]["vocab"]) | {x["content"]: x["id"] for x in config["added_tokens"]}
        self.bytes = [b""] * (max(vocab.values()) + 1)
        for piece, i in vocab.items():
            self.bytes[i] = bytes(back[c] for c in piece) if all(c in back for c in piece) else piece.encode()

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        return [np.frombuffer(self.encoder.encode(" " + t), "<u4") for t in texts]


class SideB(dict):
    """Ids and token bytes of the sentencepiece model; word -> its ids. Where no
    piece crosses a space mark and texts are not normalised, the ids of words
    that one space separates are those of the words on their own."""

    def __init__(self, file: bytes):
        super().__init__()
        import sentencepiece
        encoder = Encoder(file)
        self.library = sentencepiece.SentencePieceProcessor(model_proto=file)  # the model as it is
        self.merges, m, n = encoder.merges, encoder.model, encoder.normalize  # the merges see marks, not spaces
        self.by_word = (m.dummy_prefix and m.escape_spaces and encoder.segments.pattern.startswith(SPACE)
                        and not (n.map.units or n.fixed or m.extra_spaces or m.space_suffix))
        self.bytes = [bytes([int(p[1:-1], 16)]) if k == BYTE else p.replace(SPACE, " ").encode()
                      for p, k in zip(m.pieces, m.kinds)]

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        if not self.by_word:
            return [np.array(ids, np.uint32) for ids in self.library.encode(texts, num_threads=1)]
        cut = [t.split(" ") for t in texts]
        odd = [i for i, words in enumerate(cut) if "" in words or SPACE in texts[i]]
        if len(self) > MEMO_WORDS:
            self.clear()
        new = list(set().union(*cut).difference(self))
        self.update(zip(new, map(packed, self.merges.encode([SPACE + w for w in new], num_threads=1))))
        out = [np.frombuffer(b"".join([self[w] for w in words]), "<u4") for words in cut]
        for i, ids in zip(odd, self.library.encode([texts[i] for i in odd], num_threads=1)):
            out[i] = np.array(ids, np.uint32)
        return out


def groups_of(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Terminal token (an index of A) of the component of each token of A and of
    B; the ends are increasing, and both last ones are equal."""
    n = len(ends_a)
    over_a = np.searchsorted(ends_b, ends_a)  # the token of B that holds the last byte
    over_b = np.searchsorted(ends_a, ends_b)
    at = np.arange(n)
    points = np.concatenate([np.where(ends_b[over_a] > ends_a, n + over_a, at), over_b])
    while True:
        onward = points[points]
        if (onward == points).all():
            return points[:n], points[n:]
        points = onward


def links_of(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(token of A, token of B) of every overlap: one for each place where a token ends."""
    place = np.sort(np.concatenate([ends_a, ends_b]), kind="stable")  # merges two sorted runs
    place = place[np.r_[place[1:] != place[:-1], True]]
    return np.searchsorted(ends_a, place), np.searchsorted(ends_b, place)


class Aligner:
    """Documents of a part of a block at once."""

    def __init__(self, file_a: bytes, file_b: bytes):
        self.a, self.b = SideA(file_a), SideB(file_b)
        self.size_a, self.size_b = (np.array([len(x) for x in s.bytes], np.int64) for s in (self.a, self.b))
        self.table_a, self.table_b = (np.array([*s.bytes, None], object)[:-1] for s in (self.a, self.b))
        self.text_a = [np.array([b"%d%c" % (i, c) for i in range(len(self.a.bytes))] + [None], object)[:-1]
                       for c in (44, 124)]  # a comma, or a bar after a group's last
        self.text_b = [np.array([b"%d%c" % (i, c) for i in range(len(self.b.bytes))] + [None], object)[:-1]
                       for c in (44, 59)]

    def __call__(self, texts: list[str | None]):
        """Arrays of each text: n_a, n_b, n_groups, n_links, digests; and (text,
        pair, times) of its different links, pair = A id * 2**32 + B id."""
        n = len(texts)
        some = [i for i, t in enumerate(texts) if t]
        plain = [texts[i] for i in some]
        ids_a, ids_b = self.a(plain), self.b(plain)
        keep = []
        for k, text in enumerate(plain):
            whole = b" " + text.encode()
            if (b"".join(self.table_a[ids_a[k]].tolist()) == whole
                    and b"".join(self.table_b[ids_b[k]].tolist()) == whole):
                keep.append(k)
        doc = np.array([some[k] for k in keep], np.int64)
        n_a, n_b, n_groups, n_links = (np.zeros(n, np.int64) for _ in range(4))
        digest = [""] * n
        if not keep:
            none = np.zeros(0, np.int64)
            return n_a, n_b, n_groups, n_links, digest, none, none.astype(np.uint64), none
        len_a, len_b = (np.array([len(x[k]) for k in keep]) for x in (ids_a, ids_b))
        a = np.concatenate([ids_a[k] for k in keep]).astype(np.int64)
        b = np.concatenate([ids_b[k] for k in keep]).astype(np.int64)
        # documents follow each other in one line of bytes; each ends with a token of both
        ends_a, ends_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        doc_a = np.repeat(doc, len_a)
        group_a, group_b = groups_of(ends_a, ends_b)
        is_last = group_a == np.arange(len(a))
        n_a[doc], n_b[doc] = len_a, len_b
        n_groups += np.bincount(doc_a[is_last], minlength=n)
        self._digests(digest, doc, a, b, len_a, len_b, group_a, group_b, is_last)
        i, j = links_of(ends_a, ends_b)
        where = doc_a[i]
        n_links += np.bincount(where, minlength=n)
        pair = (a[i].astype(np.uint64) << np.uint64(32)) | b[j].astype(np.uint64)
        order = np.lexsort((pair, where))
        where, pair = where[order], pair[order]
        new = np.flatnonzero(np.r_[True, (pair[1:] != pair[:-1]) | (where[1:] != where[:-1])])
        return n_a, n_b, n_groups, n_links, digest, where[new], pair[new], np.diff(np.r_[new, len(pair)])

    def _digests(self, digest, doc, a, b, len_a, len_b, group_a, group_b, is_last) -> None:
        """SHA-256 of ``a1,a2|b1;a3|b2,b3`` of each document."""
        before = np.cumsum(is_last) - is_last  # groups that are complete before each token of A
        terminals = np.flatnonzero(is_last)
        group_of_b = before[group_b]
        many_b = np.cumsum(np.bincount(group_of_b, minlength=len(terminals)))  # tokens of B up to each group
        at_a = np.arange(len(a)) + np.r_[0, many_b][before]
        at_b = np.arange(len(b)) + terminals[group_of_b] + 1
        out = np.empty(len(a) + len(b), object)
        out[at_a] = np.where(is_last, self.text_a[1][a], self.text_a[0][a])
        last_b = np.r_[group_of_b[1:] != group_of_b[:-1], True]
        out[at_b] = np.where(last_b, self.text_b[1][b], self.text_b[0][b])
        out, at = out.tolist(), 0
        for i, size in zip(doc.tolist(), (len_a + len_b).tolist()):
            digest[i] = hashlib.sha256(b"".join(out[at:at + size])[:-1]).hexdigest()
            at += size


def put(*arrays) -> bytes:
    """Numbers as compressed bytes, the low bytes of all first."""
    import zstandard
    coder, out = zstandard.ZstdCompressor(level=1), []
    for x in arrays:
        planes = np.ascontiguousarray(np.asarray(x, "<u4").view(np.uint8).reshape(-1, 4).T)
        data = coder.compress(planes.tobytes())
        out += [struct.pack("<Q", len(data)), data]
    return b"".join(out)


def take(data: bytes) -> list[np.ndarray]:
    import zstandard
    coder, out, at = zstandard.ZstdDecompressor(), [], 0
    while at < len(data):
        (size,) = struct.unpack_from("<Q", data, at)
        planes = np.frombuffer(coder.decompress(data[at + 8:at + 8 + size]), np.uint8).reshape(4, -1)
        out.append(np.ascontiguousarray(planes.T).view("<u4").ravel())
        at += 8 + size
    return out


BLOCK = ("block long, pairs binary, held binary, links binary, doc_id array<long>, n_a array<long>, n_b array<long>, "
         "n_groups array<long>, n_links array<long>, groups_sha256 array<string>")


def align_blocks(docs: DataFrame, file_a: str, file_b: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row a block: its different pairs (as big-endian numbers, sorted), in how
    many of its documents each is held, the documents' links as places in that list,
    and the documents' own results. The tokenizer files (fixed, small) are broadcast."""
    spark = docs.sparkSession
    with open(file_a, "rb") as f, open(file_b, "rb") as g:
        files = spark.sparkContext.broadcast((f.read(), g.read()))

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext
        name = "aligner " + hashlib.sha256(files.value[0] + files.value[1]).hexdigest()
        aligner, number = once_a_worker(name, lambda: Aligner(*files.value)), TaskContext.get().partitionId() << 32
        schema = pa.schema([("block", pa.int64()), *[(c, pa.binary()) for c in ("pairs", "held", "links")],
                            *[(c, pa.list_(pa.int64())) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")],
                            ("groups_sha256", pa.list_(pa.string()))])
        texts, doc_ids, size, parts, total = [], [], 0, [], 0

        def closed():
            nonlocal number
            first = np.cumsum([0] + [len(p[0]) for p in parts])
            doc = np.concatenate([p[6] + at for p, at in zip(parts, first)])
            pair = np.concatenate([p[7] for p in parts])
            times = np.concatenate([p[8] for p in parts])
            pairs, place, held = np.unique(pair, return_inverse=True, return_counts=True)
            starts = np.r_[True, doc[1:] != doc[:-1]] if len(doc) else np.zeros(0, bool)
            step = np.diff(place, prepend=0)
            step[starts] = place[starts]  # places grow within a document
            row = {"block": number, "pairs": pairs.astype(">u8").tobytes(), "held": put(held),
                   "links": put(np.bincount(doc, minlength=first[-1]), step, times),
                   "doc_id": sum([p[0] for p in parts], []), "groups_sha256": sum([p[5] for p in parts], [])}
            for c, k in (("n_a", 1), ("n_b", 2), ("n_groups", 3), ("n_links", 4)):
                row[c] = np.concatenate([p[k] for p in parts])
            number += 1
            return pa.RecordBatch.from_arrays([pa.array([row[f.name]], f.type) for f in schema], schema=schema)

        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
                text = text.as_py()
                texts.append(text)
                doc_ids.append(doc_id)
                size += len(text or "") + 1
                if size >= PART_BYTES:
                    parts.append((doc_ids, *aligner(texts)))
                    total += size
                    texts, doc_ids, size = [], [], 0
                    if total >= block_bytes:
                        yield closed()
                        parts, total = [], 0
        if texts:
            parts.append((doc_ids, *aligner(texts)))
        if parts:
            yield closed()

    return slim(docs, "doc_id", "text").mapInArrow(run, BLOCK)


def _pairs_of(batches):
    """(block, pairs, held) -> block, place, pair, held."""
    import pyarrow as pa
    for b in batches:
        for block, pairs, held in zip(*b.columns):
            pair = np.frombuffer(pairs.as_py(), ">u8").astype(np.int64)
            held = take(held.as_py())[0].astype(np.int64)
            for at in range(0, len(pair), 1 << 16):  # rows of some kilobytes each leave in short batches
                here = pair[at:at + (1 << 16)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(here), block.as_py())), pa.array(np.arange(at, at + len(here), dtype=np.int32)),
                     pa.array(here), pa.array(held[at:at + (1 << 16)])], names=["block", "place", "pair", "held"])


RESULT = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
          "groups_sha256 string")


def _finish(blocks, answers):
    """A block's row and the (place, n, best) of all its pairs -> its documents."""
    import pyarrow as pa
    fields = [(c, pa.int64()) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")]
    schema = pa.schema([*fields, ("groups_sha256", pa.string())])
    if not blocks.num_rows:
        return schema.empty_table()
    row = {c: blocks[c][0] for c in blocks.column_names}
    place = answers["place"].to_numpy()
    n, best = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
    n[place], best[place] = answers["n"].to_numpy(), answers["best"].to_numpy().astype(np.int64)
    sizes, step, times = (x.astype(np.int64) for x in take(row["links"].as_py()))
    edge = np.cumsum(np.r_[0, sizes])
    line = np.cumsum(step)  # a document's first step is its place itself
    starts = edge[:-1][sizes > 0]
    line -= np.repeat(np.r_[0, line[starts[1:] - 1]] if len(starts) else line, sizes[sizes > 0])
    out = {}
    for name, value in (("n_best", best), ("count_sum", n)):
        sums = np.r_[0, np.cumsum(value[line] * times)]
        out[name] = sums[edge[1:]] - sums[edge[:-1]]
    columns = [pa.array(out[f.name]) if f.name in out else row[f.name].values for f in schema]
    return pa.table(columns, schema=schema)


def align(docs: DataFrame, file_a: str, file_b: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row."""
    blocks = stage(align_blocks(docs, file_a, file_b, block_bytes), "op13-blocks")
    bounded_batches(docs.sparkSession)
    entries = blocks.select("block", "pairs", "held").mapInArrow(
        _pairs_of, "block long, place int, pair long, held long")
    counts = stage(entries.groupBy("pair").agg(F.sum("held").alias("n")).withColumn(
        "a", F.shiftright("pair", 32)), "op13-counts")
    most = counts.groupBy("a").agg(F.max("n").alias("most"))
    judged = counts.join(most, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))
    answers = entries.select("block", "place", "pair").join(judged, "pair").select("block", "place", "n", "best")
    met = (blocks.drop("pairs", "held").groupBy("block").cogroup(answers.groupBy("block"))
           .applyInArrow(_finish, RESULT))
    return met
