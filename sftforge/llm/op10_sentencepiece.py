"""Operator 10, sentencepiece encoding and decoding that keeps source offsets.

Encoding normalises a text through the model's compiled character map: at each
place the longest key of the map is replaced, else one character stays. Every
normalised byte records the source byte it comes from. The normalised text is
cut before each run of space marks, which no piece of such a model crosses (the
vocabulary is checked; a model with a piece that does is given whole texts);
the segments go through the model's merges once a task each and are remembered.
A piece's normalised bytes then project to the bytes of the source text that it
covers. Ids are exactly those of the library's own ``encode``.

Decoding joins the pieces' bytes: space marks turn into spaces, the added first
one goes, byte pieces join to characters, and a byte that is part of none
becomes U+FFFD.

Defined results: a very long text is worked on whole, by the task that holds it;
a null or empty text has no ids and decodes to the empty text;
null or control ids decode to nothing; ties cannot occur (the model orders its
merges); repeated rows are encoded each; an empty table gives no rows; other
columns are dropped.
"""

from __future__ import annotations

import codecs
import re
from array import array

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sftforge.llm.common import slim
from sftforge.llm.sentencepiece_model import BYTE, CONTROL, SPACE, UNKNOWN, USER_DEFINED, CharMap, Model

#: Segments whose ids a task remembers at most; beyond it, it forgets them all.
MEMO_SEGMENTS = 300_000
#: Rows leave a task in batches of texts of about so many bytes.
OUT_BYTES = 4 << 20
# Fixed value: how the library spells an unknown piece.
UNKNOWN_TEXT = " ⁇ "


class Normalizer:
    """Longest-prefix normalisation with alignment."""

    def __init__(self, model: Model):
        self.model = model
        self.map = CharMap(model.char_map)
        fixed = [p for p, k in zip(model.pieces, model.kinds) if k == USER_DEFINED]
        self.fixed = sorted((p.encode() for p in fixed), key=len, reverse=True)

    def prefix(self, data: bytes, at: int) -> tuple[int, bytes]:
        """(source bytes used, normalised bytes) at a place."""
        for p in self.fixed:
            if data.startswith(p, at):
                return len(p), p
        if found := self.map.longest(data, at):
            return found
        lead = data[at]
        n = 1 + (lead >= 0xC0) + (lead >= 0xE0) + (lead >= 0xF0)
        return n, data[at:at + n]

    def __call__(self, text: str) -> tuple[bytes, np.ndarray]:
        """(normalised bytes, source byte of each and of the end)."""
        m, data = self.model, text.encode()
        mark = SPACE.encode() if m.escape_spaces else b" "
        if not (self.map.units or self.fixed or m.extra_spaces or m.space_suffix):
            if not data:
                return b"", np.zeros(1, np.int64)
            raw = np.frombuffer(data, np.uint8)
            origin = np.repeat(np.arange(len(raw)), np.where(raw == 32, len(mark), 1))
            head = mark if m.dummy_prefix else b""
            return head + data.replace(b" ", mark), np.concatenate(
                [np.zeros(len(head), np.int64), origin, [len(raw)]])
        out, origin, at = bytearray(), array("q"), 0
        while m.extra_spaces and at < len(data):
            n, part = self.prefix(data, at)
            if part != b" ":
                break
            at += n
        if at == len(data):
            return b"", np.full(1, at, np.int64)

        def put(part: bytes, source: int) -> None:
            out.extend(part)
            origin.extend([source] * len(part))

        if m.dummy_prefix and not m.space_suffix:
            put(mark, at)
        after_space = m.extra_spaces
        while at < len(data):
            n, part = self.prefix(data, at)
            if after_space:
                part = part.lstrip(b" ")
            if part:
                put(part.replace(b" ", mark), at)
                after_space = part.endswith(b" ")
            at += n
            after_space = after_space and m.extra_spaces
        while m.extra_spaces and out.endswith(mark):
            at = origin[-len(mark)]
            del out[-len(mark):], origin[-len(mark):]
        if m.dummy_prefix and m.space_suffix:
            put(mark, at)
        return bytes(out), np.array([*origin, at], np.int64)


class Encoder(dict):
    """normalised segment -> ids, as 32-bit numbers."""

    def __init__(self, file: bytes):
        import sentencepiece
        super().__init__()
        self.model = Model.parse(file)
        self.normalize = Normalizer(self.model)
        self.merges = sentencepiece.SentencePieceProcessor(model_proto=self.model.plain)
        bare = [p.lstrip(SPACE) for p, k in zip(self.model.pieces, self.model.kinds) if k != USER_DEFINED]
        parts = not self.normalize.fixed and not any(SPACE in p for p in bare) and not self.model.space_suffix
        self.segments = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+" if parts else "(?s:.+)")
        self.sizes = np.array([1 if k == BYTE else len(p.encode())
                               for p, k in zip(self.model.pieces, self.model.kinds)], np.int64)
        self.unknown = self.model.kinds.index(UNKNOWN)

    def learn(self, segments: set[str]) -> None:
        """Remember the ids of segments, which the merges see together."""
        new = [s for s in segments if s not in self]
        if len(self) + len(new) > MEMO_SEGMENTS:
            self.clear()
            new = list(segments)
        for s, ids in zip(new, self.merges.encode(new)):
            self[s] = array("i", ids).tobytes()

    def pieces(self, ids: np.ndarray, segments: list[str]) -> np.ndarray:
        """Normalised bytes of each piece. An unknown one covers what the text holds there."""
        sizes = self.sizes[ids]
        if (ids == self.unknown).any():
            held = [p for s in segments for p in self.merges.encode(s, out_type=str)]
            at = np.flatnonzero(ids == self.unknown)
            sizes[at] = [len(held[i].encode()) for i in at]
        return sizes

    def encode_all(self, texts: list[str]):
        """ids, and the first and last + 1 byte of the source that each piece
        covers, of each text."""
        normal = [self.normalize(t) for t in texts]
        cut = [self.segments.findall(norm.decode()) for norm, _ in normal]
        self.learn(set().union(*cut))
        for (_, origin), segments in zip(normal, cut):
            ids = np.frombuffer(b"".join([self[s] for s in segments]), np.int32)
            edge = np.zeros(len(ids) + 1, np.int64)
            np.cumsum(self.pieces(ids, segments), out=edge[1:])
            at = origin[edge]
            yield ids, at[:-1], at[1:]


def _each_byte(error):
    return "�" * (error.end - error.start), error.end


class Decoder:
    def __init__(self, file: bytes):
        m = Model.parse(file)
        self.strip_one = m.dummy_prefix or m.extra_spaces
        self.strip_all = m.extra_spaces
        self.bytes = [b"" if k == CONTROL else UNKNOWN_TEXT.encode() if k == UNKNOWN
                      else bytes([int(p[1:-1], 16)]) if k == BYTE else p.replace(SPACE, " ").encode()
                      for p, k in zip(m.pieces, m.kinds)]
        codecs.register_error("each_byte", _each_byte)

        self.table = np.array([*self.bytes, None], object)[:-1]
        self.odd = np.array([k in (CONTROL, UNKNOWN, BYTE) for k in m.kinds])
        self.is_control = np.array([k == CONTROL for k in m.kinds])

    def decode(self, ids) -> str:
        ids = np.asarray(ids, np.int64)
        parts = self.table[ids].tolist()
        if self.strip_one:
            for k, part in enumerate(parts):
                if self.odd[ids[k]]:
                    if part:
                        break
                elif part.startswith(b" "):
                    parts[k] = part[1:]
                    if parts[k] or not self.strip_all:
                        break
                elif part:
                    break
        cuts = np.flatnonzero(self.is_control[ids])
        if len(cuts):  # a control id also ends a run of byte pieces
            runs = [parts[a + 1:b] for a, b in zip([-1, *cuts], [*cuts, len(ids)])]
        else:
            runs = [parts]
        return "".join(b"".join(x).decode("utf-8", "each_byte") for x in runs)


def encode(docs: DataFrame, model_file: str) -> DataFrame:
    """doc_id, ids, and the arrays ``starts`` and ``ends`` of the bytes of the
    text that each id covers. The model file (a fixed, small one) is broadcast."""
    file = _sent(docs, model_file)

    def run(batches):
        import pyarrow as pa
        encoder = Encoder(file.value)

        def lists(arrays) -> pa.Array:
            edge = np.cumsum([0] + [len(x) for x in arrays], dtype=np.int32)
            return pa.ListArray.from_arrays(pa.array(edge), pa.array(np.concatenate(arrays).astype(np.int32)))

        for b in batches:
            texts, size, at = [], 0, 0
            for i, text in enumerate(b.column(1), 1):
                texts.append(text.as_py() or "")
                size += len(texts[-1])
                if size >= OUT_BYTES or i == b.num_rows:
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).slice(at, i - at).cast(pa.int64()), *map(lists, zip(*encoder.encode_all(texts)))],
                        names=["doc_id", "ids", "starts", "ends"])
                    texts, size, at = [], 0, i

    return slim(docs, "doc_id", "text").mapInArrow(
        run, "doc_id long, ids array<int>, starts array<int>, ends array<int>")


def decode(docs: DataFrame, model_file: str):
    """Column function: an array of ids -> the text."""
    file = _sent(docs, model_file)

    @F.arrow_udf("string")
    def text(ids):
        import pyarrow as pa
        decoder = Decoder(file.value)
        out = []
        for x in ids:
            row = x.values
            out.append("" if row is None else decoder.decode(row.drop_null().to_numpy()))
        return pa.array(out, pa.string())

    return text


def _sent(docs: DataFrame, model_file: str):
    with open(model_file, "rb") as f:
        return docs.sparkSession.sparkContext.broadcast(f.read())
