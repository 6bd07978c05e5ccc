"""Words and word shingles of many texts at once, as 64-bit hashes in numpy."""

from __future__ import annotations

import numpy as np

#: Texts are worked on in chunks of about so many bytes (a longer text is a chunk of its own).
CHUNK_BYTES = 1 << 19

_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True
_BYTE = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: For folded words: runs of ASCII letters and digits and of other characters, upper case as lower.
_LETTER = np.array([chr(b).isalnum() or b > 127 for b in range(256)])
_FOLDED = _BYTE[np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)])]
_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit numbers."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base, and of its inverse."""
    def of(base: int) -> np.ndarray:
        out = np.full(max(n, 1), base, np.uint64)
        out[0] = 1
        return np.cumprod(out, dtype=np.uint64)

    return of(_BASE), of(pow(_BASE, -1, 1 << 64))


class Words:
    """Words of a chunk: byte range, document and hash of each; first word and
    number of words of each document."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, tables: tuple | None = None, folded: bool = False):
        self.n_docs = len(offsets) - 1
        self.data, self.offsets = data, offsets
        ink = _LETTER[data] if folded else ~_WHITE[data]
        before, after = np.zeros(len(ink), bool), np.zeros(len(ink), bool)
        before[1:], after[:-1] = ink[:-1], ink[1:]
        inner = offsets[(offsets > 0) & (offsets < len(ink))]
        before[inner] = False
        after[inner - 1] = False
        self.start = np.flatnonzero(ink & ~before)
        self.end = np.flatnonzero(ink & ~after) + 1
        self.doc = np.searchsorted(offsets, self.start, side="right") - 1
        self.first = np.searchsorted(self.doc, np.arange(self.n_docs))
        self.count = np.diff(np.append(self.first, len(self.doc)))
        power, inverse = tables or powers(len(data))
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((_FOLDED if folded else _BYTE)[data] * power[:len(data)], out=total[1:])
        self.hash = mix((total[self.end] - total[self.start]) * inverse[self.start])


def windows(hashes: np.ndarray, width: int, salt: int = 0) -> np.ndarray:
    """Hash of the ``width`` words from each word on (the last ones run short)."""
    out = np.full(len(hashes), salt, np.uint64)
    for j in range(min(width, len(hashes))):
        factor = np.uint64(pow(0xD6E8FEB86659FD93, j + 1, 1 << 64))
        out[:len(hashes) - j] += hashes[j:] * factor
    return mix(out)


def shingles(w: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, document) of each shingle of ``width`` words; a document of fewer
    words has one shingle, the whole of it."""
    whole = windows(w.hash, width)
    fits = np.flatnonzero(w.doc[:len(w.doc) - width + 1] == w.doc[width - 1:]) if len(w.doc) >= width else []
    out, doc = [whole[fits]], [w.doc[fits]]
    for n in range(1, width):
        short = np.flatnonzero(w.count == n)
        if len(short):
            out.append(windows(w.hash, n, salt=n)[w.first[short]])
            doc.append(short)
    return np.concatenate(out), np.concatenate(doc)


def chunks(texts, folded: bool = False):
    """(first row, number of rows, Words) over an Arrow column of texts; null counts as empty."""
    import pyarrow as pa
    import pyarrow.compute as pc
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if not len(texts):
        return
    _, where, buffer = texts.buffers()
    offsets = np.frombuffer(where, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None and buffer.size else np.zeros(0, np.uint8)
    at, tables = 0, powers(0)
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + CHUNK_BYTES, side="right")) - 1)
        size = int(offsets[to] - offsets[at])
        if size > len(tables[0]):
            tables = powers(max(size, CHUNK_BYTES))
        yield at, to - at, Words(data[offsets[at]:offsets[to]], offsets[at:to + 1] - offsets[at], tables, folded)
        at = to
