"""A sentencepiece model file's parts: pieces, settings, compiled character map."""

from __future__ import annotations

import struct
from dataclasses import dataclass, field

# Field numbers of the public model format.
PIECES, TRAINER, NORMALIZER = 1, 2, 3
PIECE_TEXT, PIECE_SCORE, PIECE_TYPE = 1, 2, 3
NORM_NAME, NORM_MAP, NORM_DUMMY_PREFIX, NORM_EXTRA_SPACES, NORM_ESCAPE = 1, 2, 3, 4, 5
TRAINER_SUFFIX = 24
# Kinds of pieces.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6

SPACE = "▁"


def fields(data: bytes):
    """(number, value, raw bytes) of a protocol-buffer message; 64-bit kinds do not occur."""
    at = 0

    def varint() -> int:
        nonlocal at
        out = shift = 0
        while True:
            byte = data[at]
            at += 1
            out |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return out

    while at < len(data):
        began = at
        key = varint()
        kind = key & 7
        if kind == 0:
            value = varint()
        elif kind == 2:
            size = varint()
            value = data[at:at + size]
            at += size
        elif kind == 5:
            value = struct.unpack("<f", data[at:at + 4])[0]
            at += 4
        else:
            raise ValueError(f"field kind {kind}")
        yield key >> 3, value, data[began:at]


def _field(number: int, value: bytes) -> bytes:
    size, out = len(value), bytearray([number << 3 | 2])
    while size > 127:
        out.append(size & 127 | 128)
        size >>= 7
    return bytes(out) + bytes([size]) + value


@dataclass
class Model:
    pieces: list[str] = field(default_factory=list)
    kinds: list[int] = field(default_factory=list)
    char_map: bytes = b""
    dummy_prefix: bool = True
    extra_spaces: bool = True      # remove them
    escape_spaces: bool = True
    space_suffix: bool = False
    plain: bytes = b""             # the same model, whose own normaliser changes nothing

    @classmethod
    def parse(cls, data: bytes) -> Model:
        out, rest = cls(), []
        for number, value, raw in fields(data):
            if number == PIECES:
                piece = {n: v for n, v, _ in fields(value)}
                out.pieces.append(piece.get(PIECE_TEXT, b"").decode())
                out.kinds.append(piece.get(PIECE_TYPE, NORMAL))
            elif number == TRAINER:
                out.space_suffix = bool({n: v for n, v, _ in fields(value)}.get(TRAINER_SUFFIX, 0))
            elif number == NORMALIZER:
                norm = {n: v for n, v, _ in fields(value)}
                out.char_map = norm.get(NORM_MAP, b"")
                out.dummy_prefix = bool(norm.get(NORM_DUMMY_PREFIX, 1))
                out.extra_spaces = bool(norm.get(NORM_EXTRA_SPACES, 1))
                out.escape_spaces = bool(norm.get(NORM_ESCAPE, 1))
                continue
            rest.append(raw)
        off = bytes([NORM_DUMMY_PREFIX << 3, 0, NORM_EXTRA_SPACES << 3, 0, NORM_ESCAPE << 3, 1])
        out.plain = b"".join(rest) + _field(NORMALIZER, off)
        return out


class CharMap:
    """The compiled map: a double-array trie of byte strings and the texts that
    replace them. ``longest`` finds the longest key that starts at a place."""

    def __init__(self, blob: bytes):
        size = struct.unpack("<I", blob[:4])[0] if blob else 0
        self.units = struct.unpack(f"<{size // 4}I", blob[4:4 + size]) if blob else ()
        self.texts = blob[4 + size:] if blob else b""

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """(bytes matched, replacement), or None."""
        if not self.units:
            return None
        found = None
        node = 0
        unit = self.units[0]
        node ^= (unit >> 10) << ((unit & 512) >> 6)
        for n, byte in enumerate(data[at:], 1):
            if not byte:
                break
            node ^= byte
            unit = self.units[node]
            if unit & 0x800000FF != byte:
                break
            node ^= (unit >> 10) << ((unit & 512) >> 6)
            if unit >> 8 & 1:
                found = n, self.units[node] & 0x7FFFFFFF
        if found is None:
            return None
        n, start = found
        return n, self.texts[start:self.texts.index(b"\0", start)]
