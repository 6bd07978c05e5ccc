"""Reproducible, partition-independent random draws.

``draw(tag, *parts)`` = first 32 bits of md5("tag:part1:part2:...") as a BIGINT
in [0, 2^32). The same integers come out of DuckDB as
``('0x' || substr(md5(...), 1, 8))::BIGINT``, so every random choice of the
generator can be recomputed by an oracle. ``rand()`` is never used: its stream
depends on partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_POW_32 = 4294967296


def _key(tag: str, parts) -> Column:
    cols = [F.lit(tag)] + [p if isinstance(p, Column) else F.lit(p) for p in parts]
    return F.concat_ws(":", *[c.cast("string") for c in cols])


def draw(tag: str, *parts, word: int = 0) -> Column:
    """32-bit draw; ``word`` selects which 8-hex-digit slice of the md5 (0..3)."""
    h = F.md5(_key(tag, parts))
    return F.conv(F.substring(h, 1 + 8 * word, 8), 16, 10).cast("bigint")


def draw_sql(tag: str, *parts: str, word: int = 0) -> str:
    """The DuckDB form of :func:`draw`; ``parts`` are SQL expressions."""
    key = " || ':' || ".join([f"'{tag}'"] + [f"CAST({p} AS VARCHAR)" for p in parts])
    return f"('0x' || substr(md5({key}), {1 + 8 * word}, 8))::BIGINT"
