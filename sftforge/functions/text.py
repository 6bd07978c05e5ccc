"""String column expressions: strip, chat template, prompts, token pattern."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from sftforge.functions import constants as K


def _ws_class() -> str:
    """Regex character class (Java and RE2 syntax) of Python's whitespace set."""
    parts = []
    for ch in K.PY_WHITESPACE:
        cp = ord(ch)
        parts.append(" " if ch == " " else f"\\x{{{cp:x}}}")
    return "[" + "".join(parts) + "]"


WS_CLASS = _ws_class()
# Removes leading and trailing Python whitespace (str.strip()).
STRIP_PATTERN = f"\\A{WS_CLASS}+|{WS_CLASS}+\\z"

# Covering token pattern: chat markers, whitespace runs, letter runs, digit runs,
# any other single code point. Tokens cover the text, so offsets are prefix sums.
MARKER_PATTERN = r"<\|[a-z_]+\|>"
TOKEN_PATTERN = MARKER_PATTERN + r"|[ \t\r\n]+|\p{L}+|\p{N}+|(?s:.)"
# How a marker's beginning is written inside a text.
MARKER_START, ESCAPED_START = "<|", "< |"


def py_strip(col: Column | str) -> Column:
    """``str.strip()`` as a JVM expression, linear in the text."""
    c = F.col(col) if isinstance(col, str) else col
    return F.btrim(c, F.lit(K.PY_WHITESPACE))


def sql_str(s: str) -> str:
    """A SQL string literal (single quotes doubled)."""
    return "'" + s.replace("'", "''") + "'"


def escaped(text: Column) -> Column:
    """``text`` without anything that reads as a chat marker."""
    return F.replace(text, F.lit(MARKER_START), F.lit(ESCAPED_START))


def sql_escaped(x: str) -> str:
    """The DuckDB form of :func:`escaped`."""
    return f"replace({x}, {sql_str(MARKER_START)}, {sql_str(ESCAPED_START)})"


@dataclass(frozen=True)
class ChatTemplate:
    """Named chat template. The model's own template is not available, so the
    markers are parameters; the default reproduces the audit's token counts.
    A marker must be one token, or the user part's tokens would not be a prefix
    of the whole text's. Texts cannot forge a marker: ``<|`` in them is written
    ``< |``."""

    user_prefix: str = "<|user|>"
    user_suffix: str = ""
    assistant_prefix: str = "<|assistant|>"
    assistant_suffix: str = "<|end|>"

    def __post_init__(self):
        for m in self.markers:
            if not re.fullmatch(MARKER_PATTERN, m):
                raise ValueError(f"the marker {m!r} is not one token ({MARKER_PATTERN})")

    @property
    def markers(self) -> list[str]:
        seen = []
        for m in (self.user_prefix, self.user_suffix, self.assistant_prefix, self.assistant_suffix):
            if m and m not in seen:
                seen.append(m)
        return seen

    def user_text(self, user: Column) -> Column:
        """User turn only, without generation prompt."""
        return F.concat(F.lit(self.user_prefix), escaped(user), F.lit(self.user_suffix))

    def request_text(self, user: Column) -> Column:
        """User turn plus generation prompt (inference)."""
        return F.concat(F.lit(self.user_prefix), escaped(user), F.lit(self.user_suffix),
                        F.lit(self.assistant_prefix))

    def full_text(self, user: Column, assistant: Column) -> Column:
        return F.concat(F.lit(self.user_prefix), escaped(user), F.lit(self.user_suffix),
                        F.lit(self.assistant_prefix), escaped(assistant), F.lit(self.assistant_suffix))

    def sql_full(self, u: str, a: str) -> str:
        return (f"{sql_str(self.user_prefix)} || {sql_escaped(u)} || {sql_str(self.user_suffix)} || "
                f"{sql_str(self.assistant_prefix)} || {sql_escaped(a)} || {sql_str(self.assistant_suffix)}")

    def sql_user(self, u: str) -> str:
        return f"{sql_str(self.user_prefix)} || {sql_escaped(u)} || {sql_str(self.user_suffix)}"

    def sql_request(self, u: str) -> str:
        return (f"{sql_str(self.user_prefix)} || {sql_escaped(u)} || {sql_str(self.user_suffix)} || "
                f"{sql_str(self.assistant_prefix)}")


DEFAULT_TEMPLATE = ChatTemplate()


def train_prompt(seq: Column) -> Column:
    return F.concat(F.lit(K.TRAIN_PROMPT_HEAD), seq, F.lit(K.TRAIN_PROMPT_TAIL))


def infer_prompt(seq: Column) -> Column:
    return F.concat(F.lit(K.INFER_PROMPT_HEAD), seq, F.lit(K.INFER_PROMPT_TAIL))


def token_count(text: Column) -> Column:
    """Untruncated token count under TOKEN_PATTERN (no array is built)."""
    return F.regexp_count(text, F.lit(TOKEN_PATTERN))


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(TOKEN_PATTERN), F.lit(0))


def one_json_value(text: Column) -> Column:
    """``text`` as a VARIANT if it is one JSON value and nothing else, else null.
    The parser stops after a value, so the text is parsed as the one element of an
    array and as the one field of an object: both end where they should only if
    it is a value of its own."""
    alone = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    field = F.try_parse_json(F.concat(F.lit('{"c":'), text, F.lit("}")))
    items = F.try_variant_get(alone, "$", "array<variant>")
    return F.when((F.size(items) == 1) & F.try_variant_get(field, "$.c", "variant").isNotNull(), items[0])


def json_kind(value: Column) -> Column:
    """The type of a VARIANT's value: OBJECT, ARRAY, STRING, BIGINT, DECIMAL, DOUBLE,
    BOOLEAN, VOID (JSON null); null if there is no value."""
    return F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)


def last_key_wins(spark) -> None:
    """JSON objects that repeat a key keep its last value, as Python's reader does."""
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")


def each(items: Column) -> Column:
    """A row for each item; also one null row for a null or empty array, which the
    caller filters out. Plain ``explode`` would make Spark infer a filter on the
    array's size and compute the array again for it, before any exchange."""
    return F.explode_outer(items)


_SLOT = re.compile(r"\{(\w+)\}")


def fmt(template: str, **vals) -> Column:
    """``template.format(**vals)`` as a column: literal pieces and values concatenated."""
    parts = _SLOT.split(template)
    cols = []
    for i, p in enumerate(parts):
        if i % 2 == 0:
            if p:
                cols.append(F.lit(p))
        else:
            v = vals[p]
            cols.append(v.cast("string") if isinstance(v, Column) else F.lit(str(v)))
    return F.concat(*cols)


def sql_fmt(template: str, **vals: str) -> str:
    """The DuckDB form of :func:`fmt`; ``vals`` are SQL expressions."""
    parts = _SLOT.split(template)
    out = []
    for i, p in enumerate(parts):
        if i % 2 == 0:
            if p:
                out.append(sql_str(p))
        else:
            out.append(f"CAST({vals[p]} AS VARCHAR)")
    return "(" + " || ".join(out) + ")"


def py_list_text(stack: Column) -> Column:
    """A string of single characters printed as a Python list: ``[')', ']']``."""
    return F.when(F.length(stack) == 0, F.lit("[]")).otherwise(
        F.concat(F.lit("['"), F.array_join(F.split(stack, ""), "', '"), F.lit("']")))
