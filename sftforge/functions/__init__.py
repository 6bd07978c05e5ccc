"""Column expressions and fixed values shared by the operators."""

from sftforge.functions import constants
from sftforge.functions.hashing import draw, draw_sql
from sftforge.functions.text import (
    DEFAULT_TEMPLATE, STRIP_PATTERN, TOKEN_PATTERN, ChatTemplate, infer_prompt, py_strip,
    token_count, tokens, train_prompt,
)

__all__ = [
    "constants", "draw", "draw_sql", "DEFAULT_TEMPLATE", "STRIP_PATTERN", "TOKEN_PATTERN",
    "ChatTemplate", "infer_prompt", "py_strip", "token_count", "tokens", "train_prompt",
]
