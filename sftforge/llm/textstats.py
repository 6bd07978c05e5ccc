"""Statistics of one text, each computed when first asked for."""

from __future__ import annotations

import math
import re
from collections import Counter
from functools import cached_property

from sftforge.llm.common import WHITE, words

# The symbols that count as such, marks of list items.
SYMBOLS = "#*$%&|<>"
BULLETS = ("-", "*", "\u2022", "\u2023", "\u25cf", "\u00b7")
#: Control characters other than white space, and the replacement character.
GARBLED = re.compile("[\x00-\x08\x0e-\x1f\x7f-\x9f\ufffd]")


class TextView:
    """One document's text (null counts as empty)."""

    def __init__(self, text: str | None):
        self.text = text or ""

    @cached_property
    def words(self) -> list[bytes]:
        return words(self.text)

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        """Code points inside words."""
        return len(self.text) - sum(self.text.count(c) for c in WHITE)

    @cached_property
    def n_symbols(self) -> int:
        return sum(self.text.count(c) for c in SYMBOLS)

    @cached_property
    def lines(self) -> list[str]:
        """Lines that hold a word."""
        return [x for x in self.text.split("\n") if x.strip(WHITE)]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def dup_line_chars(self) -> int:
        """Characters of lines that equal an earlier one."""
        return sum(map(len, self.lines)) - sum(map(len, set(self.lines)))

    @cached_property
    def n_bullet_lines(self) -> int:
        return sum(x.lstrip(WHITE).startswith(BULLETS) for x in self.lines)

    @cached_property
    def n_ellipsis_lines(self) -> int:
        return sum(x.rstrip(WHITE).endswith(("...", "\u2026")) for x in self.lines)

    @cached_property
    def n_repeat_words(self) -> int:
        """Words inside 3-word windows that the text holds twice or more."""
        w = self.words
        grams = list(zip(w, w[1:], w[2:]))
        if len(set(grams)) == len(grams):
            return 0
        seen, total, upto = Counter(grams), 0, 0
        for i, g in enumerate(grams):
            if seen[g] > 1:
                total += i + 3 - max(i, upto)
                upto = i + 3
        return total

    @cached_property
    def n_exclaims(self) -> int:
        return self.text.count("!")

    @cached_property
    def n_braces(self) -> int:
        return self.text.count("{") + self.text.count("}")

    @cached_property
    def n_garbled(self) -> int:
        return len(GARBLED.findall(self.text))

    @cached_property
    def n_lettered_words(self) -> int:
        """Words that hold a letter."""
        return sum(any(map(str.isalpha, x.decode())) for x in self.words)

    @cached_property
    def n_upper(self) -> int:
        return sum(map(str.isupper, self.text))

    @cached_property
    def n_letters(self) -> int:
        return sum(map(str.isalpha, self.text))

    @cached_property
    def n_digits(self) -> int:
        return sum(map(str.isdigit, self.text))

    @cached_property
    def word_counts(self) -> Counter:
        return Counter(self.words)

    def features(self) -> list[float]:
        """Bounded shape statistics for the quality classifier: no word, name
        or id is among them."""
        n, chars, lines = max(self.n_words, 1), max(self.word_chars, 1), max(len(self.lines), 1)
        top = self.word_counts.most_common(1)[0][1] if self.n_words else 0
        used = len(self.word_counts)
        return [
            math.log1p(self.n_words),
            self.word_chars / n,
            min(self.n_symbols / n, 4.0),
            min(self.n_exclaims / n, 4.0),
            self.n_upper / max(self.n_letters, 1),
            self.n_letters / chars,
            self.n_digits / chars,
            self.n_dup_lines / lines,
            self.n_repeat_words / n,
            used / n,
            math.log1p(used) / math.log1p(n),
            top / n,
            min(sum(self.text.count(c) for c in ".,;:") / n, 4.0),
            min(self.text.count("|") / n, 4.0),
            math.log1p(n / lines),
        ]
