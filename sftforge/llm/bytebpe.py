"""Byte-level BPE ids of many texts: words are looked up before they are merged."""

from __future__ import annotations

import hashlib
import json
import re
import sys
from array import array
from operator import itemgetter

from sftforge.llm.common import once_a_worker

#: Words whose ids a worker remembers at most; beyond it, it forgets them all.
MEMO_WORDS = 700_000
#: Words of these letters, and marks after them, need no whole tokenizer.
LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
MARKS = ".,;:!?#*$%&"
BIG = sys.byteorder == "big"


def packed(ids) -> bytes:
    """Little-endian 32-bit numbers."""
    out = array("I", ids)
    if BIG:
        out.byteswap()
    return out.tobytes()


class ByteEncoder:
    """text -> its ids as little-endian 32-bit numbers, exactly those of the
    tokenizer file. Under the byte-level rule for words, a single space between
    two visible characters begins a word, and a single line feed between two is
    one of its own; so texts are cut there and equal words are merged once. Any
    other white space keeps its neighbours in one piece, which goes through the
    whole tokenizer, as do texts under any other kind of file.

    ``plain_specials``: special tokens' strings inside texts are plain text."""

    CUT = re.compile(r"(?<=\S) (?=\S)")

    def __init__(self, file: bytes, plain_specials: bool = False):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(file.decode())
        self.tokenizer.encode_special_tokens = plain_specials
        self.tokenize = self.tokenizer.model.tokenize
        config = json.loads(file)
        split, model = config["pre_tokenizer"] or {}, config["model"]
        self.by_word = (
            config["normalizer"] is None and split.get("type") == "ByteLevel" and split["use_regex"]
            and not split["add_prefix_space"] and model["type"] == "BPE" and not model.get("dropout")
            and not model.get("ignore_merges") and not config["truncation"] and not config["padding"])
        self.specials = [] if plain_specials else [x["content"] for x in config["added_tokens"]]
        kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in set(kept)]
        self.spelling = {b: chr(256 + i) for i, b in enumerate(rest)}  # the other bytes spell themselves
        self.spelled = {c: "".join(self.spelling.get(b, chr(b)) for b in chr(c).encode()) for c in [32, *range(192, 256)]}
        self.first, self.later, self.parts = _Memo(self, ""), _Memo(self, " "), {}
        self.feed = self.whole("\n")

    @classmethod
    def of(cls, file: bytes, plain_specials: bool = False) -> "ByteEncoder":
        """The worker's encoder of a file."""
        name = f"{cls.__name__} {hashlib.sha256(file).hexdigest()} {plain_specials}"
        return once_a_worker(name, lambda: cls(file, plain_specials))

    def part(self, text: str) -> bytes:
        """Ids of a run of letters or of marks, with the space before it."""
        if len(self.parts) >= MEMO_WORDS:
            self.parts.clear()
        spelled = text.replace(" ", self.spelled[32]) if text.isascii() else text.translate(self.spelled)
        ids = self.parts[text] = packed([t.id for t in self.tokenize(spelled)])
        return ids

    def whole(self, text: str) -> bytes:
        return packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def row(self, words: list[str]) -> bytes:
        """Ids of words that one space separates."""
        head, rest = self.first[words[0]], words[1:]
        if len(rest) > 1:
            return head + b"".join(itemgetter(*rest)(self.later))
        return head + self.later[rest[0]] if rest else head

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if not self.by_word or any(s in text for s in self.specials):
            return self.whole(text)
        out = []
        for line in text.split("\n"):
            words = line.split()
            if not words or " ".join(words) != line:  # white space of another kind
                return self.row(self.CUT.split(text))
            out.append(self.row(words))
        return self.feed.join(out)


class _Memo(dict):
    """word -> ids of ``head`` and the word."""

    def __init__(self, encoder: ByteEncoder, head: str):
        super().__init__()
        self.encoder, self.head = encoder, head

    def __missing__(self, word: str) -> bytes:
        """Letters and the marks that follow them are words of their own."""
        if len(self) >= MEMO_WORDS:
            self.clear()
        encoder, whole = self.encoder, self.head + word
        letters = word.rstrip(MARKS)
        if not letters or not (letters.isalpha() if letters.isascii() else LETTERS.fullmatch(letters)):
            ids = encoder.whole(whole)
        elif letters == word:
            ids = encoder.parts.get(whole) or encoder.part(whole)
        else:
            base, marks = whole[:len(letters) - len(word)], word[len(letters):]
            ids = ((encoder.parts.get(base) or encoder.part(base))
                   + (encoder.parts.get(marks) or encoder.part(marks)))
        self[word] = ids
        return ids
