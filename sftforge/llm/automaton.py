"""A suffix automaton over word sequences that knows whether each of its
substrings occurs at two different places."""

from __future__ import annotations


class SuffixAutomaton:
    """Built from reference passages. Each state stands for substrings with the
    same set of end places; it keeps the least and the greatest of them, so a
    substring occurs at two places if these differ. A place is any comparable
    value that is equal for equal places of the corpus, so passages may overlap."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]
        self.low: list = [None]
        self.high: list = [None]

    def add(self, symbols, places) -> None:
        """Add one passage: its symbols, and the place at which each ends."""
        nxt, link, length = self.next, self.link, self.length
        last = 0
        for c, place in zip(symbols, places):
            q = nxt[last].get(c)
            if q is not None and length[q] == length[last] + 1:
                last = q
            elif q is not None:
                last = self._split(last, c, q)
            else:
                cur = self._state(length[last] + 1)
                p = last
                while p >= 0 and c not in nxt[p]:
                    nxt[p][c] = cur
                    p = link[p]
                if p < 0:
                    link[cur] = 0
                else:
                    q = nxt[p][c]
                    link[cur] = q if length[q] == length[p] + 1 else self._split(p, c, q)
                last = cur
            self._seen(last, place, place)

    def _state(self, length: int) -> int:
        self.next.append({})
        self.link.append(0)
        self.length.append(length)
        self.low.append(None)
        self.high.append(None)
        return len(self.next) - 1

    def _split(self, p: int, c, q: int) -> int:
        new = self._state(self.length[p] + 1)
        self.next[new] = dict(self.next[q])
        self.link[new] = self.link[q]
        self.link[q] = new
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = new
            p = self.link[p]
        return new

    def _seen(self, s: int, low, high) -> None:
        if low is not None:
            self.low[s] = low if self.low[s] is None else min(low, self.low[s])
            self.high[s] = high if self.high[s] is None else max(high, self.high[s])

    def close(self) -> None:
        """Pass the places on to the shorter suffixes; call once, after the last ``add``."""
        for s in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            self._seen(self.link[s], self.low[s], self.high[s])

    def matches(self, symbols):
        """Matching statistics: for each symbol (state, length) of the longest
        suffix up to it that the references hold."""
        s, n = 0, 0
        for c in symbols:
            while s and c not in self.next[s]:
                s = self.link[s]
                n = self.length[s]
            s = self.next[s].get(c, 0)
            n = n + 1 if s else 0
            yield s, n

    def repeated_windows(self, symbols, width: int):
        """Ends (index of the last symbol) of the windows of ``width`` symbols
        that occur at two places or more."""
        for i, (s, n) in enumerate(self.matches(symbols)):
            if n >= width:
                while self.length[self.link[s]] >= width:
                    s = self.link[s]
                    n = self.length[s]
                if self.low[s] != self.high[s]:
                    yield i
