"""Byte-pair encodings as a left-to-right dynamic program over prefixes.

A token sequence is what the merges give exactly when each neighbouring pair
of tokens, encoded alone, stays that pair.  So the encoding of a prefix ends
in the one token whose predecessor is the last token of a shorter prefix's
encoding and may stand before it: no merge loop over the whole text, and every
prefix's encoding comes along.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

#: Texts and token pairs remembered in a worker before starting afresh.
REMEMBERED = 800_000
START = 0


class Memory(dict):
    """Values by text, computed when missing, of bounded number."""

    def __init__(self, compute: Callable[[str], object], most: int = REMEMBERED, longest: int = 200):
        super().__init__()
        self.compute, self.most, self.longest = compute, most, longest

    def __missing__(self, key: str):
        if len(self) > self.most:
            self.clear()
        value = self.compute(key)
        if len(key) < self.longest:
            self[key] = value
        return value


class PrefixEncoder:
    """``tokens``: each token's base symbols; ``rank(a, b)``: the priority of
    joining two neighbours (lower first) or None.  Tokens are numbered from 1;
    0 is the start of a text."""

    def __init__(self, tokens: Iterable[Sequence[str]], rank: Callable[[str, str], float | None]):
        self.symbols = [(), *map(tuple, tokens)]
        self.text = ["", *("".join(t) for t in self.symbols[1:])]
        self.rank = rank
        self.longest = max(map(len, self.symbols))
        self._pairs: dict[int, bool] = {}
        #: Tokens by their symbols from the last to the first; "" holds the number.
        self.tree: dict = {}
        for number, s in enumerate(self.symbols):
            node = self.tree
            for x in reversed(s):
                node = node.setdefault(x, {})
            if number:
                node[""] = number

    def merge(self, symbols: Sequence[str]) -> list[str]:
        """The encoding by merges, best rank first, leftmost on ties."""
        s = list(symbols)
        ranks = [self.rank(a, b) for a, b in zip(s, s[1:])]
        while True:
            best = None
            for i, r in enumerate(ranks):
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                return s
            s[at : at + 2] = [s[at] + s[at + 1]]
            del ranks[at]
            if at:
                ranks[at - 1] = self.rank(s[at - 1], s[at])
            if at + 1 < len(s):
                ranks[at] = self.rank(s[at], s[at + 1])

    def follows(self, a: int, b: int) -> bool:
        """True if token ``b`` can stand after token ``a``."""
        key = a << 32 | b
        known = self._pairs.get(key)
        if known is None:
            if len(self._pairs) > REMEMBERED:
                self._pairs.clear()
            known = self._pairs[key] = self.joined(a, b)
        return known

    def joined(self, a: int, b: int) -> bool:
        """What :meth:`follows` remembers, found anew by the merges."""
        want = [self.text[a], self.text[b]] if a else [self.text[b]]
        return self.merge(self.symbols[a] + self.symbols[b]) == want

    def last(self, s: Sequence[str], i: int, before: Sequence[int], final: str | None = None) -> tuple[int, int]:
        """(token, its start): the last token of the encoding of ``s[:i]``, or
        (0, -1).  ``final`` stands in for the last symbol."""
        node, j = self.tree, i - 1
        pairs = self._pairs
        x = s[j] if final is None else final
        while True:
            node = node.get(x)
            if node is None:
                return 0, -1
            token = node.get("")
            if token is not None:
                known = pairs.get(before[j] << 32 | token)
                if known or (known is None and self.follows(before[j], token)):
                    return token, j
            j -= 1
            if j < 0:
                return 0, -1
            x = s[j]
