"""Which two tokens may stand side by side in a byte-pair encoding.

A sequence of tokens is the encoding of its text exactly if each token and each pair of neighbours is, on its
own, the encoding of its own text. So an encoder needs no merge queue: it goes from left to right and takes the
one token that ends here and suits the token before it.
"""

from __future__ import annotations

from collections.abc import Hashable, Sequence

PAIRS_KEPT = 400_000  # in each of two generations
NEVER = float("inf")  # the rank of a pair that doesn't merge


class MergeRule:
    """rank: the priority of each token that a merge can make, the lowest first. Tokens are bytes or str."""

    def __init__(self, rank: dict[Hashable, float]):
        self.rank = rank
        self.known: dict = {}
        self.before: dict = {}

    def merged(self, symbols: Sequence) -> list:
        """The encoding of a short text, by its definition: the best pair merges, the leftmost of equals."""
        parts, rank = list(symbols), self.rank.get
        ranks = [rank(a + b, NEVER) for a, b in zip(parts[:-1], parts[1:], strict=True)]
        while ranks:
            best = min(ranks)
            if best == NEVER:
                break
            at = ranks.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del ranks[at]
            if at:
                ranks[at - 1] = rank(parts[at - 1] + parts[at], NEVER)
            if at < len(ranks):
                ranks[at] = rank(parts[at] + parts[at + 1], NEVER)
        return parts

    def suits(self, left, right) -> bool:
        """Whether `right` may follow `left` (None: a start)."""
        key = (left, right)
        found = self.known.get(key)
        if found is None:
            if len(self.known) > PAIRS_KEPT:
                self.before, self.known = self.known, {}
            found = self.before.get(key)
            if found is None:
                found = self._suits(left, right)
            self.known[key] = found
        return found

    def _suits(self, left, right) -> bool:
        text = right if left is None else left + right
        symbols = [text[i : i + 1] for i in range(len(text))]
        return self.merged(symbols) == ([right] if left is None else [left, right])
