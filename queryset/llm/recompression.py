"""Locally consistent names of token runs and pairs (recompression) over a batch of documents.

Every round replaces runs of one symbol, or pairs of a "left" and a "right" symbol, by a
new symbol. A symbol's name depends on what it stands for only, so equal passages get
equal symbols in every document, everywhere, but near their ends. ``first`` and ``last``
bound the words on which a symbol depends: itself and the neighbours that decided that it
was, or was not, joined. A window of words that holds these bounds holds the symbol
wherever the window occurs.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
GOLD, MIX_A, MIX_B = U(0x9E3779B97F4A7C15), U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """SplitMix64's finalizer over a salted value."""
    x = x + U((int(GOLD) * (salt + 1)) % (1 << 64))
    x = (x ^ (x >> U(30))) * MIX_A
    x = (x ^ (x >> U(27))) * MIX_B
    return x ^ (x >> U(31))


class Level:
    """Symbols of all documents in order: name, place of the first word, bounds of what decided them."""

    def __init__(self, name: np.ndarray, start: np.ndarray, first: np.ndarray, last: np.ndarray, doc: np.ndarray):
        self.name, self.start, self.first, self.last, self.doc = name, start, first, last, doc

    def take(self, keep: np.ndarray, name: np.ndarray, first: np.ndarray, last: np.ndarray) -> Level:
        return Level(name[keep], self.start[keep], first[keep], last[keep], self.doc[keep])


def _neighbours(level: Level) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Whether the next symbol is of the same document; bounds with the left and the right neighbour taken in."""
    n = len(level.name)
    joined = np.zeros(n, bool)
    joined[:-1] = level.doc[1:] == level.doc[:-1]
    # Without a neighbour the end of the document decided: no window can hold that.
    left, right = level.first - 1, level.last + 1
    left[1:][joined[:-1]] = level.first[:-1][joined[:-1]]
    right[:-1][joined[:-1]] = level.last[1:][joined[:-1]]
    return joined, left, right


def name_runs(level: Level, salt: int) -> Level:
    """Maximal runs of one symbol become one symbol; its neighbours decided where it ends."""
    joined, left, right = _neighbours(level)
    n = len(level.name)
    same = np.zeros(n, bool)  # equal to the symbol before
    same[1:] = joined[:-1] & (level.name[1:] == level.name[:-1])
    heads = np.flatnonzero(~same)
    size = np.diff(np.append(heads, n))
    tails = heads + size - 1
    name = np.where(size > 1, mix(level.name[heads] ^ mix(size.astype(U), salt), salt), level.name[heads])
    return Level(name, level.start[heads], left[heads], right[tails], level.doc[heads])


def name_pairs(level: Level, salt: int) -> Level:
    """A left symbol and a right one after it become one symbol; a bit of each name, new in every round, says which it is."""
    joined, left, right = _neighbours(level)
    n = len(level.name)
    side = (mix(level.name, salt) >> U(63)).astype(bool)
    pair = np.zeros(n, bool)
    pair[:-1] = joined[:-1] & ~side[:-1] & side[1:]
    second = np.zeros(n, bool)
    second[1:] = pair[:-1]
    name, first, last = level.name.copy(), np.where(side, left, level.first), np.where(side, level.last, right)
    heads = np.flatnonzero(pair)
    name[heads] = mix(level.name[heads] * MIX_A ^ mix(level.name[heads + 1], salt), salt)
    first[heads], last[heads] = level.first[heads], level.last[heads + 1]
    return level.take(~second, name, first, last)


def levels(words: np.ndarray, doc: np.ndarray, rounds: int) -> list[Level]:
    """The words themselves, their runs, and ``rounds`` rounds of pairs."""
    at = np.arange(len(words))
    out = [Level(mix(words), at, at, at + 1, doc)]
    out.append(name_runs(out[0], 1))
    for k in range(rounds):
        out.append(name_pairs(out[-1], k + 2))
    return out


def owners(stack: list[Level], doc_end: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(name, place of the symbol) by window of ``size`` words: of the symbols of the highest level that the window holds, the longest, of those the one with the least name.

    The choice depends on the window's words only, and neighbouring windows mostly share
    it. Long symbols are rare ones, so few windows share a name by chance. ``doc_end`` is
    the end of each word's document. Windows that would leave it have place -1.
    """
    n = len(doc_end)
    at = np.arange(n)
    name, place = np.zeros(n, U), np.full(n, -1)
    todo = np.flatnonzero(at + size <= doc_end)
    for k in range(len(stack) - 1, -1, -1):
        level = stack[k]
        # Symbols low <= s < high are held: bounds ascend with the symbols.
        low = np.cumsum(np.bincount(np.maximum(level.first + 1, 0), minlength=n + 2))[todo]
        high = np.cumsum(np.bincount(np.minimum(level.last, n + 1), minlength=n + 2))[todo + size]
        held = high > low
        low, high, here = low[held], high[held], todo[held]
        names = mix(level.name, 64 + k)
        words = np.diff(level.start, append=n)  # of a held symbol, as its neighbour is of the same document
        order = (U(255) - np.clip(words, 1, 255).astype(U)) << U(56) | names >> U(8)
        best = low.copy()
        for step in range(1, int((high - low).max(initial=0))):
            open_ = np.flatnonzero(low + step < high)
            other = low[open_] + step
            less = order[other] < order[best[open_]]
            best[open_[less]] = other[less]
        name[here], place[here] = names[best], level.start[best]
        todo = todo[~held]
    return name, place
