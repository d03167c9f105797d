"""A compressed full-text index over sequences of words: Burrows-Wheeler transform in a wavelet tree, searched backwards.

The index keeps no text and no suffix array: one bit per level and position for the transform, a mark where the first `depth`
words of sorted suffixes change, and one number for each such group. A search goes through patterns from their last word to
their first; many patterns take a step at once. Nothing here knows of Spark: one bucket of an exchange is one index.
"""

from __future__ import annotations

import numpy as np


class Bits:
    """A bit vector that counts the ones before a position."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        padded = np.zeros(len(bits) // 64 * 8 + 8, np.uint8)
        padded[: len(packed)] = packed
        self.words = padded.view("<u8")
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words))[:-1]]).astype(np.int32)

    def rank(self, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & below)


class WaveletTree:
    """Symbols (0 <= symbol < 2 ** depth) level by level, highest bit first; zeros of a level stand before its ones."""

    def __init__(self, symbols: np.ndarray, alphabet: int):
        self.levels: list[tuple[int, Bits, int]] = []
        for bit in reversed(range(max(1, int(alphabet - 1).bit_length()))):
            ones = (symbols >> bit & 1).astype(bool)
            self.levels.append((bit, Bits(ones), int(len(ones) - ones.sum())))
            symbols = np.concatenate([symbols[~ones], symbols[ones]])
        self.start = self._down(np.arange(alphabet), np.zeros(alphabet, np.int64))

    def _down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for bit, ones, zeros in self.levels:
            rank = ones.rank(at)
            at = np.where(symbol >> bit & 1, zeros + rank, at - rank)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each position."""
        return self._down(symbol, at) - self.start[symbol]


def suffix_order(symbols: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffix array, same): where a suffix in the array begins with the same `depth` symbols as the one before it.

    Sorting doubles the length that is compared; symbols must be such that all suffixes differ at last. The places where
    `depth` symbols do not fit come out as different from their neighbours.
    """
    n = len(symbols)
    rank = np.unique(symbols, return_inverse=True)[1].astype(np.int32)
    length, parts = 1, []
    while True:
        if depth & length:
            parts.append((length, rank))
        if length >= depth and rank.max(initial=0) == n - 1:
            break
        key = rank.astype(np.int64) * (n + 1)
        key[: max(0, n - length)] += rank[length:] + 1
        order = np.argsort(key)
        key = key[order]
        rank = np.empty(n, np.int32)
        rank[order] = np.concatenate([np.zeros(1, np.int32), np.cumsum(key[1:] != key[:-1], dtype=np.int32)])
        del key, order
        length *= 2
    array = np.empty(n, np.int32)
    array[rank] = np.arange(n, dtype=np.int32)
    same = np.zeros(n, bool)
    if n > 1:
        a, b = array[1:], array[:-1]
        equal, at = (a + depth <= n) & (b + depth <= n), 0
        for size, ranks in parts:
            equal &= ranks[np.minimum(a + at, n - 1)] == ranks[np.minimum(b + at, n - 1)]
            at += size
        same[1:] = equal
    return array, same


class FmIndex:
    """Index over sequences of words; `least` gives the smallest of the sequences' numbers that hold a run of `depth` words."""

    def __init__(self, words: np.ndarray, lengths: np.ndarray, numbers: np.ndarray, depth: int):
        """`words` (0 or more each) of all sequences in turn, the `lengths` of the sequences and a number for each."""
        pieces = len(lengths)
        ends = np.cumsum(lengths)
        place = np.arange(len(words)) + np.repeat(np.arange(pieces), lengths)
        n = len(words) + pieces
        text = np.zeros(n, np.int32)
        text[place] = words + 1
        own = text + np.int32(pieces - 1)  # every sequence ends in a separator of its own, below all words
        own[ends + np.arange(pieces)] = np.arange(pieces)
        del place
        array, same = suffix_order(own, depth)
        del own
        self.depth, self.size = depth, n
        alphabet = int(words.max(initial=-1)) + 2
        self.tree = WaveletTree(text[array - 1], alphabet)
        counts = np.bincount(text, minlength=alphabet)
        self.first = np.cumsum(counts) - counts
        del text
        owner = np.repeat(np.arange(pieces, dtype=np.int32), lengths + 1)
        left = (ends + np.arange(pieces))[owner] - np.arange(n)  # words before the separator
        # a run over a separator equals no other, as separators differ; it has no number
        value = np.where(left >= depth, numbers[owner], np.iinfo(np.int64).max)[array]
        self.group_start = np.append(np.flatnonzero(~same), n)
        self.marks = Bits(~same)
        self.group_least = np.minimum.reduceat(value, self.group_start[:-1]) if n else value

    def extend(self, symbols: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The suffixes that begin with each symbol and go on as those from `low` to `high`; none where the ends meet.

        A symbol that the index does not hold (negative, or beyond its words) has none.
        """
        inside = (symbols >= 0) & (symbols + 1 < len(self.first))
        symbol = np.where(inside, symbols + 1, 0)
        first = self.first[symbol]
        low, high = first + self.tree.rank(symbol, low), first + self.tree.rank(symbol, high)
        return low, np.where(inside, high, low)

    def group(self, low: np.ndarray) -> np.ndarray:
        """The group of suffixes with the same first `depth` words that each place belongs to."""
        return self.marks.rank(low + 1) - 1


def matching_statistics(index: FmIndex, words: np.ndarray, lengths: np.ndarray, slice_size: int = 1 << 16) -> tuple[np.ndarray, np.ndarray]:
    """(length, least) at every word of the patterns: how many words from there on, up to the index's depth, stand in some
    sequence of the index, and where that is all of the depth, the smallest number of such a sequence.

    A match grows to the left by backward steps; one of full depth drops its last word by going to its group. Where a match
    cannot grow it is begun again without its last word, so no pattern needs to be known to the index.
    """
    length, least = np.zeros(len(words), np.int64), np.full(len(words), np.iinfo(np.int64).max)
    starts = np.cumsum(lengths) - lengths
    for part in range(0, len(lengths), slice_size):
        begin, at = starts[part : part + slice_size], (starts + lengths - 1)[part : part + slice_size]
        low, high, matched = np.zeros(len(at), np.int64), np.full(len(at), index.size), np.zeros(len(at), np.int64)
        while True:
            going = at >= begin
            if not going.all():
                begin, at, low, high, matched = (x[going] for x in (begin, at, low, high, matched))
            if not len(at):
                break
            new_low, new_high = index.extend(words[at], low, high)
            grown = new_low < new_high
            size = np.where(grown, np.minimum(matched + 1, index.depth), 0)
            length[at] = np.maximum(length[at], size)
            full = np.flatnonzero(size == index.depth)
            group = index.group(new_low[full])
            least[at[full]] = index.group_least[group]
            new_low[full], new_high[full] = index.group_start[group], index.group_start[group + 1]
            # without a match: one word to the left of an empty one, else again from the last word but one
            again = np.where(matched == 0, at - 1, at + matched - 1)
            at = np.where(grown, at - 1, again)
            low, high = np.where(grown, new_low, 0), np.where(grown, new_high, index.size)
            matched = size
    return length, least
