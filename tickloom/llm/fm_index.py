"""A full-text index of symbol sequences: suffix order, wavelet ranks, sampled places.

The sequence is many runs of symbols 1 .. ``alphabet`` - 1. Each run ends with a separator (0);
separators order by place, so no suffix is compared beyond its run. Patterns hold no separator.
"""

from __future__ import annotations

import numpy as np

_SAMPLE = 8


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Places of all suffixes in order, by doubling the sorted length until all differ."""
    n = len(symbols)
    gaps = symbols == 0
    rank = np.where(gaps, np.cumsum(gaps) - 1, symbols.astype(np.int64) + int(gaps.sum()))
    length = 1
    order = np.argsort(rank, kind="stable")
    while True:
        sorted_rank = rank[order]
        new = np.concatenate([[False], sorted_rank[1:] != sorted_rank[:-1]])
        dense = np.empty(n, np.int64)
        dense[order] = np.cumsum(new)
        rank = dense
        if n == 0 or rank[order[-1]] == n - 1:
            return order
        behind = np.zeros(n, np.int64)
        behind[:n - length] = rank[length:] + 1
        # What differs already keeps its place; only the suffixes in ties are sorted again.
        size = np.bincount(rank, minlength=n)
        tied = order[size[rank[order]] > 1]
        again = tied[np.lexsort((behind[tied], rank[tied]))]
        order[size[rank[order]] > 1] = again
        key = np.stack([rank[order], np.where(size[rank[order]] > 1, behind[order], 0)])
        new = np.concatenate([[False], (key[:, 1:] != key[:, :-1]).any(0)])
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(new)
        length *= 2


class Wavelet:
    """Ranks in a symbol sequence: one packed bit row per bit of the symbols, highest first."""

    def __init__(self, symbols: np.ndarray, alphabet: int):
        self.bits = max(1, int(alphabet - 1).bit_length())
        self.rows, self.zeros = [], []
        left = symbols.astype(np.uint32)
        for bit in range(self.bits - 1, -1, -1):
            ones = (left >> np.uint32(bit)) & np.uint32(1)
            packed = np.packbits(ones.astype(np.uint8), bitorder="little")
            packed = np.pad(packed, (0, 8 + -len(packed) % 8)).view(np.uint64)
            before = np.concatenate([[0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)])
            self.rows.append((packed, before))
            self.zeros.append(int(len(left) - ones.sum()))
            left = np.concatenate([left[ones == 0], left[ones == 1]])

    @staticmethod
    def _ones(row: tuple[np.ndarray, np.ndarray], place: np.ndarray) -> np.ndarray:
        packed, before = row
        word, bit = place >> 6, (place & 63).astype(np.uint64)
        return before[word] + np.bitwise_count(
            packed[word] & ((np.uint64(1) << bit) - np.uint64(1))).astype(np.int64)

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How often each symbol is found before each place."""
        begin, end = np.zeros_like(place), place
        for level, (row, zeros) in enumerate(zip(self.rows, self.zeros)):
            one = ((symbol >> (self.bits - 1 - level)) & 1).astype(bool)
            b, e = self._ones(row, begin), self._ones(row, end)
            begin = np.where(one, zeros + b, begin - b)
            end = np.where(one, zeros + e, end - e)
        return end - begin

    def symbol_and_rank(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each place, and how often it is found before."""
        symbol, begin, at = np.zeros_like(place), np.zeros_like(place), place
        for row, zeros in zip(self.rows, self.zeros):
            packed, _ = row
            one = ((packed[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)
            b, p = self._ones(row, begin), self._ones(row, at)
            begin = np.where(one, zeros + b, begin - b)
            at = np.where(one, zeros + p, at - p)
            symbol = symbol * 2 + one
        return symbol, at - begin


class FMIndex:
    def __init__(self, symbols: np.ndarray, alphabet: int):
        order = suffix_order(symbols)
        n = len(symbols)
        self.wavelet = Wavelet(symbols[order - 1] if n else symbols, alphabet)
        self.below = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=alphabet))])
        begins = np.ones(n, bool)
        begins[1:] = symbols[:-1] == 0
        sampled = (order % _SAMPLE == 0) | begins[order]  # a walk back never leaves its run
        self.sampled, self.places = sampled, order
        self.places = order[sampled]
        self.sample_rank = np.cumsum(sampled) - 1
        self.size = n

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and behind-last row of the suffixes that begin with each pattern, which stands at
        the left of its row of ``patterns``; its symbols are taken from the last to the first."""
        first = np.zeros(len(lengths), np.int64)
        behind = np.full(len(lengths), self.size, np.int64)
        for step in range(1, int(lengths.max(initial=0)) + 1):
            live = np.flatnonzero((lengths >= step) & (first < behind))
            if not len(live):
                break
            symbol = patterns[live, lengths[live] - step].astype(np.int64)
            base = self.below[symbol]
            first[live] = base + self.wavelet.rank(symbol, first[live])
            behind[live] = base + self.wavelet.rank(symbol, behind[live])
        return first, behind

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The place of the suffix at each row: walk back to a sampled one."""
        place = np.zeros(len(rows), np.int64)
        row, steps = rows.copy(), np.zeros(len(rows), np.int64)
        walking = np.arange(len(rows))
        while len(walking):
            done = self.sampled[row[walking]]
            here = walking[done]
            place[here] = self.places[self.sample_rank[row[here]]] + steps[here]
            walking = walking[~done]
            symbol, rank = self.wavelet.symbol_and_rank(row[walking])
            row[walking] = self.below[symbol] + rank
            steps[walking] += 1
        return place
