"""FM-index over a sequence of word numbers, in numpy: wavelet matrix, backward search, sampled positions.

The sequence is made of pieces with separators between them.  Many patterns are searched at once, one step of all of
them at a time.
"""

from __future__ import annotations

import numpy as np

PLACE_BITS = 21
MOST_PLACES = 1 << PLACE_BITS


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Places in the order of what follows them, by prefix doubling.

    Each separator (0) counts as a symbol of its own, so comparisons end with a piece and the number of rounds follows
    the longest repeat inside pieces, not the length of the sequence.
    """
    n = len(symbols)
    at = np.arange(n, dtype=np.int64)
    apart = symbols == 0
    present = np.unique(symbols)
    rank = np.searchsorted(present, symbols) + int(apart.sum()) + 1
    rank[apart] = np.arange(1, int(apart.sum()) + 1)
    known = 1
    while True:
        after = np.zeros(n, np.int64)
        after[: n - known] = rank[known:]
        if n < MOST_PLACES:
            keys = np.sort((rank << (2 * PLACE_BITS)) | (after << PLACE_BITS) | at)
            order = keys & (MOST_PLACES - 1)
            keys >>= PLACE_BITS
        else:
            order = np.lexsort((after, rank))
            keys = rank[order] * (n + 1) + after[order]
        group = np.cumsum(np.concatenate([[1], keys[1:] != keys[:-1]]))
        known *= 2
        if group[-1] == n:
            return order
        rank = np.empty(n, np.int64)
        rank[order] = group


class Bits:
    """A bit sequence with counts before every 64th place."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        room = np.zeros(len(bits) // 64 + 1, np.uint64)
        room.view(np.uint8)[: len(packed)] = packed
        self.words = room
        self.before = np.zeros(len(room), np.int64)
        np.cumsum(np.bitwise_count(room[:-1]), out=self.before[1:])

    def rank(self, place: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        word = place >> 6
        mask = (np.uint64(1) << (place & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)

    def get(self, place: np.ndarray) -> np.ndarray:
        return (self.words[place >> 6] >> (place & 63).astype(np.uint64)) & np.uint64(1)


class Wavelet:
    """Wavelet matrix: one bit sequence for each binary digit of the symbols, high digits first."""

    def __init__(self, symbols: np.ndarray, most: int):
        self.levels: list[tuple[int, Bits, int]] = []
        for digit in range(max(1, int(most).bit_length()) - 1, -1, -1):
            bit = (symbols >> digit) & 1
            zeros = int(len(bit) - bit.sum())
            self.levels.append((digit, Bits(bit.astype(np.uint8)), zeros))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])

    def down(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        for digit, bits, zeros in self.levels:
            ones = bits.rank(place)
            place = np.where((symbol >> digit) & 1, zeros + ones, place - ones)
        return place

    def access(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each place, and where it lies below the last level."""
        symbol = np.zeros(len(place), np.int64)
        for digit, bits, zeros in self.levels:
            bit = bits.get(place).astype(np.int64)
            ones = bits.rank(place)
            place = np.where(bit, zeros + ones, place - ones)
            symbol |= bit << digit
        return symbol, place


class FMIndex:
    """Index of ``symbols`` (from 1; 0 separates pieces and is in no pattern).

    Every ``sample``-th place is kept, and every first one of a piece, so that no walk crosses a separator.
    """

    def __init__(self, symbols: np.ndarray, sample: int = 8):
        symbols = np.concatenate([symbols, [0]]).astype(np.int64)
        order = suffix_order(symbols)
        most = int(symbols.max())
        self.wavelet = Wavelet(symbols[order - 1], most)
        self.smaller = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=most + 1))])
        self.origin = self.wavelet.down(np.arange(most + 1), np.zeros(most + 1, np.int64))
        kept = (order % sample == 0) | (symbols[order - 1] == 0)
        self.kept = Bits(kept.astype(np.uint8))
        self.samples = order[kept]
        self.most = most

    def back(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """The first row at or after which rows of ``symbol`` before the rows from ``place`` begin."""
        return self.smaller[symbol] + self.wavelet.down(symbol, place) - self.origin[symbol]

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One backward step: rows that begin with ``symbol`` and go on as the rows low to high."""
        both = self.back(np.concatenate([symbol, symbol]), np.concatenate([low, high]))
        return both[: len(low)], both[len(low) :]

    def search(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows (low, high) of each pattern (a row of symbols); empty where low >= high."""
        count, length = patterns.shape
        low = np.zeros(count, np.int64)
        high = np.zeros(count, np.int64)
        last = patterns[:, -1]
        live = np.flatnonzero((last > 0) & (last <= self.most))
        low[live], high[live] = self.smaller[last[live]], self.smaller[last[live] + 1]
        for step in range(length - 2, -1, -1):
            live = live[low[live] < high[live]]
            if not len(live):
                break
            symbol = patterns[live, step]
            fits = (symbol > 0) & (symbol <= self.most)
            high[live[~fits]] = low[live[~fits]]
            live, symbol = live[fits], symbol[fits]
            low[live], high[live] = self.extend(symbol, low[live], high[live])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Places of rows: walk back to the nearest kept place."""
        place = np.zeros(len(rows), np.int64)
        walked = np.zeros(len(rows), np.int64)
        live, now = np.arange(len(rows)), rows.copy()
        while len(live):
            hit = self.kept.get(now).astype(bool)
            found = live[hit]
            place[found] = self.samples[self.kept.rank(now[hit])] + walked[found]
            live, now = live[~hit], now[~hit]
            if not len(live):
                break
            symbol, below = self.wavelet.access(now)
            now = self.smaller[symbol] + below - self.origin[symbol]
            walked[live] += 1
        return place
