"""An FM-index over a sequence of symbols, in numpy.

Symbol 0 is a break: nothing that is searched for reaches over one.  A suffix
ends at its first break, and breaks differ by their place, so that the order of
suffixes is settled within runs between breaks.  The index keeps the last column
of the sorted rotations in a wavelet matrix (one bit vector with counts for each
bit of a symbol) behind a bit vector that leaves breaks out, and the places of
every ``SAMPLE``-th suffix and of those that follow a break.
"""

from __future__ import annotations

import numpy as np

SAMPLE = 8


class Bits:
    """A bit vector with the number of ones before any place."""

    def __init__(self, flags: np.ndarray):
        self.size = len(flags)
        packed = np.zeros(self.size // 64 + 1, "<u8")
        packed.view(np.uint8)[: -(-self.size // 8)] = np.packbits(flags, bitorder="little")
        self.words = packed
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)])[:-1]
        self.ones = int(self.before[-1] + np.bitwise_count(packed[-1]))

    def rank(self, at: np.ndarray) -> np.ndarray:
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        mask = (np.uint64(1) << bit) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask)

    def get(self, at: np.ndarray) -> np.ndarray:
        return ((self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)


def suffix_ranks(text: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The rank of every suffix; ``text`` ends with a break.

    Ranks start as those of first symbols and double the length they cover;
    only suffixes that still share a rank are sorted again.
    """
    n = len(text)
    below = np.cumsum(counts) - counts  # breaks come first, in their order
    ranks = below[text]
    breaks = np.flatnonzero(text == 0)
    ranks[breaks] = np.arange(len(breaks))
    live, reach = np.flatnonzero(text), 1
    while len(live):
        key = ranks[live] * np.int64(n + 1) + ranks[live + reach]
        order = np.argsort(key)
        live, key = live[order], key[order]
        old = ranks[live]
        place = np.arange(len(live))
        family = np.concatenate([[True], old[1:] != old[:-1]])
        run = np.concatenate([[True], key[1:] != key[:-1]])
        start = np.maximum.accumulate(np.where(run, place, 0))
        ranks[live] = old + start - np.maximum.accumulate(np.where(family, place, 0))
        alone = run & np.concatenate([run[1:], [True]])
        live, reach = live[~alone], 2 * reach
    return ranks


class FMIndex:
    def __init__(self, text: np.ndarray, symbols: int):
        """``text``: whole numbers from 0 to ``symbols``, 0 for a break."""
        if not len(text) or text[-1]:
            text = np.append(text, 0)
        self.counts = np.bincount(text, minlength=symbols + 1).astype(np.int64)
        self.first = np.cumsum(self.counts) - self.counts
        order = np.empty(len(text), np.int64)
        order[suffix_ranks(text, self.counts)] = np.arange(len(text))
        last = np.where(order > 0, text[order - 1], 0)
        words = last > 0
        self.words = Bits(words)
        sampled = ~words | (order % SAMPLE == 0)
        self.sampled, self.places = Bits(sampled), order[sampled]
        now, self.levels, self.zeros = last[words], [], []
        self.width = int(symbols).bit_length()
        for shift in range(self.width - 1, -1, -1):
            one = (now >> shift & 1).astype(bool)
            self.levels.append(Bits(one))
            self.zeros.append(len(now) - self.levels[-1].ones)
            now = np.concatenate([now[~one], now[one]])
        # what leads from a place in the last level to the row of the first column
        every = np.arange(symbols + 1)
        self.shift = self.first - self._down(every, np.zeros(symbols + 1, np.int64))

    def _down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where a symbol's occurrences before ``at`` end in the last level."""
        for k, (bits, zeros) in enumerate(zip(self.levels, self.zeros, strict=True)):
            ones = bits.rank(at)
            at = np.where(symbol >> (self.width - 1 - k) & 1, zeros + ones, at - ones)
        return at

    def step(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Backward step: the first row of ``symbol`` before the suffixes from ``row`` on."""
        return self._down(symbol, self.words.rank(row)) + self.shift[symbol]

    def search(self, phrases: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows (begin, end) of every phrase; ``phrases`` are right-aligned rows."""
        end = phrases[:, -1]
        low, high = self.first[end].copy(), (self.first + self.counts)[end]
        live = np.flatnonzero(high > low)
        for t in range(1, phrases.shape[1]):
            live = live[(sizes[live] > t) & (high[live] > low[live])]
            if not len(live):
                break
            symbol = phrases[live, -1 - t]
            low[live], high[live] = self.step(symbol, low[live]), self.step(symbol, high[live])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The places of rows: back until a sampled one."""
        found, steps = np.zeros(len(rows), np.int64), 0
        at, which = rows.astype(np.int64), np.arange(len(rows))
        while len(at):
            known = self.sampled.get(at)
            found[which[known]] = self.places[self.sampled.rank(at[known])] + steps
            at, which, steps = at[~known], which[~known], steps + 1
            symbol, place = np.zeros(len(at), np.int64), self.words.rank(at)
            for bits, zeros in zip(self.levels, self.zeros, strict=True):
                one, ones = bits.get(place), bits.rank(place)
                symbol, place = symbol << 1 | one, np.where(one, zeros + ones, place - ones)
            at = place + self.shift[symbol]
        return found
