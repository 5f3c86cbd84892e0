"""A compressed full-text index over word ids: BWT in a wavelet tree, searched backwards."""

from __future__ import annotations

import numpy as np


class FMIndex:
    """Finds all places of a word sequence of at most ``depth`` words.

    ``text`` holds word ids from 1; 0 separates sequences and ends the text. Suffixes are
    sorted by their first words only, as deep as patterns reach, in doubling steps. The
    last column is kept as a wavelet tree in levelwise form: one bit of every symbol per
    level, with counts for each 64 bits, so a rank costs one look-up a level.
    """

    def __init__(self, text: np.ndarray, depth: int) -> None:
        self.places = self._sorted(text.astype(np.int64), depth)
        last = text[self.places - 1].astype(np.int64)
        symbols = int(text.max(initial=0)) + 1
        self._before = np.r_[0, np.cumsum(np.bincount(text, minlength=symbols))]
        self._levels: list[tuple[int, np.ndarray, np.ndarray, int]] = []
        at = np.zeros(symbols, np.int64)
        ids = np.arange(symbols)
        for bit in range(max(1, (symbols - 1).bit_length()) - 1, -1, -1):
            ones = ((last >> bit) & 1).astype(np.uint8)
            packed = np.packbits(np.r_[ones, np.zeros(-len(ones) % 64 + 64, np.uint8)], bitorder="little").view(np.uint64)
            counts = np.r_[0, np.cumsum(np.bitwise_count(packed), dtype=np.int64)][:-1]
            level = (bit, packed, counts, len(ones) - int(ones.sum()))
            self._levels.append(level)
            at = self._down(level, ids, at)
            last = np.concatenate([last[ones == 0], last[ones == 1]])
        self._starts = at

    @staticmethod
    def _sorted(text: np.ndarray, depth: int) -> np.ndarray:
        rank, step = text, 1
        order = np.argsort(rank, kind="stable")
        while step < depth:
            key = rank * (int(rank.max(initial=0)) + 1) + np.roll(rank, -step)
            order = np.argsort(key, kind="stable")
            in_order = key[order]
            rank = np.empty(len(text), np.int64)
            rank[order] = np.r_[0, np.cumsum(in_order[1:] != in_order[:-1])]
            step *= 2
        return order

    @staticmethod
    def _down(level: tuple[int, np.ndarray, np.ndarray, int], symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        bit, packed, counts, zeros = level
        word = at >> 6
        below = packed[word] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1))
        ones = counts[word] + np.bitwise_count(below)
        return np.where((symbols >> bit) & 1, zeros + ones, at - ones)

    def _rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol is among the first ``at`` of the last column."""
        for level in self._levels:
            at = self._down(level, symbols, at)
        return at - self._starts[symbols]

    def extend(self, symbols: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One step of backward search: the intervals of the patterns with a symbol before them."""
        both = self._rank(np.concatenate([symbols, symbols]), np.concatenate([low, high]))
        first = self._before[symbols]
        return first + both[: len(low)], first + both[len(low) :]

    def matching(self, text: np.ndarray, starts: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For the sequences text[s : s + words]: how many words, from their ends, match in more than one place.

        Also the interval of the whole sequence where all words do; a search stops where
        one place is left.
        """
        low, high = np.zeros(len(starts), np.int64), np.full(len(starts), len(self.places), np.int64)
        matched = np.zeros(len(starts), np.int64)
        live = np.arange(len(starts))
        for step in range(words):
            low[live], high[live] = self.extend(text[starts[live] + words - 1 - step].astype(np.int64), low[live], high[live])
            live = live[high[live] - low[live] > 1]
            if not len(live):
                break
            matched[live] += 1
        return matched, low, high
