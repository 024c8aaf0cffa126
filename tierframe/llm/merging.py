"""Exact merging of one long symbol sequence, and lookups of symbol pairs in arrays."""

from __future__ import annotations

import heapq

import numpy as np

NONE = np.iinfo(np.int64).max


class PairTable:
    """Rank and result of the merge of two symbols.

    Small ranks merge first.  ``look_up`` works on arrays, ``get`` on one pair.
    """

    def __init__(self, left, right, rank, merged):
        keys = np.asarray(left, np.int64) << 32 | np.asarray(right, np.int64)
        order = np.argsort(keys)
        self.keys = keys[order]
        self.rank = np.append(np.asarray(rank, np.int64)[order], NONE)
        self.merged = np.append(np.asarray(merged, np.int64)[order], -1)
        self.get = dict(
            zip(self.keys.tolist(), zip(self.rank.tolist(), self.merged.tolist()))
        ).get

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (NONE where the two don't merge) and merged symbol (there -1)."""
        keys = left.astype(np.int64) << 32 | right.astype(np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), max(len(self.keys) - 1, 0))
        at = np.where(self.keys[at] == keys, at, len(self.keys)) if len(self.keys) else at
        return self.rank[at], self.merged[at]


def merge_sequence(symbols: list[int], pairs: PairTable) -> list[int]:
    """Always the pair of the lowest rank, the leftmost of equal ones, until none merges.

    A heap of pairs over a linked list: n log n for a sequence of any length.
    Symbols below 0 merge with nothing.
    """
    symbols = list(symbols)
    end = len(symbols)
    after = list(range(1, end + 1))
    before = list(range(-1, end - 1))
    heap = []

    def offer(i: int, j: int) -> None:
        if symbols[i] >= 0 and symbols[j] >= 0:
            found = pairs.get(symbols[i] << 32 | symbols[j])
            if found:
                heapq.heappush(heap, (found[0], i, symbols[i], symbols[j], j, found[1]))

    for i in range(end - 1):
        offer(i, i + 1)
    gone = [False] * end
    while heap:
        _, i, left, right, j, merged = heapq.heappop(heap)
        if gone[i] or gone[j] or after[i] != j or symbols[i] != left or symbols[j] != right:
            continue
        symbols[i] = merged
        gone[j] = True
        after[i] = after[j]
        if after[j] < end:
            before[after[j]] = i
            offer(i, after[i])
        if before[i] >= 0:
            offer(before[i], i)
    return [s for s, dead in zip(symbols, gone) if not dead]


def merge_words(
    symbol: np.ndarray, word: np.ndarray, pairs: PairTable
) -> tuple[np.ndarray, np.ndarray]:
    """Merge many words at once; ``word`` numbers the word of each symbol, ascending.

    In every step each word merges its pair of the lowest rank, the leftmost of
    equal ones, all words in one array operation; a word without a pair is
    done.  One pair per word and step is what makes it exact: a merged symbol
    may form a pair that comes before the next one of the same kind.  Returns
    the symbols left and their words, words in no particular order.
    """

    def with_next(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        after = np.minimum(at + 1, len(symbol) - 1)
        fits = (after > at) & (word[at] == word[after]) & (symbol[at] >= 0) & (symbol[after] >= 0)
        rank, merged = np.full(len(at), NONE), np.full(len(at), -1)
        rank[fits], merged[fits] = pairs.look_up(symbol[at[fits]], symbol[after[fits]])
        return rank, merged

    finished = []
    symbol, word = symbol.astype(np.int64), word.astype(np.int64)
    rank, merged = with_next(np.arange(len(symbol)))
    while len(symbol):
        starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        lowest = np.minimum.reduceat(rank, starts)
        lengths = np.diff(np.r_[starts, len(word)])
        done = np.repeat(lowest == NONE, lengths)
        if done.any():
            finished.append((symbol[done], word[done]))
            symbol, word, rank, merged = (a[~done] for a in (symbol, word, rank, merged))
            lengths, lowest = lengths[lowest != NONE], lowest[lowest != NONE]
            if not len(symbol):
                break
        hit = np.flatnonzero(rank == np.repeat(lowest, lengths))
        at = hit[np.r_[True, word[hit][1:] != word[hit][:-1]]]
        symbol[at] = merged[at]
        keep = np.ones(len(symbol), bool)
        keep[at + 1] = False
        symbol, word, rank, merged = (a[keep] for a in (symbol, word, rank, merged))
        at = at - np.arange(len(at))
        changed = np.r_[at, at[at > 0] - 1]
        rank[changed], merged[changed] = with_next(changed)
    if not finished:
        return symbol, word
    return tuple(np.concatenate(part) for part in zip(*finished))
