"""Byte-pair merges of many words at once: rounds over one flat array of symbols.

A round finds the best pair rank of each word, merges its leftmost occurrences in all words at once and compacts the
array; words without a pair leave. Where a merge would create a pair that comes before the next occurrence, only the
leftmost is merged in that round, so the result is that of the one-by-one procedure.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_NO_PAIR = np.int32(2**31 - 1)


@dataclass
class MergeTable:
    """Open-addressing table of symbol pairs: the symbol a pair becomes and its place in the order of merges."""
    slots: np.ndarray
    merged: np.ndarray
    rank: np.ndarray


def merge_table(left: list[int], right: list[int], merged: list[int], rank) -> MergeTable:
    """Table of pairs of symbols below two million; ranks may tie."""
    size = 1 << max(4, (len(left) * 6).bit_length())
    table = MergeTable(np.full(size, -1, dtype=np.int64), np.zeros(size, dtype=np.int32), np.full(size, _NO_PAIR, dtype=np.int32))
    keys = np.array(left, dtype=np.int64) << 21 | np.array(right, dtype=np.int64)
    for key, home, new, place in zip(keys.tolist(), _home(keys, size).tolist(), merged, np.asarray(rank).tolist()):
        while table.slots[home] >= 0 and table.slots[home] != key:
            home = (home + 1) & (size - 1)
        if table.slots[home] < 0:
            table.slots[home], table.merged[home], table.rank[home] = key, new, place
    return table


def _home(keys: np.ndarray, size: int) -> np.ndarray:
    return ((keys * np.int64(-7046029254386353131)).view(np.uint64) >> np.uint64(40)).astype(np.int64) & (size - 1)


def _find(table: MergeTable, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Slot of each pair, -1 where the pair makes no piece."""
    keys = left.astype(np.int64) << 21 | right
    at = _home(keys, len(table.slots))
    seen = table.slots[at]
    out = np.where(seen == keys, at, -1)
    open_ = np.flatnonzero((seen != keys) & (seen >= 0))
    while len(open_):
        at[open_] = (at[open_] + 1) & (len(table.slots) - 1)
        seen = table.slots[at[open_]]
        out[open_[seen == keys[open_]]] = at[open_[seen == keys[open_]]]
        open_ = open_[(seen != keys[open_]) & (seen >= 0)]
    return out


def _ranks(table: MergeTable, slots: np.ndarray) -> np.ndarray:
    return np.where(slots >= 0, table.rank[slots], _NO_PAIR)


def merge_words(table: MergeTable, symbols: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Merge the words that lie one after another in ``symbols``; returns the symbols left and their number per word."""
    word = np.arange(len(size))
    done_word, done_size, done_symbols = [], [], []
    slot = np.full(len(symbols), -1, dtype=np.int64)
    if len(symbols):
        last = np.zeros(len(symbols), dtype=bool)
        last[np.cumsum(size) - 1] = True
        inner = np.flatnonzero(~last)
        slot[inner] = _find(table, symbols[inner], symbols[inner + 1])
    rank = _ranks(table, slot)
    while len(word):
        start = np.cumsum(size) - size
        best = np.minimum.reduceat(rank, start)
        live = best < _NO_PAIR
        if not live.all():                                            # finished words leave
            stay = np.repeat(live, size)
            done_word.append(word[~live])
            done_size.append(size[~live])
            done_symbols.append(symbols[~stay])
            word, size, best = word[live], size[live], best[live]
            symbols, slot, rank = symbols[stay], slot[stay], rank[stay]
            if not len(word):
                break
            start = np.cumsum(size) - size
        of = np.repeat(np.arange(len(word)), size)
        hit = np.flatnonzero(rank == best[of])                        # a word's last symbol never has a pair
        head = np.concatenate([[True], hit[1:] != hit[:-1] + 1])
        run = np.flatnonzero(head)
        hit = hit[((np.arange(len(hit)) - run[np.cumsum(head) - 1]) & 1) == 0]     # every other one of a chain
        new = table.merged[slot[hit]]
        ends = start + size - 1                                       # last symbol of each word
        # the pairs a merge creates at its time: with what stands left (maybe just merged) and, unmerged, right
        has_left, has_right = hit > start[of[hit]], hit + 1 < ends[of[hit]]
        left = symbols[np.maximum(hit - 1, 0)].copy()
        beside = np.concatenate([[False], hit[1:] == hit[:-1] + 2]) & has_left
        left[beside] = new[np.flatnonzero(beside) - 1]
        left_slot, right_slot = np.full(len(hit), -1, dtype=np.int64), np.full(len(hit), -1, dtype=np.int64)
        left_slot[has_left] = _find(table, left[has_left], new[has_left])
        right_slot[has_right] = _find(table, new[has_right], symbols[hit[has_right] + 2])
        early = np.minimum(_ranks(table, left_slot), _ranks(table, right_slot)) <= best[of[hit]]
        if early.any():                                               # such words merge their leftmost pair only
            alone = np.zeros(len(word), dtype=bool)
            alone[of[hit[early]]] = True
            first = np.concatenate([[True], of[hit[1:]] != of[hit[:-1]]])
            keep = first | ~alone[of[hit]]
            hit, new, left_slot, right_slot = hit[keep], new[keep], left_slot[keep], right_slot[keep]
            has_left, has_right = has_left[keep], has_right[keep]
        symbols = symbols.copy()
        symbols[hit] = new
        slot[hit] = right_slot
        back = hit[has_left] - 1
        slot[back] = left_slot[has_left]
        gone = np.zeros(len(symbols), dtype=bool)
        gone[hit + 1] = True
        # right of a merge may stand another merge of this round: its left slot is the pair that lasts
        behind = np.flatnonzero(np.concatenate([[False], hit[1:] == hit[:-1] + 2]) & has_left)
        slot[hit[behind] - 2] = left_slot[behind]
        rank[hit] = _ranks(table, slot[hit])
        rank[back] = _ranks(table, slot[back])
        rank[hit[behind] - 2] = _ranks(table, slot[hit[behind] - 2])
        size = size - np.bincount(of[hit], minlength=len(word))
        symbols, slot, rank = symbols[~gone], slot[~gone], rank[~gone]
    if not done_word:
        return symbols, size
    word, sizes, flat = np.concatenate(done_word), np.concatenate(done_size), np.concatenate(done_symbols)
    order = np.argsort(word, kind="stable")
    before = np.cumsum(sizes) - sizes
    sizes_in_order = sizes[order]
    stops = np.cumsum(sizes_in_order)
    at = np.repeat(before[order] - (stops - sizes_in_order), sizes_in_order) + np.arange(len(flat))
    return flat[at], sizes_in_order
