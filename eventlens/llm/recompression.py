"""A run-length grammar by recompression, and longest common extensions on it, in numpy.

A sequence of symbols is shortened level by level, by turns:

* block compression names every stretch of one repeated symbol (symbol, times);
* pair compression deals the symbols out to a left and a right part by a hash
  and names every left symbol with the right symbol after it.

Symbols that occur once can match nothing, so neighbours among them become one.
Where a level cuts depends on the two symbols beside the cut alone; equal
stretches are therefore cut alike but for their edges, and a common extension
climbs the levels while its ends are cuts on both sides and comes down again,
with one step at most on every level.

Names are exact (a name for each distinct block or pair), so extensions are too.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

_ODD = np.uint64(0x9E3779B97F4A7C15)


def _spread(symbols: np.ndarray, salt: int) -> np.ndarray:
    h = (symbols.astype(np.uint64) + np.uint64(salt + 1)) * _ODD
    return (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)


def once(symbols: np.ndarray) -> np.ndarray:
    """True for symbols that surely occur once (a table of hash counts: some of them may be missed, all occurrences of a
    symbol alike)."""
    bits = max(4, int(2 * len(symbols)).bit_length())
    place = (_spread(symbols, 0) >> np.uint64(64 - bits)).astype(np.int64)
    return np.bincount(place, minlength=1 << bits)[place] == 1


@dataclass
class Grammar:
    """Levels of symbols; ``first[k][j]``: where the children of symbol j of level k + 1 begin in level k (one more
    entry ends the last); ``parent[k][i]``: the symbol of level k + 1 above symbol i; ``block[k]``: children are equal."""
    symbols: list[np.ndarray]
    first: list[np.ndarray] = field(default_factory=list)
    parent: list[np.ndarray] = field(default_factory=list)
    block: list[bool] = field(default_factory=list)

    def _push(self, head: np.ndarray, symbols: np.ndarray, block: bool) -> None:
        at = np.flatnonzero(head)
        self.first.append(np.append(at, len(head)).astype(np.int32))
        self.parent.append((np.cumsum(head) - 1).astype(np.int32))
        self.block.append(block)
        self.symbols.append(symbols)

    def extend(self, a: np.ndarray, b: np.ndarray, back: bool = False) -> np.ndarray:
        """How many symbols of level 0 agree from positions ``a`` and ``b`` on (a < b), or before them if ``back``.

        The sequence must begin and end with symbols that occur once."""
        way = -1 if back else 1
        x, y = (a - 1, b - 1) if back else (a.copy(), b.copy())
        begin = x.copy()
        apart = np.zeros(len(x), np.int64)  # the level on which they were found to differ
        live, top = np.arange(len(x)), len(self.first)
        for level in range(top + 1):
            s = self.symbols[level]
            live = live[s[x[live]] == s[y[live]]]
            if not len(live):
                break
            apart[live] = level
            if level == top:  # no two neighbours here can match
                x[live] += way
                y[live] += way
                break
            first, parent = self.first[level], self.parent[level]
            i, j = x[live], y[live]
            p, q = parent[i], parent[j]
            if back:
                left_i, left_j = i - first[p] + 1, j - first[q] + 1
                inside = (first[p + 1] - 1 != i) | (first[q + 1] - 1 != j)
            else:
                left_i, left_j = first[p + 1] - i, first[q + 1] - j
                inside = (first[p] != i) | (first[q] != j)
            if inside.any():
                step = np.where(inside, np.minimum(left_i, left_j), 0) * way
                i, j = i + step, j + step
                x[live], y[live] = i, j
                same = s[i] == s[j]
                live, i, j = live[same], i[same], j[same]
            apart[live] = level + 1
            x[live], y[live] = parent[i], parent[j]
        for level in range(int(apart.max(initial=0)) - 1, -1, -1):
            live = np.flatnonzero(apart > level)
            s, first = self.symbols[level], self.first[level]
            p, q = x[live], y[live]
            i, j = (first[p + 1] - 1, first[q + 1] - 1) if back else (first[p], first[q])
            same = s[i] == s[j]
            step = np.minimum(first[p + 1] - first[p], first[q + 1] - first[q]) if self.block[level] else 1
            x[live] = i + np.where(same, step, 0) * way
            y[live] = j + np.where(same, step, 0) * way
        return (x - begin) * way


def recompress(symbols: np.ndarray, single: np.ndarray) -> Grammar:
    """The grammar of a sequence; ``single`` marks symbols that are known to occur once."""
    known, names = np.unique(symbols[~single], return_inverse=True)
    s = np.empty(len(symbols), np.int64)
    s[~single] = names
    s[single] = len(known) + np.arange(int(single.sum()))
    grammar, fresh, turn = Grammar([s]), len(known) + int(single.sum()), 0
    while True:
        same = s[1:] == s[:-1]
        if same.any():
            head = np.append(True, ~same)
            at = np.flatnonzero(head)
            times = np.diff(np.append(at, len(s)))
            s = s[at]
            many = np.flatnonzero(times > 1)
            known, names = np.unique((s[many] << 31) | times[many], return_inverse=True)
            s[many] = fresh + names
            fresh += len(known)
            grammar._push(head, s, True)
        single = once(s)
        if not (~single[1:] & ~single[:-1]).any():
            return grammar
        turn += 1
        side = (_spread(s, turn) >> np.uint64(63)).astype(bool)
        ways = [~single[:-1] & ~single[1:] & x[:-1] & ~x[1:] for x in (side, ~side)]
        pair = max(ways, key=np.count_nonzero)
        head = np.append(True, ~(pair | (single[1:] & single[:-1])))
        if head.all():
            continue
        at = np.flatnonzero(head)
        paired = np.append(pair, False)[at]
        left = at[paired]
        known, names = np.unique((s[left] << 31) | s[left + 1], return_inverse=True)
        merged = ~paired & (np.diff(np.append(at, len(s))) > 1)
        s = s[at]
        s[paired] = fresh + names
        fresh += len(known)
        s[merged] = fresh + np.arange(int(merged.sum()))
        fresh += int(merged.sum())
        grammar._push(head, s, False)
