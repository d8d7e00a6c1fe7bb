"""Exact BPE segmentation of text chunks as a max-plus path problem.

A token sequence is the BPE encoding of its text exactly when every token
encodes to itself and every two neighbours encode to themselves when joined.
So the encoding is the one path through the lattice of vocabulary pieces whose
neighbouring edges are compatible (weight -1 a token; -inf otherwise).  A chunk's
boundary states are the pieces that may lie across or end at its boundary; its
transfer matrix holds the best path weight from each entry to each exit state.
"""

from __future__ import annotations

import re
from array import array
from functools import lru_cache

import numpy as np
import sentencepiece

SPACE = "▁"
#: A segment: spaces and what follows them up to the next spaces.  No piece has a space mark after another
#: character, so BPE treats segments independently.
_SEGMENT = re.compile(" *[^ ]+| +$")
#: Segments that a process remembers; the older half goes when the newer is full.
MEMORY = 25_000


class Pieces:
    """A SentencePiece BPE model, its pieces and what can be derived from them."""

    def __init__(self, model: bytes):
        self.sp = sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.plain = {sp.id_to_piece(i): i for i in range(sp.get_piece_size())
                      if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))}
        if any(SPACE in p.lstrip(SPACE) for p in self.plain):
            raise ValueError("pieces that cross a word's beginning are not supported")
        self.rank = {p: sp.get_score(i) for p, i in self.plain.items()}
        self.longest = max(map(len, self.plain))
        self.byte = {b: sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)}
        self.fallback = all(sp.is_byte(i) for i in self.byte.values())
        self.bytes_of = [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else
                         b"" if sp.is_control(i) else sp.id_to_piece(i).replace(SPACE, " ").encode()
                         for i in range(sp.get_piece_size())]
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.compatible = lru_cache(100_000)(lambda a, b: self.merged(a + b) == [a, b])
        self.solid = lru_cache(25_000)(lambda a: self.merged(a) == [a])

    def merged(self, text: str) -> list[str]:
        """BPE of a short text, as pieces."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.rank.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def ids_of(self, token: str) -> list[int]:
        found = self.plain.get(token)
        if found is not None:
            return [found]
        return [self.byte[b] for b in token.encode()] if self.fallback else [self.sp.unk_id()]

    def encode_spaced(self, text: str) -> np.ndarray:
        """Ids of a text whose first character is the space before its first word; no text: no ids."""
        # a segment is known by what follows its first space, which the library adds itself
        parts = text.split(" ")[1:]
        if "" in parts:  # runs of spaces, which belong to the segment after them
            parts = [p[1:] for p in _SEGMENT.findall(text)]
        new, old = self.new, self.old
        missing = set(parts).difference(new)
        if missing:
            ask = []
            for p in missing:
                if p in old:
                    new[p] = old[p]
                else:
                    ask.append(p)
            for p, ids in zip(ask, self.sp.encode(ask, num_threads=1), strict=True):
                # a lone space is the space mark itself
                new[p] = array("i", ids if p else self.ids_of(SPACE)).tobytes()
        found = np.frombuffer(b"".join(map(new.__getitem__, parts)), np.int32)
        if len(new) > MEMORY:
            self.old, self.new = new, {}
        return found

    # chunks: s is a text with space marks, [a, b) the chunk within it

    def states(self, s: str, at: int) -> list[tuple[int, int]]:
        """Pieces (start, end) with start < at <= end, in a fixed order."""
        found = []
        for i in range(max(0, at - self.longest), at):
            for j in range(at, min(len(s), i + self.longest) + 1):
                t = s[i:j]
                if j == i + 1 or t in self.plain and self.solid(t):
                    found.append((i, j))
        return found

    def walk(self, s: str, begin: int, before: str | None, until: int, cross: bool) -> dict:
        """Pieces reached from ``begin`` after piece ``before``: (start, end) -> (weight, piece before it)."""
        reached: dict = {}
        ends: dict[int, list] = {begin: [None]}
        for i in range(begin, until):
            for j in range(i + 1, min(i + self.longest, len(s)) + 1) if i in ends else ():
                if j > until and not cross:
                    break
                t = s[i:j]
                if j > i + 1 and not (t in self.plain and self.solid(t)):
                    continue
                best = None
                for last in ends[i]:
                    left = before if last is None else s[last[0]:last[1]]
                    if left is None or self.compatible(left, t):
                        weight = -1.0 + (reached[last][0] if last else 0.0)
                        if best is None or weight > best[0]:
                            best = (weight, last)
                if best:
                    reached[i, j] = best
                    ends.setdefault(j, []).append((i, j))
        return reached

    @staticmethod
    def word_starts(s: str, a: int, b: int) -> tuple[int, int] | None:
        """First and last beginning of a word in [a, b), where every path has a token boundary."""
        at = [m.start() + 1 for m in re.finditer(f"[^{SPACE}]{SPACE}", s[max(a - 1, 0):b])]
        shift = max(a - 1, 0)
        at = [x + shift for x in at if a <= x + shift < b]
        if a == 0:
            at = [0, *at]
        return (at[0], at[-1]) if at else None

    def transfer(self, s: str, a: int, b: int, first: bool, last: bool) -> np.ndarray:
        """Max-plus transfer matrix of the chunk: entry states x exit states."""
        enter = [None] if first else self.states(s, a)
        leave = [(None, b)] if last else self.states(s, b)
        column = {x: k for k, x in enumerate(leave)}

        def exits(reached: dict, base: float) -> np.ndarray:
            row = np.full(len(leave), -np.inf)
            for (i, j), (weight, _) in reached.items():
                k = column.get((None, j) if last else (i, j))
                if k is not None:
                    row[k] = max(row[k], base + weight)
            return row

        words = self.word_starts(s, a, b)
        if words:
            head = np.full(len(enter), -np.inf)
            for k, x in enumerate(enter):
                begin = a if x is None else x[1]
                if begin == words[0]:
                    head[k] = 0.0
                else:
                    reached = self.walk(s, begin, x and s[x[0]:x[1]], words[0], False)
                    head[k] = max((w for (_, j), (w, _) in reached.items() if j == words[0]), default=-np.inf)
            return head[:, None] + exits(self.walk(s, words[1], None, b, not last), 0.0)[None, :]
        return np.array([exits(self.walk(s, a if x is None else x[1], x and s[x[0]:x[1]], b, not last), 0.0)
                         for x in enter]).reshape(len(enter), len(leave))

    def path(self, s: str, a: int, b: int, first: bool, last: bool, enter: int, leave: int) -> np.ndarray:
        """Ids of the tokens that start in the chunk, given its entry and exit state."""
        x = None if first else self.states(s, a)[enter]
        end = (None, b) if last else self.states(s, b)[leave]

        def trace(reached: dict, stop: tuple) -> np.ndarray:
            at = stop if stop[0] is not None else max(
                (t for t in reached if t[1] == stop[1]), key=lambda t: reached[t][0])
            back = []
            while at is not None:
                back.append(at)
                at = reached[at][1]
            return np.array([k for i, j in reversed(back) for k in self.ids_of(s[i:j])], np.int32)

        begin, before = (a, None) if x is None else (x[1], s[x[0]:x[1]])
        words = self.word_starts(s, a, b)
        if not words:
            return trace(self.walk(s, begin, before, b, not last), end)
        head = np.zeros(0, np.int32) if begin == words[0] else trace(self.walk(s, begin, before, words[0], False), (None, words[0]))
        middle = self.encode_spaced(s[words[0]:words[1]].replace(SPACE, " "))
        return np.concatenate([head, middle, trace(self.walk(s, words[1], None, b, not last), end)])


def product(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return (left[:, :, None] + right[None, :, :]).max(axis=1)


def chain(mats: list[np.ndarray], enter: int, leave: int) -> list[int]:
    """States at all boundaries of the best path from ``enter`` through ``mats`` to ``leave``."""
    ahead = [np.where(np.arange(mats[0].shape[0]) == enter, 0.0, -np.inf)]
    for m in mats:
        ahead.append((ahead[-1][:, None] + m).max(axis=0))
    behind = np.where(np.arange(mats[-1].shape[1]) == leave, 0.0, -np.inf)
    found = [leave]
    for k in range(len(mats) - 1, -1, -1):
        behind = (mats[k] + behind[None, :]).max(axis=1)
        found.append(int(np.argmax(ahead[k] + behind)))
    return found[::-1]


def cuts(n: int, size: int, longest: int) -> list[int]:
    """Chunk boundaries of a text of n characters; every chunk is longer than any piece."""
    if size <= longest:
        raise ValueError(f"chunks need more than {longest} characters")
    at = list(range(0, n, size))
    if len(at) > 1 and n - at[-1] <= longest:
        at.pop()
    return [*at, n]
