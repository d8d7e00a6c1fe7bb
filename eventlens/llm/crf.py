"""A two-label linear-chain CRF over hashed word features, in numpy.

Texts are handled as the bytes of a whole block of documents: words are runs of
ASCII letters, digits and non-ASCII bytes, lower-cased in ASCII; substring
hashes come from prefix sums of a polynomial, so no word is ever a Python
object.  Forward and backward passes run over blocks of the token sequence: the
2 x 2 transfer matrices of all blocks are multiplied side by side, the blocks'
boundary states follow, and all blocks are filled in side by side.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE = np.arange(256)
_IS_WORD = ((_BYTE >= 48) & (_BYTE <= 57)) | ((_BYTE | 32) >= 97) & ((_BYTE | 32) <= 122) | (_BYTE >= 128)
_LOWER = np.where((_BYTE >= 65) & (_BYTE <= 90), _BYTE + 32, _BYTE).astype(np.uint64)
#: Byte lengths of the word beginnings that are features.
PREFIXES = (3, 4, 5, 6, 7, 8)
KINDS = ("word", *(f"prefix{n}" for n in PREFIXES), "before", "after")
_powers: dict[int, np.ndarray] = {}


def _power_table(base: int, n: int) -> np.ndarray:
    found = _powers.get(base)
    if found is None or len(found) < n:
        table = np.full(max(n, 1 << 16), base, np.uint64)
        table[0] = 1
        found = _powers[base] = np.cumprod(table, dtype=np.uint64)
    return found[:n]


def _mixed(h: np.ndarray, salt: int) -> np.ndarray:
    h = (h ^ np.uint64(salt * 0xD6E8FEB86659FD93 % (1 << 64))) * np.uint64(0xFF51AFD7ED558CCD)
    return (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)


@dataclass
class Tokens:
    """Words of a block of documents: byte ranges, first-word marks, and the counts per document."""
    starts: np.ndarray
    ends: np.ndarray
    doc: np.ndarray
    first: np.ndarray
    hashes: dict[str, np.ndarray]

    def __len__(self) -> int:
        return len(self.starts)


def tokenize(offsets: np.ndarray, data: np.ndarray) -> Tokens:
    word = _IS_WORD[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True  # words end with their document
    before, after = np.r_[False, word[:-1]], np.r_[word[1:], False]
    starts = np.flatnonzero(word & (~before | edge[:-1]))
    ends = np.flatnonzero(word & (~after | edge[1:])) + 1
    doc = np.searchsorted(offsets, starts, "right") - 1
    first = np.r_[True, doc[1:] != doc[:-1]] if len(doc) else np.zeros(0, bool)
    n = len(data)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((_LOWER[data] + np.uint64(1)) * _power_table(_BASE, n), out=sums[1:], dtype=np.uint64)
    back = _power_table(_INVERSE, n + 1)[starts]
    size = ends - starts
    plain = (sums[ends] - sums[starts]) * back
    hashes = {"word": _mixed(plain, 1)}
    for i, k in enumerate(PREFIXES):
        stop = np.minimum(ends, starts + k)
        cut = _mixed((sums[stop] - sums[starts]) * back, 2 + i)
        hashes[f"prefix{k}"] = np.where(size > k, cut, np.uint64(0))  # 0: no such feature
    last = np.r_[first[1:], True] if len(first) else first
    hashes["before"] = np.where(first, np.uint64(0), _mixed(np.roll(plain, 1), 20))
    hashes["after"] = np.where(last, np.uint64(0), _mixed(np.roll(plain, -1), 21))
    return Tokens(starts, ends, doc, first, hashes)


def ranges(offsets: np.ndarray, limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of documents with at most ``limit`` bytes, or one longer document."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def tokenize_slices(offsets: np.ndarray, data: np.ndarray, limit: int = 1 << 20) -> Tokens:
    """`tokenize` some documents at a time, so that byte-wise arrays stay small."""
    parts = []
    for lo, hi in list(ranges(offsets, limit)) or [(0, 0)]:
        part = tokenize(offsets[lo:hi + 1] - offsets[lo], data[offsets[lo]:offsets[hi]])
        part.starts, part.ends, part.doc = part.starts + offsets[lo], part.ends + offsets[lo], part.doc + lo
        parts.append(part)
    join = {f: np.concatenate([getattr(p, f) for p in parts]) for f in ("starts", "ends", "doc", "first")}
    return Tokens(**join, hashes={k: np.concatenate([p.hashes.pop(k) for p in parts]) for k in KINDS})


@dataclass
class Crf:
    """Feature weights (toxic minus clean) by sorted hash, and chain parameters."""
    keys: np.ndarray
    weights: np.ndarray
    bias: float = -4.0
    start: float = 0.0
    trans: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))

    def __post_init__(self):
        self._seen = np.zeros(1 << 20, bool)  # most words fall out here
        self._seen[self.keys >> np.uint64(44)] = True

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_seen"}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.__post_init__()

    def unary(self, tokens: Tokens) -> np.ndarray:
        out = np.full(len(tokens), self.bias)
        for h in tokens.hashes.values():
            maybe = np.flatnonzero(self._seen[h >> np.uint64(44)])
            at = np.searchsorted(self.keys, h[maybe])
            at[at == len(self.keys)] = 0
            ok = self.keys[at] == h[maybe]
            out[maybe[ok]] += self.weights[at[ok]]
        return out

    def matrices(self, unary: np.ndarray, first: np.ndarray) -> np.ndarray:
        """M[t] with alpha[t] = alpha[t-1] M[t]; at a document's first word both rows are its start."""
        odds = np.exp(np.clip(unary, -30, 30))
        e = np.exp(self.trans)
        m = np.empty((4, len(unary)))
        m[0], m[1] = e[0, 0], e[0, 1] * odds
        m[2], m[3] = e[1, 0], e[1, 1] * odds
        begin = np.exp(self.start) * odds[first]
        m[0, first], m[1, first], m[2, first], m[3, first] = 1.0, begin, 1.0, begin
        return m


def forward_backward(m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Odds alpha(1)/alpha(0) and beta(1)/beta(0) of every token, from the transfer matrices."""
    n = m.shape[1]
    if not n:
        return np.zeros(0), np.zeros(0)
    size = max(1, int(np.sqrt(n)))
    blocks = -(-n // size)
    pad = np.zeros((4, blocks * size))
    pad[0], pad[3] = 1.0, 1.0
    pad[:, :n] = m
    m00, m01, m10, m11 = (x.reshape(blocks, size).T.copy() for x in pad)
    p00, p01, p10, p11 = np.ones(blocks), np.zeros(blocks), np.zeros(blocks), np.ones(blocks)
    for t in range(size):
        p00, p01, p10, p11 = (p00 * m00[t] + p01 * m10[t], p00 * m01[t] + p01 * m11[t],
                              p10 * m00[t] + p11 * m10[t], p10 * m01[t] + p11 * m11[t])
        scale = 1.0 / (p00 + p01 + p10 + p11)
        p00, p01, p10, p11 = p00 * scale, p01 * scale, p10 * scale, p11 * scale
    enter, leave = np.empty(blocks), np.empty(blocks)
    a, b = 0.0, 1.0  # the first token's matrix has equal rows: any state may precede it
    for i in range(blocks):
        enter[i] = a
        a = min((p01[i] + a * p11[i]) / max(p00[i] + a * p10[i], 1e-300), 1e150)
    for i in range(blocks - 1, -1, -1):
        leave[i] = b
        b = min((p10[i] + b * p11[i]) / max(p00[i] + b * p01[i], 1e-300), 1e150)
    alpha, beta = np.empty((size, blocks)), np.empty((size, blocks))
    a, b = enter, leave
    for t in range(size):
        a = (m01[t] + a * m11[t]) / (m00[t] + a * m10[t])
        alpha[t] = a
    for t in range(size - 1, -1, -1):
        beta[t] = b
        b = (m10[t] + b * m11[t]) / (m00[t] + b * m01[t])
    return alpha.T.ravel()[:n], beta.T.ravel()[:n]


def marginals(crf: Crf, tokens: Tokens) -> np.ndarray:
    """Probability of label 1 for every token."""
    alpha, beta = forward_backward(crf.matrices(crf.unary(tokens), tokens.first))
    odds = alpha * beta
    return odds / (1.0 + odds)


def train(tokens: Tokens, gold: np.ndarray, rounds: int = 100, rate: float = 0.5, decay: float = 1e-3,
          min_count: int = 3) -> Crf:
    """Maximum likelihood by adaptive gradient steps; features on fewer than ``min_count`` words are left out.

    The tokens' hashes are used up: each kind is let go when its features are numbered."""
    n, size = len(tokens), 0
    keys, index, where = [], [], []
    for kind in list(tokens.hashes):  # features that no word labelled 1 has are told by the bias
        h = tokens.hashes.pop(kind)
        here = np.flatnonzero((h != 0) & np.isin(h, np.unique(h[gold > 0]))).astype(np.int32)
        names, at, count = np.unique(h[here], return_inverse=True, return_counts=True)
        useful = count >= min_count
        ok = useful[at]
        keys.append(names[useful])
        index.append((np.cumsum(useful) - 1 + size)[at[ok]].astype(np.int32))
        where.append(here[ok])
        size += len(keys[-1])
    keys, index, where = np.concatenate(keys), np.concatenate(index), np.concatenate(where)
    order = np.argsort(keys)
    rank = np.empty(len(keys), np.int32)
    rank[order] = np.arange(len(keys), dtype=np.int32)
    keys, index = keys[order], rank[index]
    crf = Crf(keys, np.zeros(len(keys)), bias=float(np.log((gold.sum() + 1) / (n + 2))))
    inner = np.flatnonzero(~tokens.first)
    pair = (2 * gold[inner - 1] + gold[inner]).astype(np.int64)
    seen = np.bincount(pair, minlength=4).astype(float)
    memory = [np.full(len(keys), 1e-8), 1e-8, 1e-8, np.full((2, 2), 1e-8)]
    for _ in range(rounds):
        unary = np.full(n, crf.bias) + np.bincount(where, crf.weights[index], n)
        m = crf.matrices(unary, tokens.first)
        alpha, beta = forward_backward(m)
        odds = alpha * beta
        p = odds / (1 + odds)
        a, b, u = alpha[inner - 1], beta[inner], np.exp(np.clip(unary[inner], -30, 30))
        e = np.exp(crf.trans)
        joint = np.stack([np.full(len(a), e[0, 0]), e[0, 1] * u * b, a * e[1, 0], a * e[1, 1] * u * b])
        expected = (joint / joint.sum(axis=0)).sum(axis=1)
        miss = gold - p
        steps = [np.bincount(index, miss[where], len(keys)) - decay * crf.weights,
                 miss.sum(), miss[tokens.first].sum() - decay * crf.start,
                 (seen - expected).reshape(2, 2) - decay * crf.trans]
        memory = [x + s * s for x, s in zip(memory, steps, strict=True)]
        moved = [rate * s / np.sqrt(x) for s, x in zip(steps, memory, strict=True)]
        crf.weights = crf.weights + moved[0]
        crf.bias, crf.start, crf.trans = crf.bias + moved[1], crf.start + moved[2], crf.trans + moved[3]
    strong = np.abs(crf.weights) > 0.05
    return Crf(keys[strong], crf.weights[strong], crf.bias, crf.start, crf.trans)
