"""A word-level FM-index with vectorised backward search.

The Burrows-Wheeler transform is kept in a wavelet matrix of packed bits with a rank sample every 64 bits; of the suffix
array only the rows of every SAMPLE-th place of the text and of the heads of its parts stay, and others are found by walking back to one. Lengths
of common prefixes, a byte a row, give the shorter match when a longer one can't be extended. All queries of a
batch take a step together, so a step is a few vector operations a level.
"""

from __future__ import annotations

import numpy as np

SAMPLE = 8
#: Steps, as powers of two, in which the rows that share a prefix are looked for.
_STEPS = (12, 9, 6, 3, 0)


class Bits:
    """A bit vector with rank."""

    def __init__(self, bits: np.ndarray) -> None:
        packed = np.packbits(np.append(bits, np.zeros(-len(bits) % 64 + 64, bool)), bitorder="little").view(np.uint64)
        self.words = packed
        self.samples = np.append(0, np.cumsum(np.bitwise_count(packed), dtype=np.int64))[:-1].astype(np.int32)

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones before each i."""
        at = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.samples[at] + np.bitwise_count(self.words[at] & mask)

    def get(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64) & np.uint64(1)).astype(bool)


def dense(*keys: np.ndarray) -> np.ndarray:
    """Ranks, from 0, of tuples of ranks."""
    out = keys[0].astype(np.int64)
    for k in keys[1:]:
        out = np.unique(out * (int(k.max()) + 1) + k, return_inverse=True)[1]
    return out


def shifted(rank: np.ndarray, n: int) -> np.ndarray:
    return np.append(rank[n:], np.zeros(min(n, len(rank)), rank.dtype))


class FMIndex:
    """Of a text of symbols (0 separates its parts and ends it), for patterns of up to `depth` symbols without 0."""

    def __init__(self, text: np.ndarray, depth: int) -> None:
        self.depth, self.n = depth, len(text)
        # prefix doubling until all differ; each separator is a symbol of its own, so that is at most the longest part
        ends = text == 0
        ranks, power = [np.unique(np.where(ends, np.cumsum(ends) - 1, text + int(ends.sum())), return_inverse=True)[1]], 1
        while power <= depth or (power < self.n and int(ranks[-1].max(initial=0)) < self.n - 1):
            ranks.append(dense(ranks[-1], shifted(ranks[-1], power)))
            power *= 2
        suffixes = np.argsort(ranks[-1], kind="stable")
        # symbols that a row shares with the one before, depth at most; none across the ends
        same = np.zeros(self.n - 1, np.int64)
        for j in range(len(ranks) - 1, -1, -1):
            a, b = suffixes[:-1] + same, suffixes[1:] + same
            inside = np.maximum(a, b) + (1 << j) <= self.n
            same[inside] += np.where(ranks[j][a[inside]] == ranks[j][b[inside]], 1 << j, 0)
        shared = np.zeros(self.n + 1, np.uint8)
        shared[1:-1] = np.minimum(same, depth)
        self.shared = {0: shared}
        for j in range(1, _STEPS[0] + 1):
            last = self.shared[j - 1]
            self.shared[j] = np.minimum(last[: max(0, len(last) - (1 << j - 1))], last[1 << j - 1 :])
        self.shared = {j: self.shared[j] for j in _STEPS}
        size = int(text.max(initial=0)) + 1
        self.starts = np.append(0, np.cumsum(np.bincount(text, minlength=size)))
        self.levels, self.zeros, row = [], [], text[suffixes - 1]
        for shift in range(max(1, (size - 1).bit_length()) - 1, -1, -1):
            bits = (row >> shift & 1).astype(bool)
            self.levels.append(Bits(bits))
            self.zeros.append(int(len(bits) - bits.sum()))
            row = np.concatenate([row[~bits], row[bits]])
        self.base = self._walk(np.arange(size), np.zeros(size, np.int64))
        kept = (suffixes % SAMPLE == 0) | ends[suffixes - 1]  # no walk goes over a separator
        self.marks, self.samples = Bits(kept), suffixes[kept].astype(np.int32)

    def _walk(self, symbols: np.ndarray, i: np.ndarray) -> np.ndarray:
        for k, (level, zeros) in enumerate(zip(self.levels, self.zeros, strict=True)):
            one = (symbols >> (len(self.levels) - 1 - k) & 1).astype(bool)
            r = level.rank(i)
            i = np.where(one, zeros + r, i - r)
        return i

    def extend(self, symbols: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One step of backward search: the rows of symbol + pattern from those of the pattern."""
        both = self._walk(np.concatenate([symbols, symbols]), np.concatenate([lo, hi]))
        both = both - np.tile(self.base[symbols], 2) + np.tile(self.starts[symbols], 2)
        return both[: len(symbols)], both[len(symbols) :]

    def widened(self, lo: np.ndarray, hi: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All rows that share `length` symbols with the rows lo to hi (exclusive)."""
        lo, hi = np.where(length > 0, lo, 0), np.where(length > 0, hi, self.n)
        some = np.flatnonzero(length)
        for j in _STEPS:
            least, step = self.shared[j], 1 << j
            move = some
            while len(move):  # the step rows up to lo share enough with the one before each
                at = lo[move] - step + 1
                fits = (at > 0) & (at < len(least))
                move = move[fits]
                move = move[least[at[fits]] >= length[move]]
                lo[move] -= step
            move = some
            while len(move):
                move = move[hi[move] < len(least)]
                move = move[(least[hi[move]] >= length[move]) & (hi[move] + step <= self.n)]
                hi[move] += step
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Places in the text of the suffixes of rows."""
        at, steps, out = rows.copy(), 0, np.empty(len(rows), np.int64)
        left = np.arange(len(rows))
        while len(left):
            found = self.marks.get(at)
            out[left[found]] = self.samples[self.marks.rank(at[found])] + steps
            left, at = left[~found], at[~found]
            symbols = np.zeros(len(at), np.int64)
            for level, zeros in zip(self.levels, self.zeros, strict=True):
                one, r = level.get(at), level.rank(at)
                symbols = symbols * 2 + one
                at = np.where(one, zeros + r, at - r)
            at = at - self.base[symbols] + self.starts[symbols]
            steps += 1
        return out

    def matching(self, text: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Matching statistics, capped at depth, of the queries text[begin:end] (0: a symbol that is not indexed).

        Given are the positions that start a match of `depth` symbols, and its rows. Queries are read from the right. A match that a
        symbol does not extend is shortened on the right, to what its rows share with a neighbour, until it does.
        """
        order = np.argsort(begin - end, kind="stable")  # longest first
        begin, end = begin[order], end[order]
        lo, hi, length = np.zeros(len(begin), np.int64), np.full(len(begin), self.n), np.zeros(len(begin), np.int64)
        where, los, his = [], [], []
        for t in range(int((end - begin).max(initial=0))):
            k = int(np.searchsorted(begin - end, -t, "left"))  # queries longer than t
            at = end[:k] - 1 - t
            symbols = text[at]
            unknown = np.flatnonzero(symbols == 0)
            lo[unknown], hi[unknown], length[unknown] = 0, self.n, 0
            todo = np.flatnonzero(symbols)
            while len(todo):
                a, b = self.extend(symbols[todo], lo[todo], hi[todo])
                met = a < b
                won = todo[met]
                lo[won], hi[won], length[won] = a[met], b[met], length[won] + 1
                todo = todo[~met]  # a symbol of the index always extends the empty match
                less = np.maximum(self.shared[0][lo[todo]], self.shared[0][hi[todo]]).astype(np.int64)
                lo[todo], hi[todo] = self.widened(lo[todo], hi[todo], less)
                length[todo] = less
            over = np.flatnonzero(length[:k] > self.depth)
            lo[over], hi[over] = self.widened(lo[over], hi[over], np.full(len(over), self.depth))
            length[over] = self.depth
            done = length[:k] == self.depth
            where.append(at[done])
            los.append(lo[:k][done])
            his.append(hi[:k][done])
        return tuple(np.concatenate(x) if x else np.zeros(0, np.int64) for x in (where, los, his))
