"""Sorting suffixes by hash: equal strings of a fixed length in arrays of bytes.

Prefix polynomial hashes give the hash of any substring; a binary search over them finds how
far two suffixes agree, so a comparison takes a logarithmic number of look-ups. All
comparisons of a merge step are made at once. The result is checked against the bytes.
"""

from functools import lru_cache

import numpy as np

_MASK = (1 << 64) - 1
#: Base of the polynomials, modulo 2^64, and the constants that mix bits (fixed values).
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """A scrambled number for each byte."""
    return mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(MIX[0])
    x = (x ^ (x >> np.uint64(27))) * np.uint64(MIX[1])
    return x ^ (x >> np.uint64(31))


_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64, by doubling."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        have, step = np.ones(1, np.uint64), base
        while len(have) < n:
            have, step = np.concatenate([have, have * np.uint64(step)]), step * step & _MASK
        _POWERS[base] = have
    return have[:n]


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of every prefix of some bytes, the empty one first."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_letters()[data] * powers(BASE, len(data)), out=out[1:])
    return out


def substring_hashes(prefix: np.ndarray, at: np.ndarray, length) -> np.ndarray:
    """Hashes of the substrings from ``at`` of a length, or of each one's own length."""
    return (prefix[at + length] - prefix[at]) * powers(INVERSE, len(prefix))[at]


class Suffixes:
    """Suffixes of some bytes, compared by their first ``length`` bytes."""

    def __init__(self, data: np.ndarray, length: int, prefix: np.ndarray | None = None) -> None:
        self.data, self.length = data, length
        self.prefix = prefix_hashes(data) if prefix is None else prefix
        self.windows = np.lib.stride_tricks.sliding_window_view(data, length)

    def common(self, p: np.ndarray, q: np.ndarray) -> np.ndarray:
        """How many bytes each pair has in common, by binary search over hashes."""
        low, high = np.zeros(len(p), np.int64), np.full(len(p), self.length)
        while (low < high).any():
            middle = (low + high + 1) >> 1
            same = substring_hashes(self.prefix, p, middle) == substring_hashes(self.prefix, q, middle)
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        return low

    def less(self, p: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Whether p sorts before q."""
        at = self.common(p, q)
        short = at < self.length
        out = np.zeros(len(p), bool)
        out[short] = self.data[p[short] + at[short]] < self.data[q[short] + at[short]]
        return out

    def sort(self, starts: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Stable mergesort of suffixes within groups; ``group`` is sorted.

        Gives the order, and for each place whether its suffix equals the one before it in
        its group. Adjacent suffixes are compared by their bytes; a group where hashes had
        misled the order is sorted by its bytes instead.
        """
        n = len(starts)
        order = np.arange(n)
        first = np.flatnonzero(np.append(True, group[1:] != group[:-1])) if n else np.zeros(0, np.int64)
        begin = np.repeat(first, np.diff(np.append(first, n)))
        end = np.repeat(np.append(first[1:], n), np.diff(np.append(first, n)))
        inside = np.arange(n) - begin
        width, longest = 1, int((end - begin).max()) if n else 0
        while width < longest:
            run = inside // width
            own = begin + run * width  # where the element's run begins
            left = run % 2 == 0
            other = np.where(left, own + width, own - width)
            low = np.minimum(other, end)
            high = np.minimum(other + width, end)
            todo = np.flatnonzero((end - begin > width) & (low < high))
            moved = np.arange(n)
            moved[todo] += self._before(order, starts, todo, low[todo], high[todo], left[todo]) - np.where(left[todo], 0, width)
            new = np.empty_like(order)
            new[moved] = order
            order, width = new, width * 2
        equal, wrong = self._checked(starts[order], group)
        if len(wrong):
            for g in wrong:
                part = np.flatnonzero(group == g)
                keys = [self.windows[starts[i]].tobytes() for i in part]
                order[part] = part[sorted(range(len(part)), key=lambda k: (keys[k], k))]
            equal, _ = self._checked(starts[order], group)
        return order, equal

    def _before(self, order, starts, which, low, high, left) -> np.ndarray:
        """How many of the sibling run's elements go before each one: less ones, for the right run equal ones too."""
        base = low.copy()
        mine = starts[order[which]]
        low, high = low.copy(), high.copy()
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                return low - base
            middle = (low[open_] + high[open_]) >> 1
            theirs, own = starts[order[middle]], mine[open_]
            is_left = left[open_]
            before = np.empty(len(open_), bool)
            before[is_left] = self.less(theirs[is_left], own[is_left])
            before[~is_left] = ~self.less(own[~is_left], theirs[~is_left])
            low[open_] = np.where(before, middle + 1, low[open_])
            high[open_] = np.where(before, high[open_], middle)

    def _checked(self, starts: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Equality with the place before, by bytes, and the groups that aren't in order."""
        equal = np.zeros(len(starts), bool)
        wrong = set()
        pair = np.flatnonzero(group[1:] == group[:-1]) + 1 if len(starts) else np.zeros(0, np.int64)
        for at in range(0, len(pair), 1 << 16):
            some = pair[at : at + (1 << 16)]
            a, b = self.windows[starts[some - 1]], self.windows[starts[some]]
            differ = a != b
            same = ~differ.any(1)
            equal[some] = same
            where = differ.argmax(1)
            rows = np.arange(len(some))
            bad = ~same & (a[rows, where] > b[rows, where])
            wrong.update(group[some[bad]].tolist())
        return equal, np.array(sorted(wrong), np.int64)
