"""Texts as arrays of lower-cased letters, read block by block, and their hashed n-grams."""

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np

#: Characters read at once. Where a block ends tells nothing: n-grams and sentences go on in the next.
BLOCK = 1 << 16
_ODD = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(maxsize=1)
def _lower() -> np.ndarray:
    """The lower-cased code point of each letter, 0 for all else."""
    out = np.zeros(0x110000, np.uint32)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            out[i] = ord(low) if len(low) == 1 else i
    return out


class Block(NamedTuple):
    """A piece of a text: its place, its code points, and its letters as :func:`letters` gives them.

    The letters of all blocks in a row are those of the whole text.
    """

    offset: int
    codes: np.ndarray
    low: np.ndarray
    at: np.ndarray  # place of each letter or separator in the text, -1 for one before it


def letters(text: str) -> Iterator[Block]:
    """Lower-cased letters of a text, with one 0 after each run of them and before one that begins the text."""
    table, offset, inside = _lower(), 0, False  # inside: a run of letters is open
    while offset < len(text):
        codes = np.frombuffer(text[offset : offset + BLOCK].encode("utf-32-le", "surrogatepass"), np.uint32)
        low = table[codes]
        is_letter = low != 0
        keep = is_letter.copy()
        keep[1:] |= is_letter[:-1] & ~is_letter[1:]  # the first character after a run
        keep[0] |= inside
        at = np.flatnonzero(keep)
        low, at = low[at], at + offset
        if not offset and is_letter[0]:
            low, at = np.append(np.uint32(0), low), np.append(-1, at)
        inside = bool(is_letter[-1])
        if inside and offset + len(codes) == len(text):
            low, at = np.append(low, np.uint32(0)), np.append(at, len(text))
        yield Block(offset, codes, low, at)
        offset += len(codes)


def text_ngrams(text: str, orders: tuple[int, ...], buckets: int) -> Iterator[tuple[Block, list[np.ndarray], np.ndarray]]:
    """(block, bucket numbers of the n-grams by order, places) of a text.

    An n-gram comes with the block that it ends in; ``places`` has those of the letters that the block's
    n-grams are made of, so the n-grams of each order end at its end.
    """
    held, places = np.zeros(0, np.uint32), np.zeros(0, np.int64)
    for block in letters(text):
        before = len(held)
        low, at = np.concatenate([held, block.low]), np.concatenate([places, block.at])
        # of each order only what ends in this block: the last n - 1 letters before it count
        yield block, [ngrams(low[max(before - n + 1, 0) :], n, buckets) for n in orders], at
        keep = max(orders) - 1
        held, places = low[len(low) - min(keep, len(low)) :], at[len(at) - min(keep, len(at)) :]


def ngrams(low: np.ndarray, n: int, buckets: int) -> np.ndarray:
    """Bucket numbers, a power of two of them, of all n-grams."""
    count = len(low) - n + 1
    if count <= 0:
        return np.zeros(0, np.int64)
    wide = low.astype(np.uint64)
    h = np.full(count, n, np.uint64)
    for k in range(n):
        h ^= wide[k : k + count]
        h *= _ODD
        h ^= h >> np.uint64(29)
    return (h & np.uint64(buckets - 1)).astype(np.int64)
