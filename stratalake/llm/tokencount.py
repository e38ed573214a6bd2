"""Edit-aware token counts: a segment tree over the pre-tokens of each document.

An edit encodes anew only the pre-tokens it touches, with the context that may change their
bounds, and updates the sums on the way to the root. Trees are a stored table: later edits start
from it.
"""

import base64
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pre-tokens of a leaf.
LEAF = 32
#: A pre-token's bounds depend on at most this many characters after it: one that shows that
#: it ends, or the rest of a contraction.
CONTEXT = 2
_CACHE = 500_000


class Vocabulary:
    """Pre-tokens of a text and their token counts, each distinct one encoded once while cached."""

    def __init__(self, file: str) -> None:
        import tiktoken

        with open(file, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("counts", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.counts: dict[str, int] = {}

    def count(self, piece: str) -> int:
        n = self.counts.get(piece)
        if n is None:
            if len(self.counts) >= _CACHE:
                self.counts.clear()
            n = self.counts[piece] = len(self.encoding.encode_ordinary(piece))
        return n


@lru_cache(maxsize=2)
def vocabulary(file: str) -> Vocabulary:
    return Vocabulary(file)


class Edit(NamedTuple):
    """Characters from start to before end give way to a text; offsets are of the text so far."""

    start: int
    end: int
    text: str


class CountTree:
    """Token counts of one text, kept through edits.

    Leaves hold the lengths and counts of LEAF pre-tokens at first, of up to four times as many
    after edits; every node has the characters and tokens below it. ``pieces`` are the lengths and
    counts of the pre-tokens of a text that was encoded before.
    """

    def __init__(self, text: str, words: Vocabulary, pieces: tuple[list[int], list[int]] | None = None) -> None:
        self.text, self.words, self.encoded = text, words, 0
        if pieces is None:
            found = words.pattern.findall(text)
            self.encoded = len(found)
            pieces = list(map(len, found)), list(map(words.count, found))
        self._lay_out(*pieces)

    def _lay_out(self, sizes: list[int], counts: list[int]) -> None:
        cuts = range(0, max(1, len(sizes)), LEAF)
        self.leaves = [(sizes[c : c + LEAF], counts[c : c + LEAF]) for c in cuts]
        self.width = 1 << (len(self.leaves) - 1).bit_length()
        self.chars, self.tokens = [0] * (2 * self.width), [0] * (2 * self.width)
        for i, (s, n) in enumerate(self.leaves):
            self.chars[self.width + i], self.tokens[self.width + i] = sum(s), sum(n)
        for node in range(self.width - 1, 0, -1):
            self._add_up(node)

    def pieces(self) -> tuple[list[int], list[int]]:
        """Lengths and counts of all pre-tokens, which are all that a tree is made of beside its text."""
        return [s for leaf in self.leaves for s in leaf[0]], [n for leaf in self.leaves for n in leaf[1]]

    def _add_up(self, node: int) -> None:
        self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
        self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    def __len__(self) -> int:
        return self.tokens[1]

    def _leaf_at(self, place: int) -> tuple[int, int]:
        """The leaf that holds a character, and where the leaf begins."""
        node, at = 1, 0
        while node < self.width:
            node *= 2
            if place >= at + self.chars[node] and self.chars[node + 1]:
                at += self.chars[node]
                node += 1
        return node - self.width, at

    def tokens_before(self, place: int) -> int:
        """Tokens of the pre-tokens that end at or before a character."""
        leaf, at = self._leaf_at(place)
        node, total = leaf + self.width, 0
        while node > 1:
            if node % 2:
                total += self.tokens[node - 1]
            node //= 2
        for size, n in zip(*self.leaves[leaf]):
            at += size
            if at > place:
                break
            total += n
        return total

    def apply(self, edit: Edit) -> None:
        """Offsets beyond the text are cut to it; an end before the start is the start."""
        start = min(max(edit.start, 0), len(self.text))
        end = min(max(edit.end, start), len(self.text))
        first, at = self._leaf_at(max(0, start - CONTEXT))
        sizes, counts = self.leaves[first]
        skip = 0
        while skip < len(sizes) and at + sizes[skip] + CONTEXT <= start:
            at += sizes[skip]
            skip += 1
        head = (sizes[:skip], counts[:skip])
        text = self.text[:start] + edit.text + self.text[end:]
        grown = len(text) - len(self.text)
        new_sizes, new_counts = [], []
        # Old bounds from here on, leaf by leaf, until a new bound meets one after the edit.
        leaf, old, place, rest = first, at, skip, sizes
        position, over = at, start + len(edit.text)
        while position < len(text):
            while old + grown < position or old < end:  # the next old bound that new text could meet
                while place == len(rest) and leaf + 1 < len(self.leaves):
                    leaf, place = leaf + 1, 0
                    rest = self.leaves[leaf][0]
                if place == len(rest):
                    break
                old += rest[place]
                place += 1
            if position >= over and old >= end and old + grown == position:
                break
            found = self.words.pattern.match(text, position)
            piece = found.group()
            new_sizes.append(len(piece))
            new_counts.append(self.words.count(piece))
            position = found.end()
        else:
            leaf, place = len(self.leaves) - 1, len(self.leaves[-1][0])
        self.encoded += len(new_sizes)
        self.text = text
        tail = tuple(x[place:] for x in self.leaves[leaf])
        for i in range(first, leaf + 1):
            self.leaves[i] = ([], [])
        self.leaves[first] = (head[0] + new_sizes, head[1] + new_counts)
        if leaf == first:
            self.leaves[first] = (self.leaves[first][0] + tail[0], self.leaves[first][1] + tail[1])
        else:
            self.leaves[leaf] = tail
        if max(len(self.leaves[first][0]), len(self.leaves[leaf][0])) > 4 * LEAF:
            self._lay_out(*self.pieces())  # after 3 * LEAF new pre-tokens at least; nothing is encoded
        else:
            self._update(first, leaf)

    def _update(self, first: int, last: int) -> None:
        for i in range(first, last + 1):
            self.chars[self.width + i], self.tokens[self.width + i] = sum(self.leaves[i][0]), sum(self.leaves[i][1])
        low, high = (first + self.width) // 2, (last + self.width) // 2
        while low:
            for node in range(low, high + 1):
                self._add_up(node)
            low, high = low // 2, high // 2


_TREE = "doc_id long, text string, sizes array<int>, counts array<int>"
_COUNTED = "n_tokens long, n_tokens_edited long, n_chars_edited long, n_pretokens long, n_encoded_again long"
#: Characters of texts after which a batch of trees is handed on.
_FULL = 1 << 21


def _lists(lists: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, lists)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(lists), pa.int32()))


def _row(doc_id: int | None, tree: CountTree) -> tuple:
    return doc_id, tree.text, *(np.array(x, np.int32) for x in tree.pieces())


def _tree_columns(trees: list[tuple]) -> list[pa.Array]:
    ids, texts, sizes, counts = zip(*trees)
    return [pa.array(ids, pa.int64()), pa.array(texts, pa.string()), _lists(sizes), _lists(counts)]


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def count_trees(docs: DataFrame, file: str) -> DataFrame:
    """(doc_id, text, sizes, counts): the tree of every row, to be stored.

    ``sizes`` and ``counts`` are the characters and tokens of each pre-token, the leaves of the
    tree; its inner sums follow from them without encoding. A null text is empty and has none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(file)
        for batch in batches:
            out, held = [], 0
            for i, doc_id in enumerate(batch.column(0).to_pylist()):
                tree = CountTree(batch.column(1)[i].as_py() or "", words)
                out.append(_row(doc_id, tree))
                held += len(tree.text)
                if held >= _FULL or i + 1 == batch.num_rows:
                    yield pa.RecordBatch.from_arrays(_tree_columns(out), names=_names(_TREE))
                    out, held = [], 0

    return docs.select("doc_id", "text").mapInArrow(run, _TREE)


def with_edits(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """``rows`` with edits of a table (doc_id, seq, start, end, text) as a sorted list in each.

    Edits of a null doc_id are ignored; all rows of a doc_id get its edits.
    """
    row = F.struct("seq", "start", "end", "text")
    lists = edits.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("_d")).agg(F.sort_array(F.collect_list(row)).alias("edits"))
    lists = lists.select("_d", F.expr("transform(edits, e -> struct(e.start, e.end, e.text))").alias("edits"))
    return rows.drop("edits").join(lists, F.col("doc_id") == F.col("_d"), "left").drop("_d")


def edited_trees(trees: DataFrame, file: str, keep: bool = True) -> DataFrame:
    """Stored trees after their edits, and what was counted: n_tokens before, n_tokens_edited, n_chars_edited, n_pretokens before, n_encoded_again.

    ``trees``: as :func:`count_trees` or this function gave them, and edits, an array of
    (start, end, text) in code points applied in order; a null list has no edits, a null start or
    end is 0, a null replacement is empty. Only pre-tokens that an edit touches are encoded. Nothing
    is shuffled; one document's tree is in memory at a time. Without ``keep`` (doc_id and the counts) only.
    """
    schema = f"{_TREE}, {_COUNTED}" if keep else f"doc_id long, {_COUNTED}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(file)
        for batch in batches:
            lists = [(c.offsets.to_numpy(), c.values.to_numpy()) for c in (batch.column(2), batch.column(3))]
            kept, counted, held = [], [], 0
            for i, doc_id in enumerate(batch.column(0).to_pylist()):
                pieces = tuple(values[ends[i] : ends[i + 1]].tolist() for ends, values in lists)
                tree = CountTree(batch.column(1)[i].as_py() or "", words, pieces)
                before = len(tree)
                for e in batch.column(4)[i].as_py() or []:
                    tree.apply(Edit(e["start"] or 0, e["end"] or 0, e["text"] or ""))
                counted.append((before, len(tree), len(tree.text), len(pieces[0]), tree.encoded))
                kept.append(_row(doc_id, tree) if keep else doc_id)
                held += len(tree.text) if keep else 0
                if held >= _FULL or i + 1 == batch.num_rows:
                    columns = _tree_columns(kept) if keep else [pa.array(kept, pa.int64())]
                    columns += [pa.array(c, pa.int64()) for c in zip(*counted)]
                    yield pa.RecordBatch.from_arrays(columns, names=_names(schema))
                    kept, counted, held = [], [], 0

    return trees.select(*_names(_TREE), "edits").mapInArrow(run, schema)


def edited_counts(trees: DataFrame, file: str) -> DataFrame:
    """(doc_id, n_tokens, n_tokens_edited, n_chars_edited, n_pretokens, n_encoded_again) of stored trees with edits."""
    return edited_trees(trees, file, keep=False)
