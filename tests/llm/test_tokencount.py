import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_rows import documents

from stratalake.llm import tokencount
from stratalake.llm.common import stored
from stratalake.llm.queries import op6_token_counts
from stratalake.llm.tokencount import CountTree, Edit, count_trees, edited_counts, edited_trees, vocabulary, with_edits

FILE = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORDS = vocabulary(FILE)
ALPHABET = st.text(alphabet="ab's 're1\n\té.!", max_size=60)
EDITS = st.lists(st.tuples(st.integers(-5, 70), st.integers(-5, 70), st.text(alphabet="a'rel s\n1é", max_size=12)), max_size=6)


def plain(text):
    return len(WORDS.encoding.encode_ordinary(text))


def edited(text, start, end, new):
    start = min(max(start, 0), len(text))
    end = min(max(end, start), len(text))
    return text[:start] + new + text[end:]


def check(text, edits):
    tree = CountTree(text, WORDS)
    assert len(tree) == plain(text)
    for e in edits:
        text = edited(text, *e)
        tree.apply(Edit(*e))
        assert tree.text == text and len(tree) == plain(text), (text, e)
        assert tree.chars[1] == len(text)
        pieces = [s for leaf in tree.leaves for s in leaf[0]]
        assert pieces == list(map(len, WORDS.pattern.findall(text)))


@settings(max_examples=400, deadline=None)
@given(ALPHABET, EDITS)
def test_small_texts(text, edits):
    tokencount.LEAF = 3
    try:
        check(text, edits)
    finally:
        tokencount.LEAF = 32


def test_long_text_encodes_little():
    rng = random.Random(1)
    text = " ".join(rng.choice(["alpha", "it's", "12", "\n\n ", "é."]) for _ in range(20_000))
    edits = [(rng.randrange(len(text)), rng.randrange(len(text)), rng.choice(["", "x", " 're ", "\n"])) for _ in range(3)]
    check(text, [(a, a + 5, t) for a, _, t in edits])
    tree = CountTree(text, WORDS)
    built = tree.encoded
    tree.apply(Edit(50_000, 50_010, "'re new words"))
    assert tree.encoded - built < 12
    cut = WORDS.pattern.findall(tree.text)
    at = sum(map(len, cut[:9000]))
    assert tree.tokens_before(at) == sum(map(WORDS.count, cut[:9000]))


def by_plain(rows, edits_of):
    out = []
    for doc_id, text in rows:
        new = text or ""
        for e in edits_of(doc_id, new):
            new = edited(new, *e)
        out.append((doc_id, plain(text or ""), plain(new), len(new)))
    return sorted(out, key=str)


def test_query(spark, folder, clash):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice(["alpha", "it's", "12", "\n\n ", "é."]) for _ in range(rng.randrange(90)))) for i in range(150)]
    rows += [(900, None), (901, ""), (None, "some words here"), (5, rows[5][1]), (902, "x" * 200_000)]

    def edits(_, t):
        word = t.split(" ")[1] if len(t.split(" ")) > 1 else ""
        n = len(t)
        return [(n // 4, n // 4, word), (n // 2, n // 2 + 7, "\n  " + t[:20]), (n - 9, n + 99, ".")]

    got = op6_token_counts(spark, folder(documents=clash(documents(spark, rows)))).collect()
    assert sorted((tuple(r)[:4] for r in got), key=str) == by_plain(rows, edits)
    assert op6_token_counts(spark, folder(documents=documents(spark, []))).count() == 0


@pytest.mark.parametrize("none", [False, True])
def test_edits_of_a_table(spark, none):
    rows = [(1, "one two three"), (2, "four's five"), (None, "six"), (1, "seven"), (3, None)]
    edits = [(1, 2, 0, 3, "1"), (1, 1, 4, 4, "x"), (3, 1, 0, 0, "new"), (None, 1, 0, 1, "z"), (2, 1, None, None, None)][: 0 if none else 9]
    table = spark.createDataFrame(edits, "doc_id long, seq int, start int, end int, text string")
    trees = stored(count_trees(documents(spark, rows), FILE), "trees")
    got = edited_counts(with_edits(trees, table), FILE).collect()
    of = {} if none else {1: [(4, 4, "x"), (0, 3, "1")], 3: [(0, 0, "new")]}
    assert sorted((tuple(r)[:4] for r in got), key=str) == by_plain(rows, lambda d, _: of.get(d, []))


def test_stored_trees_take_later_edits(spark):
    """Two sittings, the second from what the first stored; only what is touched is encoded."""
    rng = random.Random(5)
    text = lambda n: " ".join(rng.choice(["alpha", "it's", "12", "\n\n ", "é."]) for _ in range(n))
    rows = [(i, text(400)) for i in range(40)] + [(90, None), (91, ""), (92, "x" * 50_000)]
    made = [(d, k, rng.randrange(1500), "'re b " * rng.randrange(3)) for d, _ in rows for k in range(4)]
    edits = spark.createDataFrame([(d, k, a, a + 3, t) for d, k, a, t in made], "doc_id long, seq int, start int, end int, text string")
    first = stored(edited_trees(with_edits(stored(count_trees(documents(spark, rows), FILE), "a"), edits.where("seq < 2")), FILE), "b")
    second = edited_trees(with_edits(first, edits.where("seq >= 2")), FILE).collect()
    for r in second:
        new = dict(rows)[r["doc_id"]] or ""
        for d, _, a, t in made:
            new = edited(new, a, a + 3, t) if d == r["doc_id"] else new
        pieces = WORDS.pattern.findall(new)
        assert r["text"] == new and r["n_tokens_edited"] == plain(new)
        assert r["sizes"] == list(map(len, pieces)) and r["counts"] == list(map(WORDS.count, pieces))
        assert r["n_encoded_again"] < 60
    assert len(second) == len(rows)


def test_a_leaf_that_grows_is_laid_out_anew():
    tree = CountTree("one two", WORDS)
    for _ in range(400):
        tree.apply(Edit(3, 3, " a b"))
    assert max(len(s) for s, _ in tree.leaves) <= 4 * tokencount.LEAF
    assert len(tree) == plain(tree.text) and len(tree.leaves) > 4
