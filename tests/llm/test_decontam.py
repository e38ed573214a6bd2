import random
import re
from collections import Counter

import pytest
from llm_rows import documents

from stratalake.llm import decontam
from stratalake.llm.decontam import _RADII, BLOCKS, RADIUS, contaminated, fingerprint, hashes, simhash, without_contaminated, words
from stratalake.llm.queries import op7_decontamination


def plain_words(text):
    return [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]


def grams(w):
    return Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))


def parts(v, most):
    """An item's words as equal parts of at most that many shingles."""
    n = len(v) - 4
    if n < 1:
        return []
    c = -(-n // most)
    return [v[b * n // c : (b + 1) * n // c + 4] for b in range(c)]


def brute(docs, items, most=decontam.PART):
    """Best similarity of every document and item over all windows."""
    found = {}
    for doc_id, text in docs:
        w = plain_words(text)
        for item_id, v in [(i, v) for i, item in items for v in parts(plain_words(item), most)]:
            if len(w) < 5:
                continue
            a = grams(v)
            for s in range(max(1, len(w) - len(v) + 1)):
                b = grams(w[s : s + len(v)])
                sim = (a & b).total() / (a | b).total()
                if sim >= 0.8:
                    found[doc_id, item_id] = max(sim, found.get((doc_id, item_id), 0))
    return found


def rows(rng):
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(4))
    items = [(i, " ".join(word() for _ in range(rng.randrange(10, 60)))) for i in range(25)]
    items += [(30, items[0][1]), (31, "only four words here"), (32, None), (33, "tik tok " * 10), (34, "")]
    docs = []
    for i in range(60):
        text = [word() for _ in range(rng.randrange(0, 80))]
        if i % 2:
            leak = items[rng.randrange(25)][1].split()
            for _ in range(rng.randrange(3)):
                leak[rng.choice([0, 1, -1, -2, len(leak) // 2])] = word()
            if i % 3 == 0:
                leak = leak[: int(len(leak) * 0.9)]
            text[len(text) // 2 : len(text) // 2] = leak * (1 + (i % 5 == 0))
        docs.append((i, (", " if i % 4 else " ").join(text).upper() if i % 7 == 0 else " ".join(text)))
    docs += [(100, "tik tok " * 40), (101, "  "), (102, items[3][1]), (103, None), (104, (word() + " ") * 20_000 + items[4][1] + " end")]
    return docs, items


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, folder, clash, seed):
    docs, items = rows(random.Random(seed))
    bench = spark.createDataFrame(items, "item_id long, text string")
    extra = [(102, docs[-3][1]), (None, items[5][1]), (None, "a clean row without an id")]
    frame = clash(documents(spark, docs + extra))
    got = op7_decontamination(spark, folder(documents=frame, benchmark=bench)).collect()
    want = brute([d for d in docs if d[0] != 104], items) | {(104, 4): 1.0} | {(None, 5): 1.0}
    assert len(want) > 15 and sum(s < 1 for s in want.values()) > 3
    assert {(r.doc_id, r.item_id): pytest.approx(r.similarity) for r in got} == want and len(got) == len(want)
    kept = without_contaminated(frame, bench)
    assert kept.columns == frame.columns
    dirty = {d for d, _ in want}
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == sorted(
        [(False, i) for i, _ in docs if i not in dirty] + [(True, 0)]
    )


def test_windows_of_repeats(spark):
    """A passage that occurs often, and a text of one repeated word."""
    bench = spark.createDataFrame([(1, "x " * 12), (2, "one two three four five six seven eight nine ten eleven twelve")], "item_id long, text string")
    docs = [(1, "x " * 500), (2, "x " * 9 + "y"), (3, "one two three four five six seven eight nine ten eleven twelve. " * 50)]
    got = {(r.doc_id, r.item_id, r.start_word) for r in contaminated(documents(spark, docs), bench).collect()}
    assert got == {(1, 1, 0), (3, 2, 0)}


def test_fingerprint_and_blocks(spark):
    rng = random.Random(1)
    text = " ".join(rng.choice("abcd") for _ in range(300))
    r = spark.createDataFrame([(text,)], "text string").selectExpr(f"{words()} as w").selectExpr(f"{hashes('w')} as h").selectExpr("h", f"{simhash('h')} as fp").first()
    assert len(r.h) == 296
    want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in r.h) > 296)
    assert r.fp % (1 << 64) == want
    numbered = Counter()
    for h in r.h:
        numbered[h] += 1
    assert max(numbered.values()) > 1
    w = spark.createDataFrame([(text,)], "text string").selectExpr(f"{words()} as w")
    two = w.selectExpr(f"{fingerprint('w')} as a", f"{fingerprint('reverse(reverse(w))')} as b").first()
    assert two.a == two.b != r.fp
    for _ in range(2000):  # the guarantee of the blocks
        x = sum(1 << b for b in rng.sample(range(64), RADIUS))
        assert any((x >> 8 * i & 255).bit_count() <= _RADII[i] for i in range(BLOCKS))


def similar_with_repeats(rng, i):
    """A window at 0.8 or a little more to its item, the difference being mostly one shingle told many times."""
    word = lambda: "".join(rng.choice("abcdefghijkl") for _ in range(5))
    body, run = [word() for _ in range(130 + i)], [word()] * rng.randrange(14, 18)
    return body + run, body + [word() for _ in run]


@pytest.mark.parametrize("seed", [7, 8])
def test_recall_where_a_repeated_shingle_differs(spark, seed):
    rng = random.Random(seed)
    pairs = [similar_with_repeats(rng, i) for i in range(60)]
    items = [(i, " ".join(item)) for i, (item, _) in enumerate(pairs)]
    docs = [(i, " ".join(text)) for i, (_, text) in enumerate(pairs)]
    want = {k: v for i in range(60) for k, v in brute(docs[i : i + 1], items[i : i + 1]).items()}
    assert len(want) >= 50
    got = contaminated(documents(spark, docs), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id): pytest.approx(r.similarity) for r in got} == want


def test_items_without_or_with_the_same_id(spark):
    rng = random.Random(3)
    text = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(n))
    short, long = text(12), text(60)
    items = [(None, text(20)), (5, short), (5, short + " " + long), (None, None)]
    docs = [(1, "x y " + items[0][1]), (2, short), (3, text(9) + " " + items[2][1]), (4, text(50))]
    got = contaminated(documents(spark, docs), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id): pytest.approx(r.similarity) for r in got} == brute(docs, items)
    assert {(r.doc_id, r.item_id) for r in got} == {(1, None), (2, 5), (3, 5)}


def test_long_items_by_parts(spark, monkeypatch):
    rng = random.Random(4)
    text = lambda n: ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(n)]
    monkeypatch.setattr(decontam, "PART", 16)
    items = [(1, " ".join(text(90))), (2, " ".join(text(20))), (3, " ".join(text(21)))]
    one = items[0][1].split()
    docs = [(1, " ".join(text(30) + one[32:60] + text(5))), (2, " ".join(one)), (3, items[1][1]), (4, " ".join(one[:9]))]
    got = contaminated(documents(spark, docs), spark.createDataFrame(items, "item_id long, text string")).collect()
    want = brute(docs, items, 16)
    assert {(r.doc_id, r.item_id): pytest.approx(r.similarity) for r in got} == want
    assert {k for k in want} == {(1, 1), (2, 1), (3, 2)}


def test_an_item_of_100_000_shingles(spark):
    rng = random.Random(6)
    item = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(100_004)]
    leak = list(item)
    for at in range(0, len(leak), 97):
        leak[at] = "changed"
    docs = [(1, " ".join(leak)), (2, " ".join(item[5000:8000])), (3, " ".join(item[:200])), (4, "a b c d e f g h")]
    got = contaminated(documents(spark, docs), spark.createDataFrame([(9, " ".join(item))], "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in got.collect()} == {(1, 9), (2, 9)}


def test_empty(spark):
    bench = spark.createDataFrame([(1, "one two three four five six")], "item_id long, text string")
    docs = documents(spark, [(1, "one two three four five six")])
    assert contaminated(documents(spark, []), bench).count() == 0
    assert contaminated(docs, bench.limit(0)).count() == 0
    assert without_contaminated(docs, bench.limit(0)).count() == 1
