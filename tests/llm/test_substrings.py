import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from llm_rows import documents

from stratalake.llm import substrings, suffix
from stratalake.llm.queries import op8_suffix_dedup
from stratalake.llm.substrings import anchors, repeated_substrings
from stratalake.llm.suffix import Suffixes


def brute(rows, length):
    """Rows in document order; equal (doc_id, text) rows are interchangeable."""
    seen, out = set(), []
    for doc_id, text in rows:
        data = (text or "").encode()
        cover = np.zeros(len(data), bool)
        for s in range(len(data) - length + 1):
            window = data[s : s + length]
            if window in seen:
                cover[s : s + length] = True
            seen.add(window)
        edges = np.diff(np.concatenate([[0], cover.astype(int), [0]]))
        kept = np.frombuffer(data, np.uint8)[~cover].tobytes()
        out.append((doc_id, len(data), int(cover.sum()), int((edges == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


def corpus(rng, n=120):
    line = lambda k: "".join(rng.choice("abcdé \n") for _ in range(k))
    shared = [line(rng.randrange(60, 260)) for _ in range(6)]
    base = line(900)
    rows = []
    for i in range(n):
        kind = i % 6
        if kind == 0:  # a near copy with few edits
            t = list(base)
            for _ in range(rng.randrange(1, 4)):
                t[rng.randrange(len(t))] = rng.choice("xyz")
            text = "".join(t)
        elif kind == 1:
            text = line(80) + rng.choice(shared) + line(rng.randrange(200)) + rng.choice(shared)[: rng.randrange(90, 200)]
        elif kind == 2:
            text = rng.choice(["ab", "x", "abcde\n"]) * rng.randrange(20, 200)
        elif kind == 3:
            text = line(rng.randrange(300))
        elif kind == 4:
            text = rng.choice(shared) + rng.choice(shared)
        else:
            text = rows[rng.randrange(len(rows))][1] if rows else "x"
        rows.append((i * 3, text))
    return rows


def same(got, want):
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_suffix_sort():
    rng = np.random.default_rng(3)
    data = rng.integers(0, 3, 4000).astype(np.uint8)
    data[2000:2300] = data[100:400]
    s = Suffixes(data, 40)
    starts = rng.integers(0, 3960, 600)
    starts[:50] = rng.integers(0, 5, 50)
    group = np.sort(rng.integers(0, 25, 600))
    p, q = starts[:300], starts[300:]
    plain = [next((k for k in range(40) if data[a + k] != data[b + k]), 40) for a, b in zip(p, q)]
    assert s.common(p, q).tolist() == plain
    want = sorted(range(600), key=lambda i: (group[i], data[starts[i] : starts[i] + 40].tobytes(), i))
    for prefix in (s.prefix, np.zeros_like(s.prefix)):  # with hashes that all agree, the bytes decide
        order, equal = Suffixes(data, 40, prefix).sort(starts, group)
        assert order.tolist() == want
        key = [(group[i], data[starts[i] : starts[i] + 40].tobytes()) for i in order]
        assert equal.tolist() == [k > 0 and key[k] == key[k - 1] for k in range(600)]


def test_anchors_depend_on_the_window(monkeypatch):
    monkeypatch.setattr("stratalake.llm.substrings.BLOCK", 300)
    data = np.random.default_rng(1).integers(0, 4, 1500).astype(np.uint8)
    data[900:1200] = data[50:350]
    of = {}
    for gram, place, first, last in anchors(data, 20, 6):
        for g, p, a, b in zip(gram, place, first, last):
            for s in range(a, b + 1):
                assert s not in of and s <= p <= s + 14
                of[s] = (int(g), p - s)
    assert sorted(of) == list(range(1481))
    assert all(of[50 + i] == of[900 + i] for i in range(281))


@pytest.mark.parametrize("many,at_once", [(4096, 1 << 19), (2, 1 << 19), (4096, 300), (3, 64)])
def test_against_brute_force(spark, many, at_once):
    rows = corpus(random.Random(many + at_once))
    shuffled = rows[:]
    random.Random(1).shuffle(shuffled)
    docs = documents(spark, shuffled).repartition(5)
    same(repeated_substrings(docs, many=many, at_once=at_once).collect(), brute(rows, 100))


@pytest.mark.parametrize("many", [4096, 2])
def test_weak_digests_decide_nothing(spark, monkeypatch, many):
    """With digests of one bit most contexts of a gram agree; of a frequent gram they are told by a second seed."""
    rows = corpus(random.Random(77))
    tried, plain = [], substrings._found
    monkeypatch.setattr(substrings, "_found", lambda *a: tried.append(a[-1]) or plain(*a))
    docs = documents(spark, rows).repartition(5)
    same(repeated_substrings(docs, many=many, digests=(1, 64)).collect(), brute(rows, 100))
    assert tried == ([1] if many > len(rows) else [1, 64])
    if many < len(rows):
        with pytest.raises(ValueError, match="agree"):
            repeated_substrings(docs, many=many, digests=(1,))


def test_query(spark, folder, clash):
    rng = random.Random(8)
    rows = corpus(rng, 60) + [(900, "é" * 60), (901, "é" * 60), (902, "ab" * 49), (903, "ab" * 49), (904, None), (905, "")]
    rows += [(906, "q" * 150), (906, "q" * 150), (None, "q" * 120), (None, rows[3][1])]
    rows.append((950, "".join(rng.choice("abcd") for _ in range(120_000)) * 2))
    rows.sort(key=lambda r: (r[0] is None, r[0]))
    got = op8_suffix_dedup(spark, folder(documents=clash(documents(spark, rows)))).collect()
    same(got, brute(rows, 100))
    assert op8_suffix_dedup(spark, folder(documents=documents(spark, []))).count() == 0


def test_powers():
    assert [int(x) for x in suffix.powers(7, 5)] == [1, 7, 49, 343, 2401]
    assert (suffix.BASE * suffix.INVERSE) % (1 << 64) == 1


def test_hot_passage_is_reduced_before_the_shuffle(spark, monkeypatch):
    rng = random.Random(5)
    line = lambda k: "".join(rng.choice("abcdefgh") for _ in range(k))
    passage = line(130)
    rows = [(i, line(150) + (passage if i % 3 else "") + line(150)) for i in range(300)]
    dealt, plain = [], substrings._sorted
    monkeypatch.setattr(substrings, "_sorted", lambda contexts, *a: dealt.append(contexts) or plain(contexts, *a))
    got = repeated_substrings(documents(spark, rows).repartition(5), many=20).collect()
    same(got, brute(rows, 100))
    contexts = dealt[0].where("length(bytes) > 0")
    assert contexts.groupBy("key").count().agg({"count": "max"}).first()[0] < 20


def test_one_key_beyond_what_is_sorted_at_once():
    window = bytes(range(100))
    names = ["key", "ord", "tie", "place", "first", "bytes", "check"]
    taken = []

    def batches():
        for k in range(40):
            taken.append(k)
            n = 50
            cells = [[7] * n, [k * n + i for i in range(n)], [0] * n, [10] * n, [5] * n, [window] * n]
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cells[:5]), pa.array(cells[5], pa.binary()), pa.array([False] * n)], names=names)

    marks = substrings._swept(batches(), 100, 200)
    got = next(marks).to_pylist()
    assert len(taken) < 10
    got += [r for m in marks for r in m.to_pylist()]
    assert [(r["ord"], r["low"], r["high"]) for r in got] == [(i, 5, 105) for i in range(1, 2000)]
