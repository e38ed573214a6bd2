import random
import re

import xxhash
from llm_rows import documents

from stratalake.llm import common
from stratalake.llm.queries import op4_simhash
from stratalake.llm.simhash import components, fingerprint, near_pairs


def plain_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    for c in "\t\n\v\f\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [" ".join(words)] * bool(words)
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def roots(nodes, pairs):
    up = {n: n for n in nodes}

    def top(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in pairs:
        a, b = sorted((top(a), top(b)))
        up[b] = a
    return {n: top(n) for n in nodes}


def test_fingerprint():
    rng = random.Random(1)
    for _ in range(200):
        text = "".join(rng.choice(["a", "B", " ", "\t", "\n", "é", " ", "\x1c", "zz"]) for _ in range(rng.randrange(60)))
        assert fingerprint(text) % (1 << 64) == plain_fingerprint(text), repr(text)
    long = " ".join(rng.choice("abcdefg") for _ in range(140_000))
    assert fingerprint(long) % (1 << 64) == plain_fingerprint(long)


def test_near_pairs_exact(spark):
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(30)] + [0, (1 << 64) - 1]
    values = set(base)
    for v in base[:20]:
        for _ in range(20):
            for b in rng.sample(range(64), rng.randrange(1, 5)):
                v ^= 1 << b
            values.add(v)
    signed = sorted(v - (1 << 64) if v >> 63 else v for v in values)
    frame = spark.createDataFrame([(v,) for v in signed], "fp long")
    for radius, parts in ((2, 2), (1, 2), (3, 2), (4, 4)):
        want = {(a, b) for i, a in enumerate(signed) for b in signed[i + 1 :] if ((a ^ b) & (1 << 64) - 1).bit_count() <= radius}
        for bucket in (32, 1) if radius < 3 else (32,):
            got = near_pairs(frame, radius, parts, bucket).collect()
            assert len(got) == len(want) and {(r.a, r.b) for r in got} == want, (radius, bucket)


def test_components(spark):
    rng = random.Random(2)
    pairs = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 140)] + [tuple(sorted(rng.sample(range(200, 300), 2))) for _ in range(60)]
    frame = spark.createDataFrame(pairs, "a long, b long")
    want = roots({n for p in pairs for n in p}, pairs)
    assert {r.node: r.root for r in components(frame).collect()} == want
    assert components(frame.limit(0)).count() == 0


def test_query(spark, folder, clash):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    texts = [None, "", " \n", "one", "one two"]
    for _ in range(12):
        words = [word() for _ in range(150)]
        texts += [" ".join(words), " ".join(words).upper(), " ".join([*words[:-1], word()]), " ".join([word(), *words[1:]])]
    rows = [(i, t) for i, t in enumerate(texts)] + [(1, texts[1]), (None, texts[5]), (None, "lonely row without id")]
    got = op4_simhash(spark, folder(documents=clash(documents(spark, rows)))).collect()
    assert len(got) == len(rows)
    fps = [plain_fingerprint(t or "") for _, t in rows]
    linked = roots(range(len(rows)), [(i, j) for i in range(len(rows)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 2])
    ids = {}
    for i, r in linked.items():
        ids.setdefault(r, []).append(rows[i][0])
    want = [(rows[i][0], f"{fps[i]:016x}", min((x for x in ids[r] if x is not None), default=None)) for i, r in linked.items()]
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert op4_simhash(spark, folder(documents=documents(spark, []))).count() == 0


def test_exploded_sides_are_not_broadcast_by_a_guess(spark, monkeypatch):
    monkeypatch.setattr(common, "SMALL_ROWS", 100)
    values = [(v * 0x9E3779B97F4A7C15 + (1 << 63)) % (1 << 64) - (1 << 63) for v in range(300)]
    frame = spark.createDataFrame([(v,) for v in values + [values[0] ^ 1]], "fp long")
    for bucket in (32, 1):
        pairs = near_pairs(frame, bucket=bucket)
        plan = pairs._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin") == (1 if bucket > 1 else 2) and not re.search("BroadcastHashJoin .*Inner", plan), plan
        assert pairs.count() == 1
