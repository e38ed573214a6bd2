import random

import duckdb
import pytest
from llm_rows import documents

from stratalake.llm.exactdup import BASES, CHUNK, PRIMES, combined, exact_duplicates, part_hash
from stratalake.llm.queries import SQL, op5_exact_dedup


def by_sql(docs):
    db = duckdb.connect()
    frame = docs.select("doc_id", "text").toArrow()
    db.register("documents", frame)
    got = db.execute(SQL["op5_exact_dedup"])
    assert [c[0] for c in got.description] == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    return sorted(got.fetchall(), key=str)


def test_fingerprint_composes():
    rng = random.Random(1)
    for n in (0, 1, CHUNK - 1, CHUNK, 3 * CHUNK + 17):
        data = rng.randbytes(n)
        for prime, base in zip(PRIMES, BASES):
            plain = 0
            for x in data:
                plain = (plain * base + x + 1) % prime
            assert part_hash(data, prime, base) == plain
            cut = n // 3
            left, right = part_hash(data[:cut], prime, base), part_hash(data[cut:], prime, base)
            assert combined(left, right, n - cut, prime, base) == plain


def odd_rows():
    rng = random.Random(2)
    texts = ["", None, " \n", "a b", "ab", "a\tb ", "A b", "a\x1cb", "a\xa0b", "é x", "éx", "x" * 70_000 + " y", "x " * 70_000 + "y", "x" * 69_999 + "zy"]
    rows = [(i, rng.choice(texts)) for i in range(300)] + [(None, "a b"), (None, "alone"), (7, "ab"), (7, "ab"), (500, "only  me"), (501, "a  b  ")]
    return rows


@pytest.mark.parametrize("primes,huge", [(PRIMES, 1 << 24), ((3, 2), 1 << 24), (PRIMES, 1000), ((3, 2), 1000)])
def test_against_sql(spark, primes, huge):
    """Weak moduli make fingerprints collide; a small ``huge`` cuts the long texts into pieces."""
    docs = documents(spark, odd_rows())
    got = sorted((tuple(r) for r in exact_duplicates(docs, primes, huge).collect()), key=str)
    assert got == by_sql(docs)


def test_query(spark, folder, clash):
    docs = documents(spark, odd_rows())
    got = sorted((tuple(r) for r in op5_exact_dedup(spark, folder(documents=clash(docs))).collect()), key=str)
    assert got == by_sql(docs)
    assert op5_exact_dedup(spark, folder(documents=documents(spark, []))).count() == 0
