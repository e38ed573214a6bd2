import heapq
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from stratalake.llm import convrepair
from stratalake.llm.queries import SQL, op12_conversation_repair

ROWS = "conv_id long, turn long, role string, text string"
WORD = re.compile(r"(s?(ua)+)?\Z")
PREFIX = re.compile(r"s?(ua)*u?\Z")


def against_sql(spark, path):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW conversations AS SELECT * FROM '{path}/conversations.parquet{'/*.parquet' if path[:5] != '/root' else ''}'")
    want = db.execute(SQL["op12_conversation_repair"])
    names = [c[0] for c in want.description]
    got = op12_conversation_repair(spark, path).select(*names).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want.fetchall()))
    return got


def test_query_against_sql(spark):
    assert len(against_sql(spark, "/root/testdata/sf0.01")) == 100


def faults(rows):
    seen = set()
    for _, role, text in rows:
        yield convrepair.fault_of(text, (role, text) in seen)
        seen.add((role, text))


def cheapest(rows):
    """(cost, audit) by search through all edits in order of cost."""
    found = list(faults(rows))
    heap, done = [(0, "", 0, "")], set()
    while heap:
        cost, audit, i, letters = heapq.heappop(heap)
        if i == len(rows) and WORD.match(letters):
            return cost, audit
        if (audit, letters) in done or not PREFIX.match(letters):
            continue
        done.add((audit, letters))
        if not audit.endswith("II"):
            for s in "ua":
                heapq.heappush(heap, (cost + 2, audit + "I", i, letters + s))
        if i < len(rows):
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, letters))
            if found[i] in ("", "truncated"):
                cut = found[i] == "truncated"
                for s in "ua":
                    heapq.heappush(heap, (cost + 2 + cut, audit + "R", i + 1, letters + s))
                if rows[i][1]:
                    heapq.heappush(heap, (cost + cut, audit + "K", i + 1, letters + rows[i][1][0]))


def random_rows(rng, n):
    roles = ["system", "user", "assistant", "user", "tool", "", "admin"]
    return [(i, rng.choice(roles), rng.choice(["a.", "b", "", " \t", "c!", "d?", "e"])) for i in range(n)]


def test_cost_and_audit_against_search():
    rng = random.Random(5)
    for _ in range(600):
        rows = random_rows(rng, rng.randrange(6))
        got = convrepair.repair(rows)
        assert (got["cost"], got["audit"]) == cheapest(rows), rows


def test_stacks_of_the_grammar():
    assert len(convrepair.GRAPH) == 4
    for word in ("", "ua", "sua", "uaua", "suaua"):
        tops = {0}
        for s in word:
            tops = {t for x in tops for t in convrepair.moves(x, s)}
        assert tops & convrepair.WHOLE, word
    for word in ("s", "u", "su", "ss", "au", "uu", "uas"):
        tops = {0}
        for s in word:
            tops = {t for x in tops for t in convrepair.moves(x, s)}
        assert not tops & convrepair.WHOLE, word


ODD = [
    (None, None, None, None), (None, None, None, None), (None, 3, "user", "x."), (None, -4, "assistant", "y."),
    (1, None, "user", None), (1, 2, None, "z!"), (1, 2, "user", "b."), (1, 2, "user", "a."), (1, 2, "user", "a."),
    (2, 7, "", ""), (3, 1, "tool", "a b c " * 200_000), (4, 2**62, "system", " "), (4, 0, "s", "?\v"),
]


def test_odd_rows(spark, folder, clash):
    rows = clash(spark.createDataFrame(ODD, ROWS)).withColumn("at", F.lit("x")).withColumn("copies", F.lit(9))
    got = against_sql(spark, folder(conversations=rows))
    assert len(got) == 5
    empty = op12_conversation_repair(spark, folder(conversations=spark.createDataFrame([], ROWS)))
    assert empty.count() == 0


@pytest.mark.parametrize("bits", [1, 3])
def test_long_conversations_in_chunks(spark, folder, monkeypatch, bits):
    monkeypatch.setattr(convrepair, "MANY_ROWS", 12)
    monkeypatch.setattr(convrepair, "CHUNK_BITS", bits)
    rng = random.Random(bits)
    rows = list(ODD)
    for conv in (None, 10, 11, 12):
        n = rng.randrange(40, 90)
        rows += [(conv, rng.choice([None, i // 2, i]), role, text) for i, role, text in random_rows(rng, n)]
    # a third of all rows is one conversation, without turns
    rows += [(13, None, "user", f"{i % 20}.") for i in range(150)]
    frame = spark.createDataFrame(rows, ROWS).repartition(7)
    got = {r.conv_id: r for r in against_sql(spark, folder(conversations=frame))}
    assert len(got[13].audit) >= 100 and got[13].duplicate > 100
