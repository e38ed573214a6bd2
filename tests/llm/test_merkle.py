import hashlib
from zlib import crc32

import duckdb
import pytest
from llm_rows import documents

from stratalake.llm import merkle
from stratalake.llm.common import table
from stratalake.llm.queries import SQL, op13_merkle_manifest


def against_sql(spark, path, levels=merkle.LEVELS):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/documents.parquet{'/*.parquet' if path[:5] != '/root' else ''}'")
    want = db.execute(SQL["op13_merkle_manifest"])
    names = [c[0] for c in want.description]
    rows = merkle.manifest(table(spark, path, "documents"), levels) if levels != merkle.LEVELS else op13_merkle_manifest(spark, path)
    got = rows.select(*names).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want.fetchall()))
    return got


def test_query_against_sql(spark):
    got = against_sql(spark, "/root/testdata/sf0.01")
    assert len(got) == 1000 and {r.verified for r in got} == {True, False}


def test_states_are_kept_and_resumed():
    children = [hashlib.sha256(bytes([i])).hexdigest().encode() for i in range(3)]
    other = hashlib.sha256(b"x").hexdigest().encode()
    for n in (1, 2, 3):
        parent = merkle.Parent(children[:n])
        assert parent.digest.decode() == hashlib.sha256(b"".join(children[:n])).hexdigest()
        for slot in range(n):
            whole = children[:slot] + [other] + children[slot + 1 : n]
            assert parent.folded(slot, other).decode() == hashlib.sha256(b"".join(whole)).hexdigest()
            assert parent.folded(slot, children[slot]) == parent.digest
            assert parent.siblings(slot) == b"".join(children[:slot] + children[slot + 1 : n])


@pytest.mark.parametrize("levels", [1, 2, 6])
def test_trees_of_many_blocks(spark, folder, levels):
    sizes = {"hot": 95, None: 28, "a": 27, "é": 9, "b": 10, "one": 1, "two": 2, "": 3}
    rows, i = [], 0
    for source, n in sizes.items():
        rows += [(i := i + 1, f"line {i}\nend" if i % 3 else f"line {i}", "en", source) for _ in range(n)]
    docs = documents(spark, rows).repartition(5)
    got = against_sql(spark, folder(documents=docs), levels)
    assert len({r.subroot for r in got}) == len(sizes) and len({r.root for r in got}) == 1
    assert all(r.verified == (bool(crc32(str(r.doc_id).encode()) % 2) or r.doc_id % 3 == 0) for r in got)


def test_odd_rows(spark, folder, clash):
    rows = [
        (1, None, None, None), (1, None, None, None), (None, "a\nb", None, None), (None, None, "x", "s"), (2, "", "", ""),
        (4, "\n", None, "s"), (4, "\n\n", None, "s"), (-7, "é\n" * 500_000, "fr", "s"), (2**62, "z", "en", "\U0001f600"),
    ]
    docs = clash(documents(spark, rows))
    got = against_sql(spark, folder(documents=docs.repartition(3)))
    assert len(got) == len(rows)
    one = against_sql(spark, folder(documents=documents(spark, [(5, "x", None, "s")])))
    assert one[0].leaf == one[0].subroot == one[0].root == one[0].folded_root
    assert one[0].proof_sha256 == hashlib.sha256().hexdigest()
    empty = op13_merkle_manifest(spark, folder(documents=documents(spark, [])))
    assert empty.count() == 0
