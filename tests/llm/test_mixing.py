import duckdb
import pytest
from llm_rows import documents
from pyspark.sql import functions as F

from stratalake.llm.mixing import mixed, poisson_mix, source_rates
from stratalake.llm.queries import SQL, op9_mixing


def test_query_against_sql(spark):
    path = "/root/testdata/sf0.001"
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/documents.parquet'")
    want = db.execute(SQL["op9_mixing"])
    names = [c[0] for c in want.description]
    got = sorted(tuple(r[n] for n in names) for r in op9_mixing(spark, path).collect())
    assert [(*r[:2], pytest.approx(r[2]), *r[3:]) for r in sorted(want.fetchall())] == got


def test_shares(spark):
    rows = [(i, f"t{i}", None, "hot" if i % 3 == 0 else f"s{i % 4}") for i in range(6000)]
    docs = documents(spark, rows)
    out = mixed(docs, source_rates(docs, {"hot": 3.0}))
    n = out.count()
    assert abs(n - 6000) < 300
    shares = {r.source: r["count"] / n for r in out.groupBy("source").count().collect()}
    assert abs(shares["hot"] - 3 / 7) < 0.03 and all(abs(shares[f"s{i}"] - 1 / 7) < 0.02 for i in range(4))


def test_large_mean_and_order(spark):
    docs = documents(spark, [(i, "t", None, "rare") for i in range(20)] + [(100 + i, "t", None, "rest") for i in range(1980)])
    out = mixed(docs, source_rates(docs)).withColumn("pid", F.spark_partition_id())
    counts = {r.doc_id: r["count"] for r in out.where("source = 'rare'").groupBy("doc_id").count().collect()}
    assert abs(sum(counts.values()) / 20 - 50) < 6 and min(counts.values()) < max(counts.values())
    ids = [r.doc_id for r in out.collect()]
    assert ids != sorted(ids)


def test_odd_rows(spark, clash):
    rows = [(1, None, None, None), (1, None, None, None), (None, "x", None, None), (None, None, None, "a"), (2, "", None, "a")]
    docs = clash(documents(spark, rows))
    out = poisson_mix(docs, source_rates(docs, epochs=40.0))
    assert out.columns[:-1] == docs.columns
    counts = {(r.doc_id, r.source): r["count"] for r in out.groupBy("doc_id", "source").count().collect()}
    assert counts[(1, None)] % 2 == 0 and len(counts) == 4
    assert mixed(docs, source_rates(docs, epochs=0.0)).count() == 0
    empty = documents(spark, [])
    assert mixed(empty, source_rates(empty)).count() == 0


def test_a_document_of_very_many_copies_goes_to_many_tasks(spark, clash):
    docs = clash(documents(spark, [(i, "t", None, "rare" if i == 7 else "rest") for i in range(40)]))
    rates = source_rates(docs, {"rare": 499.0}, epochs=500.0)  # about 20,000 copies of one row
    whole = poisson_mix(docs, rates)
    pieces = poisson_mix(docs, rates, piece=100)
    assert pieces.columns == whole.columns
    rows = lambda out: sorted((r.doc_id, *r[-1]) for r in out.collect())
    assert rows(pieces) == rows(whole)
    spread = pieces.where("doc_id = 7").groupBy(F.spark_partition_id()).count().collect()
    assert len(spread) >= 4 and max(r["count"] for r in spread) < 12_000


def test_query_stores_whole_rows_in_order(spark, folder, clash):
    rows = [(i, f"text {i}", "en", "rare" if i % 40 == 0 else "rest") for i in range(800)]
    docs = clash(documents(spark, rows))
    out = op9_mixing(spark, folder(documents=docs))
    got = out.collect()
    places = [r.place for r in got]
    assert places == sorted(places) and [r.doc_id for r in got] != sorted(r.doc_id for r in got)
    files = sorted(out.inputFiles())
    kept = [r for f in files for r in spark.read.parquet(f).collect()]
    assert list(kept[0].asDict())[:-1] == docs.columns
    assert [(r.doc_id, r[-1].copy_no, r[-1].place) for r in kept] == [(r.doc_id, r.copy_no, r.place) for r in got]
    assert all(r.text == f"text {r.doc_id}" for r in kept)
