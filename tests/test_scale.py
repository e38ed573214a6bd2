"""What keeps shuffles, writes and the memory of a task in proportion to the rows."""

from functools import partial

import pytest
from conftest import SF, move, payload_rows, root, species
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.operators import discovery, readers
from stratalake.operators.layers import capture
from stratalake.plans.entities import ENTITIES, checked
from stratalake.sources import shared
from stratalake.sources.landing import envelope, landing_lines, write_landing
from stratalake.sources.shared import fresh_folder
from stratalake.sources.store import Warehouse
from stratalake.workload import universe
from stratalake.workload.universe import Tables


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_payloads_are_made_of_rows_in_their_place(spark, warehouse):
    """what is shuffled are the narrow rows; each payload lies where its key belongs."""
    t = Tables(spark, SF)
    text = plan(universe.moves(t, partial(warehouse.place, "raw.records")))
    assert text.index("AS payload") < text.index("Exchange") and "payload" not in text[text.index("Exchange"):]
    rows = envelope(universe.payloads(t, partial(warehouse.place, "raw.records")), "bucket")
    n = warehouse.append("raw.records", rows)
    plain = envelope(universe.payloads(t)).select("key", "payload")
    stored = warehouse.placed("raw.records")
    assert n == plain.count() and stored.select("key", "payload").exceptAll(plain).isEmpty()
    assert stored.where("bucket <> pmod(xxhash64(key), 4)").isEmpty()


def test_placed_rows_are_written_again_without_a_shuffle(spark, warehouse, monkeypatch):
    """F8, F14: a copy of stored rows keeps their buckets."""
    warehouse.append("raw.records", envelope(payload_rows(spark, move=[move(i) for i in range(40)])))
    copy = Warehouse(spark, fresh_folder(spark, "warehouse"))
    rows = warehouse.placed("raw.records")
    with monkeypatch.context() as m:
        m.setattr(DataFrame, "hint", lambda *_: pytest.fail("shuffled"))
        assert copy.overwrite("raw.records", rows) == 40
    assert copy.upsert("raw.records", envelope(payload_rows(spark, move=[move(7, pp=9)]))) == 1
    assert copy.table("raw.records").count() == 40


def test_a_bucket_that_is_wholly_replaced_is_not_read(spark, monkeypatch):
    """F8: only buckets with rows that stay are joined with the batch and written anew."""
    warehouse = Warehouse(spark, fresh_folder(spark, "warehouse"), buckets=4)
    rows = envelope(payload_rows(spark, move=[move(i) for i in range(40)]))
    warehouse.append("raw.records", rows)
    joined = []
    with monkeypatch.context() as m:
        real = DataFrame.join
        m.setattr(DataFrame, "join", lambda a, b, on=None, how=None: joined.append(how) or real(a, b, on, how))
        m.setattr(DataFrame, "isEmpty", lambda _: pytest.fail("read"))
        assert warehouse.upsert("raw.records", rows) == 40
    assert warehouse.table("raw.records").count() == 40
    one = envelope(payload_rows(spark, move=[move(3, pp=77)]))
    assert warehouse.upsert("raw.records", one) == 1
    stored = warehouse.table("raw.records")
    assert stored.count() == 40 and stored.where("payload LIKE '%77%'").count() == 1


def test_bundles_are_compressed(spark):
    """F9, F11, F12."""
    folder = fresh_folder(spark, "landing")
    write_landing(payload_rows(spark, move=[move(i) for i in range(9)]), folder)
    assert all(n.endswith(".gz") for n in shared.names_in(spark, f"{folder}/entity_type=move") if n.startswith("part"))
    assert landing_lines(spark.read, folder).select("key").distinct().count() == 9


def test_payloads_are_not_sorted_to_meet_many_keys(spark, monkeypatch):
    """nor do payloads of entities without a pending key meet them."""
    source = payload_rows(spark, root=[root(1)], move=[move(i) for i in range(9)])
    pending = source.where("key LIKE 'move:%'").select("key")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(discovery.new_records(source, pending))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "ShuffledHashJoin" in text and "Sort [" not in text
    assert discovery.part_with(source, pending).where("key LIKE 'root:%'").isEmpty()


def test_shuffles_begin_with_partitions_by_size(spark, tmp_path, monkeypatch):
    """F5, F7, F16, F17: a task gets no more rows when the tables grow."""
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    monkeypatch.setattr(shared, "BYTES_PER_PARTITION", 10)
    for size, wanted in ((5000, "500"), (20, None)):
        (tmp_path / "rows").write_bytes(b"x" * size)
        shared.shuffle_by_size(spark, str(tmp_path))
        assert spark.conf.get(name, None) == wanted


def test_a_root_is_one_row_until_its_products_are_made(spark):
    """no row per root and attacking type is grouped; sparse matrices, repeats and null roots count as before."""
    held = spark.createDataFrame([(1, 1), (1, 2), (1, 2), (2, 3), (None, 1), (3, 9)], "root_id bigint, type_id int")
    matrix = spark.createDataFrame(
        [(1, 1, 2.0), (1, 2, 0.5), (1, 2, 0.5), (2, 2, 0.0), (None, 1, 3.0)],
        "attacking_type_id int, defending_type_id int, multiplier double",
    )
    found = readers.defence_profile(held, matrix)
    plain = held.withColumnRenamed("type_id", "defending_type_id").join(matrix, "defending_type_id")
    want = plain.groupBy("root_id", "attacking_type_id").agg(F.product("multiplier"))
    assert sorted(map(str, found.collect())) == sorted(map(str, want.toDF(*found.columns).collect()))
    assert "hashpartitioning(root_id#" in (text := plan(found)) and "attacking_type_id#" not in text.split("hashpartitioning(root_id")[1].split(")")[0]
    assert readers.defence_profile(held, matrix.limit(0)).isEmpty()


def test_problems_are_listed_only_if_there_are_any(spark):
    """sound payloads make no list; stat names are parsed as text, whatever they are."""
    odd = root(2, stats=[{"base_stat": 1, "stat": {"name": 5}}, *root()["stats"], {"base_stat": 2, "stat": {"name": None}}])
    bad = root(3, name=5, height=None)
    rows = checked(payload_rows(spark, root=[root(), odd, bad]), ENTITIES["root"])
    assert "CASE WHEN isnull(coalesce(" in plan(rows)
    got = {r["key"]: (r["problems"], r["hp"]) for r in rows.collect()}
    assert got == {"root:1": ([], 10), "root:2": ([], 10), "root:3": (["name: wrong type", "height: null"], 10)}


def test_many_payloads_are_shuffled_once(spark, warehouse, monkeypatch):
    """payloads meet the pending keys in the partitions they are written from."""
    rows = payload_rows(spark, root=[root(1)], move=[move(i) for i in range(30)])
    pending = rows.where("key LIKE 'move:%'").select("key").unionByName(rows.limit(0).select("key"))
    place = partial(warehouse.place_for_join, "raw.records")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with shared.joining_by_part(spark):
            records = discovery.new_records(rows, pending, place)
            assert plan(records).count("Exchange hashpartitioning") == 2  # payloads, keys
            staged = warehouse.stage_upsert("raw.records", records, seq="seq")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    warehouse.commit(staged)
    stored = warehouse.placed("raw.records")
    assert staged.rows == stored.select("key").distinct().count() == 30
    assert stored.where("bucket <> pmod(xxhash64(key), 4)").isEmpty()
    monkeypatch.setattr(discovery, "MANY_KEYS", 1)
    source = payload_rows(
        spark, root=[root()], species=[species()], move=[move(302, name="winch"), move(301, name="anchor"), move(9)],
    )
    other = Warehouse(spark, fresh_folder(spark, "warehouse"))
    assert capture(other, source.unionByName(source), fixed=source.where("key = 'move:301'").select("key")) == 4
    assert {r["key"] for r in other.table("raw.records").collect()} == {"root:1", "species:1", "move:301", "move:302"}
