"""Layers at rest: upsert, commits, runs."""

from functools import reduce

import pytest
from conftest import kind, move, payload_rows, root, species
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stratalake.operators.layers import build_star, capture, load, rebuild, run
from stratalake.operators.lineage import run_state
from stratalake.operators.upsert import latest, latest_wide, upsert_rows
from stratalake.sources.landing import envelope, fixed_keys
from stratalake.sources.shared import fresh_folder
from stratalake.sources.store import Warehouse


def raw_rows(spark, **entities):
    return envelope(payload_rows(spark, **entities))


def universe(spark):
    """One root, its species and moves, two types."""
    return payload_rows(
        spark,
        root=[root()],
        species=[species()],
        move=[move(302, name="winch"), move(301, name="anchor")],
        type=[kind(1, "ore", double_damage_to=["tide"]), kind(2, "tide")],
    )


def types_of(spark):
    return fixed_keys(spark, "type", 2)


def test_raw_round_trip(spark, warehouse):
    rows = raw_rows(spark, move=[move(1), move(2)], species=[species()])
    assert warehouse.append("raw.records", rows) == 3
    stored = warehouse.table("raw.records")
    assert {r["key"] for r in stored.collect()} == {"move:1", "move:2", "species:1"}
    assert stored.where("entity_type = 'move'").count() == 2
    assert Warehouse(spark, warehouse.path).table("raw.records").count() == 3  # reopened


def test_never_written_is_empty(warehouse):
    assert warehouse.table("staging.move").count() == 0
    warehouse.ensure()
    warehouse.ensure()
    assert warehouse.table("staging.move").count() == 0


def test_empty_batches_change_nothing(spark, warehouse):
    rows = raw_rows(spark, move=[move(1)])
    none = rows.where("false")
    assert warehouse.append("raw.records", none) == 0
    assert warehouse.upsert("raw.records", none) == 0
    assert not warehouse.is_written("raw.records")
    warehouse.append("raw.records", rows)
    assert warehouse.upsert("raw.records", none) == 0
    assert warehouse.table("raw.records").count() == 1


def test_upsert_replaces_and_counts_updates(spark, warehouse):
    warehouse.upsert("raw.records", raw_rows(spark, move=[move(1), move(2)]))
    assert warehouse.upsert("raw.records", raw_rows(spark, move=[move(2, name="new"), move(3)])) == 2
    names = warehouse.table("raw.records").selectExpr("key", "get_json_object(payload, '$.name')")
    assert dict(names.collect()) == {"move:1": "move-1", "move:2": "new", "move:3": "move-3"}


def test_upsert_with_sequence(spark, warehouse):
    batch = raw_rows(spark, move=[move(1, name="a")]).withColumn("seq", F.lit(1)).unionByName(
        raw_rows(spark, move=[move(1, name="b")]).withColumn("seq", F.lit(2))
    )
    assert warehouse.upsert("raw.records", batch, seq="seq") == 1
    assert '"b"' in warehouse.table("raw.records").first()["payload"]


def test_failed_write_leaves_the_table(spark, warehouse):
    warehouse.upsert("raw.records", raw_rows(spark, move=[move(1)]))
    bad = raw_rows(spark, move=[move(2)]).withColumn("payload", F.raise_error(F.lit("kaboom")))
    with pytest.raises(Exception, match="kaboom"):
        warehouse.upsert("raw.records", bad)
    assert [r["key"] for r in warehouse.table("raw.records").collect()] == ["move:1"]


def test_a_table_may_be_replaced_by_what_is_read_from_it(spark, warehouse):
    warehouse.append("raw.records", raw_rows(spark, move=[move(1), move(2)]))
    warehouse.overwrite("raw.records", warehouse.table("raw.records").where("key = 'move:2'"))
    assert warehouse.table("raw.records").count() == 1


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 99)), max_size=12), st.randoms())
def test_latest_ignores_row_order(spark, pairs, random):
    rows = [(k, seq, f"v{k}-{seq}") for k, seq in set(pairs)]
    expected = {k: max(s for kk, s, _ in rows if kk == k) for k, _, _ in rows}
    random.shuffle(rows)
    frame = spark.createDataFrame(rows, "k int, seq int, v string")
    for find in (latest, latest_wide):
        got = sorted(tuple(r) for r in find(frame, ["k"], "seq").collect())
        assert got == sorted((k, s, f"v{k}-{s}") for k, s in expected.items())


def test_upsert_rows(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string")
    assert dict(upsert_rows(old, new, ["k"]).collect()) == {1: "a", 2: "c", 3: "d"}


def test_capture_takes_the_closure_and_resumes(spark, warehouse):
    source = universe(spark).unionByName(payload_rows(spark, species=[species(2)], move=[move(99)]))
    assert capture(warehouse, source, fixed=types_of(spark)) == 6  # not species:2, not move:99
    before = {r["key"]: r["fetched_at"] for r in warehouse.table("raw.records").collect()}
    more = source.unionByName(payload_rows(spark, root=[root(2, moves=[{"move": {"name": "m", "url": "/move/99/"}}])]))
    assert capture(warehouse, more, fixed=types_of(spark)) == 2  # root:2 and its move
    after = {r["key"]: r["fetched_at"] for r in warehouse.table("raw.records").collect()}
    assert {k: after[k] for k in before} == before
    assert capture(warehouse, more, fixed=types_of(spark)) == 0


def test_references_of_captured_roots_still_count(spark, warehouse):
    warehouse.append("raw.records", raw_rows(spark, root=[root()]))
    assert capture(warehouse, universe(spark), fixed=types_of(spark)) == 5


def test_limit_bounds_the_roots_only(spark, warehouse):
    source = universe(spark).unionByName(payload_rows(spark, root=[root(10), root(2)]))
    capture(warehouse, source, limit=2, fixed=types_of(spark))
    keys = {r["key"] for r in warehouse.table("raw.records").collect()}
    assert {k for k in keys if k.startswith("root")} == {"root:1", "root:2"}
    assert {"move:302", "move:301", "species:1"} <= keys


def test_capture_fails_on_what_the_source_lacks(spark, warehouse):
    with pytest.raises(ValueError, match="lacks what is to be captured: move:301"):
        capture(warehouse, universe(spark).where("key <> 'move:301'"), fixed=types_of(spark))
    with pytest.raises(ValueError, match="type:3"):
        capture(warehouse, universe(spark), fixed=fixed_keys(spark, "type", 3))
    assert not warehouse.is_written("raw.records")


@pytest.mark.parametrize("others", [0, 300])
def test_capture_keeps_one_record_of_a_key(spark, warehouse, others):
    """The result doesn't depend on how much else the source holds."""
    again = payload_rows(spark, move=[move(302, name="later")]).withColumn("seq", F.lit(1))
    more = payload_rows(spark, move=[move(1000 + i) for i in range(others + 1)])
    source = universe(spark).unionByName(more).withColumn("seq", F.lit(0)).unionByName(again)
    assert capture(warehouse, source, fixed=types_of(spark)) == 6
    raw = warehouse.table("raw.records")
    assert raw.count() == 6 and "later" in raw.where("key = 'move:302'").first()["payload"]
    assert raw.columns == ["key", "entity_type", "payload", "fetched_at"]
    assert capture(warehouse, source, fixed=types_of(spark)) == 0
    assert load(warehouse)["move"] == 2


def test_load_keeps_one_row_of_an_id(spark, warehouse):
    first = raw_rows(spark, move=[move(302, name="old")]).withColumn("fetched_at", F.lit("2020-01-01").cast("timestamp"))
    later = raw_rows(spark, move=[move(302, name="new")]).withColumn("key", F.lit("move:0302"))
    warehouse.append("raw.records", first.unionByName(later))
    assert load(warehouse)["move"] == 1
    assert [r["name"] for r in warehouse.table("staging.move").collect()] == ["new"]


def test_a_repaired_payload_leaves_the_rejects(spark, warehouse):
    warehouse.append("raw.records", raw_rows(spark, species=[species(1), species(2, name=None)]))
    load(warehouse, on_error="quarantine")
    warehouse.upsert("raw.records", raw_rows(spark, species=[species(2)]))
    load(warehouse, on_error="quarantine")
    assert warehouse.table("staging.rejects").count() == 0
    assert warehouse.table("staging.species").count() == 2


def test_star_fails_on_what_staging_lacks(spark, warehouse):
    capture(warehouse, universe(spark), fixed=types_of(spark))
    load(warehouse)
    warehouse.overwrite("staging.move", warehouse.table("staging.move").where("id <> 301"))
    warehouse.overwrite("staging.species", warehouse.table("staging.species").where("false"))
    with pytest.raises(ValueError, match=r"move anchor \(1\); species 1 \(1\)"):
        build_star(warehouse)
    assert not warehouse.is_written("analytics.fact_root")


def test_two_writers_are_told_apart(spark, warehouse):
    for i in range(3):
        warehouse.append("raw.records", raw_rows(spark, move=[move(i)]))
    other, third = Warehouse(spark, warehouse.path), Warehouse(spark, warehouse.path)
    assert other.table("raw.records").count() == 3
    # both have written and are about to show it: one comes first
    mine = warehouse.stage_upsert("raw.records", raw_rows(spark, move=[move(4)]))
    theirs = other.stage_overwrite("raw.records", raw_rows(spark, move=[move(9)]))
    other.commit(theirs)
    with pytest.raises(RuntimeError, match="another writer"):
        warehouse.commit(mine)
    with pytest.raises(RuntimeError, match="another writer"):
        third.append("raw.records", raw_rows(spark, move=[move(4)]))
    again = Warehouse(spark, warehouse.path)
    assert again.table("raw.records").count() == 1
    assert again.upsert("raw.records", raw_rows(spark, move=[move(4)])) == 1
    assert Warehouse(spark, warehouse.path).table("raw.records").count() == 2


def files_of(warehouse, name):
    return set(warehouse.table(name).inputFiles())


def test_an_upsert_rewrites_the_buckets_it_changes(spark):
    warehouse = Warehouse(spark, fresh_folder(spark, "buckets"), buckets=100)
    rows = payload_rows(spark, move=[move(i) for i in range(3000)])
    warehouse.append("raw.records", envelope(rows))
    before = files_of(warehouse, "raw.records")
    assert 95 <= len(before) <= 110
    one = F.expr("pmod(xxhash64(key), 100) = 7")
    batch = envelope(rows.where(one).withColumn("payload", F.lit('{"id": 0}')))
    n = batch.count()
    assert 10 < n < 60 and warehouse.upsert("raw.records", batch) == n
    after = files_of(warehouse, "raw.records")
    assert len(before - after) == len(after - before) == 1  # the batch tells all of a bucket anew
    table = warehouse.table("raw.records")
    assert table.count() == 3000 and table.where("payload = '{\"id\": 0}'").count() == n
    # of keys that are new only, no bucket is written anew
    assert warehouse.upsert("raw.records", raw_rows(spark, move=[move(9000)])) == 1
    assert after < files_of(warehouse, "raw.records")
    # some new, some not, in other buckets
    mixed = envelope(payload_rows(spark, move=[move(9001), move(9002), move(5, name="five")]))
    assert warehouse.upsert("raw.records", mixed) == 3
    assert len(after - files_of(warehouse, "raw.records")) == 1
    assert warehouse.table("raw.records").count() == 3003


def test_vacuum_keeps_what_is_current(spark, warehouse):
    for name in ("a", "b"):
        warehouse.upsert("raw.records", raw_rows(spark, move=[move(i, name=name) for i in range(20)]))
    warehouse.overwrite("staging.type", warehouse.table("staging.type"))
    warehouse.overwrite("staging.type", warehouse.table("staging.type"))
    assert warehouse.vacuum() > 0 and warehouse.vacuum() == 0
    assert warehouse.table("raw.records").where("payload like '%\"b\"%'").count() == 20
    assert Warehouse(spark, warehouse.path).table("staging.type").count() == 0


def versions(spark, *pairs):
    rows = [payload_rows(spark, move=[move(i, name=name)]).withColumn("seq", F.lit(seq)) for i, name, seq in pairs]
    return envelope(reduce(lambda a, b: a.unionByName(b), rows), "seq")


def names(warehouse):
    return dict(warehouse.table("raw.records").selectExpr("key", "get_json_object(payload, '$.name')").collect())


def test_the_newer_version_stays_whenever_it_comes(spark, warehouse):
    assert warehouse.upsert("raw.records", versions(spark, (1, "b", 2), (2, "b", 2), (1, "a", 1)), "seq", newer=True) == 2
    assert warehouse.upsert("raw.records", versions(spark, (1, "a", 1), (2, "c", 3), (3, "c", 3)), "seq", newer=True) == 2
    assert warehouse.upsert("raw.records", versions(spark, (1, "a", 1), (2, "b", 2)), "seq", newer=True) == 0
    assert names(warehouse) == {"move:1": "b", "move:2": "c", "move:3": "c"}
    # without ``newer`` the batch replaces what is stored
    assert warehouse.upsert("raw.records", versions(spark, (1, "z", 0)), "seq") == 1
    assert warehouse.upsert("raw.records", versions(spark, (1, "y", 1)), "seq", newer=True) == 1
    # a row stored without a version is older than any
    assert warehouse.upsert("raw.records", raw_rows(spark, move=[move(3, name="plain")])) == 1
    assert warehouse.upsert("raw.records", versions(spark, (3, "d", 0)), "seq", newer=True) == 1
    assert names(warehouse) == {"move:1": "y", "move:2": "c", "move:3": "d"}
    with pytest.raises(ValueError, match="versions are int, not string"):
        warehouse.upsert("raw.records", versions(spark, (1, "z", "0")), "seq")


def test_a_batch_of_a_stream_counts_once(spark, warehouse):
    one, two = versions(spark, (1, "a", 1)), versions(spark, (1, "b", 2))
    assert warehouse.upsert("raw.records", one, "seq", stream=("s", 0)) == 1
    assert warehouse.upsert("raw.records", two, "seq", stream=("s", 1)) == 1
    again = Warehouse(spark, warehouse.path)
    assert again.upsert("raw.records", one, "seq", stream=("s", 0)) == 0
    assert again.upsert("raw.records", one.where("false"), "seq", stream=("s", 2)) == 0
    assert again.upsert("raw.records", one, "seq", stream=("t", 0)) == 1
    assert names(again) == {"move:1": "a"}


def test_load_of_changes_only(spark):
    warehouse, whole = (Warehouse(spark, fresh_folder(spark, "changes"), buckets=4) for _ in range(2))
    first = raw_rows(spark, move=[move(i) for i in range(400)], species=[species(1), species(2, name=None)], root=[root()])
    old = F.lit("2020-01-01").cast("timestamp")
    more = raw_rows(spark, move=[move(400), move(7, name="new"), move(8, name="late")]).withColumn(
        # another key of the same id, fetched before it
        "key", F.expr("if(key = 'move:8', 'move:0008', key)")
    ).withColumn("fetched_at", F.when(F.col("key") == "move:0008", old).otherwise(F.col("fetched_at")))
    for w in (warehouse, whole):
        w.append("raw.records", first)
    load(warehouse, on_error="quarantine", only_changes=True)
    assert warehouse.table("staging.move").count() == 400
    mark = warehouse.loaded("staging.move")
    for w in (warehouse, whole):
        w.upsert("raw.records", more)
    changes = warehouse.changes("raw.records", mark)
    assert changes.count() == 3
    assert len(changes.inputFiles()) <= 4  # folders of earlier writes aren't opened
    assert load(warehouse, on_error="quarantine", only_changes=True) == {"root": 0, "species": 0, "type": 0, "move": 2}
    load(whole, on_error="quarantine")
    for name in ("root", "species", "type", "move", "rejects"):
        a, b = (w.table(f"staging.{name}").collect() for w in (warehouse, whole))
        assert sorted(map(str, a)) == sorted(map(str, b)), name
    assert load(warehouse, on_error="quarantine", only_changes=True)["move"] == 0
    with pytest.raises(Exception, match="species:2"):
        load(warehouse, only_changes=True)  # what was rejected is parsed again
    warehouse.upsert("raw.records", raw_rows(spark, species=[species(2)]))
    assert load(warehouse, only_changes=True)["species"] == 1
    assert warehouse.table("staging.species").count() == 2


def test_settings_of_the_caller_come_back(spark, warehouse):
    name = "spark.sql.adaptive.forceOptimizeSkewedJoin"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        capture(warehouse, universe(spark), fixed=types_of(spark))
        assert spark.conf.get(name) == "false"
    finally:
        spark.conf.set(name, before)


def test_null_in_a_required_column_fails(spark, warehouse):
    with pytest.raises(Exception, match="null in payload"):
        warehouse.append("raw.records", raw_rows(spark, move=[move(1)]).withColumn("payload", F.lit(None).cast("string")))


def test_load_is_idempotent(spark, warehouse):
    capture(warehouse, universe(spark), fixed=types_of(spark))
    assert load(warehouse) == {"root": 1, "species": 1, "type": 2, "move": 2}
    first = warehouse.table("staging.move").collect()
    assert load(warehouse) == {"root": 1, "species": 1, "type": 2, "move": 2}
    assert sorted(warehouse.table("staging.move").collect()) == sorted(first)


def test_load_stops_at_the_bad_entity(spark, warehouse):
    rows = raw_rows(spark, root=[root()], species=[species(1), species(2, name=None)], move=[move()])
    warehouse.append("raw.records", rows)
    with pytest.raises(Exception, match="species:2"):
        load(warehouse)
    counts = {n: warehouse.table(f"staging.{n}").count() for n in ("root", "species", "move")}
    assert counts == {"root": 1, "species": 0, "move": 0}


def test_load_quarantine(spark, warehouse):
    warehouse.append("raw.records", raw_rows(spark, species=[species(1), species(2, name=None)]))
    load(warehouse, on_error="quarantine")
    assert warehouse.table("staging.species").count() == 1
    assert [r["key"] for r in warehouse.table("staging.rejects").collect()] == ["species:2"]
    with pytest.raises(ValueError, match="on_error"):
        load(warehouse, on_error="ignore")


def test_star_is_rebuilt_whole(spark, warehouse):
    capture(warehouse, universe(spark), fixed=types_of(spark))
    load(warehouse)
    assert build_star(warehouse) == build_star(warehouse)
    assert warehouse.table("analytics.bridge_type_effectiveness").count() == 4
    assert warehouse.table("analytics.fact_root").first()["base_stat_total"] == 150


def test_layers_are_built_in_order(spark, warehouse):
    done = rebuild(
        warehouse, ("analytics", "serving", "staging", "raw"), universe(spark), fixed=types_of(spark)
    )
    assert done[:2] == [("raw", 6), ("staging", 6)] and done[2][0] == "analytics"
    assert rebuild(warehouse, ("staging",)) == [("staging", 6)]
    assert rebuild(warehouse, ()) == []
    with pytest.raises(ValueError, match="source"):
        rebuild(warehouse, ("raw",))


def test_run_records_success(spark, warehouse):
    rows = run(warehouse, universe(spark), limit=5, fixed=types_of(spark))
    assert rows == {"raw": 6, "staging": 6}
    (state,) = run_state(warehouse.table("meta.run_events")).collect()
    assert (state["status"], state["scope_limit"], state["stages"]) == ("success", 5, ["raw", "staging"])
    assert (state["raw_written"], state["staging_written"], state["error"]) == (6, 6, None)
    assert state["started_at"] <= state["finished_at"]


def test_load_only_run(spark, warehouse):
    run(warehouse, universe(spark), fixed=types_of(spark))
    run(warehouse, layers=("staging",))
    states = run_state(warehouse.table("meta.run_events")).where("stages = array('staging')").collect()
    assert [(s["raw_written"], s["staging_written"]) for s in states] == [(0, 6)]


def test_run_records_failure_and_raises(spark, warehouse):
    broken = universe(spark).where("key <> 'root:1'").unionByName(payload_rows(spark, root=[root(height="tall")]))
    with pytest.raises(Exception, match="invalid payload root:1"):
        run(warehouse, broken, fixed=types_of(spark))
    (state,) = run_state(warehouse.table("meta.run_events")).collect()
    assert state["status"] == "failed" and "invalid payload root:1" in state["error"]
    assert state["finished_at"] is not None and state["raw_written"] is None
