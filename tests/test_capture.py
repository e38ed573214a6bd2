"""Landing files, discovery and the stream."""

import json
import os
from pathlib import Path

import pytest
from conftest import kind, move, payload_rows, root, species
from pyspark.sql import functions as F

from stratalake.operators import discovery
from stratalake.operators.layers import capture, load
from stratalake.sources.landing import (
    fixed_keys,
    landing_lines,
    landing_scan,
    root_scope,
    write_files,
    write_landing,
)
from stratalake.sources.shared import fresh_folder
from stratalake.streaming.ingest import ingest_new_files


def write_tree(folder: Path, **entities):
    for entity, payloads in entities.items():
        (folder / entity).mkdir(parents=True, exist_ok=True)
        for p in payloads:
            (folder / entity / f"{p['id']}.json").write_text(json.dumps(p, indent=1))


def test_landing_tree(spark, tmp_path):
    write_tree(tmp_path, root=[root(3)], **{"egg-group": [{"id": 7}]})
    rows = {r["key"]: json.loads(r["payload"]) for r in landing_scan(spark.read, str(tmp_path)).collect()}
    assert rows == {"root:3": root(3), "egg-group:7": {"id": 7}}


def test_other_files_are_refused(spark, tmp_path):
    (tmp_path / "notes.json").write_text("{}")
    with pytest.raises(Exception, match="no entity in path"):
        landing_scan(spark.read, str(tmp_path)).collect()


def test_written_landing_reads_back(spark):
    rows = payload_rows(spark, root=[root(1)], move=[move(302), move(301)])
    folder = fresh_folder(spark, "landing")
    write_landing(rows, folder)
    assert sorted(landing_lines(spark.read, folder).drop("seq").collect()) == sorted(rows.collect())
    files = fresh_folder(spark, "files")
    write_files(rows, files)
    whole = landing_scan(spark.read, files).selectExpr("key", "rtrim('\n', payload) AS payload")
    assert sorted(whole.collect()) == sorted(rows.collect())


def keys_of(spark, *parts):
    rows = [spark.range(*span).selectExpr(f"concat('{entity}:', id) AS key") for entity, *span in parts]
    out = rows[0]
    for more in rows[1:]:
        out = out.unionByName(more)
    return out


@pytest.mark.parametrize("most", [discovery.MOST_BITS, 0])
def test_resume_by_bitmaps_is_exact(spark, most):
    existing = keys_of(spark, ("move", 0, 40_000), ("root", 0, 20_000, 7))
    wanted = keys_of(spark, ("move", 39_000, 45_000), ("root", 0, 3_000)).unionByName(spark.sql("SELECT CAST(NULL AS STRING) AS key"))
    got = discovery.resume_filter_many(wanted, existing, most)
    want = discovery.resume_filter(wanted, existing)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert want.count() == 5_000 + 3_000 - 429 + 1
    none = existing.limit(0)
    assert discovery.resume_filter_many(none, existing, most).count() == 0
    assert discovery.resume_filter_many(wanted, none, most).count() == wanted.count()


def test_bitmaps_pass_every_hit_and_few_others(spark):
    existing = keys_of(spark, ("move", 0, 400_000))
    wanted = keys_of(spark, ("move", 399_000, 410_000))
    bits = 6 * 8 * 4096
    passed = discovery.possible_hits(existing, discovery.key_bitmaps(wanted, bits), bits)
    assert existing.join(wanted, "key", "left_semi").join(passed, "key", "left_anti").count() == 0
    assert passed.count() < 400_000 * 0.08  # 11,000 keys in 196,608 bits: 1 in 18


def test_a_line_without_id_fails(spark, tmp_path):
    (tmp_path / "root").mkdir()
    (tmp_path / "root" / "a.json").write_text('{"id": 1}\n{"name": "x"}\n')
    with pytest.raises(Exception, match="payload without id"):
        landing_lines(spark.read, str(tmp_path)).collect()


def ingest(spark, landing, warehouse, progress):
    ingest_new_files(landing_scan(spark.readStream, str(landing)), warehouse, progress)


def test_stream_reads_each_file_once(spark, tmp_path, warehouse):
    landing, progress = tmp_path / "landing", str(tmp_path / "progress")
    write_tree(landing, move=[move(1), move(2)])
    ingest(spark, landing, warehouse, progress)
    raw = lambda: warehouse.table("raw.records").collect()
    first = {r["key"]: r["fetched_at"] for r in raw()}
    assert set(first) == {"move:1", "move:2"}
    write_tree(landing, species=[species(9)])
    ingest(spark, landing, warehouse, progress)
    ingest(spark, landing, warehouse, progress)
    assert sorted(r["key"] for r in raw()) == ["move:1", "move:2", "species:9"]
    assert {r["key"]: r["fetched_at"] for r in raw() if r["key"] in first} == first


def test_stream_keeps_the_later_file_and_loads(spark, tmp_path, warehouse):
    """Two captures of a key in one batch, in the order of their files, not of their text."""
    landing = tmp_path / "landing"
    write_tree(landing / "b", move=[move(1, name="zz"), move(2)], type=[kind(1, "a")])
    write_tree(landing / "a", move=[move(1, name="aa")])
    os.utime(landing / "b" / "move" / "1.json", (1_600_000_000, 1_600_000_000))
    ingest(spark, landing, warehouse, str(tmp_path / "progress"))
    assert load(warehouse) == {"root": 0, "species": 0, "type": 1, "move": 2}
    assert {r["name"] for r in warehouse.table("staging.move").collect()} == {"aa", "move-2"}


@pytest.mark.parametrize("runs", [1, 2, 3])
def test_stream_gives_the_batch_result_in_any_order(spark, tmp_path, warehouse, runs):
    """Files delivered the newest first, over several runs."""
    landing, progress = tmp_path / "landing", str(tmp_path / "progress")
    for i in range(3):  # the first to come is the latest
        for key in (1, 2 + i):
            write_tree(landing / str(i), move=[move(key, name=f"of-{i}")])
            os.utime(landing / str(i) / "move" / f"{key}.json", (1_600_000_000 - i,) * 2)
        if runs > 2 - i:
            ingest(spark, landing, warehouse, progress)
    names = warehouse.table("raw.records").selectExpr("key", "get_json_object(payload, '$.name')")
    assert dict(names.collect()) == {"move:1": "of-0", "move:2": "of-0", "move:3": "of-1", "move:4": "of-2"}


def test_references_with_repeats(spark):
    refs = discovery.extract_refs(payload_rows(spark, root=[root()]))
    assert sorted(r["ref"] for r in refs.collect()) == ["move:301", "move:302", "move:302", "move:302", "species:1"]
    assert sorted(r["key"] for r in discovery.distinct_refs(refs).collect()) == ["move:301", "move:302", "species:1"]


def test_bad_reference_fails(spark):
    bad = root(species={"url": "http://w/species/"})
    with pytest.raises(Exception, match="unparseable resource url"):
        discovery.extract_refs(payload_rows(spark, root=[bad])).collect()


def test_pending_is_sorted_and_new(spark):
    refs = discovery.extract_refs(payload_rows(spark, root=[root()]))
    known = spark.createDataFrame([("move:302",), ("type:2",)], "key string")
    pending = discovery.pending_keys(refs, fixed_keys(spark, "type", 3), known)
    assert [r["key"] for r in pending.collect()] == ["move:301", "species:1", "type:1", "type:3"]


def test_scope(spark):
    rows = payload_rows(spark, root=[root(10), root(9), root(100)], type=[kind(1, "a")])
    assert [r["key"] for r in root_scope(rows, "root", 2).collect()] == ["root:9", "root:10"]
    known = spark.createDataFrame([("root:9",), ("type:1",)], "key string")
    wanted = spark.createDataFrame([("type:1",), ("type:2",)], "key string")
    counts = discovery.scope_counts(root_scope(rows, "root"), wanted, known).first()
    assert tuple(counts) == (3, 2, 1)


def test_closure(spark):
    have = spark.createDataFrame([("a:1",), ("a:2",)], "key string")
    want = spark.createDataFrame([("a:2",), ("a:3",)], "key string")
    found = {tuple(r) for r in discovery.closure_check(have, want).collect()}
    assert found == {("a:1", "extra"), ("a:3", "missing")}


def refs_to(*keys, url="http://w"):
    return [{"move": {"name": "m", "url": f"{url}/move/{k}/"}} for k in keys]


@pytest.mark.parametrize("scan", [landing_scan, landing_lines])
def test_capture_opens_files_of_its_entities_only(spark, tmp_path, warehouse, scan):
    """A file that can't be read stands for all of its entity."""
    landing = tmp_path / "landing"
    for entity, payloads in {"root": [root(1, moves=refs_to(5))], "species": [species(1)], "move": [move(5)]}.items():
        (landing / entity).mkdir(parents=True)
        for p in payloads:
            (landing / entity / f"{p['id']}.json").write_text(json.dumps(p))
    for entity in ("type", "egg-group"):
        unreadable = landing / entity / ("1.json.gz" if scan is landing_lines else "id=1/a.json.gz")
        unreadable.parent.mkdir(parents=True)
        unreadable.write_bytes(b"not a zip")
    none = spark.createDataFrame([], "key string")
    source = scan(spark.read, str(landing), by_entity=True)
    assert capture(warehouse, source, fixed=none) == 3
    assert {r["key"] for r in warehouse.table("raw.records").collect()} == {"root:1", "species:1", "move:5"}
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        source.where("entity_type = 'type'").collect()
    assert capture(warehouse, source, fixed=none) == 0
    (landing / "root" / "2.json").write_text(json.dumps(root(2, moves=refs_to(5))))
    os.remove(landing / "move" / "5.json")  # not needed again
    assert capture(warehouse, scan(spark.read, str(landing), by_entity=True), fixed=none) == 1


def test_a_capture_that_fails_shows_nothing(spark, warehouse):
    rows = payload_rows(spark, root=[root(1, moves=refs_to(5, 6))], species=[species(1)], move=[move(5)])
    none = spark.createDataFrame([], "key string")
    with pytest.raises(ValueError, match="captured: move:6$"):
        capture(warehouse, rows, fixed=none)
    assert warehouse.table("raw.records").isEmpty() and warehouse.vacuum() == 1
    fixed = spark.createDataFrame([("move:5",), ("root:1",)], "key string")
    with pytest.raises(ValueError, match="captured: move:5, root:1$"):
        capture(warehouse, rows.limit(0), fixed=fixed)


def test_key_of_a_landed_line_is_computed_once(spark, tmp_path):
    """a join by hashes of the key doesn't copy the search for the id into a filter."""
    write_landing(payload_rows(spark, move=[move(i) for i in range(9)]), str(tmp_path / "landing"))
    lines = landing_lines(spark.read, str(tmp_path / "landing"), by_entity=True)
    hashed = lines.withColumns({"a": F.xxhash64("key"), "b": F.xxhash64(F.lit(1), "key")})
    other = spark.range(9).selectExpr("concat('move:', id) AS key").withColumns({"a": F.xxhash64("key"), "b": F.xxhash64(F.lit(1), "key")})
    joined = hashed.join(other.hint("shuffle_hash"), ["a", "b", "key"])
    assert joined._jdf.queryExecution().optimizedPlan().toString().count("get_json_object") == 1
    assert joined.count() == 9
