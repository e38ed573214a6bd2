"""Plans: what is read, and what is shuffled."""

import pytest
from conftest import SF

from stratalake.operators import discovery, quality, scoring
from stratalake.operators.upsert import latest_wide, merge_rows
from stratalake.plans.entities import ENTITIES, project
from stratalake.sources.landing import existing_keys, raw_by_entity
from stratalake.workload.shared import Layers


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def layers(spark):
    return Layers(spark, SF)


def test_one_entity_reads_one_partition(layers):
    text = plan(raw_by_entity(layers.raw, "move"))
    assert "PartitionFilters: [isnotnull(entity_type" in text and "= move)" in text
    assert "ReadSchema: struct<key:string,payload:string>" in text


def test_captured_keys_are_not_shuffled_to_meet_the_wanted(layers):
    bits = 8 * 4096
    wanted = layers.tables.part.selectExpr("concat('move:', p_partkey) AS key")
    existing = existing_keys(layers.raw)
    text = plan(discovery.possible_hits(existing, discovery.key_bitmaps(wanted, bits), bits))
    assert text.count("Exchange hashpartitioning") == 1  # of the bitmaps
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_keys_read_one_column(layers):
    assert "ReadSchema: struct<key:string>" in plan(existing_keys(layers.raw))


def test_staging_is_one_pass_without_shuffle(layers):
    text = plan(project(raw_by_entity(layers.raw, "root"), ENTITIES["root"]))
    assert "Exchange" not in text and "Python" not in text


def test_moves_without_power_are_left_out_at_the_scan(layers):
    base = scoring.move_base(
        layers.star("bridge_root_move"),
        layers.star("dim_move"),
        layers.star("fact_root"),
        layers.star("bridge_root_type"),
    )
    text = plan(base)
    assert "IsNotNull(power)" in text
    assert "ReadSchema: struct<root_id:bigint,attack:int,sp_atk:int>" in text


def test_best_move_shrinks_before_it_meets_the_matrix(layers):
    base = scoring.move_base(
        layers.star("bridge_root_move"),
        layers.star("dim_move"),
        layers.star("fact_root"),
        layers.star("bridge_root_type"),
    )
    text = plan(scoring.best_move(base, layers.star("bridge_type_effectiveness")))
    assert text.index("Generate explode") < text.index("partial_min(move_id")  # parents come first
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_small_batch_does_not_shuffle_what_is_stored(layers):
    stored = layers.staging("move")
    batch = stored.where("power IS NULL").select("id").limit(5)
    assert "BroadcastHashJoin" in plan(merge_rows(stored, batch, ["id"]))


def test_wide_rows_are_not_grouped(layers):
    # the first branch of the union holds the keys that occur once
    once = plan(latest_wide(layers.raw, ["key"], "fetched_at")).split("\n   +- ")[0]
    assert "LeftAnti" in once and "max(struct" not in once


def test_star_checks_read_each_table_once(layers):
    star = {f"analytics.{n}": layers.star(n) for n in quality.STAR_KEYS}
    text = plan(quality.star_violations(star)).split("== Initial Plan ==")[0]
    # dim_type once more, for the number of types; keys are shuffled once, what is found once more
    assert text.count("FileScan") == len(star) + 1 and text.count("Exchange hashpartitioning") == 2


def test_stats_are_searched_once_a_payload(layers):
    text = plan(project(raw_by_entity(layers.raw, "root"), ENTITIES["root"]))
    assert text.count(".stat.name") == 1 and "SortAggregate" not in text
