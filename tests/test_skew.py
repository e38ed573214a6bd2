"""Hot keys: what a third of all rows on one key does to the plans."""

import pytest
from conftest import SF
from pyspark.sql import functions as F

from stratalake.operators import quality
from stratalake.operators.upsert import latest
from stratalake.plans import star
from stratalake.workload.shared import Layers
from stratalake.workload.universe import Tables


@pytest.fixture
def small_partitions(spark):
    """Settings under which a few megabytes count as a large skewed partition."""
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def final_plan(frame):
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString()


def hot_edges(spark, n=300_000):
    """(root_id, slug): a third of the rows name one slug."""
    hot = "CASE WHEN id % 3 = 0 THEN 'slug-0' ELSE concat('slug-', id % 5000) END AS slug"
    return spark.range(0, n, 1, 8).selectExpr("id AS root_id", hot)


def test_hot_slug_is_split(spark, small_partitions):
    dim = spark.range(5000).selectExpr("id AS move_id", "concat('slug-', id) AS name")
    resolved = star.resolve(hot_edges(spark), dim, "move_id")
    assert "SortMergeJoin(skew=true)" in final_plan(resolved)
    assert resolved.count() == 300_000


def test_hot_key_is_reduced_before_the_shuffle(spark):
    rows = hot_edges(spark).withColumn("seq", F.col("root_id"))
    frame = latest(rows, ["slug"], "seq")
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "Window" not in plan
    assert frame.where("slug = 'slug-0'").first()["seq"] == 299_997


def test_checks_count_before_they_join(spark):
    dim = spark.range(5000).selectExpr("concat('slug-', id) AS name").where("name <> 'slug-0'")
    found = quality.relationships(hot_edges(spark), "t", ["slug"], dim, ["name"])
    assert [(r["key"], r["detail"]) for r in found.collect()] == [("slug-0", "100040")]


def test_a_supplier_with_a_third_of_all_lineitems(spark, tmp_path):
    """Payloads stay short, and every lineitem is a move of its one root."""
    folder = str(tmp_path)
    for name in ("nation", "customer", "supplier", "part", "orders", "lineitem"):
        rows = spark.read.parquet(f"{SF}/{name}.parquet")
        if name == "lineitem":
            rows = rows.withColumn("l_suppkey", F.expr("if(l_partkey % 3 = 0, 1L, l_suppkey)"))
        rows.write.parquet(f"{folder}/{name}.parquet")
    layers = Layers(spark, folder)
    fact, items = layers.star("fact_root"), Tables(spark, folder).lineitem
    assert fact.count() == fact.select("root_id").distinct().count() == Tables(spark, folder).orders.count()
    read = "from_json(payload, 'moves array<struct<move:struct<url:string>>>').moves"
    sizes = layers.raw.where("entity_type = 'root'").selectExpr(f"size({read}) AS n").collect()
    assert sum(r["n"] for r in sizes) == items.count() and max(r["n"] for r in sizes) < 30
    learned = layers.star("bridge_root_move").selectExpr("root_id", "move_id")
    want = items.selectExpr("l_orderkey AS root_id", "l_partkey AS move_id").distinct()
    assert learned.exceptAll(want).count() == want.exceptAll(learned).count() == 0


def test_dense_matrix_needs_no_join(spark):
    rows = spark.sql(
        "SELECT id, concat('t', id) AS name, array('t1') AS double_damage_to, array() AS half_damage_to,"
        " array('t2') AS no_damage_to FROM range(10)"
    )
    plan = star.effectiveness(rows)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Cartesian" not in plan
