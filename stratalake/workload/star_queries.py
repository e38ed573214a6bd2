"""The star, data checks, lineage and runs."""

import contextlib

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratalake.operators import lineage, quality
from stratalake.operators.layers import build_star, capture, load, rebuild, run
from stratalake.plans import star
from stratalake.plans.entities import ENTITIES
from stratalake.sources.store import Warehouse, row_counts
from stratalake.workload import universe
from stratalake.workload.registry import query
from stratalake.workload.shared import Layers

_ENTITIES = list(ENTITIES)
_STAGING = [spec.table for spec in ENTITIES.values()]
_STAR = [
    "dim_type", "dim_species", "dim_move", "fact_root", "bridge_root_type", "bridge_root_move",
    "bridge_type_effectiveness",
]


def _staged(layers: Layers) -> dict[str, DataFrame]:
    return {e: layers.staging(e) for e in _ENTITIES}


def _stored_star(layers: Layers) -> dict[str, DataFrame]:
    return {f"analytics.{n}": layers.star(n) for n in _STAR}


# --- star -----------------------------------------------------------------------------


@query("dim_type", "SELECT n_nationkey AS type_id, n_name AS name FROM nation")
def q_dim_type(layers: Layers) -> DataFrame:
    return star.dim_type(layers.staging("type"))


@query(
    "dim_species",
    """SELECT id AS species_id, name, evolution_chain_id, evolves_from_id AS evolves_from_species_id,
              is_legendary, is_mythical, CAST(generation_id AS INTEGER) AS generation_id FROM u_species""",
)
def q_dim_species(layers: Layers) -> DataFrame:
    return star.dim_species(layers.staging("species"))


@query(
    "dim_move",
    """SELECT id AS move_id, name, CAST(type_id AS INTEGER) AS type_id, CAST(power AS INTEGER) AS power,
              CAST(accuracy AS INTEGER) AS accuracy, damage_class, CAST(pp AS INTEGER) AS pp FROM u_move""",
)
def q_dim_move(layers: Layers) -> DataFrame:
    return star.dim_move(layers.staging("move"))


@query("fact_build", "SELECT * FROM u_fact")
def q_fact_build(layers: Layers) -> DataFrame:
    return star.fact_root(layers.staging("root"), layers.staging("species"))


@query("row_total", "SELECT root_id, base_stat_total FROM u_fact")
def q_row_total(layers: Layers) -> DataFrame:
    return layers.star("fact_root").select(
        "root_id", star.row_total(star.STATS).alias("base_stat_total")
    )


@query(
    "bridge_slots",
    """SELECT t.root_id, CAST(t.type_id AS INTEGER) AS type_id,
              CAST(row_number() OVER (PARTITION BY root_id ORDER BY slot) AS SMALLINT) AS slot
       FROM u_root_type t""",
)
def q_bridge_slots(layers: Layers) -> DataFrame:
    return star.bridge_root_type(layers.staging("root"), star.dim_type(layers.staging("type")))


@query("bridge_learnset", "SELECT root_id, move_id FROM u_learn")
def q_bridge_learnset(layers: Layers) -> DataFrame:
    return star.bridge_root_move(layers.staging("root"), star.dim_move(layers.staging("move")))


@query(
    "slug_resolve",
    """SELECT move_id, count(*) AS n_roots FROM u_learn GROUP BY move_id""",
)
def q_slug_resolve(layers: Layers) -> DataFrame:
    rows = star.move_slugs(layers.staging("root"))
    resolved = star.resolve(rows, star.dim_move(layers.staging("move")), "move_id")
    return resolved.groupBy("move_id").agg(F.count(F.lit(1)).alias("n_roots"))


@query(
    "slug_unresolved",
    """SELECT concat('part-', l.move_id) AS slug, count(*) AS n FROM u_learn l
       JOIN u_move m ON m.id = l.move_id WHERE m.damage_class = 'status' GROUP BY ALL""",
)
def q_slug_unresolved(layers: Layers) -> DataFrame:
    # resolved against the moves that do damage: what is left are the status moves
    dim = star.dim_move(layers.staging("move")).where(F.col("damage_class") != "status")
    return star.unresolved(star.move_slugs(layers.staging("root")), dim)


@query(
    "pair_matrix",
    "SELECT a AS attacking_type_id, b AS defending_type_id, multiplier FROM u_pair",
)
def q_pair_matrix(layers: Layers) -> DataFrame:
    return star.effectiveness(layers.staging("type"))


@query(
    "star_rebuild",
    "SELECT *, (SELECT count(*) FROM u_learn) AS n_learned, (SELECT count(*) FROM u_pair) AS n_pairs FROM u_fact",
)
def q_star_rebuild(layers: Layers) -> DataFrame:
    warehouse = _with_staging(layers)
    build_star(warehouse)
    counts = build_star(warehouse)  # replaces, does not add
    return warehouse.table("analytics.fact_root").withColumns(
        {
            "n_learned": F.lit(counts["analytics.bridge_root_move"]).cast("bigint"),
            "n_pairs": F.lit(counts["analytics.bridge_type_effectiveness"]).cast("bigint"),
        }
    )


def _with_staging(layers: Layers) -> Warehouse:
    """A fresh warehouse whose staging is that of the shared one."""
    warehouse = layers.fresh_warehouse()
    warehouse.commit(
        *[warehouse.stage_overwrite(s.table, layers.staging(e)) for e, s in ENTITIES.items()]
    )
    return warehouse


# --- data checks ----------------------------------------------------------------------


@query(
    "dq_unique",
    """SELECT 'unique' AS rule, 'lineitem' AS table_name,
              concat(l_orderkey, ',', l_linenumber) AS key, CAST(count(*) AS VARCHAR) AS detail
       FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
)
def q_dq_unique(layers: Layers) -> DataFrame:
    return quality.unique(layers.tables.lineitem, "lineitem", ["l_orderkey", "l_linenumber"])


@query(
    "dq_relationships",
    """SELECT 'relationships' AS rule, 'events' AS table_name, CAST(user_id AS VARCHAR) AS key,
              CAST(count(*) AS VARCHAR) AS detail
       FROM events WHERE user_id NOT IN (SELECT id FROM u_species WHERE NOT is_legendary) GROUP BY user_id""",
)
def q_dq_relationships(layers: Layers) -> DataFrame:
    common = layers.star("dim_species").where(~F.col("is_legendary"))
    return quality.relationships(
        layers.tables.events, "events", ["user_id"], common, ["species_id"]
    )


@query(
    "dq_accepted",
    """SELECT 'accepted_values' AS rule, 'dim_move' AS table_name, damage_class AS key,
              CAST(count(*) AS VARCHAR) AS detail FROM u_move WHERE damage_class = 'status' GROUP BY ALL
       UNION ALL SELECT 'accepted_values', 'dim_move', CASE WHEN accuracy IS NULL THEN 'null' ELSE CAST(accuracy AS VARCHAR) END, CAST(count(*) AS VARCHAR)
       FROM u_move WHERE accuracy IS NULL OR accuracy NOT IN (100, 75) GROUP BY accuracy""",
)
def q_dq_accepted(layers: Layers) -> DataFrame:
    moves = layers.star("dim_move")
    classes = quality.accepted_values(moves, "dim_move", "damage_class", ["physical", "special"])
    return classes.unionByName(quality.accepted_values(moves, "dim_move", "accuracy", [100, 75]))


@query(
    "dq_matrix",
    """SELECT 'matrix' AS rule, 'bridge_type_effectiveness' AS table_name, CAST(a AS VARCHAR) AS key,
              CAST(count(*) FILTER (multiplier > 0) AS VARCHAR) AS detail
       FROM u_pair GROUP BY a HAVING count(*) FILTER (multiplier > 0) <> (SELECT count(*) FROM nation)""",
)
def q_dq_matrix(layers: Layers) -> DataFrame:
    # a matrix without its zeros is incomplete wherever a type has no effect on another
    sparse = layers.star("bridge_type_effectiveness").where(F.col("multiplier") > 0)
    return quality.matrix_complete(sparse, layers.star("dim_type"))


@query(
    "dq_bridge",
    """SELECT 'bridge' AS rule, 'scoring moves' AS table_name, 'moves' AS key,
              concat((SELECT count(*) FROM u_learn l JOIN u_move m ON m.id = l.move_id
                      WHERE m.power IS NOT NULL), '/', (SELECT count(*) FROM u_learn)) AS detail""",
)
def q_dq_bridge(layers: Layers) -> DataFrame:
    """Holds for the whole bridges; a bridge to the moves with power only is found short."""
    roots = layers.staging("root")
    scoring = layers.star("bridge_root_move").join(
        layers.star("dim_move").where(F.col("power").isNotNull()).select("move_id"),
        "move_id",
        "left_semi",
    )
    checks = [
        quality.bridge_cardinality(roots, "moves", layers.star("bridge_root_move"), "bridge_root_move"),
        quality.bridge_cardinality(roots, "types", layers.star("bridge_root_type"), "bridge_root_type"),
        quality.bridge_cardinality(roots, "moves", scoring, "scoring moves"),
    ]
    return checks[0].unionByName(checks[1]).unionByName(checks[2])


@query(
    "dq_conservation",
    """SELECT 'conservation' AS rule, 'staging' AS table_name, 'move' AS key,
              concat((SELECT count(*) FROM part WHERE p_type <> 'SMALL'), '/', (SELECT count(*) FROM part)) AS detail""",
)
def q_dq_conservation(layers: Layers) -> DataFrame:
    """Every entity is whole but the moves, of which those without power are left out here."""
    staged = _staged(layers)
    staged["move"] = staged["move"].where(F.col("power").isNotNull())
    return quality.conservation(layers.raw, staged)


@query(
    "dq_reciprocity",
    """SELECT 'reciprocity' AS rule, 'half' AS table_name, concat(a_name, '>', b_name) AS key,
              'from only' AS detail
       FROM u_pair p JOIN nation n ON n.n_nationkey = p.a
       WHERE multiplier = 0.5 AND n_regionkey = 0""",
)
def q_dq_reciprocity(layers: Layers) -> DataFrame:
    """Both sides agree; the types without a class have their half list emptied to differ."""
    types = layers.staging("type")
    emptied = types.withColumn(
        "half_damage_to",
        F.when(F.col("move_damage_class").isNull(), F.slice("half_damage_to", 1, 0)).otherwise(F.col("half_damage_to")),
    )
    whole = quality.reciprocity(types, "double").unionByName(quality.reciprocity(types, "no"))
    return whole.unionByName(quality.reciprocity(emptied, "half"))


@query(
    "dq_idempotent",
    """SELECT 'idempotent' AS rule, 'dim_move' AS table_name, CAST(id AS VARCHAR) AS key,
              side AS detail
       FROM u_move, (VALUES ('left only'), ('right only')) v(side) WHERE accuracy IS NULL""",
)
def q_dq_idempotent(layers: Layers) -> DataFrame:
    """Built twice, the star is the same; a build that fills null accuracies is not."""
    again = star.star(*(layers.staging(e) for e in _ENTITIES))
    stored = _stored_star(layers)
    filled = again["analytics.dim_move"].fillna({"accuracy": 100})
    out = quality.same_rows(stored["analytics.dim_move"], filled, "dim_move")
    for name, rows in again.items():
        out = out.unionByName(quality.same_rows(stored[name], rows, name))
    return out


@query(
    "dq_star",
    "SELECT c AS \"check\", CAST(0 AS BIGINT) AS violations FROM (VALUES "
    + ", ".join(
        f"('{c}')"
        for c in [
            *(f"unique:{n}" for n in _STAR),
            *(
                f"relationships:{c}"
                for c in (
                    "dim_species:evolves_from_species_id", "dim_move:type_id",
                    "fact_root:species_id", "bridge_root_type:root_id",
                    "bridge_root_type:type_id", "bridge_root_move:root_id",
                    "bridge_root_move:move_id", "bridge_type_effectiveness:attacking_type_id",
                    "bridge_type_effectiveness:defending_type_id",
                )
            ),
            "accepted_values:dim_move:damage_class", "accepted_values:bridge_root_type:slot",
            "accepted_values:bridge_type_effectiveness:multiplier",
            "matrix:bridge_type_effectiveness",
        ]
    )
    + ") v(c)",
)
def q_dq_star(layers: Layers) -> DataFrame:
    return quality.star_summary(quality.star_violations(_stored_star(layers)))


@query(
    "dq_star_violations",
    """SELECT 'relationships:bridge_root_move:move_id' AS "check", count(DISTINCT move_id) AS violations
       FROM u_learn WHERE move_id IN (SELECT id FROM u_move WHERE damage_class = 'status')
       UNION ALL SELECT 'unique:fact_root', count(*) FROM u_fact WHERE height = 1
       UNION ALL SELECT 'relationships:fact_root:species_id', count(DISTINCT species_id)
       FROM u_fact WHERE species_id IN (SELECT id FROM u_species WHERE is_baby)
       UNION ALL SELECT 'matrix:bridge_type_effectiveness', count(DISTINCT a) FROM u_pair WHERE a = 0""",
)
def q_dq_star_violations(layers: Layers) -> DataFrame:
    """The same checks where status moves, young species and one type's pairs are gone and some roots are double."""
    star = _stored_star(layers)
    move, species, fact, pairs = (
        star[f"analytics.{n}"] for n in ("dim_move", "dim_species", "fact_root", "bridge_type_effectiveness")
    )
    baby = layers.staging("species").where("is_baby").select(F.col("id").alias("species_id"))
    broken = star | {
        "analytics.dim_move": move.where("damage_class <> 'status'"),
        "analytics.dim_species": species.join(baby, "species_id", "left_anti"),
        "analytics.fact_root": fact.unionByName(fact.where("height = 1")),
        "analytics.bridge_type_effectiveness": pairs.where("attacking_type_id <> 0"),
    }
    names = ["relationships:bridge_root_move:move_id", "unique:fact_root", "relationships:fact_root:species_id", "matrix:bridge_type_effectiveness"]
    return quality.star_summary(quality.star_violations(broken)).where(F.col("check").isin(names))


# --- lineage and runs -----------------------------------------------------------------


@query(
    "load_counts",
    """SELECT 'root' AS entity, count(*) AS n FROM u_root UNION ALL
       SELECT 'species', count(*) FROM customer UNION ALL SELECT 'type', count(*) FROM nation
       UNION ALL SELECT 'move', count(*) FROM part UNION ALL
       SELECT '(total)', (SELECT count(*) FROM u_root) + (SELECT count(*) FROM customer)
              + (SELECT count(*) FROM nation) + (SELECT count(*) FROM part)""",
)
def q_load_counts(layers: Layers) -> DataFrame:
    return lineage.load_counts(_staged(layers))


def _run_events(layers: Layers) -> DataFrame:
    """Runs told by the orders: all begin; F fail, P succeed, O are still running."""
    orders = layers.tables.orders
    items = layers.tables.lineitem.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    begun = orders.select(
        F.col("o_orderkey").cast("string").alias("run_id"),
        F.lit(0).alias("seq"),
        F.col("o_orderdate").alias("at"),
        F.lit(lineage.RUNNING).alias("status"),
        F.col("o_custkey").alias("scope_limit"),
        F.array(F.lit("raw"), F.lit("staging")).alias("stages"),
    )
    ended = (
        orders.where(F.col("o_orderstatus").isin("F", "P"))
        .join(items, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .withColumn("ok", F.col("o_orderstatus") == "P")
        .select(
            F.col("o_orderkey").cast("string").alias("run_id"),
            F.lit(1).alias("seq"),
            (F.col("o_orderdate") + F.expr("INTERVAL 1 HOUR")).alias("at"),
            F.when(F.col("ok"), lineage.SUCCESS).otherwise(F.lit(lineage.FAILED)).alias("status"),
            F.when(F.col("ok"), F.coalesce("n", F.lit(0))).alias("raw_written"),
            F.when(F.col("ok"), F.lit(0).cast("bigint")).alias("staging_written"),
            F.when(~F.col("ok"), F.concat_ws(": ", "o_orderpriority", F.lit("stopped"))).alias("error"),
        )
    )
    return begun.unionByName(ended, allowMissingColumns=True)


@query(
    "run_lineage",
    """SELECT CAST(o_orderkey AS VARCHAR) AS run_id, o_orderdate AS started_at,
              CASE WHEN o_orderstatus <> 'O' THEN o_orderdate + INTERVAL 1 HOUR END AS finished_at,
              CASE o_orderstatus WHEN 'F' THEN 'failed' WHEN 'P' THEN 'success' ELSE 'running' END AS status,
              o_custkey AS scope_limit, 'raw,staging' AS stages,
              CASE WHEN o_orderstatus = 'P' THEN coalesce(n, 0) END AS raw_written,
              CASE WHEN o_orderstatus = 'P' THEN CAST(0 AS BIGINT) END AS staging_written,
              CASE WHEN o_orderstatus = 'F' THEN concat(o_orderpriority, ': stopped') END AS error
       FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY ALL) i
         ON l_orderkey = o_orderkey""",
)
def q_run_lineage(layers: Layers) -> DataFrame:
    runs = lineage.run_state(_run_events(layers))
    return runs.withColumn("stages", F.array_join("stages", ","))


@query(
    "run_failures",
    """SELECT o_orderpriority AS error_type, count(*) AS n_runs FROM orders
       WHERE o_orderstatus = 'F' GROUP BY ALL""",
)
def q_run_failures(layers: Layers) -> DataFrame:
    return lineage.run_failures(lineage.run_state(_run_events(layers)))


@query(
    "run_fold",
    """SELECT o_orderstatus AS status, CAST(coalesce(sum(n), 0) AS BIGINT) AS raw_written,
              CAST(coalesce(sum(d), 0) AS BIGINT) AS staging_written
       FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n, count(DISTINCT l_partkey) AS d
                              FROM lineitem GROUP BY ALL) i ON l_orderkey = o_orderkey
       GROUP BY ALL""",
)
def q_run_fold(layers: Layers) -> DataFrame:
    """Two partial results per order, extract and load; orders without items have none."""
    parts = layers.tables.lineitem.groupBy("l_orderkey", "l_partkey").agg(F.count(F.lit(1)).alias("n"))
    extract = parts.select("l_orderkey", F.col("n").alias("raw_written"))
    loaded = parts.select("l_orderkey", F.lit(1).cast("bigint").alias("staging_written"))
    stages = extract.unionByName(loaded, allowMissingColumns=True)
    status = layers.tables.orders.select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderstatus").alias("status")
    )
    return lineage.run_fold(status.join(stages, "l_orderkey", "left"), ["status"])


@query("stage_subset", "SELECT *, false AS star_written FROM u_species")
def q_stage_subset(layers: Layers) -> DataFrame:
    """Only the named layer is built, whatever the order; unknown names count for nothing."""
    warehouse = layers.fresh_warehouse()
    warehouse.overwrite("raw.records", layers.placed_raw)
    rebuild(warehouse, ("serving", "staging"))
    rows = warehouse.table("staging.species").withColumn("egg_groups", F.array_join("egg_groups", ","))
    return rows.withColumn("star_written", F.lit(warehouse.is_written("analytics.fact_root")))


@query(
    "load_only",
    """SELECT m.*, (SELECT count(*) FROM u_root) + (SELECT count(*) FROM customer)
              + (SELECT count(*) FROM nation) + (SELECT count(*) FROM part) AS n_raw
       FROM u_move m""",
)
def q_load_only(layers: Layers) -> DataFrame:
    """Staging from the raw that is there, twice; raw stays as it is."""
    warehouse = layers.fresh_warehouse()
    warehouse.overwrite("raw.records", layers.placed_raw)
    load(warehouse)
    load(warehouse)
    n = row_counts(warehouse, ["raw.records"]).select("n").scalar()
    return warehouse.table("staging.move").withColumn("n_raw", n)


@query(
    "run_recorded",
    """SELECT i, CASE WHEN i = 2 THEN 'failed' ELSE 'success' END AS status,
              CASE i WHEN 0 THEN 'raw,staging' WHEN 1 THEN 'staging' ELSE 'raw' END AS stages,
              CASE i WHEN 0 THEN n.raw WHEN 1 THEN 0 END AS raw_written,
              CASE WHEN i < 2 THEN n.raw END AS staging_written, i = 2 AS has_error
       FROM range(3) t(i) CROSS JOIN (
           SELECT (SELECT count(*) FROM u_root) + (SELECT count(DISTINCT species) FROM u_root)
                  + (SELECT count(*) FROM nation) + (SELECT count(DISTINCT move_id) FROM u_learn) AS raw) n""",
)
def q_run_recorded(layers: Layers) -> DataFrame:
    """The lineage of a full run, of a load alone, and of a capture from a source without types."""
    warehouse, fixed = layers.fresh_warehouse(), universe.all_types(layers.tables)
    source = layers.raw.select("key", "payload")
    run(warehouse, source, fixed=fixed)
    run(warehouse, layers=("staging",))
    other = fixed.selectExpr("concat(key, '00') AS key")
    with contextlib.suppress(ValueError):  # its failure is what is recorded
        run(warehouse, source, layers=("raw",), fixed=other)
    runs = lineage.run_state(warehouse.table("meta.run_events"))
    ordered = runs.withColumn("i", F.row_number().over(Window.orderBy("started_at")).cast("bigint") - 1)  # three rows
    return ordered.select(
        "i", "status", F.array_join("stages", ",").alias("stages"), "raw_written", "staging_written",
        F.col("error").isNotNull().alias("has_error"),
    )


@query(
    "full_refresh",
    """SELECT e AS entity_type, CAST(CASE e WHEN 'root' THEN (SELECT count(*) FROM u_root)
                WHEN 'species' THEN (SELECT count(DISTINCT species) FROM u_root)
                WHEN 'move' THEN (SELECT count(DISTINCT move_id) FROM u_learn)
                ELSE (SELECT count(*) FROM nation) END AS BIGINT) AS n, CAST(0 AS BIGINT) AS differing
       FROM (VALUES ('root'), ('species'), ('move'), ('type')) v(e)""",
)
def q_full_refresh(layers: Layers) -> DataFrame:
    """A capture into an empty warehouse equals one resumed from half the records."""
    source = layers.raw.select("key", "payload")
    fixed = universe.all_types(layers.tables)
    resumed = layers.fresh_warehouse()
    resumed.append(
        "raw.records", layers.placed_raw.where(F.col("entity_type").isin("root", "type"))
    )
    capture(resumed, source, fixed=fixed)
    fresh = layers.fresh_warehouse()
    capture(fresh, source, fixed=fixed)
    # a digest stands for the payload, which then is not shuffled
    a, b = (
        w.table("raw.records").selectExpr("entity_type", "key", "sha2(payload, 256) AS digest")
        for w in (fresh, resumed)
    )
    differing = quality.same_rows(a, b, "raw").groupBy(F.col("key").alias("entity_type")).agg(
        F.count(F.lit(1)).alias("differing")
    )
    counts = a.groupBy("entity_type").agg(F.count(F.lit(1)).alias("n"))
    return counts.join(differing, "entity_type", "left").select(
        "entity_type", "n", F.coalesce("differing", F.lit(0).cast("bigint")).alias("differing")
    )
