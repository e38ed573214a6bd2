"""Projection functions, entity projections and the gate."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.functions.nested import (
    collapse_spaces,
    distinct_sorted,
    first_match,
    last_match,
    nested_names,
    slot_order,
)
from stratalake.functions.refs import ref_id
from stratalake.operators.quality import summary
from stratalake.plans.entities import (
    ENTITIES,
    MISSING,
    NULL,
    WRONG_TYPE,
    EntitySpec,
    all_accepted,
    checked,
    project,
    scalar,
)
from stratalake.plans.tables import conform
from stratalake.sources.landing import raw_by_entity
from stratalake.sources.store import row_counts
from stratalake.workload.registry import query
from stratalake.workload.shared import Layers

_REF = "struct<name:string,url:string>"


def _parsed(layers: Layers, entity: str, ddl: str) -> DataFrame:
    payloads = raw_by_entity(layers.raw, entity)
    return payloads.selectExpr(f"explode(array(from_json(payload, '{ddl}'))) AS d").select("d.*")


def _joined(names: str, alias: str) -> str:
    return f"array_join({names}, ',') AS {alias}"


# --- functions ------------------------------------------------------------------------


@query("ref_id", "SELECT id, species AS species_id FROM u_root")
def q_ref_id(layers: Layers) -> DataFrame:
    rows = _parsed(layers, "root", f"id bigint, species {_REF}")
    return rows.selectExpr("id", f"{ref_id('species.url')} AS species_id")


@query(
    "slot_order",
    """SELECT id, (SELECT string_agg(name, ',' ORDER BY slot) FROM u_root_type t WHERE t.root_id = r.id) AS types,
              concat('trait-', id % 11, ',aura-', nation % 7) AS abilities FROM u_root r""",
)
def q_slot_order(layers: Layers) -> DataFrame:
    ddl = f"id bigint, types array<struct<slot:int,type:{_REF}>>, abilities array<struct<slot:int,ability:{_REF}>>"
    return _parsed(layers, "root", ddl).selectExpr(
        "id",
        _joined(slot_order("types", "e.slot", "e.type.name"), "types"),
        _joined(slot_order("abilities", "e.slot", "e.ability.name"), "abilities"),
    )


@query("nested_names", "SELECT id, egg_groups, len(egg_groups) = 0 AS is_empty FROM u_species")
def q_nested_names(layers: Layers) -> DataFrame:
    rows = _parsed(layers, "species", f"id bigint, egg_groups array<{_REF}>")
    names = nested_names("egg_groups", "e.name")
    return rows.selectExpr("id", _joined(names, "egg_groups"), f"size({names}) = 0 AS is_empty")


@query(
    "distinct_sorted",
    """SELECT root_id AS id, count(*) AS n, string_agg(slug, ',' ORDER BY slug) AS moves
       FROM (SELECT root_id, concat('part-', move_id) AS slug FROM u_learn) GROUP BY root_id
       UNION ALL SELECT id, 0, '' FROM u_root WHERE id NOT IN (SELECT root_id FROM u_learn)""",
)
def q_distinct_sorted(layers: Layers) -> DataFrame:
    rows = _parsed(layers, "root", f"id bigint, moves array<struct<move:{_REF}>>")
    names = rows.selectExpr("id", f"{distinct_sorted('moves', 'e.move.name')} AS names")
    return names.selectExpr("id", "CAST(size(names) AS BIGINT) AS n", _joined("names", "moves"))


@query(
    "first_match",
    """SELECT conv_id, arg_min(turn, turn) FILTER (role = 'assistant') AS first_answer,
              arg_min(text, turn) FILTER (role = 'system') AS instruction
       FROM conversations GROUP BY conv_id""",
)
def q_first_match(layers: Layers) -> DataFrame:
    # The first matching turn needs no list of all turns: a conversation of any length is
    # reduced to its first turn per role in each task, and that short list is searched.
    firsts = layers.tables.conversations.groupBy("conv_id", "role").agg(
        F.min(F.struct("turn", "text")).alias("first")
    )
    turns = firsts.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("first.turn", "role", "first.text"))).alias("turns")
    )
    answer = first_match("turns", "e.role = 'assistant'")
    instruction = first_match("turns", "e.role = 'system'")
    return turns.selectExpr("conv_id", f"{answer}.turn AS first_answer", f"{instruction}.text AS instruction")


@query("ws_collapse", r"SELECT doc_id, trim(regexp_replace(text, '\s+', ' ', 'g')) AS text FROM documents")
def q_ws_collapse(layers: Layers) -> DataFrame:
    return layers.tables.documents.selectExpr("doc_id", f"{collapse_spaces('text')} AS text")


@query(
    "stat_pivot",
    """SELECT id, hp, attack, defense, special_attack, special_defense, speed FROM u_root""",
)
def q_stat_pivot(layers: Layers) -> DataFrame:
    rows = _parsed(layers, "root", f"id bigint, stats array<struct<base_stat:bigint,stat:{_REF}>>")
    names = ["hp", "attack", "defense", "special-attack", "special-defense", "speed"]
    stats = {n.replace("-", "_"): last_match("stats", f"e.stat.name = '{n}'") for n in names}
    return rows.selectExpr("id", *[f"{hit}.base_stat AS {c}" for c, hit in stats.items()])


@query("nested_path", "SELECT id, growth_rate, color, generation_id FROM u_species")
def q_nested_path(layers: Layers) -> DataFrame:
    rows = _parsed(layers, "species", f"id bigint, growth_rate {_REF}, color {_REF}, generation {_REF}")
    return rows.selectExpr(
        "id",
        "growth_rate.name AS growth_rate",
        "color.name AS color",
        f"{ref_id('generation.url')} AS generation_id",
    )


@query("optional_path", "SELECT id, shape, habitat, evolves_from_id FROM u_species")
def q_optional_path(layers: Layers) -> DataFrame:
    rows = _parsed(layers, "species", f"id bigint, shape {_REF}, habitat {_REF}, evolves_from_species {_REF}")
    return rows.selectExpr(
        "id",
        "shape.name AS shape",
        "habitat.name AS habitat",
        f"{ref_id('evolves_from_species.url')} AS evolves_from_id",
    )


@query("null_preserved", "SELECT id, power, accuracy, pp, effect_chance FROM u_move")
def q_null_preserved(layers: Layers) -> DataFrame:
    rows = project(raw_by_entity(layers.raw, "move"), ENTITIES["move"])
    return rows.select("id", "power", "accuracy", "pp", "effect_chance")


@query(
    "column_order",
    """SELECT id, name, "order", 7 AS is_legendary_position FROM u_species""",
)
def q_column_order(layers: Layers) -> DataFrame:
    spec = ENTITIES["species"]
    rows = project(raw_by_entity(layers.raw, "species"), spec)
    shuffled = rows.select([F.col(f"`{c}`") for c in sorted(rows.columns, reverse=True)])
    ordered = conform(shuffled, spec.schema)
    position = ordered.columns.index("is_legendary") + 1
    return ordered.select("id", "name", "`order`", F.lit(position).alias("is_legendary_position"))


# --- entities -------------------------------------------------------------------------


def _lists_joined(rows: DataFrame) -> DataFrame:
    lists = [f.name for f in rows.schema if f.dataType.typeName() == "array"]
    return rows.withColumns({c: F.array_join(c, ",") for c in lists})


@query(
    "stage_root",
    """SELECT r.id, r.name, height, weight, CASE WHEN balance >= 0 THEN weight END AS base_experience,
              id AS "order", balance >= 0 AS is_default, species AS species_id,
              (SELECT string_agg(t.name, ',' ORDER BY slot) FROM u_root_type t WHERE t.root_id = r.id) AS types,
              concat('trait-', id % 11, ',aura-', nation % 7) AS abilities, coalesce(l.moves, '') AS moves,
              CASE WHEN balance >= 0 THEN concat('http://w/front/', id, '/') END AS sprite_front_default,
              CASE WHEN balance >= 5000 THEN concat('http://w/back/', id, '/') END AS sprite_back_default,
              hp, attack, defense, special_attack, special_defense, speed
       FROM u_root r LEFT JOIN (
           SELECT root_id, string_agg(slug, ',' ORDER BY slug) AS moves
           FROM (SELECT root_id, concat('part-', move_id) AS slug FROM u_learn) GROUP BY root_id) l
         ON l.root_id = r.id""",
)
def q_stage_root(layers: Layers) -> DataFrame:
    rows = project(raw_by_entity(layers.raw, "root"), ENTITIES["root"])
    return _lists_joined(rows)


@query("stage_species", "SELECT * FROM u_species")
def q_stage_species(layers: Layers) -> DataFrame:
    rows = project(raw_by_entity(layers.raw, "species"), ENTITIES["species"])
    return _lists_joined(rows)


_TYPE_LISTS = ",\n".join(
    f"""coalesce((SELECT string_agg({other}_name, ',' ORDER BY {other}) FROM u_pair
        WHERE {own} = n_nationkey AND multiplier = {value}), '') AS {kind}_damage_{side}"""
    for kind, value in (("double", 2), ("half", 0.5), ("no", 0))
    for side, own, other in (("to", "a", "b"), ("from", "b", "a"))
)


@query(
    "stage_type",
    f"""SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS name,
               CAST(n_regionkey AS BIGINT) AS generation_id,
               CASE n_regionkey WHEN 0 THEN NULL WHEN 1 THEN 'physical' ELSE 'special' END AS move_damage_class,
               {_TYPE_LISTS} FROM nation""",
)
def q_stage_type(layers: Layers) -> DataFrame:
    rows = project(raw_by_entity(layers.raw, "type"), ENTITIES["type"])
    return _lists_joined(rows)


@query("stage_move", "SELECT * FROM u_move")
def q_stage_move(layers: Layers) -> DataFrame:
    return project(raw_by_entity(layers.raw, "move"), ENTITIES["move"])


# --- gate -----------------------------------------------------------------------------

# One required number, read from the props of the events; some of them are spoiled first.
_PROPS = EntitySpec("event", "staging.event", "k {int}", (scalar("k", "bigint"),))

_BAD = {
    WRONG_TYPE: "event_type = 'error' AND value >= 10",
    NULL: "event_type = 'signup' AND value < 5",
    MISSING: "event_type = 'view' AND value >= 20",
}


def _spoiled(layers: Layers) -> DataFrame:
    payload = (
        F.when(F.expr(_BAD[WRONG_TYPE]), '{"k":"tall"}')
        .when(F.expr(_BAD[NULL]), '{"k":null}')
        .when(F.expr(_BAD[MISSING]), "{}")
        .otherwise(F.col("props"))
    )
    return layers.tables.events.select(
        F.concat(F.lit("event:"), "event_id").alias("key"), payload.alias("payload")
    )


def _gate_rows(layers: Layers, problem: str) -> DataFrame:
    rows = checked(_spoiled(layers), _PROPS)
    hits = rows.where(F.array_contains("problems", f"k: {problem}"))
    return hits.select("key", F.array_join("problems", ";").alias("problems"))


def _gate_sql(problem: str) -> str:
    return (
        f"SELECT concat('event:', event_id) AS key, 'k: {problem}' AS problems "
        f"FROM events WHERE {_BAD[problem]}"
    )


@query("gate_type", _gate_sql(WRONG_TYPE))
def q_gate_type(layers: Layers) -> DataFrame:
    return _gate_rows(layers, WRONG_TYPE)


@query("gate_required", _gate_sql(NULL))
def q_gate_required(layers: Layers) -> DataFrame:
    return _gate_rows(layers, NULL)


@query("gate_missing", _gate_sql(MISSING))
def q_gate_missing(layers: Layers) -> DataFrame:
    return _gate_rows(layers, MISSING)


@query(
    "gate_atomic",
    """SELECT 'staging.move' AS table_name, count(*) AS n, false AS failed FROM part UNION ALL
       SELECT 'staging.species', CAST(0 AS BIGINT), true""",
)
def q_gate_atomic(layers: Layers) -> DataFrame:
    """One payload without a name: its entity is not written at all, the one before stays."""
    warehouse = layers.fresh_warehouse()
    warehouse.upsert("staging.move", project(raw_by_entity(layers.raw, "move"), ENTITIES["move"]))
    spoiled = raw_by_entity(layers.raw, "species").withColumn(
        "payload",
        F.when(F.col("key") == "species:0", F.lit('{"id":0}')).otherwise(F.col("payload")),
    )
    failed = False
    try:
        rows = checked(spoiled, ENTITIES["species"])
        warehouse.upsert("staging.species", all_accepted(rows).drop("key"))
    except Exception as error:
        failed = "invalid payload species:0" in str(error)
    counts = row_counts(warehouse, ["staging.move", "staging.species"])
    stopped = F.when(F.col("table_name") == "staging.species", F.lit(failed)).otherwise(F.lit(False))
    return counts.withColumn("failed", stopped)


@query(
    "gate_summary",
    "SELECT concat('k: ', p) AS \"check\", n AS violations FROM (" + " UNION ALL ".join(
        f"SELECT '{p}' AS p, count(*) AS n FROM events WHERE {c}" for p, c in _BAD.items()
    ) + ")",
)
def q_gate_summary(layers: Layers) -> DataFrame:
    rows = checked(_spoiled(layers), _PROPS).select(F.explode("problems").alias("p"))
    return summary({f"k: {p}": rows.where(F.col("p") == f"k: {p}") for p in _BAD})
