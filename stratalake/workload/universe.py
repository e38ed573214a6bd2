"""Nested payloads derived from the given tables.

order -> root, customer -> species, nation -> type, part -> move; lineitem gives the
learnsets, the stats and the relations between types. Every row of every table counts. An
order has few lineitems, so a payload is short however large the tables are.
"""

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.functions.bounded import bounded_list
from stratalake.plans.star import MAX_TYPES
from stratalake.sources.landing import encode_payload

# taken off an order's price, so that some roots have a balance below 0
DEBT = 50_000

#: Brings rows together for the table their payloads go to, by the key in SQL; adds ``bucket``.
Place = Callable[[DataFrame, str], DataFrame]


class Tables:
    """The given tables of one scale factor."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        table = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        setattr(self, name, table)
        return table


def _url(entity: str, number: str) -> str:
    return f"concat('http://w/{entity}/', {number}, '/')"


def _ref(name: str, entity: str, number: str) -> str:
    return f"struct({name} AS name, {_url(entity, number)} AS url)"


def _to(entity: str, number: str) -> str:
    return f"struct({_url(entity, number)} AS url)"


def _named(name: str) -> str:
    return f"struct({name} AS name)"


def _whole(amount: str) -> str:
    return f"CAST(floor(abs({amount})) AS BIGINT)"


def _payload(rows: DataFrame, entity: str, document: dict[str, str], place: Place | None) -> DataFrame:
    fields = ", ".join(f"{value} AS `{name}`" for name, value in document.items())
    key = f"concat('{entity}:', id)"
    if place:
        rows = place(rows, key)
    return rows.selectExpr(
        f"{key} AS key", f"{encode_payload(f'struct({fields})')} AS payload", *(["bucket"] if place else [])
    )


def n_types(t: Tables) -> Column:
    """How many nations there are; their keys run from 0."""
    return t.nation.agg(F.expr("count(*)")).scalar()


def order_items(t: Tables) -> DataFrame:
    """(l_orderkey, parts, counts by flag and status): an order's part keys, repeats included."""
    return t.lineitem.groupBy("l_orderkey").agg(
        F.expr("sort_array(collect_list(l_partkey)) AS parts"),
        F.expr("count_if(l_returnflag = 'A') AS n_a"),
        F.expr("count_if(l_returnflag = 'N') AS n_n"),
        F.expr("count_if(l_returnflag = 'R') AS n_r"),
        F.expr("count_if(l_linestatus = 'O') AS n_o"),
        F.expr("count_if(l_linestatus = 'F') AS n_f"),
    )


def roots(t: Tables, place: Place | None = None) -> DataFrame:
    nation = t.nation.select("n_nationkey", "n_name")
    rows = (
        t.orders.withColumn("n_types", n_types(t))
        .withColumn("first", F.expr("o_orderkey % n_types"))
        .withColumn("other", F.expr("o_orderkey * 7 % n_types"))
        .join(order_items(t).withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderkey", "left")
        .join(nation.toDF("first", "type_1"), "first")
        .join(nation.toDF("other", "type_2"), "other")
        .selectExpr("*", f"o_totalprice - {DEBT} AS balance", "o_orderkey AS id")
        .withColumn("amount", F.expr(_whole("balance")))
    )

    def stat(name: str, value: str) -> str:
        return f"struct(CAST({value} AS BIGINT) AS base_stat, {_named(f"'{name}'")} AS stat)"

    first = f"struct(1 AS slot, {_ref('type_1', 'type', 'first')} AS type)"
    second = f"struct(2 AS slot, {_ref('type_2', 'type', 'other')} AS type)"
    trait = f"struct(1 AS slot, {_named("concat('trait-', id % 11)")} AS ability)"
    aura = f"struct(3 AS slot, {_named("concat('aura-', first % 7)")} AS ability)"
    move = _ref("concat('part-', p)", "move", "p")
    stats = [
        stat("speed", "-1"),  # a repeated name: the later entry counts
        stat("hp", "coalesce(n_a, 0)"),
        stat("attack", "coalesce(n_n, 0) + amount"),
        stat("defense", "coalesce(n_r, 0)"),
        stat("special-attack", "coalesce(n_o, 0) + amount"),
        stat("special-defense", "coalesce(n_f, 0)"),
        stat("speed", "amount % 1000"),
    ]
    return _payload(
        rows,
        "root",
        {
            "id": "id",
            "name": "concat('order-', id)",
            "height": "first + 1",
            "weight": "amount",
            "base_experience": "CASE WHEN balance >= 0 THEN amount END",
            "order": "id",
            "is_default": "balance >= 0",
            "species": _ref("concat('species-', o_custkey)", "species", "o_custkey"),
            "types": f"CASE WHEN first = other THEN array({first}) ELSE array({second}, {first}) END",
            "abilities": f"array({aura}, {trait})",
            "moves": f"transform(coalesce(parts, array()), p -> struct({move} AS move))",
            "sprites": (
                f"struct(CASE WHEN balance >= 0 THEN {_url('front', 'id')} END AS front_default, "
                f"CASE WHEN balance >= 5000 THEN {_url('back', 'id')} END AS back_default)"
            ),
            "stats": f"array({', '.join(stats)})",
        },
        place,
    )


def species(t: Tables, place: Place | None = None) -> DataFrame:
    rows = t.customer.selectExpr(
        "*",
        "c_custkey AS id",
        f"{_whole('c_acctbal')} AS amount",
        "lower(c_mktsegment) AS segment",
    )

    def text(words: str, language: str) -> str:
        return f"struct({words} AS flavor_text, {_named(f"'{language}'")} AS language)"

    french = text("'Le client'", "fr")
    english = text(r"concat('The\n', c_name, '\u000C  of ', segment, ' \n')", "en")
    later = text("'a later one'", "en")
    groups = f"array({_named('segment')}, {_named("concat('group-', c_nationkey)")})"
    return _payload(
        rows,
        "species",
        {
            "id": "id",
            "name": "c_name",
            "order": "c_custkey",
            "generation": _to("generation", "c_nationkey"),
            "evolution_chain": _to("evolution-chain", "c_custkey div 3"),
            "evolves_from_species": f"CASE WHEN c_custkey % 3 <> 0 THEN {_ref("'parent'", 'species', 'c_custkey - 1')} END",
            "is_legendary": "c_acctbal > 9000",
            "is_mythical": "c_acctbal < -900",
            "is_baby": "c_mktsegment = 'BUILDING'",
            "capture_rate": "c_nationkey * 10",
            "base_happiness": "CASE WHEN c_acctbal >= 0 THEN amount END",
            "gender_rate": "c_nationkey % 9",
            "hatch_counter": "CASE WHEN c_acctbal >= 1000 THEN c_nationkey END",
            "has_gender_differences": "c_nationkey % 2 = 0",
            "forms_switchable": "c_nationkey % 3 = 0",
            "growth_rate": _named("segment"),
            "color": _named("concat('color-', c_nationkey % 10)"),
            "shape": f"CASE WHEN c_acctbal >= 2000 THEN {_named("concat('shape-', c_nationkey % 4)")} END",
            "habitat": f"CASE WHEN c_acctbal >= 3000 THEN {_named("concat('habitat-', c_nationkey % 5)")} END",
            "egg_groups": f"CASE WHEN c_acctbal >= 0 THEN {groups} ELSE slice({groups}, 1, 0) END",
            "flavor_text_entries": f"CASE WHEN c_acctbal >= 0 THEN array({french}, {english}, {later}) ELSE array({french}) END",
        },
        place,
    )


def pair_counts(t: Tables) -> DataFrame:
    """(a, b, n): lineitems from suppliers of nation a to customers of nation b."""
    suppliers = t.supplier.selectExpr("s_suppkey AS l_suppkey", "s_nationkey AS a")
    customers = t.customer.selectExpr("c_custkey AS o_custkey", "c_nationkey AS b")
    buyers = t.orders.select("o_orderkey", "o_custkey").join(customers, "o_custkey")
    return (
        t.lineitem.selectExpr("l_orderkey AS o_orderkey", "l_suppkey")
        .join(suppliers, "l_suppkey")
        .join(buyers, "o_orderkey")
        .groupBy("a", "b")
        .agg(F.expr("count(*) AS n"))
    )


def types(t: Tables, place: Place | None = None) -> DataFrame:
    nations = t.nation.selectExpr("n_nationkey AS id", "n_name AS name")
    everyone = bounded_list(nations, ["id"], MAX_TYPES, "nation")
    share = "n * n_types * n_types * 100"
    size = (
        f"CASE WHEN n IS NULL OR {share} <= 70 * total THEN 'no' "
        f"WHEN {share} >= 115 * total THEN 'double' WHEN {share} <= 90 * total THEN 'half' END"
    )
    pairs = (
        nations.withColumn("other", F.explode(everyone))
        .selectExpr("id AS a", "name AS a_name", "other.id AS b", "other.name AS b_name")
        .join(pair_counts(t), ["a", "b"], "left")
        .withColumn("total", t.lineitem.agg(F.expr("count(*)")).scalar())
        .withColumn("n_types", n_types(t))
        .selectExpr("a", "a_name", "b", "b_name", f"{size} AS size")
        .where("size IS NOT NULL")
    )

    # each related pair goes into a list of either type
    def entry(owner: str, side: str, other: str) -> str:
        ref = f"struct({other} AS id, {other}_name AS name)"
        return f"struct({owner} AS n_nationkey, concat(size, '_damage_{side}') AS list, {ref} AS ref)"

    entries = pairs.selectExpr(f"inline(array({entry('a', 'to', 'b')}, {entry('b', 'from', 'a')}))")
    # The relations of a type.
    relations = [
        "double_damage_to", "double_damage_from", "half_damage_to", "half_damage_from", "no_damage_to", "no_damage_from",
    ]

    def refs(name: str) -> str:
        picked = f"sort_array(collect_list(CASE WHEN list = '{name}' THEN ref END))"
        return f"transform({picked}, e -> {_ref('e.name', 'type', 'e.id')}) AS {name}"

    lists = entries.groupBy("n_nationkey").agg(*[F.expr(refs(r)) for r in relations])
    rows = t.nation.join(lists, "n_nationkey", "left").withColumn("id", F.col("n_nationkey"))
    damage_class = _named("CASE WHEN n_regionkey = 1 THEN 'physical' ELSE 'special' END")
    filled = ", ".join(f"coalesce({r}, array()) AS {r}" for r in relations)
    return _payload(
        rows,
        "type",
        {
            "id": "id",
            "name": "n_name",
            "generation": _to("generation", "n_regionkey"),
            "move_damage_class": f"CASE WHEN n_regionkey <> 0 THEN {damage_class} END",
            "damage_relations": f"struct({filled})",
        },
        place,
    )


def moves(t: Tables, place: Place | None = None) -> DataFrame:
    damage_class = (
        "CASE WHEN p_type = 'SMALL' THEN 'status' "
        "WHEN p_type IN ('PROMO', 'LARGE') THEN 'special' ELSE 'physical' END"
    )
    return _payload(
        t.part.withColumn("id", F.col("p_partkey")).withColumn("n_types", n_types(t)),
        "move",
        {
            "id": "id",
            "name": "concat('part-', p_partkey)",
            "power": "CASE WHEN p_type <> 'SMALL' THEN p_size END",
            "accuracy": "CASE WHEN p_partkey % 11 <> 0 THEN 100 - p_partkey % 4 * 25 END",
            "pp": "CASE WHEN p_size >= 10 THEN p_size END",
            "priority": "p_size % 3",
            "effect_chance": "CASE WHEN p_size < 25 THEN p_size * 2 END",
            "type": _to("type", "p_partkey % n_types"),
            "damage_class": _named(damage_class),
            "target": _named("lower(p_brand)"),
            "generation": _to("generation", "p_size % 5"),
        },
        place,
    )


def payloads(t: Tables, place: Place | None = None) -> DataFrame:
    """(key, payload) of all four entities, with ``bucket`` if their rows are placed first."""
    return reduce(DataFrame.unionByName, (of(t, place) for of in (roots, species, types, moves)))


def all_types(t: Tables) -> DataFrame:
    """The fixed set of type keys."""
    return t.nation.selectExpr("concat('type:', n_nationkey) AS key")


def team_members(t: Tables) -> DataFrame:
    """(team_id, root_id), distinct: a team is a customer, its members the customer's orders."""
    return t.orders.select(F.col("o_custkey").alias("team_id"), F.col("o_orderkey").alias("root_id")).distinct()
