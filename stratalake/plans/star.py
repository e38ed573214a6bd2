"""The analytics star, derived from staging alone."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.functions.bounded import bounded_list

# The type dimension is square in the matrix and broadcast in scoring, so its size is checked.
MAX_TYPES = 512

STATS = ("hp", "attack", "defense", "sp_atk", "sp_def", "speed")


def dim_type(types: DataFrame) -> DataFrame:
    return types.select(F.col("id").cast("int").alias("type_id"), "name")


def dim_species(species: DataFrame) -> DataFrame:
    """Family of a species = its evolution chain."""
    return species.select(
        F.col("id").alias("species_id"),
        "name",
        "evolution_chain_id",
        F.col("evolves_from_id").alias("evolves_from_species_id"),
        "is_legendary",
        "is_mythical",
        F.col("generation_id").cast("int"),
    )


def dim_move(moves: DataFrame) -> DataFrame:
    return moves.select(
        F.col("id").alias("move_id"),
        "name",
        F.col("type_id").cast("int"),
        F.col("power").cast("int"),
        F.col("accuracy").cast("int"),
        "damage_class",
        F.col("pp").cast("int"),
    )


def row_total(columns: tuple[str, ...]) -> Column:
    """Sum of columns of one row."""
    total = F.col(columns[0])
    for c in columns[1:]:
        total = total + F.col(c)
    return total


def fact_root(roots: DataFrame, species: DataFrame) -> DataFrame:
    """One row per root; the generation comes from its species, and is null without one."""
    generations = species.select(F.col("id").alias("species_id"), "generation_id")
    joined = roots.join(generations, "species_id", "left")
    return joined.select(
        F.col("id").alias("root_id"),
        "species_id",
        "name",
        F.col("generation_id").cast("int"),
        *[
            F.col(c).cast("int").alias(alias)
            for c, alias in zip(
                ("hp", "attack", "defense", "special_attack", "special_defense", "speed"),
                STATS,
                strict=True,
            )
        ],
        F.col("height").cast("int"),
        F.col("weight").cast("int"),
    ).select(
        "root_id", "species_id", "name", "generation_id", *STATS,
        row_total(STATS).alias("base_stat_total"), "height", "weight",
    )


def type_slugs(roots: DataFrame) -> DataFrame:
    """(root_id, slot, slug): the types array unnested, slot = position from 1."""
    return roots.select(F.col("id").alias("root_id"), F.posexplode("types").alias("pos", "slug")).select(
        "root_id", (F.col("pos") + 1).cast("smallint").alias("slot"), "slug"
    )


def move_slugs(roots: DataFrame) -> DataFrame:
    """(root_id, slug), distinct: made so within each row, which needs no shuffle."""
    return roots.select(F.col("id").alias("root_id"), F.explode(F.array_distinct("moves")).alias("slug"))


def resolve(rows: DataFrame, dim: DataFrame, id_column: str) -> DataFrame:
    """Slug -> id; rows whose slug is unknown are left out (see :func:`unresolved`).

    A plain equi-join: Spark broadcasts the dimension when its measured size allows, and
    otherwise splits the partition of a slug that a large share of the rows has in common.
    """
    return rows.join(dim.select(F.col("name").alias("slug"), id_column), "slug")


def unresolved(rows: DataFrame, dim: DataFrame) -> DataFrame:
    """(slug, n) of slugs without an entry; counted before the join, so hot slugs are one row."""
    counted = rows.groupBy("slug").agg(F.count(F.lit(1)).alias("n"))
    return counted.join(dim.select(F.col("name").alias("slug")), "slug", "left_anti")


def orphans(roots: DataFrame, species: DataFrame, types: DataFrame, moves: DataFrame) -> DataFrame:
    """(relation, name, n): what roots refer to and staging lacks; counted before the joins."""
    of_species = roots.groupBy("species_id").agg(F.count(F.lit(1)).alias("n"))
    known = species.select(F.col("id").alias("species_id"))
    lacking = of_species.join(known, "species_id", "left_anti")
    found = lacking.select(F.lit("species").alias("relation"), F.col("species_id").cast("string").alias("name"), "n")
    for relation, slugs, dim in (("type", type_slugs(roots), types), ("move", move_slugs(roots), moves)):
        rows = unresolved(slugs, dim).select(F.lit(relation).alias("relation"), F.col("slug").alias("name"), "n")
        found = found.unionByName(rows)
    return found


def bridge_root_type(roots: DataFrame, types: DataFrame) -> DataFrame:
    return resolve(type_slugs(roots), types, "type_id").select("root_id", "type_id", "slot")


def bridge_root_move(roots: DataFrame, moves: DataFrame) -> DataFrame:
    return resolve(move_slugs(roots), moves, "move_id").select("root_id", "move_id")


def effectiveness(types: DataFrame) -> DataFrame:
    """Dense matrix: one multiplier per (attacking, defending) pair of types.

    Each attacking type holds its own relation lists, so its row is expanded over the
    (checked) list of all types and looked up in those lists: no join and no shuffle.
    A pair in several lists gets the smallest multiplier; one in none gets 1.0.
    """
    everyone = bounded_list(types.select("id", "name"), ["id"], MAX_TYPES, "type dimension")
    pairs = types.withColumn("defender", F.explode(everyone))
    slug = F.col("defender.name")
    multiplier = (
        F.when(F.array_contains("no_damage_to", slug), 0.0)
        .when(F.array_contains("half_damage_to", slug), 0.5)
        .when(F.array_contains("double_damage_to", slug), 2.0)
        .otherwise(1.0)
    )
    return pairs.select(
        F.col("id").cast("int").alias("attacking_type_id"),
        F.col("defender.id").cast("int").alias("defending_type_id"),
        multiplier.cast("double").alias("multiplier"),
    )


def star(roots: DataFrame, species: DataFrame, types: DataFrame, moves: DataFrame) -> dict[str, DataFrame]:
    """Every analytics table from the four staging tables."""
    dims = {"dim_type": dim_type(types), "dim_move": dim_move(moves)}
    return {
        "analytics.dim_type": dims["dim_type"],
        "analytics.dim_species": dim_species(species),
        "analytics.dim_move": dims["dim_move"],
        "analytics.fact_root": fact_root(roots, species),
        "analytics.bridge_root_type": bridge_root_type(roots, dims["dim_type"]),
        "analytics.bridge_root_move": bridge_root_move(roots, dims["dim_move"]),
        "analytics.bridge_type_effectiveness": effectiveness(types),
    }
