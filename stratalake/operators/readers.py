"""Other readers of the star."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.operators.scoring import bounded_matrix


def catalogue(
    fact: DataFrame, species: DataFrame, bridge_root_type: DataFrame, types: DataFrame
) -> DataFrame:
    """One row per root with its species and its types in slot order."""
    named = bridge_root_type.join(types.select("type_id", "name"), "type_id")
    # at most one entry per type of the dimension
    listed = named.groupBy("root_id").agg(
        F.sort_array(F.collect_list(F.struct("slot", "name"))).alias("slots")
    )
    kinds = species.select(
        "species_id", F.col("name").alias("species"), "is_legendary", "evolution_chain_id"
    )
    return (
        fact.join(kinds, "species_id", "left")
        .join(listed, "root_id", "left")
        .select(
            "root_id",
            "name",
            "species",
            "generation_id",
            "is_legendary",
            "evolution_chain_id",
            F.coalesce(F.array_join(F.transform("slots", lambda s: s["name"]), ","), F.lit("")).alias("types"),
            "base_stat_total",
            "height",
            "weight",
        )
    )


def defence_profile(bridge_root_type: DataFrame, matrix: DataFrame) -> DataFrame:
    """(root_id, attacking_type_id, multiplier): product over the root's own types.

    The matrix is bounded, which is checked, hence the broadcast, with a column per attacking type: a
    root is one row until its products are made, whatever the number of types.
    """
    own = bridge_root_type.select("root_id", F.col("type_id").alias("defending_type_id"))
    matrix = bounded_matrix(matrix)
    kind = matrix.schema["attacking_type_id"].dataType
    attackers = [F.lit(r[0]).cast(kind) for r in matrix.select("attacking_type_id").distinct().collect()]
    if not attackers:
        return own.join(matrix, "defending_type_id").select("root_id", "attacking_type_id", "multiplier")
    factor = [F.when(F.col("attacking_type_id").eqNullSafe(a), F.col("multiplier")) for a in attackers]
    factors = matrix.groupBy("defending_type_id").agg(*[F.product(f).alias(f"f{i}") for i, f in enumerate(factor)])
    products = own.join(F.broadcast(factors), "defending_type_id").groupBy("root_id").agg(
        *[F.product(f"f{i}").alias(f"f{i}") for i in range(len(attackers))]
    )
    pairs = [F.struct(a.alias("attacking_type_id"), F.col(f"f{i}").alias("multiplier")) for i, a in enumerate(attackers)]
    return products.select("root_id", F.inline(F.array(*pairs))).where("multiplier IS NOT NULL")


def dashboard(
    fact: DataFrame, bridge_root_type: DataFrame, types: DataFrame
) -> DataFrame:
    """Measures per generation and type."""
    typed = bridge_root_type.join(types.select("type_id", F.col("name").alias("type")), "type_id")
    return (
        fact.join(typed, "root_id")
        .groupBy("generation_id", "type")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.max("base_stat_total").alias("max_total"),
            F.min("base_stat_total").alias("min_total"),
            F.sum(F.col("base_stat_total").cast("bigint")).alias("sum_total"),
            F.max("height").alias("max_height"),
            F.max("weight").alias("max_weight"),
        )
    )


def top_roots(fact: DataFrame, n: int) -> DataFrame:
    """The n roots with the highest stat total."""
    return (
        fact.orderBy(F.desc("base_stat_total"), "root_id")
        .limit(n)
        .select("root_id", "name", "base_stat_total")
    )


def family_rollup(species: DataFrame) -> DataFrame:
    """One row per evolution family. Measures only: a family may be of any size."""
    order = F.struct("species_id", "name")
    return (
        species.groupBy("evolution_chain_id")
        .agg(
            F.count(F.lit(1)).alias("n_species"),
            F.count_if(F.col("evolves_from_species_id").isNull()).alias("n_base"),
            F.count_if("is_legendary").alias("n_legendary"),
            F.min(order).alias("first"),
            F.max(order).alias("last"),
        )
        .select(
            "evolution_chain_id",
            "n_species",
            "n_base",
            "n_legendary",
            F.col("first.name").alias("first_name"),
            F.col("last.name").alias("last_name"),
        )
    )


def parent_lookup(species: DataFrame) -> DataFrame:
    """Each species with the name of the one it evolves from, if any."""
    parents = species.select(
        F.col("species_id").alias("evolves_from_species_id"), F.col("name").alias("parent_name")
    )
    return species.join(parents, "evolves_from_species_id", "left").select(
        "species_id", "name", "evolves_from_species_id", "parent_name"
    )
