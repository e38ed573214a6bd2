"""The declared tables of the four layers. Nothing is inferred from data."""

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class TableSpec:
    """Columns in stored order as DDL, primary key and partition columns of one table.

    A bucketed table takes upserts by key; a log only takes further rows; any other is written anew.
    """

    columns: str
    key: list[str]
    partition_by: tuple[str, ...] = ()
    bucketed: bool = False
    log: bool = False

    @cached_property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.columns)


# Table and column names. Ids that grow with the data are BIGINT throughout;
# measures, type ids and generations of the star are INTEGER.
TABLES: dict[str, TableSpec] = {
    "raw.records": TableSpec(
        "key STRING NOT NULL, entity_type STRING NOT NULL, payload STRING NOT NULL, "
        "fetched_at TIMESTAMP NOT NULL",
        ["key"],
        ("entity_type",),
        bucketed=True,
    ),
    "staging.root": TableSpec(
        "id BIGINT NOT NULL, name STRING NOT NULL, height BIGINT NOT NULL, "
        "weight BIGINT NOT NULL, base_experience BIGINT, `order` BIGINT NOT NULL, "
        "is_default BOOLEAN NOT NULL, species_id BIGINT NOT NULL, "
        "types ARRAY<STRING> NOT NULL, abilities ARRAY<STRING> NOT NULL, "
        "moves ARRAY<STRING> NOT NULL, sprite_front_default STRING, "
        "sprite_back_default STRING, hp BIGINT NOT NULL, attack BIGINT NOT NULL, "
        "defense BIGINT NOT NULL, special_attack BIGINT NOT NULL, "
        "special_defense BIGINT NOT NULL, speed BIGINT NOT NULL",
        ["id"],
        bucketed=True,
    ),
    "staging.species": TableSpec(
        "id BIGINT NOT NULL, name STRING NOT NULL, `order` BIGINT NOT NULL, "
        "generation_id BIGINT NOT NULL, evolution_chain_id BIGINT NOT NULL, "
        "evolves_from_id BIGINT, is_legendary BOOLEAN NOT NULL, "
        "is_mythical BOOLEAN NOT NULL, is_baby BOOLEAN NOT NULL, "
        "capture_rate BIGINT NOT NULL, base_happiness BIGINT, "
        "gender_rate BIGINT NOT NULL, hatch_counter BIGINT, "
        "has_gender_differences BOOLEAN NOT NULL, forms_switchable BOOLEAN NOT NULL, "
        "growth_rate STRING NOT NULL, color STRING NOT NULL, shape STRING, "
        "habitat STRING, egg_groups ARRAY<STRING> NOT NULL, flavor_text STRING",
        ["id"],
        bucketed=True,
    ),
    "staging.type": TableSpec(
        "id BIGINT NOT NULL, name STRING NOT NULL, generation_id BIGINT NOT NULL, "
        "move_damage_class STRING, double_damage_to ARRAY<STRING> NOT NULL, "
        "double_damage_from ARRAY<STRING> NOT NULL, "
        "half_damage_to ARRAY<STRING> NOT NULL, half_damage_from ARRAY<STRING> NOT NULL, "
        "no_damage_to ARRAY<STRING> NOT NULL, no_damage_from ARRAY<STRING> NOT NULL",
        ["id"],
        bucketed=True,
    ),
    "staging.move": TableSpec(
        "id BIGINT NOT NULL, name STRING NOT NULL, power BIGINT, accuracy BIGINT, "
        "pp BIGINT, priority BIGINT NOT NULL, effect_chance BIGINT, "
        "type_id BIGINT NOT NULL, damage_class STRING NOT NULL, target STRING NOT NULL, "
        "generation_id BIGINT NOT NULL",
        ["id"],
        bucketed=True,
    ),
    "staging.rejects": TableSpec(
        "key STRING NOT NULL, entity_type STRING NOT NULL, payload STRING NOT NULL, "
        "problems ARRAY<STRING> NOT NULL",
        ["key"],
    ),
    "analytics.dim_type": TableSpec("type_id INT NOT NULL, name STRING NOT NULL", ["type_id"]),
    "analytics.dim_species": TableSpec(
        "species_id BIGINT NOT NULL, name STRING NOT NULL, "
        "evolution_chain_id BIGINT NOT NULL, evolves_from_species_id BIGINT, "
        "is_legendary BOOLEAN NOT NULL, is_mythical BOOLEAN NOT NULL, "
        "generation_id INT NOT NULL",
        ["species_id"],
    ),
    "analytics.dim_move": TableSpec(
        "move_id BIGINT NOT NULL, name STRING NOT NULL, type_id INT NOT NULL, power INT, "
        "accuracy INT, damage_class STRING NOT NULL, pp INT",
        ["move_id"],
    ),
    "analytics.fact_root": TableSpec(
        "root_id BIGINT NOT NULL, species_id BIGINT NOT NULL, name STRING NOT NULL, "
        "generation_id INT NOT NULL, hp INT NOT NULL, attack INT NOT NULL, "
        "defense INT NOT NULL, sp_atk INT NOT NULL, sp_def INT NOT NULL, "
        "speed INT NOT NULL, base_stat_total INT NOT NULL, height INT NOT NULL, "
        "weight INT NOT NULL",
        ["root_id"],
    ),
    "analytics.bridge_root_type": TableSpec(
        "root_id BIGINT NOT NULL, type_id INT NOT NULL, slot SMALLINT NOT NULL", ["root_id", "type_id"]
    ),
    "analytics.bridge_root_move": TableSpec(
        "root_id BIGINT NOT NULL, move_id BIGINT NOT NULL", ["root_id", "move_id"]
    ),
    "analytics.bridge_type_effectiveness": TableSpec(
        "attacking_type_id INT NOT NULL, defending_type_id INT NOT NULL, "
        "multiplier DOUBLE NOT NULL",
        ["attacking_type_id", "defending_type_id"],
    ),
    "meta.run_events": TableSpec(
        "run_id STRING NOT NULL, seq INT NOT NULL, `at` TIMESTAMP NOT NULL, "
        "status STRING NOT NULL, scope_limit BIGINT, stages ARRAY<STRING>, "
        "raw_written BIGINT, staging_written BIGINT, error STRING",
        ["run_id", "seq"],
        log=True,
    ),
}


def conform(rows: DataFrame, schema: T.StructType, *more: Column) -> DataFrame:
    """The declared columns in declared order and type, then ``more``; quoted, since ``order`` is one of them.

    A null in a column declared NOT NULL fails the job.
    """

    def value(f: T.StructField) -> Column:
        column = F.col(f"`{f.name}`").cast(f.dataType.simpleString())
        if not f.nullable:
            column = F.coalesce(column, F.raise_error(F.lit(f"null in {f.name}")).cast(f.dataType.simpleString()))
        return column.alias(f.name)

    return rows.select([value(f) for f in schema] + list(more))
