"""Scores, teams and the other readers of the star."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.operators import readers, scoring, teams
from stratalake.workload import universe
from stratalake.workload.registry import query
from stratalake.workload.shared import Layers

TOP_TEAMS = 10


def by_speed(speed: Column) -> Column:
    """Speed factor of these queries; a power of two keeps the arithmetic exact."""
    return 1 + speed / F.lit(1024.0)


def _base(layers: Layers, speed_factor: scoring.SpeedFactor = by_speed) -> DataFrame:
    return scoring.move_base(
        layers.star("bridge_root_move"),
        layers.star("dim_move"),
        layers.star("fact_root"),
        layers.star("bridge_root_type"),
        speed_factor,
    )


def _matrix(layers: Layers) -> DataFrame:
    return layers.star("bridge_type_effectiveness")


def _best(layers: Layers) -> DataFrame:
    return scoring.best_move(_base(layers), _matrix(layers))


def _n_types(layers: Layers) -> int:
    return layers.star("dim_type").count()


def _profile(layers: Layers) -> DataFrame:
    return scoring.member_profile(_base(layers), _matrix(layers), _n_types(layers))


def _members(layers: Layers) -> DataFrame:
    return universe.team_members(layers.tables)


def _objective(layers: Layers) -> DataFrame:
    return teams.team_objective(_members(layers), _profile(layers), _n_types(layers))


# --- scores ---------------------------------------------------------------------------


@query(
    "move_score",
    """SELECT root_id, defending_type_id, count(*) AS n, min(score) AS worst, max(score) AS best,
              sum(score) AS total
       FROM u_score GROUP BY ALL""",
)
def q_move_score(layers: Layers) -> DataFrame:
    return scoring.score_summary(_base(layers), _matrix(layers))


@query(
    "stab",
    """SELECT l.root_id, l.move_id, CASE WHEN t.type_id IS NULL THEN CAST(1 AS DOUBLE)
              ELSE CAST(1.5 AS DOUBLE) END AS stab
       FROM u_learn l JOIN u_move m ON m.id = l.move_id
       LEFT JOIN u_root_type t ON t.root_id = l.root_id AND t.type_id = m.type_id""",
)
def q_stab(layers: Layers) -> DataFrame:
    held = scoring.held_types(layers.star("bridge_root_type"))
    moves = layers.star("dim_move").select("move_id", "type_id")
    known = layers.star("bridge_root_move").join(moves, "move_id").join(held, "root_id", "left")
    return known.select(
        "root_id", "move_id", scoring.stab(F.col("type_ids"), F.col("type_id")).alias("stab")
    )


@query(
    "stat_pick",
    """SELECT l.root_id, m.damage_class, count(*) AS n,
              max(CASE m.damage_class WHEN 'physical' THEN f.attack WHEN 'special' THEN f.sp_atk END) AS stat
       FROM u_learn l JOIN u_move m ON m.id = l.move_id JOIN u_fact f ON f.root_id = l.root_id
       GROUP BY ALL""",
)
def q_stat_pick(layers: Layers) -> DataFrame:
    moves = layers.star("dim_move").select("move_id", "damage_class")
    known = layers.star("bridge_root_move").join(moves, "move_id").join(layers.star("fact_root"), "root_id")
    return known.groupBy("root_id", "damage_class").agg(
        F.count(F.lit(1)).alias("n"), F.max(scoring.stat_pick(F.col("damage_class"))).alias("stat")
    )


@query(
    "speed_factor",
    """SELECT b.root_id, b.move_id, b.base / (1 + f.speed / CAST(1024 AS DOUBLE)) AS plain,
              b.base AS with_speed
       FROM u_base b JOIN u_fact f ON f.root_id = b.root_id""",
)
def q_speed_factor(layers: Layers) -> DataFrame:
    plain = _base(layers, scoring.no_speed).withColumnRenamed("base", "plain")
    fast = _base(layers).select("root_id", "move_id", F.col("base").alias("with_speed"))
    return plain.join(fast, ["root_id", "move_id"]).select("root_id", "move_id", "plain", "with_speed")


@query(
    "best_move",
    """SELECT root_id, CAST(defending_type_id AS INTEGER) AS defending_type_id, score, move_id,
              CAST(type_id AS INTEGER) AS type_id FROM u_best""",
)
def q_best_move(layers: Layers) -> DataFrame:
    return _best(layers)


# --- teams ----------------------------------------------------------------------------


@query(
    "team_coverage",
    """SELECT team_id, coverage FROM u_team""",
)
def q_team_coverage(layers: Layers) -> DataFrame:
    return _objective(layers).select("team_id", "coverage")


@query("team_duplicates", "SELECT team_id, duplicates FROM u_team")
def q_team_duplicates(layers: Layers) -> DataFrame:
    return _objective(layers).select("team_id", "duplicates")


@query("team_firepower", "SELECT team_id, firepower FROM u_team")
def q_team_firepower(layers: Layers) -> DataFrame:
    return _objective(layers).select("team_id", "firepower")


_SIX = "(SELECT team_id FROM u_member GROUP BY team_id HAVING count(*) = 6)"


@query(
    "team_rank",
    f"""SELECT team_id, coverage, duplicates, firepower, CAST(rank AS INTEGER) AS rank FROM (
           SELECT *, row_number() OVER (ORDER BY coverage DESC, duplicates, firepower DESC, team_id) AS rank
           FROM u_team WHERE team_id IN {_SIX}) WHERE rank <= {TOP_TEAMS}""",
)
def q_team_rank(layers: Layers) -> DataFrame:
    # the size comes out of the same aggregate as the objective: one pass over the members
    of_six = _objective(layers).where(F.col("size") == teams.TEAM_SIZE)
    return teams.team_rank(of_six.drop("cover", "size"), TOP_TEAMS)


@query(
    "team_rank_by_status",
    """SELECT team_id, status, coverage, duplicates, firepower, CAST(rank AS INTEGER) AS rank FROM (
           SELECT t.*, c_mktsegment AS status, row_number() OVER (PARTITION BY c_mktsegment
               ORDER BY coverage DESC, duplicates, firepower DESC, team_id) AS rank
           FROM u_team t JOIN customer ON c_custkey = team_id) WHERE rank <= 3""",
)
def q_team_rank_by_status(layers: Layers) -> DataFrame:
    status = layers.tables.customer.select(
        F.col("c_custkey").alias("team_id"), F.col("c_mktsegment").alias("status")
    )
    objective = _objective(layers).drop("cover", "size").join(status, "team_id")
    return teams.team_rank(objective, 3, by=["status"])


@query(
    "candidate_pool",
    """SELECT f.* FROM u_fact f JOIN u_species s ON s.id = f.species_id
       WHERE NOT s.is_legendary AND f.generation_id IN (1, 2, 3, 5, 8, 13, 21)""",
)
def q_candidate_pool(layers: Layers) -> DataFrame:
    generations = [1, 2, 3, 5, 8, 13, 21]
    return teams.candidate_pool(
        layers.star("fact_root"), layers.star("dim_species"), generations, legendary=False
    )


# the customer of the dearest order
_ADVERSARY = "(SELECT o_custkey FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 1)"


def _strongest(layers: Layers) -> DataFrame:
    orders = layers.tables.orders.orderBy(F.desc("o_totalprice"), "o_orderkey")
    return orders.limit(1).select(F.col("o_custkey").alias("team_id"))


@query(
    "team_must_include",
    f"""WITH seeds AS (SELECT root_id FROM u_fact WHERE species_id = {_ADVERSARY}
                      ORDER BY base_stat_total DESC, root_id LIMIT 2)
        SELECT team_id FROM u_member m JOIN seeds s ON s.root_id = m.root_id
        GROUP BY team_id HAVING count(*) = (SELECT count(*) FROM seeds)""",
)
def q_team_must_include(layers: Layers) -> DataFrame:
    fact, strongest = layers.star("fact_root"), _strongest(layers)
    of_team = fact.join(strongest.withColumnRenamed("team_id", "species_id"), "species_id", "left_semi")
    return teams.must_include(_members(layers), readers.top_roots(of_team, 2))


@query(
    "team_counter",
    f"""SELECT team_id, min(score) AS coverage FROM u_cover
        WHERE defending_type_id IN (
            SELECT t.type_id FROM u_root_type t JOIN u_member m ON m.root_id = t.root_id
            WHERE m.team_id = {_ADVERSARY})
        GROUP BY team_id""",
)
def q_team_counter(layers: Layers) -> DataFrame:
    members = _members(layers)
    against = teams.types_of_team(
        members.join(_strongest(layers), "team_id", "left_semi"), layers.star("bridge_root_type")
    )
    types = layers.star("dim_type").select("type_id")
    return teams.counter_coverage(_objective(layers), types, against).select("team_id", "coverage")


@query(
    "team_size",
    f"SELECT team_id, root_id FROM u_member WHERE team_id IN {_SIX}",
)
def q_team_size(layers: Layers) -> DataFrame:
    return teams.team_size(_members(layers))


# --- other readers --------------------------------------------------------------------


@query(
    "catalogue",
    """SELECT f.root_id, f.name, s.name AS species, f.generation_id, s.is_legendary,
              s.evolution_chain_id,
              (SELECT string_agg(t.name, ',' ORDER BY slot) FROM u_root_type t WHERE t.root_id = f.root_id) AS types,
              f.base_stat_total, f.height, f.weight
       FROM u_fact f JOIN u_species s ON s.id = f.species_id""",
)
def q_catalogue(layers: Layers) -> DataFrame:
    return readers.catalogue(
        layers.star("fact_root"),
        layers.star("dim_species"),
        layers.star("bridge_root_type"),
        layers.star("dim_type"),
    )


@query(
    "defence_profile",
    """SELECT t.root_id, p.a AS attacking_type_id, product(p.multiplier) AS multiplier
       FROM u_root_type t JOIN u_pair p ON p.b = t.type_id GROUP BY ALL""",
)
def q_defence_profile(layers: Layers) -> DataFrame:
    return readers.defence_profile(layers.star("bridge_root_type"), _matrix(layers))


@query(
    "dashboard",
    """SELECT f.generation_id, t.name AS type, count(*) AS n, max(base_stat_total) AS max_total,
              min(base_stat_total) AS min_total, CAST(sum(base_stat_total) AS BIGINT) AS sum_total,
              max(height) AS max_height, max(weight) AS max_weight
       FROM u_fact f JOIN u_root_type t ON t.root_id = f.root_id GROUP BY ALL""",
)
def q_dashboard(layers: Layers) -> DataFrame:
    return readers.dashboard(
        layers.star("fact_root"), layers.star("bridge_root_type"), layers.star("dim_type")
    )


@query(
    "dashboard_top",
    """SELECT root_id, name, base_stat_total FROM u_fact
       ORDER BY base_stat_total DESC, root_id LIMIT 20""",
)
def q_dashboard_top(layers: Layers) -> DataFrame:
    return readers.top_roots(layers.star("fact_root"), 20)


@query(
    "family_rollup",
    """SELECT evolution_chain_id, count(*) AS n_species,
              count(*) FILTER (evolves_from_id IS NULL) AS n_base,
              count(*) FILTER (is_legendary) AS n_legendary,
              arg_min(name, id) AS first_name, arg_max(name, id) AS last_name
       FROM u_species GROUP BY ALL""",
)
def q_family_rollup(layers: Layers) -> DataFrame:
    return readers.family_rollup(layers.star("dim_species"))


@query(
    "parent_lookup",
    """SELECT s.id AS species_id, s.name, s.evolves_from_id AS evolves_from_species_id,
              p.name AS parent_name
       FROM u_species s LEFT JOIN u_species p ON p.id = s.evolves_from_id""",
)
def q_parent_lookup(layers: Layers) -> DataFrame:
    return readers.parent_lookup(layers.star("dim_species"))
