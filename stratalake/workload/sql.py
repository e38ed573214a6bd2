"""SQL views that derive the universe from the flat tables, without any JSON."""

import re

# view -> its SQL; a view may use the ones above it
VIEWS: dict[str, str] = {
    "u_types": """
        SELECT count(*) AS n FROM nation""",
    "u_learn": """
        SELECT l_orderkey AS root_id, l_partkey AS move_id, count(*) AS copies FROM lineitem GROUP BY ALL""",
    "u_item": """
        SELECT l_orderkey AS id, count(*) FILTER (l_returnflag = 'A') AS n_a,
               count(*) FILTER (l_returnflag = 'N') AS n_n,
               count(*) FILTER (l_returnflag = 'R') AS n_r,
               count(*) FILTER (l_linestatus = 'O') AS n_o,
               count(*) FILTER (l_linestatus = 'F') AS n_f
        FROM lineitem GROUP BY ALL""",
    "u_root": """
        SELECT o.id, o.species, concat('order-', o.id) AS name, o.nation, o.balance,
               CAST(o.nation + 1 AS BIGINT) AS height, o.weight,
               CAST(coalesce(u.n_a, 0) AS BIGINT) AS hp,
               CAST(coalesce(u.n_n, 0) + o.weight AS BIGINT) AS attack,
               CAST(coalesce(u.n_r, 0) AS BIGINT) AS defense,
               CAST(coalesce(u.n_o, 0) + o.weight AS BIGINT) AS special_attack,
               CAST(coalesce(u.n_f, 0) AS BIGINT) AS special_defense,
               o.weight % 1000 AS speed
        FROM (SELECT o_orderkey AS id, o_custkey AS species, o_orderkey % t.n AS nation,
                     o_totalprice - 50000 AS balance,
                     CAST(floor(abs(o_totalprice - 50000)) AS BIGINT) AS weight
              FROM orders CROSS JOIN u_types t) o
        LEFT JOIN u_item u ON u.id = o.id""",
    "u_root_type": """
        SELECT r.id AS root_id, n.n_nationkey AS type_id, n.n_name AS name, 1 AS slot
        FROM u_root r JOIN nation n ON n.n_nationkey = r.nation
        UNION ALL
        SELECT r.id, n.n_nationkey, n.n_name, 2
        FROM u_root r CROSS JOIN u_types t JOIN nation n ON n.n_nationkey = (r.id * 7) % t.n
        WHERE n.n_nationkey <> r.nation""",
    "u_species": r"""
        SELECT c_custkey AS id, c_name AS name, c_custkey AS "order",
               CAST(c_nationkey AS BIGINT) AS generation_id, c_custkey // 3 AS evolution_chain_id,
               CASE WHEN c_custkey % 3 <> 0 THEN c_custkey - 1 END AS evolves_from_id,
               c_acctbal > 9000 AS is_legendary, c_acctbal < -900 AS is_mythical,
               c_mktsegment = 'BUILDING' AS is_baby,
               CAST(c_nationkey * 10 AS BIGINT) AS capture_rate,
               CASE WHEN c_acctbal >= 0 THEN CAST(floor(c_acctbal) AS BIGINT) END AS base_happiness,
               CAST(c_nationkey % 9 AS BIGINT) AS gender_rate,
               CASE WHEN c_acctbal >= 1000 THEN CAST(c_nationkey AS BIGINT) END AS hatch_counter,
               c_nationkey % 2 = 0 AS has_gender_differences,
               c_nationkey % 3 = 0 AS forms_switchable,
               lower(c_mktsegment) AS growth_rate, concat('color-', c_nationkey % 10) AS color,
               CASE WHEN c_acctbal >= 2000 THEN concat('shape-', c_nationkey % 4) END AS shape,
               CASE WHEN c_acctbal >= 3000 THEN concat('habitat-', c_nationkey % 5) END AS habitat,
               CASE WHEN c_acctbal >= 0
                    THEN concat(lower(c_mktsegment), ',group-', c_nationkey) ELSE '' END AS egg_groups,
               CASE WHEN c_acctbal >= 0
                    THEN concat('The ', c_name, ' of ', lower(c_mktsegment)) END AS flavor_text
        FROM customer""",
    "u_move": """
        SELECT p_partkey AS id, concat('part-', p_partkey) AS name,
               CASE WHEN p_type <> 'SMALL' THEN CAST(p_size AS BIGINT) END AS power,
               CASE WHEN p_partkey % 11 <> 0 THEN 100 - p_partkey % 4 * 25 END AS accuracy,
               CASE WHEN p_size >= 10 THEN CAST(p_size AS BIGINT) END AS pp,
               CAST(p_size % 3 AS BIGINT) AS priority,
               CASE WHEN p_size < 25 THEN CAST(p_size * 2 AS BIGINT) END AS effect_chance,
               p_partkey % t.n AS type_id,
               CASE WHEN p_type = 'SMALL' THEN 'status'
                    WHEN p_type IN ('PROMO', 'LARGE') THEN 'special' ELSE 'physical' END AS damage_class,
               lower(p_brand) AS target, CAST(p_size % 5 AS BIGINT) AS generation_id
        FROM part CROSS JOIN u_types t""",
    "u_pair": """
        SELECT a.n_nationkey AS a, b.n_nationkey AS b, a.n_name AS a_name, b.n_name AS b_name,
               CASE WHEN c.n IS NULL OR c.n * k.n * k.n * 100 <= 70 * t.total THEN CAST(0 AS DOUBLE)
                    WHEN c.n * k.n * k.n * 100 >= 115 * t.total THEN CAST(2 AS DOUBLE)
                    WHEN c.n * k.n * k.n * 100 <= 90 * t.total THEN CAST(0.5 AS DOUBLE)
                    ELSE CAST(1 AS DOUBLE) END AS multiplier
        FROM nation a CROSS JOIN nation b
        CROSS JOIN (SELECT count(*) AS total FROM lineitem) t CROSS JOIN u_types k
        LEFT JOIN (
            SELECT s.s_nationkey AS a, k.c_nationkey AS b, count(*) AS n
            FROM lineitem l JOIN supplier s ON s.s_suppkey = l.l_suppkey
            JOIN orders o ON o.o_orderkey = l.l_orderkey
            JOIN customer k ON k.c_custkey = o.o_custkey
            GROUP BY ALL) c ON c.a = a.n_nationkey AND c.b = b.n_nationkey""",
    "u_fact": """
        SELECT r.id AS root_id, r.species AS species_id, r.name,
               CAST(s.generation_id AS INTEGER) AS generation_id,
               CAST(r.hp AS INTEGER) AS hp, CAST(r.attack AS INTEGER) AS attack,
               CAST(r.defense AS INTEGER) AS defense, CAST(r.special_attack AS INTEGER) AS sp_atk,
               CAST(r.special_defense AS INTEGER) AS sp_def, CAST(r.speed AS INTEGER) AS speed,
               CAST(r.hp + r.attack + r.defense + r.special_attack + r.special_defense + r.speed
                    AS INTEGER) AS base_stat_total,
               CAST(r.height AS INTEGER) AS height, CAST(r.weight AS INTEGER) AS weight
        FROM u_root r JOIN u_species s ON s.id = r.species""",
    "u_base": """
        SELECT l.root_id, l.move_id, CAST(m.type_id AS INTEGER) AS type_id,
               CAST(m.power AS DOUBLE)
               * CASE WHEN m.accuracy IS NULL THEN CAST(1 AS DOUBLE)
                      ELSE (m.accuracy / CAST(100 AS DOUBLE)) * (m.accuracy / CAST(100 AS DOUBLE)) END
               * CASE WHEN EXISTS (SELECT 1 FROM u_root_type t
                                   WHERE t.root_id = l.root_id AND t.type_id = m.type_id)
                      THEN CAST(1.5 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END
               * CASE WHEN m.damage_class = 'physical' THEN f.attack ELSE f.sp_atk END
               * (1 + f.speed / CAST(1024 AS DOUBLE)) AS base
        FROM u_learn l JOIN u_move m ON m.id = l.move_id JOIN u_fact f ON f.root_id = l.root_id
        WHERE m.power IS NOT NULL AND m.damage_class IN ('physical', 'special')""",
    "u_score": """
        SELECT b.root_id, b.move_id, b.type_id, p.b AS defending_type_id,
               b.base * p.multiplier AS score
        FROM u_base b JOIN u_pair p ON p.a = b.type_id""",
    "u_best": """
        SELECT root_id, defending_type_id, score, move_id, type_id FROM (
            SELECT *, row_number() OVER (PARTITION BY root_id, defending_type_id
                                         ORDER BY score DESC, move_id) AS rn
            FROM u_score) WHERE rn = 1""",
    "u_top": """
        SELECT root_id, score AS firepower, move_id, type_id FROM (
            SELECT *, row_number() OVER (PARTITION BY root_id ORDER BY score DESC, move_id) AS rn
            FROM u_best) WHERE rn = 1""",
    "u_member": """
        SELECT DISTINCT o_custkey AS team_id, o_orderkey AS root_id FROM orders""",
    "u_cover": """
        SELECT m.team_id, b.defending_type_id, max(b.score) AS score
        FROM u_member m JOIN u_best b ON b.root_id = m.root_id GROUP BY ALL""",
    "u_team": """
        SELECT m.team_id, coalesce(c.coverage, 0) AS coverage, m.duplicates, m.firepower
        FROM (SELECT k.team_id,
                     count(t.type_id) - count(DISTINCT t.type_id) AS duplicates,
                     coalesce(sum(t.firepower), 0) AS firepower
              FROM u_member k LEFT JOIN u_top t ON t.root_id = k.root_id GROUP BY ALL) m
        LEFT JOIN (SELECT team_id, min(score) AS coverage FROM u_cover GROUP BY ALL) c
          ON c.team_id = m.team_id""",
}


def with_views(sql: str) -> str:
    """The SQL with the views it uses, directly or through others, put before it."""
    needed: set[str] = set()

    def need(text: str) -> None:
        for name in set(re.findall(r"\bu_\w+", text)) - needed:
            needed.add(name)
            need(VIEWS[name])

    need(sql)
    if not needed:
        return sql.strip()
    # materialized: the engine evaluates a view used several times once
    parts = [f"{n} AS MATERIALIZED ({VIEWS[n].strip()})" for n in VIEWS if n in needed]
    body = sql.strip()
    if body.startswith("WITH "):
        parts.append(body.removeprefix("WITH "))
        return "WITH " + ",\n".join(parts)
    return "WITH " + ",\n".join(parts) + "\n" + body
