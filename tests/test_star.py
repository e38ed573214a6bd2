"""Star, scores and teams against plain Python."""

import itertools
import random

import pytest
from conftest import kind, move, payload_rows, root, species
from pyspark.sql import functions as F

from stratalake.operators import quality, readers, scoring, teams
from stratalake.plans import star
from stratalake.plans.entities import ENTITIES, project


def staged(spark, entity, payloads):
    return project(payload_rows(spark, **{entity: payloads}), ENTITIES[entity])


def types(spark, *payloads):
    return staged(spark, "type", list(payloads))


def pairs(matrix):
    return {(r[0], r[1]): r[2] for r in matrix.collect()}


def test_matrix_is_dense(spark):
    rows = types(
        spark,
        kind(1, "a", double_damage_to=["b"], half_damage_to=["a"], no_damage_to=["c"]),
        kind(2, "b"),
        kind(3, "c", double_damage_to=["a", "unknown"]),
    )
    matrix = pairs(star.effectiveness(rows))
    assert len(matrix) == 9
    assert {k: v for k, v in matrix.items() if v != 1.0} == {(1, 2): 2.0, (1, 1): 0.5, (1, 3): 0.0, (3, 1): 2.0}


def test_overlapping_relations_take_the_smallest(spark):
    rows = types(
        spark,
        kind(1, "a", double_damage_to=["a", "b"], half_damage_to=["a", "b"], no_damage_to=["b"]),
        kind(2, "b"),
    )
    matrix = pairs(star.effectiveness(rows))
    assert (matrix[1, 1], matrix[1, 2]) == (0.5, 0.0)


def test_too_many_types_fail_instead_of_being_cut(spark, monkeypatch):
    monkeypatch.setattr(star, "MAX_TYPES", 2)
    rows = types(spark, kind(1, "a"), kind(2, "b"), kind(3, "c"))
    with pytest.raises(Exception, match="type dimension: more than 2 rows"):
        star.effectiveness(rows).collect()


def test_bridges_resolve_and_report(spark):
    roots = staged(spark, "root", [root(1), root(2, types=[], moves=[])])
    dim = star.dim_type(types(spark, kind(12, "ore"), kind(4, "tide")))
    assert {tuple(r) for r in star.bridge_root_type(roots, dim).collect()} == {(1, 12, 1), (1, 4, 2)}
    moves = star.dim_move(staged(spark, "move", [move(301, name="anchor")]))
    assert [tuple(r) for r in star.bridge_root_move(roots, moves).collect()] == [(1, 301)]
    missing = star.unresolved(star.move_slugs(roots), moves).collect()
    assert [tuple(r) for r in missing] == [("winch", 1)]


def test_fact(spark):
    facts = star.fact_root(
        staged(spark, "root", [root()]), staged(spark, "species", [species()])
    ).collect()
    assert [(r["generation_id"], r["base_stat_total"], r["sp_atk"]) for r in facts] == [(1, 150, 40)]


# --- a small random star, scored by hand ------------------------------------------------

N_TYPES = 4


@pytest.fixture(scope="module")
def world(spark):
    rnd = random.Random(7)
    roots = {
        r: {
            "attack": rnd.choice([-3, 10, 20]),
            "sp_atk": rnd.choice([15, 20]),
            "speed": rnd.randrange(0, 2048, 256),
            "types": rnd.sample(range(N_TYPES), rnd.choice([1, 2])),
            "moves": rnd.sample(range(20), 6) if r else [],
        }
        for r in range(9)
    }
    moves = {
        m: {
            "type": rnd.randrange(N_TYPES),
            "power": rnd.choice([None, 20, 40]),
            "accuracy": rnd.choice([None, 100, 50]),
            "class": rnd.choice(["physical", "special"]),
        }
        for m in range(20)
    }
    matrix = {
        (a, d): rnd.choice([0.0, 0.5, 1.0, 2.0]) for a in range(N_TYPES) for d in range(N_TYPES)
    }
    frames = {
        "fact": spark.createDataFrame(
            [(r, v["attack"], v["sp_atk"], v["speed"]) for r, v in roots.items()],
            "root_id long, attack int, sp_atk int, speed int",
        ),
        "moves": spark.createDataFrame(
            [(m, v["type"], v["power"], v["accuracy"], v["class"]) for m, v in moves.items()],
            "move_id long, type_id int, power int, accuracy int, damage_class string",
        ),
        "learn": spark.createDataFrame(
            [(r, m) for r, v in roots.items() for m in v["moves"]], "root_id long, move_id long"
        ),
        "held": spark.createDataFrame(
            [(r, t, i + 1) for r, v in roots.items() for i, t in enumerate(v["types"])],
            "root_id long, type_id int, slot int",
        ),
        "matrix": spark.createDataFrame(
            [(a, d, x) for (a, d), x in matrix.items()],
            "attacking_type_id int, defending_type_id int, multiplier double",
        ),
    }

    def score(r, m, t):
        who, what = roots[r], moves[m]
        if what["power"] is None:
            return None
        hit = 1.0 if what["accuracy"] is None else (what["accuracy"] / 100) ** 2
        bonus = 1.5 if what["type"] in who["types"] else 1.0
        stat = who["attack"] if what["class"] == "physical" else who["sp_atk"]
        return what["power"] * hit * bonus * stat * (1 + who["speed"] / 1024) * matrix[what["type"], t] + 0.0

    best = {}
    for r, v in roots.items():
        for t in range(N_TYPES):
            answers = [(-score(r, m, t), m) for m in v["moves"] if score(r, m, t) is not None]
            if answers:
                s, m = min(answers)
                best[r, t] = (-s + 0.0, m, moves[m]["type"])
    return frames, score, best, roots, moves


def base(frames):
    return scoring.move_base(
        frames["learn"], frames["moves"], frames["fact"], frames["held"], lambda s: 1 + s / F.lit(1024.0)
    )


def test_summary_equals_the_scores(world):
    frames = world[0]
    single = scoring.move_score(base(frames), frames["matrix"]).groupBy("root_id", "defending_type_id")
    want = single.agg(F.count("score").alias("n"), F.min("score"), F.max("score"), F.sum("score")).collect()
    got = scoring.score_summary(base(frames), frames["matrix"]).collect()
    assert [pytest.approx(tuple(r)) for r in sorted(want)] == [tuple(r) for r in sorted(got)]


def test_scores(world):
    frames, score, _, roots, _ = world
    got = {(r[0], r[1], r[3]): r[4] for r in scoring.move_score(base(frames), frames["matrix"]).collect()}
    expected = {
        (r, m, t): score(r, m, t)
        for r, v in roots.items()
        for m in v["moves"]
        for t in range(N_TYPES)
        if score(r, m, t) is not None
    }
    assert got == expected


def test_best_move(world):
    frames, _, best, _, _ = world
    got = {(r[0], r[1]): (r[2], r[3], r[4]) for r in scoring.best_move(base(frames), frames["matrix"]).collect()}
    assert got == best


def objective_by_hand(best, team):
    cover = [max((best[r, t][0] for r in team if (r, t) in best), default=0.0) for t in range(N_TYPES)]
    tops = []
    for r in team:
        mine = [(-best[r, t][0], best[r, t][1], best[r, t][2]) for t in range(N_TYPES) if (r, t) in best]
        if mine:
            s, _, kind_of = min(mine)
            tops.append((-s, kind_of))
    return min(cover), len(tops) - len({k for _, k in tops}), sum(s for s, _ in tops)


def profile(world):
    frames = world[0]
    return scoring.member_profile(base(frames), frames["matrix"], N_TYPES)


def test_team_objective(spark, world):
    best = world[2]
    groups = {i: c for i, c in enumerate(itertools.combinations(range(9), 3))} | {900: (0,)}
    members = spark.createDataFrame([(i, r) for i, c in groups.items() for r in c], "team_id long, root_id long")
    rows = teams.team_objective(members, profile(world), N_TYPES).collect()
    got = {r["team_id"]: (r["coverage"], r["duplicates"], r["firepower"]) for r in rows}
    assert got == {i: objective_by_hand(best, c) for i, c in groups.items()}
    assert got[900] == (0.0, 0, 0.0)


def test_ranking(spark):
    rows = [(1, 5.0, 1, 9.0, "x"), (2, 5.0, 0, 1.0, "x"), (3, 6.0, 9, 0.0, "y"), (4, 5.0, 0, 2.0, "y")]
    frame = spark.createDataFrame(rows, "team_id int, coverage double, duplicates int, firepower double, g string")
    top = teams.team_rank(frame, 3).orderBy("rank").collect()
    assert [(r["team_id"], r["rank"]) for r in top] == [(3, 1), (4, 2), (2, 3)]
    grouped = teams.team_rank(frame, 1, by=["g"]).collect()
    assert {(r["g"], r["team_id"]) for r in grouped} == {("x", 2), ("y", 3)}


def test_team_filters(spark):
    members = spark.createDataFrame([(1, 7), (1, 8), (2, 7), (3, 7), (3, 8), (3, 9)], "team_id int, root_id long")
    seeds = spark.createDataFrame([(7,), (8,), (8,)], "root_id long")
    assert {r[0] for r in teams.must_include(members, seeds).collect()} == {1, 3}
    assert {r["team_id"] for r in teams.team_size(members, 2).collect()} == {1}


def test_counter_coverage(spark):
    rows = spark.createDataFrame([(1, 0.0, [3.0, 1.0, 2.0])], "team_id int, coverage double, cover array<double>")
    every = spark.createDataFrame([(0,), (1,), (2,)], "type_id int")
    some = spark.createDataFrame([(0,), (2,), (2,)], "type_id int")
    assert teams.counter_coverage(rows, every, some).first()["coverage"] == 2.0


def test_many_types_do_not_fit_one_word(spark):
    n = 70
    cover = [float(t) for t in range(n)]
    profiles = spark.createDataFrame(
        [(r, cover, t, t, 1.0) for r, t in ((1, 0), (2, 63), (3, 69), (4, 63))],
        "root_id long, cover array<double>, attack_type int, place long, firepower double",
    )
    members = spark.createDataFrame([(1, r) for r in (1, 2, 3, 4)], "team_id int, root_id long")
    assert teams.team_objective(members, profiles, n).first()["duplicates"] == 1


def test_defence_profile(world):
    frames = world[0]
    got = {(r[0], r[1]): r[2] for r in readers.defence_profile(frames["held"], frames["matrix"]).collect()}
    matrix = pairs(frames["matrix"])
    for r, v in world[3].items():
        for a in range(N_TYPES):
            product = 1.0
            for t in v["types"]:
                product *= matrix[a, t]
            assert got[r, a] == product


# --- data checks ------------------------------------------------------------------------


def test_checks_find_what_is_wrong(spark):
    rows = spark.createDataFrame([(1, 5), (1, None), (2, 9)], "id int, parent int")
    parents = spark.createDataFrame([(5,)], "pid int")
    assert [(r["key"], r["detail"]) for r in quality.unique(rows, "t", ["id"]).collect()] == [("1", "2")]
    orphans = quality.relationships(rows, "t", ["parent"], parents, ["pid"]).collect()
    assert [(r["key"], r["detail"]) for r in orphans] == [("9", "1")]
    values = quality.accepted_values(rows, "t", "parent", [5]).collect()
    assert {r["key"] for r in values} == {"9", "null"}
    assert quality.same_rows(rows, rows, "t").count() == 0
    assert quality.same_rows(rows, rows.union(rows), "t").count() == 3


def test_rows_that_only_look_alike_differ(spark):
    """Nulls and elements that change places, copies, and nothing else."""
    one = "a int, b int, c array<int>, d struct<x:int,y:int>, e double"
    rows = [(1, None, [1, None], (None, 1), 0.0), (2, 2, [], None, 1.5), (3, None, None, None, None)]
    same = spark.createDataFrame([*reversed(rows)], one)
    left = spark.createDataFrame(rows, one)
    assert quality.same_rows(left, same, "t").isEmpty()
    assert quality.same_rows(left.limit(0), same.limit(0), "t").isEmpty()
    for k, other in enumerate([(None, 1, [1, None], (None, 1), 0.0), (1, None, [None, 1], (None, 1), 0.0), (1, None, [1, None], (1, None), 0.0)]):
        found = quality.same_rows(left, spark.createDataFrame([other, *rows[1:]], one), "t").collect()
        assert sorted(r["detail"] for r in found) == ["left only", "right only"], k
    found = quality.same_rows(left, spark.createDataFrame([(2, 2, None, None, 1.5), rows[0], rows[2]], one), "t")
    assert [r["key"] for r in found.collect()] == ["2", "2"]
    assert sorted(tuple(r)[2:] for r in quality.same_rows(left.union(left), left, "t").collect()) == [(str(i), "left only") for i in (1, 2, 3)]


def test_equal_tables_move_digests_only(spark):
    rows = spark.range(200_000).selectExpr("id", "concat('row ', id) AS text")
    changed = rows.withColumn("text", F.when(F.col("id") == 77, "other").otherwise(F.col("text")))
    equal, differ = quality.same_rows(rows, rows.orderBy(F.desc("id")), "t"), quality.same_rows(rows, changed, "t")
    assert equal.collect() == []
    final = equal._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "EmptyRelation" in final and "Exchange" not in final and "Shuffle" not in final
    assert sorted(r["detail"] for r in differ.collect()) == ["left only", "right only"]
    assert quality.differing_ranges(rows, changed).count() in (1, 2)


def test_reciprocity(spark):
    good = types(spark, kind(1, "a", double_damage_to=["b"]), kind(2, "b", double_damage_from=["a"]))
    assert quality.reciprocity(good, "double").count() == 0
    bad = types(spark, kind(1, "a", double_damage_to=["b"]), kind(2, "b"))
    assert [(r["key"], r["detail"]) for r in quality.reciprocity(bad, "double").collect()] == [("a>b", "to only")]


def test_incomplete_matrix(spark):
    dim = spark.createDataFrame([(1,), (2,)], "type_id int")
    rows = [(1, 1, 1.0), (1, 2, 1.0), (2, 1, 1.0), (2, 1, 1.0)]
    matrix = spark.createDataFrame(rows, "attacking_type_id int, defending_type_id int, multiplier double")
    assert [r["key"] for r in quality.matrix_complete(matrix, dim).collect()] == ["2"]


def test_a_large_matrix_is_refused(spark):
    pairs = spark.range(600).selectExpr("cast(id as int) AS attacking_type_id", "cast(id as int) AS defending_type_id", "1D AS multiplier")
    with pytest.raises(Exception, match="more than 512 types"):
        scoring.effect_rows(pairs).collect()


def test_all_checks_of_the_star_in_one_pass(spark):
    """The one pass finds what the checks find table by table."""
    star = {
        "dim_type": spark.sql("SELECT * FROM VALUES (1, 'a'), (2, 'b'), (3, 'c'), (4, 'd') t(type_id, name)"),
        "dim_species": spark.sql("SELECT * FROM VALUES (1L, NULL), (2L, 1L), (3L, 9L) t(species_id, evolves_from_species_id)"),
        "dim_move": spark.sql("SELECT * FROM VALUES (1L, 1, 'status'), (2L, 7, 'odd'), (2L, 2, NULL) t(move_id, type_id, damage_class)"),
        "fact_root": spark.sql("SELECT * FROM VALUES (1L, 1L), (2L, 8L), (2L, 2L) t(root_id, species_id)"),
        "bridge_root_type": spark.sql("SELECT * FROM VALUES (1L, 1, 1), (1L, 5, 3), (6L, 1, 2) t(root_id, type_id, slot)"),
        "bridge_root_move": spark.sql("SELECT * FROM VALUES (1L, 1L), (1L, 1L), (7L, 3L) t(root_id, move_id)"),
        # type 1 is complete, 2 has a pair twice and one too few, 3 a pair twice, 4 none; 9 is no type
        "bridge_type_effectiveness": spark.sql(
            """SELECT * FROM VALUES (1, 1, 1D), (1, 2, -0D), (1, 3, 2D), (1, 4, 0.5D), (2, 1, 3D), (2, 1, 1D), (2, 2, 1D), (2, 3, 1D),
               (3, 1, 1D), (3, 1, 1D), (3, 2, 1D), (3, 3, 1D), (3, 4, 1D), (9, 1, 1D), (9, 1, 1D)
               t(attacking_type_id, defending_type_id, multiplier)"""
        ),
    }
    want = set()
    for name, key in quality.STAR_KEYS.items():
        want |= {(f"unique:{name}", *r) for r in quality.unique(star[name], name, key).collect()}
    for child, column, parent in quality.STAR_REFERENCES:
        rows = quality.relationships(star[child], child, [column], star[parent], quality.STAR_KEYS[parent])
        want |= {(f"relationships:{child}:{column}", *r) for r in rows.collect()}
    for name, column, values in quality.STAR_VALUES:
        want |= {(f"accepted_values:{name}:{column}", *r) for r in quality.accepted_values(star[name], name, column, values).collect()}
    pairs = "bridge_type_effectiveness"
    want |= {(f"matrix:{pairs}", *r) for r in quality.matrix_complete(star[pairs], star["dim_type"]).collect()}
    found = quality.star_violations({f"analytics.{n}": rows for n, rows in star.items()})
    got = found.collect()
    assert len(got) == len(set(got)) and {tuple(r) for r in got} == want
    assert {r[3] for r in want if r[1] == "matrix"} == {"2", "3", "4"}
    counts = dict(quality.star_summary(found).collect())
    assert list(counts) and set(counts) == set(quality.STAR_CHECKS)
    assert all(n == sum(r[0] == check for r in want) for check, n in counts.items())
