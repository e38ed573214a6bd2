"""Payload -> staging: values, nulls, and everything the gate must refuse."""

import json
from dataclasses import replace

import pytest
from conftest import kind, move, payload_rows, root, species
from pyspark.sql import functions as F

from stratalake.functions.nested import collapse_spaces, slot_order
from stratalake.functions.refs import parse_key, ref_id, url_to_key
from stratalake.plans.entities import ENTITIES, accepted, checked, checked_plain_first, project, rejected


def staged(spark, entity, payload):
    rows = project(payload_rows(spark, **{entity: [payload]}), ENTITIES[entity]).collect()
    assert len(rows) == 1
    return rows[0].asDict()


def problems(spark, entity, payload):
    text = payload if isinstance(payload, str) else json.dumps(payload)
    rows = spark.createDataFrame([(f"{entity}:1", text)], "key string, payload string")
    return checked(rows, ENTITIES[entity]).select("problems").first()[0]


def test_root_values(spark):
    row = staged(spark, "root", root())
    assert row["types"] == ["ore", "tide"]  # by slot, whatever the gaps
    assert row["abilities"] == ["drift", "drift"]  # repeats stay where order counts
    assert row["moves"] == ["anchor", "winch"]
    assert row["species_id"] == 1 and row["weight"] == 12_500 and row["order"] == -1
    stats = ("hp", "attack", "defense", "special_attack", "special_defense", "speed")
    assert [row[s] for s in stats] == [10, 50, 30, 40, 20, 0]
    assert row["base_experience"] is None and row["sprite_front_default"] is None
    assert row["sprite_back_default"] == "s3://pics/back 1.png"
    assert list(row) == ENTITIES["root"].schema.names


def test_root_without_lists(spark):
    row = staged(spark, "root", root(types=[], abilities=[], moves=[]))
    assert (row["types"], row["abilities"], row["moves"]) == ([], [], [])


def test_last_of_equal_stats_counts(spark):
    extra = [*root()["stats"], {"base_stat": 99, "stat": {"name": "hp"}}]
    assert staged(spark, "root", root(stats=extra))["hp"] == 99


def test_species_values(spark):
    row = staged(spark, "species", species())
    assert row["flavor_text"] == "Lamps by the harbour wall"
    assert (row["shape"], row["habitat"], row["evolves_from_id"]) == (None, "coast", None)
    assert (row["generation_id"], row["evolution_chain_id"]) == (1, 9)
    assert row["egg_groups"] == ["metal", "foam", "metal"]


def test_species_without_english_text(spark):
    assert staged(spark, "species", species(flavor_text_entries=[]))["flavor_text"] is None


def test_parent_is_read(spark):
    parent = {"name": "p", "url": "http://w/species/12"}
    assert staged(spark, "species", species(evolves_from_species=parent))["evolves_from_id"] == 12


def test_relation_lists(spark):
    lists = {"double_damage_to": ["tide", "ember", "tide"], "half_damage_from": ["ore"], "no_damage_from": ["ore"]}
    row = staged(spark, "type", kind(3, "ember", **lists))
    assert row["double_damage_to"] == ["tide", "ember", "tide"]
    assert row["half_damage_from"] == row["no_damage_from"] == ["ore"]
    assert row["no_damage_to"] == row["half_damage_to"] == row["double_damage_from"] == []


@pytest.mark.parametrize("given", [None, {"name": "special"}])
def test_class_of_a_type_is_optional(spark, given):
    row = staged(spark, "type", {**kind(3, "ember"), "move_damage_class": given})
    assert row["move_damage_class"] == (given or {}).get("name")


def test_null_power_stays_null(spark):
    row = staged(spark, "move", move(power=None))
    assert row["power"] is None and row["accuracy"] == 40


@pytest.mark.parametrize(
    ("entity", "payload", "expected"),
    [
        ("root", root(height="tall"), ["height: wrong type"]),
        ("root", root(height=7.5), ["height: wrong type"]),
        ("root", root(height=True), ["height: wrong type"]),
        ("root", root(is_default=1), ["is_default: wrong type"]),
        ("root", root(name=5), ["name: wrong type"]),
        ("root", root(name=None), ["name: null"]),
        ("root", {k: v for k, v in root().items() if k != "weight"}, ["weight: missing"]),
        ("root", {k: v for k, v in root().items() if k != "base_experience"}, ["base_experience: missing"]),
        ("root", root(moves=[{"move": {"name": 3}}]), ["moves: wrong type"]),
        ("root", root(moves=[{"move": {"name": None}}]), ["moves: wrong type"]),
        ("root", root(types=[{"type": {"name": "x"}}]), ["types: wrong type"]),
        ("root", root(stats=root()["stats"][1:]), ["speed: missing"]),
        ("root", root(species={"name": "s", "url": "http://w/species/x/"}), ["species_id: wrong type"]),
        ("move", move(name=None), ["name: null"]),
        ("move", move(power=None), []),
        ("species", species(shape={}), []),
        ("species", species(shape="round"), ["shape: wrong type"]),
        ("species", species(shape={"name": 3}), ["shape: wrong type"]),
        ("species", species(evolves_from_species={"url": "nothing"}), ["evolves_from_id: wrong type"]),
        ("species", species(flavor_text_entries=[{"flavor_text": 3, "language": {"name": "en"}}]), ["flavor_text: wrong type"]),
        ("species", species(flavor_text_entries=[{"flavor_text": 3, "language": {"name": "fr"}}]), []),
    ],
)
def test_gate(spark, entity, payload, expected):
    assert problems(spark, entity, payload) == expected


@pytest.mark.parametrize("text", ["nope", '{"id": 1', "[]"])
def test_text_that_is_no_object(spark, text):
    assert "payload: malformed" in problems(spark, "move", text)


def test_wrong_shape_is_refused(spark):
    assert problems(spark, "root", root(moves="none"))


def test_invalid_payload_fails_the_job(spark):
    rows = payload_rows(spark, move=[move(1), move(2, name=None)])
    with pytest.raises(Exception, match="invalid payload move:2: name: null"):
        project(rows, ENTITIES["move"]).collect()


def test_quarantine_splits(spark):
    rows = checked(payload_rows(spark, move=[move(1), move(2, name=None)]), ENTITIES["move"])
    assert [r["id"] for r in accepted(rows).collect()] == [1]
    assert [(r["key"], r["problems"]) for r in rejected(rows).collect()] == [("move:2", ["name: null"])]


def test_unknown_entity():
    with pytest.raises(KeyError):
        ENTITIES["berry"]


def test_payload_is_parsed_once(spark):
    plan = project(payload_rows(spark, root=[root()]), ENTITIES["root"])
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("from_json") == 1


def one(spark, expression, value):
    return spark.createDataFrame([(value,)], "v string").select(F.expr(expression)).first()[0]


@pytest.mark.parametrize(
    ("url", "key"),
    [
        ("s3a://b/v2/color_set/0", "color_set:0"),
        ("/x/0012345678901234567890/", "x:0012345678901234567890"),  # longer than a long, zeros kept
        ("/größe/٣٤/", "größe:٣٤"),  # letters and digits of any script
        ("/a/1/b/2", "b:2"),
        ("a//7/", None),
        ("/a/7//", None),
        ("/a/7?x=1", None),
        ("/a/-7", None),
        ("/a b/7", None),
        ("7/", None),
    ],
)
def test_keys(spark, url, key):
    assert one(spark, parse_key("v"), url) == key


def test_unparseable_url_fails(spark):
    with pytest.raises(Exception, match="unparseable resource url: http://w/move/"):
        one(spark, url_to_key("v"), "http://w/move/")


def test_ref_id(spark):
    assert one(spark, ref_id("v"), "http://w/x/6//") == 6
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one(spark, ref_id("v"), "http://w/x/six/")


@pytest.mark.parametrize("text", ["a  b\x1cc", " a  b\tc\n", "a\u0085b　c", "a b c"])
def test_spaces_as_in_python(spark, text):
    assert one(spark, collapse_spaces("v"), text) == " ".join(text.split()) == "a b c"


def test_equal_slots_keep_their_order(spark):
    sql = slot_order("items", "e.s", "e.n")
    rows = spark.sql(
        "SELECT array(struct(2 AS s, 'z' AS n), struct(1 AS s, 'y' AS n), struct(1 AS s, 'a' AS n)) AS items"
    )
    assert rows.select(F.expr(sql)).first()[0] == ["y", "a", "z"]


def test_sound_payloads_need_no_variant_leaves(spark):
    """the plain parse settles a sound payload; the second parse, here of nothing, isn't made."""
    for entity, doc in {"root": root(), "species": species(), "move": move(1)}.items():
        spec, own = ENTITIES[entity], payload_rows(spark, **{entity: [doc]}).select("key", "payload")
        blind = replace(spec, payload=spec.payload + ", nowhere {int}", fields=tuple(replace(f, problem="'not read'") for f in spec.fields))
        found = checked_plain_first(own, blind).collect()
        assert found == checked(own, spec).collect() and found[0]["problems"] == []


def test_plain_parse_judges_as_variant_leaves_do(spark):
    """Whatever a payload holds, both ways give the same columns and problems."""
    odd = [None, 5, -1, 5.0, 10**20, True, "", "5", "true", "NaN", "a\n5", "http://w/a/7/", [], {}, [None], [{}], {"name": "q"}, {"name": 5}]
    docs = {"root": root(), "species": species(), "move": move(1)}
    for entity, doc in docs.items():
        texts = [json.dumps(doc), json.dumps([doc]), json.dumps(doc)[:-1], json.dumps(doc) + "}", "null", "", None]
        texts += [json.dumps(doc).replace('"name"', name, 1) for name in ('"n\\u0061me"', '"name": 5, "name"', '"name": "a", "name"', "'name'")]
        texts += [json.dumps(doc).replace('"id"', '"id": "x", "id"'), json.dumps(doc).replace('"', "'")]
        for key, value in doc.items():
            inner = value if isinstance(value, list) else [value]
            for other in odd:
                texts.append(json.dumps(doc | {key: other}))
                if isinstance(value, list):
                    texts += [json.dumps(doc | {key: [*inner, other]}), json.dumps(doc | {key: [other, *inner]})]
                if inner and isinstance(inner[-1], dict):
                    for k in inner[-1]:
                        changed = inner[-1] | {k: other}
                        texts.append(json.dumps(doc | {key: [*inner[:-1], changed] if isinstance(value, list) else changed}))
            texts.append(json.dumps({k: v for k, v in doc.items() if k != key}))
        rows = spark.createDataFrame([(f"{entity}:{i}", t) for i, t in enumerate(texts)], "key string, payload string")
        ways = [way(rows, ENTITIES[entity]).drop("payload").collect() for way in (checked, checked_plain_first)]
        assert len(ways[0]) == len(texts) and ways[0] == ways[1]
