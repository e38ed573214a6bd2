"""One local session, small generated payloads, a fresh warehouse per test."""

import json
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from stratalake.sources.shared import fresh_folder, tune
from stratalake.sources.store import Warehouse

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    tune(session)
    yield session
    session.stop()


@pytest.fixture
def warehouse(spark):
    return Warehouse(spark, fresh_folder(spark, "warehouse"))


def ref(entity, number, name=None):
    return {"name": name or f"{entity}-{number}", "url": f"http://w/{entity}/{number}/"}


def root(number=1, **changes):
    """Slots with gaps and out of order, a move known three times, an ability twice."""
    names = ["speed", "hp", "special-defense", "defense", "special-attack", "attack"]
    known = [(302, "winch"), (301, "anchor"), (302, "winch"), (302, "winch")]
    payload = {
        "id": number,
        "name": f"root-{number}",
        "height": 0,
        "weight": 12_500,
        "base_experience": None,
        "order": -1,
        "is_default": True,
        "species": ref("species", 1),
        "types": [
            {"slot": 9, "type": ref("type", 2, "tide")},
            {"slot": 4, "type": ref("type", 1, "ore")},
        ],
        "abilities": [{"slot": n, "ability": ref("ability", n, "drift")} for n in (8, 3)],
        "moves": [{"move": ref("move", n, m), "level": 1} for n, m in known],
        "sprites": {"front_default": None, "back_default": "s3://pics/back 1.png"},
        "stats": [{"base_stat": 10 * i, "stat": {"name": s}} for i, s in enumerate(names)],
        "unread": {"deep": [1, 2, 3]},
    }
    return {**payload, **changes}


def species(number=1, **changes):
    payload = {
        "id": number,
        "name": f"species-{number}",
        "order": 1,
        "generation": ref("generation", 1),
        "evolution_chain": {"url": "http://w/evolution-chain/9/"},
        "evolves_from_species": None,
        "is_legendary": False,
        "is_mythical": False,
        "is_baby": False,
        "capture_rate": 0,
        "base_happiness": None,
        "gender_rate": 1,
        "hatch_counter": 20,
        "has_gender_differences": False,
        "forms_switchable": False,
        "growth_rate": ref("growth-rate", 4, "medium"),
        "color": ref("color", 5, "grey"),
        "shape": None,
        "habitat": ref("habitat", 3, "coast"),
        "egg_groups": [ref("egg-group", 11, "metal"), ref("egg-group", 4, "foam"), ref("egg-group", 11, "metal")],
        "flavor_text_entries": [
            {"flavor_text": "Une lampe", "language": {"name": "fr"}},
            {"flavor_text": " Lamps\n\n by the\f harbour \n wall", "language": {"name": "en"}},
            {"flavor_text": "later", "language": {"name": "en"}},
        ],
    }
    return {**payload, **changes}


def kind(number, name, **lists):
    sides = [f"{s}_damage_{d}" for s in ("double", "half", "no") for d in ("to", "from")]
    relations = {s: [ref("type", 0, n) for n in lists.get(s, [])] for s in sides}
    return {
        "id": number,
        "name": name,
        "generation": ref("generation", 1),
        "move_damage_class": ref("move-damage-class", 2, "physical"),
        "damage_relations": relations,
    }


def move(number=1, **changes):
    payload = {
        "id": number,
        "name": f"move-{number}",
        "power": 50,
        "accuracy": 40,
        "pp": 1,
        "priority": 0,
        "effect_chance": None,
        "type": ref("type", 1),
        "damage_class": ref("damage-class", 2, "physical"),
        "target": ref("target", 10, "selected"),
        "generation": ref("generation", 1),
    }
    return {**payload, **changes}


def payload_rows(spark, **entities):
    """(key, payload) of dicts by entity."""
    rows = [
        (f"{entity}:{p['id']}", json.dumps(p)) for entity, ps in entities.items() for p in ps
    ]
    return spark.createDataFrame(rows, "key string, payload string")
