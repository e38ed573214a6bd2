"""Building the layers, each from the stored layer before."""

import json
import uuid
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from contextlib import nullcontext
from dataclasses import replace
from functools import partial, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.operators import discovery
from stratalake.operators.discovery import absent, new_records, part_with, wanted_keys
from stratalake.operators.lineage import FAILED, RUNNING, SUCCESS
from stratalake.plans.entities import ENTITIES, accepted, all_accepted, checked_plain_first, rejected
from stratalake.plans.star import orphans, star
from stratalake.sources.landing import existing_keys
from stratalake.sources.shared import checkpointed, joining_by_part, tuned
from stratalake.sources.store import Staged, Warehouse

LAYERS = ("raw", "staging", "analytics")

_EVENT = (
    "run_id string, seq int, status string, scope_limit bigint, stages array<string>, "
    "raw_written bigint, staging_written bigint, error string"
)


def capture(
    warehouse: Warehouse,
    source: DataFrame,
    limit: int | None = None,
    fixed: DataFrame | None = None,
) -> int:
    """Add what the source has and raw lacks; records already captured stay as they are.

    A referenced or fixed key that the source doesn't have fails the capture; what it has written by
    then is never shown, and ``vacuum`` deletes it. The source is read twice: its roots for their references, whose
    outcome (the keys to capture) is stored, and then the payloads of those keys. If it has a column ``entity_type``
    made of file paths, the first read opens the files of roots only, the second those of entities with
    something to capture; if there is nothing, no file.
    """
    with tuned(warehouse.spark):
        existing = existing_keys(warehouse.table("raw.records"))
        pending = checkpointed(wanted_keys(warehouse.spark, source, existing, limit=limit, fixed=fixed))
        wanted = pending.count()
        if not wanted:
            return 0
        place = partial(warehouse.place_for_join, "raw.records") if wanted >= discovery.MANY_KEYS else None
        records = new_records(part_with(source, pending), pending, place)
        with joining_by_part(warehouse.spark) if place else nullcontext():
            staged = warehouse.stage_upsert("raw.records", records, seq="seq")
        if staged.rows < wanted:  # a row for each key that was found
            found = warehouse.unseen(staged) if staged.rows else pending.limit(0)
            lacking = absent(pending, found).orderBy("key").limit(10).collect()
            raise ValueError(f"the source lacks what is to be captured: {', '.join(r['key'] for r in lacking)}")
        warehouse.commit(staged)
        return staged.rows


def load(warehouse: Warehouse, on_error: str = "fail", only_changes: bool = False) -> dict[str, int]:
    """Raw -> staging, entity by entity; returns the rows written.

    Of payloads with the same id the one fetched last stays, then the one of the last key.
    ``fail``: an invalid payload fails the write of its entity, which then keeps its
    previous content. ``quarantine``: invalid payloads are in ``staging.rejects`` as long as
    they are invalid; payloads are parsed once, and rows and rejects change in one commit.

    ``only_changes`` parses what came to raw since the last load of the entity, and what was
    rejected; the commit that shows the rows says how far they go, so the result is that of a whole load.
    """
    if on_error not in ("fail", "quarantine"):
        raise ValueError(f"on_error: {on_error}")
    with tuned(warehouse.spark):
        upto = warehouse.number
        raw = warehouse.table("raw.records")
        old_rejects = warehouse.table("staging.rejects")
        staged, rejects, written = [], [], {}
        for entity, spec in ENTITIES.items():
            payloads = raw.where(F.col("entity_type") == entity)
            if only_changes:
                new = warehouse.changes("raw.records", warehouse.loaded(spec.table))
                new = new.where(F.col("entity_type") == entity)
                bad = old_rejects.where(F.col("entity_type") == entity).join(new.select("key"), "key", "left_anti")
                again = payloads.join(bad.select("key"), "key", "left_semi")
                payloads = new if bad.isEmpty() else new.unionByName(again)
            both = checked_plain_first(payloads.select("key", "payload", "fetched_at"), spec, "fetched_at")
            if on_error == "fail":
                rows = _by_id(all_accepted(both))
            else:
                both = checkpointed(both)
                rows = _by_id(accepted(both))
                rejects.append(rejected(both).withColumn("entity_type", F.lit(entity)))
            one = _loaded(warehouse.stage_upsert(spec.table, rows, seq="_seq", newer=only_changes), upto)
            written[entity] = one.rows
            if on_error == "fail":
                warehouse.commit(one)
            else:
                staged.append(one)
        if rejects:
            # what was rejected before has been parsed again
            bad = reduce(DataFrame.unionByName, rejects)
            warehouse.commit(*staged, warehouse.stage_overwrite("staging.rejects", bad))
        return written


def _loaded(staged: Staged, upto: int) -> Staged:
    return replace(staged, content=replace(staged.content, loaded=upto))


def _by_id(rows: DataFrame) -> DataFrame:
    return rows.withColumn("_seq", F.struct("fetched_at", "key")).drop("fetched_at", "key")


def build_star(warehouse: Warehouse) -> dict[str, int]:
    """Staging -> analytics, every table anew; all of them change in one commit.

    A root whose species isn't staged, or a slug without an entry, fails the build:
    :func:`stratalake.plans.star.orphans` lists them.
    """
    with tuned(warehouse.spark):
        staging = [warehouse.table(ENTITIES[e].table) for e in ("root", "species", "type", "move")]
        found = orphans(*staging).orderBy("relation", "name").limit(10).collect()
        if found:
            raise ValueError("not in staging: " + "; ".join(f"{r['relation']} {r['name']} ({r['n']})" for r in found))
        frames = star(*staging)
        with ThreadPoolExecutor(len(frames)) as pool:  # independent jobs: small ones fill the gaps
            staged = list(pool.map(warehouse.stage_overwrite, frames.keys(), frames.values()))
        warehouse.commit(*staged)
        return {s.table: s.rows for s in staged}


def rebuild(
    warehouse: Warehouse,
    layers: Iterable[str],
    source: DataFrame | None = None,
    limit: int | None = None,
    fixed: DataFrame | None = None,
    on_error: str = "fail",
) -> list[tuple[str, int]]:
    """Build the chosen layers in their fixed order; names that are no layer are ignored."""
    chosen = set(layers)
    done = []
    if "raw" in chosen:
        if source is None:
            raise ValueError("layer raw needs a source")
        done.append(("raw", capture(warehouse, source, limit, fixed)))
    if "staging" in chosen:
        done.append(("staging", sum(load(warehouse, on_error).values())))
    if "analytics" in chosen:
        done.append(("analytics", sum(build_star(warehouse).values())))
    return done


def run(
    warehouse: Warehouse,
    source: DataFrame | None = None,
    layers: tuple[str, ...] = ("raw", "staging"),
    limit: int | None = None,
    fixed: DataFrame | None = None,
    on_error: str = "fail",
) -> dict[str, int]:
    """As :func:`rebuild`, with a lineage row; a failure is recorded and raised again."""
    run_id = uuid.uuid4().hex
    _record(warehouse, run_id, 0, RUNNING, limit=limit, stages=list(layers))
    try:
        rows = dict(rebuild(warehouse, layers, source, limit, fixed, on_error))
    except Exception as error:
        _record(warehouse, run_id, 1, FAILED, error=f"{type(error).__name__}: {error}")
        raise
    written = {"raw": rows.get("raw", 0), "staging": rows.get("staging", 0)}
    _record(warehouse, run_id, 1, SUCCESS, raw=written["raw"], staging=written["staging"])
    return rows


def _record(
    warehouse: Warehouse,
    run_id: str,
    seq: int,
    status: str,
    limit: int | None = None,
    stages: list[str] | None = None,
    raw: int | None = None,
    staging: int | None = None,
    error: str | None = None,
) -> None:
    event = {
        "run_id": run_id, "seq": seq, "status": status, "scope_limit": limit, "stages": stages,
        "raw_written": raw, "staging_written": staging, "error": error,
    }
    row = warehouse.spark.sql(
        f"SELECT e.*, current_timestamp() AS at FROM (SELECT from_json(:event, '{_EVENT}') AS e)",
        args={"event": json.dumps(event)},
    )
    warehouse.append("meta.run_events", row)
