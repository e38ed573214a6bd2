"""Landing, raw, discovery and resume."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.functions.refs import key_entity, key_id, key_path, parse_key
from stratalake.operators import discovery
from stratalake.operators.layers import capture, load
from stratalake.sources.landing import (
    encode_payload,
    envelope,
    existing_keys,
    fixed_keys,
    landing_lines,
    landing_scan,
    raw_by_entity,
    root_scope,
    write_files,
    write_landing,
)
from stratalake.sources.shared import fresh_folder
from stratalake.sources.store import row_counts
from stratalake.streaming.ingest import ingest_new_files
from stratalake.workload import universe
from stratalake.workload.registry import query
from stratalake.workload.shared import Layers

_ALL_KEYS = """
    SELECT concat('root:', id) AS key FROM u_root UNION ALL
    SELECT concat('species:', c_custkey) FROM customer UNION ALL
    SELECT concat('type:', n_nationkey) FROM nation UNION ALL
    SELECT concat('move:', p_partkey) FROM part"""

_REFS = """
    SELECT concat('root:', id) AS key, concat('species:', species) AS ref FROM u_root UNION ALL
    SELECT concat('root:', l_orderkey), concat('move:', l_partkey) FROM lineitem"""

_FIXED = "SELECT concat('type:', n_nationkey) AS key FROM nation"

# captured before, as an earlier run that stopped half way would have left it: the special
# moves, the roots in debt, the types of the first generation
_EXISTING = """
    SELECT concat('move:', p_partkey) AS key FROM part WHERE p_type IN ('PROMO', 'LARGE') UNION ALL
    SELECT concat('root:', id) FROM u_root WHERE balance < 0 UNION ALL
    SELECT concat('type:', n_nationkey) FROM nation WHERE n_regionkey = 0"""


def _roots(layers: Layers) -> DataFrame:
    return raw_by_entity(layers.raw, "root")


def _fixed(layers: Layers) -> DataFrame:
    return universe.all_types(layers.tables)


def _existing(layers: Layers) -> DataFrame:
    moves = layers.staging("move").where(F.col("damage_class") == "special")
    roots = layers.staging("root").where(~F.col("is_default"))
    types = layers.staging("type").where(F.col("generation_id") == 0)

    def keys(entity: str, rows: DataFrame) -> DataFrame:
        return rows.select(F.concat_ws(":", F.lit(entity), F.col("id").cast("string")).alias("key"))

    return keys("move", moves).unionByName(keys("root", roots)).unionByName(keys("type", types))


def _bundles(layers: Layers) -> str:
    folder = fresh_folder(layers.spark, "landing")
    write_landing(layers.raw.select("key", "payload"), folder)
    return folder


@query(
    "landing_lines",
    f"""SELECT key, split_part(key, ':', 1) AS entity,
               CAST(split_part(key, ':', 2) AS BIGINT) AS id FROM ({_ALL_KEYS})""",
)
def q_landing_lines(layers: Layers) -> DataFrame:
    rows = landing_lines(layers.spark.read, _bundles(layers))
    return rows.selectExpr(
        "key",
        f"{key_entity()} AS entity",
        "CAST(get_json_object(payload, '$.id') AS BIGINT) AS id",
    )


@query(
    "landing_scan",
    "SELECT concat('type:', n_nationkey) AS key, CAST(n_nationkey AS BIGINT) AS id, n_name AS name FROM nation",
)
def q_landing_scan(layers: Layers) -> DataFrame:
    """A file per payload, for the entity that has few."""
    folder = fresh_folder(layers.spark, "files")
    write_files(raw_by_entity(layers.raw, "type"), folder)
    rows = landing_scan(layers.spark.read, folder)
    return rows.selectExpr(
        "key",
        "CAST(get_json_object(payload, '$.id') AS BIGINT) AS id",
        "get_json_object(payload, '$.name') AS name",
    )


@query(
    "stream_ingest",
    f"""SELECT key, split_part(key, ':', 1) AS entity_type,
               (SELECT count(*) FROM u_root) AS staged_roots FROM ({_ALL_KEYS})""",
)
def q_stream_ingest(layers: Layers) -> DataFrame:
    """Raw as a stream fills it, and staging loaded from there."""
    landing, warehouse = _bundles(layers), layers.fresh_warehouse()
    progress = fresh_folder(layers.spark, "progress")
    for _ in range(2):  # the second time finds nothing new
        ingest_new_files(landing_lines(layers.spark.readStream, landing), warehouse, progress)
    roots = load(warehouse)["root"]
    return warehouse.table("raw.records").select("key", "entity_type", F.lit(roots).cast("bigint").alias("staged_roots"))


@query("root_scope", "SELECT concat('root:', id) AS key FROM u_root ORDER BY id LIMIT 50")
def q_root_scope(layers: Layers) -> DataFrame:
    return root_scope(existing_keys(layers.raw), "root", 50)


@query("fixed_keys", "SELECT concat('type:', n_nationkey) AS key, n_name AS name FROM nation")
def q_fixed_keys(layers: Layers) -> DataFrame:
    keys = fixed_keys(layers.spark, "type", layers.tables.nation.count(), first=0)
    named = layers.staging("type").select(
        F.concat_ws(":", F.lit("type"), F.col("id").cast("string")).alias("key"), "name"
    )
    return keys.join(named, "key")


@query(
    "raw_envelope",
    f"SELECT key, split_part(key, ':', 1) AS entity_type, true AS has_time FROM ({_ALL_KEYS})",
)
def q_raw_envelope(layers: Layers) -> DataFrame:
    return layers.raw.select(
        "key", "entity_type", F.col("fetched_at").isNotNull().alias("has_time")
    )


@query(
    "payload_roundtrip",
    """SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier""",
)
def q_payload_roundtrip(layers: Layers) -> DataFrame:
    suppliers = layers.tables.supplier
    document = f"struct({', '.join(suppliers.columns)})"
    text = suppliers.selectExpr(f"{encode_payload(document)} AS payload")
    return text.select(F.from_json("payload", suppliers.schema).alias("d")).select("d.*")


@query(
    "raw_by_entity",
    """SELECT concat('move:', id) AS key, id, name, power FROM u_move""",
)
def q_raw_by_entity(layers: Layers) -> DataFrame:
    return raw_by_entity(layers.raw, "move").select(
        "key",
        F.get_json_object("payload", "$.id").cast("bigint").alias("id"),
        F.get_json_object("payload", "$.name").alias("name"),
        F.get_json_object("payload", "$.power").cast("bigint").alias("power"),
    )


@query("existing_keys", _ALL_KEYS)
def q_existing_keys(layers: Layers) -> DataFrame:
    return existing_keys(layers.raw)


@query(
    "upsert_latest",
    """SELECT event_id, user_id, event_type,
              CASE WHEN event_type = 'purchase' THEN value + 1 ELSE value END AS value
       FROM events""",
)
def q_upsert_latest(layers: Layers) -> DataFrame:
    """Events as raw records: all of them, then the purchases again, each key told twice in a batch."""
    events = layers.tables.events
    document = encode_payload("struct(event_id AS id, user_id, event_type, value)")

    def records(rows: DataFrame, seq: int) -> DataFrame:
        payloads = rows.selectExpr("concat('event:', event_id) AS key", f"{document} AS payload")
        return envelope(payloads, f"{seq} AS seq")

    warehouse = layers.fresh_warehouse()
    changed = events.where(F.col("event_type") == "purchase")
    warehouse.upsert("raw.records", records(events, 1), seq="seq")
    more = records(changed.withColumn("value", F.col("value") + 1), 3).unionByName(records(changed, 2))
    warehouse.upsert("raw.records", more, seq="seq")
    read = "from_json(payload, 'id bigint, user_id bigint, event_type string, value double') AS e"
    return warehouse.table("raw.records").selectExpr(read).selectExpr("e.id AS event_id", "e.user_id", "e.event_type", "e.value")


@query(
    "staging_upsert",
    """SELECT id, name, power, CASE WHEN power IS NULL THEN 0 ELSE priority END AS priority,
              (SELECT count(*) FROM part WHERE p_type = 'SMALL') AS rows_written
       FROM u_move""",
)
def q_staging_upsert(layers: Layers) -> DataFrame:
    moves = layers.staging("move")
    warehouse = layers.fresh_warehouse()
    warehouse.upsert("staging.move", moves)
    changed = moves.where(F.col("power").isNull()).withColumn("priority", F.lit(0).cast("bigint"))
    written = warehouse.upsert("staging.move", changed)
    return warehouse.table("staging.move").select(
        "id", "name", "power", "priority", F.lit(written).cast("bigint").alias("rows_written")
    )


@query(
    "empty_batch",
    """SELECT CAST(0 AS BIGINT) AS appended, CAST(0 AS BIGINT) AS upserted,
              (SELECT count(*) FROM part) AS rows_kept""",
)
def q_empty_batch(layers: Layers) -> DataFrame:
    moves = layers.staging("move")
    raw_moves = layers.raw.where(F.col("entity_type") == "move")
    warehouse = layers.fresh_warehouse()
    warehouse.overwrite("staging.move", moves)
    warehouse.overwrite("raw.records", raw_moves)
    known = existing_keys(warehouse.table("raw.records"))
    appended = warehouse.append("raw.records", raw_moves.join(known, "key", "left_anti"))
    upserted = warehouse.upsert(
        "staging.move", moves.join(warehouse.table("staging.move").select("id"), "id", "left_anti")
    )
    return warehouse.table("staging.move").agg(
        F.lit(appended).cast("bigint").alias("appended"),
        F.lit(upserted).cast("bigint").alias("upserted"),
        F.count(F.lit(1)).alias("rows_kept"),
    )


@query(
    "ensure_layers",
    """SELECT 'staging.move' AS table_name, count(*) AS n FROM part
       UNION ALL SELECT 'staging.type', count(*) FROM nation
       UNION ALL SELECT t, CAST(0 AS BIGINT) FROM (VALUES ('raw.records'), ('staging.root'),
         ('staging.species'), ('analytics.fact_root'), ('meta.run_events')) v(t)""",
)
def q_ensure_layers(layers: Layers) -> DataFrame:
    warehouse = layers.fresh_warehouse()
    warehouse.ensure()
    warehouse.upsert("staging.move", layers.staging("move"))
    warehouse.upsert("staging.type", layers.staging("type"))
    warehouse.ensure()  # leaves what is there alone
    return row_counts(
        warehouse,
        ["raw.records", "staging.root", "staging.species", "staging.type", "staging.move",
         "analytics.fact_root", "meta.run_events"],
    )


@query("extract_refs", f"SELECT key, ref, count(*) AS n FROM ({_REFS}) GROUP BY ALL")
def q_extract_refs(layers: Layers) -> DataFrame:
    return discovery.extract_refs(_roots(layers)).groupBy("key", "ref").agg(F.count(F.lit(1)).alias("n"))


@query("distinct_refs", f"SELECT DISTINCT ref AS key FROM ({_REFS})")
def q_distinct_refs(layers: Layers) -> DataFrame:
    return discovery.distinct_refs(discovery.extract_refs(_roots(layers)))


@query(
    "resume_filter",
    f"""SELECT key FROM (SELECT ref AS key FROM ({_REFS}) UNION {_FIXED})
        EXCEPT SELECT key FROM ({_EXISTING})""",
)
def q_resume_filter(layers: Layers) -> DataFrame:
    # the references of captured roots count too: expand first, filter then
    wanted = discovery.wanted_refs(discovery.extract_refs(_roots(layers)), _fixed(layers))
    return discovery.resume_filter(wanted, _existing(layers))


@query(
    "resume_filter_many",
    f"""SELECT key FROM (SELECT ref AS key FROM ({_REFS}) UNION {_FIXED})
        EXCEPT SELECT key FROM ({_EXISTING})""",
)
def q_resume_filter_many(layers: Layers) -> DataFrame:
    wanted = discovery.wanted_refs(discovery.extract_refs(_roots(layers)), _fixed(layers))
    return discovery.resume_filter_many(wanted, _existing(layers))


@query(
    "pending_keys",
    f"""SELECT key FROM (SELECT ref AS key FROM ({_REFS}) UNION {_FIXED})
        EXCEPT SELECT key FROM ({_EXISTING}) ORDER BY key""",
)
def q_pending_keys(layers: Layers) -> DataFrame:
    refs = discovery.extract_refs(_roots(layers))
    return discovery.pending_keys(refs, _fixed(layers), _existing(layers))


@query(
    "scope_counts",
    f"""SELECT (SELECT count(*) FROM u_root) AS in_scope,
               (SELECT count(*) FROM u_root WHERE concat('root:', id) NOT IN
                       (SELECT key FROM ({_EXISTING}))) AS to_ingest,
               (SELECT count(*) FROM (SELECT ref FROM ({_REFS}) UNION {_FIXED}
                       EXCEPT SELECT key FROM ({_EXISTING}))) AS references_pending""",
)
def q_scope_counts(layers: Layers) -> DataFrame:
    roots = _roots(layers)
    wanted = discovery.wanted_refs(discovery.extract_refs(roots), _fixed(layers))
    return discovery.scope_counts(roots, wanted, _existing(layers))


@query(
    "capture_universe",
    f"""SELECT concat('root:', id) AS key FROM u_root UNION SELECT ref FROM ({_REFS})
        UNION {_FIXED}""",
)
def q_capture_universe(layers: Layers) -> DataFrame:
    roots = _roots(layers)
    return discovery.capture_universe(roots, discovery.extract_refs(roots), _fixed(layers))


@query(
    "capture_landing",
    f"""SELECT key, split_part(key, ':', 1) AS entity_type,
               CAST(split_part(key, ':', 2) AS BIGINT) AS id
        FROM (SELECT concat('root:', id) AS key FROM u_root UNION SELECT ref FROM ({_REFS}) UNION {_FIXED})""",
)
def q_capture_landing(layers: Layers) -> DataFrame:
    """What a capture takes out of landed bundles: the closure of the roots, not all that has landed."""
    warehouse = layers.fresh_warehouse()
    source = landing_lines(layers.spark.read, _bundles(layers), by_entity=True)
    capture(warehouse, source, fixed=_fixed(layers))
    rows = warehouse.table("raw.records")
    return rows.selectExpr("key", "entity_type", "CAST(get_json_object(payload, '$.id') AS BIGINT) AS id")


@query(
    "closure_check",
    f"""WITH want AS (SELECT concat('root:', id) AS key FROM u_root UNION
                      SELECT ref FROM ({_REFS}) UNION {_FIXED}),
             have AS (SELECT key FROM ({_EXISTING}) UNION
                      SELECT concat('species:', c_custkey) FROM customer)
        SELECT coalesce(h.key, w.key) AS key,
               CASE WHEN h.key IS NULL THEN 'missing' ELSE 'extra' END AS state
        FROM have h FULL JOIN want w ON h.key = w.key
        WHERE h.key IS NULL OR w.key IS NULL""",
)
def q_closure_check(layers: Layers) -> DataFrame:
    roots = _roots(layers)
    want = discovery.capture_universe(roots, discovery.extract_refs(roots), _fixed(layers))
    species = raw_by_entity(layers.raw, "species").select("key")
    return discovery.closure_check(_existing(layers).unionByName(species), want)


@query(
    "url_to_key",
    r"""SELECT page_id, url, concat(regexp_extract(url, '/([\w-]+)/(\d+)/?$', 1), ':',
               regexp_extract(url, '/([\w-]+)/(\d+)/?$', 2)) AS key
        FROM pages WHERE regexp_matches(url, '/([\w-]+)/(\d+)/?$')""",
)
def q_url_to_key(layers: Layers) -> DataFrame:
    keyed = layers.tables.pages.select("page_id", "url", F.expr(parse_key("url")).alias("key"))
    return keyed.where(F.col("key").isNotNull())


@query(
    "url_to_key_rejects",
    r"SELECT page_id, url FROM pages WHERE NOT regexp_matches(url, '/([\w-]+)/(\d+)/?$')",
)
def q_url_to_key_rejects(layers: Layers) -> DataFrame:
    keyed = layers.tables.pages.select("page_id", "url", F.expr(parse_key("url")).alias("key"))
    return keyed.where(F.col("key").isNull()).drop("key")


@query(
    "key_split",
    f"""SELECT key, split_part(key, ':', 1) AS entity, split_part(key, ':', 2) AS id,
               concat('/', replace(key, ':', '/')) AS path FROM ({_ALL_KEYS})""",
)
def q_key_split(layers: Layers) -> DataFrame:
    return layers.raw.selectExpr(
        "key", f"{key_entity()} AS entity", f"{key_id()} AS id", f"{key_path()} AS path"
    )
