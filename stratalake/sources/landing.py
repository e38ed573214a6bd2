"""Payload files on shared storage, and the envelope they are captured in."""

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamReader

from stratalake.functions.refs import key_entity, key_id

# <entity>/<id>.json, and the folder of a bundle; either plain or as Spark's partition folders
FILE_OF_ONE = r"/(?:entity_type=)?([\w-]+)/(?:(\d+)\.json|id=(\d+)/[^/]+)$"
FILE_OF_MANY = r"/(?:entity_type=)?([\w-]+)/[^/]+$"

_PATH = "_metadata.file_path"
# later files win; a bundle's lines are told apart by their payload
ARRIVAL = "struct<file_modification_time:timestamp,file_path:string>"
_ARRIVAL = "struct(_metadata.file_modification_time, _metadata.file_path) AS seq"


def _or_bad_path(found: str, key: str) -> str:
    bad_path = f"raise_error(concat('no entity in path: ', {_PATH}))"
    return f"CASE WHEN {found} <> '' THEN {key} ELSE {bad_path} END"


def landing_scan(reader: DataFrameReader | DataStreamReader, path: str, by_entity: bool = False) -> DataFrame:
    """(key, payload, seq) of a tree with one payload per file; the key comes from the path.

    ``reader`` is ``spark.read``, or ``spark.readStream`` for the files not yet seen. ``seq``
    orders payloads by the time of their file. ``by_entity`` adds ``entity_type``, made of the path
    alone: a filter on it keeps files of other entities from being opened.
    """
    entity, plain, number = (f"regexp_extract({_PATH}, r'{FILE_OF_ONE}', {i})" for i in (1, 2, 3))
    files = reader.text(path, wholetext=True, recursiveFileLookup=True)
    key = _or_bad_path(entity, f"concat({entity}, ':', {plain}, {number})")
    return files.selectExpr(f"{key} AS key", "value AS payload", _ARRIVAL, *([f"{entity} AS entity_type"] if by_entity else []))


def landing_lines(reader: DataFrameReader | DataStreamReader, path: str, by_entity: bool = False) -> DataFrame:
    """(key, payload, seq) of a tree of bundles, one payload per line; ``by_entity`` as above.

    The layout for many payloads, where a file each would be more files than a store can
    list. The entity comes from the folder, the id from the payload; a line without one fails.
    """
    # of the path only what the pattern can match: it is searched for every line
    entity = f"regexp_extract(concat('/', substring_index({_PATH}, '/', -2)), r'{FILE_OF_MANY}', 1)"
    lines = reader.text(path, recursiveFileLookup=True)
    number = "get_json_object(value, '$.id')"
    no_id = f"raise_error(concat('payload without id in: ', {_PATH}, ': ', left(value, 200)))"
    key = _or_bad_path(entity, f"concat({entity}, ':', coalesce({number}, {no_id}))")
    # explode of one element: a join by the key, or by its hash, would copy the search for the id into a filter, once a column
    return lines.selectExpr(f"explode(array({key})) AS key", "value AS payload", _ARRIVAL, *([f"{entity} AS entity_type"] if by_entity else []))


def write_landing(payloads: DataFrame, path: str) -> None:
    """Lay payloads out in bundles, one folder per entity; compressed, a bundle is what one task writes."""
    rows = payloads.selectExpr("payload AS value", f"{key_entity()} AS entity_type")
    rows.write.partitionBy("entity_type").text(path, compression="gzip")


def write_files(payloads: DataFrame, path: str) -> None:
    """Lay payloads out one per file, for what reads a file as one payload."""
    rows = payloads.selectExpr("payload AS value", f"{key_entity()} AS entity_type", f"{key_id()} AS id")
    rows.write.partitionBy("entity_type", "id").text(path)


def encode_payload(document: str) -> str:
    """Document -> JSON text; null fields are kept, since a missing key means an error later."""
    return f"to_json({document}, map('ignoreNullFields', 'false'))"


def envelope(payloads: DataFrame, *more: str) -> DataFrame:
    """(key, payload) -> raw record, with further columns ``more``."""
    return payloads.selectExpr(
        "key", f"{key_entity()} AS entity_type", "payload", "current_timestamp() AS fetched_at", *more
    )


def raw_by_entity(raw: DataFrame, entity: str) -> DataFrame:
    """Payloads of one entity: a partition filter on the raw table."""
    return raw.where(F.col("entity_type") == entity).select("key", "payload")


def existing_keys(raw: DataFrame) -> DataFrame:
    """Keys already captured; reads one column."""
    return raw.select("key")


def root_scope(payload_keys: DataFrame, entity: str, limit: int | None = None) -> DataFrame:
    """Keys of the root entities in scope: the first ``limit`` by id, or all of them."""
    roots = payload_keys.where(f"{key_entity()} = '{entity}'").select("key")
    if limit is None:
        return roots
    return roots.orderBy(F.expr(f"CAST({key_id()} AS BIGINT)")).limit(limit)


def fixed_keys(spark: SparkSession, entity: str, n: int, first: int = 1) -> DataFrame:
    """Keys of an entity whose ids are the fixed range first .. first + n - 1."""
    return spark.range(first, first + n).selectExpr(f"concat('{entity}:', id) AS key")
