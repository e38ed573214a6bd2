"""Stored layers: Parquet written by Spark, and one pointer that names what is current.

Every write goes to a new folder. Rows of a keyed table lie in hash buckets of their key, so
that an upsert rewrites only the buckets in which it changes something. The pointer is one small
file with the whole state; the next one is put in place only if its number is still free.
So a failed or lost job leaves every table as it was, a plan may read the table it replaces, several
tables change at once, and of two writers that started from the same state one fails.
"""

import json
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.operators.upsert import latest_wide, repeated_keys
from stratalake.plans.tables import TABLES, conform
from stratalake.sources.shared import create_once, delete_path, names_in, path_exists, read_file

#: Columns of keyed tables beside the declared ones: what orders the versions of a key, and the
#: number of the write that brought the row.
SEQ, WRITE = "_seq", "_write"

#: Payloads and names are much the same from row to row.
_CODEC = "zstd"


@dataclass(frozen=True)
class Content:
    """What a table consists of: folder -> its current buckets, or None for all that it has."""

    folders: dict[str, list[int] | None] = field(default_factory=dict)
    buckets: int = 0
    seq: str | None = None  # type of SEQ
    loaded: int = 0  # the last write of its source that it has taken in

    def only(self, buckets: list[int], held: dict[str, list[int]], rest: bool = False) -> dict[str, list[int] | None]:
        """The folders in some buckets, or in the rest of them; ``held`` has the buckets of each folder."""
        wanted = set(buckets)
        found = {}
        for folder, current in self.folders.items():
            now = held[folder] if current is None else current
            left = [b for b in now if (b in wanted) != rest]
            if left:
                found[folder] = current if len(left) == len(now) else left
        return found


@dataclass(frozen=True)
class Staged:
    """Written content that no reader sees yet."""

    table: str
    content: Content
    rows: int


class Warehouse:
    """The tables of ``plans.tables`` under one folder.

    ``buckets`` is how many a keyed table gets when it is first written, or written anew:
    by default as many as the session has shuffle partitions.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None) -> None:
        self.spark = spark
        self.path = path.rstrip("/")
        self.buckets = buckets
        self.number, self._tables, self._streams = self._read_pointer()

    # ---- the pointer ----------------------------------------------------------------------

    def _read_pointer(self) -> tuple[int, dict[str, Content], dict[str, int]]:
        numbers = [int(n) for n in names_in(self.spark, f"{self.path}/_current") if n.isdigit()]
        if not numbers:
            return 0, {}, {}
        state = json.loads(read_file(self.spark, f"{self.path}/_current/{max(numbers)}"))
        return max(numbers), {n: Content(**c) for n, c in state["tables"].items()}, state["streams"]

    def commit(self, *staged: Staged, stream: tuple[str, int] | None = None) -> None:
        """Make written content current, all of it at once, and remember how far a stream has come.

        Fails if another writer has committed since this one read the pointer.
        """
        tables = self._tables | {s.table: s.content for s in staged}
        streams = self._streams | ({stream[0]: stream[1]} if stream else {})
        state = {"tables": {n: vars(c) for n, c in tables.items()}, "streams": streams}
        number = self.number + 1
        if not create_once(self.spark, f"{self.path}/_current/{number}", json.dumps(state)):
            raise RuntimeError(f"another writer has changed {self.path}; open the warehouse again")
        # the pointer before stays for who is about to read it
        delete_path(self.spark, f"{self.path}/_current/{number - 2}")
        self.number, self._tables, self._streams = number, tables, streams

    def vacuum(self) -> int:
        """Delete what the pointer doesn't name; returns the folders deleted. No reader or writer may be busy."""
        gone = 0
        for name in TABLES:
            current = self._tables.get(name, Content()).folders
            for folder in names_in(self.spark, self._base(name)):
                if not folder.startswith("write="):
                    continue
                if folder not in current:
                    gone += delete_path(self.spark, f"{self._base(name)}/{folder}")
                elif current[folder] is not None:
                    for b in set(self._held(name, folder)) - set(current[folder]):
                        gone += delete_path(self.spark, f"{self._base(name)}/{folder}/bucket={b}")
        return gone

    # ---- reading --------------------------------------------------------------------------

    def _base(self, name: str) -> str:
        return f"{self.path}/{name.replace('.', '/')}"

    def is_written(self, name: str) -> bool:
        return path_exists(self.spark, self._base(name)) if TABLES[name].log else name in self._tables

    def table(self, name: str) -> DataFrame:
        """Current content, in the declared columns; empty if never written."""
        if not TABLES[name].log:
            return self._read(name, self._tables.get(name, Content()))
        if not self.is_written(name):
            return self.spark.createDataFrame([], TABLES[name].schema)
        return self.spark.read.schema(TABLES[name].schema).parquet(self._base(name))

    def changes(self, name: str, since: int) -> DataFrame:
        """Rows of a keyed table that a write after number ``since`` brought; older folders aren't opened."""
        content = self._tables.get(name, Content())
        newer = {f: b for f, b in content.folders.items() if int(f.split("=")[1].split("-")[0]) > since}
        rows = self._read(name, replace(content, folders=newer), WRITE)
        return rows.where(F.col(WRITE) > since).drop(WRITE)

    def unseen(self, staged: Staged) -> DataFrame:
        """Rows in folders of staged content that no reader sees yet."""
        current = self._tables.get(staged.table, Content()).folders
        new = {f: b for f, b in staged.content.folders.items() if f not in current}
        return self._read(staged.table, replace(staged.content, folders=new))

    def loaded(self, name: str) -> int:
        """The last write of its source that a table has taken in; 0 for none."""
        return self._tables.get(name, Content()).loaded

    def _read(self, name: str, content: Content, *more: str) -> DataFrame:
        hidden = {SEQ: content.seq or "string", WRITE: "bigint", "bucket": "int"}
        fields = [*TABLES[name].schema, *(T.StructField(c, T.DataType.fromDDL(hidden[c])) for c in more)]
        schema = T.StructType(fields)
        paths = []
        for folder, buckets in content.folders.items():
            path = f"{self._base(name)}/{folder}"
            paths += [path] if buckets is None else [f"{path}/bucket={b}" for b in buckets]
        if not paths:
            return self.spark.createDataFrame([], schema)
        read = self.spark.read.schema(schema).option("basePath", self._base(name))
        return read.parquet(*paths).select([F.col(f"`{c}`") for c in schema.names])

    def _held(self, name: str, folder: str) -> list[int]:
        found = names_in(self.spark, f"{self._base(name)}/{folder}")
        return sorted(int(n.split("=")[1]) for n in found if n.startswith("bucket="))

    # ---- writing --------------------------------------------------------------------------

    def _write(self, name: str, rows: DataFrame, content: Content, seq: str | None = None) -> tuple[str, int]:
        """(new folder, rows written), in the buckets of ``content``.

        ``seq`` is kept as SEQ, and WRITE if the rows have it. Rows with a column ``bucket`` (see :meth:`place`) lie
        together by it, and aren't shuffled.
        """
        spec = TABLES[name]
        folder = f"write={self.number + 1}-{uuid.uuid4().hex[:12]}"
        more = [F.col(seq).cast(content.seq).alias(SEQ)] if seq else []
        if spec.bucketed:
            more.append(F.col(WRITE) if WRITE in rows.columns else F.lit(self.number + 1).cast("bigint").alias(WRITE))
        out = conform(rows, spec.schema, *more)
        layout = spec.partition_by
        if spec.bucketed:
            layout = ("bucket", *layout)
            out = out.withColumn("bucket", _bucket([F.col(f"`{c}`") for c in spec.key], content))
            if "bucket" not in rows.columns:
                # a task of its own for each bucket, more for a large one, small ones together
                out = out.hint("rebalance", *layout)
        seen = Observation()
        out.observe(seen, F.count(F.lit(1)).alias("rows")).write.partitionBy(*layout).parquet(f"{self._base(name)}/{folder}", compression=_CODEC)
        return folder, seen.get["rows"]

    def place(self, name: str, rows: DataFrame, *key: str) -> DataFrame:
        """Rows with the ``bucket`` that the expressions ``key`` will have in a table, brought together by it.

        For narrow rows from which wide ones are made: these are then written without being shuffled.
        """
        columns = [F.expr(k).cast(TABLES[name].schema[c].dataType) for k, c in zip(key, TABLES[name].key, strict=True)]
        content = self._tables.get(name) or self._new(name)
        return rows.withColumn("bucket", _bucket(columns, content)).hint("rebalance", "bucket")

    def place_for_join(self, name: str, rows: DataFrame) -> DataFrame:
        """Rows brought together by ``bucket`` and ``part``, a share of the bucket by further bits of the key's hash.

        There are about as many parts as a shuffle begins with partitions, so a large bucket isn't one task.
        """
        content = self._tables.get(name) or self._new(name)
        conf, key = self.spark.conf, [F.col(f"`{c}`") for c in TABLES[name].key]
        n = conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) or conf.get("spark.sql.shuffle.partitions")
        part = F.pmod(F.xxhash64(F.lit(1), *key), F.lit(-(-int(n) // content.buckets))).cast("int")
        return rows.withColumns({"bucket": _bucket(key, content), "part": part}).repartition("bucket", "part")

    def placed(self, name: str) -> DataFrame:
        """As :meth:`table`, with ``bucket``: its rows are stored by it, and are written again without a shuffle."""
        return self._read(name, self._tables.get(name, Content()), "bucket")

    def _new(self, name: str) -> Content:
        n = self.buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        return Content(buckets=n if TABLES[name].bucketed else 0)

    def stage_overwrite(self, name: str, rows: DataFrame) -> Staged:
        """Write new content for a table without showing it yet."""
        content = self._new(name)
        folder, n = self._write(name, rows, content)
        return Staged(name, replace(content, folders={folder: None}), n)

    def overwrite(self, name: str, rows: DataFrame) -> int:
        """Replace a table; returns the rows written."""
        staged = self.stage_overwrite(name, rows)
        self.commit(staged)
        return staged.rows

    def append(self, name: str, rows: DataFrame) -> int:
        """Add rows whose keys are new; what is stored is not read or rewritten."""
        if TABLES[name].log:
            seen = Observation()
            out = conform(rows, TABLES[name].schema).observe(seen, F.count(F.lit(1)).alias("rows"))
            out.write.mode("append").parquet(self._base(name), compression=_CODEC)
            return seen.get["rows"]
        content = self._tables.get(name) or self._new(name)
        folder, n = self._write(name, rows, content)
        if n:
            self.commit(Staged(name, replace(content, folders=content.folders | {folder: None}), n))
        return n

    def upsert(
        self,
        name: str,
        batch: DataFrame,
        seq: str | None = None,
        newer: bool = False,
        stream: tuple[str, int] | None = None,
    ) -> int:
        """Insert or replace whole rows by key; returns rows written, updates included.

        With ``seq`` the last row per key of the batch wins, and it is stored as the version of the key; without
        it the keys of the batch must be unique. With ``newer`` a stored row of a greater version stays, so that batches
        may come in any order. An empty batch changes nothing. ``stream`` (its id, number of
        the batch) makes a batch count once. The batch is computed once.
        """
        if stream and self._streams.get(stream[0], -1) >= stream[1]:
            return 0
        staged = self.stage_upsert(name, batch, seq, newer)
        if staged.rows or stream:
            self.commit(*([staged] if staged.rows else []), stream=stream)
        return staged.rows

    def stage_upsert(self, name: str, batch: DataFrame, seq: str | None = None, newer: bool = False) -> Staged:
        """Write what :meth:`upsert` would show, without showing it yet.

        Keys decide, in the buckets of the batch only. A bucket that has none of them gets a
        further file; of one that has some, the rows that stay are written anew.
        """
        key = TABLES[name].key
        content = self._tables.get(name) or self._new(name)
        if seq is not None:
            kind = batch.schema[seq].dataType.simpleString()
            if content.seq not in (None, kind):
                raise ValueError(f"{name}: versions are {content.seq}, not {kind}")
            content = replace(content, seq=kind)
        hidden = (SEQ, WRITE) if content.seq else (WRITE,)

        def own(folder: str, *more: str) -> DataFrame:
            return self._read(name, replace(content, folders={folder: None}), *more)

        folder, n = self._write(name, batch, content, seq)
        if seq is not None and n and not repeated_keys(own(folder), key).isEmpty():
            folder, n = self._write(name, latest_wide(own(folder, SEQ), key, SEQ), content, SEQ)
        added = replace(content, folders=content.folders | {folder: None})
        if not n or not content.folders:
            return Staged(name, added, n)
        touched = self._held(name, folder)
        held = {f: self._held(name, f) for f in content.folders}
        near = self._read(name, replace(content, folders=content.only(touched, held)), *hidden, "bucket")
        mine = own(folder, *hidden, "bucket")
        version = [F.col(SEQ).alias("_version")] if newer and content.seq else []
        keys = mine.select(*key, *version)
        found = near.select(*key, "bucket", *([SEQ] if version else [])).join(keys, key, "left_semi" if not version else "inner")
        replaced = _rows_by_bucket(found)  # at most the buckets of a table
        hit = sorted(replaced)
        if not hit:
            return Staged(name, added, n)
        stale = found.where(F.col(SEQ) > F.col("_version")).select(*key) if version else None
        lost = stale.count() if stale is not None else 0
        fresh = mine.join(stale, key, "left_anti") if lost else mine
        # of a bucket all of whose rows are replaced nothing stays, so it isn't read
        stored = {} if version else _rows_by_bucket(near)
        part = [b for b in hit if stored.get(b) != replaced[b]]
        stay = near.where(F.col("bucket").isin(part)).join(fresh.select(*key), key, "left_anti")
        kept = content.only(hit, held, rest=True)
        if lost:  # what the batch brought is written again, without the rows that came too late
            kept |= Content({folder: None}).only(hit, {folder: touched}, rest=True)
            stay = stay.unionByName(fresh.where(F.col("bucket").isin(hit)))
        else:
            kept |= {folder: None}
        if part and not stay.isEmpty():
            anew, _ = self._write(name, stay.drop("bucket"), content, SEQ if content.seq else None)
            kept |= {anew: None}
        return Staged(name, replace(content, folders=kept), n - lost)

    def ensure(self) -> None:
        """Give every declared table a stored, empty version unless it has one."""
        missing = [n for n in TABLES if not self.is_written(n)]
        for n in missing:
            if TABLES[n].log:
                self.append(n, self.table(n))
        missing = [n for n in missing if not TABLES[n].log]
        if missing:
            with ThreadPoolExecutor(len(missing)) as pool:
                self.commit(*pool.map(lambda n: self.stage_overwrite(n, self.table(n)), missing))


def _bucket(key: list[Column], content: Content) -> Column:
    return F.pmod(F.xxhash64(*key), F.lit(content.buckets)).cast("int")


def _rows_by_bucket(rows: DataFrame) -> dict[int, int]:
    return {r["bucket"]: r["n"] for r in rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).collect()}


def row_counts(warehouse: Warehouse, names: list[str]) -> DataFrame:
    """(table_name, n) of the named tables."""
    counts = [
        warehouse.table(n).agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(n).alias("table_name"), F.col("n").cast(T.LongType())
        )
        for n in names
    ]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out
