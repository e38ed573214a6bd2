"""What several operators need: stored steps, joins by size, texts in Arrow batches."""

import os
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.sources.shared import fresh_folder

#: Rows, and bytes of their values, that a broadcast may hold; a larger side is shuffled.
SMALL_ROWS = 200_000
SMALL_BYTES = 64 << 20
#: The rows of crc32(doc_id) mod 4 that no model learns from.
HELD_OUT = 2


def importable(spark: SparkSession) -> None:
    """Let Python workers on this machine find the package wherever the session was started.

    On a cluster the package is installed or sent along (``--py-files``), as for any job.
    """
    root = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, known]))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(rows: DataFrame, name: str) -> DataFrame:
    """Rows written as Parquet in the folder all executors share, and read back.

    Cuts the lineage: what reads it neither computes it again nor keeps its shuffle files.
    """
    folder = fresh_folder(rows.sparkSession, name)
    rows.write.parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def sized(rows: DataFrame, limit: int = SMALL_ROWS, most: int = SMALL_BYTES) -> DataFrame:
    """A stored table, marked for broadcast if it has at most ``limit`` rows of ``most`` bytes; else as it is."""
    texts = [F.octet_length(F.col(f"`{c}`").cast("string")) for c, kind in rows.dtypes if kind[:5] in ("strin", "array", "struc", "map<s")]
    long = sum((F.coalesce(t, F.lit(0)) for t in texts), F.lit(8 * len(rows.columns)))
    found = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(long).alias("bytes")).first()
    return F.broadcast(rows) if found["n"] <= limit and (found["bytes"] or 0) <= most else rows


def exploded(rows: DataFrame, n: int) -> DataFrame:
    """``n`` rows of an explode, marked for broadcast if they are few, else for a shuffle of both sides.

    Without a mark Spark would broadcast them by the size of what went into the explode.
    """
    return F.broadcast(rows) if n <= SMALL_ROWS else rows.hint("merge")


def held_out(doc_id: str = "doc_id") -> F.Column:
    """Whether a row is in the quarter that no model learns from; a null id is."""
    part = F.crc32(F.col(doc_id).cast("string")) % 4
    return F.coalesce(part == HELD_OUT, F.lit(True))


def sample_of(rows: DataFrame, bound: int, key: str = "doc_id") -> DataFrame:
    """At most about ``bound`` rows, the same ones in every run: those of the smallest hash of the key.

    Only hashes are sorted; rows that share the key of the last place all count.
    """
    place = F.xxhash64(F.col(key).cast("string"))
    last = rows.select(place.alias("place")).orderBy("place").limit(bound).agg(F.max("place").alias("place"))
    cut = last.first()["place"]
    return rows.where(place <= F.lit(cut)) if cut is not None else rows.limit(0)


def map_texts(docs: DataFrame, fn: Callable[[list, Iterator[str]], dict], schema: str, columns=("doc_id", "text")) -> DataFrame:
    """``fn(columns before the last, texts)`` for each Arrow batch -> dict of output columns.

    The last of ``columns`` is the text, null read as empty and handed over one at a time.
    """
    names = list(columns)
    out = docs.sparkSession.createDataFrame([], schema).schema
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                texts = (v.as_py() or "" for v in batch.column(len(names) - 1))
                made = fn([batch.column(i) for i in range(len(names) - 1)], texts)
                yield pa.RecordBatch.from_arrays([pa.array(made[f.name], f.type) for f in arrow], schema=arrow)

    return docs.select(*names).mapInArrow(run, schema)


def free_name(rows: DataFrame, name: str) -> str:
    """``name``, or with underscores added until no column has it in any case."""
    taken = {c.lower() for c in rows.columns}
    while name.lower() in taken:
        name += "_"
    return name
