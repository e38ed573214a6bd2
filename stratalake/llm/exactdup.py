"""Exact duplicates by composable polynomial fingerprints, confirmed by comparing chunks."""

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import sized, stored

#: The two moduli of a fingerprint and the bases of its polynomials (fixed values).
PRIMES = (2147483647, 2147483629)
BASES = (1000003, 998244353)
#: Bytes that one dot product hashes.
CHUNK = 1 << 12
#: Bytes that one row of the comparison holds.
PIECE = 1 << 16
#: Code points from which a document's pieces of that size are hashed by different tasks.
HUGE = 1 << 24
_SPACE = b" \t\n\v\f\r"


@lru_cache(maxsize=4)
def _powers(prime: int, base: int) -> np.ndarray:
    out = np.ones(CHUNK, np.uint64)
    for i in range(1, CHUNK):
        out[i] = int(out[i - 1]) * base % prime
    return out[::-1].copy()


def combined(left: int, right: int, length: int, prime: int, base: int) -> int:
    """Fingerprint of two parts in a row: the left one is shifted by the right one's length."""
    return (left * pow(base, length, prime) + right) % prime


def part_hash(data: bytes, prime: int, base: int) -> int:
    """Fingerprint of some bytes: all chunks are hashed at once, then combined."""
    if not data:
        return 0
    first = len(data) % CHUNK
    values = np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)  # so that zero bytes count
    powers, total = _powers(prime, base), 0
    if first:
        total = int((values[:first] @ powers[CHUNK - first :]) % np.uint64(prime))
    if len(data) > first:
        hashes = (values[first:].reshape(-1, CHUNK) @ powers) % np.uint64(prime)
        for h in hashes.tolist():
            total = combined(total, h, CHUNK, prime, base)
    return total


def normalised(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass").translate(None, _SPACE)


def _pairs(data: bytes, primes: tuple[int, int]) -> tuple[int, int]:
    return tuple(part_hash(data, p, b) for p, b in zip(primes, BASES))


def _batches(rows: DataFrame, fn, schema: str) -> DataFrame:
    """``fn(row values)`` -> row values, for every row; the last column is a text or bytes, one in memory at a time."""
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(rows.sparkSession.createDataFrame([], schema).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                small = [batch.column(i).to_pylist() for i in range(batch.num_columns - 1)]
                made = zip(*(fn(*values, cell.as_py()) for *values, cell in zip(*small, batch.column(batch.num_columns - 1))))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(made, arrow)], schema=arrow)

    return rows.mapInArrow(run, schema)


def fingerprints(docs: DataFrame, primes: tuple[int, int] = PRIMES, huge: int = HUGE) -> DataFrame:
    """(doc_id, n_chars, n_bytes, text_sha256, fp) of every row's normalised text.

    A document's chunks are hashed by the task that reads it and combined there. A document of
    ``huge`` code points or more is cut into pieces of that size, hashed by different tasks
    and combined by length, so that it isn't one task's work.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    size = F.length("text")

    def whole(doc_id, text):
        data = normalised(text)
        high, low = _pairs(data, primes)
        return doc_id, len(text), len(data), hashlib.sha256(data).hexdigest(), high << 31 | low

    schema = "doc_id long, n_chars long, n_bytes long, text_sha256 string, fp long"
    small = _batches(rows.where(size < huge), whole, schema)

    def piece(row, number, text):
        data = normalised(text)
        return row, number, len(data), *_pairs(data, primes)

    def joined(doc_id, n_chars, digest, pieces):
        high = low = total = 0
        for x in pieces:
            high = combined(high, x["high"], x["n_bytes"], primes[0], BASES[0])
            low = combined(low, x["low"], x["n_bytes"], primes[1], BASES[1])
            total += x["n_bytes"]
        return doc_id, n_chars, total, digest, high << 31 | low

    # stored, so that each reader sees the same numbers, also after a task is run again
    numbered = stored(rows.where(size >= huge).withColumn("row", F.monotonically_increasing_id()), "huge")
    starts = F.sequence(F.lit(0), F.floor((size - 1) / huge).cast("int"))
    pieces = numbered.select("row", F.explode(starts).alias("number"), "text").select(
        "row", "number", F.substring("text", F.col("number") * huge + 1, F.lit(huge)).alias("text")
    )
    hashes = _batches(pieces.repartition("row", "number"), piece, "row long, number int, n_bytes long, high long, low long")
    lists = hashes.groupBy(F.col("row").alias("r")).agg(F.sort_array(F.collect_list(F.struct("number", "n_bytes", "high", "low"))).alias("pieces"))
    digest = F.sha2(F.translate("text", " \t\n\v\f\r", ""), 256)
    facts = numbered.select("row", "doc_id", size.cast("long").alias("n_chars"), digest.alias("digest"))
    long = facts.join(lists, F.col("row") == F.col("r")).select("doc_id", "n_chars", "digest", "pieces")
    return small.unionByName(_batches(long, joined, schema))


def _collided(docs: DataFrame, groups: DataFrame, primes: tuple[int, int], huge: int) -> DataFrame:
    """(fp, n_bytes) of groups whose texts aren't all equal, compared piece by piece.

    Every piece of a member is grouped by its bytes; equal ones meet before the shuffle, so a
    group of any size sends one row a task. A group is confirmed if each piece has one content.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cell in batch.column(0):
                data = normalised(cell.as_py() or "")
                high, low = _pairs(data, primes)
                cuts = range(0, len(data), PIECE)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([high << 31 | low] * len(cuts), pa.int64()),
                        pa.array([len(data)] * len(cuts), pa.int64()),
                        pa.array(range(len(cuts)), pa.int32()),
                        pa.array([data[c : c + PIECE] for c in cuts], pa.binary()),
                    ],
                    names=["fp", "n_bytes", "piece", "data"],
                )

    parts = docs.select("text").mapInArrow(pieces, "fp long, n_bytes long, piece int, data binary")
    members = parts.join(groups.select("fp", "n_bytes"), ["fp", "n_bytes"], "left_semi")
    contents = members.groupBy("fp", "n_bytes", "piece", "data").count()
    several = contents.groupBy("fp", "n_bytes", "piece").count().where(F.col("count") > 1)
    return several.select("fp", "n_bytes").distinct()


def exact_duplicates(docs: DataFrame, primes: tuple[int, int] = PRIMES, huge: int = HUGE) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of every row.

    Texts are equal if they are without ASCII white space; null is empty. Of a group the row
    with the most code points stays, then of the least doc_id (null last), and of repeated
    rows one. Groups are made by fingerprint and length and confirmed by comparison; texts of
    a group that fails it are grouped by their own bytes.
    """
    rows = stored(fingerprints(docs, primes, huge), "fingerprints")
    first = F.min(F.struct((-F.col("n_chars")).alias("order"), F.col("doc_id").isNull().alias("none"), "doc_id")).alias("first")
    key = ["fp", "n_bytes"]
    all_groups = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("group_size"), first)
    groups = sized(stored(all_groups.where(F.col("group_size") > 1), "groups"))
    wrong = sized(stored(_collided(docs, groups, primes, huge), "collided"))
    split = not wrong.isEmpty()
    if split:  # the digest tells nothing new where fingerprints agree; here the bytes decide
        texts = _texts(docs, primes).join(wrong, key, "left_semi")
        by_text = texts.groupBy(*key, "data").agg(F.count(F.lit(1)).alias("group_size"), first)
        groups = stored(
            groups.join(wrong, key, "left_anti")
            .withColumn("text_sha256", F.lit(None).cast("string"))
            .unionByName(by_text.select(*key, "group_size", "first", F.sha2("data", 256).alias("text_sha256"))),
            "groups",
        )
    same = F.col("t.fp").eqNullSafe(F.col("g.fp")) & (F.col("t.n_bytes") == F.col("g.n_bytes"))
    if split:
        same &= F.coalesce(F.col("g.text_sha256") == F.col("t.text_sha256"), F.lit(True))
    distinct = rows.groupBy("doc_id", "n_chars", "n_bytes", "text_sha256", "fp").agg(F.count(F.lit(1)).alias("copies"))
    joined = distinct.alias("t").join(groups.alias("g"), same, "left").select(
        "t.doc_id",
        F.when(F.col("g.fp").isNull(), F.col("t.doc_id")).otherwise(F.col("g.first.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (F.col("g.fp").isNull() | ((F.col("g.first.order") == -F.col("n_chars")) & F.col("g.first.doc_id").eqNullSafe(F.col("t.doc_id")))).alias("best"),
        "t.text_sha256",
        F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"),
    )
    return joined.select("doc_id", "keep_id", "group_size", (F.col("best") & (F.col("copy") == 1)).alias("kept"), "text_sha256")


def _texts(docs: DataFrame, primes: tuple[int, int]) -> DataFrame:
    """(doc_id, n_chars, n_bytes, fp, data) of every row, with the normalised bytes."""

    def made(doc_id, text):
        data = normalised(text or "")
        high, low = _pairs(data, primes)
        return doc_id, len(text or ""), len(data), high << 31 | low, data

    return _batches(docs.select("doc_id", "text"), made, "doc_id long, n_chars long, n_bytes long, fp long, data binary")
