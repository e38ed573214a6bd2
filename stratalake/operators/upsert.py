"""Keyed upsert, without MERGE."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest(rows: DataFrame, key: list[str], seq: str) -> DataFrame:
    """The row with the highest ``seq`` per key.

    An aggregate, not a window: each task first reduces its own rows per key, so a key
    with a third of all rows costs one row per task. Equal ``seq`` falls back to the
    remaining columns, which makes the winner independent of row order.
    """
    rest = [seq] + [c for c in rows.columns if c not in key and c != seq]
    picked = rows.groupBy(*key).agg(F.max(F.struct(*[F.col(f"`{c}`") for c in rest])).alias("_r"))
    columns = [F.col(f"`{c}`") if c in key else F.col(f"_r.`{c}`") for c in rows.columns]
    return picked.select(columns)


def repeated_keys(rows: DataFrame, key: list[str]) -> DataFrame:
    """Keys that occur more than once."""
    return rows.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").drop("_n")


def latest_wide(rows: DataFrame, key: list[str], seq: str) -> DataFrame:
    """As :func:`latest`, for wide rows of which few are superseded.

    Only the keys are shuffled to find those that occur twice; the rows of all other keys
    stay where they are as long as the list of repeated keys is small enough to broadcast.
    """
    repeated = repeated_keys(rows, key)
    once = rows.join(repeated, key, "left_anti")
    return once.unionByName(latest(rows.join(repeated, key, "left_semi"), key, seq))


def merge_rows(stored: DataFrame, batch: DataFrame, key: list[str]) -> DataFrame:
    """Stored rows that the batch leaves alone."""
    return stored.join(batch.select(*key), key, "left_anti")


def upsert_rows(stored: DataFrame, batch: DataFrame, key: list[str], seq: str | None = None) -> DataFrame:
    """Stored rows with the batch inserted or replaced, as one DataFrame."""
    if seq is not None:
        batch = latest(batch, key, seq).drop(seq)
    return merge_rows(stored, batch, key).unionByName(batch)
