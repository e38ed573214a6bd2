"""Small dimensions as values, with their size checked."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bounded_list(rows: DataFrame, order_by: list[str], bound: int, what: str) -> Column:
    """All rows as one sorted array of structs, as a scalar subquery.

    Only for tables that are small by nature. ``limit(bound + 1)`` stops the read
    early and a table above the bound fails the job, so nothing is cut off silently
    and nothing unbounded reaches one task.
    """
    columns = order_by + [c for c in rows.columns if c not in order_by]
    items = F.sort_array(F.collect_list(F.struct(*columns)))
    too_many = F.raise_error(F.lit(f"{what}: more than {bound} rows")).cast("boolean")
    return (
        rows.limit(bound + 1)
        .agg(items.alias("items"), F.count(F.lit(1)).alias("n"))
        .where(F.when(F.col("n") > bound, too_many).otherwise(F.lit(True)))
        .select("items")
        .scalar()
    )
