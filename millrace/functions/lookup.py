"""Joining a fact to something small without shuffling the fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A lookup up to this many rows is broadcast; a larger one goes through an ordinary join.
BROADCAST_ROWS = 50_000


def scalar(one_row: DataFrame) -> Column:
    """All columns of a one-row frame as one struct, usable as an expression anywhere."""
    return one_row.select(F.struct("*").alias("row")).scalar()


def small_or_same(lookup: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """An aggregated lookup, turned into a broadcast local table if it is known to be small."""
    rows = lookup.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        return lookup
    return F.broadcast(lookup.sparkSession.createDataFrame(rows, lookup.schema))


def attach(df: DataFrame, lookup: DataFrame, key: str | list[str],
           max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Left join to a lookup, broadcast only once its row count is known to be small."""
    return df.join(small_or_same(lookup, max_rows), key, "left")


def mapped(key: Column, table: dict[str, float], default: float | None) -> Column:
    """Value of a fixed lookup table; unlisted and missing keys get the default."""
    pairs = [F.lit(x) for item in table.items() for x in item]
    found = F.try_element_at(F.create_map(*pairs), key)
    return found if default is None else F.coalesce(found, F.lit(default))
