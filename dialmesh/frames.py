"""Small DataFrame helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def add_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a costly column that is computed once per row.

    The optimiser copies a column's expression into every filter on it.  It does not
    reach through a generator, so a one-element explode keeps the expression in one
    place.
    """
    return df.select("*", F.explode_outer(F.array(value)).alias(name))


def explode_positions(df: DataFrame, keys: list[str], array: Column, name: str) -> DataFrame:
    """``keys, pos, name`` per array element.

    The outer form keeps the optimiser from testing the (costly) array for emptiness
    in a filter of its own before exploding it.
    """
    rows = df.select(*keys, F.posexplode_outer(array).alias("pos", name))
    return rows.where("pos is not null")
