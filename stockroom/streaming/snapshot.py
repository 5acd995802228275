"""Serve the newest of several copies of a result (a cached copy and a freshly written
file, say): the copy whose ``as_of`` is largest wins, whole - rows of different copies are
never mixed. The winner is one scalar (max as_of), so the choice is a filter, not a join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def newest_copy(copies: DataFrame, as_of: str = "as_of", copy_col: str = "copy") -> DataFrame:
    """``copies`` stacks the candidate copies, each row tagged with its copy id and as_of.
    Returns the rows of the newest copy (ties: the largest copy id)."""
    best = copies.agg(F.max(F.struct(F.col(as_of).alias("a"), F.col(copy_col).alias("c"))).alias("b")).first()["b"]
    if best is None:
        return copies.limit(0)
    return copies.filter((F.col(as_of) == F.lit(best["a"])) & (F.col(copy_col) == F.lit(best["c"])))
