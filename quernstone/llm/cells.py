"""Joins of all rows of a group with each other, spread over tasks where the group is large."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of one group that one task holds of the left side; the right side's rows go to each cell of a larger group.
HOT = 8192


def n_cells(size: str | Column) -> Column:
    return F.greatest(F.ceil((F.col(size) if isinstance(size, str) else size) / HOT), F.lit(1)).cast("int")


def cell_of(ident: str, cells: Column) -> Column:
    return F.pmod(F.xxhash64(ident), cells).cast("int")


def in_cells(members: DataFrame, ident: str, size: str) -> tuple[DataFrame, DataFrame]:
    """(left, right) of ``members``, each with ``cell``, to be joined on the group and the cell.

    ``size`` has the number of rows of a row's group.  A group of up to HOT rows is one cell;
    a larger one is dealt to cells by the hash of ``ident``, and its rows on the right are
    repeated for each, so every pair meets once and no task gets more than HOT rows on the left.
    """
    left = members.withColumn("cell", cell_of(ident, n_cells(size)))
    right = members.withColumn("cell", F.explode(F.sequence(F.lit(0), n_cells(size) - 1)))
    return left, right
