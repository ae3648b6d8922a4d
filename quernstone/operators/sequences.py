"""Operators over ordered rows: spans, sections, carry-forward, as-of and range lookups, gaps, codes, budgets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quernstone.runtime import materialize, shuffle_partitions


def spans(df: DataFrame, by: list[str], start: str, last: Column | None = None) -> DataFrame:
    """Each row's end: one before the next start of its group, else ``last``."""
    following = F.lead(start).over(Window.partitionBy(*by).orderBy(start))
    return df.withColumn("span_end", F.coalesce(following - 1, last if last is not None else F.lit(None)))


def sections(df: DataFrame, by: list[str], order: list[str], opens: Column) -> DataFrame:
    """``df`` with section_no: how many rows that open a section lie up to the row; 0 before the first."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn("section_no", F.sum(F.when(opens, 1).otherwise(0)).over(w))


def carried_forward(df: DataFrame, by: list[str], order: list[str], column: str, into: str) -> DataFrame:
    """The last value of ``column`` that was not null, up to the row."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(into, F.last(column, ignorenulls=True).over(w))


def as_of(rows: DataFrame, markers: DataFrame, by: str, at: str, value: str) -> DataFrame:
    """``rows`` with the ``value`` of the last marker at or before them, in the same ``by``; null before the first.

    Rows and markers are put in one order and the marker's value is carried forward: one
    shuffle and one sort instead of a join of every row with every earlier marker.
    """
    columns = [c for c in rows.columns if c not in (by, at)]
    a = rows.select(by, at, F.lit(1).alias("_kind"), F.lit(None).cast(dict(markers.dtypes)[value]).alias("_value"), *columns)
    b = markers.select(by, at, F.lit(0).alias("_kind"), F.col(value).alias("_value"), *(F.lit(None).cast(t).alias(c) for c, t in rows.dtypes if c in columns))
    w = Window.partitionBy(by).orderBy(at, "_kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return a.unionByName(b).withColumn(f"asof_{value}", F.last("_value", ignorenulls=True).over(w)).where("_kind = 1").drop("_kind", "_value")


def in_range(points: DataFrame, ranges: DataFrame, by: str, point: str, start: str, end: str, name: str, width: int = 16) -> DataFrame:
    """``points`` with the first range of their ``by`` that holds them, null if none does.

    Ranges are cut into cells of ``width`` and points meet only ranges of their cell, so the
    join is an equi-join, with the bounds as residual.
    """
    cells = ranges.where(F.col(start) <= F.col(end)).select(by, start, end, name, F.explode(F.sequence(F.floor(F.col(start) / width), F.floor(F.col(end) / width))).alias("_cell"))
    p = points.withColumn("_cell", F.floor(F.col(point) / width))
    met = p.join(cells.select(F.col(by).alias("_by"), F.col("_cell").alias("_c"), start, end, name), (F.col(by) == F.col("_by")) & (F.col("_cell") == F.col("_c")) & F.col(point).between(F.col(start), F.col(end)), "left")
    return met.groupBy(*points.columns).agg(F.min(F.when(F.col(name).isNotNull(), F.struct(start, name))).alias("_m")).select(*points.columns, F.col(f"_m.{name}").alias(name))


def gaps(df: DataFrame, by: str, number: str, last: str) -> DataFrame:
    """(by, number) of the numbers from 1 to ``last`` that a group lacks."""
    there = df.groupBy(by).agg(F.max(last).alias("_last"), F.collect_set(number).alias("_there"))
    missing = F.array_except(F.when(F.col("_last") >= 1, F.sequence(F.lit(1), F.col("_last"))).otherwise(F.array().cast("array<int>")), "_there")
    return there.select(by, F.explode(missing).alias(number))


def numbered(df: DataFrame, by: list[str], order: list, into: str = "ordinal") -> DataFrame:
    return df.withColumn(into, F.row_number().over(Window.partitionBy(*by).orderBy(*order)))


def unique_codes(df: DataFrame, code: str, order: list) -> DataFrame:
    """``code`` made unique: the first keeps it, the n-th gets -n."""
    k = F.row_number().over(Window.partitionBy(code).orderBy(*order))
    return df.withColumn("unique_code", F.when(k == 1, F.col(code)).otherwise(F.concat_ws("-", F.col(code), k.cast("string"))))


def batches(df: DataFrame, ident: str, order: list, size: int = 100) -> DataFrame:
    """(ident, k, batch) of the different ids in the order of their first row; batches of ``size`` are numbered from 1."""
    first = df.where(F.col(ident).isNotNull()).groupBy(ident).agg(F.min(F.struct(*order)).alias("_first"))
    named = renumbered(first, ["_first", ident], "k")
    return named.select(ident, "k", (F.floor((F.col("k") - 1) / size) + 1).cast("int").alias("batch"))


def renumbered(units: DataFrame, order: list, into: str = "unit_no") -> DataFrame:
    """Units numbered from 1 in one order over all of them.

    The rows are divided by ranges of the order and numbered inside each; how many rows the
    ranges before have, one number a range, is added.  No task gets all rows.
    """
    parts = shuffle_partitions(units.sparkSession)
    ranged = materialize(units.repartitionByRange(parts, *order).withColumn("_range", F.spark_partition_id()), "ranges")
    counts = sorted((r["_range"], r.n) for r in ranged.groupBy("_range").agg(F.count("*").alias("n")).collect())  # one row a partition
    before, at = [], 0
    for k, n in counts:
        before.append((k, at))
        at += n
    starts = units.sparkSession.createDataFrame(before, "_range int, _before long")
    within = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return ranged.withColumn(into, within).join(F.broadcast(starts), "_range").withColumn(into, (F.col(into) + F.col("_before")).cast("int")).drop("_range", "_before")


def looked_back(df: DataFrame, number: str, lags: tuple[int, ...], into: str = "reviews") -> DataFrame:
    """``df`` with the earlier numbers that a row looks back to: ``number`` less each of ``lags``, those from 1 on."""
    earlier = F.array(*(F.col(number) - lag for lag in lags))
    return df.withColumn(into, F.filter(earlier, lambda k: k >= 1))


def within_budget(df: DataFrame, by: list[str], order: list, size: Column, budget: int) -> DataFrame:
    """The rows of each group before the running total first exceeds ``budget``."""
    w = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn("running", F.sum(size).over(w)).where(F.col("running") <= budget)
