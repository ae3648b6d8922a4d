"""Keep-first, keep-last, keep-best, duplicates, overlays and replacements by key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def keep_one(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """One row a key: the first in ``order``.

    ``max_by``-like aggregation over a struct, so rows are reduced before the shuffle and a
    key that holds a third of all rows costs one row a task; a window would gather it in one.
    Columns of ``order`` are ascending as given; give descending ones through ``descending``.
    """
    names = [c for c in df.columns if c not in keys]
    ranked = F.struct(*(o.alias(f"_{k}") for k, o in enumerate(order)), *names)
    return df.groupBy(*keys).agg(F.min(ranked).alias("_kept")).select(*keys, *(F.col(f"_kept.{n}").alias(n) for n in names))


def descending(x: Column) -> Column:
    """A number that orders the other way."""
    return -x.cast("double")


def descending_time(x: Column) -> Column:
    return -F.unix_micros(x)


def duplicates(df: DataFrame, keys: list[str], ident: str) -> DataFrame:
    """(keys, n, kept, dropped) of the keys with several rows."""
    return (
        df.groupBy(*keys)
        .agg(F.count("*").alias("n"), F.min(ident).alias("kept"))
        .where("n > 1")
        .withColumn("dropped", F.col("n") - 1)
    )


def without_existing(df: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    return df.join(existing.select(*keys).distinct(), keys, "left_anti")


def replace_partition(base: DataFrame, new: DataFrame, partition: str, key: list[str], *order: Column) -> DataFrame:
    """Rows of the partitions that ``new`` has are dropped from ``base``, the new rows are added, one a key."""
    kept = base.join(new.select(partition).distinct(), partition, "left_anti")
    return kept.unionByName(keep_one(new, key, *order))


def upsert(base: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``new`` replace those of ``base`` with the same key; others are added."""
    return base.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new, allowMissingColumns=True)


def overlay(base: DataFrame, old: DataFrame, keys: list[str], fill: list[str], empty: Column | None = None) -> DataFrame:
    """Base rows with the columns ``fill`` completed from ``old`` where they are null; rows only in ``old`` follow.

    ``origin`` tells base, filled or old.  Base is not deduplicated; old must have one row a key.
    """
    right = old.select(*keys, *(F.col(c).alias(f"_old_{c}") for c in fill), F.lit(True).alias("_in_old"))
    left = base.select(*keys, *fill, F.lit(True).alias("_in_base"))
    both = left.join(right, keys, "full_outer")
    filled = [F.coalesce(F.col(c), F.col(f"_old_{c}")).alias(c) for c in fill]
    changed = F.lit(False)
    for c in fill:
        changed = changed | (F.col(c).isNull() & F.col(f"_old_{c}").isNotNull())
    origin = F.when(F.col("_in_base").isNull(), "old").when(changed, "filled").otherwise("base").alias("origin")
    return both.select(*keys, *filled, origin)


def violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that should be unique and aren't, with the number of their rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def changes(old: DataFrame, new: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(change, column_name, n): added and removed keys and changed columns between two tables, nulls compared as values."""
    a = old.select(key, *(F.col(c).alias(f"a_{c}") for c in columns), F.lit(1).alias("in_a"))
    b = new.select(key, *(F.col(c).alias(f"b_{c}") for c in columns), F.lit(1).alias("in_b"))
    both = a.join(b, key, "full_outer")
    cases = [F.when(F.col("in_a").isNull(), F.struct(F.lit("added").alias("change"), F.lit("*").alias("column_name")))]
    cases.append(F.when(F.col("in_b").isNull(), F.struct(F.lit("removed").alias("change"), F.lit("*").alias("column_name"))))
    there = F.col("in_a").isNotNull() & F.col("in_b").isNotNull()
    same = F.lit(True)
    for c in columns:
        equal = F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}"))
        same = same & equal
        cases.append(F.when(there & ~equal, F.struct(F.lit("changed").alias("change"), F.lit(c).alias("column_name"))))
    cases.append(F.when(there & same, F.struct(F.lit("unchanged").alias("change"), F.lit("*").alias("column_name"))))
    return both.select(F.explode(F.array_compact(F.array(*cases))).alias("x")).groupBy("x.change", "x.column_name").agg(F.count("*").alias("n"))


def by_recency(df: DataFrame, keys: list[str], time: str, n: int) -> DataFrame:
    """The latest ``n`` rows of each key (a top-k report)."""
    k = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(time)))
    return df.withColumn("k", k).where(F.col("k") <= n)
