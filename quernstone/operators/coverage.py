"""Coverage of a dimension, deficits, backfill, top counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def coverage(dimension: DataFrame, facts: DataFrame, key: str, target: int) -> DataFrame:
    """``dimension`` with n, deficit to ``target`` and state ok, low or zero; entries without facts count 0.

    Facts are counted before they meet the dimension, so only one row a key is shuffled further.
    """
    counts = facts.groupBy(key).agg(F.count("*").alias("n"))
    n = F.coalesce("n", F.lit(0))
    state = F.when(n >= target, "ok").when(n > 0, "low").otherwise("zero")
    return dimension.join(counts, key, "left").select(*dimension.columns, n.alias("n"), F.greatest(F.lit(target) - n, F.lit(0)).alias("deficit"), state.alias("state"))


def backfill(covered: DataFrame, key: str, prefix: str) -> DataFrame:
    """A generated row for each missing one: (key, ordinal, generated_id)."""
    rows = covered.where("deficit > 0").select(key, F.explode(F.sequence(F.lit(1), F.col("deficit").cast("int"))).alias("ordinal"))
    return rows.withColumn("generated_id", F.concat_ws("-", F.lit(prefix), F.col(key).cast("string"), F.lpad(F.col("ordinal").cast("string"), 3, "0")))


def top_counts(df: DataFrame, column: str, n: int) -> DataFrame:
    """The ``n`` most frequent values; ties in order of the value."""
    return df.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.asc(column)).limit(n)


def mix(df: DataFrame, by: str, kind: str) -> DataFrame:
    """Rows for each value of ``by`` and ``kind`` with their share of the value's rows, in thousandths."""
    part = df.groupBy(by, kind).agg(F.count("*").alias("n"))
    whole = part.groupBy(by).agg(F.sum("n").alias("whole"))
    return part.join(whole, by).select(by, kind, "n", F.floor(F.col("n") * 1000 / F.col("whole")).alias("per_mille"))
