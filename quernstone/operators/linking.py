"""Links that narrow softly, required against covered, moves, repairs of a hierarchy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quernstone.operators.sequences import carried_forward


def narrowed(pairs: DataFrame, item: str, node: str, preferences: list[Column], n: int) -> DataFrame:
    """(item, nodes): the nodes linked to an item, kept to those of each preference in turn unless none is left; ``n`` at most, in order.

    A row stays if it meets the preference or no row of its item that is left does.  What each
    preference leaves is a matter of order alone: rows that meet the first come before those that
    don't, and so on, so the best rank of an item is an aggregate and the rows of that rank are
    those that stay.  Only the first ``n`` of them are collected.
    """
    rows = pairs.select(item, node, F.array(*(~F.coalesce(p, F.lit(False)) for p in preferences)).alias("_rank")).distinct()
    first = F.dense_rank().over(Window.partitionBy(item).orderBy("_rank", node))
    kept = rows.withColumn("_k", first).where(F.col("_k") <= n)
    best = kept.groupBy(item).agg(F.min("_rank").alias("_best"))
    stay = kept.join(best, item).where(F.col("_rank") == F.col("_best"))
    return stay.groupBy(item).agg(F.array_sort(F.collect_set(node)).alias("nodes"))


def required_but_missing(required: DataFrame, covered: DataFrame, by: str, value: str) -> DataFrame:
    return required.select(by, value).distinct().join(covered.select(by, value).distinct(), [by, value], "left_anti")


def moved(members: DataFrame, moves: DataFrame, member: str, unit: str) -> DataFrame:
    """Members with their unit after ``moves`` (member, unit); all moves are read off the units as they were."""
    to = moves.select(member, F.col(unit).alias("_to"))
    return members.join(to, member, "left").withColumn(unit, F.coalesce("_to", unit)).drop("_to")


def filled(rows: DataFrame, by: list[str], group: str, order: str, text: str) -> DataFrame:
    """``text`` completed by the longest text of its ``group``, else by the last one before it in ``order`` within ``by``.

    Of several longest texts the least is taken; a row without a group, or whose group has no text, takes the one carried forward.
    """
    named = rows.where(F.col(text).isNotNull() & F.col(group).isNotNull())
    longest = named.groupBy(group).agg(F.min(F.struct((-F.length(text)).alias("n"), F.col(text).alias("t"))).alias("_m")).select(group, F.col("_m.t").alias("_longest"))
    joined = rows.join(longest, group, "left").withColumn(text, F.coalesce(text, "_longest")).drop("_longest")
    return carried_forward(joined, by, [order], text, "_last").withColumn(text, F.coalesce(text, "_last")).drop("_last")


def contiguous(rows: DataFrame, by: str, number: str) -> DataFrame:
    """(by, problem): groups whose numbers aren't 1 to n, each once."""
    per = rows.groupBy(by).agg(F.min(number).alias("low"), F.max(number).alias("high"), F.count("*").alias("n"), F.countDistinct(number).alias("d"))
    problems = F.array_compact(F.array(F.when(F.col("low") != 1, F.lit("does not start at 1")), F.when(F.col("d") != F.col("high"), F.lit("has gaps")), F.when(F.col("n") != F.col("d"), F.lit("has repetitions"))))
    return per.select(by, F.explode(problems).alias("problem"))
