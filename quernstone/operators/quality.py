"""Gates that explain themselves: every row gets the list of reasons why it fails."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def reasons(rules: list[tuple[str, Column]]) -> Column:
    """The names of the rules whose condition holds, in the order of the rules; a null condition doesn't hold."""
    return F.array_compact(F.array(*(F.when(condition, F.lit(name)) for name, condition in rules)))


def gate(df: DataFrame, rules: list[tuple[str, Column]], blocking: list[str] | None = None) -> DataFrame:
    """``df`` with issues (array), accepted, and reason_text joined by "; ".  Without ``blocking`` every issue rejects."""
    marked = df.withColumn("issues", reasons(rules))
    against = F.col("issues") if blocking is None else F.array_intersect("issues", F.array(*map(F.lit, blocking)))
    return marked.withColumn("accepted", F.size(against) == 0).withColumn("reason_text", F.array_join("issues", "; "))


def histogram(df: DataFrame, *by: str) -> DataFrame:
    """Rows for each issue (and each value of ``by``)."""
    return df.select(*by, F.explode("issues").alias("issue")).groupBy("issue", *by).agg(F.count("*").alias("n"))


def samples(df: DataFrame, ident: str, n: int) -> DataFrame:
    """The first ``n`` ids of each issue: a report of examples.

    A top-k window: every task keeps its first ``n`` of an issue before anything is shuffled, so a frequent issue is no hot group.
    """
    rows = df.select(F.explode("issues").alias("issue"), F.col(ident).alias("id")).distinct()
    return first_rows(rows, ["issue"], n, F.col("id")).select("issue", "k", "id")


def first_rows(df: DataFrame, by: list[str], n: int, *order: Column) -> DataFrame:
    """The first ``n`` rows of each group: a top-k report."""
    return df.withColumn("k", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("k") <= n)
