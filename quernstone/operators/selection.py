"""Deterministic samples and ranked selections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def shuffled(seed: str, ident: Column) -> Column:
    """A reproducible random order: the hash of seed and id."""
    return F.sha1(F.concat_ws("|", F.lit(seed), ident.cast("string")))


def stratified(df: DataFrame, stratum: str, ident: str, prefer: Column, n: int, seed: str) -> DataFrame:
    """``n`` rows of each stratum, preferred ones first, otherwise in random order (a sampling operator)."""
    w = Window.partitionBy(stratum).orderBy(F.when(prefer, 0).otherwise(1), shuffled(seed, F.col(ident)), ident)
    return df.withColumn("k", F.row_number().over(w)).where(F.col("k") <= n)


def diverse(df: DataFrame, kind: str, first: Column, ident: str, n: int) -> DataFrame:
    """``n`` rows in which the kinds take turns: the best of each kind, then the second best of each (a top-k report)."""
    turn = F.row_number().over(Window.partitionBy(kind).orderBy(F.when(first, 0).otherwise(1), ident))
    return df.withColumn("turn", turn).orderBy("turn", kind, ident).limit(n)
