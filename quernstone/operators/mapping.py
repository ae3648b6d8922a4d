"""Mapping of records onto units: by exact title, by alias, by token similarity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def best_by_tokens(items: DataFrame, units: DataFrame, item: str = "item", unit: str = "unit", hot: int = 100_000) -> DataFrame:
    """(item, unit, score): the unit of the highest token similarity, the least unit in a tie; items without a common token are left out.

    ``items`` (item, tokens) and ``units`` (unit, tokens) meet on common tokens only: one
    equi-join on the exploded token instead of all pairs.  Rows carry the sizes of the sets and
    no sets; how often a pair meets is what it has in common, which is counted before the shuffle.
    Tokens that more than ``hot`` items hold are dealt to cells, and the few units that hold them go to each.
    Any common token can decide, so there is no prefix that would do instead.
    """
    a = items.select(F.col(item).alias("_item"), F.size(F.array_distinct("tokens")).alias("_na"), F.explode(F.array_distinct("tokens")).alias("token"))
    b = units.select(F.col(unit).alias("_unit"), F.size(F.array_distinct("tokens")).alias("_nb"), F.explode(F.array_distinct("tokens")).alias("token"))
    frequent = a.groupBy("token").agg(F.count("*").alias("_n")).where(F.col("_n") > hot).select("token", F.ceil(F.col("_n") / hot).cast("int").alias("_cells"))
    cells = F.coalesce("_cells", F.lit(1))
    b = b.join(frequent, "token", "left").select("_unit", "_nb", "token", F.explode(F.sequence(F.lit(0), cells - 1)).alias("_cell"))
    a = a.join(frequent, "token", "left").select("_item", "_na", "token", F.pmod(F.xxhash64("_item"), cells).cast("int").alias("_cell"))
    met = a.join(b, ["token", "_cell"]).groupBy("_item", "_unit", "_na", "_nb").agg(F.count("*").alias("_both"))
    scored = met.select(F.col("_item").alias(item), F.col("_unit").alias(unit), (F.col("_both") / (F.col("_na") + F.col("_nb") - F.col("_both"))).alias("score"))
    best = scored.groupBy(item).agg(F.min(F.struct((-F.col("score")).alias("s"), F.col(unit).alias("u"))).alias("b"))
    return best.select(item, F.col("b.u").alias(unit), (-F.col("b.s")).alias("score"))


def three_tiers(items: DataFrame, exact: DataFrame, alias: DataFrame, similar: DataFrame, item: str = "item", unit: str = "unit") -> DataFrame:
    """(item, unit, method): the first tier that knows the item; unmapped items stay, with null and ``none``."""
    tiers = [("exact", exact), ("alias", alias), ("tokens", similar)]
    out = items.select(item)
    for name, tier in tiers:
        out = out.join(tier.select(item, F.col(unit).alias(f"_{name}")), item, "left")
    method = F.lit("none")
    for name, _ in reversed(tiers):
        method = F.when(F.col(f"_{name}").isNotNull(), name).otherwise(method)
    return out.select(item, F.coalesce(*(F.col(f"_{name}") for name, _ in tiers)).alias(unit), method.alias("method"))
