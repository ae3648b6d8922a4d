"""Lookups that keep an order, fall from exact to contained titles, pick the best element; lists rolled up; pivots; commits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quernstone.functions.text import jaccard


def in_order(rows: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """``rows`` of the keys in ``wanted`` (key, ordinal), with the ordinal they were asked in; keys that don't exist are left out."""
    first = wanted.groupBy(key).agg(F.min("ordinal").alias("ordinal"))
    return rows.join(first, key)


def by_title(items: DataFrame, titles: DataFrame, item: str = "item", unit: str = "unit", title: str = "title") -> DataFrame:
    """(item, unit, how): the unit of equal title, else the least unit whose title holds the item or is held by it.

    Items that found no equal title meet the titles through ``containing``, in both directions.  Empty texts hold nothing and are held by nothing.
    """
    exact = items.join(titles.groupBy(F.col(title).alias(item)).agg(F.min(unit).alias(unit)), item).withColumn("how", F.lit("exact"))
    rest = items.join(exact.select(item), item, "left_anti")
    named = titles.select(F.col(title).alias("_title"), F.col(unit).alias("_unit")).where("_title is not null")
    within = containing(rest.select(item), item, named.select("_title").distinct(), "_title").select(item, "_title")
    around = containing(named.select("_title").distinct(), "_title", rest.select(item), item).select(item, "_title")
    held = within.unionByName(around).distinct().join(named, "_title").select(item, F.col("_unit").alias(unit))
    return exact.select(item, unit, "how").unionByName(held.groupBy(item).agg(F.min(unit).alias(unit)).withColumn("how", F.lit("contained")))


def _grams(x: Column, size: int) -> Column:
    """The different runs of ``size`` characters of a text."""
    starts = F.sequence(F.lit(1), F.greatest(F.length(x) - (size - 1), F.lit(1)))
    return F.array_distinct(F.transform(starts, lambda k: F.substr(x, k, F.lit(size))))


def containing(parts: DataFrame, part: str, wholes: DataFrame, whole: str, size: int = 4) -> DataFrame:
    """(part, whole) of distinct texts where ``part`` stands inside ``whole``, by an equi-join.

    A text holds every run of characters that a part of it has.  Each part is looked up by the
    one of its runs of ``size`` characters that fewest wholes have, and those found are tested; parts
    shorter than that by their rarest single character.
    """
    found = None
    for long, n in ((True, size), (False, 1)):
        some = parts.select(part).where((F.length(part) >= size) if long else F.length(part).between(1, size - 1)).distinct()
        grams = wholes.select(whole, F.explode(_grams(F.col(whole), n)).alias("_gram"))
        count = grams.groupBy("_gram").agg(F.count("*").alias("_n"))
        asked = some.select(part, F.explode(_grams(F.col(part), n)).alias("_gram")).join(count, "_gram", "left")
        rarest = asked.groupBy(part).agg(F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("n"), F.col("_gram").alias("g"))).alias("_m")).select(part, F.col("_m.g").alias("_gram"))
        met = rarest.join(grams, "_gram").where(F.col(whole).contains(F.col(part))).select(part, whole)
        found = met if found is None else found.unionByName(met)
    return found


def best_element(tokens: Column, candidates: Column) -> Column:
    """(text, score) of the candidate (text, tokens) most like ``tokens``, the first of several; null without one in common."""
    scored = F.transform(candidates, lambda c, k: F.named_struct(F.lit("score"), jaccard(tokens, c["tokens"]), F.lit("k"), -k, F.lit("text"), c["text"]))
    best = F.array_max(scored)
    return F.when(best["score"] > 0, F.struct(best["text"].alias("text"), best["score"].alias("score")))


def rolled_up(lists: DataFrame, facts: DataFrame, name: str, members: str, key: str, value: str, once: bool) -> DataFrame:
    """(name, total) of the members' values; a member listed twice counts twice unless ``once``."""
    wanted = F.array_distinct(members) if once else F.col(members)
    rows = lists.select(name, F.explode(wanted).alias(key)).join(facts.select(key, value), key, "left")
    return rows.groupBy(name).agg(F.sum(F.coalesce(value, F.lit(0))).alias("total"))


def crossed(df: DataFrame, row: str, column: str, values: list[str]) -> DataFrame:
    """Counts of ``column``'s ``values`` for each ``row``; the values are given, so no pass finds them."""
    return df.groupBy(row).pivot(column, values).agg(F.count(F.lit(1))).na.fill(0, values)


def scored_pick(df: DataFrame, name: str, scores: list[tuple[str, int]], limit: int) -> DataFrame:
    """The best rows by the points their name earns, at most max(1, min(3, limit / 20 rounded up)) of them."""
    points = F.lit(0)
    for pattern, n in scores:
        points = points + F.when(F.col(name).rlike(pattern), n).otherwise(0)
    return df.withColumn("points", points).orderBy(F.desc("points"), name).limit(max(1, min(3, -(-limit // 20))))


def commit(exams: DataFrame, questions: DataFrame, stored: DataFrame, replace: bool = False) -> dict[str, DataFrame]:
    """What storing exams means, as tables: ``skipped`` ones that are there, ``sets``, ``questions`` once each, ``links``, and the ``run``.

    exams: (source_hash, exam_index, title); questions: (source_hash, exam_index, source_code, section, number, text).
    Ids are hashes of the keys, so a repeated commit gives the same rows.
    """
    key = ["source_hash", "exam_index"]
    there = stored.select(*key).distinct()
    skipped = exams.limit(0) if replace else exams.join(there, key, "left_semi")
    taken = exams if replace else exams.join(there, key, "left_anti")
    set_id = F.sha1(F.concat_ws("|", *key)).alias("set_id")
    sets = taken.select(set_id, *taken.columns)
    rows = questions.join(sets.select("set_id", *key), key)
    question_id = F.sha1("source_code").alias("question_id")
    first = F.row_number().over(Window.partitionBy("source_code").orderBy("section", "number"))
    once = rows.withColumn("_k", first).where("_k = 1").select(question_id, "source_code", "text")
    links = rows.select("set_id", question_id, "section", "number").distinct()
    both = sets.select(F.lit(1).alias("s"), F.lit(0).alias("l")).unionByName(links.select(F.lit(0).alias("s"), F.lit(1).alias("l")))
    run = both.agg(F.coalesce(F.sum("s"), F.lit(0)).alias("n_sets"), F.coalesce(F.sum("l"), F.lit(0)).alias("n_links"))
    return {"skipped": skipped, "sets": sets, "questions": once, "links": links, "run": run}
