"""Shared pieces of the plans and of their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quernstone.functions.text import SPACE, STOP_WORDS
from quernstone.operators.dedupe import keep_one
from quernstone.runtime import table

Run = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Run] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Run], Run]:
    """Registers a plan under its name, with the SQL that must give the same rows."""

    def register(run: Run) -> Run:
        QUERIES[run.__name__] = run
        if sql is not None:
            ORACLES[run.__name__] = sql
        return run

    return register


def bank(spark: SparkSession, root: str, *columns: str) -> DataFrame:
    """The question bank, one row a question: the latest import."""
    kept = [c for c in columns if c != "question_id"]
    rows = table(spark, root, "random_sources_preview").select("question_id", "imported_at", "needs_review", *(c for c in kept if c not in ("imported_at", "needs_review")))
    return keep_one(rows, ["question_id"], -F.unix_micros("imported_at"), F.coalesce("needs_review", F.lit(False))).select("question_id", *kept)


# ---- the same in SQL

BANK = """bank AS (SELECT * FROM random_sources_preview QUALIFY row_number() OVER (
  PARTITION BY question_id ORDER BY imported_at DESC, coalesce(needs_review, false)) = 1)"""
EXAM = "exam AS (SELECT * FROM standard_exam_questions QUALIFY row_number() OVER (PARTITION BY id ORDER BY created_at) = 1)"


def fold(x: str) -> str:
    return f"replace(strip_accents(replace(lower({x}), 'ß', 'ss')), 'đ', 'd')"


def squash(x: str) -> str:
    return f"trim(regexp_replace({x}, '{SPACE}+', ' ', 'g'))"


def optional(x: str) -> str:
    return f"(CASE WHEN lower({squash(x)}) NOT IN ('', 'null', 'none', 'n/a') THEN {squash(x)} END)"


def tokens(x: str) -> str:
    stop = ", ".join(f"'{w}'" for w in STOP_WORDS)
    return (
        f"list_sort(list_distinct(list_filter(regexp_extract_all({fold(f'coalesce({x}, {chr(39)}{chr(39)})')}, '[a-z0-9]+'), "
        f"lambda w: length(w) >= 3 AND w NOT IN ({stop}) AND NOT regexp_full_match(w, '[0-9]+'))))"
    )


def number(x: str) -> str:
    """Numeric reading of an answer."""
    part = "(-?[0-9]+(?:[.,][0-9]+)?)"
    fraction = rf"^\s*{part}\s*/\s*{part}\s*$"
    value = lambda n: f"TRY_CAST(replace(regexp_extract({x}, '{fraction}', {n}), ',', '.') AS DOUBLE)"
    first = f"TRY_CAST(replace(regexp_extract({x}, '{part}', 1), ',', '.') AS DOUBLE)"
    return f"(CASE WHEN regexp_matches({x}, '{fraction}') AND {value(2)} <> 0 THEN {value(1)} / {value(2)} WHEN NOT contains({x}, chr(10)) THEN {first} END)"
