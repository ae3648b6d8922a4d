"""Documents as pages and lines: key lines, compaction, tables, formulas, questions with their keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quernstone.functions.text import squash
from quernstone.operators.parse import OPTION_LINE, answer_key, lines, stem


def key_lines(df: DataFrame, ident: str, column: str, pattern: str, n: int, prefix: int = 160) -> DataFrame:
    """(ident, k, line_no, line): at most ``n`` lines of each text, those that match ``pattern`` first, equal beginnings once (a preview)."""
    rows = lines(df, column, ident).withColumn("line", squash(F.col("line"))).where("line <> ''")
    once = rows.groupBy(ident, F.substring("line", 1, prefix).alias("_head")).agg(F.min(F.struct("line_no", "line")).alias("m"))
    rows = once.select(ident, "m.line_no", "m.line").withColumn("rank", F.when(F.col("line").rlike(pattern), 0).otherwise(1))
    k = F.row_number().over(Window.partitionBy(ident).orderBy("rank", "line_no"))
    return rows.withColumn("k", k).where(F.col("k") <= n).select(ident, "k", "line_no", "line")


def compacted(pages: DataFrame, ident: str, page: str, text: str, limit: int, head: int = 3, tail: int = 2) -> DataFrame:
    """(ident, text): a short document whole; of a long one the first ``head`` and the last ``tail`` pages (a preview)."""
    per = pages.groupBy(ident).agg(F.sum(F.length(text)).alias("_size"), F.max(page).alias("_last"))
    rows = pages.join(per, ident).where((F.col("_size") <= limit) | (F.col(page) <= head) | (F.col(page) > F.col("_last") - tail))
    return rows.groupBy(ident).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(page, text))), lambda p: p[text]), "\n").alias("text"))


def math_segments(x: Column) -> Column:
    """Formulas between single dollars, in order."""
    return F.regexp_extract_all(x, F.lit(r"\$([^$]*)\$"), F.lit(1))


def markdown_rows(df: DataFrame, column: str, *keep: str) -> DataFrame:
    """(keep, line_no, cells) of the rows of Markdown tables, without the rule below a head."""
    rows = lines(df, column, *keep).where(F.col("line").rlike(r"^\s*\|.*\|\s*$") & ~F.col("line").rlike(r"^[\s|:\-]+$"))
    inner = F.regexp_replace(F.trim("line"), r"^\||\|$", "")
    return rows.select(*keep, "line_no", F.transform(F.split(inner, r"\|", -1), lambda c: F.trim(c)).alias("cells"))


def questions(df: DataFrame, column: str, *keep: str, marker: str = r"(?iu)(?:câu|question)\s*(\d+)\s*[.:)]") -> DataFrame:
    """(keep, ordinal, number, stem, options, answer): questions of a text from marker to marker, with the letter of its answer key if it has one."""
    pieces = F.split(F.regexp_replace(column, marker, "\u0001$1\u0002"), "\u0001", -1)
    rows = df.select(*keep, answer_key(F.col(column)).alias("_key"), F.posexplode(pieces).alias("ordinal", "_piece")).where("ordinal > 0")
    number = F.regexp_extract("_piece", "^([0-9]+)\u0002", 1).cast("int")
    body = F.regexp_replace("_piece", "^[0-9]+\u0002", "")
    options = F.filter(F.split(body, "\n", -1), lambda line: line.rlike(OPTION_LINE))
    return rows.select(*keep, "ordinal", number.alias("number"), stem(body).alias("stem"), F.transform(options, lambda o: squash(F.regexp_extract(o, OPTION_LINE, 2))).alias("options"), F.try_element_at("_key", number).alias("answer"))


def text_issues(x: Column, limit: int = 1200) -> list[tuple[str, Column]]:
    """Rules for damaged texts: private-use glyphs, lost encodings, overlong answers."""
    return [
        ("private_glyphs", x.rlike(r"[\x{E000}-\x{F8FF}]")),
        ("lost_encoding", (F.length(x) - F.length(F.replace(x, F.lit("?"))) >= 5) | x.rlike(r"[A-Za-z]\?\?")),
        ("overlong", F.length(x) > limit),
    ]


def dangling(x: Column) -> Column:
    """Whether a text ends in a word that needs another one."""
    # Words that no phrase ends with.
    return F.lower(x).rlike(r"(?:^|\s)(?:of|to|in|for|with|the|a|an|and|or|của|cho|với|và|hoặc|từ|đến)\s*$")
