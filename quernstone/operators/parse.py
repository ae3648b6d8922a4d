"""Parsers: one text in, several rows out."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quernstone.functions.text import squash

#: An option line of a scanned block: a letter, a mark, the text.
OPTION_LINE = r"^\s*([A-F])\s*[.):]\s*(.*)$"
#: What begins a question, and what begins a context that questions share.
QUESTION = re.compile(r"(?m)^\s*(?:câu|question|bài)\s*(\d+)\s*[.:)]", re.IGNORECASE)
CONTEXT = re.compile(r"(?im)^\s*(?:read the following|đọc đoạn|đọc văn bản|passage|mark the letter)")


def lines(df: DataFrame, column: str, *keep: str) -> DataFrame:
    """A row for each line, counted from 1."""
    return df.select(*keep, F.posexplode(F.split(column, "\n", -1)).alias("line_no", "line")).withColumn("line_no", F.col("line_no") + 1)


def option_lines(df: DataFrame, column: str, *keep: str) -> DataFrame:
    """(keep, line_no, letter, option) of the option lines of a block."""
    rows = lines(df, column, *keep).where(F.col("line").rlike(OPTION_LINE))
    return rows.select(*keep, "line_no", F.regexp_extract("line", OPTION_LINE, 1).alias("letter"), squash(F.regexp_extract("line", OPTION_LINE, 2)).alias("option"))


def stem(text: Column) -> Column:
    """The text before its first option line, on one line."""
    kept = F.aggregate(
        F.split(text, "\n", -1),
        F.struct(F.lit("").alias("text"), F.lit(False).alias("over")),
        lambda s, line: F.struct(
            F.when(s["over"] | line.rlike(OPTION_LINE), s["text"]).otherwise(F.concat(s["text"], F.lit(" "), line)).alias("text"),
            (s["over"] | line.rlike(OPTION_LINE)).alias("over"),
        ),
    )
    return squash(kept["text"])


def answer_key(text: Column, least: int = 5) -> Column:
    """Map number -> letter of an answer key such as "1. A 2-B 3C"; the last entry of a number holds; null below ``least`` entries."""
    numbers = F.regexp_extract_all(text, F.lit(r"(\d+)\s*[-.:)]?\s*([A-D])(?![A-Za-z])"), F.lit(1))
    letters = F.regexp_extract_all(text, F.lit(r"(\d+)\s*[-.:)]?\s*([A-D])(?![A-Za-z])"), F.lit(2))
    # later entries first, then the first of each number
    pairs = F.reverse(F.transform(numbers, lambda n, k: F.named_struct(F.lit("n"), n, F.lit("l"), F.get(letters, k))))
    last = F.filter(pairs, lambda p, k: F.size(F.filter(F.slice(pairs, 1, k), lambda q: q["n"] == p["n"])) == 0)
    return F.when(F.size(numbers) >= least, F.map_from_arrays(F.transform(last, lambda p: p["n"].cast("int")), F.transform(last, lambda p: p["l"])))


def coded_blocks(df: DataFrame, column: str, *keep: str, pattern: str = r"\[IT\d{6,}\]", least: int = 12) -> DataFrame:
    """(keep, ordinal, code, block) of the blocks that begin with a code."""
    parts = F.posexplode(F.split(column, rf"(?={pattern})", -1)).alias("ordinal", "block")
    rows = df.select(*keep, parts).where(F.col("block").rlike("^" + pattern))
    return rows.select(*keep, "ordinal", F.regexp_extract("block", pattern, 0).alias("code"), squash("block").alias("block")).where(F.length("block") >= least)


def exam_items(df: DataFrame, column: str, *keep: str, part: str = r"(?iu)(?:PHẦN|PART)\s+(III|II|I|[1-3])\b", marker: str = r"(?iu)(?:câu|question)\s*(\d+)\s*[.:)]") -> DataFrame:
    """(keep, part, number, body) of a text divided by headings of parts and, inside each, by question markers.

    Questions before the first heading have part null; what stands before the first marker of a part belongs to no question.
    """
    parts = F.split(F.regexp_replace(column, part, "\u0001$1\u0002"), "\u0001", -1)
    rows = df.select(*keep, F.posexplode(parts).alias("part_no", "_part"))
    named = rows.select(*keep, "part_no", F.when(F.col("part_no") > 0, F.upper(F.substring_index("_part", "\u0002", 1))).alias("part"), F.when(F.col("part_no") > 0, F.regexp_replace("_part", "^[^\u0002]*\u0002", "")).otherwise(F.col("_part")).alias("_text"))
    pieces = F.split(F.regexp_replace("_text", marker, "\u0001$1\u0002"), "\u0001", -1)
    found = named.select(*keep, "part_no", "part", F.posexplode(pieces).alias("ordinal", "_piece")).where("ordinal > 0")
    return found.select(*keep, "part_no", "part", "ordinal", F.substring_index("_piece", "\u0002", 1).cast("int").alias("number"), F.regexp_replace("_piece", "^[^\u0002]*\u0002", "").alias("body"))


def one_chunk(text: Column, number: Column) -> Column:
    """The text of one question, from its marker to the next one; null if the text hasn't it."""
    pieces = F.split(F.regexp_replace(text, r"(?iu)(?:câu|question)\s*(\d+)\s*[.:)]", "\u0001$1\u0002"), "\u0001", -1)
    head = F.concat(number.cast("string"), F.lit("\u0002"))
    return F.trim(F.substring_index(F.get(F.filter(pieces, lambda p: p.startswith(head)), F.lit(0)), "\u0002", -1))


def chosen_letter(text: Column) -> Column:
    """The letter that a solution says it chooses; null without one."""
    letter = F.upper(F.regexp_extract(text, r"(?iu)(?:chọn|choose)\s*(?:đáp án|option)?\s*:?\s*([A-D])\b", 1))
    return F.when(letter != "", letter)


def question_segments(df: DataFrame, key: str, column: str) -> DataFrame:
    """(key, segment_no, context, question_no, question): questions with the context that stands before them.

    A context cue closes the segment before it; a text before the first question is its context.
    """
    kind = df.schema[key].dataType
    schema = T.StructType([T.StructField(key, kind), *(T.StructField(n, t) for n, t in (("segment_no", T.IntegerType()), ("context", T.StringType()), ("question_no", T.IntegerType()), ("question", T.StringType())))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: tuple[list, ...] = ([], [], [], [], [])
            for k, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for row in _segments(text or ""):
                    for column_, x in zip(rows, (k, *row), strict=True):
                        column_.append(x)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows[0], batch.column(0).type), pa.array(rows[1], pa.int32()), pa.array(rows[2], pa.string()), pa.array(rows[3], pa.int32()), pa.array(rows[4], pa.string())],
                names=[f.name for f in schema],
            )

    return df.select(key, column).mapInArrow(run, schema)


def _segments(text: str) -> Iterator[tuple[int, str | None, int, str]]:
    marks = [(m.start(), m) for m in QUESTION.finditer(text)]
    if not marks:
        return
    context, segment = text[: marks[0][0]].strip() or None, 1
    for k, (start, mark) in enumerate(marks):
        end = marks[k + 1][0] if k + 1 < len(marks) else len(text)
        body = text[mark.end() : end]
        cue = CONTEXT.search(body)
        yield segment, context, int(mark.group(1)), body[: cue.start() if cue else len(body)].strip()
        if cue:
            context, segment = body[cue.start() :].strip(), segment + 1
