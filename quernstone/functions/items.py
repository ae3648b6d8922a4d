"""Column expressions over question items: statements, lists, tables, flags, boxes, nested JSON."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quernstone.functions.text import fold, squash

# Folded words that tell of figures, tables, grouped data and true/false questions.
FIGURE_WORDS = ("hinh ve", "hinh ben", "do thi", "bang bien thien", "figure", "diagram", "graph")
TABLE_WORDS = ("bang so lieu", "bang sau", "bang tan so", "the table", "following table")
GROUPED_WORDS = ("ghep nhom", "tan so", "trung vi", "tu phan vi", "grouped data")
JUDGE_WORDS = ("dung hay sai", "menh de nao dung", "khang dinh nao", "true or false", "which statement")


def mentions(x: Column, words: tuple[str, ...]) -> Column:
    """Whether the folded text has one of the words; null counts as no."""
    folded = F.coalesce(fold(x), F.lit(""))
    out = F.lit(False)
    for word in words:
        out = out | folded.contains(word)
    return out


def needs_image(x: Column, all_pages: bool = False, least: int = 800) -> Column:
    """Whether a page has to be looked at as an image: always, or as its text is short or speaks of figures."""
    return F.lit(all_pages) | (F.length(F.coalesce(x, F.lit(""))) < least) | mentions(x, FIGURE_WORDS)


def looks_like_question(x: Column) -> Column:
    """A question marker and two options at least."""
    return F.coalesce(x.rlike(r"(?iu)(?:câu|question|bài)\s*\d+\s*[.:)]") & (F.regexp_count(x, F.lit(r"(?m)^\s*[A-F]\s*[.):]")) >= 2), F.lit(False))


def is_question(x: Column) -> Column:
    """A text that asks: it ends with a question mark or begins as questions do."""
    folded = fold(squash(x))
    return F.coalesce(folded.endswith("?") | folded.rlike("^(?:tinh|tim|hoi|hay|cho biet|what|which|how|why|find|choose)\\b"), F.lit(False))


def is_answerable(stem: Column, options: Column, statements: Column) -> Column:
    """A stem that is no placeholder, with two options or some statement."""
    real = ~F.coalesce(fold(squash(stem)), F.lit("")).isin("", "null", "n/a", "...", "placeholder", "question text")
    return real & ((F.size(F.filter(options, lambda o: F.coalesce(F.trim(o), F.lit("")) != "")) >= 2) | (F.coalesce(F.size(statements), F.lit(0)) > 0))


def clipped(x: Column, n: int) -> Column:
    """The first ``n`` filled, trimmed elements (a preview)."""
    return F.slice(F.filter(F.transform(x, lambda s: F.trim(s)), lambda s: F.coalesce(s, F.lit("")) != ""), 1, n)


def truth_letters(x: Column) -> Column:
    """D and S of the usual spellings of four true/false answers; null if there aren't four."""
    folded = F.regexp_replace(F.regexp_replace(fold(x), r"\b(?:dung|true)\b", "d"), r"\b(?:sai|false)\b", "s")
    letters = F.upper(F.regexp_replace(folded, "[^ds]", ""))
    return F.when(letters.rlike("^[DS]{4}$"), letters)


def with_truths(statements: Column, letters: Column) -> Column:
    """Four statements, padded and labelled a to d, their answers set from letters such as DSDS."""
    at = lambda k: F.get(statements, k)
    return F.transform(
        F.sequence(F.lit(0), F.lit(3)),
        lambda k: F.named_struct(
            F.lit("label"), F.coalesce(at(k)["label"], F.substr(F.lit("abcd"), k + 1, F.lit(1))), F.lit("text"), at(k)["text"],
            F.lit("answer"), F.when(F.substr(letters, k + 1, F.lit(1)) == "D", True).when(F.substr(letters, k + 1, F.lit(1)) == "S", False).otherwise(at(k)["answer"]),
        ),
    )


def without_answers(statements: Column) -> Column:
    return F.transform(statements, lambda s: s.withField("answer", F.lit(None).cast("boolean")))


def with_explanations(statements: Column, explanations: Column) -> Column:
    """Statements with the explanation of their label, the first given for it; a statement without a label has that of its place."""
    label = lambda s, k: F.lower(F.coalesce(s["label"], F.substr(F.lit("abcdefgh"), k + 1, F.lit(1))))
    return F.transform(
        statements, lambda s, k: F.named_struct(F.lit("label"), label(s, k), F.lit("text"), s["text"], F.lit("explanation"), F.get(F.filter(explanations, lambda e: F.lower(e["label"]) == label(s, k)), F.lit(0))["text"])
    )


def clean_table(rows: Column) -> Column:
    """Rows of labelled cells, trimmed; rows without a label and a filled cell go."""
    made = F.transform(rows, lambda r: F.named_struct(F.lit("label"), F.trim(F.coalesce(r["label"], F.lit(""))), F.lit("cells"), F.transform(r["cells"], lambda c: F.trim(F.coalesce(c, F.lit(""))))))
    return F.filter(made, lambda r: (r["label"] != "") | F.exists(r["cells"], lambda c: c != ""))


def page_range(x: Column) -> Column:
    """First and last page named by tags such as [PAGE 12]; null without any."""
    pages = F.transform(F.regexp_extract_all(x, F.lit(r"\[PAGE (\d+)\]"), F.lit(1)), lambda p: p.cast("int"))
    return F.when(F.size(pages) > 0, F.struct(F.array_min(pages).alias("first"), F.array_max(pages).alias("last")))


def clip_box(box: Column, width: Column, height: Column, margin: float = 0.01) -> Column:
    """Pixels of a box of fractions, widened by ``margin`` and clipped to the page."""
    at = lambda k, d, size: F.floor(F.least(F.greatest(F.get(box, k) + d, F.lit(0.0)), F.lit(1.0)) * size).cast("int")
    return F.array(at(0, -margin, width), at(1, -margin, height), at(2, margin, width), at(3, margin, height))


def without_paragraphs(x: Column, begins: str) -> Column:
    """The paragraphs that don't begin as ``begins`` says; each is tested on its own, so stacked ones all go."""
    return F.array_join(F.filter(F.split(x, r"\n\s*\n", -1), lambda p: ~F.trim(p).rlike("^(?:" + begins + ")")), "\n\n")


def json_with(raw: Column, element: str, name: str, value: Column) -> Column:
    """JSON text with a field set; ``element`` is the DDL of the fields that are kept.  Unreadable JSON stays as it is."""
    parsed = F.from_json(raw, element)
    return F.coalesce(F.to_json(parsed.withField(name, value)), raw)


def unsupported_words(question: Column, passage: Column, n: int = 10) -> Column:
    """Whether the question has two content words or more and none of its first ``n`` stands in the passage."""
    words = F.slice(F.array_distinct(F.filter(F.regexp_extract_all(fold(F.coalesce(question, F.lit(""))), F.lit("[a-z]+"), F.lit(0)), lambda w: F.length(w) >= 5)), 1, n)
    there = F.regexp_extract_all(fold(F.coalesce(passage, F.lit(""))), F.lit("[a-z]+"), F.lit(0))
    return (F.size(words) >= 2) & (F.size(F.array_intersect(words, there)) == 0)


def blank_number(stem: Column) -> Column:
    """The number of the blank that a stem asks for, such as (12) or (12)____; the last one if there are several."""
    return F.try_element_at(F.regexp_extract_all(stem, F.lit(r"\((\d{1,3})\)"), F.lit(1)), F.lit(-1)).try_cast("int")


def cloze(stem: Column, passage: Column, least: int = 180) -> Column:
    """(stem, passage) of a gap item: a stem that holds its whole passage gives it up and asks for the blank by number; others stay."""
    number = blank_number(stem)
    holds = number.isNotNull() & (F.length(stem) >= least)
    asked = F.concat(F.lit("Choose the option for blank ("), number.cast("string"), F.lit(")."))
    return F.struct(F.when(holds, asked).otherwise(stem).alias("stem"), F.when(holds & (F.coalesce(F.trim(passage), F.lit("")) == ""), squash(stem)).otherwise(passage).alias("passage"))


def blank_context(text: Column, number: Column, before: int = 1300, after: int = 1300) -> Column:
    """The part of ``text`` around the last place where blank ``number`` stands; null without one."""
    mark = F.concat(F.lit("("), number.cast("string"), F.lit(")"))
    at = F.length(text) - F.length(F.call_function("substring_index", text, mark, F.lit(-1))) - F.length(mark) + 1
    begin = F.greatest(at - before, F.lit(1))
    return F.when(F.contains(text, mark), F.substr(text, begin, at - begin + after))


def last_passage(x: Column, cue: str) -> Column:
    """The text from the last cue on; null without one."""
    parts = F.split(x, f"(?={cue})", -1)
    return F.when(x.rlike(cue), F.element_at(parts, -1))


def split_tail(option: Column, cue: str) -> Column:
    """An option and the text after it that belongs to the next context."""
    cut = F.regexp_instr(option, F.lit(cue))
    return F.when(cut > 0, F.struct(F.trim(F.substr(option, F.lit(1), cut - 1)).alias("option"), F.trim(F.substr(option, cut)).alias("tail"))).otherwise(
        F.struct(F.trim(option).alias("option"), F.lit(None).cast("string").alias("tail"))
    )
