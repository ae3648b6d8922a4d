"""Plans over texts: exam texts parsed, answer keys, passages, cleaning, signatures, values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quernstone.functions import items, keys, text, values
from quernstone.operators import documents, linking, parse
from quernstone.plans.base import BANK, EXAM, bank, fold, number, optional, query, squash
from quernstone.plans.exam_plans import _BLOCKS, _LESSONS, _SECTION, _blocks, _lessons
from quernstone.plans.source_plans import _questions
from quernstone.runtime import least_row, table

# ---------------------------------------------------------------- exam texts: written from the tables, parsed back

_MARK = r"(?i)(?:câu|question)\s*[0-9]+\s*[.:)]|(?:phần|part)\s+(?:iii|ii|i|[1-3])\b"
_PLAIN = f"{squash(f'''regexp_replace(question_text, '{_MARK}', ' ', 'g')''')}"
_PLACES = f"""pl AS (SELECT exam_set_id, {_SECTION} AS section, question_number AS number, min(question_id) AS question_id FROM standard_exam_links WHERE exam_set_id IS NOT NULL AND {_SECTION} IS NOT NULL AND question_number IS NOT NULL GROUP BY 1, 2, 3),
px AS (SELECT pl.exam_set_id, upper(replace(section, 'part_', '')) AS part, number, {_PLAIN} AS stem, question_type, option_a, option_b, option_c, option_d, correct_answer FROM pl JOIN exam ON exam.id = pl.question_id WHERE question_text IS NOT NULL AND {_PLAIN} <> '')"""


def _places(spark: SparkSession, root: str) -> DataFrame:
    """(exam_set_id, part, number, stem, options, letter): one question for each place of an exam."""
    section = values.section_code(F.col("section_code"))
    links = table(spark, root, "standard_exam_links").select("exam_set_id", section.alias("section"), F.col("question_number").alias("number"), "question_id")
    places = links.where("exam_set_id is not null and section is not null and number is not null").groupBy("exam_set_id", "section", "number").agg(F.min("question_id").alias("id"))
    stem = text.squash(F.regexp_replace("question_text", _MARK.replace("(?i)", "(?iu)", 1), " "))
    questions = _questions(spark, root, "question_text", "question_type", "option_a", "option_b", "option_c", "option_d", "correct_answer").withColumn("stem", stem).where("stem <> ''")
    options = F.filter(F.array(*(text.squash(F.col(f"option_{k}")) for k in "abcd")), lambda o: F.coalesce(o, F.lit("")) != "")
    letter = F.when(F.col("question_type") == "multiple_choice", values.answer_letter(F.col("correct_answer")))
    return places.join(questions, "id").select("exam_set_id", F.upper(F.replace("section", F.lit("part_"), F.lit(""))).alias("part"), "number", "stem", options.alias("options"), letter.alias("letter"))


def _exam_texts(spark: SparkSession, root: str) -> DataFrame:
    """(exam_set_id, text): each exam written out with headings of parts and question markers; the questions of one exam are few."""
    lines_ = F.transform("options", lambda o, k: F.concat(F.substr(F.lit("ABCD"), k + 1, F.lit(1)), F.lit(". "), o))
    rows = _places(spark, root).withColumn("body", F.concat(F.lit("Câu "), F.col("number").cast("string"), F.lit(": "), F.array_join(F.concat(F.array("stem"), lines_), "\n")))
    per = rows.groupBy("exam_set_id", "part").agg(F.array_sort(F.collect_list(F.struct("number", "body"))).alias("q"))
    parts = per.select("exam_set_id", "part", F.concat(F.lit("PHẦN "), "part", F.lit("\n"), F.array_join(F.transform("q", lambda x: x["body"]), "\n")).alias("body"))
    return parts.groupBy("exam_set_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "body"))), lambda x: x["body"]), "\n").alias("text"))


@query(f"""WITH {EXAM}, {_PLACES} SELECT exam_set_id, part, number, sha1(stem) AS stem FROM px""")
def exam_text_items(spark: SparkSession, root: str) -> DataFrame:
    """Questions of an exam's text by part and number: what was written out comes back."""
    found = parse.exam_items(_exam_texts(spark, root), "text", "exam_set_id")
    return found.select("exam_set_id", "part", "number", F.sha1(parse.stem(F.col("body"))).alias("stem"))


@query(f"""WITH {EXAM}, {_PLACES} SELECT exam_set_id, part, count(*) AS n, min(number) AS first_number, max(number) AS last_number FROM px GROUP BY 1, 2""")
def exam_text_parts(spark: SparkSession, root: str) -> DataFrame:
    """Parts of an exam's text with the numbers that each holds."""
    found = parse.exam_items(_exam_texts(spark, root), "text", "exam_set_id")
    return found.groupBy("exam_set_id", "part").agg(F.count("*").alias("n"), F.min("number").alias("first_number"), F.max("number").alias("last_number"))


_OPTS = "list_filter([" + ", ".join(squash(f"option_{k}") for k in "abcd") + "], lambda o: coalesce(o, '') <> '')"


@query(f"""WITH {EXAM}, {_PLACES} SELECT exam_set_id, part, number, CASE WHEN len({_OPTS}) >= 2 THEN 'multiple_choice' ELSE 'open' END AS kind, CAST(len({_OPTS}) AS INTEGER) AS n_options, sha1(array_to_string({_OPTS}, '|')) AS options, substring(stem, 1, 60) AS head FROM px""")
def exam_text_rows(spark: SparkSession, root: str) -> DataFrame:
    """Rows built of an exam's text: kind by the options found, capped head, options."""
    found = parse.exam_items(_exam_texts(spark, root), "text", "exam_set_id")
    options = F.transform(F.filter(F.split("body", "\n", -1), lambda line: line.rlike(parse.OPTION_LINE)), lambda o: text.squash(F.regexp_extract(o, parse.OPTION_LINE, 2)))
    rows = found.withColumn("o", options)
    kind = F.when(F.size("o") >= 2, "multiple_choice").otherwise("open")
    return rows.select("exam_set_id", "part", "number", kind.alias("kind"), F.size("o").alias("n_options"), F.sha1(F.array_join("o", "|")).alias("options"), F.substring(parse.stem(F.col("body")), 1, 60).alias("head"))


@query(f"""WITH {EXAM}, {_PLACES} SELECT exam_set_id, sha1(stem) AS stem FROM px WHERE part = 'I' QUALIFY row_number() OVER (PARTITION BY exam_set_id ORDER BY number) = 1""")
def exam_text_chunk(spark: SparkSession, root: str) -> DataFrame:
    """The text of one question, cut out of the text of its exam by its number."""
    texts = _exam_texts(spark, root).withColumn("one", F.regexp_extract("text", r"(?s)^PHẦN I\n(.*?)(?:\nPHẦN|$)", 1)).where("text like 'PHẦN I\\n%'")
    number_ = F.regexp_extract("one", r"Câu (\d+):", 1).cast("int")
    return texts.select("exam_set_id", F.sha1(parse.stem(parse.one_chunk(F.col("one"), number_))).alias("stem"))


_LETTER_OF = f"(CASE WHEN {fold(squash('correct_answer'))} NOT IN ('n/a', 'null', 'none') AND regexp_extract({fold(squash('correct_answer'))}, '(?:^|[^a-z])([a-d])[^a-z]*$', 1) <> '' THEN upper(regexp_extract({fold(squash('correct_answer'))}, '(?:^|[^a-z])([a-d])[^a-z]*$', 1)) END)"


@query(f"""WITH {EXAM}, {_PLACES}, k AS (SELECT exam_set_id, number, {_LETTER_OF} AS letter FROM px WHERE part = 'I' AND question_type = 'multiple_choice'), n AS (SELECT exam_set_id FROM k WHERE letter IS NOT NULL GROUP BY 1 HAVING count(*) >= 5)
SELECT exam_set_id, number, letter FROM k WHERE letter IS NOT NULL AND exam_set_id IN (SELECT exam_set_id FROM n)""")
def exam_answer_keys(spark: SparkSession, root: str) -> DataFrame:
    """Answer keys written as one line and read back; a key of fewer than five entries is none."""
    known = _places(spark, root).where("part = 'I' and letter is not null")
    entry = F.concat(F.col("number").cast("string"), F.lit(". "), "letter")
    line = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("number", entry.alias("e")))), lambda x: x["e"]), "  ")
    read = known.groupBy("exam_set_id").agg(line.alias("line")).select("exam_set_id", parse.answer_key(F.col("line")).alias("key"))
    return read.where("key is not null").select("exam_set_id", F.explode("key").alias("number", "letter"))


@query(rf"""WITH {EXAM}, c AS (SELECT id, upper(regexp_extract(explanation, '(?i)(?:chọn|choose)\s*(?:đáp án|option)?\s*:?\s*([A-D])\b', 1)) AS letter FROM exam WHERE explanation IS NOT NULL) SELECT id, CASE WHEN letter <> '' THEN letter END AS letter FROM c""")
def exam_chosen_letters(spark: SparkSession, root: str) -> DataFrame:
    """The letter that each solution chooses."""
    return _questions(spark, root, "explanation").where("explanation is not null").select("id", parse.chosen_letter(F.col("explanation")).alias("letter"))


# ---------------------------------------------------------------- documents, blocks, passages

_DOCS = "d AS (SELECT doc_id, min(text) AS text FROM documents WHERE text IS NOT NULL GROUP BY 1)"


def _documents(spark: SparkSession, root: str) -> DataFrame:
    return least_row(table(spark, root, "documents").where("text is not null").select("doc_id", "text"), ["doc_id"])


@query(rf"""WITH {_DOCS}, p AS (SELECT doc_id, text, string_split(regexp_replace(text, '\(([0-9]{{1,3}})\)', chr(1) || '\1' || chr(2), 'g'), chr(1)) AS parts FROM d WHERE regexp_matches(text, '\([0-9]{{1,3}}\)'))
SELECT doc_id, TRY_CAST(list_extract(regexp_extract_all(text, '\(([0-9]{{1,3}})\)', 1), -1) AS INTEGER) AS number FROM p""")
def doc_blank_numbers(spark: SparkSession, root: str) -> DataFrame:
    """The last blank or bracketed number of each text that has one."""
    rows = _documents(spark, root).withColumn("number", items.blank_number(F.col("text")))
    return rows.where("number is not null").select("doc_id", "number")


@query(rf"""WITH {_DOCS}, n AS (SELECT doc_id, text, list_extract(regexp_extract_all(text, '\(([0-9]{{1,3}})\)', 1), -1) AS k FROM d WHERE regexp_matches(text, '\([0-9]{{1,3}}\)')), a AS (SELECT doc_id, text, length(text) - length(list_extract(string_split(text, '(' || CAST(CAST(k AS INTEGER) AS VARCHAR) || ')'), -1)) - length('(' || CAST(CAST(k AS INTEGER) AS VARCHAR) || ')') + 1 AS pos, contains(text, '(' || CAST(CAST(k AS INTEGER) AS VARCHAR) || ')') AS has FROM n)
SELECT doc_id, CASE WHEN has THEN sha1(substring(text, greatest(pos - 1300, 1), pos - greatest(pos - 1300, 1) + 1300)) END AS context FROM a""")
def doc_blank_contexts(spark: SparkSession, root: str) -> DataFrame:
    """The part of a text around its last blank."""
    rows = _documents(spark, root).withColumn("number", items.blank_number(F.col("text"))).where("number is not null")
    return rows.select("doc_id", F.sha1(items.blank_context(F.col("text"), F.col("number"))).alias("context"))


_CUE = "(?:Read |Đọc |Cho |Given |Let )"


@query(rf"""WITH {_DOCS}, p AS (SELECT doc_id, string_split(regexp_replace(text, '({_CUE})', chr(1) || '\1', 'g'), chr(1)) AS parts FROM d WHERE regexp_matches(text, '{_CUE}')) SELECT doc_id, sha1(parts[-1]) AS passage FROM p""")
def doc_last_passages(spark: SparkSession, root: str) -> DataFrame:
    """The text of each document from its last cue on."""
    rows = _documents(spark, root).withColumn("p", items.last_passage(F.col("text"), _CUE)).where("p is not null")
    return rows.select("doc_id", F.sha1("p").alias("passage"))


@query(f"""WITH {BANK}, o AS (SELECT question_id, {squash('option_d')} || CASE WHEN length(question_id) > 0 AND page_number % 2 = 0 THEN ' Read the text below.' ELSE '' END AS x FROM bank WHERE option_d IS NOT NULL AND page_number IS NOT NULL)
SELECT question_id, trim(CASE WHEN contains(x, 'Read ') THEN regexp_extract(x, '(?s)^(.*?)Read ', 1) ELSE x END) AS option, CASE WHEN contains(x, 'Read ') THEN trim(regexp_extract(x, '(?s)(Read .*)$', 1)) END AS tail FROM o""")
def qb_option_tails(spark: SparkSession, root: str) -> DataFrame:
    """Last options parted from the text that follows them."""
    rows = bank(spark, root, "option_d", "page_number").where("option_d is not null and page_number is not null")
    x = F.concat(text.squash(F.col("option_d")), F.when(F.col("page_number") % 2 == 0, " Read the text below.").otherwise(""))
    return rows.select("question_id", items.split_tail(x, "Read ").alias("s")).select("question_id", "s.option", "s.tail")


_WORDS = lambda c: f"regexp_extract_all({fold(f'''coalesce({c}, '')''')}, '[a-z]+')"


@query(f"""WITH {BANK}, w AS (SELECT question_id, {_WORDS('question_text')} AS q, {_WORDS('explanation')} AS p FROM bank WHERE explanation IS NOT NULL), k AS (SELECT question_id, p, list_filter(q, lambda x: length(x) >= 5) AS q FROM w),
o AS (SELECT question_id, p, list_slice(list_transform(list_filter(list_transform(q, lambda x, i: {{'x': x, 'first': list_position(q, x) = i}}), lambda s: s.first), lambda s: s.x), 1, 10) AS q FROM k)
SELECT question_id, len(q) >= 2 AND NOT list_has_any(q, p) AS mismatch FROM o""")
def qb_passage_mismatch(spark: SparkSession, root: str) -> DataFrame:
    """Questions none of whose first content words stands in the text that goes with them."""
    rows = bank(spark, root, "question_text", "explanation").where("explanation is not null")
    return rows.select("question_id", items.unsupported_words(F.col("question_text"), F.col("explanation")).alias("mismatch"))


@query(rf"""WITH {BANK}, c AS (SELECT question_id, question_text AS q, explanation AS e, TRY_CAST(list_extract(regexp_extract_all(question_text, '\(([0-9]{{1,3}})\)', 1), -1) AS INTEGER) AS k FROM bank WHERE question_text IS NOT NULL)
SELECT question_id, CASE WHEN k IS NOT NULL AND length(q) >= 180 THEN 'Choose the option for blank (' || CAST(k AS VARCHAR) || ').' ELSE sha1(q) END AS stem, sha1(CASE WHEN k IS NOT NULL AND length(q) >= 180 AND coalesce(trim(e), '') = '' THEN {squash('q')} ELSE e END) AS passage FROM c""")
def qb_cloze_repaired(spark: SparkSession, root: str) -> DataFrame:
    """Gap items whose stem holds the whole passage: the passage is moved and the stem asks for its blank."""
    rows = bank(spark, root, "question_text", "explanation").where("question_text is not null").withColumn("c", items.cloze(F.col("question_text"), F.col("explanation")))
    stem = F.when(F.col("c.stem") == F.col("question_text"), F.sha1("c.stem")).otherwise(F.col("c.stem"))
    return rows.select("question_id", stem.alias("stem"), F.sha1("c.passage").alias("passage"))


@query(rf"""WITH {_BLOCKS}, g AS (SELECT ordinal, raw_block, coalesce(regexp_matches(raw_block, '(?i)(?:câu|question|bài)\s*[0-9]+\s*[.:)]'), false) AS marked, len(list_filter(string_split(raw_block, chr(10)), lambda x: regexp_matches(x, '^\s*[A-F]\s*[.):]'))) AS n FROM b WHERE raw_block IS NOT NULL)
SELECT ordinal, marked AND n >= 2 AS hinted, NOT marked AND n >= 2 AS unmarked FROM g""")
def block_guard(spark: SparkSession, root: str) -> DataFrame:
    """Blocks that look like questions, and those with options that no marker announces: a parser that finds nothing there should be looked at."""
    rows = _blocks(spark, root).where("raw_block is not null")
    x = F.col("raw_block")
    n = F.size(F.filter(F.split(x, "\n", -1), lambda line: line.rlike(r"^\s*[A-F]\s*[.):]")))
    marked = x.rlike(r"(?iu)(?:câu|question|bài)\s*\d+\s*[.:)]")
    return rows.select("ordinal", items.looks_like_question(x).alias("hinted"), (~marked & (n >= 2)).alias("unmarked"))


@query(f"""WITH {BANK}, m AS (SELECT raw_document_id, arg_min(explanation, (-length(explanation), explanation)) AS longest FROM bank WHERE explanation IS NOT NULL AND raw_document_id IS NOT NULL AND source_file IS NOT NULL GROUP BY 1),
j AS (SELECT question_id, source_file, coalesce(explanation, longest) AS t FROM bank LEFT JOIN m USING (raw_document_id) WHERE source_file IS NOT NULL)
SELECT question_id, sha1(coalesce(t, last_value(t IGNORE NULLS) OVER (PARTITION BY source_file ORDER BY question_id ROWS UNBOUNDED PRECEDING))) AS digest FROM j""")
def qb_passages_filled(spark: SparkSession, root: str) -> DataFrame:
    """Texts completed by the longest of their raw document, else by the last one before in the file."""
    rows = bank(spark, root, "source_file", "raw_document_id", "explanation").where("source_file is not null")
    return linking.filled(rows, ["source_file"], "raw_document_id", "question_id", "explanation").select("question_id", F.sha1("explanation").alias("digest"))


@query(f"""WITH {EXAM} SELECT id, array_to_string(list_transform(statements, lambda s, i: coalesce(lower(s.label), substring('abcdefgh', i, 1)) || '=' || coalesce(CASE WHEN i % 2 = 1 AND s.label IS NOT NULL THEN 'vì ' || coalesce(s.text, '') END, '-')), '|') AS explained FROM exam WHERE statements IS NOT NULL""")
def exam_explained_statements(spark: SparkSession, root: str) -> DataFrame:
    """Explanations, given for every other label in capitals, put beside the statements of their label."""
    given = F.filter(F.transform("statements", lambda s, k: F.struct(F.upper(s["label"]).alias("label"), F.concat(F.lit("vì "), F.coalesce(s["text"], F.lit(""))).alias("text"), (k % 2).alias("odd"))), lambda e: (e["odd"] == 0) & e["label"].isNotNull())
    rows = _questions(spark, root, "statements").where("statements is not null").withColumn("e", given)
    both = items.with_explanations(F.col("statements"), F.col("e"))
    return rows.select("id", F.array_join(F.transform(both, lambda s: F.concat(s["label"], F.lit("="), F.coalesce(s["explanation"], F.lit("-")))), "|").alias("explained"))


@query(f"""WITH {BANK}, r AS (SELECT question_id, raw_text FROM bank WHERE json_valid(raw_text)) SELECT question_id, 'checked' AS topic, sha1(json_extract_string(raw_text, '$.question_text')) AS digest FROM r""")
def qb_raw_updated(spark: SparkSession, root: str) -> DataFrame:
    """A field set inside the page items, the rest of them kept."""
    valid = F.try_parse_json(F.col("raw_text")).isNotNull()
    rows = bank(spark, root, "raw_text").where(valid).withColumn("now", items.json_with(F.col("raw_text"), "question_text string, topic string", "topic", F.lit("checked")))
    return rows.select("question_id", F.get_json_object("now", "$.topic").alias("topic"), F.sha1(F.get_json_object("now", "$.question_text")).alias("digest"))


@query(f"""WITH {BANK} SELECT question_id, array_to_string([CAST(floor(least(greatest(visual_bbox[1] - 0.01, 0.0), 1.0) * 1000) AS INTEGER), CAST(floor(least(greatest(visual_bbox[2] - 0.01, 0.0), 1.0) * 1400) AS INTEGER), CAST(floor(least(greatest(visual_bbox[3] + 0.01, 0.0), 1.0) * 1000) AS INTEGER), CAST(floor(least(greatest(visual_bbox[4] + 0.01, 0.0), 1.0) * 1400) AS INTEGER)], ',') AS pixels FROM bank WHERE len(visual_bbox) = 4""")
def qb_crops(spark: SparkSession, root: str) -> DataFrame:
    """Pixels of the figures on a page of 1,000 by 1,400."""
    rows = bank(spark, root, "visual_bbox").where("size(visual_bbox) = 4")
    box = items.clip_box(F.col("visual_bbox"), F.lit(1000), F.lit(1400))
    return rows.select("question_id", F.array_join(F.transform(box, lambda k: k.cast("string")), ",").alias("pixels"))


# ---------------------------------------------------------------- one plan for each text function


@query(f"""WITH {BANK} SELECT question_id, {optional('subtopic')} AS subtopic FROM bank""")
def qb_optional(spark: SparkSession, root: str) -> DataFrame:
    """Subtopics with the spellings of no value as null."""
    return bank(spark, root, "subtopic").select("question_id", text.optional(F.col("subtopic")).alias("subtopic"))


@query(f"""WITH {BANK} SELECT question_id, sha1({fold('question_text')}) AS folded, sha1({squash('question_text')}) AS squashed FROM bank WHERE question_text IS NOT NULL""")
def qb_folded(spark: SparkSession, root: str) -> DataFrame:
    """Texts without accents and case, and with single spaces."""
    rows = bank(spark, root, "question_text").where("question_text is not null")
    return rows.select("question_id", F.sha1(text.fold(F.col("question_text"))).alias("folded"), F.sha1(text.squash(F.col("question_text"))).alias("squashed"))


@query(f"""WITH {_BLOCKS}, s AS (SELECT ordinal, string_split(raw_block, chr(10)) AS x FROM b WHERE raw_block IS NOT NULL), c AS (SELECT ordinal, x, list_position(list_transform(x, lambda v: regexp_matches(v, '^\\s*[A-F]\\s*[.):]')), true) AS cut FROM s)
SELECT ordinal, sha1(array_to_string(CASE WHEN coalesce(cut, 0) > 0 THEN list_slice(x, 1, cut - 1) ELSE x END, chr(10))) AS digest FROM c""")
def block_stems(spark: SparkSession, root: str) -> DataFrame:
    """Blocks up to their first option line."""
    return _blocks(spark, root).where("raw_block is not null").select("ordinal", F.sha1(text.truncated_at(F.col("raw_block"), r"^\s*[A-F]\s*[.):]")).alias("digest"))


@query(f"""WITH {_DOCS}, p AS (SELECT doc_id, list_filter(string_split(regexp_replace(text, '\\n\\s*\\n', chr(1), 'g'), chr(1)), lambda x: NOT regexp_matches(trim(x), '^(?:#|[0-9]+[.)])')) AS kept FROM d) SELECT doc_id, sha1(array_to_string(kept, chr(10) || chr(10))) AS digest FROM p""")
def doc_without_headings(spark: SparkSession, root: str) -> DataFrame:
    """Documents without the paragraphs that begin as headings and numbered points do."""
    return _documents(spark, root).select("doc_id", F.sha1(items.without_paragraphs(F.col("text"), r"#|[0-9]+[.)]")).alias("digest"))


@query(f"""WITH {_LESSONS}, t AS (SELECT lesson_id, trim(regexp_replace({squash('analysis.lesson_title')}, '^[0-9]+[.)-]?\\s*', '')) AS x FROM l WHERE analysis.lesson_title IS NOT NULL) SELECT lesson_id, upper(substring(x, 1, 1)) || substring(x, 2) AS title FROM t""")
def lesson_display_titles(spark: SparkSession, root: str) -> DataFrame:
    """Titles without numbering, their first letter in upper case."""
    return _lessons(spark, root).where("analysis.lesson_title is not null").select("lesson_id", text.display_title(F.col("analysis.lesson_title")).alias("title"))


@query(f"""WITH {BANK} SELECT question_id, sha1(replace(replace(replace(replace(question_text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;')) AS digest FROM bank WHERE question_text IS NOT NULL""")
def qb_escaped(spark: SparkSession, root: str) -> DataFrame:
    """Texts made safe for HTML."""
    return bank(spark, root, "question_text").where("question_text is not null").select("question_id", F.sha1(text.escape_html(F.col("question_text"))).alias("digest"))


@query(f"""WITH {BANK} SELECT question_id, sha1({squash(fold("coalesce(question_type, '')"))} || chr(10) || {squash(fold("coalesce(question_text, '')"))}) AS signature FROM bank""")
def qb_folded_signature(spark: SparkSession, root: str) -> DataFrame:
    """The looser fingerprint, in which neither accents nor case count."""
    return bank(spark, root, "question_type", "question_text").select("question_id", keys.folded_signature(F.col("question_type"), F.col("question_text")).alias("signature"))


@query(f"""WITH {BANK} SELECT question_id, coalesce(source_file, '') || '|' || coalesce(CAST(page_number AS VARCHAR), '') || '|' || sha1(CASE WHEN coalesce(substring({squash("lower(coalesce(option_a, ''))")}, 1, 600), '') <> '' THEN substring({squash("lower(coalesce(option_a, ''))")}, 1, 600) ELSE substring({squash('lower(question_text)')}, 1, 240) END) AS k FROM bank WHERE question_text IS NOT NULL AND source_file IS NOT NULL""")
def qb_content_keys(spark: SparkSession, root: str) -> DataFrame:
    """Keys of file, number and what the question holds."""
    rows = bank(spark, root, "source_file", "page_number", "option_a", "question_text").where("question_text is not null and source_file is not null")
    key = keys.content_key(F.lit("x"), F.lit(None).cast("int"), F.coalesce("option_a", F.lit("")), F.col("question_text"))
    content = F.regexp_replace(key, r"^x\|\|", "")
    return rows.select("question_id", F.concat_ws("|", "source_file", F.coalesce(F.col("page_number").cast("string"), F.lit("")), F.sha1(content)).alias("k"))


@query(f"""WITH {EXAM} SELECT id, {number('numeric_answer')} AS value FROM exam WHERE numeric_answer IS NOT NULL""")
def exam_numbers(spark: SparkSession, root: str) -> DataFrame:
    """Numeric answers as numbers."""
    return _questions(spark, root, "numeric_answer").where("numeric_answer is not null").select("id", values.numeric_answer(F.col("numeric_answer")).alias("value"))


@query(f"""WITH {EXAM}, s AS (SELECT id, unnest(statements) AS s FROM exam WHERE statements IS NOT NULL) SELECT id, count(*) FILTER (s.answer) AS n_true, count(*) FILTER (NOT s.answer) AS n_false, count(*) FILTER (s.answer IS NULL) AS n_open FROM s GROUP BY 1""")
def exam_truths(spark: SparkSession, root: str) -> DataFrame:
    """True, false and open statements of each question, read from their words."""
    rows = _questions(spark, root, "statements").where("statements is not null").select("id", F.explode("statements").alias("s"))
    read = values.boolean(F.when(F.col("s.answer"), "Đúng").when(~F.col("s.answer"), "SAI").otherwise("?"))
    return rows.select("id", read.alias("b")).groupBy("id").agg(F.count_if("b").alias("n_true"), F.count_if(~F.col("b")).alias("n_false"), F.count_if(F.col("b").isNull()).alias("n_open"))


@query(rf"""WITH {_DOCS}, l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS line_no FROM d)
SELECT doc_id, CAST(line_no AS INTEGER) AS line_no, CAST(len(string_split(regexp_replace(trim(line), '^\||\|$', '', 'g'), '|')) AS INTEGER) AS n_cells FROM l WHERE regexp_matches(line, '^\s*\|.*\|\s*$') AND NOT regexp_matches(line, '^[\s|:\-]+$')""")
def doc_table_rows(spark: SparkSession, root: str) -> DataFrame:
    """Rows of the tables inside documents."""
    return documents.markdown_rows(_documents(spark, root), "text", "doc_id").select("doc_id", "line_no", F.size("cells").alias("n_cells"))
