"""Plans that link, compact, parse and check."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quernstone.functions import text, values
from quernstone.operators import documents, exams, linking, mapping, providers, quality, sequences
from quernstone.plans.bank_plans import _LETTER
from quernstone.plans.base import BANK, EXAM, bank, fold, query, squash, tokens
from quernstone.plans.exam_plans import _LESSONS, _lessons
from quernstone.runtime import least_row, table


@query(f"""WITH {BANK}, i AS (SELECT question_id, list_filter([CASE WHEN regexp_matches(question_text, '[\\x{{E000}}-\\x{{F8FF}}]') THEN 'private_glyphs' END,
CASE WHEN length(question_text) - length(replace(question_text, '?', '')) >= 5 OR regexp_matches(question_text, '[A-Za-z]\\?\\?') THEN 'lost_encoding' END,
CASE WHEN length(question_text) > 1200 THEN 'overlong' END], lambda x: x IS NOT NULL) AS issues FROM bank)
SELECT question_id, array_to_string(issues, '; ') AS reason_text FROM i WHERE len(issues) > 0""")
def qb_text_issues(spark: SparkSession, root: str) -> DataFrame:
    """Questions with damaged texts."""
    marked = quality.gate(bank(spark, root, "question_text"), documents.text_issues(F.col("question_text")))
    return marked.where("not accepted").select("question_id", "reason_text")


@query(f"""WITH {BANK} SELECT question_id, CAST(len(regexp_extract_all(question_text, '\\$([^$]*)\\$', 1)) AS INTEGER) AS n_formulas, sha1(array_to_string(regexp_extract_all(question_text, '\\$([^$]*)\\$', 1), '|')) AS digest FROM bank WHERE question_text IS NOT NULL""")
def qb_formulas(spark: SparkSession, root: str) -> DataFrame:
    """Formulas of each question."""
    rows = bank(spark, root, "question_text").where("question_text is not null").withColumn("f", documents.math_segments(F.col("question_text")))
    return rows.select("question_id", F.size("f").alias("n_formulas"), F.sha1(F.array_join("f", "|")).alias("digest"))


@query("""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS line_no FROM (SELECT DISTINCT doc_id, text FROM documents WHERE text IS NOT NULL)),
s AS (SELECT doc_id, line_no, """ + squash("line") + """ AS line FROM l), o AS (SELECT doc_id, min(line_no) AS line_no, arg_min(line, line_no) AS line FROM s WHERE line <> '' GROUP BY doc_id, substring(line, 1, 160))
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY CASE WHEN regexp_matches(line, '^#|[0-9]+[.:]') THEN 0 ELSE 1 END, line_no) AS INTEGER) AS k, CAST(line_no AS INTEGER) AS line_no, sha1(line) AS digest FROM o QUALIFY k <= 5""")
def doc_key_lines(spark: SparkSession, root: str) -> DataFrame:
    """Five telling lines of each document (a preview)."""
    rows = table(spark, root, "documents").where("text is not null").select("doc_id", "text").distinct()
    return documents.key_lines(rows, "doc_id", "text", "^#|[0-9]+[.:]", 5).select("doc_id", "k", "line_no", F.sha1("line").alias("digest"))


@query(f"""WITH {_LESSONS}, {EXAM}, c AS (SELECT lesson_id, unnest(analysis.concepts) AS subtopic, analysis.lesson_type AS kind, analysis.phase AS phase FROM l),
p AS (SELECT DISTINCT exam.id, lesson_id, coalesce(kind = 'practice', false) AS a, coalesce(phase = 'core', false) AS b FROM exam JOIN c USING (subtopic)),
q AS (SELECT * FROM p QUALIFY a OR NOT bool_or(a) OVER (PARTITION BY id)), r AS (SELECT * FROM q QUALIFY b OR NOT bool_or(b) OVER (PARTITION BY id))
SELECT id, array_to_string(list_slice(list_sort(list_distinct(list(lesson_id))), 1, 5), ',') AS lessons FROM r GROUP BY id""")
def exam_lesson_links(spark: SparkSession, root: str) -> DataFrame:
    """Up to five lessons for each exam question: of its subtopic, practice and core ones if there are any.

    A question has one subtopic and takes its lessons, so these are narrowed once a subtopic; questions times lessons are never paired.
    """
    concepts = _lessons(spark, root).where("analysis is not null").select("lesson_id", F.explode("analysis.concepts").alias("subtopic"), F.col("analysis.lesson_type").alias("kind"), F.col("analysis.phase").alias("phase"))
    linked = linking.narrowed(concepts, "subtopic", "lesson_id", [F.col("kind") == "practice", F.col("phase") == "core"], 5)
    lessons = linked.select("subtopic", F.array_join(F.transform("nodes", lambda n: n.cast("string")), ",").alias("lessons"))
    questions = exams.one_question(table(spark, root, "standard_exam_questions").select("id", "subtopic", "created_at"))
    return questions.join(lessons, "subtopic").select("id", "lessons")


@query(f"""WITH {_LESSONS} SELECT DISTINCT source_name, value FROM (SELECT source_name, unnest(analysis.prerequisites) AS value FROM l)
EXCEPT SELECT source_name, unnest(analysis.concepts) FROM l""")
def lesson_missing_prerequisites(spark: SparkSession, root: str) -> DataFrame:
    """What lessons of a source require and none of them teaches."""
    rows = _lessons(spark, root)
    needed = rows.select("source_name", F.explode("analysis.prerequisites").alias("value"))
    taught = rows.select("source_name", F.explode("analysis.concepts").alias("value"))
    return linking.required_but_missing(needed, taught, "source_name", "value")


@query(f"""WITH {_LESSONS}, m AS (SELECT lesson_id, analysis.program_area AS area, CASE WHEN analysis.lesson_type = 'review' AND len(analysis.concepts) > 0 THEN (SELECT any_value(t.topic_title) FROM canonical_subtopics s JOIN canonical_topics t ON t.id = s.topic_id WHERE s.subtopic_title = analysis.concepts[1]) END AS goes_to FROM l WHERE analysis IS NOT NULL),
u AS (SELECT coalesce(goes_to, area) AS unit, count(*) AS n, min(lesson_id) AS first_lesson FROM m WHERE coalesce(goes_to, area) IS NOT NULL GROUP BY 1)
SELECT unit, n, CAST(row_number() OVER (ORDER BY first_lesson, unit) AS INTEGER) AS unit_no FROM u""")
def lesson_regrouped(spark: SparkSession, root: str) -> DataFrame:
    """Units after review lessons moved to the topic of their first concept; empty units go, the others are numbered."""
    rows = _lessons(spark, root).where("analysis is not null").select("lesson_id", F.col("analysis.program_area").alias("unit"), F.col("analysis.lesson_type").alias("kind"), F.get("analysis.concepts", 0).alias("subtopic_title"))
    topics = table(spark, root, "canonical_topics").select(F.col("id").alias("topic_id"), F.col("topic_title").alias("to"))
    home = table(spark, root, "canonical_subtopics").select("subtopic_title", "topic_id").join(F.broadcast(topics), "topic_id")
    moves = rows.where("kind = 'review'").join(F.broadcast(home), "subtopic_title").select("lesson_id", F.col("to").alias("unit"))
    units = linking.moved(rows.select("lesson_id", "unit"), moves, "lesson_id", "unit").where("unit is not null").groupBy("unit").agg(F.count("*").alias("n"), F.min("lesson_id").alias("first_lesson"))
    return sequences.renumbered(units, ["first_lesson", "unit"]).select("unit", "n", "unit_no")


@query("""WITH s AS (SELECT DISTINCT id, source_hash, exam_index FROM standard_exam_sets), l AS (SELECT DISTINCT exam_set_id, id, question_number FROM standard_exam_links),
a AS (SELECT 'exams of ' || source_hash AS grp, min(exam_index) AS low, max(exam_index) AS high, count(*) AS n, count(DISTINCT exam_index) AS d FROM s GROUP BY 1 UNION ALL SELECT 'questions of ' || exam_set_id, min(question_number), max(question_number), count(*), count(DISTINCT question_number) FROM l GROUP BY 1)
SELECT grp, 'does not start at 1' AS problem FROM a WHERE low <> 1 UNION ALL SELECT grp, 'has gaps' FROM a WHERE d <> high UNION ALL SELECT grp, 'has repetitions' FROM a WHERE n <> d""")
def exam_numbering(spark: SparkSession, root: str) -> DataFrame:
    """Exams of a file and questions of an exam that aren't numbered from 1 without gaps."""
    sets = table(spark, root, "standard_exam_sets").select("id", F.concat(F.lit("exams of "), "source_hash").alias("grp"), F.col("exam_index").alias("number")).distinct()
    links = table(spark, root, "standard_exam_links").select("id", F.concat(F.lit("questions of "), "exam_set_id").alias("grp"), F.col("question_number").alias("number")).distinct()
    return linking.contiguous(sets.unionByName(links), "grp", "number")


@query(f"""WITH {BANK}, {EXAM}, a AS (SELECT question_id, sha1({squash(fold('question_text'))}) AS k, answer_source, {_LETTER} AS letter FROM bank WHERE question_text IS NOT NULL AND question_type = 'multiple_choice'),
b AS (SELECT sha1({squash(fold('question_text'))}) AS k, min({_LETTER}) AS other FROM exam WHERE question_text IS NOT NULL AND question_type = 'multiple_choice' GROUP BY 1)
SELECT question_id, CASE WHEN letter IS NULL AND other IS NULL THEN 'open' WHEN other IS NULL THEN 'kept' WHEN letter IS NULL THEN 'filled' WHEN letter = other THEN 'verified' WHEN answer_source = 'original' THEN 'conflict' ELSE 'replaced' END AS verdict,
CASE WHEN letter IS NULL THEN other WHEN other IS NULL OR letter = other OR answer_source = 'original' THEN letter ELSE other END AS answer FROM a LEFT JOIN b USING (k)""")
def qb_answer_conflicts(spark: SparkSession, root: str) -> DataFrame:
    """Answers of the bank against those of equal exam questions: original answers stay and are flagged, others are replaced."""
    k = F.sha1(text.squash(text.fold(F.col("question_text")))).alias("k")
    letter = values.answer_letter(F.col("correct_answer"))
    a = bank(spark, root, "question_text", "question_type", "answer_source", "correct_answer").where("question_text is not null and question_type = 'multiple_choice'").select("question_id", k, "answer_source", letter.alias("letter"))
    b = table(spark, root, "standard_exam_questions").where("question_text is not null and question_type = 'multiple_choice'").select(k, letter.alias("other")).groupBy("k").agg(F.min("other").alias("other"))
    mine, other, original = F.col("letter"), F.col("other"), F.coalesce(F.col("answer_source") == "original", F.lit(False))
    verdict = (
        F.when(mine.isNull() & other.isNull(), "open").when(other.isNull(), "kept").when(mine.isNull(), "filled").when(mine == other, "verified").when(original, "conflict").otherwise("replaced")
    )
    answer = F.when(mine.isNull(), other).when(other.isNull() | (mine == other) | original, mine).otherwise(other)
    return a.join(b, "k", "left").select("question_id", verdict.alias("verdict"), answer.alias("answer"))


@query(f"""WITH {BANK}, v AS (SELECT DISTINCT topic AS item FROM bank WHERE topic IS NOT NULL), a AS (SELECT item, {tokens('item')} AS ta FROM v), b AS (SELECT id AS unit, {tokens('topic_title')} AS tb FROM canonical_topics),
s AS (SELECT item, unit, len(list_intersect(ta, tb)) / len(list_distinct(list_concat(ta, tb))) AS score FROM a, b WHERE len(list_intersect(ta, tb)) > 0), t AS (SELECT item, score FROM s QUALIFY row_number() OVER (PARTITION BY item ORDER BY score DESC, unit) = 1)
SELECT item, round(least(0.9, score * 1.5), 6) AS confidence, round(least(0.9, score * 1.5), 6) < 0.4 AS needs_review FROM t""")
def qb_mapping_confidence(spark: SparkSession, root: str) -> DataFrame:
    """Confidence of the mapping by word similarity, and whether it needs a review."""
    items = bank(spark, root, "topic").select(F.col("topic").alias("item")).where("item is not null").distinct().withColumn("tokens", text.tokens(F.col("item")))
    units = table(spark, root, "canonical_topics").select(F.col("id").alias("unit"), text.tokens(F.col("topic_title")).alias("tokens"))
    confidence = F.round(F.least(F.lit(0.9), F.col("score") * 1.5), 6)
    return mapping.best_by_tokens(items, units).select("item", confidence.alias("confidence"), (confidence < 0.4).alias("needs_review"))


@query(f"""WITH {EXAM} SELECT id, sha1(question_text || chr(10) || array_to_string(list_transform(statements, lambda s: coalesce(s.label, '') || ') ' || coalesce(s.text, '')), chr(10))) AS digest FROM exam WHERE statements IS NOT NULL AND question_text IS NOT NULL""")
def exam_merged_stems(spark: SparkSession, root: str) -> DataFrame:
    """Statements of true/false questions merged into their stem."""
    rows = exams.one_question(table(spark, root, "standard_exam_questions")).where("statements is not null and question_text is not null")
    lines_ = F.array_join(F.transform("statements", lambda s: F.concat(F.coalesce(s["label"], F.lit("")), F.lit(") "), F.coalesce(s["text"], F.lit("")))), "\n")
    return rows.select("id", F.sha1(F.concat("question_text", F.lit("\n"), lines_)).alias("digest"))


@query(f"""WITH {BANK} SELECT question_id, coalesce(explanation, 'unsolved') AS reply, 'fallback_no_provider' AS status FROM bank""")
def qb_provider_boundary(spark: SparkSession, root: str) -> DataFrame:
    """What rows get from a provider where none is set: their fallback, and a status that says so."""
    rows = bank(spark, root, "question_text", "explanation").withColumn("fallback", F.coalesce("explanation", F.lit("unsolved")))
    return providers.answered(rows, "question_id", "question_text", "fallback", [])


@query(f"""WITH {BANK} SELECT question_id, k.letter AS letter FROM (SELECT question_id, unnest([{{'letter': 'A', 'o': option_a}}, {{'letter': 'B', 'o': option_b}}, {{'letter': 'C', 'o': option_c}}, {{'letter': 'D', 'o': option_d}}]) AS k FROM bank WHERE question_type = 'multiple_choice')
WHERE regexp_matches(lower(k.o), '(?:^|\\s)(?:of|to|in|for|with|the|a|an|and|or|của|cho|với|và|hoặc|từ|đến)\\s*$')""")
def qb_dangling_options(spark: SparkSession, root: str) -> DataFrame:
    """Options that end in a word that needs another one."""
    rows = bank(spark, root, "question_type", "option_a", "option_b", "option_c", "option_d").where("question_type = 'multiple_choice'")
    options = F.explode(F.array(*(F.struct(F.lit(k.upper()).alias("letter"), F.col(f"option_{k}").alias("o")) for k in "abcd"))).alias("k")
    return rows.select("question_id", options).where(documents.dangling(F.col("k.o"))).select("question_id", "k.letter")


@query()
def doc_questions(spark: SparkSession, root: str) -> DataFrame:
    """Questions of the documents from marker to marker (tested on literals)."""
    rows = table(spark, root, "documents").where("text is not null").select("doc_id", "text").transform(lambda d: least_row(d, ["doc_id"]))
    out = documents.questions(rows, "text", "doc_id", marker=r"(?iu)(?:câu|question|bài|unit)\s*(\d+)\s*[.:)]")
    return out.select("doc_id", "ordinal", "number", F.length("stem").alias("n_chars"), F.size("options").alias("n_options"), "answer")
