"""Plans that reports read: previews in order, roadmaps with counts, mixes, assembled rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quernstone.functions import text, values
from quernstone.operators import coverage, dedupe, documents, quality, sequences
from quernstone.plans.bank_plans import _gated, _ISSUES
from quernstone.plans.base import BANK, EXAM, bank, fold, query, squash
from quernstone.plans.exam_plans import _BLOCKS, _LESSONS, _SECTION, _blocks, _lessons
from quernstone.plans.source_plans import _questions
from quernstone.plans.text_plans import _DOCS, _documents
from quernstone.runtime import table

# ---------------------------------------------------------------- reports


@query(f"""WITH {BANK}, v AS (SELECT topic AS item, count(*) AS n FROM bank WHERE topic IS NOT NULL GROUP BY 1), m AS (SELECT item, n, t.id AS unit FROM v LEFT JOIN canonical_topics t ON t.topic_title = item)
SELECT item, n, unit, unit IS NULL AS needs_review FROM m ORDER BY (unit IS NULL) DESC, n DESC, item LIMIT 50""")
def report_mapping(spark: SparkSession, root: str) -> DataFrame:
    """Topics as typed with their entry: those to review first, the most frequent first (a preview)."""
    typed = bank(spark, root, "topic").where("topic is not null").groupBy(F.col("topic").alias("item")).agg(F.count("*").alias("n"))
    units = table(spark, root, "canonical_topics").select(F.col("topic_title").alias("item"), F.col("id").alias("unit"))
    rows = typed.join(units, "item", "left").withColumn("needs_review", F.col("unit").isNull())
    return rows.orderBy(F.desc("needs_review"), F.desc("n"), "item").limit(50).select("item", "n", "unit", "needs_review")


@query(f"""WITH {BANK}, {_LESSONS}, q AS (SELECT subtopic AS t, count(*) AS n FROM bank GROUP BY 1), c AS (SELECT unnest(analysis.concepts) AS t, lesson_id FROM l), k AS (SELECT t, count(DISTINCT lesson_id) AS n FROM c GROUP BY 1)
SELECT topic_order, subtopic_order, subtopic_code, coalesce(q.n, 0) AS n_questions, coalesce(k.n, 0) AS n_lessons FROM canonical_subtopics s JOIN canonical_topics t ON t.id = s.topic_id LEFT JOIN q ON q.t = subtopic_title LEFT JOIN k ON k.t = subtopic_title""")
def report_roadmap(spark: SparkSession, root: str) -> DataFrame:
    """Subtopics in their order with the questions and lessons of each."""
    asked = bank(spark, root, "subtopic").groupBy(F.col("subtopic").alias("subtopic_title")).agg(F.count("*").alias("n_questions"))
    taught = _lessons(spark, root).select("lesson_id", F.explode("analysis.concepts").alias("subtopic_title")).groupBy("subtopic_title").agg(F.countDistinct("lesson_id").alias("n_lessons"))
    topics = table(spark, root, "canonical_topics").select(F.col("id").alias("topic_id"), "topic_order")
    rows = table(spark, root, "canonical_subtopics").join(topics, "topic_id").join(asked, "subtopic_title", "left").join(taught, "subtopic_title", "left")
    return rows.select("topic_order", "subtopic_order", "subtopic_code", F.coalesce("n_questions", F.lit(0)).alias("n_questions"), F.coalesce("n_lessons", F.lit(0)).alias("n_lessons"))


@query(f"""WITH {BANK}, {_ISSUES} SELECT question_type, source_name, count(*) AS n, count(*) FILTER (len(issues) = 0) AS n_sound FROM issues GROUP BY ALL""")
def report_formats(spark: SparkSession, root: str) -> DataFrame:
    """Questions of each type and source, and how many are without any issue."""
    return _gated(spark, root).groupBy("question_type", "source_name").agg(F.count("*").alias("n"), F.count_if(F.size("issues") == 0).alias("n_sound"))


@query(f"""WITH {BANK}, {_ISSUES}, r AS (SELECT count(*) AS n, count(*) FILTER (len(issues) = 0) AS sound FROM issues), s AS (SELECT count(*) AS n FROM random_sources_preview)
SELECT 'rows sent' AS measure, n FROM s UNION ALL SELECT 'questions', n FROM r UNION ALL SELECT 'sent again', s.n - r.n FROM s, r UNION ALL SELECT 'sound', sound FROM r""")
def report_merge(spark: SparkSession, root: str) -> DataFrame:
    """What became of the rows that were sent."""
    sent = table(spark, root, "random_sources_preview").select(F.lit(1).alias("sent"), F.lit(0).alias("kept"), F.lit(0).alias("sound"))
    kept = _gated(spark, root).select(F.lit(0).alias("sent"), F.lit(1).alias("kept"), (F.size("issues") == 0).cast("int").alias("sound"))
    total = sent.unionByName(kept).agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("sent", "kept", "sound")))
    measures = (("rows sent", F.col("sent")), ("questions", F.col("kept")), ("sent again", F.col("sent") - F.col("kept")), ("sound", F.col("sound")))
    return total.select(F.explode(F.array(*(F.struct(F.lit(name).alias("measure"), n.alias("n")) for name, n in measures))).alias("m")).select("m.measure", "m.n")


@query(f"""WITH {EXAM}, k AS (SELECT DISTINCT exam_set_id, question_id, {_SECTION} AS section, question_number AS number FROM standard_exam_links WHERE exam_set_id IS NOT NULL)
SELECT exam_set_id, section, number, question_type, substring({squash('question_text')}, 1, 80) AS head FROM k JOIN exam ON exam.id = question_id WHERE number <= 3""")
def report_exam_preview(spark: SparkSession, root: str) -> DataFrame:
    """The first three questions of each section of each exam (a preview)."""
    links = table(spark, root, "standard_exam_links").where("exam_set_id is not null and question_number <= 3").select("exam_set_id", F.col("question_id").alias("id"), values.section_code(F.col("section_code")).alias("section"), F.col("question_number").alias("number")).distinct()
    rows = links.join(_questions(spark, root, "question_type", "question_text"), "id")
    return rows.select("exam_set_id", "section", "number", "question_type", F.substring(text.squash(F.col("question_text")), 1, 80).alias("head"))


@query(f"""WITH {_LESSONS} SELECT source_name, analysis.phase AS phase, analysis.lesson_type AS lesson_type, count(*) AS n, min(lesson_no) AS first_no, max(lesson_no) AS last_no FROM l GROUP BY ALL""")
def report_lessons(spark: SparkSession, root: str) -> DataFrame:
    """Lessons of each source by phase and kind."""
    rows = _lessons(spark, root).groupBy("source_name", F.col("analysis.phase").alias("phase"), F.col("analysis.lesson_type").alias("lesson_type"))
    return rows.agg(F.count("*").alias("n"), F.min("lesson_no").alias("first_no"), F.max("lesson_no").alias("last_no"))


# ---------------------------------------------------------------- assembled rows


@query(f"""WITH {BANK} SELECT question_id, question_type, CASE WHEN question_type = 'multiple_choice' THEN upper(trim(correct_answer)) WHEN question_type = 'short_answer' THEN trim(numeric_answer) END AS answer, coalesce(needs_review, false) AS needs_review, NOT coalesce(needs_review, false) AND explanation IS NOT NULL AS is_published FROM bank""")
def qb_row_builder(spark: SparkSession, root: str) -> DataFrame:
    """Rows as the bank stores them: one answer column by type, and the flags that follow."""
    kind, review = F.col("question_type"), F.coalesce("needs_review", F.lit(False))
    answer = F.when(kind == "multiple_choice", F.upper(F.trim("correct_answer"))).when(kind == "short_answer", F.trim("numeric_answer"))
    rows = bank(spark, root, "question_type", "correct_answer", "numeric_answer", "needs_review", "explanation")
    return rows.select("question_id", "question_type", answer.alias("answer"), review.alias("needs_review"), (~review & F.col("explanation").isNotNull()).alias("is_published"))


@query("""WITH s AS (SELECT id, min(title) AS title FROM standard_exam_sets GROUP BY 1), k AS (SELECT exam_set_id AS id, question_number AS number, min(question_id) AS question_id FROM standard_exam_links WHERE exam_set_id IS NOT NULL AND question_number IS NOT NULL GROUP BY 1, 2),
d AS (SELECT id, count(*) AS n, string_agg(CAST(number AS VARCHAR) || ':' || coalesce(question_id, ''), ',' ORDER BY number) AS questions FROM k GROUP BY 1) SELECT id, title, coalesce(n, 0) AS n, sha1(coalesce(questions, '')) AS digest FROM s LEFT JOIN d USING (id)""")
def exam_documents(spark: SparkSession, root: str) -> DataFrame:
    """Each exam with its questions in order as one document; the questions of an exam are few."""
    sets = table(spark, root, "standard_exam_sets").groupBy("id").agg(F.min("title").alias("title"))
    places = table(spark, root, "standard_exam_links").where("exam_set_id is not null and question_number is not null").groupBy(F.col("exam_set_id").alias("id"), F.col("question_number").alias("number")).agg(F.min("question_id").alias("question_id"))
    per = places.groupBy("id").agg(F.count("*").alias("n"), F.array_sort(F.collect_list(F.struct("number", "question_id"))).alias("q"))
    joined = F.array_join(F.transform("q", lambda x: F.concat(x["number"].cast("string"), F.lit(":"), F.coalesce(x["question_id"], F.lit("")))), ",")
    return sets.join(per.select("id", "n", joined.alias("q")), "id", "left").select("id", "title", F.coalesce("n", F.lit(0)).alias("n"), F.sha1(F.coalesce("q", F.lit(""))).alias("digest"))


@query(f"""WITH {_LESSONS}, n AS (SELECT lesson_id, source_name, row_number() OVER (PARTITION BY source_name ORDER BY lesson_no, lesson_id) AS k FROM l) SELECT source_name, CAST((k - 1) // 3 + 1 AS INTEGER) AS week, CAST((k - 1) % 3 + 1 AS INTEGER) AS session, lesson_id FROM n""")
def lesson_sessions(spark: SparkSession, root: str) -> DataFrame:
    """Lessons of each source dealt to weeks of three sessions."""
    rows = sequences.numbered(_lessons(spark, root).select("source_name", "lesson_no", "lesson_id"), ["source_name"], ["lesson_no", "lesson_id"], "k")
    return rows.select("source_name", (F.floor((F.col("k") - 1) / 3) + 1).cast("int").alias("week"), ((F.col("k") - 1) % 3 + 1).cast("int").alias("session"), "lesson_id")


@query(f"""WITH {EXAM} SELECT id, question_type, CASE question_type WHEN 'true_false' THEN array_to_string(list_transform(statements, lambda s: CASE WHEN s.answer THEN 'D' WHEN NOT s.answer THEN 'S' ELSE '?' END), '') WHEN 'short_answer' THEN numeric_answer ELSE correct_answer END AS answer FROM exam""")
def exam_answer_texts(spark: SparkSession, root: str) -> DataFrame:
    """The answer of every question as text, by its type."""
    kind = F.col("question_type")
    answer = F.when(kind == "true_false", values.statement_answers(F.col("statements"))).when(kind == "short_answer", F.col("numeric_answer")).otherwise(F.col("correct_answer"))
    return _questions(spark, root, "question_type", "statements", "numeric_answer", "correct_answer").select("id", "question_type", answer.alias("answer"))


@query(f"""WITH {BANK} SELECT question_id, sha1(array_to_string(list_filter([question_text, option_a, option_b, option_c, option_d], lambda x: coalesce(trim(x), '') <> ''), chr(10))) AS digest FROM bank""")
def qb_blobs(spark: SparkSession, root: str) -> DataFrame:
    """Question and options as one text, empty parts left out."""
    parts = F.filter(F.array("question_text", "option_a", "option_b", "option_c", "option_d"), lambda x: F.coalesce(F.trim(x), F.lit("")) != "")
    return bank(spark, root, "question_text", "option_a", "option_b", "option_c", "option_d").select("question_id", F.sha1(F.array_join(parts, "\n")).alias("digest"))


@query(f"""WITH {BANK} SELECT question_id, CASE WHEN length(question_text) > 400 THEN substring(question_text, 1, 400) ELSE question_text END AS stem, CAST((option_a IS NOT NULL)::INTEGER + (option_b IS NOT NULL)::INTEGER + (option_c IS NOT NULL)::INTEGER + (option_d IS NOT NULL)::INTEGER AS INTEGER) AS n_options, topic FROM bank WHERE question_text IS NOT NULL""")
def qb_compact(spark: SparkSession, root: str) -> DataFrame:
    """Questions as a lesson builder takes them: the beginning of the stem, the number of options, the topic."""
    n = sum((F.col(f"option_{k}").isNotNull().cast("int") for k in "abcd"), F.lit(0))
    return bank(spark, root, "question_text", "option_a", "option_b", "option_c", "option_d", "topic").where("question_text is not null").select("question_id", F.substring("question_text", 1, 400).alias("stem"), n.alias("n_options"), "topic")


# ---------------------------------------------------------------- aggregates of their own


@query(f"""WITH {BANK}, {_ISSUES}, x AS (SELECT question_id, source_name, len(issues) = 0 AS ok, array_to_string(issues, '; ') AS reason FROM issues) SELECT question_id, reason FROM x WHERE NOT ok AND source_name IS NOT NULL""")
def qb_rejected(spark: SparkSession, root: str) -> DataFrame:
    """Questions with any issue, annotated with their reasons."""
    return _gated(spark, root).where("size(issues) > 0 and source_name is not null").select("question_id", F.col("reason_text").alias("reason"))


@query(f"""WITH {BANK} SELECT question_id FROM bank WHERE NOT coalesce(needs_review, false) AND length(question_text) >= 20 AND explanation IS NULL""")
def qb_ready_to_solve(spark: SparkSession, root: str) -> DataFrame:
    """Questions that can be given to a solver."""
    return bank(spark, root, "needs_review", "question_text", "explanation").where("not coalesce(needs_review, false) and length(question_text) >= 20 and explanation is null").select("question_id")


@query(f"""WITH {BANK} SELECT topic, subtopic, count(*) AS n, count(*) FILTER (needs_review) AS n_review FROM bank GROUP BY ALL""")
def qb_topic_summary(spark: SparkSession, root: str) -> DataFrame:
    """Questions and those to review of each topic and subtopic as typed."""
    return bank(spark, root, "topic", "subtopic", "needs_review").groupBy("topic", "subtopic").agg(F.count("*").alias("n"), F.count_if("needs_review").alias("n_review"))


@query(f"""WITH {BANK} SELECT count(*) AS n, count(DISTINCT source_file) AS n_files, count(DISTINCT topic) AS n_topics, count(*) FILTER (needs_review) AS n_review, count(*) FILTER (explanation IS NULL) AS n_unsolved FROM bank""")
def qb_totals(spark: SparkSession, root: str) -> DataFrame:
    """Totals of the bank."""
    rows = bank(spark, root, "source_file", "topic", "needs_review", "explanation")
    return rows.agg(F.count("*").alias("n"), F.countDistinct("source_file").alias("n_files"), F.countDistinct("topic").alias("n_topics"), F.count_if("needs_review").alias("n_review"), F.count_if(F.col("explanation").isNull()).alias("n_unsolved"))


@query(f"""WITH {EXAM}, n AS (SELECT s.source_unit_id AS unit, question_type, count(*) AS n FROM exam JOIN canonical_subtopics s ON s.id = canonical_subtopic_id WHERE s.source_unit_id IS NOT NULL GROUP BY 1, 2) SELECT unit, question_type, n FROM n""")
def exam_units(spark: SparkSession, root: str) -> DataFrame:
    """Exam questions of each unit a subtopic was taken from; subtopics without a unit are left out."""
    units = table(spark, root, "canonical_subtopics").where("source_unit_id is not null").select(F.col("id").alias("canonical_subtopic_id"), F.col("source_unit_id").alias("unit"))
    return _questions(spark, root, "canonical_subtopic_id", "question_type").join(units, "canonical_subtopic_id").groupBy("unit", "question_type").agg(F.count("*").alias("n"))


@query(f"""WITH {BANK} SELECT lower(regexp_extract(source_file, '\\.([^.]+)$', 1)) AS extension, count(*) AS n, count(DISTINCT source_file) AS n_files FROM bank WHERE source_file IS NOT NULL GROUP BY 1""")
def qb_file_types(spark: SparkSession, root: str) -> DataFrame:
    """Kinds of files and the questions they gave."""
    rows = bank(spark, root, "source_file").where("source_file is not null")
    return rows.groupBy(F.lower(F.regexp_extract("source_file", r"\.([^.]+)$", 1)).alias("extension")).agg(F.count("*").alias("n"), F.countDistinct("source_file").alias("n_files"))


@query(f"""WITH {_BLOCKS}, p AS (SELECT ordinal, any_value(parser) AS parser FROM (SELECT ordinal, min(parser) AS parser FROM mineru_preview_10_questions GROUP BY 1) GROUP BY 1) SELECT parser, CASE WHEN raw_block IS NULL OR trim(raw_block) = '' THEN 'empty' WHEN len(string_split(raw_block, chr(10))) = 1 THEN 'one line' ELSE 'lines' END AS outcome, count(*) AS n FROM b JOIN p USING (ordinal) GROUP BY ALL""")
def block_outcomes(spark: SparkSession, root: str) -> DataFrame:
    """What each parser made of the blocks."""
    parsers = table(spark, root, "mineru_preview_10_questions").groupBy("ordinal").agg(F.min("parser").alias("parser"))
    outcome = F.when(F.col("raw_block").isNull() | (F.trim("raw_block") == ""), "empty").when(F.size(F.split("raw_block", "\n", -1)) == 1, "one line").otherwise("lines")
    return _blocks(spark, root).join(parsers, "ordinal").groupBy("parser", outcome.alias("outcome")).agg(F.count("*").alias("n"))


@query(f"""WITH {BANK}, g AS (SELECT subtopic AS t, count(*) AS final, count(*) FILTER (answer_source <> 'original') AS added FROM bank WHERE subtopic IS NOT NULL GROUP BY 1)
SELECT subtopic_code, coalesce(final, 0) - coalesce(added, 0) AS before, coalesce(added, 0) AS added, greatest(60 - coalesce(final, 0), 0) AS need, CASE WHEN coalesce(final, 0) >= 60 THEN 'green' WHEN coalesce(final, 0) >= 20 THEN 'yellow' ELSE 'red' END AS light FROM canonical_subtopics s LEFT JOIN g ON g.t = s.subtopic_title""")
def qb_coverage_lights(spark: SparkSession, root: str) -> DataFrame:
    """Coverage before and after what was added, and a light for each subtopic."""
    per = bank(spark, root, "subtopic", "answer_source").where("subtopic is not null").groupBy(F.col("subtopic").alias("subtopic_title")).agg(F.count("*").alias("final"), F.count_if(F.col("answer_source") != "original").alias("added"))
    rows = table(spark, root, "canonical_subtopics").select("subtopic_code", "subtopic_title").join(per, "subtopic_title", "left")
    final, added = F.coalesce("final", F.lit(0)), F.coalesce("added", F.lit(0))
    light = F.when(final >= 60, "green").when(final >= 20, "yellow").otherwise("red")
    return rows.select("subtopic_code", (final - added).alias("before"), added.alias("added"), F.greatest(60 - final, F.lit(0)).alias("need"), light.alias("light"))


@query(f"""WITH {BANK}, f AS (SELECT source_file, raw_document_id IS NOT NULL AS grouped FROM bank WHERE source_file IS NOT NULL) SELECT source_file, count(*) FILTER (grouped) AS n_grouped, count(*) FILTER (NOT grouped) AS n_alone FROM f GROUP BY 1""")
def qb_grouped_by_file(spark: SparkSession, root: str) -> DataFrame:
    """Questions of each file that belong to a group and those that stand alone."""
    rows = bank(spark, root, "source_file", "raw_document_id").where("source_file is not null")
    grouped = F.col("raw_document_id").isNotNull()
    return rows.groupBy("source_file").agg(F.count_if(grouped).alias("n_grouped"), F.count_if(~grouped).alias("n_alone"))


@query(f"""WITH {BANK}, n AS (SELECT subtopic, count(*) AS n FROM bank WHERE subtopic IS NOT NULL GROUP BY 1) SELECT s.subtopic_code, greatest(60 - coalesce(n, 0), 0) AS deficit FROM canonical_subtopics s LEFT JOIN n ON n.subtopic = s.subtopic_title WHERE greatest(60 - coalesce(n, 0), 0) > 0 ORDER BY deficit DESC, subtopic_code LIMIT 15""")
def qb_largest_deficits(spark: SparkSession, root: str) -> DataFrame:
    """The fifteen subtopics that lack most (a report)."""
    facts = bank(spark, root, "subtopic").select(F.col("subtopic").alias("subtopic_title"))
    rows = coverage.coverage(table(spark, root, "canonical_subtopics").select("subtopic_code", "subtopic_title"), facts, "subtopic_title", 60)
    return rows.where("deficit > 0").orderBy(F.desc("deficit"), "subtopic_code").limit(15).select("subtopic_code", "deficit")


@query(f"""WITH {_DOCS}, p AS (SELECT doc_id, text, string_split(text, chr(10)) AS x FROM d) SELECT doc_id, sha1(CASE WHEN length(text) - (len(x) - 1) <= 2000 OR len(x) <= 5 THEN text ELSE array_to_string(list_concat(list_slice(x, 1, 3), list_slice(x, -2, -1)), chr(10)) END) AS digest FROM p""")
def doc_compacted(spark: SparkSession, root: str) -> DataFrame:
    """Short documents whole, of long ones the first three and the last two lines (a preview)."""
    pages = _documents(spark, root).select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("page", "line")).withColumn("page", F.col("page") + 1)
    return documents.compacted(pages, "doc_id", "page", "line", 2000).select("doc_id", F.sha1("text").alias("digest"))


@query("""WITH s AS (SELECT DISTINCT source_hash, exam_index, start_page, end_page FROM standard_exam_sets), n AS (SELECT *, lead(start_page) OVER (PARTITION BY source_hash ORDER BY start_page) AS following FROM s) SELECT source_hash, exam_index, start_page, CAST(least(coalesce(following - 1, end_page), end_page) AS INTEGER) AS capped FROM n""")
def exam_ranges_capped(spark: SparkSession, root: str) -> DataFrame:
    """Ranges of exams that end before the next one begins and not after their own last page."""
    rows = table(spark, root, "standard_exam_sets").select("source_hash", "exam_index", "start_page", "end_page").distinct()
    spanned = sequences.spans(rows, ["source_hash"], "start_page", F.col("end_page"))
    return spanned.select("source_hash", "exam_index", "start_page", F.least("span_end", "end_page").cast("int").alias("capped"))


@query(f"""WITH {BANK} SELECT question_id, last_value(raw_document_id IGNORE NULLS) OVER (PARTITION BY source_file ORDER BY page_number NULLS FIRST, question_id ROWS UNBOUNDED PRECEDING) AS passage FROM bank WHERE source_file IS NOT NULL""")
def qb_current_passage(spark: SparkSession, root: str) -> DataFrame:
    """The raw document each question belongs to, carried forward through its file."""
    rows = bank(spark, root, "source_file", "page_number", "raw_document_id").where("source_file is not null")
    return sequences.carried_forward(rows, ["source_file"], ["page_number", "question_id"], "raw_document_id", "passage").select("question_id", "passage")


@query(f"""WITH {BANK}, t AS (SELECT question_id, source_name, sha1(question_id) AS h FROM bank WHERE source_name IS NOT NULL), k AS (SELECT question_id, source_name, h FROM t QUALIFY row_number() OVER (PARTITION BY source_name ORDER BY h) <= 3) SELECT source_name, question_id FROM k""")
def qb_sampled_pages(spark: SparkSession, root: str) -> DataFrame:
    """Three questions of each source in hash order (a sample)."""
    rows = bank(spark, root, "source_name").where("source_name is not null").withColumn("h", F.sha1("question_id"))
    return quality.first_rows(rows, ["source_name"], 3, F.col("h")).select("source_name", "question_id")


@query(f"""WITH {BANK}, o AS (SELECT source_name, question_type, question_id, row_number() OVER (PARTITION BY source_name ORDER BY question_type DESC, question_id) AS k FROM bank WHERE source_name IS NOT NULL AND question_type IS NOT NULL) SELECT source_name, question_type, question_id FROM o WHERE k <= 4""")
def qb_mixed_order(spark: SparkSession, root: str) -> DataFrame:
    """Four questions of each source, one order descending and one ascending (a top-k report)."""
    rows = bank(spark, root, "source_name", "question_type").where("source_name is not null and question_type is not null")
    return quality.first_rows(rows, ["source_name"], 4, F.desc("question_type"), F.col("question_id")).select("source_name", "question_type", "question_id")


@query(f"""WITH {EXAM}, {BANK}, a AS (SELECT DISTINCT sha1({squash(fold('question_text'))}) AS k FROM bank WHERE question_text IS NOT NULL), b AS (SELECT DISTINCT sha1({squash(fold('question_text'))}) AS k FROM exam WHERE question_text IS NOT NULL)
SELECT coalesce(a.k, b.k) AS k, CASE WHEN b.k IS NULL THEN 'bank only' ELSE 'exam only' END AS side FROM a FULL JOIN b ON a.k = b.k WHERE a.k IS NULL OR b.k IS NULL""")
def qb_symmetric_difference(spark: SparkSession, root: str) -> DataFrame:
    """Folded texts that only one of the two tables of questions has."""
    key = F.sha1(text.squash(text.fold(F.col("question_text")))).alias("k")
    a = bank(spark, root, "question_text").where("question_text is not null").select(key).distinct()
    b = _questions(spark, root, "question_text").where("question_text is not null").select(key).distinct()
    one, other = dedupe.without_existing(a, b, ["k"]), dedupe.without_existing(b, a, ["k"])
    return one.withColumn("side", F.lit("bank only")).unionByName(other.withColumn("side", F.lit("exam only")))


@query(f"""WITH {BANK} SELECT source_name, count(*) AS n, CAST(min(length(question_text)) AS INTEGER) AS shortest, CAST(max(length(question_text)) AS INTEGER) AS longest, CAST(floor(sum(length(question_text)) / count(question_text)) AS BIGINT) AS mean_floor FROM bank WHERE question_text IS NOT NULL GROUP BY 1""")
def qb_source_lengths(spark: SparkSession, root: str) -> DataFrame:
    """Least, greatest and mean length of each source's questions, rounded down."""
    n = F.length("question_text")
    return bank(spark, root, "source_name", "question_text").where("question_text is not null").groupBy("source_name").agg(F.count("*").alias("n"), F.min(n).alias("shortest"), F.max(n).alias("longest"), F.floor(F.sum(n) / F.count("question_text")).alias("mean_floor"))


@query(f"""WITH {_LESSONS}, x AS (SELECT source_name, unnest(analysis.example_types) AS kind FROM l) SELECT source_name, kind, count(*) AS n FROM x WHERE kind IS NOT NULL GROUP BY ALL""")
def lesson_example_types(spark: SparkSession, root: str) -> DataFrame:
    """Types of examples of each source, exploded from the lessons."""
    return _lessons(spark, root).select("source_name", F.explode("analysis.example_types").alias("kind")).where("kind is not null").groupBy("source_name", "kind").agg(F.count("*").alias("n"))


@query(f"""WITH {BANK}, r AS (SELECT question_id, needs_review, topic = 'Chưa phân loại' AS by_rule FROM bank) SELECT question_id, coalesce(needs_review, false) AND NOT coalesce(by_rule, false) AS effective FROM r""")
def qb_effective_review(spark: SparkSession, root: str) -> DataFrame:
    """Whether a question really needs a review: not where a rule alone asked for it."""
    by_rule = F.coalesce(F.col("topic") == "Chưa phân loại", F.lit(False))
    return bank(spark, root, "needs_review", "topic").select("question_id", (F.coalesce("needs_review", F.lit(False)) & ~by_rule).alias("effective"))


@query(f"""WITH {_LESSONS}, u AS (SELECT DISTINCT analysis.program_area AS area, unnest(analysis.concepts) AS concept FROM l WHERE analysis IS NOT NULL), s AS (SELECT count(DISTINCT subtopic_title) AS n FROM canonical_subtopics)
SELECT area, count(*) AS n_covered, (SELECT n FROM s) - count(*) AS n_missing FROM u JOIN (SELECT DISTINCT subtopic_title FROM canonical_subtopics) c ON c.subtopic_title = concept WHERE area IS NOT NULL GROUP BY 1""")
def lesson_area_coverage(spark: SparkSession, root: str) -> DataFrame:
    """Canonical subtopics that each area of lessons covers, and how many it lacks."""
    taught = _lessons(spark, root).where("analysis is not null and analysis.program_area is not null").select(F.col("analysis.program_area").alias("area"), F.explode("analysis.concepts").alias("subtopic_title")).distinct()
    known = table(spark, root, "canonical_subtopics").select("subtopic_title").distinct()
    total = known.count()
    return taught.join(known, "subtopic_title").groupBy("area").agg(F.count("*").alias("n_covered")).withColumn("n_missing", F.lit(total) - F.col("n_covered"))


# ---------------------------------------------------------------- verdicts and rows grown


@query(f"""WITH {BANK}, {_ISSUES}, n AS (SELECT source_name, count(*) FILTER (len(issues) = 0) AS accepted, count(*) FILTER (len(issues) > 0) AS rejected FROM issues WHERE source_name IS NOT NULL GROUP BY 1) SELECT source_name, accepted > 0 AND rejected <= accepted AS accepted FROM n""")
def qb_source_verdicts(spark: SparkSession, root: str) -> DataFrame:
    """Sources that can be taken at a glance: some questions are sound, and no more have issues than haven't."""
    per = _gated(spark, root).where("source_name is not null").groupBy("source_name").agg(F.count_if(F.size("issues") == 0).alias("ok"), F.count_if(F.size("issues") > 0).alias("bad"))
    return per.select("source_name", ((F.col("ok") > 0) & (F.col("bad") <= F.col("ok"))).alias("accepted"))


@query("""WITH f AS (SELECT question_id, source_file, coalesce(needs_review, false) AS a FROM random_sources_preview QUALIFY row_number() OVER (PARTITION BY question_id ORDER BY imported_at, coalesce(needs_review, false)) = 1),
l AS (SELECT question_id, coalesce(needs_review, false) AS b FROM random_sources_preview QUALIFY row_number() OVER (PARTITION BY question_id ORDER BY imported_at DESC, coalesce(needs_review, false)) = 1),
n AS (SELECT source_file, count(*) FILTER (a) AS before, count(*) FILTER (b) AS after, count(*) FILTER (NOT b) AS ready FROM f JOIN l USING (question_id) WHERE source_file IS NOT NULL GROUP BY 1) SELECT source_file, before, after, ready > 0 AND after < before AS accepted FROM n""")
def qb_reextracted(spark: SparkSession, root: str) -> DataFrame:
    """Files whose later imports are better than the first ones: some questions are ready and fewer need a review."""
    review = F.coalesce("needs_review", F.lit(False))
    rows = table(spark, root, "random_sources_preview").select("question_id", "source_file", review.alias("review"), F.unix_micros("imported_at").alias("us"))
    both = rows.groupBy("question_id").agg(F.min(F.struct("us", "review", "source_file")).alias("f"), F.min(F.struct((-F.col("us")).alias("us"), "review")).alias("l"))
    per = both.where("f.source_file is not null").groupBy(F.col("f.source_file").alias("source_file")).agg(F.count_if("f.review").alias("before"), F.count_if("l.review").alias("after"), F.count_if(~F.col("l.review")).alias("ready"))
    return per.select("source_file", "before", "after", ((F.col("ready") > 0) & (F.col("after") < F.col("before"))).alias("accepted"))


@query("""SELECT id, CASE WHEN min(exam_index) > 1 THEN min(subject) END AS subject, min(title) AS title FROM standard_exam_sets GROUP BY id""")
def exam_schema_grown(spark: SparkSession, root: str) -> DataFrame:
    """Rows with a column that the stored table lacks: it is added, and null for what was there."""
    rows = table(spark, root, "standard_exam_sets").groupBy("id").agg(F.min("title").alias("title"), F.min("subject").alias("subject"), F.min("exam_index").alias("k"))
    stored, new = rows.where("k = 1").select("id", "title"), rows.where("k > 1").select("id", "title", "subject")
    return stored.join(new.select("id"), "id", "left_anti").unionByName(new, allowMissingColumns=True).select("id", "subject", "title")


@query(f"""WITH {BANK} SELECT question_id, CASE {fold(squash('difficulty'))} WHEN 'nhan biet' THEN 'NB' WHEN 'thong hieu' THEN 'TH' WHEN 'van dung' THEN 'VD' WHEN 'van dung cao' THEN 'VDC' ELSE '?' END AS code, {squash('option_a')} AS option_a FROM bank""")
def qb_item_fixups(spark: SparkSession, root: str) -> DataFrame:
    """Word forms of raw items brought to codes, their options to single spaces."""
    code = values.mapped(F.col("difficulty"), {"nhan biet": "NB", "thong hieu": "TH", "van dung": "VD", "van dung cao": "VDC"}, "?")
    return bank(spark, root, "difficulty", "option_a").select("question_id", code.alias("code"), text.squash(F.col("option_a")).alias("option_a"))


@query(f"""WITH {_BLOCKS} SELECT ordinal, 'segment-' || substring(sha1(CAST(ordinal AS VARCHAR) || '|' || {squash('raw_block')}), 1, 16) AS segment_id FROM b WHERE raw_block IS NOT NULL""")
def block_segment_ids(spark: SparkSession, root: str) -> DataFrame:
    """Ids of blocks by their place and text."""
    key = F.concat_ws("|", F.col("ordinal").cast("string"), text.squash(F.col("raw_block")))
    return _blocks(spark, root).where("raw_block is not null").select("ordinal", F.concat(F.lit("segment-"), F.substring(F.sha1(key), 1, 16)).alias("segment_id"))
