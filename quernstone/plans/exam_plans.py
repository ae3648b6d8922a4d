"""Plans over exams, scanned blocks, lessons, documents and the relational tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quernstone.functions import keys, text, tolerant_json, values
from quernstone.operators import clusters, coverage, dedupe, exams, parse, quality, sequences
from quernstone.plans.base import EXAM, fold, query, squash, tokens
from quernstone.runtime import least_row, table
from quernstone.streaming import incremental

_CODE = f"regexp_replace({fold(squash('section_code'))}, '[_-]', ' ', 'g')"
_SECTION = f"CASE WHEN regexp_extract({_CODE}, '(?:^| )(iii|ii|i|3|2|1)$', 1) IN ('i', '1') THEN 'part_i' WHEN regexp_extract({_CODE}, '(?:^| )(iii|ii|i|3|2|1)$', 1) IN ('ii', '2') THEN 'part_ii' WHEN regexp_extract({_CODE}, '(?:^| )(iii|ii|i|3|2|1)$', 1) IN ('iii', '3') THEN 'part_iii' END"
_ANSWER = fold(squash("correct_answer"))
_LETTER = f"({_ANSWER} NOT IN ('n/a', 'null', 'none') AND regexp_extract({_ANSWER}, '(?:^|[^a-z])([a-d])[^a-z]*$', 1) <> '')"
_ANSWERED = f"""coalesce(CASE question_type WHEN 'multiple_choice' THEN correct_answer IS NOT NULL AND {_LETTER}
  WHEN 'true_false' THEN len(statements) = 4 AND len(list_filter(statements, lambda s: s.answer IS NOT NULL)) = 4 ELSE length(trim(numeric_answer)) > 0 END, false)"""
_ITEMS = "CASE WHEN question_type = 'true_false' THEN coalesce(len(statements), 0) ELSE 1 END"


@query(f"SELECT section_code, {_SECTION} AS section, count(*) AS n FROM standard_exam_links GROUP BY ALL")
def exam_section_codes(spark: SparkSession, root: str) -> DataFrame:
    """Spellings of section codes and what they mean."""
    return table(spark, root, "standard_exam_links").groupBy("section_code", values.section_code(F.col("section_code")).alias("section")).agg(F.count("*").alias("n"))


@query(f"""WITH {EXAM}, p AS (SELECT DISTINCT exam_set_id, question_id, {_SECTION} AS section FROM standard_exam_links)
SELECT exam_set_id, section, count(*) AS n_questions, CAST(sum({_ITEMS}) AS BIGINT) AS n_items FROM p JOIN exam ON exam.id = question_id GROUP BY 1, 2""")
def exam_sections(spark: SparkSession, root: str) -> DataFrame:
    """Questions and items of each section of each exam."""
    links = table(spark, root, "standard_exam_links").select("exam_set_id", "question_id", values.section_code(F.col("section_code")).alias("section")).distinct()
    facts = exams.items(exams.one_question(table(spark, root, "standard_exam_questions"))).select(F.col("id").alias("question_id"), "n_items")
    return links.join(facts, "question_id").groupBy("exam_set_id", "section").agg(F.count("*").alias("n_questions"), F.sum("n_items").alias("n_items"))


@query(f"""WITH {EXAM}, q AS (SELECT id, {_ITEMS} AS n_items, {_ANSWERED} AS answered, needs_review FROM exam), l AS (SELECT DISTINCT exam_set_id, question_id, question_number FROM standard_exam_links),
p AS (SELECT exam_set_id, count(DISTINCT question_number) AS n_questions, sum(n_items) AS n_items, count(*) FILTER (NOT answered) AS n_unanswered, count(*) FILTER (coalesce(needs_review, false)) AS n_review FROM l JOIN q ON q.id = question_id GROUP BY 1),
s AS (SELECT DISTINCT id AS exam_set_id, expected_question_count FROM standard_exam_sets)
SELECT exam_set_id, expected_question_count, coalesce(n_questions, 0) AS n_questions, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, coalesce(n_unanswered, 0) AS n_unanswered, coalesce(n_review, 0) AS n_review,
CASE WHEN coalesce(n_questions, 0) = expected_question_count AND coalesce(n_unanswered, 0) = 0 THEN 'ready' ELSE 'needs_review' END AS verdict FROM s LEFT JOIN p USING (exam_set_id)""")
def exam_audit(spark: SparkSession, root: str) -> DataFrame:
    """What each exam holds against what it should."""
    return exams.audit(*(table(spark, root, f"standard_exam_{t}") for t in ("sets", "links", "questions")))


@query(f"""WITH {EXAM}, q AS (SELECT id, CASE WHEN {_ANSWERED} THEN 4 ELSE 0 END + CASE WHEN coalesce(needs_visual, false) THEN 2 ELSE 0 END + CASE WHEN coalesce(length(explanation), 0) >= 200 THEN 1 ELSE 0 END AS score FROM exam),
l AS (SELECT DISTINCT id, exam_set_id, question_id, {_SECTION} AS section, question_number, created_at FROM standard_exam_links)
SELECT exam_set_id, section, question_number, l.id, question_id FROM l JOIN q ON q.id = question_id QUALIFY row_number() OVER (PARTITION BY exam_set_id, section, question_number ORDER BY score DESC, created_at, l.id) = 1""")
def exam_best_links(spark: SparkSession, root: str) -> DataFrame:
    """The best question for each place of an exam."""
    score = F.when(exams.has_answer(), 4).otherwise(0) + F.when(F.coalesce("needs_visual", F.lit(False)), 2).otherwise(0) + F.when(F.coalesce(F.length("explanation"), F.lit(0)) >= 200, 1).otherwise(0)
    return exams.best_links(table(spark, root, "standard_exam_links"), table(spark, root, "standard_exam_questions"), score).select("exam_set_id", "section", "question_number", "id", "question_id")


@query("""WITH n AS (SELECT id AS exam_set_id, unnest(range(1, max(expected_question_count) + 1)) AS question_number FROM standard_exam_sets GROUP BY id)
SELECT exam_set_id, CAST(question_number AS INTEGER) AS question_number FROM n WHERE exam_set_id IN (SELECT exam_set_id FROM standard_exam_links) EXCEPT SELECT exam_set_id, question_number FROM standard_exam_links""")
def exam_missing_numbers(spark: SparkSession, root: str) -> DataFrame:
    """Numbers that an exam lacks."""
    expected = table(spark, root, "standard_exam_sets").groupBy(F.col("id").alias("exam_set_id")).agg(F.max("expected_question_count").alias("expected"))
    return sequences.gaps(table(spark, root, "standard_exam_links").join(expected, "exam_set_id"), "exam_set_id", "question_number", "expected")


@query("""WITH s AS (SELECT DISTINCT source_hash, exam_index, start_page, end_page, total_pages FROM standard_exam_sets)
SELECT source_hash, exam_index, start_page, CAST(coalesce(lead(start_page) OVER (PARTITION BY source_hash ORDER BY start_page) - 1, total_pages) AS INTEGER) AS span_end, end_page FROM s""")
def exam_spans(spark: SparkSession, root: str) -> DataFrame:
    """Pages of each exam: up to the next one's start, the last up to the end of its file."""
    rows = table(spark, root, "standard_exam_sets").select("source_hash", "exam_index", "start_page", "end_page", "total_pages").distinct()
    return sequences.spans(rows, ["source_hash"], "start_page", F.col("total_pages")).select("source_hash", "exam_index", "start_page", F.col("span_end").cast("int").alias("span_end"), "end_page")


@query("""WITH s AS (SELECT DISTINCT source_hash, id, start_page, end_page FROM standard_exam_sets), p AS (SELECT DISTINCT s.source_hash, l.id AS link_id, l.exam_set_id, CAST(l.page_number + s.start_page - 1 AS INTEGER) AS page FROM standard_exam_links l JOIN s ON s.id = l.exam_set_id WHERE l.page_number IS NOT NULL)
SELECT p.link_id, p.page, (SELECT arg_min(r.id, r.start_page) FROM s r WHERE r.source_hash = p.source_hash AND p.page BETWEEN r.start_page AND r.end_page) AS found FROM p""")
def exam_page_lookup(spark: SparkSession, root: str) -> DataFrame:
    """The exam on whose pages each link of a file lies: a range join in cells."""
    sets = table(spark, root, "standard_exam_sets").select("source_hash", F.col("id").alias("found"), "start_page", "end_page").distinct()
    own = sets.select("source_hash", F.col("found").alias("exam_set_id"), F.col("start_page").alias("first"))
    links = table(spark, root, "standard_exam_links").select(F.col("id").alias("link_id"), "exam_set_id", "page_number").where("page_number is not null").distinct()
    points = links.join(own, "exam_set_id").select("source_hash", "link_id", (F.col("page_number") + F.col("first") - 1).cast("int").alias("page"))
    return sequences.in_range(points, sets, "source_hash", "page", "start_page", "end_page", "found").select("link_id", "page", "found")


@query("""SELECT 'links' AS table_name, exam_set_id || '|' || coalesce(section_code, '') || '|' || CAST(question_number AS VARCHAR) AS key, count(*) AS n FROM standard_exam_links GROUP BY ALL HAVING count(*) > 1
UNION ALL SELECT 'sets', source_hash || '|' || CAST(exam_index AS VARCHAR), count(*) FROM standard_exam_sets GROUP BY ALL HAVING count(*) > 1""")
def exam_key_violations(spark: SparkSession, root: str) -> DataFrame:
    """Keys that should be unique and aren't."""
    links = table(spark, root, "standard_exam_links").select(F.concat_ws("|", "exam_set_id", F.coalesce("section_code", F.lit("")), F.col("question_number").cast("string")).alias("key"))
    sets = table(spark, root, "standard_exam_sets").select(F.concat_ws("|", "source_hash", F.col("exam_index").cast("string")).alias("key"))
    both = links.withColumn("table_name", F.lit("links")).unionByName(sets.withColumn("table_name", F.lit("sets")))
    return dedupe.violations(both, ["table_name", "key"]).select("table_name", "key", "n")


@query(f"""WITH {EXAM} SELECT t.topic_code, s.subtopic_code, s.display_title, count(exam.id) AS n, count(exam.id) FILTER (coalesce(needs_review, false)) AS n_review
FROM canonical_subtopics s JOIN canonical_topics t ON t.id = s.topic_id LEFT JOIN exam ON exam.canonical_subtopic_id = s.id GROUP BY ALL""")
def exam_taxonomy(spark: SparkSession, root: str) -> DataFrame:
    """Exam questions of each subtopic with its topic; subtopics without any count 0."""
    counts = exams.one_question(table(spark, root, "standard_exam_questions")).groupBy(F.col("canonical_subtopic_id").alias("id")).agg(F.count("*").alias("n"), F.count_if(F.coalesce("needs_review", F.lit(False))).alias("n_review"))
    topics = table(spark, root, "canonical_topics").select(F.col("id").alias("topic_id"), "topic_code")
    subtopics = table(spark, root, "canonical_subtopics").select("id", "topic_id", "subtopic_code", "display_title")
    rows = subtopics.join(F.broadcast(topics), "topic_id").join(counts, "id", "left")
    return rows.select("topic_code", "subtopic_code", "display_title", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("n_review", F.lit(0)).alias("n_review"))


@query(f"""WITH {EXAM} SELECT verdict, count(*) AS n FROM (SELECT CASE WHEN canonical_subtopic_id IS NULL THEN 'no subtopic' WHEN s.id IS NULL THEN 'unknown subtopic' WHEN canonical_topic_id IS DISTINCT FROM s.topic_id THEN 'topic corrected' ELSE 'consistent' END AS verdict
FROM exam LEFT JOIN canonical_subtopics s ON s.id = canonical_subtopic_id) GROUP BY 1""")
def exam_taxonomy_integrity(spark: SparkSession, root: str) -> DataFrame:
    """Whether topic and subtopic of the exam questions fit together."""
    subtopics = table(spark, root, "canonical_subtopics").select(F.col("id").alias("canonical_subtopic_id"), "topic_id")
    rows = exams.one_question(table(spark, root, "standard_exam_questions")).select("canonical_topic_id", "canonical_subtopic_id").join(F.broadcast(subtopics), "canonical_subtopic_id", "left")
    verdict = (
        F.when(F.col("canonical_subtopic_id").isNull(), "no subtopic").when(F.col("topic_id").isNull(), "unknown subtopic")
        .when(~F.col("canonical_topic_id").eqNullSafe(F.col("topic_id")), "topic corrected").otherwise("consistent")
    )
    return rows.groupBy(verdict.alias("verdict")).agg(F.count("*").alias("n"))


@query(f"""WITH {EXAM} SELECT id, array_to_string(list_transform(statements, lambda s: CASE WHEN s.answer THEN 'D' WHEN NOT s.answer THEN 'S' ELSE '?' END), '') AS answers FROM exam WHERE statements IS NOT NULL""")
def exam_statement_answers(spark: SparkSession, root: str) -> DataFrame:
    """Answers of true/false questions as one word."""
    rows = exams.one_question(table(spark, root, "standard_exam_questions")).where("statements is not null")
    return rows.select("id", values.statement_answers(F.col("statements")).alias("answers"))


@query("""WITH l AS (SELECT DISTINCT exam_set_id, question_id FROM standard_exam_links), q AS (SELECT DISTINCT id FROM standard_exam_questions), s AS (SELECT DISTINCT id FROM standard_exam_sets)
SELECT 'link without question' AS problem, count(*) AS n FROM l WHERE question_id NOT IN (SELECT id FROM q) UNION ALL SELECT 'link without exam', count(*) FROM l WHERE exam_set_id NOT IN (SELECT id FROM s)
UNION ALL SELECT 'question without link', count(*) FROM q WHERE id NOT IN (SELECT question_id FROM l WHERE question_id IS NOT NULL)""")
def exam_references(spark: SparkSession, root: str) -> DataFrame:
    """References that lead nowhere, and questions nothing refers to."""
    links = table(spark, root, "standard_exam_links").select("exam_set_id", "question_id").distinct()
    questions = table(spark, root, "standard_exam_questions").select(F.col("id").alias("question_id")).distinct()
    sets = table(spark, root, "standard_exam_sets").select(F.col("id").alias("exam_set_id")).distinct()
    parts = (("link without question", links.where("question_id is not null").join(questions, "question_id", "left_anti")), ("link without exam", links.where("exam_set_id is not null").join(sets, "exam_set_id", "left_anti")), ("question without link", questions.join(links, "question_id", "left_anti")))
    out = None
    for name, rows in parts:
        part = rows.agg(F.count("*").alias("n")).select(F.lit(name).alias("problem"), "n")
        out = part if out is None else out.unionByName(part)
    return out


# ---------------------------------------------------------------- scanned blocks

_BLOCKS = "b AS (SELECT ordinal, any_value(raw_block) AS raw_block, any_value(question_html) AS question_html FROM mineru_preview_10_questions GROUP BY ordinal)"


def _blocks(spark: SparkSession, root: str) -> DataFrame:
    return least_row(table(spark, root, "mineru_preview_10_questions").select("ordinal", "raw_block", "question_html", "question_text"), ["ordinal"])


@query(rf"""WITH {_BLOCKS}, l AS (SELECT ordinal, unnest(string_split(raw_block, chr(10))) AS line, generate_subscripts(string_split(raw_block, chr(10)), 1) AS line_no FROM b)
SELECT ordinal, CAST(line_no AS INTEGER) AS line_no, regexp_extract(line, '^\s*([A-F])\s*[.):]\s*(.*)$', 1) AS letter, {squash("regexp_extract(line, '^" + chr(92) + "s*([A-F])" + chr(92) + "s*[.):]" + chr(92) + "s*(.*)$', 2)")} AS option FROM l WHERE regexp_matches(line, '^\s*([A-F])\s*[.):]\s*(.*)$')""")
def block_options(spark: SparkSession, root: str) -> DataFrame:
    """Option lines of scanned blocks."""
    return parse.option_lines(_blocks(spark, root), "raw_block", "ordinal")


@query(rf"""WITH {_BLOCKS}, l AS (SELECT ordinal, list_filter(string_split(raw_block, chr(10)), lambda x: trim(x) <> '' AND NOT regexp_matches(x, '^\s*[-~—\[]*\s*[0-9]+\s*[-~—\]]*\s*$|^\s*(?:Trang|Page|Tr\.)')) AS kept FROM b WHERE raw_block IS NOT NULL)
SELECT ordinal, CAST(len(kept) AS INTEGER) AS n_lines, sha1(array_to_string(kept, chr(10))) AS digest FROM l""")
def block_without_furniture(spark: SparkSession, root: str) -> DataFrame:
    """Scanned blocks without blank lines and plain page numbers."""
    kept = text.without_lines(F.col("raw_block"), r"^\s*[-~—\[]*\s*[0-9]+\s*[-~—\]]*\s*$|^\s*(?:Trang|Page|Tr\.)")
    rows = _blocks(spark, root).where("raw_block is not null").withColumn("kept", kept)
    n = F.when(F.col("kept") == "", 0).otherwise(F.size(F.split("kept", "\n", -1)))
    return rows.select("ordinal", n.alias("n_lines"), F.sha1("kept").alias("digest"))


@query(f"""WITH {_BLOCKS} SELECT ordinal, sha1({squash("regexp_replace(question_html, '<[^>]+>', ' ', 'g')")}) AS digest FROM b WHERE question_html IS NOT NULL""")
def block_html_text(spark: SparkSession, root: str) -> DataFrame:
    """Text of the blocks' HTML."""
    return _blocks(spark, root).where("question_html is not null").select("ordinal", F.sha1(text.strip_tags(F.col("question_html"))).alias("digest"))


@query(f"""WITH {_BLOCKS}, l AS (SELECT ordinal, generate_subscripts(string_split(raw_block, chr(10)), 1) AS line_no, unnest(string_split(raw_block, chr(10))) AS line FROM b),
s AS (SELECT ordinal, line, sum(CASE WHEN regexp_matches(line, '^\\s*D\\s*[.):]') THEN 1 ELSE 0 END) OVER (PARTITION BY ordinal ORDER BY line_no ROWS UNBOUNDED PRECEDING) AS section_no FROM l)
SELECT ordinal, CAST(section_no AS BIGINT) AS section_no, count(*) AS n_lines FROM s GROUP BY 1, 2""")
def block_sections(spark: SparkSession, root: str) -> DataFrame:
    """Lines of the blocks folded into sections, each opened by a line D."""
    rows = parse.lines(_blocks(spark, root), "raw_block", "ordinal")
    folded = sequences.sections(rows, ["ordinal"], ["line_no"], F.col("line").rlike(r"^\s*D\s*[.):]"))
    return folded.groupBy("ordinal", "section_no").agg(F.count("*").alias("n_lines"))


# ---------------------------------------------------------------- lessons

_LESSONS = "l AS (SELECT * FROM curriculum_scan QUALIFY row_number() OVER (PARTITION BY lesson_id ORDER BY scanned_at) = 1)"


def _lessons(spark: SparkSession, root: str) -> DataFrame:
    return dedupe.keep_one(table(spark, root, "curriculum_scan"), ["lesson_id"], F.unix_micros("scanned_at"))


@query(f"""WITH {_LESSONS}, c AS (SELECT source_name, lesson_id, unnest(analysis.concepts) AS concept FROM l), f AS (SELECT source_name, concept, min(lesson_id) AS first_lesson FROM c GROUP BY 1, 2)
SELECT source_name, CAST(row_number() OVER (PARTITION BY source_name ORDER BY first_lesson, concept) AS INTEGER) AS k, concept FROM f QUALIFY k <= 8""")
def lesson_profile(spark: SparkSession, root: str) -> DataFrame:
    """The first eight different concepts of each source (a preview)."""
    rows = _lessons(spark, root).select("source_name", "lesson_id", F.explode("analysis.concepts").alias("concept"))
    first = rows.groupBy("source_name", "concept").agg(F.min("lesson_id").alias("first_lesson"))
    return quality.first_rows(first, ["source_name"], 8, F.col("first_lesson"), F.col("concept")).select("source_name", "k", "concept")


@query(f"""WITH {_LESSONS}, c AS (SELECT lesson_id, unnest(list_distinct(analysis.concepts)) AS concept FROM l), t AS (SELECT subtopic_code, subtopic_title FROM canonical_subtopics), n AS (SELECT concept, count(*) AS n FROM c GROUP BY 1)
SELECT subtopic_code, coalesce(n, 0) AS n, CASE WHEN coalesce(n, 0) = 0 THEN 'missing' WHEN n > 1 THEN 'repeated' ELSE 'covered' END AS state FROM t LEFT JOIN n ON concept = subtopic_title""")
def lesson_coverage(spark: SparkSession, root: str) -> DataFrame:
    """Subtopics that lessons cover, repeat or lack."""
    rows = _lessons(spark, root).select(F.explode(F.array_distinct("analysis.concepts")).alias("subtopic_title"))
    covered = coverage.coverage(table(spark, root, "canonical_subtopics").select("subtopic_code", "subtopic_title"), rows, "subtopic_title", 1)
    return covered.select("subtopic_code", "n", F.when(F.col("n") == 0, "missing").when(F.col("n") > 1, "repeated").otherwise("covered").alias("state"))


@query(f"""WITH {_LESSONS}, p AS (SELECT *, string_split(relative_path, '/') AS parts FROM l)
SELECT lesson_id, parts[1] AS source, array_to_string(parts[1:2], '/') AS topic_key, parts[-1] AS file_name, TRY_CAST(regexp_extract(parts[-1], '([0-9]+)', 1) AS INTEGER) AS number, lower(regexp_extract(parts[-1], '\\.([^.]+)$', 1)) AS extension FROM p WHERE relative_path IS NOT NULL""")
def lesson_paths(spark: SparkSession, root: str) -> DataFrame:
    """What the path of a lesson tells."""
    rows = _lessons(spark, root).where("relative_path is not null").withColumn("parts", F.split("relative_path", "/", -1))
    name = F.element_at("parts", -1)
    return rows.select("lesson_id", F.element_at("parts", 1).alias("source"), F.array_join(F.slice("parts", 1, 2), "/").alias("topic_key"), name.alias("file_name"), F.regexp_extract(name, "([0-9]+)", 1).try_cast("int").alias("number"), F.lower(F.regexp_extract(name, r"\.([^.]+)$", 1)).alias("extension"))


@query(f"""WITH {_LESSONS} SELECT source_name, count(*) AS n_files, count(DISTINCT regexp_replace(relative_path, '/[^/]*$', '')) AS n_folders, count(*) FILTER (analysis IS NULL) AS n_unread FROM l GROUP BY 1""")
def lesson_manifest(spark: SparkSession, root: str) -> DataFrame:
    """Files and folders of each source."""
    folder = F.regexp_replace("relative_path", "/[^/]*$", "")
    return _lessons(spark, root).groupBy("source_name").agg(F.count("*").alias("n_files"), F.countDistinct(folder).alias("n_folders"), F.count_if(F.col("analysis").isNull()).alias("n_unread"))


@query(f"""WITH {_LESSONS}, n AS (SELECT lesson_id, analysis.program_area AS area, CAST(row_number() OVER (PARTITION BY analysis.program_area ORDER BY lesson_id) AS INTEGER) AS k FROM l WHERE analysis.program_area IS NOT NULL)
SELECT lesson_id, area, CASE WHEN k = 1 THEN area ELSE area || '-' || CAST(k AS VARCHAR) END AS unique_code FROM n""")
def lesson_codes(spark: SparkSession, root: str) -> DataFrame:
    """Areas made unique by a running number."""
    rows = _lessons(spark, root).select("lesson_id", F.col("analysis.program_area").alias("area")).where("area is not null")
    return sequences.unique_codes(rows, "area", ["lesson_id"])


@query(f"""WITH {_LESSONS}, t AS (SELECT lesson_id, {tokens("analysis.lesson_title")} AS a, {tokens("analysis.chapter")} AS b FROM l WHERE analysis IS NOT NULL)
SELECT lesson_id, round(CASE WHEN len(a) > 0 AND len(b) > 0 THEN len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))) ELSE 0 END, 6) AS similarity FROM t""")
def lesson_similarity(spark: SparkSession, root: str) -> DataFrame:
    """How alike title and chapter of a lesson are."""
    rows = _lessons(spark, root).where("analysis is not null")
    return rows.select("lesson_id", F.round(text.jaccard(text.tokens(F.col("analysis.lesson_title")), text.tokens(F.col("analysis.chapter"))), 6).alias("similarity"))


@query()
def lesson_units(spark: SparkSession, root: str) -> DataFrame:
    """Lessons of each area clustered greedily into units; the result depends on their order, which SQL can't express."""
    rows = _lessons(spark, root).where("analysis is not null").select(F.coalesce("analysis.program_area", F.lit("")).alias("area"), "lesson_id", text.tokens(F.col("analysis.lesson_title")).alias("words"))
    return clusters.greedy(rows, "area", "lesson_id", "words")


# ---------------------------------------------------------------- documents and relational tables


@query("""SELECT sha1(coalesce(text, '')) AS sha1, count(*) AS n FROM documents GROUP BY 1 HAVING sha1 NOT IN (SELECT sha1(coalesce(text, '')) FROM documents WHERE source = 'kho-hat-de')""")
def doc_new_content(spark: SparkSession, root: str) -> DataFrame:
    """Contents that the processed source hasn't, with the number of documents that hold each."""
    documents = table(spark, root, "documents")
    hashed = F.sha1(F.coalesce("text", F.lit(""))).alias("sha1")
    fresh = incremental.new_content(documents.select("doc_id", "text"), documents.where("source = 'kho-hat-de'").select(hashed), "text").select("sha1")
    return documents.select(hashed).join(fresh, "sha1", "left_semi").groupBy("sha1").agg(F.count("*").alias("n"))


@query()
def doc_chunks(spark: SparkSession, root: str) -> DataFrame:
    """Documents in pieces of at most 3,000 characters that end at a line break where they can (tested by joining them again)."""
    rows = table(spark, root, "documents").where("text is not null and text <> ''").select("doc_id", F.posexplode(text.chunks(F.col("text"), 3000)).alias("chunk_no", "chunk"))
    return rows.select("doc_id", "chunk_no", F.length("chunk").alias("n_chars"), F.sha1("chunk").alias("digest"))


@query("""SELECT doc_id, CASE WHEN length(text) >= 120 THEN 'passage-' || substring(sha1(substring(text, 1, 1000)), 1, 16) END AS passage_id FROM documents WHERE text IS NOT NULL""")
def doc_passage_ids(spark: SparkSession, root: str) -> DataFrame:
    """Ids of passages by their first characters."""
    return table(spark, root, "documents").where("text is not null").select("doc_id", keys.passage_id(F.col("text")).alias("passage_id"))


@query(f"""WITH f AS (SELECT doc_id, {squash(fold('text'))} AS k FROM documents WHERE text IS NOT NULL) SELECT sha1(k) AS k, count(*) AS n, min(doc_id) AS kept, count(*) - 1 AS dropped FROM f GROUP BY 1 HAVING count(*) > 1""")
def doc_duplicates(spark: SparkSession, root: str) -> DataFrame:
    """Documents whose folded texts are the same."""
    rows = table(spark, root, "documents").where("text is not null").select("doc_id", F.sha1(text.squash(text.fold(F.col("text")))).alias("k"))
    return dedupe.duplicates(rows, ["k"], "doc_id")


@query("""SELECT doc_id, source, CAST(row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS INTEGER) AS k FROM documents WHERE source IS NOT NULL QUALIFY k <= 5""")
def doc_longest(spark: SparkSession, root: str) -> DataFrame:
    """The five longest documents of each source (a top-k report)."""
    return quality.first_rows(table(spark, root, "documents").where("source is not null"), ["source"], 5, F.desc("n_chars"), F.col("doc_id")).select("doc_id", "source", "k")


@query()
def doc_json_objects(spark: SparkSession, root: str) -> DataFrame:
    """Objects inside the page items of the bank, the broken ones repaired where that is possible."""
    rows = table(spark, root, "random_sources_preview").select("question_id", "raw_text").transform(lambda d: least_row(d, ["question_id"]))
    out = tolerant_json.explode_objects(rows, "question_id", "raw_text")
    return out.select("question_id", "ordinal", F.sha1("object").alias("digest"), "bad_tail")


@query()
def doc_question_segments(spark: SparkSession, root: str) -> DataFrame:
    """Questions with their contexts inside documents."""
    rows = table(spark, root, "documents").where("text is not null").select("doc_id", "text").transform(lambda d: least_row(d, ["doc_id"]))
    out = parse.question_segments(rows, "doc_id", "text")
    return out.select("doc_id", "segment_no", "question_no", F.length("question").alias("n_chars"))


@query("""WITH p AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'), v AS (SELECT user_id, ts, value FROM events WHERE event_type = 'view')
SELECT p.event_id, v.value AS asof_value FROM p ASOF LEFT JOIN (SELECT user_id, ts, max(value) AS value FROM v GROUP BY 1, 2) v ON p.user_id = v.user_id AND p.ts >= v.ts""")
def events_as_of(spark: SparkSession, root: str) -> DataFrame:
    """The value of the last view of each buyer at the time of purchase: an as-of lookup in one pass."""
    events = table(spark, root, "events")
    views = events.where("event_type = 'view'").groupBy("user_id", "ts").agg(F.max("value").alias("value"))
    return sequences.as_of(events.where("event_type = 'purchase'").select("user_id", "ts", "event_id"), views, "user_id", "ts", "value").select("event_id", "asof_value")


@query("""SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events""")
def events_json(spark: SparkSession, root: str) -> DataFrame:
    """A field inside JSON."""
    return table(spark, root, "events").select("event_id", F.get_json_object("props", "$.k").try_cast("int").alias("k"))


@query("""SELECT r_name, n_name, CAST(row_number() OVER (PARTITION BY r_name ORDER BY n_nationkey) AS INTEGER) AS ordinal, count(c_custkey) AS n FROM region JOIN nation ON n_regionkey = r_regionkey LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY r_name, n_name, n_nationkey""")
def star_counts(spark: SparkSession, root: str) -> DataFrame:
    """A star of three tables with running codes and counts, empty entries included."""
    counts = table(spark, root, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count("*").alias("n"))
    nations = table(spark, root, "nation").join(F.broadcast(table(spark, root, "region")), F.col("n_regionkey") == F.col("r_regionkey")).join(counts, "n_nationkey", "left")
    return sequences.numbered(nations, ["r_name"], ["n_nationkey"]).select("r_name", "n_name", "ordinal", F.coalesce("n", F.lit(0)).alias("n"))


@query("""SELECT l_orderkey, l_linenumber, max(l_extendedprice) AS l_extendedprice, count(*) AS n FROM lineitem GROUP BY 1, 2""")
def keep_best_lines(spark: SparkSession, root: str) -> DataFrame:
    """The dearest of the lines that share a key, which is not unique."""
    return table(spark, root, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_extendedprice").alias("l_extendedprice"), F.count("*").alias("n"))


@query("""WITH a AS (SELECT DISTINCT id, expected_question_count AS n FROM standard_exam_sets), b AS (SELECT exam_set_id AS id, CAST(count(DISTINCT question_number) AS INTEGER) AS n FROM standard_exam_links WHERE exam_set_id IS NOT NULL GROUP BY 1), j AS (SELECT a.id AS x, b.id AS y, a.n AS p, b.n AS q FROM a FULL JOIN b ON a.id = b.id)
SELECT change, column_name, count(*) AS n FROM (SELECT CASE WHEN x IS NULL THEN 'added' WHEN y IS NULL THEN 'removed' WHEN p IS DISTINCT FROM q THEN 'changed' ELSE 'unchanged' END AS change, CASE WHEN x IS NOT NULL AND y IS NOT NULL AND p IS DISTINCT FROM q THEN 'n' ELSE '*' END AS column_name FROM j) GROUP BY ALL""")
def exam_sync(spark: SparkSession, root: str) -> DataFrame:
    """Changes between the questions that exams should have and those that are linked."""
    declared = table(spark, root, "standard_exam_sets").select("id", F.col("expected_question_count").alias("n")).distinct()
    linked = table(spark, root, "standard_exam_links").where("exam_set_id is not null").groupBy(F.col("exam_set_id").alias("id")).agg(F.countDistinct("question_number").cast("int").alias("n"))
    return dedupe.changes(declared, linked, "id", ["n"])


@query("""WITH a AS (SELECT DISTINCT question_id FROM random_sources_preview), b AS (SELECT DISTINCT id AS question_id FROM standard_exam_questions), l AS (SELECT DISTINCT question_id FROM standard_exam_links WHERE question_id IS NOT NULL)
SELECT 'bank' AS table_name, count(*) AS n_ids, count(*) FILTER (question_id IN (SELECT question_id FROM l)) AS n_linked FROM a UNION ALL SELECT 'exam', count(*), count(*) FILTER (question_id IN (SELECT question_id FROM l)) FROM b""")
def exam_id_sets(spark: SparkSession, root: str) -> DataFrame:
    """Ids of both question tables and how many of them exams use."""
    ids = table(spark, root, "random_sources_preview").select("question_id", F.lit("bank").alias("table_name")).unionByName(table(spark, root, "standard_exam_questions").select(F.col("id").alias("question_id"), F.lit("exam").alias("table_name"))).distinct()
    links = table(spark, root, "standard_exam_links").select("question_id").distinct().withColumn("linked", F.lit(1))
    return ids.join(links, "question_id", "left").groupBy("table_name").agg(F.count("*").alias("n_ids"), F.count("linked").alias("n_linked"))
