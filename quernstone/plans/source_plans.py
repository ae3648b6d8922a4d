"""Plans over sources and sinks, filters and incremental state; what is written goes to the shared folder and is read again."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quernstone.functions import items, text, values
from quernstone.operators import dedupe, exams, lookups, providers, sequences
from quernstone.plans.base import BANK, EXAM, bank, fold, query, squash
from quernstone.plans.exam_plans import _LESSONS, _lessons
from quernstone.runtime import materialize, shared_dir, table
from quernstone.sources import files, sinks
from quernstone.streaming import incremental


def _folder(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def _questions(spark: SparkSession, root: str, *columns: str) -> DataFrame:
    return exams.one_question(table(spark, root, "standard_exam_questions").select("id", "created_at", *(c for c in columns if c != "created_at"))).select("id", *columns)


# ---------------------------------------------------------------- sources

_NATURAL = "array_to_string(list_transform(regexp_extract_all(lower(relative_path), '([0-9]+|[^0-9]+)', 1), lambda r: CASE WHEN regexp_full_match(r, '[0-9]+') THEN lpad(r, 20, '0') ELSE r END), '')"
_FILES = f"""{_LESSONS}, fs AS (SELECT lesson_id, relative_path, string_split(relative_path, '/')[1] AS source, string_split(relative_path, '/')[-1] AS file_name, regexp_replace(relative_path, '/[^/]*$', '') AS folder,
lower(regexp_extract(relative_path, '\\.([^.]+)$', 1)) AS extension FROM l WHERE relative_path IS NOT NULL)"""


def _files(spark: SparkSession, root: str) -> DataFrame:
    rows = _lessons(spark, root).where("relative_path is not null").select("lesson_id", "relative_path", F.lit(0).cast("long").alias("size_bytes"))
    return files.described(rows, ("pdf",))


@query(f"""WITH {_FILES} SELECT lesson_id, source, extension, CAST(row_number() OVER (PARTITION BY source ORDER BY {_NATURAL}, relative_path) AS INTEGER) AS ordinal FROM fs WHERE extension = 'pdf'""")
def lesson_file_order(spark: SparkSession, root: str) -> DataFrame:
    """The place of each file in the natural order of its source."""
    return _files(spark, root).select("lesson_id", "source", "extension", "ordinal")


@query(f"""WITH {_FILES} SELECT source, count(*) AS n_files, count(DISTINCT folder) AS n_folders, CAST(0 AS BIGINT) AS n_bytes FROM fs WHERE extension = 'pdf' GROUP BY 1""")
def lesson_file_summary(spark: SparkSession, root: str) -> DataFrame:
    """Files, folders and bytes of each source."""
    return files.manifest_summary(_files(spark, root))


@query(f"""WITH {_FILES}, one AS (SELECT min(folder) AS folder FROM fs WHERE extension = 'pdf') SELECT lesson_id, CAST(row_number() OVER (ORDER BY lower(file_name), file_name, lesson_id) AS INTEGER) AS k FROM fs WHERE extension = 'pdf' AND folder = (SELECT folder FROM one)""")
def lesson_folder_files(spark: SparkSession, root: str) -> DataFrame:
    """The files of the first folder by name, whatever its letter case."""
    rows = materialize(_files(spark, root), "listing")
    folder = rows.agg(F.min(F.regexp_replace("relative_path", "/[^/]*$", ""))).first()[0] or ""
    inside = files.of_folder(rows, folder).drop("k")
    return sequences.numbered(inside, ["source"], [F.lower("file_name"), "file_name", "lesson_id"], "k").select("lesson_id", "k")


@query("""SELECT DISTINCT source_hash, id, exam_index FROM standard_exam_sets""")
def exam_json_import(spark: SparkSession, root: str) -> DataFrame:
    """Exams written as one JSON envelope for each file they come from, and read back from the list inside it."""
    sets = table(spark, root, "standard_exam_sets").select("source_hash", "id", "exam_index").distinct()
    folder = _folder(spark, "envelopes")
    envelope = F.to_json(F.struct(F.collect_list(F.struct("source_hash", "id", "exam_index")).alias("questions")))  # the exams of one file
    sets.groupBy(F.col("source_hash").alias("file")).agg(envelope.alias("value")).write.partitionBy("file").text(folder)
    return files.json_rows(spark, folder, "source_hash string, id string, exam_index int")


@query("""SELECT DISTINCT question_id AS id FROM standard_exam_links WHERE question_id IS NOT NULL""")
def exam_run_log(spark: SparkSession, root: str) -> DataFrame:
    """Ids of a log of JSON lines in which blank and broken lines stand between the good ones."""
    links = table(spark, root, "standard_exam_links").where("question_id is not null")
    folder = _folder(spark, "log")
    links.select(F.explode(F.array(F.to_json(F.struct(F.col("question_id").alias("id"))), F.lit(""), F.lit('{"id": "bro'))).alias("value")).write.text(folder)
    return files.json_lines(spark, folder, "id string").select("id").distinct()


@query("""SELECT id, topic FROM (SELECT DISTINCT id, topic, question_type, explanation, difficulty FROM standard_exam_questions) WHERE question_type IN ('multiple_choice', 'short_answer') AND explanation IS NULL AND difficulty = 'Thông hiểu'""")
def exam_filtered_scan(spark: SparkSession, root: str) -> DataFrame:
    """Unexplained questions of two types and one difficulty: all three conditions reach the scan."""
    rows = table(spark, root, "standard_exam_questions").where(F.col("question_type").isin("multiple_choice", "short_answer") & F.col("explanation").isNull() & (F.col("difficulty") == "Thông hiểu"))
    return rows.select("id", "topic", "question_type", "explanation", "difficulty").distinct().select("id", "topic")


@query(f"""WITH {EXAM}, w AS (SELECT question_id AS id, min(question_number) AS ordinal FROM standard_exam_links WHERE question_id IS NOT NULL GROUP BY 1) SELECT id, question_type, ordinal FROM exam JOIN w USING (id)""")
def exam_in_order(spark: SparkSession, root: str) -> DataFrame:
    """Linked questions with the least number they are asked for by."""
    wanted = table(spark, root, "standard_exam_links").where("question_id is not null").select(F.col("question_id").alias("id"), F.col("question_number").alias("ordinal"))
    return lookups.in_order(_questions(spark, root, "question_type"), wanted, "id").select("id", "question_type", "ordinal")


@query("""SELECT subtopic_code AS key, max(subtopic_title) AS value FROM canonical_subtopics GROUP BY 1""")
def subtopic_settings(spark: SparkSession, root: str) -> DataFrame:
    """Settings written as KEY="value" lines among comments and blank lines, and read back."""
    folder = _folder(spark, "settings")
    line = F.concat_ws("", "subtopic_code", F.lit(' = "'), "subtopic_title", F.lit('"'))
    table(spark, root, "canonical_subtopics").select(F.explode(F.array(F.lit("# a comment = none"), line, F.lit(""))).alias("value")).coalesce(1).write.text(folder)
    return files.settings(spark, folder)


@query("""SELECT source_hash, arg_max(title, (created_at, title)) AS title FROM standard_exam_sets GROUP BY 1""")
def exam_latest_artifact(spark: SparkSession, root: str) -> DataFrame:
    """The newest exam of each file."""
    rows = table(spark, root, "standard_exam_sets").select("source_hash", F.col("title").alias("relative_path"), F.col("created_at").alias("modified_at"))
    return files.latest(rows, "source_hash").select("source_hash", F.col("relative_path").alias("title"))


@query(f"""WITH {_LESSONS}, s AS (SELECT DISTINCT file_name, CASE WHEN regexp_matches(file_name, 'tài liệu') THEN 3 ELSE 0 END + CASE WHEN regexp_matches(file_name, '[0-9]{{2}}') THEN 2 ELSE 0 END AS points FROM l WHERE file_name IS NOT NULL) SELECT file_name, points FROM s ORDER BY points DESC, file_name LIMIT 3""")
def lesson_scored_pick(spark: SparkSession, root: str) -> DataFrame:
    """The three files whose names earn most points (a pick)."""
    names = _lessons(spark, root).where("file_name is not null").select("file_name").distinct()
    return lookups.scored_pick(names, "file_name", [("tài liệu", 3), ("[0-9]{2}", 2)], 60)


# ---------------------------------------------------------------- sinks


@query("""SELECT count(DISTINCT id) AS n_rows, CAST(2 AS INTEGER) AS n_columns, count(DISTINCT id) AS n_read FROM standard_exam_sets""")
def exam_envelope(spark: SparkSession, root: str) -> DataFrame:
    """The totals of an envelope of exams and the rows it holds."""
    folder = _folder(spark, "envelope")
    sinks.write_envelope(table(spark, root, "standard_exam_sets").groupBy("id").agg(F.min("title").alias("title")), folder)
    read = spark.read.parquet(f"{folder}/rows").agg(F.count("*").alias("n_read"))
    summary = spark.read.schema("n_rows long, columns array<string>").json(f"{folder}/summary").select("n_rows", F.size("columns").alias("n_columns"))
    return summary.unionByName(read, allowMissingColumns=True).agg(*(F.max(c).alias(c) for c in ("n_rows", "n_columns", "n_read")))


@query(f"""WITH {_LESSONS} SELECT CASE WHEN analysis IS NULL THEN 'error' ELSE 'processed' END AS status, count(*) AS n FROM l GROUP BY 1""")
def lesson_logs(spark: SparkSession, root: str) -> DataFrame:
    """A log appended to twice: what was processed, then what went wrong."""
    folder, rows = _folder(spark, "runs"), _lessons(spark, root)
    for status, some in (("processed", rows.where("analysis is not null")), ("error", rows.where("analysis is null"))):
        sinks.append_log(some.select("lesson_id", F.lit(status).alias("status")), folder)
    return spark.read.schema("lesson_id long, status string, logged_at timestamp").json(folder).groupBy("status").agg(F.count("*").alias("n"))


@query(f"""WITH {BANK} SELECT question_id, epoch_us(imported_at) AS imported_us FROM bank""")
def qb_versions(spark: SparkSession, root: str) -> DataFrame:
    """First imports with the latest ones put in, written as a version beside them."""
    folder = _folder(spark, "bank")
    rows = table(spark, root, "random_sources_preview").select("question_id", F.unix_micros("imported_at").alias("imported_us"))
    dedupe.keep_one(rows, ["question_id"], F.col("imported_us")).write.parquet(folder)
    latest = dedupe.keep_one(rows, ["question_id"], -F.col("imported_us"))
    return spark.read.schema("question_id string, imported_us long").parquet(sinks.write_upsert(folder, latest, ["question_id"], "v2"))


@query(f"""WITH {BANK} SELECT grade, count(*) AS n FROM bank WHERE grade IS NOT NULL GROUP BY 1""")
def qb_partitions(spark: SparkSession, root: str) -> DataFrame:
    """A table written by grade, one of whose partitions is written again: the others stay."""
    folder, rows = _folder(spark, "by-grade"), bank(spark, root, "grade").where("grade is not null")
    sinks.write_partitions(rows, folder, "grade")
    sinks.write_partitions(rows.where("grade = 12"), folder, "grade")
    return spark.read.schema("question_id string, grade int").parquet(folder).groupBy("grade").agg(F.count("*").alias("n"))


@query("""WITH f AS (SELECT question_id, min((created_at, id)) AS first FROM standard_exam_links WHERE question_id IS NOT NULL GROUP BY 1), k AS (SELECT question_id, row_number() OVER (ORDER BY first, question_id) AS k FROM f)
SELECT question_id, CAST(k AS INTEGER) AS k, CAST((k - 1) // 100 + 1 AS INTEGER) AS batch FROM k""")
def exam_publish_batches(spark: SparkSession, root: str) -> DataFrame:
    """Linked questions once each, in the order of their first link, in batches of a hundred."""
    return sequences.batches(table(spark, root, "standard_exam_links"), "question_id", ["created_at", "id"])


_SETS = "s AS (SELECT DISTINCT id, source_hash, exam_index FROM standard_exam_sets), st AS (SELECT * FROM s WHERE exam_index = 1), lk AS (SELECT DISTINCT exam_set_id, question_id, coalesce(section_code, '') AS section, question_number AS number FROM standard_exam_links)"


def _commit(spark: SparkSession, root: str, replace: bool) -> DataFrame:
    sets = table(spark, root, "standard_exam_sets").groupBy("id", "source_hash", "exam_index").agg(F.min("title").alias("title"))
    links = table(spark, root, "standard_exam_links").select("exam_set_id", F.col("question_id").alias("source_code"), F.coalesce("section_code", F.lit("")).alias("section"), F.col("question_number").alias("number")).distinct()
    texts = _questions(spark, root, "question_text").select(F.col("id").alias("source_code"), F.col("question_text").alias("text"))
    asked = links.join(texts, "source_code", "left").join(sets.select(F.col("id").alias("exam_set_id"), "source_hash", "exam_index"), "exam_set_id").drop("exam_set_id")
    made = lookups.commit(sets.drop("id"), asked, sets.where("exam_index = 1"), replace)
    out = None
    for part in ("sets", "links", "questions", "skipped"):
        counted = made[part].agg(F.count("*").alias("n")).select(F.lit(part).alias("part"), "n")
        out = counted if out is None else out.unionByName(counted)
    digest = made["questions"].where("text is not null").agg(F.count("*").alias("n")).select(F.lit("texts").alias("part"), "n")
    return out.unionByName(digest)


def _commit_sql(taken: str, skipped: str) -> str:
    return f"""WITH {_SETS}, {EXAM}, t AS ({taken}), q AS (SELECT DISTINCT lk.question_id FROM lk JOIN t ON t.id = lk.exam_set_id)
SELECT 'sets' AS part, count(*) AS n FROM t UNION ALL SELECT 'links', count(*) FROM (SELECT DISTINCT source_hash, exam_index, question_id, section, number FROM lk JOIN t ON t.id = lk.exam_set_id) UNION ALL SELECT 'questions', count(*) FROM q
UNION ALL SELECT 'skipped', {skipped} UNION ALL SELECT 'texts', count(*) FROM q JOIN exam ON exam.id = q.question_id WHERE question_text IS NOT NULL"""


@query(_commit_sql("SELECT * FROM s WHERE exam_index <> 1", "(SELECT count(*) FROM st)"))
def exam_commit_new(spark: SparkSession, root: str) -> DataFrame:
    """Rows that storing all exams writes where the first one of each file is stored already: those are skipped."""
    return _commit(spark, root, replace=False)


@query(_commit_sql("SELECT * FROM s", "0"))
def exam_commit_replaced(spark: SparkSession, root: str) -> DataFrame:
    """The same with the stored ones replaced."""
    return _commit(spark, root, replace=True)


# ---------------------------------------------------------------- filters


@query(f"""WITH {BANK} SELECT CASE WHEN contains({fold('source_file')}, 'de so') OR contains({fold('source_file')}, 'test') THEN 'bundle' ELSE 'main' END AS policy, count(*) AS n, min(question_id) AS first_id FROM bank WHERE source_file IS NOT NULL GROUP BY 1""")
def qb_by_policy(spark: SparkSession, root: str) -> DataFrame:
    """The bank split by the policy of its files: bundles by their path, the others; each kept with its provenance."""
    rows = bank(spark, root, "source_file").where("source_file is not null")
    is_bundle = text.fold(F.col("source_file")).contains("de so") | text.fold(F.col("source_file")).contains("test")
    parts = [rows.where(is_bundle).withColumn("policy", F.lit("bundle")), rows.where(~is_bundle).withColumn("policy", F.lit("main"))]
    return parts[0].unionByName(parts[1]).groupBy("policy").agg(F.count("*").alias("n"), F.min("question_id").alias("first_id"))


@query("""SELECT event_id, value > 20 AS retryable, CASE WHEN value > 20 THEN CAST(floor(value) AS INTEGER) * 60 + CAST(event_id % 60 AS INTEGER) + 10 ELSE 30 END AS wait FROM events WHERE event_type = 'error'""")
def events_retries(spark: SparkSession, root: str) -> DataFrame:
    """Which failed calls are worth another try, and after how many seconds by the provider's own hint."""
    rows = table(spark, root, "events").where("event_type = 'error'")
    hint = F.concat(F.lit("HTTP 429 quota, reset after "), F.floor("value").cast("string"), F.lit("m "), (F.col("event_id") % 60).cast("string"), F.lit("s"))
    message = F.when(F.col("value") > 20, hint).otherwise("bad request: field missing")
    return rows.select("event_id", providers.is_retryable(message).alias("retryable"), providers.wait_seconds(message).cast("int").alias("wait"))


@query(f"""WITH {EXAM} SELECT id FROM exam WHERE starts_with({fold('trim(explanation)')}, 'xin loi') OR starts_with({fold('trim(explanation)')}, 'rat tiec')""")
def exam_error_content(spark: SparkSession, root: str) -> DataFrame:
    """Questions whose explanation begins as an error message does."""
    begin = text.fold(F.trim("explanation"))
    return _questions(spark, root, "explanation").where(begin.startswith("xin loi") | begin.startswith("rat tiec")).select("id")


@query(f"""WITH {BANK} SELECT question_id, length(trim(explanation)) >= 20 AS has_solution, coalesce(answer_source = 'original', false) AS is_primary FROM bank WHERE explanation IS NOT NULL""")
def qb_source_answers(spark: SparkSession, root: str) -> DataFrame:
    """Whether a question's source has a solution, and whether its answer is the source's own."""
    rows = bank(spark, root, "explanation", "answer_source").where("explanation is not null")
    return rows.select("question_id", (F.length(F.trim("explanation")) >= 20).alias("has_solution"), F.coalesce(F.col("answer_source") == "original", F.lit(False)).alias("is_primary"))


@query(f"""WITH {EXAM} SELECT id, CAST(len(statements) AS INTEGER) AS n, array_to_string(list_transform(statements, lambda s: coalesce(s.text, '')), '|') AS texts, CAST(0 AS INTEGER) AS n_answers FROM exam WHERE statements IS NOT NULL""")
def exam_without_answers(spark: SparkSession, root: str) -> DataFrame:
    """True/false questions with the answers taken out of their statements."""
    rows = _questions(spark, root, "statements").where("statements is not null").withColumn("s", items.without_answers(F.col("statements")))
    answers = F.size(F.filter("s", lambda x: x["answer"].isNotNull()))
    return rows.select("id", F.size("s").alias("n"), F.array_join(F.transform("s", lambda x: F.coalesce(x["text"], F.lit(""))), "|").alias("texts"), answers.alias("n_answers"))


@query("""SELECT DISTINCT id, page_number, question_number FROM standard_exam_links WHERE page_number BETWEEN 2 AND 4 AND question_number <= 15""")
def exam_page_range(spark: SparkSession, root: str) -> DataFrame:
    """Links on some pages and up to some number; both bounds reach the scan."""
    return table(spark, root, "standard_exam_links").where("page_number between 2 and 4 and question_number <= 15").select("id", "page_number", "question_number").distinct()


@query(f"""WITH {_LESSONS}, s AS (SELECT lesson_id, relative_path FROM l WHERE source_name IN ('nguon-01', 'nguon-05')) SELECT lesson_id FROM s ORDER BY relative_path NULLS FIRST, lesson_id LIMIT 10""")
def lesson_first_of_sources(spark: SparkSession, root: str) -> DataFrame:
    """The first ten files of two sources (a preview)."""
    rows = _lessons(spark, root).where(F.col("source_name").isin("nguon-01", "nguon-05"))
    return rows.orderBy("relative_path", "lesson_id").limit(10).select("lesson_id")


@query(f"""WITH {BANK}, p AS (SELECT question_id, CASE WHEN needs_review THEN 'rewrite' WHEN explanation IS NULL THEN 'solve' ELSE 'none' END AS action, answer_source FROM bank) SELECT question_id, action FROM p WHERE action IN ('rewrite', 'solve') AND answer_source IS DISTINCT FROM 'generated'""")
def qb_fix_plan(spark: SparkSession, root: str) -> DataFrame:
    """Questions that a plan of repairs selects."""
    action = F.when(F.col("needs_review"), "rewrite").when(F.col("explanation").isNull(), "solve").otherwise("none")
    rows = bank(spark, root, "needs_review", "explanation", "answer_source").withColumn("action", action)
    return rows.where(F.col("action").isin("rewrite", "solve") & ~F.col("answer_source").eqNullSafe("generated")).select("question_id", "action")


# ---------------------------------------------------------------- incremental state


@query(f"""WITH {_LESSONS} SELECT lesson_id FROM l WHERE relative_path IS NOT NULL AND relative_path NOT IN (SELECT relative_path FROM l WHERE analysis IS NOT NULL AND relative_path IS NOT NULL)""")
def lesson_unprocessed(spark: SparkSession, root: str) -> DataFrame:
    """Lessons whose path no processed lesson has."""
    rows = _lessons(spark, root).where("relative_path is not null")
    return dedupe.without_existing(rows, rows.where("analysis is not null"), ["relative_path"]).select("lesson_id")


@query(f"""WITH {_LESSONS}, r AS (SELECT lesson_id, source_name, analysis IS NULL AS failed FROM l) SELECT lesson_id, CASE WHEN failed AND lesson_id % 2 = 0 THEN 'ok' WHEN failed THEN 'failed' ELSE 'kept' END AS status FROM r""")
def lesson_rerun(spark: SparkSession, root: str) -> DataFrame:
    """Failed lessons run again, every other one with success: results replace what failed, all else stays."""
    rows = _lessons(spark, root).select("lesson_id", F.when(F.col("analysis").isNull(), "failed").otherwise("kept").alias("status"))
    results = rows.where("lesson_id % 2 = 0").select("lesson_id", F.lit("ok").alias("status"))  # of failed and of other lessons
    return incremental.rerun(rows, results, "lesson_id", "status = 'failed'")


@query(f"""WITH {_LESSONS}, n AS (SELECT count(*) FILTER (analysis IS NOT NULL) AS n_ok, count(*) FILTER (analysis IS NULL) AS n_failed FROM l)
SELECT CASE WHEN n_failed = 0 THEN 'completed' WHEN n_ok = 0 THEN 'failed' ELSE 'completed_with_errors' END AS status, n_ok, n_failed, CASE WHEN n_failed = 0 OR forced AND n_ok > 0 THEN n_ok ELSE 0 END AS written, forced FROM n, (VALUES (true), (false)) AS f(forced)""")
def lesson_error_gate(spark: SparkSession, root: str) -> DataFrame:
    """What a run over all lessons may write: nothing if some failed, unless it is forced."""
    rows = _lessons(spark, root).select("analysis")
    gates = [incremental.gated(rows, "analysis is null", force).withColumn("forced", F.lit(force)) for force in (True, False)]
    return gates[0].unionByName(gates[1])


@query("""WITH f AS (SELECT question_id, needs_review AS a FROM random_sources_preview QUALIFY row_number() OVER (PARTITION BY question_id ORDER BY imported_at, coalesce(needs_review, false)) = 1),
l AS (SELECT question_id, needs_review AS b FROM random_sources_preview QUALIFY row_number() OVER (PARTITION BY question_id ORDER BY imported_at DESC, coalesce(needs_review, false)) = 1)
SELECT question_id, 'would update' AS action, b AS needs_review FROM f JOIN l USING (question_id) WHERE a IS DISTINCT FROM b""")
def qb_dry_run(spark: SparkSession, root: str) -> DataFrame:
    """What putting the latest imports in would change."""
    rows = table(spark, root, "random_sources_preview").select("question_id", "needs_review", "imported_at")
    review = F.coalesce("needs_review", F.lit(False))
    first = dedupe.keep_one(rows, ["question_id"], F.unix_micros("imported_at"), review)
    last = dedupe.keep_one(rows, ["question_id"], -F.unix_micros("imported_at"), review)
    return incremental.applied(first, last, "question_id", ["needs_review"], apply=False)


@query("""SELECT sha1(text) AS sha1, CASE WHEN count(*) FILTER (source = 'kho-hat-de') > 0 THEN 'new' ELSE 'old' END AS side FROM documents WHERE text IS NOT NULL GROUP BY 1""")
def doc_node_merge(spark: SparkSession, root: str) -> DataFrame:
    """Contents of one source put over those of the others by their hash: the new side wins, the rest is appended."""
    rows = table(spark, root, "documents").where("text is not null").select(F.sha1("text").alias("sha1"), "source")
    new = rows.where("source = 'kho-hat-de'").select("sha1", F.lit("new").alias("side")).distinct()
    return dedupe.upsert(rows.select("sha1", F.lit("old").alias("side")).distinct(), new, ["sha1"])


@query(f"""WITH {_LESSONS}, {BANK}, f AS (SELECT DISTINCT source_name FROM l), n AS (SELECT source_name, count(*) AS n FROM bank GROUP BY 1) SELECT source_name, coalesce(n, 0) AS n, CASE WHEN n IS NULL THEN 'not scanned' ELSE 'scanned' END AS status FROM f LEFT JOIN n USING (source_name)""")
def lesson_source_status(spark: SparkSession, root: str) -> DataFrame:
    """Sources of lessons with what the bank knows of each."""
    counts = bank(spark, root, "source_name").groupBy("source_name").agg(F.count("*").alias("n"))
    rows = _lessons(spark, root).select("source_name").distinct().join(counts, "source_name", "left")
    return rows.select("source_name", F.coalesce("n", F.lit(0)).alias("n"), F.when(F.col("n").isNull(), "not scanned").otherwise("scanned").alias("status"))


@query("""SELECT strftime(created_at, '%Y%m%d') AS day, count(DISTINCT id) AS n FROM standard_exam_links GROUP BY 1""")
def exam_links_by_day(spark: SparkSession, root: str) -> DataFrame:
    """Links of each day, in the spelling used for file names."""
    return table(spark, root, "standard_exam_links").groupBy(F.date_format("created_at", "yyyyMMdd").alias("day")).agg(F.countDistinct("id").alias("n"))


@query(f"""WITH {_LESSONS}, k AS (SELECT lesson_id, lesson_no FROM l WHERE lesson_no IS NOT NULL) SELECT lesson_id, array_to_string(list_filter([lesson_no - 1, lesson_no - 3, lesson_no - 7], lambda x: x >= 1), ',') AS reviews FROM k""")
def lesson_review_plan(spark: SparkSession, root: str) -> DataFrame:
    """The earlier lessons that each lesson looks back to."""
    rows = sequences.looked_back(_lessons(spark, root).where("lesson_no is not null"), "lesson_no", (1, 3, 7))
    return rows.select("lesson_id", F.array_join(F.transform("reviews", lambda k: k.cast("string")), ",").alias("reviews"))


@query(f"""WITH {BANK} SELECT question_id, 'https://' || source_name || '.example' AS url FROM bank WHERE source_name IS NOT NULL""")
def qb_base_urls(spark: SparkSession, root: str) -> DataFrame:
    """Addresses without a version and slashes at their end."""
    address = F.concat(F.lit(" https://"), "source_name", F.lit(".example/v1// "))
    return bank(spark, root, "source_name").where("source_name is not null").select("question_id", text.base_url(address).alias("url"))


@query(f"""WITH {BANK} SELECT question_id, {squash('source_hint')} AS hint, CASE WHEN {fold(squash('difficulty'))} IN ('nhan biet', 'thong hieu') THEN {fold(squash('difficulty'))} ELSE 'other' END AS level, CASE {fold(squash('question_type'))} WHEN 'multiple_choice' THEN 'choice' WHEN 'true_false' THEN 'judge' WHEN 'short_answer' THEN 'number' ELSE 'open' END AS task FROM bank""")
def qb_enumerations(spark: SparkSession, root: str) -> DataFrame:
    """Values brought to a list of allowed ones, and types of question to kinds of task."""
    task = values.mapped(F.col("question_type"), {"multiple_choice": "choice", "true_false": "judge", "short_answer": "number"}, "open")
    level = values.whitelisted(text.fold(text.squash(F.col("difficulty"))), ("nhan biet", "thong hieu"), "other")
    return bank(spark, root, "source_hint", "difficulty", "question_type").select("question_id", text.squash(F.col("source_hint")).alias("hint"), level.alias("level"), task.alias("task"))
