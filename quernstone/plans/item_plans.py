"""Plans over items: flags, lists, nested values, lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quernstone.functions import items, keys, text, values
from quernstone.operators import exams, lookups
from quernstone.plans.base import BANK, EXAM, bank, fold, query, squash, tokens
from quernstone.plans.exam_plans import _LESSONS, _lessons
from quernstone.runtime import table


def _has(x: str, words: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"contains(coalesce({fold(x)}, ''), '{w}')" for w in words) + ")"


@query(f"""WITH {BANK} SELECT question_id, {_has('question_text', items.FIGURE_WORDS)} AS figure, {_has('question_text', items.TABLE_WORDS)} AS has_table, {_has('question_text', items.GROUPED_WORDS)} AS grouped, {_has('question_text', items.JUDGE_WORDS)} AS judges,
length(coalesce(question_text, '')) < 800 OR {_has('question_text', items.FIGURE_WORDS)} AS image FROM bank""")
def qb_keyword_flags(spark: SparkSession, root: str) -> DataFrame:
    """What the words of a question tell about figures, tables and the kind of task."""
    x = F.col("question_text")
    return bank(spark, root, "question_text").select(
        "question_id", items.mentions(x, items.FIGURE_WORDS).alias("figure"), items.mentions(x, items.TABLE_WORDS).alias("has_table"),
        items.mentions(x, items.GROUPED_WORDS).alias("grouped"), items.mentions(x, items.JUDGE_WORDS).alias("judges"), items.needs_image(x).alias("image"),
    )


@query(f"""WITH {BANK} SELECT question_id, coalesce({fold(squash('question_text'))} LIKE '%?' OR regexp_matches({fold(squash('question_text'))}, '^(?:tinh|tim|hoi|hay|cho biet|what|which|how|why|find|choose)\\b'), false) AS asks,
coalesce({fold(squash('question_text'))}, '') NOT IN ('', 'null', 'n/a', '...', 'placeholder', 'question text') AND len(list_filter([option_a, option_b, option_c, option_d], lambda o: coalesce(trim(o), '') <> '')) >= 2 AS answerable FROM bank WHERE question_type = 'multiple_choice'""")
def qb_answerable(spark: SparkSession, root: str) -> DataFrame:
    """Multiple-choice questions that ask, and those that can be answered."""
    rows = bank(spark, root, "question_type", "question_text", "option_a", "option_b", "option_c", "option_d").where("question_type = 'multiple_choice'")
    options, none = F.array("option_a", "option_b", "option_c", "option_d"), F.array().cast("array<string>")
    return rows.select("question_id", items.is_question(F.col("question_text")).alias("asks"), items.is_answerable(F.col("question_text"), options, none).alias("answerable"))


@query(f"""WITH {EXAM} SELECT id, k.label AS label, k.answer AS answer FROM (SELECT id, unnest(list_transform([1, 2, 3, 4], lambda i: {{'label': coalesce(statements[i].label, substring('abcd', i, 1)), 'answer': statements[i].answer}})) AS k FROM exam WHERE statements IS NOT NULL)""")
def exam_padded_statements(spark: SparkSession, root: str) -> DataFrame:
    """Four statements for each true/false question, padded where some lack, their answers set from letters."""
    rows = exams.one_question(table(spark, root, "standard_exam_questions")).where("statements is not null")
    return rows.select("id", F.explode(items.with_truths(F.transform("statements", lambda s: s.withField("answer", F.lit(None).cast("boolean"))), values.statement_answers(F.col("statements")))).alias("s")).select("id", "s.label", "s.answer")


@query(f"""WITH {_LESSONS} SELECT lesson_id, array_to_string(list_slice(list_filter(list_transform(analysis.objectives, lambda s: trim(s)), lambda s: coalesce(s, '') <> ''), 1, 2), '|') AS objectives FROM l WHERE analysis IS NOT NULL""")
def lesson_objectives(spark: SparkSession, root: str) -> DataFrame:
    """The first two objectives of each lesson (a preview)."""
    return _lessons(spark, root).where("analysis is not null").select("lesson_id", F.array_join(items.clipped(F.col("analysis.objectives"), 2), "|").alias("objectives"))


@query(f"""WITH {_LESSONS}, t AS (SELECT lesson_id, lower({squash('analysis.lesson_title')}) AS item FROM l WHERE analysis.lesson_title IS NOT NULL), v AS (SELECT DISTINCT item FROM t), c AS (SELECT id AS unit, lower({squash('subtopic_title')}) AS title FROM canonical_subtopics UNION ALL SELECT id, lower({squash('chapter_title')}) FROM canonical_chapters),
e AS (SELECT item, min(unit) AS unit FROM v JOIN c ON item = title GROUP BY 1), h AS (SELECT item, min(unit) AS unit FROM v JOIN c ON contains(title, item) OR contains(item, title) WHERE item NOT IN (SELECT item FROM e) GROUP BY 1)
SELECT item, unit, 'exact' AS how FROM e UNION ALL SELECT item, unit, 'contained' FROM h""")
def lesson_titles(spark: SparkSession, root: str) -> DataFrame:
    """Canonical entries of lesson titles: equal ones, else those that hold or are held."""
    lower = lambda c: F.lower(text.squash(F.col(c)))
    titles = table(spark, root, "canonical_subtopics").select(F.col("id").alias("unit"), lower("subtopic_title").alias("title")).unionByName(table(spark, root, "canonical_chapters").select(F.col("id").alias("unit"), lower("chapter_title").alias("title")))
    found = _lessons(spark, root).select(lower("analysis.lesson_title").alias("item")).where("item is not null").distinct()
    return lookups.by_title(found, titles)


@query(f"""WITH {_LESSONS}, a AS (SELECT lesson_id, {tokens('analysis.lesson_title')} AS t, analysis.concepts AS concepts FROM l WHERE len(analysis.concepts) > 0),
s AS (SELECT lesson_id, k, c AS concept, CASE WHEN len(t) > 0 AND len(u) > 0 THEN len(list_intersect(t, u)) / len(list_distinct(list_concat(t, u))) ELSE 0 END AS score FROM (SELECT lesson_id, t, unnest(concepts) AS c, generate_subscripts(concepts, 1) AS k FROM a), LATERAL (SELECT {tokens('c')} AS u))
SELECT lesson_id, concept, round(score, 6) AS score FROM s WHERE score > 0 QUALIFY row_number() OVER (PARTITION BY lesson_id ORDER BY score DESC, k) = 1""")
def lesson_main_concept(spark: SparkSession, root: str) -> DataFrame:
    """The concept of a lesson most like its title, chosen inside the row."""
    rows = _lessons(spark, root).where("size(analysis.concepts) > 0")
    candidates = F.transform("analysis.concepts", lambda c: F.named_struct(F.lit("text"), c, F.lit("tokens"), text.tokens(c)))
    best = lookups.best_element(text.tokens(F.col("analysis.lesson_title")), candidates)
    return rows.select("lesson_id", best.alias("b")).where("b is not null").select("lesson_id", F.col("b.text").alias("concept"), F.round("b.score", 6).alias("score"))


@query(f"""WITH {_LESSONS}, {BANK}, n AS (SELECT subtopic, count(*) AS n FROM bank WHERE subtopic IS NOT NULL GROUP BY 1), c AS (SELECT lesson_id, unnest(list_concat(analysis.concepts, analysis.prerequisites)) AS subtopic FROM l WHERE analysis IS NOT NULL)
SELECT lesson_id, CAST(sum(coalesce(n, 0)) AS BIGINT) AS total FROM c LEFT JOIN n USING (subtopic) WHERE subtopic IS NOT NULL GROUP BY 1""")
def lesson_question_totals(spark: SparkSession, root: str) -> DataFrame:
    """Questions of the subtopics that a lesson teaches or requires; one that does both counts twice."""
    counts = bank(spark, root, "subtopic").where("subtopic is not null").groupBy("subtopic").agg(F.count("*").alias("n"))
    lists = _lessons(spark, root).where("analysis is not null").select("lesson_id", F.filter(F.concat(*(F.coalesce(f"analysis.{c}", F.array().cast("array<string>")) for c in ("concepts", "prerequisites"))), lambda s: s.isNotNull()).alias("members"))
    return lookups.rolled_up(lists, counts, "lesson_id", "members", "subtopic", "n", once=False)


@query(f"""WITH {BANK} SELECT source_name, count(*) FILTER (question_type = 'multiple_choice') AS multiple_choice, count(*) FILTER (question_type = 'true_false') AS true_false, count(*) FILTER (question_type = 'short_answer') AS short_answer FROM bank GROUP BY 1""")
def qb_types_by_source(spark: SparkSession, root: str) -> DataFrame:
    """Types of question across sources."""
    return lookups.crossed(bank(spark, root, "source_name", "question_type"), "source_name", "question_type", ["multiple_choice", "true_false", "short_answer"])


@query(f"""WITH {BANK} SELECT question_id, 'qb-' || substring(sha1(source_file), 1, 12) || '-' || lpad(CAST(page_number AS VARCHAR), 3, '0') || '-' || substring(sha1(question_text), 1, 12) AS stable_id FROM bank WHERE source_file IS NOT NULL AND page_number IS NOT NULL AND question_text IS NOT NULL""")
def qb_stable_ids(spark: SparkSession, root: str) -> DataFrame:
    """Ids that another run gives again."""
    rows = bank(spark, root, "source_file", "page_number", "question_text").where("source_file is not null and page_number is not null and question_text is not null")
    return rows.select("question_id", keys.stable_id("qb", F.col("source_file"), F.col("page_number"), F.col("question_text")).alias("stable_id"))


@query(f"""WITH {BANK} SELECT question_id, CASE WHEN length(regexp_replace(upper(s), '[^DS]', '', 'g')) = 4 THEN regexp_replace(upper(s), '[^DS]', '', 'g') END AS letters
FROM (SELECT question_id, array_to_string(list_transform(from_json(statements, '["JSON"]'), lambda x: CASE json_extract_string(x, '$.answer') WHEN 'true' THEN 'd' WHEN 'false' THEN 's' ELSE '?' END), ' ') AS s FROM bank WHERE json_valid(statements))""")
def qb_truth_letters(spark: SparkSession, root: str) -> DataFrame:
    """Four letters for true/false questions whose statements are all answered."""
    rows = bank(spark, root, "statements").select("question_id", F.from_json("statements", "array<struct<label:string,text:string,answer:boolean>>").alias("s")).where("s is not null")
    spelled = F.array_join(F.transform("s", lambda x: F.when(x["answer"], "đúng").when(~x["answer"], "sai").otherwise("?")), " ")
    return rows.select("question_id", items.truth_letters(spelled).alias("letters"))
