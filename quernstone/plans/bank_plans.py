"""Plans over the question bank: gates, fingerprints, coverage, mapping, merge, selection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quernstone.functions import keys, text, values
from quernstone.operators import coverage, dedupe, mapping, quality, rules, selection, sequences
from quernstone.plans import base
from quernstone.plans.base import BANK, bank, fold, optional, query, squash, tokens
from quernstone.runtime import table

TARGET = 60


@query(f"""WITH {BANK}, n AS (SELECT subtopic AS subtopic_title, count(*) AS n FROM bank WHERE subtopic IS NOT NULL GROUP BY 1)
SELECT s.subtopic_code, s.subtopic_title, coalesce(n.n, 0) AS n, greatest({TARGET} - coalesce(n.n, 0), 0) AS deficit,
  CASE WHEN coalesce(n.n, 0) >= {TARGET} THEN 'ok' WHEN coalesce(n.n, 0) > 0 THEN 'low' ELSE 'zero' END AS state
FROM canonical_subtopics s LEFT JOIN n USING (subtopic_title)""")
def qb_coverage(spark: SparkSession, root: str) -> DataFrame:
    """Questions of each canonical subtopic, those without any included, and what lacks to the target."""
    facts = bank(spark, root, "subtopic").select(F.col("subtopic").alias("subtopic_title"))
    dimension = table(spark, root, "canonical_subtopics").select("subtopic_code", "subtopic_title")
    return coverage.coverage(dimension, facts, "subtopic_title", TARGET).select("subtopic_code", "subtopic_title", "n", "deficit", "state")


@query(f"""WITH {BANK}, n AS (SELECT subtopic AS t, count(*) AS n FROM bank WHERE subtopic IS NOT NULL GROUP BY 1),
c AS (SELECT s.subtopic_code, greatest({TARGET} - coalesce(n.n, 0), 0) AS deficit FROM canonical_subtopics s LEFT JOIN n ON n.t = s.subtopic_title)
SELECT subtopic_code, CAST(o.ordinal AS INTEGER) AS ordinal, 'gen-' || subtopic_code || '-' || lpad(CAST(o.ordinal AS VARCHAR), 3, '0') AS generated_id
FROM c, unnest(range(1, deficit + 1)) AS o(ordinal) WHERE deficit > 0""")
def qb_backfill(spark: SparkSession, root: str) -> DataFrame:
    """A generated row for each question that a subtopic lacks."""
    return coverage.backfill(qb_coverage(spark, root), "subtopic_code", "gen")


def _rules() -> list:
    has_options = F.col("question_type") == "multiple_choice"
    n_options = F.size(F.filter(F.array("option_a", "option_b", "option_c", "option_d"), lambda o: F.coalesce(F.trim(o), F.lit("")) != ""))
    return [
        ("short_stem", F.length(F.coalesce("question_text", F.lit(""))) < 20),
        ("few_options", has_options & (n_options < 2)),
        ("repeated_options", has_options & values.has_repeated_option(*(F.col(f"option_{k}") for k in "abcd"))),
        ("missing_topic", text.optional(F.col("topic")).isNull()),
        ("missing_subtopic", text.optional(F.col("subtopic")).isNull()),
        ("missing_chapter", text.optional(F.col("chapter")).isNull()),
        ("missing_answer", has_options & values.answer_letter(F.col("correct_answer")).isNull()),
    ]


_OPTIONS = "list_filter([option_a, option_b, option_c, option_d], lambda o: coalesce(trim(o), '') <> '')"
_FOLDED = f"list_filter(list_transform([option_a, option_b, option_c, option_d], lambda o: {fold(squash('o'))}), lambda o: coalesce(o, '') <> '')"
_LETTER = f"(CASE WHEN {fold(squash('correct_answer'))} NOT IN ('n/a', 'null', 'none') AND regexp_extract({fold(squash('correct_answer'))}, '(?:^|[^a-z])([a-d])[^a-z]*$', 1) <> '' THEN upper(regexp_extract({fold(squash('correct_answer'))}, '(?:^|[^a-z])([a-d])[^a-z]*$', 1)) END)"
_ISSUES = f"""issues AS (SELECT question_id, question_type, source_name, list_filter([
  CASE WHEN length(coalesce(question_text, '')) < 20 THEN 'short_stem' END,
  CASE WHEN question_type = 'multiple_choice' AND len({_OPTIONS}) < 2 THEN 'few_options' END,
  CASE WHEN question_type = 'multiple_choice' AND len({_FOLDED}) <> len(list_distinct({_FOLDED})) THEN 'repeated_options' END,
  CASE WHEN {optional('topic')} IS NULL THEN 'missing_topic' END,
  CASE WHEN {optional('subtopic')} IS NULL THEN 'missing_subtopic' END,
  CASE WHEN {optional('chapter')} IS NULL THEN 'missing_chapter' END,
  CASE WHEN question_type = 'multiple_choice' AND {_LETTER} IS NULL THEN 'missing_answer' END], lambda x: x IS NOT NULL) AS issues FROM bank)"""
_GATE_COLUMNS = ("question_type", "question_text", "option_a", "option_b", "option_c", "option_d", "topic", "subtopic", "chapter", "correct_answer", "source_name")
_BLOCKING = ["short_stem", "few_options", "repeated_options", "missing_answer"]


def _gated(spark: SparkSession, root: str) -> DataFrame:
    return quality.gate(bank(spark, root, *_GATE_COLUMNS), _rules(), _BLOCKING).select("question_id", "question_type", "source_name", "issues", "accepted", "reason_text")


@query(f"""WITH {BANK}, {_ISSUES}
SELECT question_id, NOT list_has_any(issues, {_BLOCKING!r}) AS accepted, array_to_string(issues, '; ') AS reason_text FROM issues""")
def qb_gate(spark: SparkSession, root: str) -> DataFrame:
    """Every question with whether it is accepted and why not, in the order of the rules."""
    return _gated(spark, root).select("question_id", "accepted", "reason_text")


@query(f"""WITH {BANK}, {_ISSUES}
SELECT source_name, count(*) FILTER (NOT list_has_any(issues, {_BLOCKING!r})) AS n_accepted, count(*) FILTER (list_has_any(issues, {_BLOCKING!r})) AS n_rejected
FROM issues GROUP BY 1""")
def qb_gate_by_source(spark: SparkSession, root: str) -> DataFrame:
    """Accepted and rejected questions of each source."""
    return _gated(spark, root).groupBy("source_name").agg(F.count_if("accepted").alias("n_accepted"), F.count_if(~F.col("accepted")).alias("n_rejected"))


@query(f"""WITH {BANK}, {_ISSUES} SELECT issue, question_type, count(*) AS n FROM (SELECT question_type, unnest(issues) AS issue FROM issues) GROUP BY ALL""")
def qb_issue_histogram(spark: SparkSession, root: str) -> DataFrame:
    """How often each issue occurs in each type of question."""
    return quality.histogram(_gated(spark, root), "question_type")


@query(f"""WITH {BANK}, {_ISSUES} SELECT reason_text, count(*) AS n FROM (SELECT array_to_string(issues, '; ') AS reason_text FROM issues) GROUP BY 1""")
def qb_reason_histogram(spark: SparkSession, root: str) -> DataFrame:
    """How often each whole combination of issues occurs."""
    return _gated(spark, root).groupBy("reason_text").agg(F.count("*").alias("n"))


@query(f"""WITH {BANK}, {_ISSUES} SELECT issue, CAST(row_number() OVER (PARTITION BY issue ORDER BY question_id) AS INTEGER) AS k, question_id AS id
FROM (SELECT question_id, unnest(issues) AS issue FROM issues) QUALIFY k <= 12""")
def qb_issue_samples(spark: SparkSession, root: str) -> DataFrame:
    """Up to twelve examples of each issue."""
    return quality.samples(_gated(spark, root), "question_id", 12)


_SIGNATURE = "sha1(concat_ws(chr(10), " + ", ".join(squash(fold(f"coalesce({c}, '')")) for c in ("question_type", "question_text", "option_a", "option_b", "option_c", "option_d")) + "))"
_LOWER = "sha1(concat_ws(chr(10), " + ", ".join(squash(f"lower(coalesce({c}, ''))") for c in ("question_text", "statements")) + "))"


def _signed(spark: SparkSession, root: str) -> DataFrame:
    parts = ("question_type", "question_text", "option_a", "option_b", "option_c", "option_d")
    return bank(spark, root, *parts).select("question_id", keys.folded_signature(*(F.col(c) for c in parts)).alias("signature"))


@query(f"""WITH {BANK} SELECT signature, min(question_id) AS question_id FROM (SELECT question_id, {_SIGNATURE} AS signature FROM bank) GROUP BY 1""")
def qb_keep_first(spark: SparkSession, root: str) -> DataFrame:
    """One question for each folded content."""
    return dedupe.keep_one(_signed(spark, root), ["signature"], F.col("question_id"))


@query(f"""WITH {BANK} SELECT signature, count(*) AS n, min(question_id) AS kept, count(*) - 1 AS dropped FROM (SELECT question_id, {_SIGNATURE} AS signature FROM bank) GROUP BY 1 HAVING count(*) > 1""")
def qb_duplicates(spark: SparkSession, root: str) -> DataFrame:
    """What keeping the first of each content drops."""
    return dedupe.duplicates(_signed(spark, root), ["signature"], "question_id")


@query(f"""WITH {BANK} SELECT question_id, {_LOWER} AS signature FROM bank""")
def qb_lower_signature(spark: SparkSession, root: str) -> DataFrame:
    """The stricter fingerprint, in which accents and statements count."""
    return bank(spark, root, "question_text", "statements").select("question_id", keys.lower_signature(F.col("question_text"), F.col("statements")).alias("signature"))


_EXAM_TEXT = f"SELECT DISTINCT {squash(fold('question_text'))} AS k FROM standard_exam_questions WHERE question_text IS NOT NULL"


@query(f"""WITH {BANK} SELECT question_id FROM bank WHERE question_text IS NULL OR {squash(fold('question_text'))} NOT IN ({_EXAM_TEXT})""")
def qb_not_in_exams(spark: SparkSession, root: str) -> DataFrame:
    """Questions whose folded text no exam question has."""
    rows = bank(spark, root, "question_text").select("question_id", F.sha1(text.squash(text.fold(F.col("question_text")))).alias("k"))
    known = table(spark, root, "standard_exam_questions").select(F.sha1(text.squash(text.fold(F.col("question_text")))).alias("k")).where("k is not null")
    return dedupe.without_existing(rows, known, ["k"]).select("question_id")


@query("""WITH x AS (SELECT DISTINCT * FROM random_sources_preview), o AS (SELECT question_id, imported_at, needs_review, row_number() OVER (PARTITION BY question_id ORDER BY imported_at DESC, coalesce(needs_review, false)) AS k FROM x)
SELECT question_id, epoch_us(imported_at) AS imported_us, needs_review FROM o WHERE k = 1""")
def qb_latest(spark: SparkSession, root: str) -> DataFrame:
    """The latest import of each question wins."""
    return bank(spark, root, "imported_at", "needs_review").select("question_id", F.unix_micros("imported_at").alias("imported_us"), "needs_review")


@query("""WITH f AS (SELECT question_id, needs_review AS before FROM random_sources_preview QUALIFY row_number() OVER (PARTITION BY question_id ORDER BY imported_at, coalesce(needs_review, false)) = 1),
l AS (SELECT question_id, needs_review AS after FROM random_sources_preview QUALIFY row_number() OVER (PARTITION BY question_id ORDER BY imported_at DESC, coalesce(needs_review, false)) = 1)
SELECT 'changed' AS change, 'needs_review' AS column_name, count(*) AS n FROM f JOIN l USING (question_id) WHERE before IS DISTINCT FROM after HAVING count(*) > 0
UNION ALL SELECT 'unchanged', '*', count(*) FROM f JOIN l USING (question_id) WHERE before IS NOT DISTINCT FROM after HAVING count(*) > 0""")
def qb_import_changes(spark: SparkSession, root: str) -> DataFrame:
    """What changed between the first and the latest import of the questions."""
    rows = table(spark, root, "random_sources_preview").select("question_id", "needs_review", "imported_at")
    review = F.coalesce("needs_review", F.lit(False))
    first = dedupe.keep_one(rows, ["question_id"], F.unix_micros("imported_at"), review)
    last = dedupe.keep_one(rows, ["question_id"], -F.unix_micros("imported_at"), review)
    return dedupe.changes(first, last, "question_id", ["needs_review"])


@query(f"""WITH {BANK} SELECT answer_source, difficulty, count(*) AS n, CAST(floor(count(*) * 1000 / sum(count(*)) OVER (PARTITION BY answer_source)) AS BIGINT) AS per_mille FROM bank
WHERE answer_source IS NOT NULL GROUP BY 1, 2""")
def qb_provenance_mix(spark: SparkSession, root: str) -> DataFrame:
    """How the difficulties mix in each source of answers."""
    return coverage.mix(bank(spark, root, "answer_source", "difficulty").where("answer_source is not null"), "answer_source", "difficulty")


@query(f"""WITH {BANK} SELECT topic, count(*) AS n FROM bank GROUP BY 1 ORDER BY n DESC, topic ASC NULLS FIRST LIMIT 20""")
def qb_top_topics(spark: SparkSession, root: str) -> DataFrame:
    """The twenty most frequent topics as typed."""
    return coverage.top_counts(bank(spark, root, "topic"), "topic", 20)


@query(f"""WITH {BANK}, v AS (SELECT DISTINCT topic AS item FROM bank WHERE topic IS NOT NULL), a AS (SELECT item, {tokens('item')} AS ta FROM v),
b AS (SELECT id AS unit, {tokens('topic_title')} AS tb FROM canonical_topics),
s AS (SELECT item, unit, len(list_intersect(ta, tb)) / len(list_distinct(list_concat(ta, tb))) AS score FROM a, b WHERE len(list_intersect(ta, tb)) > 0)
SELECT item, unit, round(score, 6) AS score FROM s QUALIFY row_number() OVER (PARTITION BY item ORDER BY score DESC, unit) = 1""")
def qb_topic_by_tokens(spark: SparkSession, root: str) -> DataFrame:
    """The canonical topic of highest word similarity for each topic as typed."""
    items = bank(spark, root, "topic").select(F.col("topic").alias("item")).where("item is not null").distinct().withColumn("tokens", text.tokens(F.col("item")))
    units = table(spark, root, "canonical_topics").select(F.col("id").alias("unit"), text.tokens(F.col("topic_title")).alias("tokens"))
    return mapping.best_by_tokens(items, units).withColumn("score", F.round("score", 6))


# Keywords that all occur in a folded topic, with the topic's id.
ALIASES = ((("nguyen ham",), 3), (("tich phan",), 3), (("xac suat",), 6), (("luong giac",), 10), (("to hop",), 11), (("toi uu",), 12), (("cap so",), 8), (("vecto",), 4))
_ALIAS = "CASE " + " ".join("WHEN " + " AND ".join(f"contains({fold('item')}, '{w}')" for w in ws) + f" THEN {u}" for ws, u in ALIASES) + " END"


@query(f"""WITH {BANK}, v AS (SELECT DISTINCT topic AS item FROM bank WHERE topic IS NOT NULL), e AS (SELECT item, id AS e FROM v JOIN canonical_topics ON item = topic_title),
k AS (SELECT item, {_ALIAS} AS k FROM v), a AS (SELECT item, {tokens('item')} AS ta FROM v), b AS (SELECT id AS unit, {tokens('topic_title')} AS tb FROM canonical_topics),
s AS (SELECT item, unit, len(list_intersect(ta, tb)) / len(list_distinct(list_concat(ta, tb))) AS score FROM a, b WHERE len(list_intersect(ta, tb)) > 0),
t AS (SELECT item, unit AS t FROM s QUALIFY row_number() OVER (PARTITION BY item ORDER BY score DESC, unit) = 1)
SELECT item, coalesce(e, k, t) AS unit, CASE WHEN e IS NOT NULL THEN 'exact' WHEN k IS NOT NULL THEN 'alias' WHEN t IS NOT NULL THEN 'tokens' ELSE 'none' END AS method
FROM v LEFT JOIN e USING (item) LEFT JOIN k USING (item) LEFT JOIN t USING (item)""")
def qb_three_tier_mapping(spark: SparkSession, root: str) -> DataFrame:
    """Topics as typed mapped by exact title, else by alias, else by word similarity."""
    items = bank(spark, root, "topic").select(F.col("topic").alias("item")).where("item is not null").distinct()
    units = table(spark, root, "canonical_topics")
    exact = items.join(units.select(F.col("topic_title").alias("item"), F.col("id").alias("unit")), "item")
    alias = items.withColumn("unit", rules.all_keywords(text.fold(F.col("item")), [(w, str(u)) for w, u in ALIASES]).cast("int")).where("unit is not null")
    tokened = items.withColumn("tokens", text.tokens(F.col("item")))
    similar = mapping.best_by_tokens(tokened, units.select(F.col("id").alias("unit"), text.tokens(F.col("topic_title")).alias("tokens")))
    return mapping.three_tiers(items, exact, alias, similar)


# Ordered patterns over folded question texts.
KINDS = (("xac suat|bien co", "probability"), ("mat phang|mat cau|vecto", "space"), ("dao ham|bien thien|cuc tri", "function"), ("cau hoi|hay chon|choose", "choice"), ("chung minh", "proof"))
_KIND = lambda order: "CASE " + " ".join(f"WHEN regexp_matches({fold('question_text')}, '{p}') THEN '{k}'" for p, k in order) + " ELSE 'other' END"


@query(f"WITH {BANK} SELECT question_id, {_KIND(KINDS)} AS first_kind, {_KIND(KINDS[::-1])} AS last_kind FROM bank WHERE question_text IS NOT NULL")
def qb_rule_kinds(spark: SparkSession, root: str) -> DataFrame:
    """Kind of each question by the first and by the last rule that matches."""
    rows = bank(spark, root, "question_text").where("question_text is not null").withColumn("t", text.fold(F.col("question_text")))
    return rows.select("question_id", rules.first_match(F.col("t"), list(KINDS), "other").alias("first_kind"), rules.last_match(F.col("t"), list(KINDS), "other").alias("last_kind"))


_ALL = "list_filter([" + ", ".join(f"CASE WHEN regexp_matches({fold('question_text')}, '{p}') THEN '{k}' END" for p, k in KINDS) + "], lambda x: x IS NOT NULL)"


@query(f"WITH {BANK} SELECT kind, count(*) AS n FROM (SELECT unnest({_ALL}) AS kind FROM bank WHERE question_text IS NOT NULL) GROUP BY 1")
def qb_rule_hits(spark: SparkSession, root: str) -> DataFrame:
    """Questions that each rule matches."""
    hits = rules.all_matches(text.fold(F.col("question_text")), list(KINDS))
    return bank(spark, root, "question_text").where("question_text is not null").select(F.explode(hits).alias("kind")).groupBy("kind").agg(F.count("*").alias("n"))


@query(f"""WITH {BANK}, s AS (SELECT question_id, coalesce({optional('topic')}, CASE WHEN json_valid(raw_text) THEN json_extract_string(raw_text, '$.topic') END) AS topic FROM bank)
SELECT question_id, topic FROM s WHERE question_id IN (SELECT question_id FROM bank WHERE json_valid(raw_text))""")
def qb_field_fallback(spark: SparkSession, root: str) -> DataFrame:
    """The topic of the row, else the one inside its page item; items that are no valid JSON are left out."""
    raw = F.try_parse_json(F.col("raw_text"))
    rows = bank(spark, root, "topic", "raw_text").where(raw.isNotNull())
    return rows.select("question_id", F.coalesce(text.optional(F.col("topic")), F.try_variant_get(raw, "$.topic", "string")).alias("topic"))


@query(f"""WITH {BANK} SELECT difficulty, rank, question_id FROM (SELECT question_id, difficulty, CASE {fold(squash('difficulty'))} WHEN 'nhan biet' THEN 1 WHEN 'thong hieu' THEN 2 WHEN 'van dung' THEN 3 WHEN 'van dung cao' THEN 4 ELSE 99 END AS rank
FROM bank WHERE question_type = 'multiple_choice' AND NOT coalesce(needs_review, false)) ORDER BY rank, question_id LIMIT 15""")
def qb_easiest(spark: SparkSession, root: str) -> DataFrame:
    """The fifteen easiest multiple-choice questions that need no review."""
    rows = bank(spark, root, "question_type", "difficulty", "needs_review").where("question_type = 'multiple_choice' and not coalesce(needs_review, false)")
    return rows.select("difficulty", values.difficulty_rank(F.col("difficulty")).alias("rank"), "question_id").orderBy("rank", "question_id").limit(15)


@query(f"""WITH {BANK} SELECT source_name, question_id, CAST(row_number() OVER (PARTITION BY source_name ORDER BY CASE WHEN answer_source = 'missing' THEN 0 ELSE 1 END, sha1('seed|' || question_id), question_id) AS INTEGER) AS k
FROM bank QUALIFY k <= 3""")
def qb_stratified_sample(spark: SparkSession, root: str) -> DataFrame:
    """Three questions of each source in seeded random order, those without an answer first."""
    rows = bank(spark, root, "source_name", "answer_source")
    return selection.stratified(rows, "source_name", "question_id", F.col("answer_source") == "missing", 3, "seed").select("source_name", "question_id", "k")


@query(f"""WITH {BANK} SELECT question_type, question_id, CAST(row_number() OVER (PARTITION BY question_type ORDER BY CASE WHEN needs_visual THEN 0 ELSE 1 END, question_id) AS INTEGER) AS turn FROM bank ORDER BY turn, question_type, question_id LIMIT 20""")
def qb_diverse(spark: SparkSession, root: str) -> DataFrame:
    """Twenty questions in which the types take turns, those with a figure first."""
    return selection.diverse(bank(spark, root, "question_type", "needs_visual"), "question_type", F.coalesce("needs_visual", F.lit(False)), "question_id", 20).select("question_type", "question_id", "turn")


@query(f"""WITH {BANK}, f AS (SELECT DISTINCT source_name, source_file FROM bank WHERE source_file IS NOT NULL), n AS (SELECT *, list_reduce(list_prepend('', list_transform(regexp_extract_all(lower(source_file), '([0-9]+|[^0-9]+)'), lambda r: CASE WHEN regexp_full_match(r, '[0-9]+') THEN lpad(r, 20, '0') ELSE r END)), lambda x, y: x || y) AS k FROM f)
SELECT source_name, source_file, CAST(row_number() OVER (PARTITION BY source_name ORDER BY k, source_file) AS INTEGER) AS ordinal FROM n""")
def qb_natural_order(spark: SparkSession, root: str) -> DataFrame:
    """Files of each source in natural order."""
    files = bank(spark, root, "source_name", "source_file").where("source_file is not null").select("source_name", "source_file").distinct()
    return sequences.numbered(files, ["source_name"], [text.natural_key(F.col("source_file")), "source_file"])


@query(f"""WITH {BANK}, f AS (SELECT source_file, page_number, question_id, {optional('chapter')} AS chapter FROM bank WHERE source_file IS NOT NULL)
SELECT question_id, last_value(chapter IGNORE NULLS) OVER (PARTITION BY source_file ORDER BY page_number NULLS FIRST, question_id ROWS UNBOUNDED PRECEDING) AS carried FROM f""")
def qb_carry_forward(spark: SparkSession, root: str) -> DataFrame:
    """The chapter of each question, else the last one before it in its file."""
    rows = bank(spark, root, "source_file", "page_number", "chapter").where("source_file is not null").withColumn("chapter", text.optional(F.col("chapter")))
    return sequences.carried_forward(rows, ["source_file"], ["page_number", "question_id"], "chapter", "carried").select("question_id", "carried")


@query(f"""WITH {BANK}, r AS (SELECT source_name, question_id, length(question_text) AS size, CAST(sum(length(question_text)) OVER (PARTITION BY source_name ORDER BY question_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS running FROM bank WHERE question_text IS NOT NULL)
SELECT source_name, question_id, running FROM r WHERE running <= 8000""")
def qb_char_budget(spark: SparkSession, root: str) -> DataFrame:
    """The questions of each source up to 8,000 characters in all (a preview)."""
    rows = bank(spark, root, "source_name", "question_text").where("question_text is not null")
    return sequences.within_budget(rows, ["source_name"], ["question_id"], F.length("question_text"), 8000).select("source_name", "question_id", "running")


@query(f"""WITH {BANK} SELECT raw_document_id, count(*) AS n, min(question_id) AS first_question, CAST(min(page_number) AS INTEGER) AS page_start, CAST(max(page_number) AS INTEGER) AS page_end,
array_to_string(list_sort(list_distinct(list(question_type))), ',') AS types FROM bank WHERE raw_document_id IS NOT NULL GROUP BY 1""")
def qb_document_groups(spark: SparkSession, root: str) -> DataFrame:
    """Questions grouped by the document they came from."""
    rows = bank(spark, root, "raw_document_id", "page_number", "question_type").where("raw_document_id is not null")
    return rows.groupBy("raw_document_id").agg(
        F.count("*").alias("n"), F.min("question_id").alias("first_question"), F.min("page_number").alias("page_start"), F.max("page_number").alias("page_end"),
        F.array_join(F.array_sort(F.collect_set("question_type")), ",").alias("types"),
    )


@query(f"""WITH {BANK} SELECT source_name, kind, value, count(*) AS n FROM (SELECT source_name, unnest([{{'kind': 'difficulty', 'value': coalesce(difficulty, 'none')}}, {{'kind': 'type', 'value': coalesce(question_type, 'none')}}, {{'kind': 'visual', 'value': coalesce(visual_type, 'none')}}], recursive := true) FROM bank) GROUP BY ALL""")
def qb_nested_histograms(spark: SparkSession, root: str) -> DataFrame:
    """Difficulty, type and figure of the questions of each source, counted in one pass."""
    rows = bank(spark, root, "source_name", "difficulty", "question_type", "visual_type")
    pairs = F.array(*(F.struct(F.lit(k).alias("kind"), F.coalesce(c, F.lit("none")).alias("value")) for k, c in (("difficulty", "difficulty"), ("type", "question_type"), ("visual", "visual_type"))))
    return rows.select("source_name", F.explode(pairs).alias("p")).groupBy("source_name", "p.kind", "p.value").agg(F.count("*").alias("n"))


@query(f"""WITH {BANK} SELECT question_id, n_boxed, valid FROM (SELECT question_id, CAST(len(visual_bbox) AS INTEGER) AS n_boxed, coalesce(len(visual_bbox) = 4 AND len(list_filter(visual_bbox, lambda x: x >= 0 AND x <= 1)) = 4 AND visual_bbox[3] > visual_bbox[1] AND visual_bbox[4] > visual_bbox[2], false) AS valid FROM bank WHERE visual_bbox IS NOT NULL)""")
def qb_boxes(spark: SparkSession, root: str) -> DataFrame:
    """Boxes of figures and whether they can be one."""
    return bank(spark, root, "visual_bbox").where("visual_bbox is not null").select("question_id", F.size("visual_bbox").alias("n_boxed"), values.valid_box(F.col("visual_bbox")).alias("valid"))


@query(f"""WITH {BANK} SELECT question_id, round({base.number('numeric_answer')}, 6) AS value, {_LETTER} AS letter FROM bank""")
def qb_answers(spark: SparkSession, root: str) -> DataFrame:
    """Answers read as numbers and letters."""
    rows = bank(spark, root, "numeric_answer", "correct_answer")
    return rows.select("question_id", F.round(values.numeric_answer(F.col("numeric_answer")), 6).alias("value"), values.answer_letter(F.col("correct_answer")).alias("letter"))


@query(f"""WITH {BANK}, o AS (SELECT question_id, unnest(['A', 'B', 'C', 'D']) AS letter, unnest([option_a, option_b, option_c, option_d]) AS option FROM bank)
SELECT question_id, letter, {squash('option')} AS option FROM o WHERE coalesce({squash('option')}, '') <> ''""")
def qb_options(spark: SparkSession, root: str) -> DataFrame:
    """A row for each option."""
    rows = bank(spark, root, "option_a", "option_b", "option_c", "option_d")
    return rows.select("question_id", F.explode(values.option_map(*(F.col(f"option_{k}") for k in "abcd"))).alias("letter", "option"))


@query(f"""WITH {BANK}, s AS (SELECT question_id, unnest(from_json(statements, '[{{"label":"VARCHAR","text":"VARCHAR","answer":"BOOLEAN"}}]'), recursive := true) FROM bank WHERE json_valid(statements))
SELECT question_id, label, answer, CAST(length(text) AS INTEGER) AS n_chars FROM s""")
def qb_statements(spark: SparkSession, root: str) -> DataFrame:
    """A row for each statement of true/false questions, from its JSON."""
    rows = bank(spark, root, "statements").select("question_id", F.explode(F.from_json("statements", "array<struct<label:string,text:string,answer:boolean>>")).alias("s"))
    return rows.select("question_id", "s.label", "s.answer", F.length("s.text").alias("n_chars"))


@query(f"""WITH {BANK}, h AS (SELECT question_id, TRY_CAST(regexp_extract(source_hint, '([0-9]+)', 1) AS INTEGER) AS question_no, TRY_CAST(regexp_extract(source_hint, 'Trang ([0-9]+)', 1) AS INTEGER) AS page, page_number FROM bank WHERE source_hint IS NOT NULL)
SELECT question_id, question_no, page, page = page_number AS agrees FROM h""")
def qb_hints(spark: SparkSession, root: str) -> DataFrame:
    """Question and page number inside the source hint, and whether the page agrees."""
    rows = bank(spark, root, "source_hint", "page_number").where("source_hint is not null")
    first, page = F.regexp_extract("source_hint", "([0-9]+)", 1).try_cast("int"), F.regexp_extract("source_hint", "Trang ([0-9]+)", 1).try_cast("int")
    return rows.select("question_id", first.alias("question_no"), page.alias("page"), (page == F.col("page_number")).alias("agrees"))


@query(f"""WITH {BANK}, b AS (SELECT sha1({squash(fold('question_text'))}) AS k, explanation FROM bank WHERE question_text IS NOT NULL),
o AS (SELECT sha1({squash(fold('question_text'))}) AS k, min(explanation) AS explanation FROM standard_exam_questions WHERE question_text IS NOT NULL GROUP BY 1)
SELECT coalesce(b.k, o.k) AS k, sha1(coalesce(b.explanation, o.explanation)) AS digest, CASE WHEN b.k IS NULL THEN 'old' WHEN b.explanation IS NULL AND o.explanation IS NOT NULL THEN 'filled' ELSE 'base' END AS origin FROM b FULL JOIN o ON b.k = o.k""")
def qb_overlay(spark: SparkSession, root: str) -> DataFrame:
    """Explanations of the bank, completed from exam questions of the same folded text; exam questions the bank lacks follow."""
    k = F.sha1(text.squash(text.fold(F.col("question_text")))).alias("k")
    rows = bank(spark, root, "question_text", "explanation").where("question_text is not null").select(k, "explanation")
    old = table(spark, root, "standard_exam_questions").where("question_text is not null").select(k, "explanation").groupBy("k").agg(F.min("explanation").alias("explanation"))
    return dedupe.overlay(rows, old, ["k"], ["explanation"]).select("k", F.sha1("explanation").alias("digest"), "origin")


_FIRST = "f AS (SELECT * FROM random_sources_preview WHERE source_file IS NOT NULL QUALIFY row_number() OVER (PARTITION BY question_id ORDER BY imported_at, coalesce(needs_review, false)) = 1)"


@query(f"""WITH {_FIRST}, n AS (SELECT r.source_file, r.question_id, max(r.imported_at) AS sent_at FROM random_sources_preview r JOIN f USING (question_id) WHERE r.imported_at > f.imported_at AND r.source_file IS NOT NULL GROUP BY 1, 2)
SELECT source_file, question_id, epoch_us(imported_at) AS imported_us FROM f WHERE source_file NOT IN (SELECT source_file FROM n) UNION ALL SELECT source_file, question_id, epoch_us(sent_at) FROM n""")
def qb_replace_partition(spark: SparkSession, root: str) -> DataFrame:
    """Files of which records were sent again hold the new records only; all other files stay as first imported."""
    rows = table(spark, root, "random_sources_preview").where("source_file is not null").select("source_file", "question_id", F.unix_micros("imported_at").alias("imported_us"), F.coalesce("needs_review", F.lit(False)).alias("review"))
    first = dedupe.keep_one(rows, ["question_id"], F.col("imported_us"), F.col("review"))
    again = rows.join(first.select("question_id", F.col("imported_us").alias("first_us")), "question_id").where("imported_us > first_us")
    new = again.select("source_file", "question_id", "imported_us")
    return dedupe.replace_partition(first.select("source_file", "question_id", "imported_us"), new, "source_file", ["source_file", "question_id"], -F.col("imported_us"))


@query(f"""WITH {BANK}, s AS (SELECT question_id, trim(regexp_replace(regexp_replace({fold("coalesce(topic, '')")}, '[^a-z0-9 -]', '', 'g'), '^ +| +$', '', 'g')) AS k FROM bank)
SELECT question_id, substring(regexp_replace(regexp_replace(k, '[ -]+', '-', 'g'), '^-+|-+$', '', 'g'), 1, 50) AS slug FROM s""")
def qb_slugs(spark: SparkSession, root: str) -> DataFrame:
    """Topics as slugs."""
    return bank(spark, root, "topic").select("question_id", text.slug(F.coalesce("topic", F.lit(""))).alias("slug"))


@query(f"""WITH {BANK} SELECT question_id, array_to_string({tokens('question_text')}, ' ') AS tokens FROM bank""")
def qb_tokens(spark: SparkSession, root: str) -> DataFrame:
    """The distinct meaningful words of each question."""
    return bank(spark, root, "question_text").select("question_id", F.array_join(text.tokens(F.col("question_text")), " ").alias("tokens"))


@query(f"""WITH {BANK}, k AS (SELECT question_id, CASE WHEN length({squash('lower(question_text)')}) >= 15 THEN substring({squash('lower(question_text)')}, 1, 60) END AS k FROM bank)
SELECT k, count(*) AS n, min(question_id) AS kept FROM k WHERE k IS NOT NULL GROUP BY 1 HAVING count(*) > 1""")
def qb_prefix_keys(spark: SparkSession, root: str) -> DataFrame:
    """Questions whose texts begin alike."""
    rows = bank(spark, root, "question_text").select("question_id", keys.prefix_key(F.col("question_text")).alias("k")).where("k is not null")
    return dedupe.duplicates(rows, ["k"], "question_id").drop("dropped")


@query(f"""WITH {BANK}, r AS (SELECT question_id, list_filter(list_transform(string_split(coalesce(topic, ''), ' - '), lambda p: trim(p)), lambda p: p <> '') AS parts FROM bank)
SELECT question_id, array_to_string(list_sort(list_distinct(parts)), ' -  ') AS parts FROM r""")
def qb_delimited_sets(spark: SparkSession, root: str) -> DataFrame:
    """Delimited values as sorted sets."""
    return bank(spark, root, "topic").select("question_id", text.reason_set(F.col("topic"), " - ").alias("parts"))
