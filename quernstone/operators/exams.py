"""Exams as documents: sections, items, audit, resolved links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quernstone.functions.values import answer_letter, section_code
from quernstone.operators.dedupe import descending, keep_one

# Expected questions of each section of the standard exam.
BLUEPRINT = (("part_i", 12), ("part_ii", 4), ("part_iii", 6))


def items(questions: DataFrame) -> DataFrame:
    """``questions`` with n_items: each statement of a true/false question counts, any other question is one item."""
    n = F.when(F.col("question_type") == "true_false", F.coalesce(F.size("statements"), F.lit(0))).otherwise(1)
    return questions.withColumn("n_items", F.greatest(n, F.lit(0)))


def has_answer():
    """Whether a question is answered, by its type."""
    letter = answer_letter(F.col("correct_answer")).isNotNull()
    statements = (F.size("statements") == 4) & F.forall("statements", lambda s: s["answer"].isNotNull())
    number = F.length(F.trim("numeric_answer")) > 0
    kind = F.col("question_type")
    return F.coalesce(F.when(kind == "multiple_choice", letter).when(kind == "true_false", statements).otherwise(number), F.lit(False))


def one_question(questions: DataFrame) -> DataFrame:
    """Repeated rows of a question are one: the earliest."""
    return keep_one(questions, ["id"], F.unix_micros("created_at"))


def best_links(links: DataFrame, questions: DataFrame, score: Column) -> DataFrame:
    """One link for each place (exam, section, number) of an exam: that of the question of the highest ``score``.

    A tie goes to the earlier link, then the lesser id.
    """
    scored = one_question(questions).select(F.col("id").alias("question_id"), score.alias("score"))
    placed = links.withColumn("section", section_code("section_code")).select("id", "exam_set_id", "question_id", "section", "question_number", "created_at").distinct()
    both = placed.join(scored, "question_id")
    return keep_one(both, ["exam_set_id", "section", "question_number"], descending(F.col("score")), F.unix_micros("created_at"), F.col("id"))


def audit(sets: DataFrame, links: DataFrame, questions: DataFrame) -> DataFrame:
    """For each exam: questions and items found, places without answer, questions to review, and what that makes of it."""
    facts = items(one_question(questions)).select(F.col("id").alias("question_id"), "n_items", has_answer().alias("answered"), "needs_review")
    places = links.select("exam_set_id", "question_id", "question_number").distinct().join(facts, "question_id")
    per = places.groupBy("exam_set_id").agg(
        F.countDistinct("question_number").alias("n_questions"), F.sum("n_items").alias("n_items"),
        F.count_if(~F.col("answered")).alias("n_unanswered"), F.count_if(F.coalesce("needs_review", F.lit(False))).alias("n_review"),
    )
    exams = sets.select(F.col("id").alias("exam_set_id"), "expected_question_count").distinct()
    n = [F.coalesce(c, F.lit(0)).alias(c) for c in ("n_questions", "n_items", "n_unanswered", "n_review")]
    out = exams.join(per, "exam_set_id", "left").select("exam_set_id", "expected_question_count", *n)
    ready = (F.col("n_questions") == F.col("expected_question_count")) & (F.col("n_unanswered") == 0)
    return out.withColumn("verdict", F.when(ready, "ready").otherwise("needs_review"))
