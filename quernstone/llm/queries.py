"""The pN_ queries: each problem's operator over its whole tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quernstone.llm import answers, canonical, encoding, forms, neardup, packing, reading, scans, splits
from quernstone.runtime import materialize, one_row_each, shared_dir, table


def _questions(spark: SparkSession, root: str) -> DataFrame:
    bank = table(spark, root, "random_sources_preview").select(F.col("question_id").alias("id"), F.col("question_text").alias("text"))
    return bank.unionByName(table(spark, root, "standard_exam_questions").select("id", F.col("question_text").alias("text")))


def p1_found(spark: SparkSession, root: str) -> DataFrame:
    return neardup.record_pairs(*neardup.near_duplicates(_questions(spark, root)))


def p1_groups(spark: SparkSession, root: str) -> DataFrame:
    """The group of records that hold the same question, and the links of each record's class."""
    return splits.groups(*neardup.near_duplicates(_questions(spark, root)))


#: Fields of the bank with the list, id and title that are canonical for them.
CANONICAL = {
    "topic": ("canonical_topics", "topic_title"),
    "subtopic": ("canonical_subtopics", "subtopic_title"),
    "chapter": ("canonical_chapters", "chapter_title"),
}


def p3_found(spark: SparkSession, root: str) -> DataFrame:
    bank = table(spark, root, "random_sources_preview")
    fields = F.explode(F.array(*(F.struct(F.lit(f).alias("list"), F.col(f).alias("value")) for f in CANONICAL))).alias("f")
    records = bank.select(F.col("question_id").alias("key"), fields).select("key", "f.list", "f.value")
    entries = None
    for field, (name, title) in CANONICAL.items():
        part = table(spark, root, name).select(F.lit(field).alias("list"), "id", F.col(title).alias("title"))
        entries = part if entries is None else entries.unionByName(part)
    return canonical.map_records(records, entries).select(F.col("key").alias("question_id"), F.col("list").alias("field_name"), F.col("id").alias("canonical_id"))


def _scan_study(spark: SparkSession, root: str, flat: bool = False):
    """The scanned texts with what is known of them, and the flat texts (row_key, flat, block) if they are looked at too."""
    bank = table(spark, root, "random_sources_preview")
    blocks = table(spark, root, "mineru_preview_10_questions").select(F.col("ordinal").alias("row_key"), F.col("raw_block").alias("text"))
    clean = bank.select(F.col("question_text").alias("text")).unionByName(table(spark, root, "standard_exam_questions").select(F.col("question_text").alias("text")))
    texts = scans.scanned(blocks, bank.select(F.col("question_id").alias("row_key"), F.col("raw_text").alias("raw")))
    labelled = bank.select(F.col("question_id").alias("key"), F.col("raw_text").alias("raw"), F.col("question_text").alias("clean"))
    if not flat:
        return texts, *scans.study(texts, clean, labelled), None
    pages = table(spark, root, "mineru_preview_10_questions").select(F.col("ordinal").alias("row_key"), F.col("question_text").alias("flat"))
    flats = materialize(scans.flat_texts(pages, texts.where(F.col("source_table") == "mineru_preview_10_questions")), "flat-texts")
    return texts, *scans.study(texts.unionByName(scans.strays(flats)), clean, labelled), flats


def p4_found(spark: SparkSession, root: str) -> DataFrame:
    _, looked, meant, _, _ = _scan_study(spark, root)
    return scans.defects(looked, meant)


def p4_repaired(spark: SparkSession, root: str) -> DataFrame:
    """Each scanned text repaired; ``field`` tells the raw_block and the question_text of one key apart."""
    texts, looked, meant, _, flats = _scan_study(spark, root, flat=True)
    field = F.when(F.col("source_table") == "random_sources_preview", "raw_text").otherwise("raw_block")
    lined = scans.repaired(texts, looked, meant).withColumn("field", field)
    flat = scans.repaired_flat(flats, looked, meant, "mineru_preview_10_questions").withColumn("field", F.lit("question_text"))
    return lined.unionByName(flat)


def _form_prints(spark: SparkSession, root: str) -> DataFrame:
    bank = forms.fingerprints(table(spark, root, "random_sources_preview"), "question_id", "question_text")
    lessons = forms.fingerprints(table(spark, root, "curriculum_scan"), "lesson_id", "file_name")
    return bank.withColumn("source_table", F.lit("random_sources_preview")).unionByName(lessons.withColumn("source_table", F.lit("curriculum_scan")))


def p5_found(spark: SparkSession, root: str) -> DataFrame:
    return forms.same_looking_pairs(_form_prints(spark, root))


def p5_groups(spark: SparkSession, root: str) -> DataFrame:
    """The class of equal forms of every record, and in how many different texts its form is stored."""
    return forms.same_looking_groups(_form_prints(spark, root))


def p2_found(spark: SparkSession, root: str) -> DataFrame:
    """A record without a file ties nothing here, so such records are left out before the ties are made."""
    bank = table(spark, root, "random_sources_preview").where("source_file is not null")
    records, nodes, ties = splits.bank_graph(bank)
    return splits.file_pairs(records, splits.update_components(nodes, ties, table(spark, root, "split_targets")))


def p2_splits(spark: SparkSession, root: str) -> DataFrame:
    """The split of every record; records without a file stay with those that hold the same question."""
    records, nodes, ties = splits.bank_graph(table(spark, root, "random_sources_preview"))
    placed = splits.update_components(nodes, ties, table(spark, root, "split_targets"))
    return records.select("id", "node").distinct().join(placed.select("node", "split"), "node").select(F.col("id").alias("question_id"), "split")


def p2_batches(spark: SparkSession, root: str) -> DataFrame:
    """Splits given in two runs over the persisted component table: the older half of the time the imports span, then the rest.

    ``batch`` tells in which run the record came.  The second run's ties are those of its records with all
    records; records of the first run keep their split, or are quarantined with it kept in ``old_split``.
    """
    bank, targets = table(spark, root, "random_sources_preview"), table(spark, root, "split_targets")
    path = f"{shared_dir(spark)}/components-{uuid.uuid4().hex}"
    came = bank.where("question_id is not null").groupBy("question_id").agg(F.min("imported_at").alias("came"))
    span = came.agg(((F.min(F.unix_micros("came")) + F.max(F.unix_micros("came"))) / 2).alias("middle")).first().middle or 0.0
    first = came.where(F.coalesce(F.unix_micros("came") <= span, F.lit(True))).select("question_id")
    old, nodes, ties = splits.bank_graph(bank.join(first, "question_id", "left_semi"))
    splits.add_batch(spark, path, nodes, ties, targets)
    records, _, ties = splits.bank_graph(bank)
    batches = records.join(old.select("id").distinct().withColumn("batch", F.lit(1)), "id", "left").select("id", "node", F.coalesce("batch", F.lit(2)).alias("batch")).distinct()
    added = batches.where("batch = 2").groupBy("node").agg(F.count("*").alias("size"))
    placed = splits.add_batch(spark, path, added, ties, targets)
    return batches.join(placed, "node").select(F.col("id").alias("question_id"), "batch", "component", "split", "old_split")


def p6_found(spark: SparkSession, root: str) -> DataFrame:
    rows = table(spark, root, "standard_exam_questions").select(
        "id", F.col("question_type").alias("kind"), F.col("question_text").alias("question"), F.col("correct_answer").alias("answer"), F.col("explanation").alias("response")
    )
    return answers.defects(rows).select(F.col("id").alias("question_id"), "defect")


def p7_ids(spark: SparkSession, root: str) -> DataFrame:
    return encoding.with_ids(one_row_each(table(spark, root, "documents").select("doc_id", "text"), ["doc_id"]))


def p8_packing(spark: SparkSession, root: str) -> DataFrame:
    return packing.pack(table(spark, root, "documents"))


def p9_found(spark: SparkSession, root: str) -> DataFrame:
    documents = table(spark, root, "documents")
    return reading.with_level(documents, reading.train(reading.labelled(documents, table(spark, root, "reading_labels"))))


def queries() -> dict:
    return {
        "p1_found": p1_found, "p1_groups": p1_groups,
        "p2_found": p2_found, "p2_splits": p2_splits, "p2_batches": p2_batches,
        "p3_found": p3_found,
        "p4_found": p4_found, "p4_repaired": p4_repaired,
        "p5_found": p5_found, "p5_groups": p5_groups,
        "p6_found": p6_found,
        "p7_ids": p7_ids,
        "p8_packing": p8_packing,
        "p9_found": p9_found,
    }


def oracle_sql() -> dict[str, str]:
    return {}
