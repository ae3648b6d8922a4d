"""Schemas of the engine's entities as DDL, for reads without inference and for streams."""

from __future__ import annotations

STATEMENTS = "array<struct<label: string, text: string, answer: boolean>>"
VISUAL_TABLE = "struct<kind: string, rows: array<struct<label: string, cells: array<string>>>>"

MANIFEST = "source string, relative_path string, file_name string, extension string, size_bytes bigint, modified_at timestamp, ordinal int"
PAGE = "doc string, page int, text string, used_image boolean"
BANK = (
    "question_id string, raw_document_id string, source_code string, question_type string, topic string, subtopic string, chapter string, grade int, "
    "part string, question_text string, option_a string, option_b string, option_c string, option_d string, correct_answer string, statements string, "
    "numeric_answer string, difficulty string, needs_visual boolean, visual_type string, visual_bbox array<double>, source_hint string, source_name string, "
    "source_file string, page_number int, explanation string, answer_source string, needs_review boolean, has_image boolean, image_url string, "
    "raw_text string, is_published boolean, sampled_at timestamp, imported_at timestamp"
)
PAGE_ITEM = (
    "type string, part string, topic string, subtopic string, chapter string, grade int, difficulty string, question_text string, option_a string, "
    f"option_b string, option_c string, option_d string, correct_answer string, statements {STATEMENTS}, numeric_answer string, needs_visual boolean, "
    f"visual_type string, visual_bbox array<double>, visual_table {VISUAL_TABLE}, explanation string, source_hint string"
)
BLOCK = "ordinal bigint, code string, source_file string, parser string, question_html string, question_text string, raw_block string, extracted_at timestamp"
LESSON = (
    "lesson_id bigint, source_name string, lesson_no int, relative_path string, file_name string, analysis struct<lesson_title: string, program_area: string, "
    "chapter: string, lesson_type: string, phase: string, confidence: string, objectives: array<string>, concepts: array<string>, prerequisites: array<string>, "
    "example_types: array<string>, gaps_or_warnings: array<string>>, scanned_at timestamp"
)
TOPIC = "id int, topic_code string, topic_title string, topic_order int"
SUBTOPIC = (
    "id int, topic_id int, subtopic_code string, subtopic_title string, display_title string, subtopic_order int, source_unit_id int, phase string, is_out_of_roadmap boolean"
)
EXAM_SET = (
    "id string, title string, subject string, exam_type string, source_file string, source_hash string, source_id string, exam_index int, start_page int, end_page int, "
    "total_pages int, expected_question_count int, expected_item_count int, extracted_question_count int, max_score decimal(6,2), status string, audit_json string, created_at timestamp"
)
EXAM_LINK = (
    "id string, exam_set_id string, question_id string, section_code string, question_number int, display_order int, page_number int, source_hint string, max_score decimal(6,2), created_at timestamp"
)
EXAM_QUESTION = (
    "id string, source_code string, question_type string, question_text string, option_a string, option_b string, option_c string, option_d string, correct_answer string, "
    f"statements {STATEMENTS}, numeric_answer string, explanation string, topic string, subtopic string, chapter string, difficulty string, canonical_topic_id int, "
    "canonical_subtopic_id int, needs_visual boolean, visual_type string, answer_source string, needs_review boolean, is_published boolean, created_at timestamp"
)
SEGMENT = "segment_no int, context string, question_no int, question string"
RUN_LOG = "id string, status string, error string, logged_at timestamp"
