"""Declared schemas; JSON is never inferred, as an all-null column would come out wrong."""

from __future__ import annotations

SCORES = "struct<groundedness int, specificity int, completeness int>"
CHECK = "struct<unanswerable boolean, plausible boolean, abstention_answer boolean>"
PAGE = "source_file string, page int, page_content string"
CHUNK = "source_file string, page int, start_index int, page_content string"
PAIR = "question string, answer string, question_type string, answerable boolean, source string, page int, chunk_text string"
DATASET = "question string, answer string, source string, page int, question_type string, answerable boolean, quality_score int"
GRADED = f"{PAIR}, quality_score int, scores {SCORES}, reject_reason string"
DUPLICATE = (
    "removed_question string, removed_answer string, duplicate_of_question string, duplicate_of_answer string, "
    "similarity double, lexical_overlap double, source string, page int, question_type string, quality_score int"
)
UNANSWERABLE = f"question string, answer string, source string, page int, in_dataset boolean, check {CHECK}, reject_reason string"
CHECKPOINT = "fingerprint string, key string, payload string"
MESSAGES = "array<struct<role: string, content: string>>"

#: The columns of the training file, in order; everything else stays inside.
EXPORT_FIELDS = ("question", "answer", "source", "page", "question_type", "answerable", "quality_score")
CRITERIA = ("groundedness", "specificity", "completeness")
