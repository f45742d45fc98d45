"""Schemas of payload, request-log and assessment-log records."""

from __future__ import annotations

# Field names, types and order of the log formats.
MESSAGE = "struct<role: string, content: string>"
MESSAGES = f"array<{MESSAGE}>"
CHOICES = f"array<struct<message: {MESSAGE}>>"

CHUNK = "struct<chunk_id: string, doc_uri: string, content: string>"
RETRIEVAL = f"struct<query_text: string, chunks: array<{CHUNK}>>"
TEXT_GENERATION = "struct<prompt: string, generated_text: string>"
TRACE_STEP = (
    "struct<step_id: string, name: string, type: string, start_timestamp: timestamp, end_timestamp: timestamp, "
    f"retrieval: {RETRIEVAL}, text_generation: {TEXT_GENERATION}>"
)
TRACE = (
    "struct<app_version_id: string, start_timestamp: timestamp, end_timestamp: timestamp, "
    f"is_truncated: boolean, steps: array<{TRACE_STEP}>>"
)
REQUEST = (
    "struct<request_id: string, conversation_id: string, timestamp: timestamp, "
    f"messages: {MESSAGES}, last_input: string>"
)
REQUEST_LOG = f"struct<request: {REQUEST}, trace: {TRACE}, output: struct<choices: {CHOICES}>>"

SOURCE = "struct<type: string, id: string, tags: map<string, string>>"
WIRE_RATINGS = "map<string, struct<value: boolean, rationale: string>>"
TABLE_RATINGS = "map<string, struct<bool_value: boolean, double_value: double, rationale: string>>"


def _text_assessment(ratings: str) -> str:
    return f"struct<step_id: string, ratings: {ratings}, free_text_comment: string, suggested_output: string>"


def _retrieval_assessment(ratings: str) -> str:
    return f"struct<position: int, step_id: string, ratings: {ratings}, free_text_comment: string>"


TEXT_ASSESSMENT = _text_assessment(TABLE_RATINGS)
RETRIEVAL_ASSESSMENT = _retrieval_assessment(TABLE_RATINGS)
TEXT_ASSESSMENT_FIELDS = ("step_id", "ratings", "free_text_comment", "suggested_output")
RETRIEVAL_ASSESSMENT_FIELDS = ("position", "step_id", "ratings", "free_text_comment")
FEEDBACK_RECORDS = (
    f"array<struct<request_id: string, step_id: string, source: {SOURCE}, "
    f"text_assessments: array<{_text_assessment(WIRE_RATINGS)}>, "
    f"retrieval_assessments: array<{_retrieval_assessment(WIRE_RATINGS)}>>>"
)
ASSESSMENT_LOG = (
    f"struct<request_id: string, step_id: string, source: {SOURCE}, timestamp: timestamp, "
    f"text_assessment: {TEXT_ASSESSMENT}, retrieval_assessment: {RETRIEVAL_ASSESSMENT}>"
)
