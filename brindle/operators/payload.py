"""From raw serving payloads (JSON text) to a request log and an assessment log.

Everything is stateless and stays in the JVM, so the same functions serve batch and streaming.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from brindle.functions.text import is_listed, last_content
from brindle.sources import schemas as S

# Where the parts of a payload are found. A serving product may put its name in front
# of the id column and of the option and output keys; the prefix is read off the id column.
REQUEST_ID = "request_id"
CONVERSATION_PATH = "$.{prefix}options.conversation_id"
TRACE_PATH = "$.{prefix}output.trace"
LOGGED_REQUEST_PATH = "$.{prefix}output.trace.data.request.messages[0]"


def payload_id(payloads: DataFrame, id_col: str | None = None) -> str:
    """The id column: the given one, else the only column whose name ends in ``request_id``."""
    if id_col is not None:
        return id_col
    names = [c for c in payloads.columns if c.endswith(REQUEST_ID)]
    if len(names) != 1:
        raise ValueError(f"name the id column: {len(names)} columns end in {REQUEST_ID} ({names})")
    return names[0]


def payload_prefix(payloads: DataFrame, id_col: str | None = None, prefix: str | None = None) -> str:
    """The vendor prefix of the option and output keys: the given one, else what stands before
    ``request_id`` in the name of the id column (nothing if the name ends otherwise)."""
    if prefix is not None:
        return prefix
    name = payload_id(payloads, id_col)
    return name.removesuffix(REQUEST_ID) if name.endswith(REQUEST_ID) else ""


def successful_payloads(payloads: DataFrame) -> DataFrame:
    """Payloads with status 200, with ``timestamp`` from epoch milliseconds."""
    # Compared as it is stored, string or number, so that the filter reaches the scan.
    ok = payloads.filter(F.col("status_code") == F.lit("200"))
    return ok.withColumn("timestamp", F.timestamp_millis("timestamp_ms"))


def _has_choices() -> Column:
    return F.get_json_object("response", "$.choices").isNotNull()


def split_payloads(payloads: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(requests, assessments)``: answered requests carry ``choices`` in their response."""
    return payloads.filter(_has_choices()), payloads.filter(~_has_choices())


def parse_trace(response: Column, prefix: str = "") -> Column:
    return F.from_json(F.get_json_object(response, TRACE_PATH.format(prefix=prefix)), S.TRACE)


def unpack_requests(requests: DataFrame, id_col: str | None = None, prefix: str | None = None) -> DataFrame:
    """``request``, ``trace`` and ``output`` structs of the request log."""
    prefix = payload_prefix(requests, id_col, prefix)
    # The message list is parsed once and used twice.
    parsed = requests.withColumn("messages", F.from_json(F.get_json_object("request", "$.messages"), S.MESSAGES))
    request = F.struct(
        F.col(payload_id(requests, id_col)).alias("request_id"),
        F.get_json_object("request", CONVERSATION_PATH.format(prefix=prefix)).alias("conversation_id"),
        "timestamp",
        "messages",
        last_content(F.col("messages")).alias("last_input"),
    )
    choices = F.from_json(F.get_json_object("response", "$.choices"), S.CHOICES)
    return parsed.select(
        request.alias("request"),
        parse_trace(F.col("response"), prefix).alias("trace"),
        F.struct(choices.alias("choices")).alias("output"),
    )


def widen_ratings(ratings: Column) -> Column:
    """Ratings as sent (``value``) to ratings as stored (``bool_value``, ``double_value``)."""
    return F.transform_values(
        ratings,
        lambda _, r: F.struct(
            r["value"].alias("bool_value"), F.lit(None).cast("double").alias("double_value"), r["rationale"].alias("rationale")
        ),
    )


def _stored(assessment: Column, names: tuple[str, ...]) -> Column:
    """An assessment as stored: same fields in table order, ratings widened."""
    return F.struct(*[(widen_ratings(assessment[n]) if n == "ratings" else assessment[n]).alias(n) for n in names])


def unpack_assessments(assessments: DataFrame) -> DataFrame:
    """One row per text or retrieval assessment; records with neither kind vanish."""
    no_text = F.lit(None).cast(S.TEXT_ASSESSMENT)
    no_retrieval = F.lit(None).cast(S.RETRIEVAL_ASSESSMENT)
    records = assessments.select(
        "timestamp",
        F.explode(F.from_json(F.get_json_object("request", "$.dataframe_records"), S.FEEDBACK_RECORDS)).alias("record"),
    )
    texts = F.transform(
        "record.text_assessments",
        lambda a: F.struct(
            _stored(a, S.TEXT_ASSESSMENT_FIELDS).alias("text_assessment"), no_retrieval.alias("retrieval_assessment")
        ),
    )
    retrievals = F.transform(
        "record.retrieval_assessments",
        lambda a: F.struct(
            no_text.alias("text_assessment"), _stored(a, S.RETRIEVAL_ASSESSMENT_FIELDS).alias("retrieval_assessment")
        ),
    )
    both = F.concat(F.coalesce(texts, F.array()), F.coalesce(retrievals, F.array()))
    return records.select("record.request_id", "record.source", "timestamp", F.explode(both).alias("a")).select(
        "request_id",
        F.coalesce("a.text_assessment.step_id", "a.retrieval_assessment.step_id").alias("step_id"),
        "source",
        "timestamp",
        "a.text_assessment",
        "a.retrieval_assessment",
    )


def unpack_and_split_payloads(payloads: DataFrame, id_col: str | None = None, prefix: str | None = None) -> tuple[DataFrame, DataFrame]:
    """``(request log, assessment log)`` of a payload table. Serving logs may hold several ids:
    ``id_col`` names the one to use, ``prefix`` the vendor prefix if that name does not show it."""
    requests, assessments = split_payloads(successful_payloads(payloads))
    return unpack_requests(requests, id_col, prefix), unpack_assessments(assessments)


def message_pairs(payloads: DataFrame, keep: Sequence[str] = (), id_col: str | None = None, prefix: str | None = None) -> DataFrame:
    """``[request message, response message]`` of every payload that has both, with the columns
    ``keep``."""
    asked = F.get_json_object("response", LOGGED_REQUEST_PATH.format(prefix=payload_prefix(payloads, id_col, prefix)))
    answered = F.get_json_object("response", "$.choices[0].message")
    return payloads.filter(asked.isNotNull() & answered.isNotNull()).select(*keep, F.array(asked, answered).alias("messages"))


def first_context_uri(df: DataFrame, evaluation_round: str, col: str = "expected_retrieved_context") -> DataFrame:
    """Reduce the expected context to its first document and tag the rows with the run."""
    return df.withColumn(col, F.get(col, F.lit(0))["doc_uri"]).withColumn("evaluation_round", F.lit(evaluation_round))


def hard_cases(df: DataFrame, ratings: list[str], answer: str) -> DataFrame:
    """Rows rated "no" on any rating, or whose answer is not a numbered list."""
    bad = ~is_listed(F.col(answer))
    for rating in ratings:
        bad = bad | F.coalesce(F.col(f"`{rating}`") == "no", F.lit(False))
    return df.filter(bad)


def review_cases(payloads: DataFrame, min_length: int = 200) -> DataFrame:
    """Payloads whose first message is long and not a numbered list, for expert review."""
    content = F.get_json_object("request", "$.messages[0].content")
    return payloads.filter(~is_listed(content) & (F.length(content) > min_length))


def finetune_pairs(df: DataFrame) -> DataFrame:
    return df.select("prompt", F.col("expected_response").alias("response"))
