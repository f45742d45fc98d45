"""Payload logs, built from conversations and labels so that SQL can select the same leaves."""

from __future__ import annotations

from pyspark.sql import functions as F

from brindle.functions import text as tx
from brindle.operators import payload as p
from brindle.operators.ranking import dedup_assessment_logs, latest_suggestion
from brindle.plans.base import Catalog, table

catalog = Catalog()

# 2024-01-01 00:00:00 UTC in milliseconds, the start of the generated logs.
_START = 1704067200000


def chat_payloads(spark, sf_dir):
    """One served request per conversation turn; every ninth one failed, system turns got no choices."""
    turns = table(spark, sf_dir, "conversations")
    message = F.struct("role", F.col("text").alias("content"))
    hello = F.struct(F.lit("system").alias("role"), F.lit("be brief").alias("content"))
    at = F.timestamp_millis(F.col("timestamp_ms"))
    step = F.struct(
        F.concat(F.lit("s"), "turn").alias("step_id"),
        F.lit("retrieve").alias("name"),
        F.lit("RETRIEVAL").alias("type"),
        at.alias("start_timestamp"),
        F.struct(
            F.col("text").alias("query_text"),
            F.array(F.struct(F.md5("text").alias("chunk_id"), F.col("role").alias("doc_uri"), F.col("text").alias("content"))).alias("chunks"),
        ).alias("retrieval"),
        F.struct(F.concat(F.lit("Q: "), "text").alias("prompt"), F.lower("text").alias("generated_text")).alias("text_generation"),
    )
    trace = F.struct(
        F.lit("v1").alias("app_version_id"),
        at.alias("start_timestamp"),
        (F.col("turn") % 2 == 1).alias("is_truncated"),
        F.array(step).alias("steps"),
        F.struct(F.struct(F.array(message).alias("messages")).alias("request")).alias("data"),
    )
    answer = F.struct(F.struct(F.lit("assistant").alias("role"), F.upper("role").alias("content")).alias("message"))
    choices = F.when(F.col("role") != "system", F.array(answer))
    clock = turns.withColumn("timestamp_ms", F.lit(_START) + (F.col("conv_id") * 100 + F.col("turn")) * 60_007)
    options = F.struct(F.concat(F.lit("c"), "conv_id").alias("conversation_id"))
    return clock.select(
        F.concat_ws("-", "conv_id", "turn").alias("request_id"),
        F.when((F.col("conv_id") + F.col("turn")) % 9 == 0, 500).otherwise(200).alias("status_code"),
        "timestamp_ms",
        F.to_json(F.struct(F.array(hello, message).alias("messages"), options.alias("options"))).alias("request"),
        F.to_json(F.struct(choices.alias("choices"), F.struct(trace.alias("trace")).alias("output"))).alias("response"),
    )


def feedback_payloads(spark, sf_dir):
    """Two feedback payloads per labelled document: text and retrieval, later ones overriding."""
    labels = table(spark, sf_dir, "labels").withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1))))
    ratings = F.create_map(
        F.lit("correct"), F.struct((F.col("quality") == 1).alias("value"), F.concat(F.lit("r"), "doc_id").alias("rationale"))
    )
    step = F.concat(F.lit("s"), F.col("doc_id") % 7)
    text = F.struct(
        step.alias("step_id"),
        ratings.alias("ratings"),
        F.lit("fine").alias("free_text_comment"),
        F.concat_ws(" ", F.lit("edit"), "doc_id", "copy").alias("suggested_output"),
    )
    retrieval = F.struct(
        (F.col("doc_id") % 3).cast("int").alias("position"), step.alias("step_id"), ratings.alias("ratings"), F.lit("seen").alias("free_text_comment")
    )
    record = F.struct(
        F.concat(F.lit("q"), "doc_id").alias("request_id"),
        F.struct(F.lit("human").alias("type"), F.concat(F.lit("u"), F.col("doc_id") % 5).alias("id")).alias("source"),
        F.when(F.col("doc_id") % 4 != 3, F.array(text)).alias("text_assessments"),
        F.when(F.col("toxic") == 0, F.array(retrieval)).alias("retrieval_assessments"),
    )
    return labels.select(
        F.concat_ws("-", F.lit("f"), "doc_id", "copy").alias("request_id"),
        F.lit(200).alias("status_code"),
        (F.lit(_START) + F.col("doc_id") * 60_000 + F.col("copy") * 2_400_000).alias("timestamp_ms"),
        F.to_json(F.struct(F.array(record).alias("dataframe_records"))).alias("request"),
        F.lit('{"result": "ok"}').alias("response"),
    )


_MS = f"({_START} + (conv_id * 100 + turn) * 60007)"
_OK = "(conv_id + turn) % 9 <> 0"
_ID = "conv_id || '-' || turn"


@catalog.add(
    "successful_payloads",
    f"SELECT {_ID} AS request_id, make_timestamp({_MS} * 1000) AS served_at FROM conversations WHERE {_OK}",
)
def _(spark, sf_dir):
    ok = p.successful_payloads(chat_payloads(spark, sf_dir))
    return ok.select("request_id", F.col("timestamp").cast("timestamp_ntz").alias("served_at"))


@catalog.add(
    "split_payloads",
    f"""SELECT kind, count(*) AS payloads FROM (
          SELECT CASE WHEN role <> 'system' THEN 'request' ELSE 'assessment' END AS kind FROM conversations WHERE {_OK}
          UNION ALL SELECT 'assessment' FROM labels UNION ALL SELECT 'assessment' FROM labels) GROUP BY kind""",
)
def _(spark, sf_dir):
    payloads = chat_payloads(spark, sf_dir).unionByName(feedback_payloads(spark, sf_dir))
    requests, assessments = p.split_payloads(p.successful_payloads(payloads))
    kinds = requests.select(F.lit("request").alias("kind")).unionByName(assessments.select(F.lit("assessment").alias("kind")))
    return kinds.groupBy("kind").agg(F.count(F.lit(1)).alias("payloads"))


@catalog.add(
    "unpack_requests",
    f"""SELECT {_ID} AS request_id, 'c' || conv_id AS conversation_id, make_timestamp({_MS} * 1000) AS served_at,
               2::INTEGER AS messages, 'be brief' AS first_content, role AS last_role, text AS last_input, upper(role) AS answer
        FROM conversations WHERE {_OK} AND role <> 'system'""",
)
def _(spark, sf_dir):
    requests, _ = p.split_payloads(p.successful_payloads(chat_payloads(spark, sf_dir)))
    return p.unpack_requests(requests).select(
        "request.request_id",
        "request.conversation_id",
        F.col("request.timestamp").cast("timestamp_ntz").alias("served_at"),
        F.size("request.messages").alias("messages"),
        F.col("request.messages")[0]["content"].alias("first_content"),
        F.col("request.messages")[1]["role"].alias("last_role"),
        "request.last_input",
        F.col("output.choices")[0]["message"]["content"].alias("answer"),
    )


@catalog.add(
    "parse_trace",
    f"""SELECT {_ID} AS request_id, 'v1' AS app_version_id, make_timestamp({_MS} * 1000) AS started, turn % 2 = 1 AS is_truncated,
               's' || turn AS step_id, 'retrieve' AS step_name, text AS query_text, md5(text) AS chunk_id, role AS doc_uri,
               'Q: ' || text AS prompt, lower(text) AS generated_text
        FROM conversations WHERE {_OK} AND role <> 'system'""",
)
def _(spark, sf_dir):
    log, _ = p.unpack_and_split_payloads(chat_payloads(spark, sf_dir))
    steps = log.select("request.request_id", "trace", F.explode("trace.steps").alias("step"))
    return steps.select(
        "request_id",
        "trace.app_version_id",
        F.col("trace.start_timestamp").cast("timestamp_ntz").alias("started"),
        "trace.is_truncated",
        "step.step_id",
        F.col("step.name").alias("step_name"),
        "step.retrieval.query_text",
        F.col("step.retrieval.chunks")[0]["chunk_id"].alias("chunk_id"),
        F.col("step.retrieval.chunks")[0]["doc_uri"].alias("doc_uri"),
        "step.text_generation.prompt",
        "step.text_generation.generated_text",
    )


_FEEDBACK = f"""
SELECT doc_id, copy, make_timestamp(({_START} + doc_id * 60000 + copy * 2400000) * 1000) AS assessed_at, kind,
       CASE WHEN kind = 'retrieval' THEN (doc_id % 3)::INTEGER END AS position,
       CASE WHEN kind = 'text' THEN 'edit ' || doc_id || ' ' || copy END AS suggested_output, quality
FROM labels, (VALUES (0), (1)) c(copy), (VALUES ('text'), ('retrieval')) k(kind)
WHERE (kind = 'text' AND doc_id % 4 <> 3) OR (kind = 'retrieval' AND toxic = 0)
"""


def _assessment_leaves(log):
    return log.select(
        "request_id",
        "step_id",
        F.col("source.id").alias("source_id"),
        F.col("timestamp").cast("timestamp_ntz").alias("assessed_at"),
        F.when(F.col("text_assessment").isNotNull(), "text").otherwise("retrieval").alias("kind"),
        F.col("retrieval_assessment.position").alias("position"),
        F.col("text_assessment.suggested_output").alias("suggested_output"),
        F.coalesce("text_assessment.free_text_comment", "retrieval_assessment.free_text_comment").alias("comment"),
    )


_LEAVES_SQL = """SELECT 'q' || doc_id AS request_id, 's' || doc_id % 7 AS step_id, 'u' || doc_id % 5 AS source_id, assessed_at, kind,
       position, suggested_output, CASE WHEN kind = 'text' THEN 'fine' ELSE 'seen' END AS comment"""


@catalog.add("unpack_assessments", f"{_LEAVES_SQL} FROM ({_FEEDBACK})")
def _(spark, sf_dir):
    _, log = p.unpack_and_split_payloads(feedback_payloads(spark, sf_dir))
    return _assessment_leaves(log)


@catalog.add(
    "widen_ratings",
    f"""SELECT 'q' || doc_id AS request_id, copy AS copy, kind, 'correct' AS rating, quality = 1 AS bool_value,
               NULL::DOUBLE AS double_value, 'r' || doc_id AS rationale FROM ({_FEEDBACK})""",
)
def _(spark, sf_dir):
    _, log = p.unpack_and_split_payloads(feedback_payloads(spark, sf_dir))
    rated = log.select(
        "request_id",
        ((F.unix_millis("timestamp") - _START - F.substring("request_id", 2, 20).cast("long") * 60_000) / 2_400_000).cast("int").alias("copy"),
        F.when(F.col("text_assessment").isNotNull(), "text").otherwise("retrieval").alias("kind"),
        F.explode(F.coalesce("text_assessment.ratings", "retrieval_assessment.ratings")).alias("rating", "r"),
    )
    return rated.select("request_id", "copy", "kind", "rating", "r.*")


_DEDUP_SQL = """{leaves} FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id, kind{hour} ORDER BY assessed_at DESC) AS rn FROM ({feedback})) WHERE rn = 1"""


@catalog.add("dedup_assessment_logs", _DEDUP_SQL.format(leaves=_LEAVES_SQL, feedback=_FEEDBACK, hour=""))
def _(spark, sf_dir):
    _, log = p.unpack_and_split_payloads(feedback_payloads(spark, sf_dir))
    return _assessment_leaves(dedup_assessment_logs(log))


@catalog.add(
    "dedup_assessment_logs_hourly",
    _DEDUP_SQL.format(leaves=_LEAVES_SQL, feedback=_FEEDBACK, hour=", date_trunc('hour', assessed_at)"),
)
def _(spark, sf_dir):
    _, log = p.unpack_and_split_payloads(feedback_payloads(spark, sf_dir))
    return _assessment_leaves(dedup_assessment_logs(log, "hour"))


@catalog.add(
    "latest_suggestion",
    f"""SELECT 'q' || doc_id AS initial_request_id, {_START} + doc_id * 60000 + 2400000 AS timestamp_ms,
               CASE WHEN doc_id % 4 <> 3 THEN 'edit ' || doc_id || ' 1' END AS suggested_output FROM labels""",
)
def _(spark, sf_dir):
    return latest_suggestion(feedback_payloads(spark, sf_dir))


@catalog.add(
    "message_pairs",
    f"""SELECT {_ID} AS request_id, role AS asked_role, text AS asked, 'assistant' AS answered_role, upper(role) AS answered
       FROM conversations WHERE role <> 'system'""",
)
def _(spark, sf_dir):
    pairs = p.message_pairs(chat_payloads(spark, sf_dir), keep=["request_id"])
    parsed = pairs.select("request_id", F.transform("messages", lambda m: F.from_json(m, "role string, content string")).alias("m"))
    return parsed.select(
        "request_id",
        F.col("m")[0]["role"].alias("asked_role"),
        F.col("m")[0]["content"].alias("asked"),
        F.col("m")[1]["role"].alias("answered_role"),
        F.col("m")[1]["content"].alias("answered"),
    )


@catalog.add(
    "unpack_requests_two_ids",
    f"""SELECT {_ID} AS request_id, 'c' || conv_id AS conversation_id, text AS last_input, 'v1' AS app_version_id
        FROM conversations WHERE {_OK} AND role <> 'system'""",
)
def _(spark, sf_dir):
    """A table with a vendor's id, keys with its prefix, and a client's id beside it."""
    own = chat_payloads(spark, sf_dir)
    served = own.select(
        F.col("request_id").alias("vendor_request_id"),
        F.md5("request_id").alias("client_request_id"),
        "status_code",
        "timestamp_ms",
        F.replace("request", F.lit('"options":'), F.lit('"vendor_options":')).alias("request"),
        F.replace("response", F.lit('"output":'), F.lit('"vendor_output":')).alias("response"),
    )
    log, _ = p.unpack_and_split_payloads(served, id_col="vendor_request_id")
    return log.select("request.request_id", "request.conversation_id", "request.last_input", "trace.app_version_id")


def _eval_rows(spark, sf_dir):
    """Judged answers: one per labelled document, with a numbered list in two of three."""
    docs = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")
    yes = lambda c: F.when(c, "yes").otherwise("no")
    return docs.select(
        "doc_id",
        F.array(F.struct(F.col("source").alias("doc_uri"))).alias("expected_retrieved_context"),
        F.col("text").alias("request"),
        F.when(F.col("doc_id") % 3 != 0, F.concat(F.lit("1. a 2. b "), "text")).otherwise(F.col("text")).alias("response"),
        yes(F.col("quality") == 1).alias("response/judged/correctness/rating"),
        yes(F.col("toxic") == 0).alias("response/judged/safety/rating"),
    )


@catalog.add(
    "first_context_uri",
    "SELECT doc_id, source AS expected_retrieved_context, 'baseline' AS evaluation_round FROM documents JOIN labels USING (doc_id)",
)
def _(spark, sf_dir):
    tagged = p.first_context_uri(_eval_rows(spark, sf_dir), "baseline")
    return tagged.select("doc_id", "expected_retrieved_context", "evaluation_round")


@catalog.add(
    "hard_cases",
    """SELECT doc_id FROM (SELECT doc_id, quality, toxic, CASE WHEN doc_id % 3 <> 0 THEN '1. a 2. b ' || text ELSE text END AS response
         FROM documents JOIN labels USING (doc_id))
       WHERE quality <> 1 OR toxic <> 0 OR NOT (contains(response, '1.') AND contains(response, '2.'))""",
)
def _(spark, sf_dir):
    rated = ["response/judged/correctness/rating", "response/judged/safety/rating"]
    return p.hard_cases(_eval_rows(spark, sf_dir), rated, "response").select("doc_id")


@catalog.add(
    "review_cases",
    """SELECT doc_id FROM documents WHERE NOT (contains(text, '1.') AND contains(text, '2.')) AND length(text) > 200""",
)
def _(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    message = F.array(F.struct(F.lit("user").alias("role"), F.col("text").alias("content")))
    return p.review_cases(docs.select("doc_id", F.to_json(F.struct(message.alias("messages"))).alias("request"))).select("doc_id")


@catalog.add("finetune_pairs", "SELECT 'Q: ' || text AS prompt, source AS response FROM documents")
def _(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return p.finetune_pairs(docs.select(F.concat(F.lit("Q: "), "text").alias("prompt"), F.col("source").alias("expected_response")))


@catalog.add(
    "chat_history",
    """SELECT {id} AS request_id, text AS last_message, 1::INTEGER AS earlier, 'system' AS earlier_role FROM conversations
       WHERE role <> 'system' AND {ok}""".format(id=_ID, ok=_OK),
)
def _(spark, sf_dir):
    log, _ = p.unpack_and_split_payloads(chat_payloads(spark, sf_dir))
    messages = F.col("request.messages")
    return log.select(
        "request.request_id",
        tx.last_content(messages).alias("last_message"),
        F.size(tx.history(messages)).alias("earlier"),
        tx.history(messages)[0]["role"].alias("earlier_role"),
    )
