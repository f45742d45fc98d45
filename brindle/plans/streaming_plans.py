"""Streaming runs over everything available, compared with the batch result."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from brindle.plans import payload_plans as pp
from brindle.plans.base import Catalog, table
from brindle.session import shared_path
from brindle.streaming import streams as st

catalog = Catalog()


def _parts(spark, sf_dir, name):
    """How many files a batch has: one for each split of the table."""
    return max(1, table(spark, sf_dir, name).rdd.getNumPartitions())


def _arriving(df, label, parts, batches=4):
    """The table as a folder of files, read as a stream of ``parts`` files per batch."""
    path = shared_path(df.sparkSession, label)
    df.repartition(batches * parts).write.parquet(path)
    return st.read_parquet_stream(df.sparkSession, path, df.schema, files_per_batch=parts)


def _logged(spark, payloads, label, parts):
    """Both logs of a payload table that arrives in several batches."""
    logs = st.PayloadLogs(spark, shared_path(spark, f"{label}-logs"), payloads.schema)
    st.finish(st.run_batches(_arriving(payloads, label, parts), shared_path(spark, f"{label}-state"), logs.apply))
    return logs


@catalog.add(
    "stream_request_log",
    f"""SELECT conv_id || '-' || turn AS request_id, 'c' || conv_id AS conversation_id, text AS last_input, upper(role) AS answer
        FROM conversations WHERE {pp._OK} AND role <> 'system'""",
)
def _(spark, sf_dir):
    rows = _logged(spark, pp.chat_payloads(spark, sf_dir), "payloads", _parts(spark, sf_dir, "conversations")).read("request_log")
    return rows.select(
        "request.request_id", "request.conversation_id", "request.last_input", F.col("output.choices")[0]["message"]["content"].alias("answer")
    )


@catalog.add("stream_assessment_log", f"{pp._LEAVES_SQL} FROM ({pp._FEEDBACK})")
def _(spark, sf_dir):
    return pp._assessment_leaves(_logged(spark, pp.feedback_payloads(spark, sf_dir), "feedback", _parts(spark, sf_dir, "conversations")).read("assessment_log"))


# Events arrive in four batches by time; every tenth comes with the last one, most of them late.
_ARRIVAL = """CASE WHEN event_id % 10 = 0 THEN 3
                   ELSE least(3, ((epoch_us(ts) - min(epoch_us(ts)) OVER ()) * 4) // (max(epoch_us(ts)) OVER () - min(epoch_us(ts)) OVER () + 1)) END"""


@catalog.add(
    "stream_dedup_hourly_complete",
    f"""WITH arrived AS (SELECT *, date_trunc('hour', ts)::TIMESTAMP AS hour, {_ARRIVAL} AS batch FROM events),
             seen AS (SELECT batch, max(epoch_us(ts)) - 3600000000 AS clock FROM arrived GROUP BY batch),
             judged AS (SELECT a.*, coalesce(epoch_us(hour) + 3600000000 <= (SELECT max(clock) FROM seen s WHERE s.batch < a.batch), false) AS late FROM arrived a),
             best AS (SELECT * FROM judged WHERE NOT late
                      QUALIFY row_number() OVER (PARTITION BY user_id, event_type, hour ORDER BY ts DESC, event_id) = 1)
        SELECT hour, event_id, ts, user_id, event_type, value,
               CASE WHEN epoch_us(hour) + 3600000000 <= (SELECT max(clock) FROM seen) THEN 'closed' ELSE 'open' END AS state FROM best
        UNION ALL SELECT hour, event_id, ts, user_id, event_type, value, 'late' FROM judged WHERE late""",
)
def _(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    low, high = events.agg(F.min(micros), F.max(micros)).first()
    share = F.least(F.lit(3), F.expr(f"(unix_micros(cast(ts AS timestamp)) - {low or 0}L) * 4 div {(high or 0) - (low or 0) + 1}L"))
    arrival = F.when(F.col("event_id") % 10 == 0, 3).otherwise(share)
    latest = st.HourlyLatest(spark, shared_path(spark, "hourly"), events.schema, ["user_id", "event_type"], "ts", "event_id")
    folder, state = shared_path(spark, "arrived"), shared_path(spark, "hourly-state")
    for batch in range(4):
        events.where(arrival == batch).write.mode("append").parquet(folder)
        st.finish(st.run_batches(st.read_parquet_stream(spark, folder, events.schema), state, latest.apply))
    parts = (("closed", latest.closed()), ("open", latest.flush()), ("late", latest.late()))
    rows = [df.select("hour", *events.columns, F.lit(name).alias("state")) for name, df in parts]
    whole = rows[0].unionByName(rows[1]).unionByName(rows[2])
    return whole.select(*[F.col(c).cast("timestamp_ntz").alias(c) if c in ("ts", "hour") else c for c in whole.columns])


@catalog.add(
    "stream_dedup_hourly",
    """WITH closed AS (SELECT *, date_trunc('hour', ts) AS hour FROM events
                       WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 1 HOUR FROM events))
       SELECT hour, event_id, ts, user_id, event_type, value FROM (
         SELECT *, row_number() OVER (PARTITION BY user_id, event_type, hour ORDER BY ts DESC, event_id) AS rn FROM closed) WHERE rn = 1""",
)
def _(spark, sf_dir):
    schema = table(spark, sf_dir, "events").schema
    events = st.read_parquet_stream(spark, f"{sf_dir}/events.parquet*", schema).select(
        "event_id", "ts", "user_id", "event_type", "value"
    )
    latest = st.run_to_table(st.stream_dedup_hourly(events, ["user_id", "event_type"], "ts", tie_break="event_id"), "hourly")
    return latest.select(*[F.col(c).cast("timestamp_ntz").alias(c) if c in ("ts", "hour") else c for c in latest.columns])


@catalog.add(
    "stream_index_sync",
    """SELECT DISTINCT md5(text) AS chunk_id, md5(text || 'v') AS vector FROM documents
       WHERE md5(text) NOT IN (SELECT md5(text) FROM documents WHERE lang = 'es')""",
)
def _(spark, sf_dir):
    # All chunks arrive first; then those of one language are reported as deleted.
    docs = table(spark, sf_dir, "documents").select(F.md5("text").alias("chunk_id"), "text", "lang")
    arrived = docs.select("chunk_id", "text", F.lit(False).alias("gone"))
    removed = docs.filter("lang = 'es'").select("chunk_id", "text", F.lit(True).alias("gone"))
    index = st.StreamedIndex(spark, shared_path(spark, "index"), StructType().add("chunk_id", "string").add("vector", "string"))
    state = shared_path(spark, "index-state")
    folder, parts = shared_path(spark, "chunks"), _parts(spark, sf_dir, "documents")
    for change in (arrived, removed):
        change.repartition(2 * parts).write.mode("append").parquet(folder)
        stream = st.read_parquet_stream(spark, folder, change.schema, files_per_batch=parts)
        st.finish(st.stream_index_sync(stream, index, state, lambda new: new.withColumn("vector", F.md5(F.concat("text", F.lit("v")))), "gone"))
    return index.read()
