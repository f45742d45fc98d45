"""Deduplication, top-k and positional splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from brindle.operators import ranking as r
from brindle.plans.base import Catalog, table

catalog = Catalog()

_LATEST = """
SELECT event_id, ts, user_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type{hour} ORDER BY ts DESC, event_id) AS rn FROM events)
WHERE rn = 1
"""


def _events(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")


@catalog.add("dedup_latest", _LATEST.format(hour=""))
def _(spark, sf_dir):
    return r.latest_per_key(_events(spark, sf_dir), ["user_id", "event_type"], "ts", [F.col("event_id")])


@catalog.add("dedup_latest_hourly", _LATEST.format(hour=", date_trunc('hour', ts)"))
def _(spark, sf_dir):
    return r.latest_per_key(_events(spark, sf_dir), ["user_id", "event_type"], "ts", [F.col("event_id")], "hour")


@catalog.add(
    "positional_split",
    """SELECT doc_id, n_chars, CASE WHEN row_number() OVER (ORDER BY doc_id) <= floor(0.6 * count(*) OVER ())
                                  THEN 'train' ELSE 'test' END AS split FROM documents""",
)
def _(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    train, test = r.positional_split(docs, ["doc_id"])
    return train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))


@catalog.add("shortest_documents", "SELECT doc_id, length(text)::INTEGER AS chars FROM documents ORDER BY length(text), doc_id LIMIT 100")
def _(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return r.shortest(docs, "text", 100, "doc_id").select("doc_id", F.length("text").alias("chars"))


_RANKED = "SELECT doc_id FROM (SELECT doc_id, row_number() OVER (ORDER BY length(text), doc_id) AS rn, count(*) OVER () AS n FROM documents)"


@catalog.add("all_but_longest", f"{_RANKED} WHERE rn <= n - 100")
def _(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return r.all_but_longest(docs, "text", 100, "doc_id").select("doc_id")


@catalog.add("all_but_shortest", f"{_RANKED} WHERE rn > 100")
def _(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return r.all_but_longest(docs, "text", 100, "doc_id", drop="shortest").select("doc_id")


@catalog.add("eval_holdout", f"{_RANKED} WHERE rn > 60 AND rn <= 100")
def _(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return r.eval_holdout(docs, "text", "doc_id").select("doc_id")


_CLASSES = [f"class{i}" for i in range(1, 65)]  # one per entry of the vectors


@catalog.add(
    "topn_classes",
    """WITH ranked AS (
         SELECT vec_id, i, embedding[i]::DOUBLE AS p,
                row_number() OVER (PARTITION BY vec_id ORDER BY embedding[i] DESC, i) AS rn
         FROM embeddings, (SELECT unnest(range(1, 65)) AS i))
       SELECT vec_id,
              max(CASE WHEN rn = 1 THEN 'class' || i END) AS predicted_class_1,
              round(max(CASE WHEN rn = 1 THEN p END), 6) AS predicted_probability_1,
              max(CASE WHEN rn = 2 THEN 'class' || i END) AS predicted_class_2,
              round(max(CASE WHEN rn = 2 THEN p END), 6) AS predicted_probability_2,
              max(CASE WHEN rn = 3 THEN 'class' || i END) AS predicted_class_3,
              round(max(CASE WHEN rn = 3 THEN p END), 6) AS predicted_probability_3
       FROM ranked GROUP BY vec_id""",
)
def _(spark, sf_dir):
    scores = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("scores"))
    top = r.topn_classes(scores, "scores", _CLASSES, 3).drop("scores")
    return top.select(*[F.round(c, 6).alias(c) if "probability" in c else c for c in top.columns])


@catalog.add("expand_struct", "SELECT o_orderkey, o_custkey, o_orderpriority FROM orders")
def _(spark, sf_dir):
    packed = table(spark, sf_dir, "orders").select("o_orderkey", F.struct("o_custkey", "o_orderpriority").alias("p"))
    return r.expand_struct(packed, "p")
