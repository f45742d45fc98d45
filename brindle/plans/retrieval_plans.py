"""Chunking, embedding, retrieval and training sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from brindle.operators import chunking, retrieval, trainset
from brindle.operators.generation import echo_generator
from brindle.plans.base import Catalog, table

catalog = Catalog()

_TOKENS = "'[^ \\t\\n\\r]+'"

_PACKED = f"""
WITH RECURSIVE cut AS (
  SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: x <> '') AS l FROM documents),
lines AS (SELECT doc_id, unnest(l) AS piece, generate_subscripts(l, 1) AS i FROM cut),
sized AS (SELECT *, len(regexp_extract_all(piece, {_TOKENS})) AS n FROM lines),
p AS (SELECT *, sum(n) OVER (PARTITION BY doc_id ORDER BY i)::BIGINT AS upto FROM sized),
q AS (SELECT *, upto - n AS before, lead(upto) OVER (PARTITION BY doc_id ORDER BY i) AS next_upto FROM p),
starts AS (
  SELECT e.doc_id, e.i AS e, coalesce(min(s.i), e.i + 1) AS s
  FROM q e LEFT JOIN q s ON s.doc_id = e.doc_id AND s.i <= e.i
       AND s.before >= e.upto - 100 AND s.before >= e.next_upto - 300
  WHERE e.next_upto IS NOT NULL GROUP BY e.doc_id, e.i),
steps AS (
  SELECT t.doc_id, t.e, t.s, greatest(t.e + 1, max(x.i)) AS e2
  FROM starts t JOIN q f ON f.doc_id = t.doc_id AND f.i = t.s
       JOIN q x ON x.doc_id = t.doc_id AND (x.upto <= f.before + 300 OR x.i = t.e + 1)
  GROUP BY t.doc_id, t.e, t.s),
first AS (
  SELECT doc_id, 1 AS s, greatest(1, max(CASE WHEN upto <= 300 THEN i ELSE 1 END)) AS e FROM q GROUP BY doc_id),
chunks AS (
  SELECT doc_id, s::BIGINT AS s, e::BIGINT AS e FROM first
  UNION ALL
  SELECT c.doc_id, t.s, t.e2 FROM chunks c JOIN steps t ON t.doc_id = c.doc_id AND t.e = c.e),
texts AS (
  SELECT c.doc_id, c.e, trim(string_agg(q.piece, chr(10) ORDER BY q.i), ' ' || chr(9) || chr(10) || chr(13)) AS text_chunk
  FROM chunks c JOIN q ON q.doc_id = c.doc_id AND q.i BETWEEN c.s AND c.e GROUP BY c.doc_id, c.s, c.e)
SELECT doc_id, text_chunk, md5(text_chunk) AS chunk_id FROM texts WHERE text_chunk <> ''
"""


@catalog.add("chunk_documents", _PACKED)
def _(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", spread=True).select("doc_id", "text")
    return chunking.chunk_documents(docs, "text", separator="\n").select("doc_id", "text_chunk", "chunk_id")


_CODE = "replace(replace(text, '. ', ';' || chr(10) || 'int step('), '.' || chr(10), ';' || chr(10) || chr(10))"


@catalog.add(
    "chunk_code",
    f"""WITH RECURSIVE marked AS (
          SELECT doc_id, regexp_replace(replace({_CODE}, chr(10) || chr(10), chr(1) || chr(10) || chr(10) || chr(1)),
                   '\\n([a-zA-Z_]\\w*\\s+[a-zA-Z_]\\w*\\s*\\()', chr(1) || chr(10) || chr(1) || '\\1', 'g') AS m FROM documents),
        parts AS (SELECT doc_id, string_split(m, chr(1)) AS l FROM marked),
        segs AS (SELECT doc_id, unnest(l) AS seg, generate_subscripts(l, 1) AS i, len(l) AS n FROM parts),
        fold AS (
          SELECT doc_id, i, n, seg AS cur, NULL::VARCHAR AS done FROM segs WHERE i = 1
          UNION ALL
          SELECT f.doc_id, s.i, f.n,
                 CASE WHEN length(f.cur) + length(s.seg) > 1000 AND f.cur <> '' THEN right(f.cur, 200) || s.seg ELSE f.cur || s.seg END,
                 CASE WHEN length(f.cur) + length(s.seg) > 1000 AND f.cur <> '' THEN f.cur END
          FROM fold f JOIN segs s ON s.doc_id = f.doc_id AND s.i = f.i + 1),
        chunks AS (
          SELECT doc_id, i, done AS content FROM fold WHERE done IS NOT NULL
          UNION ALL SELECT doc_id, n + 1, cur FROM fold WHERE i = n AND cur <> ''),
        numbered AS (
          SELECT doc_id::VARCHAR AS file_path, content, (row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1)::INTEGER AS chunk_index,
                 (count(*) OVER (PARTITION BY doc_id))::INTEGER AS total_chunks FROM chunks)
        SELECT md5(file_path || ':' || chunk_index || ':' || content) AS id, content, file_path, chunk_index, total_chunks FROM numbered""",
)
def _(spark, sf_dir):
    code = F.replace(
        F.replace(F.col("text"), F.lit(". "), F.lit(";\nint step(")), F.lit(".\n"), F.lit(";\n\n")
    )
    files = table(spark, sf_dir, "documents", spread=True).select(F.col("doc_id").cast("string").alias("path"), code.alias("content"))
    return chunking.chunk_code(files)


@catalog.add(
    "embed",
    f"""WITH tokens AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), {_TOKENS})) AS t FROM documents),
             counts AS (SELECT doc_id, ('0x' || substr(md5(t), 1, 8))::BIGINT % 64 AS bucket, count(*) AS n FROM tokens GROUP BY ALL)
        SELECT doc_id, bucket::INTEGER AS bucket,
               round((n / sqrt(sum(n * n) OVER (PARTITION BY doc_id)))::FLOAT::DOUBLE, 6) AS weight FROM counts""",
)
def _(spark, sf_dir):
    vectors = retrieval.embed(table(spark, sf_dir, "documents", spread=True).select("doc_id", "text"), "text").drop("text")
    weights = vectors.select("doc_id", F.posexplode("embedding").alias("bucket", "w")).filter("w <> 0")
    return weights.select("doc_id", "bucket", F.round(F.col("w").cast("double"), 6).alias("weight"))


_HITS = """
SELECT query_id, corpus_id, score, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, corpus_id)::INTEGER AS rank FROM (
    SELECT q.vec_id AS query_id, c.vec_id AS corpus_id,
           round(list_cosine_similarity(q.embedding::DOUBLE[], c.embedding::DOUBLE[]), 12) AS score
    FROM embeddings q, embeddings c)) WHERE rank <= 4
"""
_HITS_META = f"SELECT h.* REPLACE (round(score, 6) AS score), round(1 - score, 6) AS distance, label FROM ({_HITS}) h JOIN embeddings e ON e.vec_id = h.corpus_id"


def _vectors(spark, sf_dir):
    return table(spark, sf_dir, "embeddings", spread=True)


@catalog.add("retrieve_topk", _HITS_META)
def _(spark, sf_dir):
    vectors = _vectors(spark, sf_dir)
    hits = retrieval.retrieve_topk(vectors, vectors, 4, "vec_id", "vec_id", metadata=["label"])
    return hits.withColumn("score", F.round("score", 6))


@catalog.add("retrieve_topk_blocks", _HITS_META)
def _(spark, sf_dir):
    vectors = _vectors(spark, sf_dir)
    hits = retrieval.retrieve_topk(vectors, vectors, 4, "vec_id", "vec_id", metadata=["label"], broadcast_floats=0, block_rows=1000)
    return hits.withColumn("score", F.round("score", 6))


def _by_metric(score: str, distance: str) -> str:
    return f"""
    SELECT query_id, corpus_id, round(score, 6) AS score, round({distance}, 6) AS distance, rank FROM (
      SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, corpus_id)::INTEGER AS rank FROM (
        SELECT q.vec_id AS query_id, c.vec_id AS corpus_id, round({score}, 12) AS score
        FROM (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings) q, (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings) c)) WHERE rank <= 4
    """


@catalog.add("retrieve_topk_l2", _by_metric("-list_sum([(q.e[i] - c.e[i]) * (q.e[i] - c.e[i]) FOR i IN range(1, len(q.e) + 1)])", "-score"))
def _(spark, sf_dir):
    vectors = _vectors(spark, sf_dir)
    hits = retrieval.retrieve_topk(vectors, vectors, 4, "vec_id", "vec_id", metric="l2", broadcast_floats=0, block_rows=500)
    return hits.withColumn("score", F.round("score", 6)).select("query_id", "corpus_id", "score", "distance", "rank")


@catalog.add("retrieve_topk_inner_product", _by_metric("list_inner_product(q.e, c.e)", "1 - score"))
def _(spark, sf_dir):
    vectors = _vectors(spark, sf_dir)
    hits = retrieval.retrieve_topk(vectors, vectors, 4, "vec_id", "vec_id", metric="ip")
    return hits.withColumn("score", F.round("score", 6)).select("query_id", "corpus_id", "score", "distance", "rank")


# The index of four planes in each of six tables, own bucket and those across each plane.
@catalog.add(
    "retrieve_topk_approximate",
    """WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
            planes AS (SELECT t, b, [CASE WHEN md5(t || ':' || b || ':' || d)[1] < '8' THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END FOR d IN range(64)] AS s
                       FROM range(6) x(t), range(4) y(b)),
            sides AS (SELECT vec_id, t, sum(CASE WHEN list_inner_product(e, s) >= 0 THEN (1 << b) ELSE 0 END)::BIGINT AS code FROM v, planes GROUP BY ALL),
            probes AS (SELECT vec_id, t, code FROM sides UNION ALL SELECT vec_id, t, xor(code, (1 << b)::BIGINT) FROM sides, range(4) y(b)),
            near AS (SELECT DISTINCT p.vec_id AS query_id, s.vec_id AS corpus_id FROM probes p JOIN sides s USING (t, code)),
            hits AS (SELECT query_id, corpus_id, round(list_cosine_similarity(q.e, c.e), 12) AS score FROM near JOIN v q ON q.vec_id = query_id JOIN v c ON c.vec_id = corpus_id)
       SELECT query_id, corpus_id, round(score, 6) AS score, rank FROM (
         SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, corpus_id)::INTEGER AS rank FROM hits) WHERE rank <= 4""",
)
def _(spark, sf_dir):
    vectors = _vectors(spark, sf_dir)
    hits = retrieval.retrieve_topk(vectors, vectors, 4, "vec_id", "vec_id", approximate={"tables": 6, "bits": 4, "probes": 5})
    return hits.withColumn("score", F.round("score", 6)).select("query_id", "corpus_id", "score", "rank")


_CHUNKS = "SELECT vec_id AS chunk_id, 'passage ' || vec_id || ' of ' || label AS chunk_text FROM embeddings"


def _chunks(spark, sf_dir):
    text = F.concat(F.lit("passage "), "vec_id", F.lit(" of "), "label")
    return _vectors(spark, sf_dir).select(F.col("vec_id").alias("chunk_id"), text.alias("chunk_text"), "embedding")


@catalog.add(
    "retrieved_context",
    f"""SELECT query_id, 'ask ' || query_id || string_agg(chunk_text, ' ' ORDER BY rank) AS prompt
        FROM ({_HITS}) h JOIN ({_CHUNKS}) c ON c.chunk_id = h.corpus_id GROUP BY query_id""",
)
def _(spark, sf_dir):
    queries = _vectors(spark, sf_dir).select(
        F.col("vec_id").alias("query_id"), F.concat(F.lit("ask "), "vec_id").alias("request"), "embedding"
    )
    hits = retrieval.retrieve_topk(queries, _chunks(spark, sf_dir), metadata=["chunk_text"])
    return retrieval.request_with_context(queries, hits, "request", "chunk_text").select("query_id", "prompt")


# Ring order of the chunks and the first chunk after an example's place that it did not retrieve.
_PICKS = f"""
WITH hits AS ({_HITS}),
ring AS (SELECT vec_id, row_number() OVER (ORDER BY md5('0:' || vec_id), vec_id) - 1 AS position, count(*) OVER () AS n FROM embeddings),
wanted AS (
  SELECT e.vec_id AS example_id, step, (('0x' || substr(md5('0:' || e.vec_id), 1, 8))::BIGINT % n + step) % n AS position
  FROM ring e, (SELECT unnest(range(0, 6)) AS step)),
picked AS (
  SELECT w.example_id, r.vec_id AS chunk_id, row_number() OVER (PARTITION BY w.example_id ORDER BY step)::INTEGER AS pick
  FROM wanted w JOIN ring r USING (position)
  WHERE NOT EXISTS (SELECT 1 FROM hits h WHERE h.query_id = w.example_id AND h.corpus_id = r.vec_id))
"""


@catalog.add("attach_distractors", f"{_PICKS} SELECT example_id, chunk_id, pick FROM picked WHERE pick <= 2")
def _(spark, sf_dir):
    vectors = _vectors(spark, sf_dir)
    hits = retrieval.retrieve_topk(vectors, vectors, 4, "vec_id", "vec_id")
    examples = vectors.select(F.col("vec_id").alias("example_id"))
    return trainset.attach_distractors(examples, hits, _chunks(spark, sf_dir), n=2)


@catalog.add(
    "raft_dataset",
    f"""{_PICKS}, docs AS (
          SELECT query_id AS example_id, corpus_id AS chunk_id, rank FROM hits
          UNION ALL SELECT example_id, chunk_id, pick + 4 FROM picked WHERE pick <= 2)
        SELECT example_id, 'Use this: ' || string_agg(chunk_text, ' ' ORDER BY rank) || '. Answer: ' || 'ask ' || example_id AS prompt,
               'reply ' || example_id AS response
        FROM docs JOIN ({_CHUNKS}) USING (chunk_id) GROUP BY example_id""",
)
def _(spark, sf_dir):
    examples = _vectors(spark, sf_dir).select(
        F.col("vec_id").alias("example_id"),
        F.concat(F.lit("ask "), "vec_id").alias("request"),
        F.concat(F.lit("reply "), "vec_id").alias("expected_response"),
        "embedding",
    )
    template = "Use this: {context}. Answer: {question}."
    return trainset.raft_dataset(examples, _chunks(spark, sf_dir), template, distractors=2)


@catalog.add(
    "build_eval_set",
    """WITH asked AS (SELECT doc_id, text, 'Q ' || substr(md5('Write one short question that this text answers: ' || text), 1, 8) AS request FROM documents)
       SELECT doc_id::VARCHAR AS doc_uri, request, md5(doc_id || ':' || request) AS request_id,
              'Q ' || substr(md5('Answer with a short numbered list. Text: ' || text || ' Question: ' || request), 1, 8) AS expected_response,
              'A ' || substr(md5(request), 1, 8) AS response FROM asked""",
)
def _(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", spread=True).select("doc_id", "text")
    rows, _ = trainset.build_eval_set(docs, echo_generator("Q"), echo_generator("A"), "text", "doc_id")
    return rows.select(
        F.col("expected_retrieved_context")[0]["doc_uri"].alias("doc_uri"), "request", "request_id", "expected_response", "response"
    )
