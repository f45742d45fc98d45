"""Training sets that mix retrieved passages with distractors, and question sets from chunks."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from brindle.operators.generation import generate_batch
from brindle.operators.retrieval import retrieve_topk
from brindle.functions.text import render_prompt, strip_boilerplate
from brindle.session import settle

_HEX_ROWS = 100_000


def _digest(seed: int, key: Column | str) -> Column:
    key = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def shuffled_index(df: DataFrame, key: str, seed: int = 0) -> tuple[DataFrame, int]:
    """``(key, position)`` with dense 0-based positions in md5 order, and the number of rows.

    Rows are numbered inside buckets of equal leading hex digits, which are even for unique keys;
    the buckets' offsets are a small table. No sort passes through one task.
    """
    keys = settle(df.select(key).withColumn("digest", _digest(seed, key)), "digests")
    total = keys.count()
    digits = 1
    while digits < 5 and total > _HEX_ROWS * 16**digits:
        digits += 1
    keys = keys.withColumn("bucket", F.substring("digest", 1, digits))
    counts = settle(keys.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")), "buckets")
    # At most 16**5 rows, however large the table is.
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("bucket").orderBy("digest", key)
    numbered = keys.withColumn("n", F.row_number().over(inside)).join(settle(offsets, "offsets"), "bucket")
    return numbered.select(key, (F.col("offset") + F.col("n") - 1).alias("position")), total


def attach_distractors(
    examples: DataFrame, hits: DataFrame, chunks: DataFrame, n: int = 1, k: int = 4,
    example_id: str = "example_id", chunk_id: str = "chunk_id", seed: int = 0,
) -> DataFrame:
    """n random chunks per example that are not among its own hits: ``example_id, chunk_id, pick``.

    Chunks are put in a random circular order; an example starts at a random place and takes the
    first n chunks that it did not retrieve. Among n + k neighbours at most k are hits, so this is
    exact and needs one equi-join on the position.
    """
    index, total = shuffled_index(chunks, chunk_id, seed)
    start = F.pmod(F.conv(F.substring(_digest(seed, example_id), 1, 8), 16, 10).cast("long"), F.lit(max(total, 1)))
    steps = F.sequence(F.lit(0), F.lit(max(min(n + k, total) - 1, 0)))
    wanted = examples.select(example_id, start.alias("start"), F.explode(steps).alias("step")).select(
        example_id, "step", F.pmod(F.col("start") + F.col("step"), F.lit(max(total, 1))).alias("position")
    )
    own = hits.select(F.col("query_id").alias(example_id), F.col("corpus_id").alias(chunk_id))
    candidates = wanted.join(index, "position").join(own, [example_id, chunk_id], "left_anti")
    first = Window.partitionBy(example_id).orderBy("step")
    return (
        candidates.withColumn("pick", F.row_number().over(first)).filter(F.col("pick") <= n).select(example_id, chunk_id, "pick")
    )


def split_template(template: str) -> tuple[str, str]:
    """What stands before and after ``{context}``, without the closing ``{question}.``"""
    head, _, tail = template.replace("{question}.", "").partition("{context}")
    return head, tail


def raft_dataset(
    examples: DataFrame,
    chunks: DataFrame,
    template: str,
    k: int = 4,
    distractors: int = 1,
    example_id: str = "example_id",
    chunk_id: str = "chunk_id",
    chunk_text: str = "chunk_text",
    vector: str = "embedding",
    seed: int = 0,
) -> DataFrame:
    """``prompt, response`` pairs: the k chunks nearest to the expected answer plus distractors,
    between head and tail of the template, followed by the request.

    ``examples`` holds ``request``, ``expected_response`` and the response's vector.
    """
    hits = settle(
        retrieve_topk(examples, chunks, k, example_id, chunk_id, vector, vector).select("query_id", "corpus_id", "rank"),
        "hits",
    )
    extra = attach_distractors(examples.select(example_id), hits, chunks.select(chunk_id), distractors, k, example_id, chunk_id, seed)
    picked = hits.select(F.col("query_id").alias(example_id), F.col("corpus_id").alias(chunk_id), "rank").unionByName(
        extra.select(example_id, chunk_id, (F.col("pick") + k).alias("rank"))
    )
    texts = picked.join(chunks.select(chunk_id, chunk_text), chunk_id)
    ordered = F.array_sort(F.collect_list(F.struct("rank", F.col(chunk_text).alias("text"))))  # k + n per example
    docs = texts.groupBy(example_id).agg(F.array_join(F.transform(ordered, lambda d: d["text"]), " ").alias("docs"))
    head, tail = split_template(template)
    prompt = F.concat(F.lit(head), F.coalesce("docs", F.lit("")), F.lit(tail), F.col("request"))
    return examples.join(docs, example_id, "left").select(
        example_id, prompt.alias("prompt"), F.col("expected_response").alias("response")
    )


# Default prompts of the question set; callers may bring their own.
QUESTION_PROMPT = "Write one short question that this text answers: {context}"
ANSWER_PROMPT = "Answer with a short numbered list. Text: {context} Question: {question}"


def build_eval_set(
    chunks: DataFrame,
    generator: Callable[[Sequence[str]], Sequence[str]],
    answerer: Callable[[Sequence[str]], Sequence[str]] | None = None,
    chunk_text: str = "chunk_text",
    doc_uri: str = "doc_uri",
    retries: int = 4,
    question_prompt: str = QUESTION_PROMPT,
    answer_prompt: str = ANSWER_PROMPT,
) -> tuple[DataFrame, DataFrame]:
    """``(evaluation set, failed rows)``: per chunk a question, the expected answer and context,
    and the answer of the system under test (``answerer``, or the generator).

    A question that mentions the word "chunk" is asked again up to ``retries`` times.
    """
    asked = generate_batch(
        chunks.withColumn("__prompt", render_prompt(question_prompt, {"context": F.col(chunk_text)})),
        "__prompt", generator, out="request", retries=retries, accept=lambda q: "chunk" not in q,
    ).withColumn("request", strip_boilerplate(F.col("request"), ["1. "]))
    answer = render_prompt(answer_prompt, {"context": F.col(chunk_text), "question": F.col("request")})
    answered = generate_batch(
        asked.withColumnRenamed("error", "question_error").withColumn("__prompt", answer),
        "__prompt", generator, out="expected_response",
    )
    replied = generate_batch(
        answered.withColumnRenamed("error", "answer_error"), "request", answerer or generator, out="response"
    )
    error = F.coalesce("question_error", "answer_error", "error")
    rows = replied.select(
        F.array(F.struct(F.col(doc_uri).cast("string").alias("doc_uri"))).alias("expected_retrieved_context"),
        "request",
        "expected_response",
        F.md5(F.concat_ws(":", doc_uri, "request")).alias("request_id"),
        "response",
        error.alias("error"),
    )
    # The models ran once; both parts read their written answers.
    rows = settle(rows, "eval-set")
    return rows.filter("error IS NULL").drop("error"), rows.filter("error IS NOT NULL").select(
        "expected_retrieved_context", "error"
    )
