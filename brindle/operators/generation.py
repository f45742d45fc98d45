"""Batch text generation with an injected callable: ``list of prompts -> list of texts``.

Models are not part of this library. Calls run inside tasks, partition by partition, so the
number of partitions is the number of concurrent callers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from brindle.functions.text import clean_label, parse_outline, render_prompt, scrub_label_leak, short_id, strip_boilerplate
from brindle.session import settle

Generator = Callable[[Sequence[str]], Sequence[str]]


def echo_generator(tag: str = "echo") -> Generator:
    """Offline default: the tag and the first eight hex digits of the prompt's md5."""

    def answer(prompts: Sequence[str]) -> list[str]:
        return [f"{tag} {hashlib.md5(p.encode()).hexdigest()[:8]}" for p in prompts]

    return answer


def generate_batch(
    df: DataFrame,
    prompt: str | Column,
    generator: Generator,
    out: str = "completion",
    retries: int = 0,
    accept: Callable[[str], bool] | None = None,
    concurrency: int | None = None,
) -> DataFrame:
    """Add one completion per prompt, and ``error`` where the generator failed.

    A failed batch is retried prompt by prompt; a text that ``accept`` refuses is generated again,
    both up to ``retries`` times. Only the prompt column goes through Python.
    """

    def one(text: str) -> tuple[str | None, str | None]:
        answer = failure = None
        for _ in range(retries + 1):
            try:
                answer, failure = generator([text])[0], None
            except Exception as problem:  # the row carries its error, the job goes on
                failure = f"{type(problem).__name__}: {problem}"
                continue
            if accept is None or accept(answer):
                break
        return (answer, None) if answer is not None else (None, failure)

    def many(prompts: list[str]) -> list[tuple[str | None, str | None]]:
        try:
            answers = list(generator(prompts))
        except Exception:
            return [one(p) for p in prompts]
        fine = [accept is None or retries == 0 or accept(a) for a in answers]
        return [(a, None) if ok else one(p) for p, a, ok in zip(prompts, answers, fine)]

    @F.pandas_udf("text string, error string")
    def complete(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for prompts in batches:
            rows = pd.DataFrame({"text": None, "error": None}, index=prompts.index, dtype=object)
            known = prompts.notna()
            if known.any():
                rows.loc[known, ["text", "error"]] = many(prompts[known].tolist())
            yield rows

    # Not deterministic: a call must not be repeated or moved by the optimizer.
    complete = complete.asNondeterministic()
    if concurrency:
        df = df.repartition(concurrency)
    call = complete(F.col(prompt) if isinstance(prompt, str) else prompt)
    return df.withColumn("__done", call).select("*", F.col("__done.text").alias(out), F.col("__done.error").alias("error")).drop(
        "__done", "__prompt"
    )


def _text(df: DataFrame, template: str, values: dict[str, Column], generator: Generator, out: str) -> DataFrame:
    """A completion column from a template, without the error column."""
    return generate_batch(df.withColumn("__prompt", render_prompt(template, values)), "__prompt", generator, out).drop("error")


# Default prompts; callers may bring their own.
CATEGORY_PROMPT = "Name category number {i} of texts about {domain}, in three words or less."
SYMPTOM_PROMPT = "Name issue number {i} of the category {category} in {domain}, in ten words or less."
DOCUMENT_PROMPT = "Report the issue {symptom} in detail without naming {category}."


def synth_corpus(
    domains: DataFrame,
    generator: Generator,
    n_categories: int = 25,
    fewest: int = 7,
    most: int = 12,
    text_col: str = "issue_description",
    id_col: str = "ticket_number",
) -> DataFrame:
    """``domain, category, <text>, <id>``: categories per domain, issues per category and one
    document per distinct issue, which does not name its category."""
    seeds = domains.select("domain", F.explode(F.sequence(F.lit(1), F.lit(n_categories))).alias("i"))
    values = {"i": F.col("i").cast("string"), "domain": F.col("domain")}
    named = _text(seeds, CATEGORY_PROMPT, values, generator, "category")
    # Written out before they are used again: a generated text must not be generated twice.
    categories = settle(named.select("domain", clean_label(F.col("category")).alias("category")).distinct(), "categories")
    # Between fewest and most issues, fixed by the names so that a repeated run asks for the same.
    digest = F.conv(F.substring(F.md5(F.concat_ws(":", "domain", "category")), 1, 6), 16, 10).cast("long")
    wanted = F.lit(fewest) + F.pmod(digest, F.lit(most - fewest + 1))
    seeds = categories.withColumn("i", F.explode(F.sequence(F.lit(1), wanted.cast("int"))))
    values["category"] = F.col("category")
    issues = _text(seeds, SYMPTOM_PROMPT, values, generator, "symptom")
    symptoms = settle(issues.select("domain", "category", clean_label(F.col("symptom")).alias("symptom")).distinct(), "symptoms")
    values = {"symptom": F.col("symptom"), "category": F.col("category")}
    documents = _text(symptoms, DOCUMENT_PROMPT, values, generator, text_col)
    return documents.select(
        "domain",
        "category",
        scrub_label_leak(F.col(text_col), F.col("category")).alias(text_col),
        short_id(F.concat_ws(":", "domain", "category", "symptom")).alias(id_col),
    )


OUTLINE_PROMPT = "Write an outline with sections 1, 1a, 1b, 2 for: {abstract}"
TITLE_PROMPT = "Write a short title for: {abstract}"
SECTION_PROMPT = "Write a paragraph on {section} for: {abstract}"
CODE_PROMPT = "Write a short code example for: {paragraph}"


def draft_articles(
    df: DataFrame,
    outliner: Generator,
    writer: Generator,
    titler: Generator | None = None,
    coder: Generator | None = None,
    key: str = "article_id",
    abstract: str = "abstract",
    min_len: int = 5,
) -> DataFrame:
    """``key, outline, title, paragraphs`` per abstract, and ``code_examples`` for the body
    paragraphs if there is a ``coder``. Sections of ``min_len`` characters or less are skipped."""
    source = {"abstract": F.col(abstract)}
    outlined = _text(df.select(key, abstract), OUTLINE_PROMPT, source, outliner, "outline")
    titled = settle(_text(outlined, TITLE_PROMPT, source, titler or outliner, "title"), "outlines")
    sections = titled.select(
        key, abstract, F.posexplode(parse_outline(F.col("outline"), min_len=min_len)).alias("position", "section")
    )
    written = _text(sections, SECTION_PROMPT, {"section": F.col("section"), **source}, writer, "paragraph")
    ordered = F.array_sort(F.collect_list(F.struct("position", "paragraph")))  # sections of one outline
    articles = written.groupBy(key).agg(F.transform(ordered, lambda s: s["paragraph"]).alias("paragraphs"))
    none = F.array().cast("array<string>")
    drafts = titled.join(articles, key, "left").select(key, "outline", "title", F.coalesce("paragraphs", none).alias("paragraphs"))
    if coder is None:
        return drafts
    drafts = settle(drafts, "drafts")
    size = F.size("paragraphs")
    inner = F.filter(F.slice("paragraphs", F.lit(2), F.greatest(size - 2, F.lit(0))), lambda p: F.length(p) > 10)
    bodies = drafts.select(key, F.posexplode(inner).alias("position", "paragraph"))
    coded = _text(bodies, CODE_PROMPT, {"paragraph": F.col("paragraph")}, coder, "code")
    ordered = F.array_sort(F.collect_list(F.struct("position", "code")))
    examples = coded.groupBy(key).agg(F.transform(ordered, lambda s: s["code"]).alias("code_examples"))
    return drafts.join(examples, key, "left").withColumn("code_examples", F.coalesce("code_examples", none))


REFINE_PROMPT = "Write a paragraph on {section} for: {abstract} Context: {context}"


def refine(df: DataFrame, generator: Generator, iterations: int = 3, template: str = REFINE_PROMPT) -> DataFrame:
    """A first ``paragraph`` without context, then ``iterations`` more with it; the last one is kept."""
    values = {"section": F.col("section"), "abstract": F.col("abstract"), "context": F.lit("")}
    current = _text(df, template, values, generator, "paragraph")
    values["context"] = F.col("context")
    for _ in range(iterations):
        current = _text(current.drop("paragraph"), template, values, generator, "paragraph")
    return current


ALIGN_PROMPT = "Pick the whole paragraph of the article that belongs to the section. Article: {blog} Section: {section}"
TOPIC_PROMPT = "Describe the topic in one sentence: {blog}"
# Fixed value: the lead-in that is removed from answers.
LEAD_IN = "Here is the relevant paragraph:"


def align_sections(df: DataFrame, generator: Generator, key: str, outline: str = "outline", blog: str = "blog") -> DataFrame:
    """``key, position, section, paragraph``: the article's paragraph for every outline section."""
    sections = df.select(key, F.col(blog).alias("blog"), F.posexplode(parse_outline(F.col(outline), prefix="a. ")).alias("position", "section"))
    picked = _text(sections, ALIGN_PROMPT, {"blog": F.col("blog"), "section": F.col("section")}, generator, "paragraph")
    return picked.select(key, "position", "section", strip_boilerplate(F.col("paragraph"), [LEAD_IN]).alias("paragraph"))


def article_topics(df: DataFrame, generator: Generator, key: str, blog: str = "blog") -> DataFrame:
    return _text(df.select(key, blog), TOPIC_PROMPT, {"blog": F.col(blog)}, generator, "topic").drop(blog)
