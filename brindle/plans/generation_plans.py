"""Batch generation with the offline generator, whose answers SQL can compute."""

from __future__ import annotations

from pyspark.sql import functions as F

from brindle.operators import generation as gen
from brindle.plans.base import Catalog, table

catalog = Catalog()


def _echo(tag: str, prompt: str) -> str:
    return f"('{tag} ' || substr(md5({prompt}), 1, 8))"


@catalog.add("generate_batch", f"SELECT conv_id, turn, {_echo('re', 'text')} AS completion FROM conversations")
def _(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations", spread=True)
    return gen.generate_batch(turns, "text", gen.echo_generator("re")).select("conv_id", "turn", "completion")


def _clean(text: str) -> str:
    return f"regexp_replace({text}, '[^a-zA-Z\\s]', '', 'g')"


_CATEGORY_PROMPT = "'Name category number ' || i || ' of texts about ' || domain || ', in three words or less.'"
_SYMPTOM_PROMPT = "'Name issue number ' || j || ' of the category ' || category || ' in ' || domain || ', in ten words or less.'"
_DOCUMENT = _echo("text:", "'Report the issue ' || symptom || ' in detail without naming ' || category || '.'")


@catalog.add(
    "synth_corpus",
    f"""WITH domains AS (SELECT s_name AS domain FROM supplier),
             categories AS (SELECT DISTINCT domain, {_clean(_echo('text:', _CATEGORY_PROMPT))} AS category
                            FROM domains, (SELECT unnest(range(1, 26)) AS i)),
             counted AS (SELECT *, 7 + ('0x' || substr(md5(domain || ':' || category), 1, 6))::BIGINT % 6 AS n FROM categories),
             symptoms AS (SELECT DISTINCT domain, category, {_clean(_echo('text:', _SYMPTOM_PROMPT))} AS symptom
                          FROM counted, (SELECT unnest(range(1, 13)) AS j) WHERE j <= n)
        SELECT domain, category, replace(replace(lower(replace({_DOCUMENT}, category, '')), lower(category), ''), ':', '') AS issue_description,
               substr(md5(domain || ':' || category || ':' || symptom), 1, 7) AS ticket_number FROM symptoms""",
)
def _(spark, sf_dir):
    names = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("domain"))
    return gen.synth_corpus(names, gen.echo_generator("text:"))


def outline_writer(abstracts):
    """A stand-in model: an outline with two sections and one that is too short."""
    return [f"1. About {p[-9:-1]}x 1a. So 2. Closing {len(p)}" for p in abstracts]


_OUTLINE_PROMPT = "'Write an outline with sections 1, 1a, 1b, 2 for: ' || text"
_TITLE_PROMPT = "'Write a short title for: ' || text"


def _paragraph(section: str) -> str:
    return _echo("P", f"'Write a paragraph on ' || {section} || ' for: ' || text")


_FIRST = f"'About ' || substr({_OUTLINE_PROMPT}, -9, 8) || 'x'"
_LAST = f"'Closing ' || length({_OUTLINE_PROMPT})"


@catalog.add(
    "draft_articles",
    f"""SELECT item_id, '1. ' || {_FIRST} || ' 1a. So 2. ' || {_LAST} AS outline, {_echo('T', _TITLE_PROMPT)} AS title,
               {_paragraph(f"trim({_FIRST})")} || '|' || {_paragraph(_LAST)} AS paragraphs FROM
        (SELECT item_id, regexp_replace(text, '[^a-zA-Z ]', '', 'g') AS text FROM benchmark)""",
)
def _(spark, sf_dir):
    items = table(spark, sf_dir, "benchmark").select(
        "item_id", F.regexp_replace("text", "[^a-zA-Z ]", "").alias("abstract")
    )
    drafts = gen.draft_articles(items, outline_writer, gen.echo_generator("P"), gen.echo_generator("T"), key="item_id")
    return drafts.select("item_id", "outline", "title", F.array_join("paragraphs", "|").alias("paragraphs"))


@catalog.add(
    "refine",
    f"""SELECT doc_id, {_echo('R', "'Write a paragraph on ' || source || ' for: ' || lang || ' Context: ' || text")} AS paragraph FROM documents""",
)
def _(spark, sf_dir):
    rows = table(spark, sf_dir, "documents", spread=True).select(
        "doc_id", F.col("source").alias("section"), F.col("lang").alias("abstract"), F.col("text").alias("context")
    )
    return gen.refine(rows, gen.echo_generator("R")).select("doc_id", "paragraph")


def _align_prompt(section: str) -> str:
    return (
        "'Pick the whole paragraph of the article that belongs to the section. Article: ' || text || ' Section: ' || "
        f"'a. ' || {section}"
    )


@catalog.add(
    "align_sections",
    f"""SELECT doc_id, 0::INTEGER AS position, 'a. ' || source AS section, ' ' || substr(md5({_align_prompt('source')}), 1, 8) AS paragraph FROM documents
        UNION ALL
        SELECT doc_id, 1, 'a. ' || lang, ' ' || substr(md5({_align_prompt('lang')}), 1, 8) FROM documents""",
)
def _(spark, sf_dir):
    rows = table(spark, sf_dir, "documents", spread=True).select(
        "doc_id", F.concat(F.lit("1. "), "source", F.lit(" 2. "), "lang").alias("outline"), F.col("text").alias("blog")
    )
    return gen.align_sections(rows, gen.echo_generator(gen.LEAD_IN), "doc_id")


@catalog.add("article_topics", f"""SELECT doc_id, {_echo('topic', "'Describe the topic in one sentence: ' || text")} AS topic FROM documents""")
def _(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", spread=True).select("doc_id", F.col("text").alias("blog"))
    return gen.article_topics(docs, gen.echo_generator("topic"), "doc_id")
