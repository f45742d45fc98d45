"""Text expressions over documents, parts and conversations."""

from __future__ import annotations

from pyspark.sql import functions as F

from brindle.functions import text as tx
from brindle.operators import chat
from brindle.plans.base import Catalog, table

catalog = Catalog()

# DuckDB spelling of the whitespace that is trimmed.
_WS = "' ' || chr(9) || chr(10) || chr(13) || chr(11) || chr(12)"


@catalog.add("content_id", "SELECT doc_id, md5(text) AS chunk_id, md5(source || ':' || doc_id || ':' || text) AS code_id FROM documents")
def _(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        tx.content_id(F.col("text")).alias("chunk_id"),
        tx.content_id(F.col("source"), F.col("doc_id"), F.col("text")).alias("code_id"),
    )


@catalog.add("short_id", "SELECT c_custkey, substr(md5(c_custkey::VARCHAR), 1, 7) AS ticket FROM customer")
def _(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", tx.short_id(F.col("c_custkey")).alias("ticket"))


@catalog.add(
    "scrub_label_leak",
    """SELECT doc_id, replace(replace(lower(replace(text, lang, '')), lower(lang), ''), ':', '') AS scrubbed FROM documents""",
)
def _(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", tx.scrub_label_leak(F.col("text"), F.col("lang")).alias("scrubbed"))


@catalog.add("clean_labels", "SELECT DISTINCT regexp_replace(p_brand || ' ' || p_name, '[^a-zA-Z\\s]', '', 'g') AS label FROM part")
def _(spark, sf_dir):
    labels = F.concat_ws(" ", "p_brand", "p_name")
    return table(spark, sf_dir, "part").select(tx.clean_label(labels).alias("label")).distinct()


# Documents hold few markers; the names of the source and language give every text two more.
_OUTLINED = "'1. ' || source || ' 1a. ' || text || ' 2. ' || lang"


@catalog.add(
    "parse_outline",
    f"""WITH split AS (SELECT doc_id, unnest(regexp_split_to_array({_OUTLINED}, '\\d+[a-zA-Z]?\\.')) AS raw,
                             generate_subscripts(regexp_split_to_array({_OUTLINED}, '\\d+[a-zA-Z]?\\.'), 1) AS i FROM documents),
             kept AS (SELECT doc_id, i, trim(raw, {_WS}) AS section FROM split WHERE length(trim(raw, {_WS})) > 0)
        SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1)::INTEGER AS position, section,
               'a. ' || section AS prefixed FROM kept""",
)
def _(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    text = F.concat(F.lit("1. "), "source", F.lit(" 1a. "), "text", F.lit(" 2. "), "lang")
    pairs = F.arrays_zip(tx.parse_outline(text).alias("section"), tx.parse_outline(text, prefix="a. ").alias("prefixed"))
    return docs.select("doc_id", F.posexplode(pairs).alias("position", "pair")).select(
        "doc_id", "position", F.col("pair")["section"].alias("section"), F.col("pair")["prefixed"].alias("prefixed")
    )


@catalog.add(
    "body_paragraphs",
    """WITH lines AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents),
            pieces AS (SELECT doc_id, len(l) AS n, unnest(l) AS paragraph, generate_subscripts(l, 1) AS i FROM lines)
       SELECT doc_id, paragraph, count(*) AS times FROM pieces
       WHERE i > 1 AND i < n AND length(paragraph) > 10 GROUP BY doc_id, paragraph""",
)
def _(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    lines = docs.select("doc_id", F.explode(tx.body_paragraphs(F.col("text"))).alias("paragraph"))
    return lines.groupBy("doc_id", "paragraph").agg(F.count(F.lit(1)).alias("times"))


@catalog.add(
    "render_prompt",
    "SELECT conv_id, turn, 'As ' || role || ', answer: ' || text || '. Be brief, ' || role || '!' AS prompt FROM conversations",
)
def _(spark, sf_dir):
    prompt = tx.render_prompt("As {role}, answer: {question}. Be brief, {role}!", {"role": F.col("role"), "question": F.col("text")})
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", prompt.alias("prompt"))


@catalog.add(
    "format_context",
    """SELECT doc_id, '`' || text || '``' || lang || '`' AS context, 'From ' || source || ':' || chr(10) || '```c' || chr(10) || text
              || chr(10) || '```' || chr(10) || chr(10) AS code FROM documents""",
)
def _(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        tx.format_context(F.array("text", "lang")).alias("context"),
        tx.code_context(F.col("source"), F.col("text")).alias("code"),
    )


@catalog.add(
    "last_message",
    "SELECT conv_id, arg_max(text, turn) AS question FROM conversations GROUP BY conv_id",
)
def _(spark, sf_dir):
    return chat.last_user_query(table(spark, sf_dir, "conversations"), "conv_id", "turn", "text")


@catalog.add(
    "last_user_query",
    "SELECT conv_id, arg_max(text, turn) AS question FROM conversations WHERE role = 'user' GROUP BY conv_id",
)
def _(spark, sf_dir):
    return chat.last_user_query(table(spark, sf_dir, "conversations"), "conv_id", "turn", "text", role="user")


@catalog.add(
    "earlier_turns",
    """SELECT conv_id, turn, role, text FROM conversations c
       WHERE turn < (SELECT max(turn) FROM conversations d WHERE d.conv_id = c.conv_id)""",
)
def _(spark, sf_dir):
    return chat.chat_history(table(spark, sf_dir, "conversations"), "conv_id", "turn")


@catalog.add(
    "strip_tool_calls",
    f"""SELECT conv_id, turn, trim(text || ' end', {_WS}) AS cleaned, trim(text, {_WS}) AS nested FROM conversations""",
)
def _(spark, sf_dir):
    tagged = F.concat(F.lit("<tool_call>find\n"), "role", F.lit("</tool_call>\n"), "text", F.lit("<tool_call_result>7</tool_call_result> end "))
    nested = F.concat("text", F.lit("<tool_<tool_call>a</tool_call>call>b</tool_call>"))
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", tx.strip_tool_calls(tagged).alias("cleaned"), tx.strip_tool_calls(nested).alias("nested")
    )


@catalog.add("strip_boilerplate", "SELECT conv_id, turn, replace(replace(text, 'le ', ''), 'the ', '') AS cleaned FROM conversations")
def _(spark, sf_dir):
    cleaned = tx.strip_boilerplate(F.col("text"), ["le ", "the "])
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", cleaned.alias("cleaned"))


@catalog.add(
    "strip_c_comments",
    """SELECT p_partkey, 'int x = ' || p_size || ';' || chr(10) || 'int y = 2; ' || chr(10) || 'int z;' AS code FROM part""",
)
def _(spark, sf_dir):
    code = F.concat(
        F.lit("int x = "), "p_size", F.lit(";/* "), "p_name", F.lit("\n * x = 9; */\nint y = 2; // "), "p_type", F.lit("\nint z;//")
    )
    return table(spark, sf_dir, "part").select("p_partkey", tx.strip_c_comments(code).alias("code"))
