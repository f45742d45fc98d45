"""Text expressions: ids, scrubbing, outlines, prompts and chat messages. All run in the JVM."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

# Patterns of the text formats that are read.
OUTLINE_MARKER = r"\d+[a-zA-Z]?\."
TOOL_CALL = r"(?s)<tool_call>.*?</tool_call>|<tool_call_result>.*?</tool_call_result>"
BLOCK_COMMENT = r"(?s)/\*.*?\*/"
LINE_COMMENT = r"(?m)//.*$"
NOT_LETTERS = r"[^a-zA-Z\s]"

WHITESPACE = " \t\n\r\x0b\x0c"


def strip(col: Column) -> Column:
    """Trim all ASCII whitespace, line ends included."""
    return F.btrim(col, F.lit(WHITESPACE))


def content_id(*parts: Column) -> Column:
    """Stable md5 id of one value, or of several joined by a colon."""
    return F.md5(parts[0] if len(parts) == 1 else F.concat_ws(":", *parts))


def short_id(key: Column, n: int = 7, seed: int | str = "") -> Column:
    """The first n hex digits of the key's md5. Seven digits are 28 bits: expect collisions."""
    text = key.cast("string")
    return F.substring(F.md5(F.concat(F.lit(f"{seed}"), text) if seed != "" else text), 1, n)


def scrub_label_leak(text: Column, label: Column) -> Column:
    """Remove the label from the text as written and in lower case, then colons; gives lower case."""
    exact = F.replace(text, label, F.lit(""))
    lowered = F.replace(F.lower(exact), F.lower(label), F.lit(""))
    return F.replace(lowered, F.lit(":"), F.lit(""))


def clean_label(col: Column) -> Column:
    """Letters and whitespace only."""
    return F.regexp_replace(col, NOT_LETTERS, "")


def parse_outline(col: Column, prefix: str = "", min_len: int = 0) -> Column:
    """Sections between outline markers, trimmed, longer than ``min_len``, with ``prefix`` in front."""
    sections = F.transform(F.split(col, OUTLINE_MARKER), strip)
    kept = F.filter(sections, lambda s: F.length(s) > min_len)
    return F.transform(kept, lambda s: F.concat(F.lit(prefix), s)) if prefix else kept


def body_paragraphs(col: Column, min_len: int = 10) -> Column:
    """Lines of a text without the first and the last, longer than ``min_len``."""
    lines = F.split(col, "\n")
    inner = F.slice(lines, F.lit(2), F.greatest(F.size(lines) - 2, F.lit(0)))
    return F.filter(inner, lambda p: F.length(p) > min_len)


def render_prompt(template: str, values: Mapping[str, Column]) -> Column:
    """Fill ``{name}`` placeholders from columns; NULL where a value is NULL."""
    pieces = re.split(r"\{(\w+)\}", template)
    parts = [values[p] if i % 2 else F.lit(p) for i, p in enumerate(pieces) if i % 2 or p]
    return F.concat(*parts) if parts else F.lit("")


def format_context(chunks: Column, template: str = "`{chunk_text}`") -> Column:
    """Wrap every text of an array in the template and concatenate them in order."""
    return F.array_join(F.transform(chunks, lambda c: render_prompt(template, {"chunk_text": c})), "")


def code_context(path: Column, content: Column) -> Column:
    """A code chunk as a fenced block with its origin."""
    return F.concat(F.lit("From "), path, F.lit(":\n```c\n"), content, F.lit("\n```\n\n"))


def last_content(messages: Column) -> Column:
    """Content of the newest message; NULL for an empty list."""
    return F.try_element_at(messages, F.lit(-1))["content"]


def history(messages: Column) -> Column:
    """Every message before the newest."""
    return F.slice(messages, F.lit(1), F.greatest(F.size(messages) - 1, F.lit(0)))


def strip_tool_calls(col: Column) -> Column:
    """Delete tool-call blocks until none is left, then trim.

    Every effective pass removes at least two ``>``, which bounds the number of passes; rows
    without a closing tag take none.
    """
    passes = F.when(F.contains(col, F.lit("</tool_call")), F.floor(F.regexp_count(col, F.lit(">")) / 2)).otherwise(0)
    rounds = F.when(passes > 0, F.sequence(F.lit(1), F.greatest(passes, F.lit(1)).cast("int"))).otherwise(
        F.array().cast("array<int>")
    )
    # A pass that changes nothing ends the work: the later ones only look at the flag.
    start = F.struct(col.alias("text"), F.lit(True).alias("changed"))

    def clean(state: Column, _: Column) -> Column:
        after = F.regexp_replace(state["text"], TOOL_CALL, "")
        return F.when(state["changed"], F.transform(F.array(after), lambda t: F.struct(t.alias("text"), (t != state["text"]).alias("changed")))[0]).otherwise(state)

    return strip(F.aggregate(rounds, start, clean, lambda state: state["text"]))


def strip_boilerplate(col: Column, phrases: Sequence[str]) -> Column:
    """Remove literal phrases."""
    for phrase in phrases:
        col = F.replace(col, F.lit(phrase), F.lit(""))
    return col


def strip_c_comments(col: Column) -> Column:
    """Remove block comments, then line comments (also inside string literals)."""
    return F.regexp_replace(F.regexp_replace(col, BLOCK_COMMENT, ""), LINE_COMMENT, "")


def says_yes(answer: Column) -> Column:
    """1 when the answer contains "yes" in any case, else 0."""
    return F.coalesce(F.contains(F.lower(answer), F.lit("yes")), F.lit(False)).cast("int")


def is_listed(text: Column) -> Column:
    """Does the text hold a numbered list with items 1 and 2?"""
    return F.contains(text, F.lit("1.")) & F.contains(text, F.lit("2."))
