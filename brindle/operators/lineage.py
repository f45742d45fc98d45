"""Functions, variables and assignment edges of a corpus of C files.

A pattern scan, not a parser. Tables are keyed by file and function; :func:`merge_scopes` gives
the view in which a file has one node per name.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from brindle.functions.ccode import CONTROL_WORDS, TYPE_WORDS, find_declarations, find_functions
from brindle.functions.text import code_context, render_prompt, strip_c_comments
from brindle.operators import graph as gr
from brindle.operators.ranking import top_ranked

CONSTANT_PREFIX = "Constant: "

# `type name`, possibly with pointer stars.
_NAME = r"[A-Za-z_]\w*"
_TYPED = rf"({_NAME})(\s*\*[\s*]*|\s+)({_NAME})"
PARAMETER = rf"{_TYPED}\s*(?:\[[^\]]*\]\s*)*$"
# `name = right side;` with the right side only looked at, so that `a = b = c;` gives two matches.
ASSIGNMENT = rf"\b({_NAME})\s*=(?!=)(?=\s*([^;]+);)"


def extract_functions(files: DataFrame, path: str = "path", content: str = "content") -> DataFrame:
    """``file, function, params, body, pos`` of every function of every file, comments removed."""

    @F.pandas_udf("array<struct<name: string, params: string, body: string, pos: int>>")
    def functions(texts: pd.Series) -> pd.Series:
        return texts.map(find_functions, na_action="ignore")

    found = files.select(F.col(path).alias("file"), F.explode(functions.asNondeterministic()(strip_c_comments(F.col(content)))).alias("f"))
    return found.select("file", F.col("f.name").alias("function"), "f.params", "f.body", "f.pos")


def _groups(text: Column | str, pattern: str, **names: int) -> Column:
    """All matches of a pattern as an array of structs with the given groups."""
    return F.arrays_zip(*[F.regexp_extract_all(text, F.lit(pattern), F.lit(i)).alias(n) for n, i in names.items()])


def extract_variables(functions: DataFrame) -> DataFrame:
    """``file, function, name, type, is_pointer, pos``: parameters and local declarations, all of a
    list included.

    A parameter wins over a local of the same name, a later local over an earlier one.
    """

    @F.pandas_udf("array<struct<type: string, is_pointer: boolean, name: string>>")
    def declared(bodies: pd.Series) -> pd.Series:
        return bodies.map(find_declarations, na_action="ignore")

    one = lambda p, i: F.regexp_extract(p, PARAMETER, i)
    arguments = F.transform(
        F.split("params", ","), lambda p: F.struct(one(p, 1).alias("type"), F.contains(one(p, 2), F.lit("*")).alias("is_pointer"), one(p, 3).alias("name"))
    )
    kinds = F.array(
        F.struct(F.lit(0).alias("priority"), F.col("locals").alias("found")),
        F.struct(F.lit(1).alias("priority"), arguments.alias("found")),
    )
    rows = (
        functions.withColumn("locals", declared.asNondeterministic()("body"))
        .select("file", "function", "pos", F.explode(kinds).alias("k"))
        .select("file", "function", "pos", "k.priority", F.posexplode("k.found").alias("at", "v"))
        .select("file", "function", "pos", "priority", "at", "v.*")
        .filter(F.col("name") != "")
        .filter(~F.col("type").isin(*CONTROL_WORDS) & ~F.col("name").isin(*CONTROL_WORDS, *TYPE_WORDS))
    )
    winner = F.max(F.struct("priority", "at", "type", "is_pointer", "pos"))
    return rows.groupBy("file", "function", "name").agg(winner.alias("w")).select(
        "file", "function", "name", "w.type", "w.is_pointer", "w.pos"
    )


def dependency_edges(functions: DataFrame, variables: DataFrame) -> DataFrame:
    """``file, function, src, dst``: every variable or constant on the right side of an assignment
    to a variable of the same function.

    Right sides become token rows that meet the variables in equi-joins; no text is matched
    against a list of names.
    """
    assigned = functions.select("file", "function", F.explode(_groups("body", ASSIGNMENT, dst=1, rhs=2)).alias("a"))
    tokens = assigned.select(
        "file", "function", F.col("a.dst").alias("dst"), F.explode(F.array_distinct(F.split("a.rhs", r"\W+"))).alias("src")
    ).filter((F.col("src") != "") & (F.col("src") != F.col("dst")))
    tokens = tokens.distinct()
    names = variables.select("file", "function", "name")
    known = tokens.join(names.withColumnRenamed("name", "dst"), ["file", "function", "dst"])
    is_number = F.col("src").rlike(r"^\d+$")
    from_variables = known.join(names.withColumnRenamed("name", "src"), ["file", "function", "src"])
    from_constants = known.filter(is_number).withColumn("src", F.concat(F.lit(CONSTANT_PREFIX), "src"))
    columns = ["file", "function", "src", "dst"]
    return from_variables.select(columns).unionByName(from_constants.select(columns))


def lineage_nodes(variables: DataFrame, edges: DataFrame) -> DataFrame:
    """``file, function, name, type, is_pointer, kind, pos``: the variables and the constants used."""
    constants = edges.filter(F.startswith("src", F.lit(CONSTANT_PREFIX))).select("file", "function", F.col("src").alias("name")).distinct()
    constants = constants.select(
        "file", "function", "name", F.lit("constant").alias("type"), F.lit(None).cast("boolean").alias("is_pointer"),
        F.lit("constant").alias("kind"), F.lit(None).cast("int").alias("pos"),
    )
    return variables.withColumn("kind", F.lit("variable")).select(constants.columns).unionByName(constants)


def merge_scopes(nodes: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The view with one node per file and name: attributes of the last function that declares it;
    constants have no function."""
    last = F.max(F.struct("pos", "function", "type", "is_pointer", "kind")).alias("w")
    merged = nodes.groupBy("file", "name").agg(last).select(
        "file", "name", "w.type", "w.is_pointer", F.when(F.col("w.kind") == "variable", F.col("w.function")).alias("function"), "w.kind"
    )
    return merged, edges.select("file", "src", "dst").distinct()


def variable_catalog(nodes: DataFrame) -> DataFrame:
    """All variables with type and function, sorted."""
    return nodes.filter("kind <> 'constant'").select("file", "name", "type", "function").orderBy("file", "name")


def neighbours(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``file, name, direction, neighbour`` with the neighbour's attributes, on the merged view."""
    up = edges.select("file", F.col("dst").alias("name"), F.lit("upstream").alias("direction"), F.col("src").alias("neighbour"))
    down = edges.select("file", F.col("src").alias("name"), F.lit("downstream").alias("direction"), F.col("dst").alias("neighbour"))
    attributes = nodes.select("file", F.col("name").alias("neighbour"), "type", "function", "is_pointer")
    return up.unionByName(down).join(attributes, ["file", "neighbour"]).select(
        "file", "name", "direction", "neighbour", "type", "function", "is_pointer"
    )


def top_neighbours(nodes: DataFrame, edges: DataFrame, n: int = 10, max_iter: int = 100) -> DataFrame:
    """The n most central neighbours per node and direction, with their attributes and ``rank``.

    A neighbour's centrality is the one it has in the graph that the node's predecessors (upstream)
    or successors (downstream) induce among themselves; ties go by name.
    """
    central = gr.neighbour_centrality(edges, ["file"], max_iter).withColumnRenamed("node", "name")
    # It has a row for each neighbour, which only the attributes are missing from.
    attributes = nodes.select("file", F.col("name").alias("neighbour"), "type", "function", "is_pointer")
    scored = central.join(attributes, ["file", "neighbour"])
    order = [F.desc(F.coalesce("centrality", F.lit(0.0))), F.col("neighbour")]
    return top_ranked(scored, ["file", "name", "direction"], order, n)


# The text block that describes one variable.
_HEADER = (
    "Context about the code being discussed:\n- File: {file}\n- Variable: {name}\n- Type: {type}\n- Scope: {scope}\n"
    "- Is Pointer: {is_pointer}\n\nUpstream Dependencies:\n{upstream}\n\nDownstream Dependencies:\n{downstream}"
    "\n\n---\nUser Question:\n"
)
_NONE_LINE = "  - none"
_SEGMENTS = "Relevant code segments:\n\n"


def symbol_context(nodes: DataFrame, edges: DataFrame, n: int = 10, question: Column | str | None = None) -> DataFrame:
    """``file, name, context``: one text block per variable with its most central neighbours, followed
    by the user's ``question``, a text or a column of ``nodes``."""
    top = top_neighbours(nodes, edges, n)
    line = F.concat(
        F.lit("  - "), "neighbour", F.lit(" ("), "type", F.lit(") in "), F.coalesce("function", F.lit("global"))
    )
    lines = F.transform(F.array_sort(F.collect_list(F.struct("rank", line.alias("line")))), lambda r: r["line"])  # at most n
    blocks = top.groupBy("file", "name").pivot("direction", ["upstream", "downstream"]).agg(F.array_join(lines, "\n"))
    described = nodes.filter("kind <> 'constant'").join(blocks, ["file", "name"], "left")
    text = {d: F.coalesce(F.when(F.col(d) != "", F.col(d)), F.lit(_NONE_LINE)) for d in ("upstream", "downstream")}
    context = render_prompt(
        _HEADER,
        {
            "file": F.col("file"),
            "name": F.col("name"),
            "type": F.col("type"),
            "scope": F.coalesce("function", F.lit("global")),
            "is_pointer": F.initcap(F.col("is_pointer").cast("string")),
            **text,
        },
    )
    asked = F.lit("") if question is None else F.coalesce(question if isinstance(question, Column) else F.lit(question), F.lit(""))
    return described.select("file", "name", F.concat(context, asked).alias("context"))


def with_code_segments(contexts: DataFrame, hits: DataFrame, context_id: str) -> DataFrame:
    """Append the retrieved code chunks (``query_id, rank, file_path, content``) to each context."""
    block = code_context(F.col("file_path"), F.col("content"))
    ordered = F.array_sort(F.collect_list(F.struct("rank", block.alias("block"))))  # k per query
    segments = hits.groupBy(F.col("query_id").alias(context_id)).agg(
        F.concat(F.lit(_SEGMENTS), F.array_join(F.transform(ordered, lambda s: s["block"]), "")).alias("segments")
    )
    joined = contexts.join(segments, context_id, "left")
    return joined.withColumn("context", F.concat("context", F.coalesce("segments", F.lit("")))).drop("segments")
