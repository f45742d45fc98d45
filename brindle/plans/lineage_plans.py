"""Code lineage of files written from part rows, and graphs of orders, customers and nations."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from brindle.operators import chunking, graph as gr, lineage as ln, retrieval
from brindle.operators.ranking import top_ranked
from brindle.plans.base import Catalog, table
from brindle.session import settle

catalog = Catalog()

# One C file per part with two functions; {n} is its size, {k} its key, {c} a comment.
_SOURCE = (
    "/* {c} { */\nint area{k}(int w, char *label) {\n  int h = w; // x = 9;\n  int *p;\n  unsigned int d = h * {n};\n"
    "  for (int i = 0; i < d; i++) { h = h + i; }\n  if (h == w) { return d; }\n  else if (d) { d += 2; }\n  return h;\n}\n\n"
    "static double total{k}(double rate) {\n  double h = rate, rest;\n  h = rest = rate * area{k}(d, h) + 7;\n  return h;\n}\n"
)
_BODY1 = (
    "\n  int h = w; \n  int *p;\n  unsigned int d = h * {n};\n"
    "  for (int i = 0; i < d; i++) { h = h + i; }\n  if (h == w) { return d; }\n  else if (d) { d += 2; }\n  return h;\n"
)
_BODY2 = "\n  double h = rate, rest;\n  h = rest = rate * area{k}(d, h) + 7;\n  return h;\n"


def _sql(text: str) -> str:
    """The text as an SQL expression over part."""
    quoted = "'" + text.replace("\n", "' || chr(10) || '") + "'"
    for name, column in (("n", "p_size"), ("k", "p_partkey"), ("c", "p_name")):
        quoted = quoted.replace("{" + name + "}", f"' || {column} || '")
    return quoted


def _files(spark, sf_dir):
    parts, pieces = table(spark, sf_dir, "part", spread=True), []
    text = _SOURCE
    for name, column in (("n", "p_size"), ("k", "p_partkey"), ("c", "p_name")):
        text = text.replace("{" + name + "}", "\0" + column + "\0")
    for i, piece in enumerate(text.split("\0")):
        pieces.append(F.col(piece).cast("string") if i % 2 else F.lit(piece))
    path = F.concat(F.lit("part/"), "p_partkey", F.lit(".c"))
    return parts.select(path.alias("path"), F.concat(*pieces).alias("content"))


_FILE = "'part/' || p_partkey || '.c'"


@catalog.add(
    "extract_functions",
    f"""SELECT {_FILE} AS file, 'area' || p_partkey AS function, 'int w, char *label' AS params, {_sql(_BODY1)} AS body FROM part
        UNION ALL SELECT {_FILE}, 'total' || p_partkey, 'double rate', {_sql(_BODY2)} FROM part""",
)
def _(spark, sf_dir):
    return ln.extract_functions(_files(spark, sf_dir)).drop("pos")


def _values(rows: list[tuple], names: str) -> str:
    cells = ", ".join("(" + ", ".join("NULL" if c is None else str(c).lower() if isinstance(c, bool) else f"'{c}'" for c in row) + ")" for row in rows)
    return f"(VALUES {cells}) v({names})"


_VARIABLES = _values(
    [
        ("area", "w", "int", False), ("area", "label", "char", True), ("area", "h", "int", False), ("area", "p", "int", True),
        ("area", "d", "int", False), ("area", "i", "int", False),
        ("total", "rate", "double", False), ("total", "h", "double", False), ("total", "rest", "double", False),
    ],
    "f, name, type, is_pointer",
)


def _scoped(spark, sf_dir):
    functions = settle(ln.extract_functions(_files(spark, sf_dir)), "functions")
    variables = settle(ln.extract_variables(functions), "variables")
    return functions, variables


def _merged(spark, sf_dir):
    functions, variables = _scoped(spark, sf_dir)
    edges = settle(ln.dependency_edges(functions, variables), "dependencies")
    nodes, links = ln.merge_scopes(ln.lineage_nodes(variables, edges), edges)
    return settle(nodes, "nodes"), settle(links, "links")


@catalog.add("extract_variables", f"SELECT {_FILE} AS file, f || p_partkey AS function, name, type, is_pointer FROM part, {_VARIABLES}")
def _(spark, sf_dir):
    return _scoped(spark, sf_dir)[1].drop("pos")


# `{n}` stands for the part's size.
_EDGES = _values(
    [
        ("area", "w", "h"), ("area", "i", "h"), ("area", "h", "d"), ("area", "Constant: {n}", "d"), ("area", "Constant: 0", "i"),
        ("total", "rate", "h"), ("total", "Constant: 7", "h"), ("total", "rest", "h"), ("total", "rate", "rest"), ("total", "h", "rest"),
        ("total", "Constant: 7", "rest"),
    ],
    "f, src, dst",
)


@catalog.add(
    "dependency_edges",
    f"SELECT {_FILE} AS file, f || p_partkey AS function, replace(src, '{{n}}', p_size::VARCHAR) AS src, dst FROM part, {_EDGES}",
)
def _(spark, sf_dir):
    return ln.dependency_edges(*_scoped(spark, sf_dir))


_MERGED_EDGES = f"SELECT DISTINCT {_FILE} AS file, replace(src, '{{n}}', p_size::VARCHAR) AS src, dst FROM part, {_EDGES}"
_NODES = f"""
SELECT {_FILE} AS file, name, type, is_pointer, f || p_partkey AS function, 'variable' AS kind
FROM part, {_VARIABLES} WHERE NOT (f = 'area' AND name = 'h')
UNION ALL
SELECT DISTINCT file, src, 'constant', NULL::BOOLEAN, NULL::VARCHAR, 'constant' FROM ({_MERGED_EDGES}) WHERE src LIKE 'Constant: %'
"""


@catalog.add("lineage_nodes", _NODES)
def _(spark, sf_dir):
    return _merged(spark, sf_dir)[0]


@catalog.add("variable_catalog", f"SELECT file, name, type, function FROM ({_NODES}) WHERE kind = 'variable'")
def _(spark, sf_dir):
    return ln.variable_catalog(_merged(spark, sf_dir)[0])




def _power(view: str, members: str, among: str, name: str = "central") -> str:
    """CTEs for the node centrality of the graphs told apart by the columns ``view``: power iteration,
    and degrees where it does not converge."""
    by = f"PARTITION BY {view}"
    return f"""
{name}_links AS (SELECT {view}, src, dst, false AS self FROM {among} UNION ALL SELECT {view}, node, node, true FROM {members}),
{name}_rounds AS (
    SELECT 0 AS k, {view}, node, 1.0::DOUBLE / count(*) OVER ({by}) AS x, false AS done FROM {members}
    UNION ALL
    SELECT k, {view}, node, y / len, sum(abs(y / len - old)) OVER ({by}) < n * 1e-6 FROM (
        SELECT *, sqrt(sum(y * y) OVER ({by})) AS len, count(*) OVER ({by}) AS n FROM (
            SELECT k + 1 AS k, {view}, l.dst AS node, sum(x) AS y, max(CASE WHEN self THEN x END) AS old
            FROM {name}_rounds r JOIN {name}_links l USING ({view}) WHERE l.src = r.node AND NOT done AND k < 100 GROUP BY ALL))),
{name}_last AS (SELECT *, count(*) OVER ({by}) AS n FROM (SELECT * FROM {name}_rounds QUALIFY row_number() OVER (PARTITION BY {view}, node ORDER BY k DESC) = 1)),
{name}_degrees AS (SELECT {view}, node, count(*) AS degree FROM (SELECT {view}, src AS node FROM {among} UNION ALL SELECT {view}, dst FROM {among}) GROUP BY ALL),
{name} AS (SELECT {view}, node, done AS converged, printf('%.9e', x)::DOUBLE AS power,
               CASE WHEN done THEN printf('%.9e', x)::DOUBLE WHEN n = 1 THEN 1.0 ELSE coalesce(degree, 0)::DOUBLE / (n - 1) END AS centrality
           FROM {name}_last LEFT JOIN {name}_degrees USING ({view}, node))"""


def _neighbour_power(graph: str, edges: str) -> str:
    """CTEs for the centrality of each node's neighbours among themselves: ``near_central``."""
    same = f"a.{graph} = b.{graph} AND a.{graph} = c.{graph}"
    return f"""
near_edges AS (SELECT DISTINCT a.{graph}, a.dst AS center, 'upstream' AS direction, a.src, b.src AS dst FROM {edges} a, {edges} b, {edges} c
               WHERE {same} AND a.dst = b.dst AND c.src = a.src AND c.dst = b.src
               UNION ALL SELECT DISTINCT a.{graph}, a.src, 'downstream', a.dst, b.dst FROM {edges} a, {edges} b, {edges} c
               WHERE {same} AND a.src = b.src AND c.src = a.dst AND c.dst = b.dst),
near_nodes AS (SELECT {graph}, dst AS center, 'upstream' AS direction, src AS node FROM {edges}
               UNION ALL SELECT {graph}, src, 'downstream', dst FROM {edges}),
{_power(f"{graph}, center, direction", "near_nodes", "near_edges", "near_central")}"""


_NEIGHBOURS = f"""
WITH RECURSIVE edges AS ({_MERGED_EDGES}), nodes AS ({_NODES}),
ends AS (SELECT file, dst AS name, 'upstream' AS direction, src AS neighbour FROM edges
         UNION ALL SELECT file, src, 'downstream', dst FROM edges),
degrees AS (SELECT file, node, count(*) AS degree FROM (SELECT file, src AS node FROM edges UNION ALL SELECT file, dst FROM edges) GROUP BY ALL),
counts AS (SELECT file, count(*) AS n FROM nodes GROUP BY file),
central AS (SELECT n.file, n.name AS node, coalesce(degree, 0)::DOUBLE / (c.n - 1) AS centrality
            FROM nodes n JOIN counts c ON c.file = n.file LEFT JOIN degrees d ON d.file = n.file AND d.node = n.name),
near AS (SELECT e.file, e.name, direction, neighbour, type, function, is_pointer
         FROM ends e JOIN nodes n ON n.file = e.file AND n.name = e.neighbour)
"""
_TOP = f"""{_NEIGHBOURS}, {_neighbour_power("file", "edges")},
top AS (SELECT near.*, row_number() OVER (PARTITION BY near.file, near.name, near.direction ORDER BY centrality DESC, neighbour)::INTEGER AS rank
        FROM near JOIN near_central c ON c.file = near.file AND c.center = near.name AND c.direction = near.direction AND c.node = near.neighbour)
"""


@catalog.add("neighbours", f"{_NEIGHBOURS} SELECT * FROM near")
def _(spark, sf_dir):
    return ln.neighbours(*_merged(spark, sf_dir))


def _central(nodes, links):
    return gr.degree_centrality(links, ["file"], nodes.select("file", F.col("name").alias("node")))


@catalog.add("degree_centrality", f"{_NEIGHBOURS} SELECT file, node, round(centrality, 6) AS centrality FROM central")
def _(spark, sf_dir):
    return _central(*_merged(spark, sf_dir)).withColumn("centrality", F.round("centrality", 6))


@catalog.add("top_neighbours", f"{_TOP} SELECT file, name, direction, neighbour, rank FROM top WHERE rank <= 10")
def _(spark, sf_dir):
    top = ln.top_neighbours(*_merged(spark, sf_dir))
    return top.select("file", "name", "direction", "neighbour", "rank")


def _lines(direction: str) -> str:
    return (
        "(SELECT coalesce(string_agg('  - ' || neighbour || ' (' || type || ') in ' || coalesce(function, 'global'), chr(10) ORDER BY rank), "
        f"'  - none') FROM top t WHERE t.file = v.file AND t.name = v.name AND direction = '{direction}' AND rank <= 10)"
    )


_CONTEXTS = f"""{_TOP},
contexts AS (
        SELECT file, name, 'Context about the code being discussed:' || chr(10) || '- File: ' || file || chr(10) || '- Variable: ' || name
               || chr(10) || '- Type: ' || type || chr(10) || '- Scope: ' || function || chr(10) || '- Is Pointer: '
               || CASE WHEN is_pointer THEN 'True' ELSE 'False' END || chr(10) || chr(10) || 'Upstream Dependencies:' || chr(10)
               || {_lines('upstream')} || chr(10) || chr(10) || 'Downstream Dependencies:' || chr(10) || {_lines('downstream')}
               || chr(10) || chr(10) || '---' || chr(10) || 'User Question:' || chr(10) || 'Where is ' || name || ' set?' AS context
        FROM nodes v WHERE kind = 'variable')
"""


@catalog.add("symbol_context", f"{_CONTEXTS} SELECT file, name, context FROM contexts")
def _(spark, sf_dir):
    return _asked(spark, sf_dir)


def _asked(spark, sf_dir):
    nodes, links = _merged(spark, sf_dir)
    return ln.symbol_context(nodes, links, question=F.concat(F.lit("Where is "), "name", F.lit(" set?")))


@catalog.add(
    "symbol_context_with_code",
    f"""{_CONTEXTS},
    chunks AS (SELECT {_FILE} AS file_path, {_sql(_SOURCE)} AS content FROM part),
    texts AS (SELECT 'q' AS side, file || '::' || name AS id, context AS text FROM contexts
              UNION ALL SELECT 'c', md5(file_path || ':0:' || content), content FROM chunks),
    tokens AS (SELECT side, id, unnest(regexp_extract_all(lower(text), '[^ \\t\\n\\r]+')) AS t FROM texts),
    counted AS (SELECT side, id, ('0x' || substr(md5(t), 1, 8))::BIGINT % 64 AS bucket, count(*) AS n FROM tokens GROUP BY ALL),
    scaled AS (SELECT *, (n / sqrt(sum(n * n) OVER (PARTITION BY side, id)))::FLOAT::DOUBLE AS w FROM counted),
    filled AS (SELECT t.side, t.id, b.bucket, coalesce(w, 0) AS w FROM texts t CROSS JOIN (SELECT unnest(range(64)) AS bucket) b
               LEFT JOIN scaled s ON s.side = t.side AND s.id = t.id AND s.bucket = b.bucket),
    vectors AS (SELECT side, id, list(w ORDER BY bucket) AS v FROM filled GROUP BY side, id),
    hits AS (SELECT q.id AS query_id, c.id AS corpus_id, round(list_cosine_similarity(q.v, c.v), 12) AS score
             FROM vectors q, vectors c WHERE q.side = 'q' AND c.side = 'c'),
    best AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, corpus_id) AS rank FROM hits QUALIFY rank <= 5),
    segments AS (SELECT query_id, 'Relevant code segments:' || chr(10) || chr(10) || string_agg('From ' || file_path || ':' || chr(10) || '```c'
                        || chr(10) || content || chr(10) || '```' || chr(10) || chr(10), '' ORDER BY rank) AS segments
                 FROM best b JOIN chunks c ON md5(c.file_path || ':0:' || c.content) = b.corpus_id GROUP BY query_id)
    SELECT file, name, md5(context || segments) AS context_md5 FROM contexts JOIN segments ON query_id = file || '::' || name""",
)
def _(spark, sf_dir):
    return _with_code(_asked(spark, sf_dir), _files(spark, sf_dir))


def _with_code(contexts, files):
    """Contexts of equal vectors have equal hits: each vector is asked once, and its segments made once."""
    contexts = settle(retrieval.embed(contexts, "context").withColumn("asked", retrieval.vector_key("embedding")), "contexts")
    queries = contexts.select("asked", "embedding").distinct()
    chunks = settle(retrieval.embed(chunking.chunk_code(files), "content"), "code-index")
    hits = retrieval.retrieve_topk(queries, chunks, 5, "asked", "id", metadata=["file_path", "content"])
    return ln.with_code_segments(contexts.drop("embedding"), hits, "asked").select("file", "name", F.md5("context").alias("context_md5"))


# orders -> customer -> nation -> region.
_GRAPH = """
SELECT 'o' || o_orderkey AS src, 'c' || o_custkey AS dst FROM orders
UNION ALL SELECT 'c' || c_custkey, 'n' || c_nationkey FROM customer
UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey FROM nation
"""


def _chain(spark, sf_dir):
    def link(name, a, src, b, dst):
        return table(spark, sf_dir, name).select(F.concat(F.lit(a), src).alias("src"), F.concat(F.lit(b), dst).alias("dst"))

    edges = link("orders", "o", "o_orderkey", "c", "o_custkey").unionByName(link("customer", "c", "c_custkey", "n", "c_nationkey"))
    return edges.unionByName(link("nation", "n", "n_nationkey", "r", "n_regionkey"))


def _seeds(spark, sf_dir):
    """Every customer, nation and region, and one node that does not exist."""
    edges = _chain(spark, sf_dir)
    return edges.select(F.explode(F.array(F.col("dst"), F.lit("nowhere"))).alias("seed")).distinct()


_REACHED = f"""
WITH RECURSIVE edges AS (SELECT DISTINCT * FROM ({_GRAPH})),
reached AS (SELECT DISTINCT dst AS seed, dst AS node FROM edges
            UNION SELECT r.seed, e.src FROM reached r JOIN edges e ON e.dst = r.node)
"""


@catalog.add("ancestors", f"{_REACHED} SELECT seed, node FROM reached")
def _(spark, sf_dir):
    return gr.ancestors(_chain(spark, sf_dir), _seeds(spark, sf_dir))


@catalog.add(
    "ancestor_subgraph",
    f"{_REACHED} SELECT seed, src, dst FROM reached r JOIN edges e ON e.dst = r.node",
)
def _(spark, sf_dir):
    edges = settle(_chain(spark, sf_dir), "chain")
    return gr.ancestor_subgraph(edges, gr.ancestors(edges, _seeds(spark, sf_dir)))


_VIEW = f"""
{_REACHED},
among AS (SELECT DISTINCT seed, src, dst FROM reached r JOIN edges e ON e.dst = r.node),
{_power("seed", "reached", "among")},
ranked AS (SELECT seed, node, count(*) OVER (PARTITION BY seed) > 25 AS truncated, row_number() OVER (PARTITION BY seed ORDER BY centrality DESC, node) AS rn FROM central),
shown AS (SELECT * FROM ranked WHERE rn <= 25)
"""


@catalog.add(
    "focused_view_nodes",
    f"{_VIEW} SELECT seed, node, CASE WHEN seed = node THEN 'target' ELSE 'variable' END AS style, truncated FROM shown",
)
def _(spark, sf_dir):
    return gr.focused_view(_chain(spark, sf_dir), _seeds(spark, sf_dir))[0]


@catalog.add(
    "focused_view_edges",
    f"""{_VIEW} SELECT a.seed, src, dst FROM among a JOIN shown s ON s.seed = a.seed AND s.node = a.src
                JOIN shown t ON t.seed = a.seed AND t.node = a.dst""",
)
def _(spark, sf_dir):
    return gr.focused_view(_chain(spark, sf_dir), _seeds(spark, sf_dir))[1]


# Which nations buy more than usual from a nation, by year: 25 nodes a graph, with cycles, loops and triangles.
_TRADE = """
WITH RECURSIVE sold AS (SELECT year(o_orderdate)::INTEGER AS year, s.n_name AS src, c.n_name AS dst, sum(l_quantity) AS q
              FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
              JOIN nation s ON s_nationkey = s.n_nationkey JOIN nation c ON c_nationkey = c.n_nationkey GROUP BY ALL),
edges AS (SELECT year, src, dst FROM sold QUALIFY q > avg(q) OVER (PARTITION BY year, src)),
members AS (SELECT year, src AS node FROM edges UNION SELECT year, dst FROM edges)
"""


def _trade(spark, sf_dir):
    t = lambda name: table(spark, sf_dir, name)
    nation = lambda key, name: t("nation").select(F.col("n_nationkey").alias(key), F.col("n_name").alias(name))
    sellers = t("supplier").join(nation("s_nationkey", "src"), "s_nationkey").select(F.col("s_suppkey").alias("l_suppkey"), "src")
    buyers = t("customer").join(nation("c_nationkey", "dst"), "c_nationkey").select(F.col("c_custkey").alias("o_custkey"), "dst")
    orders = t("orders").join(buyers, "o_custkey").select(F.col("o_orderkey").alias("l_orderkey"), F.year("o_orderdate").alias("year"), "dst")
    sold = t("lineitem").join(orders, "l_orderkey").join(sellers, "l_suppkey").groupBy("year", "src", "dst").agg(F.sum("l_quantity").alias("q"))
    usual = F.avg("q").over(Window.partitionBy("year", "src"))
    return settle(sold.withColumn("usual", usual).where("q > usual").select("year", "src", "dst"), "trade")


@catalog.add("trade_eigenvector_centrality", f"{_TRADE}, {_power('year', 'members', 'edges')} SELECT year, node, round(power, 6) AS centrality, converged FROM central")
def _(spark, sf_dir):
    return gr.eigenvector_centrality(_trade(spark, sf_dir), ["year"]).withColumn("centrality", F.round("centrality", 6))


@catalog.add("trade_node_centrality", f"{_TRADE}, {_power('year', 'members', 'edges')} SELECT year, node, round(centrality, 6) AS centrality FROM central")
def _(spark, sf_dir):
    return gr.node_centrality(_trade(spark, sf_dir), ["year"]).withColumn("centrality", F.round("centrality", 6))


@catalog.add(
    "trade_neighbours",
    f"""{_TRADE}, {_neighbour_power("year", "edges")}
        SELECT year, center AS node, direction, node AS neighbour, round(centrality, 6) AS centrality,
               row_number() OVER (PARTITION BY year, center, direction ORDER BY near_central.centrality DESC, near_central.node)::INTEGER AS rank
        FROM near_central QUALIFY rank <= 10""",
)
def _(spark, sf_dir):
    """The ten most central of each nation's sellers and buyers, among these."""
    central = gr.neighbour_centrality(_trade(spark, sf_dir), ["year"])
    top = top_ranked(central, ["year", "node", "direction"], [F.desc("centrality"), F.col("neighbour")], 10)
    return top.withColumn("centrality", F.round("centrality", 6)).select("year", "node", "direction", "neighbour", "centrality", "rank")


@catalog.add(
    "top_central",
    f"""WITH edges AS (SELECT DISTINCT * FROM ({_GRAPH})), ends AS (SELECT src AS node FROM edges UNION ALL SELECT dst FROM edges),
             degrees AS (SELECT node, count(*) AS degree FROM ends GROUP BY node)
        SELECT node, round(degree::DOUBLE / ((SELECT count(*) FROM degrees) - 1), 6) AS centrality FROM degrees
        ORDER BY degree DESC, node LIMIT 25""",
)
def _(spark, sf_dir):
    central = gr.degree_centrality(_chain(spark, sf_dir))
    return gr.top_central(central).withColumn("centrality", F.round("centrality", 6))


def _power_sql(rounds: int) -> str:
    steps = [f"WITH edges AS (SELECT DISTINCT * FROM ({_GRAPH})), members AS (SELECT src AS node FROM edges UNION SELECT dst FROM edges)"]
    steps.append("x0 AS (SELECT node, 1.0::DOUBLE / (SELECT count(*) FROM members) AS x FROM members)")
    for i in range(rounds):
        steps.append(
            f"y{i} AS (SELECT node, sum(x) AS x FROM (SELECT node, x FROM x{i} UNION ALL SELECT dst, x FROM x{i} JOIN edges ON src = node) GROUP BY node)"
        )
        steps.append(f"x{i + 1} AS (SELECT node, x / (SELECT sqrt(sum(x * x)) FROM y{i}) AS x FROM y{i})")
    return ", ".join(steps) + f" SELECT node, round(x, 6) AS centrality, false AS converged FROM x{rounds}"


@catalog.add("eigenvector_centrality", _power_sql(4))
def _(spark, sf_dir):
    power = gr.eigenvector_centrality(_chain(spark, sf_dir), max_iter=4)
    return power.withColumn("centrality", F.round("centrality", 6))


@catalog.add(
    "node_centrality",
    f"""WITH edges AS (SELECT DISTINCT * FROM ({_GRAPH})), ends AS (SELECT src AS node FROM edges UNION ALL SELECT dst FROM edges),
             degrees AS (SELECT node, count(*) AS degree FROM ends GROUP BY node)
        SELECT node, round(degree::DOUBLE / ((SELECT count(*) FROM degrees) - 1), 6) AS centrality FROM degrees""",
)
def _(spark, sf_dir):
    """Power iteration that has not converged after two rounds, hence the degree fallback."""
    central = gr.node_centrality(_chain(spark, sf_dir), max_iter=2)
    return central.withColumn("centrality", F.round("centrality", 6))
