"""Registered queries of the numbered operators, with SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from brindle.llm import ball_trees, byte_repeats, decontaminate, jaccard, language, lexical, lines, metric_join, prefix_trie, sampled_pieces, substring, token_counts, token_files
from brindle.plans.base import Catalog, table

catalog = Catalog()


@catalog.add("op1_token_counts")
def _(spark, sf_dir):
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@catalog.add(
    "op2_decontamination",
    rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
     b AS (SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
     win AS (SELECT item_id, least(len(w), 13) AS k, unnest([array_to_string(w[i:i + least(len(w), 13) - 1], ' ') FOR i IN range(1, greatest(len(w) - 13, 0) + 2)]) AS g
             FROM b WHERE len(w) > 0),
     sizes AS (SELECT DISTINCT k FROM win),
     grams AS (SELECT doc_id, k, unnest(range(1, len(w) - k + 2)) AS i, unnest([array_to_string(w[j:j + k - 1], ' ') FOR j IN range(1, len(w) - k + 2)]) AS g
               FROM d, sizes WHERE len(w) >= k),
     hit AS (SELECT grams.doc_id, grams.i, grams.k, win.item_id FROM grams JOIN win ON grams.k = win.k AND grams.g = win.g),
     words AS (SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, unnest(range(i, i + k)) AS p FROM hit) GROUP BY 1),
     items AS (SELECT doc_id, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM hit) GROUP BY 1)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(words.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(words.n, 0) > 0 AND 20 * coalesce(words.n, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
""",
)
def _(spark, sf_dir):
    found = decontaminate.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        "contaminated",
    )


@catalog.add("op3_sampled_pieces")
def _(spark, sf_dir):
    path = public_tokenizers.path("piece_bpe_32k.model")
    both = sampled_pieces.encode_sampled(table(spark, sf_dir, "documents"), path, decode=True)
    return both.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_pieces"),
        F.crc32(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary")).alias("ids_crc32"),
        F.octet_length("text").cast("long").alias("n_bytes"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


@catalog.add("op4_token_files")
def _(spark, sf_dir):
    read = token_files.token_files(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@catalog.add("op6_language")
def _(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2
    model = language.fit_languages(docs.where(~held_out))
    found = language.identify_languages(docs, model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "accepted")


@catalog.add("op7_substring_dedup")
def _(spark, sf_dir):
    found = substring.dedup_substrings(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@catalog.add("op10_byte_repeats")
def _(spark, sf_dir):
    found = byte_repeats.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@catalog.add("op9_jaccard_join")
def _(spark, sf_dir):
    found = jaccard.jaccard_components(table(spark, sf_dir, "documents"), words=3, percent=90)
    return found.select("doc_id", "n_shingles", "component_id", "n_links")


_TOP20 = """
WITH v AS (SELECT vec_id, [floor(64 * x::DOUBLE)::BIGINT FOR x IN embedding] AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
     s AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum([q.e[i] * c.e[i] FOR i IN range(1, len(q.e) + 1)])::BIGINT AS score
           FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
     r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""


@catalog.add("op5_exact_topk", _TOP20)
def _(spark, sf_dir):
    x = table(spark, sf_dir, "embeddings")
    finite = F.coalesce(~F.exists("embedding", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))), F.lit(False))
    whole = F.transform("embedding", lambda v: F.floor(F.lit(64.0) * v.cast("double")))
    rows = x.where(finite).select("vec_id", whole.alias("vector"))
    return ball_trees.exact_topk(rows, F.pmod("vec_id", F.lit(20)) == 0)


_LINES = r"""
WITH docs AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
     l AS (SELECT doc_id, unnest(range(1, len(ls) + 1)) AS pos, unnest(ls) AS line FROM docs),
     t AS (SELECT doc_id, pos, line, list_sort(list_distinct([x FOR x IN regexp_split_to_array(lower(line), '[ \t\r\f\x0B]+') IF x <> ''])) AS s FROM l),
     sets AS (SELECT s, len(s) AS n, min((doc_id, pos)) AS first, row_number() OVER () AS k FROM t WHERE len(s) > 0 GROUP BY s),
     tok AS (SELECT k, n, unnest(s) AS w FROM sets),
     freq AS (SELECT w, count(*) AS f FROM tok GROUP BY w),
     pre AS (SELECT k, n, w FROM (SELECT k, n, w, row_number() OVER (PARTITION BY k ORDER BY f, w) AS r FROM tok JOIN freq USING (w))
             WHERE r <= n - ceil(90 * n / 100.0) + 1),
     cand AS (SELECT DISTINCT a.k AS x, b.k AS y FROM pre a JOIN pre b ON a.w = b.w AND a.k <> b.k AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)),
     near AS (SELECT DISTINCT x FROM cand JOIN sets a ON a.k = x JOIN sets b ON b.k = y
              WHERE b.first < a.first AND 100 * len(list_intersect(a.s, b.s)) >= 90 * (a.n + b.n - len(list_intersect(a.s, b.s)))),
     judged AS (SELECT doc_id, pos, line, sets.k IS NOT NULL AND ((doc_id, pos) <> sets.first OR near.x IS NOT NULL) AS gone
                FROM t LEFT JOIN sets USING (s) LEFT JOIN near ON near.x = sets.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed, sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""


@catalog.add("op8_line_dedup", _LINES)
def _(spark, sf_dir):
    found = lines.dedup_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


_TRIE = r"""
WITH o AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos FROM conversations WHERE conv_id IS NOT NULL),
     crc AS (SELECT conv_id AS c, list_reduce(list_prepend(4294967295::UBIGINT, [ord(x)::UBIGINT FOR x IN string_split(conv_id::VARCHAR, '')]),
               lambda r, b: list_reduce(list_prepend(xor(r, b), range(8)::UBIGINT[]), lambda x, k: xor(x >> 1, CASE WHEN x % 2 = 1 THEN 3988292384::UBIGINT ELSE 0::UBIGINT END))) AS r
             FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL)),
     m AS (SELECT c, c - c % 20 AS base, xor(r, 4294967295::UBIGINT) % 4 AS h FROM crc),
     t AS (SELECT m.c, 0 AS part, pos, role, text FROM m JOIN o ON o.c = m.base AND o.pos <= m.h UNION ALL SELECT m.c, 1, pos, role, text FROM m JOIN o ON o.c = m.c AND o.pos > m.h),
     d AS (SELECT c, row_number() OVER w AS depth, list({'r': role, 't': text}) OVER w AS path, text FROM t WINDOW w AS (PARTITION BY c ORDER BY part, pos)),
     every AS (SELECT c, depth, path, text FROM d UNION ALL SELECT c, 0, [], NULL FROM m),
     node AS (SELECT path, min(depth) AS depth, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * coalesce(len(regexp_extract_all(min(text), '[^\x20\x09-\x0D]+')), 0) AS saved FROM every GROUP BY path),
     pre AS (SELECT path, unnest(range(0, depth + 1)) AS k FROM node),
     up AS (SELECT pre.path, path[:k] AS top, k FROM pre),
     kids AS (SELECT path[:depth - 1] AS path, count(*) AS n FROM node WHERE depth > 0 GROUP BY 1),
     sub AS (SELECT top AS path, sum(saved)::BIGINT AS saved_tokens, count(*) FILTER (kids.n IS NULL) AS n_leaves FROM up JOIN node USING (path) LEFT JOIN kids USING (path) GROUP BY top),
     last AS (SELECT c, max(depth) AS depth FROM every GROUP BY c),
     ends AS (SELECT path, string_agg(c::VARCHAR, ',' ORDER BY c) AS ids FROM every JOIN last USING (c, depth) GROUP BY path)
SELECT node.conv_id, node.depth, parent.conv_id AS parent_conv_id, node.n_convs, coalesce(kids.n, 0)::BIGINT AS n_children, n_leaves, saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM node JOIN sub USING (path) LEFT JOIN kids USING (path) LEFT JOIN ends USING (path) LEFT JOIN node AS parent ON node.depth > 0 AND parent.path = node.path[:node.depth - 1]
"""


@catalog.add("op11_prefix_trie", _TRIE)
def _(spark, sf_dir):
    trie = prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"), rebuild=prefix_trie.branched())
    return trie.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


_RANKED = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
     b AS (SELECT item_id, unnest(list_distinct(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))) AS t FROM benchmark),
     c AS (SELECT count(*) AS n, sum(len(w))::BIGINT AS l FROM d WHERE len(w) > 0),
     tf AS (SELECT doc_id, t, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS t FROM d) GROUP BY 1, 2),
     wt AS (SELECT t, floor(1000 * ln((2 * c.n + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM tf, c GROUP BY t, c.n),
     m AS (SELECT doc_id, 100 - 90 + ((90 * len(w) * c.n) // c.l) AS m FROM d, c WHERE len(w) > 0),
     s AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score FROM b JOIN tf USING (t) JOIN wt USING (t) JOIN m USING (doc_id) GROUP BY 1, 2),
     r AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10
"""


@catalog.add("op12_lexical_search", _RANKED)
def _(spark, sf_dir):
    return lexical.lexical_topk(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_NEAR = """
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
     ok AS (SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len([x FOR x IN e IF x IS NULL OR NOT isfinite(x)]) = 0 AND len([x FOR x IN e IF x <> 0]) > 0),
     link AS (SELECT a.vec_id AS x, b.vec_id AS y FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.93),
     reach AS (SELECT vec_id AS x, vec_id AS y FROM v UNION SELECT reach.x, link.y FROM reach JOIN link ON reach.y = link.x),
     least AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x),
     degree AS (SELECT x, count(*) AS n FROM link GROUP BY x)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM v JOIN least ON least.x = vec_id LEFT JOIN degree ON degree.x = vec_id
"""


@catalog.add("op13_near_vectors", _NEAR)
def _(spark, sf_dir):
    return metric_join.metric_links(table(spark, sf_dir, "embeddings"))
