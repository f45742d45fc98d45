"""Round trips through every source and sink."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from brindle.plans.base import Catalog, table
from brindle.session import settle, shared_path
from brindle.sources import tables as src

catalog = Catalog()


@catalog.add("csv_round_trip", "SELECT doc_id, text, lang FROM documents")
def _(spark, sf_dir):
    path = shared_path(spark, "csv")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    src.write_csv_table(docs, path)
    return src.read_csv_table(spark, path, "doc_id long, text string, lang string")


@catalog.add("table_round_trip", "SELECT o_orderkey, o_totalprice, CAST(NULL AS VARCHAR) AS o_orderstatus, o_custkey FROM orders")
def _(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    name = f"brindle_orders_{uuid.uuid4().hex}"  # runs on one metastore do not meet
    src.write_table(orders.select("o_orderkey", "o_totalprice", "o_orderstatus"), name, path=shared_path(spark, "orders"))
    # The second write adds a column and lacks one; the merged schema has both.
    merged = orders.select("o_orderkey", "o_totalprice", "o_custkey")
    src.write_table(merged, name, merge_schema=True, path=shared_path(spark, "orders"))
    return src.read_table(spark, name)


@catalog.add("explode_document_map", "SELECT lang AS category, text FROM documents UNION ALL SELECT lang, source FROM documents")
def _(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.create_map("lang", F.array("text", "source")).alias("m"))
    return src.explode_document_map(docs, "m")


@catalog.add("read_code_corpus", "SELECT 'int f' || p_partkey || '(int n) { return n; }' AS line FROM part")
def _(spark, sf_dir):
    path = shared_path(spark, "code")
    line = F.concat(F.lit("int f"), "p_partkey", F.lit("(int n) { return n; }"))
    table(spark, sf_dir, "part").select(line.alias("value")).write.text(path)
    files = src.read_code_corpus(spark, path, glob="*.txt")
    return files.select(F.explode(F.split("content", "\n")).alias("line")).filter("line <> ''")


@catalog.add("rows_as_json", "SELECT to_json({o_orderkey: o_orderkey, o_custkey: o_custkey, o_orderpriority: o_orderpriority})::VARCHAR AS json FROM orders")
def _(spark, sf_dir):
    return src.rows_as_json(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority"))


@catalog.add(
    "incremental_sync",
    """WITH old AS (SELECT DISTINCT md5(text) AS chunk_id FROM documents WHERE lang <> 'de'),
            cur AS (SELECT DISTINCT md5(CASE WHEN lang = 'fr' THEN text || '!' ELSE text END) AS chunk_id FROM documents WHERE lang <> 'es')
       SELECT chunk_id, CASE WHEN chunk_id IN (SELECT chunk_id FROM old) THEN 'kept' ELSE 'embedded' END AS origin FROM cur""",
)
def _(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    before = docs.filter("lang <> 'de'").select(F.md5("text").alias("chunk_id")).distinct()
    index = settle(before.withColumn("origin", F.lit("kept")), "index")
    text = F.when(F.col("lang") == "fr", F.concat("text", F.lit("!"))).otherwise(F.col("text"))
    chunks = docs.filter("lang <> 'es'").select(F.md5(text).alias("chunk_id"))
    return src.incremental_sync(chunks, index, embed=lambda new: new.withColumn("origin", F.lit("embedded")))


@catalog.add(
    "replace_by_file",
    """SELECT 'doc/' || doc_id AS file_path, CASE WHEN doc_id % 20 = 3 THEN md5(text || '!') ELSE md5(text) END AS chunk_id, doc_id % 20 = 3 AS changed
       FROM documents WHERE doc_id % 20 <> 7""",
)
def _(spark, sf_dir):
    """Some files of many change, others vanish; the rest of the index stays as it is."""
    docs = table(spark, sf_dir, "documents").withColumn("file_path", F.concat(F.lit("doc/"), "doc_id"))
    rows = docs.select("file_path", F.md5("text").alias("chunk_id"), F.lit(False).alias("changed"))
    index = src.FileIndex(spark, shared_path(spark, "file-index"), rows.schema)
    index.create(rows)
    changed = docs.where("doc_id % 20 = 3").select("file_path", F.md5(F.concat("text", F.lit("!"))).alias("chunk_id"), F.lit(True).alias("changed"))
    index.replace(changed, docs.where("doc_id % 20 = 7").select("file_path"))
    return index.read()
