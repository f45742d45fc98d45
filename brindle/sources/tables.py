"""Readers and writers: CSV, catalog tables, code corpora, JSON rows, incremental index tables."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from brindle.session import settle


_CSV = {"quote": '"', "escape": '"'}


def read_csv_table(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """Header CSV with quoted fields that may span lines; a file is read by as many tasks as it has
    splits. Without a schema all columns are strings, named by the header.

    First the quotes of every split are counted: the parity of their sum before a split tells whether
    it begins inside a field. Then each split is cut at true record ends, and a record that lies in
    several splits is put together from its parts. Files are UTF-8 and quotes inside fields doubled.
    """
    if schema is None:
        schema = spark.read.options(header=True, multiLine=True, **_CSV).csv(path).schema
    elif isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")]
    lines = spark.read.option("lineSep", "\n").text(path).select(*place, F.col("value").alias("line"))
    quotes = F.length("line") - F.length(F.replace("line", F.lit('"'), F.lit("")))
    splits = lines.groupBy("file", "start").agg(F.sum(quotes).alias("quotes"))  # one row per split
    before = F.coalesce(F.sum("quotes").over(Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    splits = settle(splits.select("file", "start", (before % 2 == 1).alias("inside")), "splits")
    # The order of lines must stay, so the table of splits, one row for each, is sent to all tasks.
    placed = lines.join(F.broadcast(splits), ["file", "start"])
    parts = settle(placed.select("file", "start", "inside", "line").mapInArrow(_records, "file string, start long, part string, record string"), "records")
    whole = parts.where("part = 'whole'")
    # A record that is open at the end of a split goes on with what comes first in the splits after it.
    opened = F.last(F.when(F.col("part") == "tail", F.col("start")), ignorenulls=True)
    back = Window.partitionBy("file").orderBy("start", F.col("part") == "tail")
    first = opened.over(back.rowsBetween(Window.unboundedPreceding, 0))
    cut = parts.where("part <> 'whole'").withColumn("first", first).groupBy("file", "first").agg(F.array_sort(F.collect_list(F.struct("start", F.col("part") == "tail", "record"))).alias("parts"))
    joined = cut.select("file", F.col("first").alias("start"), F.array_join(F.transform("parts", lambda p: p["record"]), "\n").alias("record"))
    records = whole.select("record").unionByName(joined.select("record"))
    row = F.from_csv(F.regexp_replace("record", "\r$", ""), _ddl(schema), {**_CSV, "multiLine": "true"})
    return records.where("record <> ''").select(row.alias("row")).select("row.*")


def _ddl(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of each split, in its order of lines: ``whole`` ones; what belongs to a record of an
    earlier split (``lead``); and the start of one that is not complete (``tail``). The header of a file,
    its first record, does not come out."""
    now, held, part, skip = None, [], "whole", False

    def row(kind: str) -> tuple:
        return (*now, kind, "\n".join(held))

    for batch in batches:
        out: list[tuple] = []
        columns = [batch.column(c).to_pylist() for c in ("file", "start", "inside", "line")]
        for file, start, inside, line in zip(*columns, strict=True):
            if (file, start) != now:
                if held:
                    out.append(row("lead" if part == "lead" else "tail"))
                now, held, part, skip = (file, start), [], "lead" if inside else "whole", start == 0
                odd = inside
            held.append(line)
            odd ^= line.count('"') % 2 == 1
            if not odd:
                if skip:
                    skip = False
                else:
                    out.append(row(part))
                held, part = [], "whole"
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], kind) for k, kind in enumerate((pa.string(), pa.int64(), pa.string(), pa.string()))], ["file", "start", "part", "record"])
    if held:
        yield pa.RecordBatch.from_arrays([pa.array([v], kind) for v, kind in zip(row("lead" if part == "lead" else "tail"), (pa.string(), pa.int64(), pa.string(), pa.string()), strict=True)], ["file", "start", "part", "record"])


def write_csv_table(df: DataFrame, path: str) -> None:
    # White space at the ends of a field is part of it.
    df.write.options(header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, **_CSV).mode("overwrite").csv(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def write_table(
    df: DataFrame, name: str, mode: str = "overwrite", merge_schema: bool = False, path: str | None = None
) -> None:
    """Save as a table. Overwriting replaces the schema; with ``merge_schema`` columns that the
    existing table has and ``df`` lacks stay in the schema, as NULL."""
    spark = df.sparkSession
    if merge_schema and spark.catalog.tableExists(name):
        known = spark.table(name).schema
        missing = [f for f in known.fields if f.name not in df.columns]
        df = df.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in missing])
    writer = df.write.mode(mode).format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(name)


def reset_schema(spark: SparkSession, names: Sequence[str]) -> None:
    """Drop the schemas with everything in them and create them empty."""
    for name in names:
        spark.sql(f"DROP SCHEMA IF EXISTS {name} CASCADE")
    for name in names:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}")


def noop_sink(df: DataFrame) -> None:
    """Run the whole plan and discard the rows."""
    df.write.format("noop").mode("overwrite").save()


def explode_document_map(df: DataFrame, map_col: str, text_col: str = "text") -> DataFrame:
    """A map of category to documents as ``(category, text)`` rows."""
    pairs = df.select(F.explode(map_col).alias("category", "documents"))
    return pairs.select("category", F.explode("documents").alias(text_col))


def read_code_corpus(spark: SparkSession, path: str, glob: str = "*.c") -> DataFrame:
    """One row per source file: ``path`` and whole ``content``."""
    files = spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", True).text(path, wholetext=True)
    return files.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("content"))


def rows_as_json(df: DataFrame) -> DataFrame:
    """One JSON document per row."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("json"))


def incremental_sync(chunks: DataFrame, index: DataFrame, key: str = "chunk_id", embed=None) -> DataFrame:
    """The index after a sync with the current ``chunks``.

    Rows whose key vanished are dropped, known rows are kept as they are, and only new keys pass
    through ``embed``. With a content hash as key, a changed chunk is a new key. Equal chunks
    share a key and enter the index once.
    """
    current = chunks.dropDuplicates([key])
    kept = index.join(current.select(key), key, "left_semi")
    added = current.join(index.select(key), key, "left_anti")
    return kept.unionByName(embed(added) if embed else added)


class FileIndex:
    """Index rows of many files, laid into ``buckets`` folders by a hash of the file.

    Replacing files rewrites their buckets only, each in one step; the files of other buckets are not
    even read. ``schema`` are the columns of the rows, the file's among them.
    """

    BUCKET = "file_bucket"

    def __init__(self, spark: SparkSession, path: str, schema: StructType, file_col: str = "file_path", buckets: int = 256):
        self.spark, self.path, self.schema, self.file_col, self.buckets = spark, path, schema, file_col, buckets

    def _placed(self, rows: DataFrame) -> DataFrame:
        return rows.select(*self.schema.names, F.pmod(F.xxhash64(self.file_col), F.lit(self.buckets)).cast("int").alias(self.BUCKET))

    def _write(self, rows: DataFrame) -> None:
        # Dealt out by bucket, so that a folder gets few files; a bucket of many rows gets several.
        writer = rows.repartition(self.BUCKET, F.pmod(F.xxhash64(*self.schema.names), F.lit(4))).write.mode("overwrite").partitionBy(self.BUCKET)
        writer.option("partitionOverwriteMode", "dynamic").parquet(self.path)

    def create(self, rows: DataFrame) -> None:
        self._write(self._placed(rows))

    def stored(self) -> DataFrame:
        whole = StructType([*self.schema.fields, StructField(self.BUCKET, IntegerType())])
        return self.spark.read.schema(whole).parquet(self.path)

    def read(self) -> DataFrame:
        # Buckets that have become empty hold one row without a file.
        return self.stored().where(F.col(self.file_col).isNotNull()).drop(self.BUCKET)

    def replace(self, rows: DataFrame, files: DataFrame) -> None:
        """Put ``rows`` in place of all rows of ``files`` (one column, the file's name).

        Files of ``rows`` are replaced too if they are not listed. A file that is listed but has no
        rows is removed. Running it again changes nothing.
        """
        new = settle(self._placed(rows), "new-rows")
        gone = settle(files.select(F.col(files.columns[0]).alias(self.file_col)).unionByName(new.select(self.file_col)).distinct(), "files")
        bucket = F.pmod(F.xxhash64(self.file_col), F.lit(self.buckets)).cast("int")
        touched = [r[0] for r in gone.select(bucket.alias("b")).distinct().collect()]  # at most ``buckets``
        if not touched:
            return
        kept = self.stored().where(F.col(self.BUCKET).isin(touched)).join(gone, self.file_col, "left_anti")
        # Read whole before its folders are overwritten. Only folders with rows are replaced, so a
        # bucket that becomes empty gets one row without a file.
        whole = settle(kept.select(*self.schema.names, self.BUCKET).unionByName(new), "buckets")
        held = whole.select(self.BUCKET).distinct()
        empty = self.spark.createDataFrame([(b,) for b in touched], f"{self.BUCKET} int").join(held, self.BUCKET, "left_anti")
        blank = empty.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema.fields], self.BUCKET)
        self._write(whole.unionByName(blank))
