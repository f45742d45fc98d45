"""Streaming forms of the payload log, the hourly deduplication and the index sync."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

from brindle.operators.payload import unpack_and_split_payloads
from brindle.operators.ranking import latest_per_key
from brindle.session import shared_path


def read_parquet_stream(spark: SparkSession, path: str, schema: StructType, files_per_batch: int | None = None) -> DataFrame:
    """Parquet files as they arrive in a folder."""
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader).parquet(path)


def write_available(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Start a query that appends everything available to parquet files, exactly once, and stops."""
    return (
        stream.writeStream.outputMode(mode)
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_request_log(payloads: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(request log, assessment log)`` streams. The batch functions keep no state."""
    return unpack_and_split_payloads(payloads)


def stream_dedup_hourly(
    stream: DataFrame, keys: Sequence[str], time: str, delay: str = "1 hour", tie_break: str | None = None
) -> DataFrame:
    """The newest row per key and hour, emitted when the watermark closes the hour.

    State is one row per open hour and key; later rows of a closed hour are dropped. Of equal
    times the smallest ``tie_break`` wins.
    """
    timed = stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay)
    rest = [c for c in stream.columns if c not in keys]
    newest_first = F.struct((-F.unix_micros(time)).alias("age"), *([tie_break] if tie_break else []))
    best = timed.groupBy(F.window(time, "1 hour").alias("hour"), *keys).agg(F.min_by(F.struct(*rest), newest_first).alias("row"))
    return best.select("hour.start", *keys, "row.*").withColumnRenamed("start", "hour")


class BatchTables:
    """Tables that a stream writes in parts, one folder per table and batch.

    A batch overwrites only its own folders, so a replayed batch adds nothing.
    """

    def __init__(self, spark: SparkSession, root: str, schemas: dict[str, StructType]):
        self.spark, self.root, self.schemas = spark, root.rstrip("/"), schemas

    def write(self, table: str, rows: DataFrame, batch: int, by: Sequence[str] = ()) -> None:
        """Write a table's part of a batch, in folders by the columns ``by``."""
        writer = rows.select(*self.schemas[table].names).write.mode("overwrite")
        (writer.partitionBy(*by) if by else writer).parquet(f"{self.root}/{table}/batch={batch}")

    def batches(self, table: str) -> list[int]:
        """The batches that have written to a table, from the names of their folders."""
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{table}")
        files = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(path):
            return []
        names = (status.getPath().getName() for status in files.listStatus(path))
        return sorted(int(name.partition("=")[2]) for name in names if name.startswith("batch="))

    def read(self, table: str, batches: Sequence[int] | None = None) -> DataFrame:
        """The rows of a table with the ``batch`` they were written by; of some batches only, if given."""
        schema = StructType([*self.schemas[table].fields, StructField("batch", LongType())])
        chosen = self.batches(table) if batches is None else batches
        if not chosen:
            return self.spark.createDataFrame([], schema)
        top = f"{self.root}/{table}"
        return self.spark.read.schema(schema).option("basePath", top).parquet(*[f"{top}/batch={b}" for b in chosen])


def run_batches(stream: DataFrame, checkpoint: str, apply: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Start a query that hands everything available to ``apply``, batch by batch, and stops."""
    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


class PayloadLogs:
    """The request log and the assessment log of one payload stream, from one pass over it.

    A batch is read once, held while both logs are derived from it, and written under its number.
    """

    TABLES = ("request_log", "assessment_log")

    def __init__(self, spark: SparkSession, root: str, payloads: StructType, **unpack: str):
        self.unpack = unpack
        empty = unpack_and_split_payloads(spark.createDataFrame([], payloads), **unpack)
        self.tables = BatchTables(spark, root, {name: df.schema for name, df in zip(self.TABLES, empty, strict=True)})

    def apply(self, payloads: DataFrame, batch: int) -> None:
        held = payloads.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for name, rows in zip(self.TABLES, unpack_and_split_payloads(held, **self.unpack), strict=True):
                self.tables.write(name, rows, batch)
        finally:
            held.unpersist()

    def read(self, name: str) -> DataFrame:
        return self.tables.read(name).drop("batch")


class HourlyLatest:
    """The newest row per key and hour, with every row accounted for.

    An hour is closed by the batch whose watermark (the greatest time seen, less ``delay_seconds``)
    reaches its end, and comes out once. Rows of hours that were closed before their batch go to the
    late rows. What has not been closed is the state: one row per open hour and key, written anew by
    every batch. After the end of the input ``flush`` gives these too. Of equal times the smallest
    ``tie_break`` wins. A replayed batch starts from the state of the batch before it.
    """

    def __init__(self, spark: SparkSession, root: str, schema: StructType, keys: Sequence[str], time: str, tie_break: str, delay_seconds: int = 3600):
        self.spark, self.keys, self.time, self.tie_break, self.delay = spark, [*keys], time, tie_break, delay_seconds
        rows = spark.createDataFrame([], schema).withColumn("hour", self._hour())
        self.columns = schema.names
        clock = StructType([StructField("watermark", LongType())])
        self.tables = BatchTables(spark, root, {"open": rows.schema, "closed": rows.schema, "late": rows.schema, "clock": clock})

    def _hour(self) -> Column:
        return F.date_trunc("hour", F.col(self.time))

    def _end(self) -> Column:
        """The end of a row's hour in microseconds."""
        return F.unix_micros(F.col("hour").cast("timestamp")) + 3_600_000_000

    def _watermark(self, batch: int) -> int | None:
        """In microseconds, as the batches before this one have left it."""
        return self.tables.read("clock", [b for b in self.tables.batches("clock") if b < batch][-1:]).agg(F.max("watermark")).first()[0]

    def apply(self, rows: DataFrame, batch: int) -> None:
        before = self._watermark(batch)
        held = rows.select(*self.columns).withColumn("hour", self._hour()).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            late = self._end() <= F.lit(before) if before is not None else F.lit(False)
            self.tables.write("late", held.where(F.coalesce(late, F.lit(False))), batch)
            last = [b for b in self.tables.batches("open") if b < batch][-1:]
            known = held.where(~F.coalesce(late, F.lit(False)) & F.col(self.time).isNotNull()).unionByName(self.tables.read("open", last).drop("batch"))
            newest_first = F.struct((-F.unix_micros(F.col(self.time).cast("timestamp"))).alias("age"), self.tie_break)
            rest = [c for c in self.columns if c not in self.keys]
            best = known.groupBy("hour", *self.keys).agg(F.min_by(F.struct(*rest), newest_first).alias("row")).select("hour", *self.keys, "row.*")
            seen = held.agg(F.max(F.unix_micros(F.col(self.time).cast("timestamp")))).first()[0]
            after = max((x for x in (before, None if seen is None else seen - self.delay * 1_000_000) if x is not None), default=None)
            closes = self._end() <= F.lit(after) if after is not None else F.lit(False)
            self.tables.write("closed", best.where(closes), batch)
            self.tables.write("open", best.where(~closes), batch)
            # The clock comes last: without it the batch has not happened.
            self.tables.write("clock", self.spark.createDataFrame([(after,)], "watermark long"), batch)
        finally:
            held.unpersist()

    def closed(self) -> DataFrame:
        return self.tables.read("closed").drop("batch")

    def late(self) -> DataFrame:
        return self.tables.read("late").drop("batch")

    def flush(self) -> DataFrame:
        """The newest rows of the hours that are still open; for use after the end of the input."""
        return self.tables.read("open", self.tables.batches("open")[-1:]).drop("batch")


class StreamedIndex:
    """An index kept as a log of changes in key buckets, with a base that is rewritten now and then.

    A batch writes only what it adds or removes, in the buckets of its keys, and looks up keys in
    these buckets only. Every ``compact_every`` batches the newest rows of all buckets become a new
    base, and reading starts there. A replayed batch overwrites its own folders and reads only
    earlier ones, so a sync can be repeated.
    """

    def __init__(self, spark: SparkSession, root: str, schema: StructType, key: str = "chunk_id", buckets: int = 64, compact_every: int = 16):
        self.spark, self.key, self.buckets, self.compact_every = spark, key, buckets, compact_every
        self.columns = schema.names
        whole = StructType([*schema.fields, StructField("live", BooleanType()), StructField("bucket", StringType())])
        self.tables = BatchTables(spark, root, {"log": whole, "base": whole})

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("string")

    def _changes(self, batch: int | None) -> DataFrame:
        """The last base and the changes after it, as of the start of a batch."""
        before = lambda found: [b for b in found if batch is None or b < batch]
        base = before(self.tables.batches("base"))[-1:]
        log = [b for b in before(self.tables.batches("log")) if not base or b > base[0]]
        return self.tables.read("base", base).unionByName(self.tables.read("log", log))

    def _newest(self, changes: DataFrame, columns: Sequence[str]) -> DataFrame:
        return latest_per_key(changes.select(*columns, "live", "batch"), [self.key], "batch").filter("live")

    def read(self) -> DataFrame:
        """The index as of the last batch."""
        return self._newest(self._changes(None), self.columns).select(*self.columns)

    def touched(self, batch_rows: DataFrame, batch: int) -> DataFrame:
        """The stored changes in the buckets of a batch's keys; no file of another bucket is read."""
        own = [r[0] for r in batch_rows.select(self._bucket()).distinct().collect()]  # at most ``buckets``
        return self._changes(batch).where(F.col("bucket").isin(own))

    def sync(self, batch_rows: DataFrame, batch: int, embed: Callable[[DataFrame], DataFrame], deleted: str | None) -> None:
        """Embed and add unknown keys; with a ``deleted`` flag column, remove flagged ones."""
        known = self._newest(self.touched(batch_rows, batch), [self.key]).select(self.key)
        gone = batch_rows.filter(deleted).select(self.key).distinct() if deleted else None
        current = batch_rows.filter(f"NOT {deleted}").drop(deleted) if deleted else batch_rows
        added = embed(current.dropDuplicates([self.key]).join(known, self.key, "left_anti"))
        changes = added.select(*self.columns, F.lit(True).alias("live"))
        if gone is not None:
            removed = gone.join(known, self.key, "left_semi").join(current.select(self.key), self.key, "left_anti")
            changes = changes.unionByName(removed.withColumn("live", F.lit(False)), allowMissingColumns=True)
        self.tables.write("log", changes.withColumn("bucket", self._bucket()), batch, by=["bucket"])
        if batch % self.compact_every == self.compact_every - 1:
            newest = self._newest(self._changes(batch + 1), self.columns).select(*self.columns, "live")
            self.tables.write("base", newest.withColumn("bucket", self._bucket()), batch, by=["bucket"])


def stream_index_sync(
    stream: DataFrame,
    index: StreamedIndex,
    checkpoint: str,
    embed: Callable[[DataFrame], DataFrame],
    deleted: str | None = None,
) -> StreamingQuery:
    """Sync the index per micro-batch: new keys pass through ``embed`` once, known keys are kept."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        index.sync(batch, batch_id, embed, deleted)

    return run_batches(stream, checkpoint, apply)


def finish(query: StreamingQuery) -> None:
    """Wait for an ``availableNow`` query and raise its error, if any."""
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def run_to_table(stream: DataFrame, label: str) -> DataFrame:
    """Run a stream over everything available and read the result back as a table."""
    spark = stream.sparkSession
    path = shared_path(spark, label)
    finish(write_available(stream, path, shared_path(spark, f"{label}-state")))
    return spark.read.schema(stream.schema).parquet(path)
