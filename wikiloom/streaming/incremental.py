"""Pages that arrive in files, taken apart batch by batch into all relations; a restart goes on where it stopped.

A batch is written by foreachBatch: it leaves out revisions that the checkpoint relation has, and writes the relations of its
pages as one batch of the log, which counts when its mark is there. A batch that is repeated after a failure
changes nothing, and a page keeps its newest revision in whatever order revisions come.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.job import RELATIONS, bundle
from ..operators.sinks import BatchLog, latest_per_key, resume
from ..plans.folders import cut, discard, ensure_checkpoints

PAGES = "revision_id long, page_id long, page_title string, namespace int, model string, redirect_to string, is_redirect boolean, content string"


def log(spark: SparkSession, folder: str) -> BatchLog:
    return BatchLog(spark, folder, RELATIONS)


def write_batch(batch: DataFrame, folder: str, source: str, name: str, store: DataFrame | None = None, **options) -> None:
    """One batch of pages into the log of ``folder``; of several revisions of a page the newest counts, of equal rows any one.

    A batch that the log has under this name is left as it is: Spark repeats a batch when it stops between our mark and its own.

    store: templates (title, body) to expand with; none leaves calls as links to missing templates.
    """
    spark = batch.sparkSession
    ensure_checkpoints(spark)
    known = log(spark, folder)
    if known.has(name):
        return
    new = resume(batch, known.every("checkpoint"), source)
    new = cut(latest_per_key(new, ["page_id"], "revision_id"))
    store = store if store is not None else spark.createDataFrame([], "title string, body string")
    relations = bundle(new, store, source, **options)
    discard(new)
    known.write(name, relations, relations["checkpoint"], last=True)


def _token(spark: SparkSession, folder: str) -> str:
    """A name of the stream's own, kept beside its checkpoint: batch numbers begin anew when that is lost, and must not meet old ones."""
    path = f"{folder}/_stream/name"
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        spark.createDataFrame([(uuid.uuid4().hex,)], "name string").coalesce(1).write.parquet(path)
    return spark.read.parquet(path).first()[0]


def start(spark: SparkSession, path: str, folder: str, source: str, files_per_batch: int = 16, store: DataFrame | None = None, **options) -> StreamingQuery:
    """Takes in all files of ``path`` there are, and stops: each of at most ``files_per_batch`` files a batch."""
    pages = spark.readStream.schema(PAGES).option("maxFilesPerTrigger", files_per_batch).parquet(path)
    token = _token(spark, folder)
    return (
        pages.writeStream.foreachBatch(lambda batch, number: write_batch(batch, folder, source, f"{number:012d}-{token}", store, **options))
        .option("checkpointLocation", f"{folder}/_stream/state")
        .trigger(availableNow=True)
        .start()
    )


def event_counts(events: DataFrame, window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Events and their values by window and type; rows later than ``late`` behind the newest are left out in a stream."""
    timed = events.withWatermark("ts", late).groupBy(F.window("ts", window), "event_type")
    return timed.agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("window.start").alias("begin"), "event_type", "n", "total")


def last_states(events: DataFrame) -> DataFrame:
    """The last event of each user, as a batch or the state a stream ends in."""
    return latest_per_key(events.select("user_id", "ts", "event_id", "event_type"), ["user_id"], "ts")


def streamed_states(spark: SparkSession, path: str, folder: str) -> DataFrame:
    """``last_states`` of the events in files of ``path``, taken by a stream that writes each batch's states and reads them together."""
    schema = spark.read.parquet(path).schema
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", 4).parquet(path)
    query = (
        rows.writeStream.foreachBatch(lambda batch, number: last_states(batch).write.mode("overwrite").parquet(f"{folder}/states/{number:012d}"))
        .option("checkpointLocation", f"{folder}/state")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return latest_per_key(spark.read.parquet(f"{folder}/states/*"), ["user_id"], "ts")


def unique(rows: DataFrame, keys: list[str], time: str | None = None, late: str | None = None) -> DataFrame:
    """``rows`` with one row of each key, of a stream also across batches: the state store holds the keys that have been.

    With ``time`` and ``late`` the state forgets keys that are older than ``late``, and a stream then leaves out rows that come later than that; without
    them it holds all keys and leaves out nothing but repeats. Null keys are equal. Of several rows of a key any one stays.
    """
    if time is None or late is None:
        return rows.dropDuplicates(keys)
    return rows.withWatermark(time, late).dropDuplicatesWithinWatermark(keys) if rows.isStreaming else rows.dropDuplicates(keys)


def streamed_unique(spark: SparkSession, paths: list[str], folder: str, keys: list[str], **options) -> DataFrame:
    """``unique`` of the files there are in ``paths``, all of one schema, by a stream that goes on from ``folder``; gives what it has written there so far.

    The file sink counts a batch once only, so a batch that is repeated after a failure adds nothing.
    """
    schema = spark.read.parquet(paths[0]).schema
    rows = None
    for path in paths:
        part = spark.readStream.schema(schema).option("maxFilesPerTrigger", 16).parquet(path)
        rows = part if rows is None else rows.unionByName(part)
    query = unique(rows, keys, **options).writeStream.format("parquet").option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start(f"{folder}/rows")
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return spark.read.schema(schema).parquet(f"{folder}/rows")
