"""MediaWiki dumps: XML (plain or bz2) into page rows, and landed as Parquet partitioned by namespace.

A dump is read once with a fixed schema; everything later reads the Parquet tables, where namespace tests prune folders.
bz2 is splittable, so one large file is read by many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = """title STRING, ns INT, id LONG, redirect STRUCT<_title: STRING>,
revision ARRAY<STRUCT<id: LONG, contributor: STRUCT<username: STRING, ip: STRING, id: LONG>, minor: STRING, comment: STRING, model: STRING, format: STRING, text: STRUCT<_VALUE: STRING, _bytes: LONG>>>"""


def read_dump(spark: SparkSession, path: str) -> DataFrame:
    """Pages as they stand in the file, with all their revisions."""
    return spark.read.format("xml").option("rowTag", "page").option("ignoreSurroundingSpaces", "false").schema(SCHEMA).load(path)


def latest_revisions(pages: DataFrame, namespaces: list[int] | None = (0,), max_pages: int | None = None) -> DataFrame:
    """A row per page: its last revision in the order of the file. namespaces None takes all; the cap is exact."""
    if namespaces is not None:
        pages = pages.filter(F.col("ns").isin(*namespaces))
    r = F.try_element_at("revision", F.lit(-1))
    rows = pages.withColumn("r", r).filter("r IS NOT NULL").select(
        F.col("r.id").alias("revision_id"),
        F.col("id").alias("page_id"),
        F.col("title").alias("page_title"),
        F.col("ns").alias("namespace"),
        F.col("redirect").isNotNull().alias("is_redirect"),
        F.col("redirect._title").alias("redirect_to"),
        F.col("r.comment").alias("comment"),
        F.coalesce("r.contributor.username", "r.contributor.ip").alias("user_text"),
        F.col("r.contributor.id").alias("user_id"),
        F.when(F.col("r.minor").isNotNull(), True).alias("minor"),
        F.col("r.model").alias("model"),
        F.col("r.format").alias("content_format"),
        F.col("r.text._VALUE").alias("content"),
    )
    return rows if max_pages is None else rows.limit(max_pages)


def land(rows: DataFrame, path: str) -> None:
    """Page rows as Parquet by namespace, dealt by page so that files are even and none too large."""
    rows.repartition("namespace", F.pmod(F.xxhash64("page_id"), F.lit(64))).sortWithinPartitions("page_id").write.option("maxRecordsPerFile", 500_000).partitionBy("namespace").parquet(path)
