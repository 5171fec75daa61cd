"""Keyed, idempotent writes over Parquet, and checkpoints for resuming.

Parquet tables have no MERGE: a keyed write is the anti-join of what is there with the new keys, and the new rows. Relations
of pages that grow by batches are only appended to, and the newest rows of a page are picked on reading.
"""

from __future__ import annotations

import hashlib
import re
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..plans.folders import discard, tidied

COMPLETED, WITH_ERRORS = "completed", "completed_with_errors"


def source_id(path: str, size: int, mtime_ns: int) -> str:
    """Name of one state of a source file."""
    return hashlib.sha256(f"v1\0{path}\0{size}\0{mtime_ns}".encode()).hexdigest()


def table_suffix(file_name: str) -> str:
    """``_YYYYMMDD`` from a dump's file name; an error if it has no such date."""
    found = re.search(r"-(\d{8})(?:-|\.|$)", file_name)
    if not found:
        raise ValueError(f"no date in {file_name!r}")
    return f"_{found[1]}"


def latest_per_key(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One row for each key: that of the greatest ``order`` (ties: any one whole row). One combined aggregate, no window."""
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(order, *[c for c in rest if c != order])).alias("__r")).select(*[c if c in keys else F.col(f"__r.{c}").alias(c) for c in rows.columns])


def upsert(existing: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """``existing`` with the rows of ``new`` in place of those of equal keys. Null keys are equal to each other."""
    return _without(existing, new, keys).unionByName(new)


def replace_by_key(existing: DataFrame, new: DataFrame, touched: DataFrame, keys: list[str]) -> DataFrame:
    """All rows of the ``touched`` keys go, also where ``new`` has none for them; then ``new`` comes in."""
    return _without(existing, touched, keys).unionByName(new)


def insert_missing(existing: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """First writer wins: only rows of new keys come in."""
    return existing.unionByName(_without(new.dropDuplicates(keys), existing, keys))


def _without(rows: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    names = {k: f"__k{i}" for i, k in enumerate(keys)}
    right = other.select(*[F.col(k).alias(n) for k, n in names.items()]).distinct()
    same = [rows[k].eqNullSafe(right[n]) for k, n in names.items()]
    condition = same[0]
    for c in same[1:]:
        condition = condition & c
    return rows.join(right, condition, "left_anti")


def duplicated_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that stand more than once: a unique constraint holds if this is empty."""
    return rows.groupBy(*keys).count().filter("count > 1")


def status(parse_error: Column) -> Column:
    return F.when(parse_error.isNotNull() & (parse_error != ""), WITH_ERRORS).otherwise(COMPLETED)


def terminal_records(processed: DataFrame, source: str) -> DataFrame:
    """Checkpoint rows of revisions whose raw and processed rows are both written."""
    return processed.select(F.lit(source).alias("source_id"), "revision_id", "page_id", status(F.col("parse_error")).alias("status"))


def resume(rows: DataFrame, checkpoint: DataFrame, source: str, retry_errors: bool = False) -> DataFrame:
    """``rows`` whose revision is not terminal yet; with ``retry_errors`` those with errors come again."""
    done = checkpoint.filter(F.col("source_id") == source).filter(F.col("status").isin(*([COMPLETED] if retry_errors else [COMPLETED, WITH_ERRORS])))
    return rows.join(done.select("revision_id").distinct(), "revision_id", "left_anti")


class BatchLog:
    """Relations of pages in one folder, written batch by batch; nothing that is there is ever written again.

    Each attempt at a batch puts its rows under ``relation/batch=attempt`` with a name of its own, the pages it is about (page_id, revision_id)
    under ``_pages``, and last a mark under ``_batches/batch=name`` that holds the attempt: only then does it count, so readers and re-runs
    see all of it or none. A batch that counts is never written again. A page is what the batch of its greatest
    revision wrote (of equal ones the batch of the greater name), also where that wrote nothing.
    """

    def __init__(self, spark: SparkSession, folder: str, schemas: dict[str, str]):
        self.spark, self.folder, self.schemas = spark, folder.rstrip("/"), schemas

    def _table(self, name: str, schema: str) -> DataFrame:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        if not path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            return self.spark.createDataFrame([], f"{schema}, batch string")
        return self.spark.read.schema(f"{schema}, batch string").parquet(f"{self.folder}/{name}")

    def write(self, batch: str, relations: dict[str, DataFrame], pages: DataFrame, last: bool = False) -> None:
        """One batch: ``relations`` by name and ``pages`` (page_id, revision_id) that they are about; nothing happens if it counts already.

        last: nothing else reads the tables of ``cut`` that these read, and each is deleted as soon as none of them does.
        """
        if self.has(batch):
            return
        attempt = f"{batch}~{uuid.uuid4().hex}"
        waiting = [*relations.values(), pages]
        for name, rows in relations.items():
            fields = [c.name for c in self.spark.createDataFrame([], self.schemas[name]).schema]
            with tidied(self.spark):
                rows.select(*fields).write.option("compression", "zstd").parquet(f"{self.folder}/{name}/batch={attempt}")
            waiting.pop(0)
            if last:
                discard(rows, keep=tuple(waiting))
        with tidied(self.spark):
            pages.select("page_id", "revision_id").write.parquet(f"{self.folder}/_pages/batch={attempt}")
        if last:
            discard(pages)
        self.commit(attempt)

    def commit(self, attempt: str) -> None:
        """Makes ``attempt`` (batch~anything) the one that counts for its batch."""
        batch = attempt.rsplit("~", 1)[0]
        self.spark.createDataFrame([(attempt,)], "attempt string").coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/_batches/batch={batch}")

    def has(self, batch: str) -> bool:
        """Whether the batch counts."""
        return not self._done().filter(F.col("name") == batch).isEmpty()

    def _done(self) -> DataFrame:
        """(name, batch): the batches that count, and the attempt of each; marks without one are of batches written under their own name."""
        return self._table("_batches", "attempt string").select(F.col("batch").alias("name"), F.coalesce("attempt", "batch").alias("batch")).distinct()

    def every(self, name: str) -> DataFrame:
        """The rows of all batches that count, of older revisions too."""
        return self._table(name, self.schemas[name]).join(self._done(), "batch", "left_semi").drop("batch")

    def read(self, name: str) -> DataFrame:
        """The rows of the pages as they are now."""
        pages = self._table("_pages", "page_id long, revision_id long").join(self._done(), "batch")
        newest = pages.groupBy("page_id").agg(F.max(F.struct("revision_id", "name", "batch")).alias("n")).select("page_id", "n.batch")
        return self._table(name, self.schemas[name]).join(newest, ["page_id", "batch"], "left_semi").drop("batch")


def conforming(rows: DataFrame, schema: str) -> DataFrame:
    """``rows`` with the columns of ``schema`` only: older columns go, new ones are null."""
    fields = rows.sparkSession.createDataFrame([], schema).schema
    return rows.select(*[(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields])


def issues(rows: DataFrame, keys: list[str], issue: str = "issue") -> DataFrame:
    """(keys, issues): the different issues of a key in order, joined by '; '."""
    return rows.filter(F.col(issue).isNotNull()).groupBy(*keys).agg(F.array_join(F.array_sort(F.collect_set(issue)), "; ").alias("issues"))


def write_metered(rows: DataFrame, path: str, skip: Column, mode: str = "errorifexists") -> dict[str, int]:
    """Writes ``rows`` where ``skip`` isn't true to ``path``; gives read_rows and skipped_rows, counted by the job that writes.

    Counts are those of the attempts that succeeded. An empty table gives zeros.
    """
    metrics = Observation()
    skipped = F.coalesce(skip, F.lit(False))
    seen = rows.observe(metrics, F.count(F.lit(1)).alias("read_rows"), F.count(F.when(skipped, 1)).alias("skipped_rows"))
    # the filter reads a column of the observed rows and stays above them
    seen.filter(~skipped).write.mode(mode).parquet(path)
    return metrics.get
