"""Helpers the operators share: word splitting, Arrow row iteration, tables in the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows turned into Python objects at a time, so that a batch of long texts is never held twice.
SLICE_ROWS = 512


def words_of(text: bytes | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of UTF-8 text: ``bytes.split`` cuts at exactly these six bytes."""
    return text.split() if text else []


def binary_column(batch: pa.RecordBatch, name: str) -> pa.Array:
    """A string column as its UTF-8 bytes, without decoding."""
    column = batch.column(batch.schema.get_field_index(name))
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary())


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``; a temporary one only where that is unset and Spark is local."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="wikiloom-"))
    return context.getCheckpointDir().rstrip("/")


def written(df: DataFrame, what: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: cuts lineage, and outlives lost executors."""
    spark = df.sparkSession
    path = f"{checkpoint_folder(spark)}/{what}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def removed(spark: SparkSession, path: str) -> None:
    """Deletes a folder that an operator wrote and nothing reads any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def discard(df: DataFrame) -> None:
    """Deletes the files of a table that ``written`` made, once nothing reads it any more."""
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        removed(df.sparkSession, folder)


def spread(df: DataFrame, *columns: str) -> DataFrame:
    """A narrow table dealt to all shuffle partitions: for rows that are about to be multiplied."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *columns)


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join that is never broadcast: Spark takes rows behind an explode, or packed tightly in Parquet, for far smaller than they are."""
    return df.hint("merge")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def sha256_hex(column: F.Column) -> F.Column:
    return F.sha2(column, 256)


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, longer by underscores until no column of ``df`` has the name, in any case."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted
