"""Where plans are cut: the shared folder that the cluster names in spark.checkpoint.dir."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoints(spark: SparkSession) -> None:
    """Leaves a set folder as it is; sets a temporary one only where none is set and Spark runs in this process."""
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found is None:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = tempfile.mkdtemp(prefix="wikiloom-")
    context.setCheckpointDir(found)


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder's path, set as ``ensure_checkpoints`` does."""
    ensure_checkpoints(spark)
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return found.rstrip("/")


@contextmanager
def tidied(spark: SparkSession) -> Iterator[None]:
    """What is written inside leaves no shuffle files behind; else they stay until the driver happens to collect its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def cut(df: DataFrame) -> DataFrame:
    """``df`` as a compressed table in the shared folder, without its plan: a checkpoint of rows is several times as large."""
    spark = df.sparkSession
    path = f"{checkpoint_folder(spark)}/cut-{uuid.uuid4().hex}"
    with tidied(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame, keep: tuple[DataFrame, ...] = ()) -> None:
    """Deletes the tables of ``cut`` that ``tables`` read and ``keep`` doesn't, once nothing reads them any more."""
    spark = tables[0].sparkSession
    path = lambda text: spark._jvm.org.apache.hadoop.fs.Path(text)
    where = lambda p: p.toUri().getPath()
    read = lambda frames: {f.rsplit("/", 1)[0] for df in frames for f in df.inputFiles()}
    top = where(path(checkpoint_folder(spark)))
    for folder in map(path, read(tables) - read(keep)):
        if folder.getName().startswith("cut-") and where(folder.getParent()) == top:
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join that is never broadcast: Spark goes by the size of files, and texts that are much alike take up far more memory than they do there."""
    return df.hint("merge")
