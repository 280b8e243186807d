"""Shared helpers of the text operators: input columns, scratch tables, fixed patterns."""

from __future__ import annotations

import ctypes
import re
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters that separate words: space and the five ASCII controls tab to carriage return.
SEPARATORS = b" \t\n\x0b\x0c\r"
SEPARATOR_CLASS = r"[\x20\x09-\x0D]"

#: Only for sessions in one process, where all tasks see the driver's disk.
LOCAL_CHECKPOINT_DIR = "/tmp/candlelake-scratch"


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def texts(docs: DataFrame, *others: str) -> DataFrame:
    """doc_id, text (null becomes empty) and the other columns that are asked for; extra columns of the input go."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"), *others)


def free_name(df: DataFrame, name: str) -> str:
    """The name, with underscores put before it until df has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def scratch_dir(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir, which all executors share. Without that setting a session in one process
    gets a local one; on a cluster it raises, as executors wouldn't see each other's files."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = LOCAL_CHECKPOINT_DIR
    return f"{base.rstrip('/')}/candlelake-{uuid.uuid4().hex}"


@contextmanager
def _settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """Within it, settings of the session; dots are spelt as double underscores."""
    values = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def materialise(df: DataFrame, *partition_by: str) -> DataFrame:
    """Write df to a scratch table and read it back: cuts the lineage, survives the loss of any executor."""
    spark, path = df.sparkSession, scratch_dir(df.sparkSession)
    # The finished write frees its shuffle files, as what was written is all that is read again; Arrow batches stay small.
    with _settings(spark, spark__sql__classic__shuffleDependency__fileCleanup__enabled="true", spark__sql__execution__arrow__maxRecordsPerBatch="2000"):
        writer = df.write.option("compression", "zstd")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def discard_path(spark: SparkSession, path: str) -> None:
    jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(conf).delete(p, True)


def discard(*tables: DataFrame) -> None:
    """Delete scratch tables that no later result reads."""
    for t in tables:
        if path := getattr(t, "_scratch", None):
            discard_path(t.sparkSession, path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def tidied(run: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """A task's function for mapInPandas that returns free memory to the system at its end. Python workers stay for later
    tasks, and what they hold adds to their executor's memory, also while only its JVM works."""

    def whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # only glibc has it
                trim(0)

    return whole
