"""What several operators share: words, carried rows and written intermediate tables."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def whole_text(text: str | Column = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def carried(docs: DataFrame, columns: list[str] | None = None) -> Column:
    """The input columns as one struct, so that no name of theirs can clash with an operator's own."""
    return F.struct(*(F.col(f"`{c}`") for c in (docs.columns if columns is None else columns)))


def computed(rows: DataFrame, name: str, value: Column) -> DataFrame:
    """Adds a column that later expressions read instead of taking it in: inside a lambda it would be computed
    again for every element. Exploding an array of one is what Spark does not merge with other projections."""
    return rows.select("*", F.explode(F.array(value)).alias(name))


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; a temporary one only where that is unset and all runs on this machine."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = tempfile.gettempdir()
    return folder.rstrip("/")


def written(df: DataFrame) -> DataFrame:
    """The rows, written once to the shared folder and read back; deleted when the driver's JVM ends.

    Later stages read the files, so neither a lost executor nor a second use computes the rows again.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_tasks(spark: SparkSession) -> int:
    """The session's number of shuffle partitions, which the cluster's owner sizes to the input."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def importable(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver has it, unless their path is set already."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    spark.sparkContext.environment.setdefault("PYTHONPATH", root)


def release_memory() -> None:
    """Gives back what earlier tasks of this Python worker have freed: Spark reuses workers, and both Arrow's pool and
    the C library keep freed memory for themselves, beside the heap of the executor."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc only
    if trim is not None:
        trim(0)


BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Documents are long: fewer of them at a time in a Python worker, unless the session's owner said otherwise."""
    if spark.conf.get(BATCH_ROWS) == "10000":  # Spark's own default
        spark.conf.set(BATCH_ROWS, str(rows))
