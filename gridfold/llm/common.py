"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import tempfile
import uuid

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Most rows of a side table that may be broadcast; larger ones are shuffled.
BROADCAST_ROWS = 20_000


#: Most bytes of a batch that goes to a Python worker, in place of Spark's 64 MB.
BATCH_BYTES = 8 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where that is unset, a temporary one, but only if all
    runs on one machine, as in tests; on a cluster that raises RuntimeError."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not where:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and the executors share")
        where = "file://" + tempfile.mkdtemp(prefix="gridfold-")
        spark.conf.set("spark.checkpoint.dir", where)
    return where


def cut(df: DataFrame) -> DataFrame:
    """Materialise df in the shared folder and go on from there, so that its lineage isn't run again."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint()


def held(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """As cut, but a table of at most so many rows becomes part of the plan and needs no files."""
    rows = df.limit(most + 1).toArrow()
    return df.sparkSession.createDataFrame(rows, df.schema) if rows.num_rows <= most else cut(df)


def written(df: DataFrame) -> DataFrame:
    """As cut, but as Parquet: for wide rows of which later steps read only some columns. The files go when the driver ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/gridfold-{uuid.uuid4().hex}"
    df.write.parquet(path)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    return spark.read.schema(df.schema).parquet(path)


def bounded_batches(spark: SparkSession) -> None:
    """Batches of at most BATCH_BYTES for Python workers: a session setting that is lowered where it is larger."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if bytes_of(spark.conf.get(key)) > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def mapped(df: DataFrame, run, schema) -> DataFrame:
    """df.mapInArrow(run, schema) for texts of any length: bounded batches, and workers that give back what they have freed
    when a task ends."""
    bounded_batches(df.sparkSession)

    def task(batches):
        yield from run(batches)
        give_back()

    task.__name__ = run.__name__
    return df.mapInArrow(task, schema)


def bytes_of(size: str) -> int:
    """A size as settings give it: 64MB, 8m, 1048576."""
    digits = size.strip().lower().removesuffix("b")
    scale = {"k": 10, "m": 20, "g": 30}.get(digits[-1:], 0)
    return int(digits[:-1] if scale else digits) << scale


def give_back() -> None:
    """Freed memory of this worker goes back to the machine, where its C library knows how."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def small(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """df with a broadcast hint if it has at most so many rows, which are counted; otherwise df. Give it materialised rows."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def texts(docs: DataFrame) -> DataFrame:
    """(doc_id, text): what most operators read; null texts are empty."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))


def hash60(*parts: Column | str) -> Column:
    """A 60-bit hash that any SQL engine with MD5 computes alike: the first 15 hex digits of md5(parts joined by ':')."""
    cols = [F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("~")) for p in parts]
    return F.conv(F.substring(F.md5(F.concat_ws(":", *cols)), 1, 15), 16, 10).cast("long")


def slices(batch: pa.RecordBatch, column: str = "text", most: int = 4 << 20):
    """The batch in pieces with at most so many bytes of the column, one row at least: Python lists stay small with long texts."""
    start = size = 0
    lengths = pa.compute.binary_length(batch.column(column)).to_pylist() if batch.num_rows else []
    for i, n in enumerate(lengths):
        if i > start and size + (n or 0) > most:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += n or 0
    if start < batch.num_rows:
        yield batch.slice(start)


def arrow_schema(df_schema) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(df_schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
