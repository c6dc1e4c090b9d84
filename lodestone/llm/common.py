"""Helpers shared by the corpus operators.

Batches that go to Python workers are bounded by Spark itself: at most 10,000 rows and 64 MiB of data (its
defaults), so a batch of long texts is cut by bytes. Operators that run their steps at once (they write them
to the shared folder) take smaller batches meanwhile, and leave the caller's session as it was.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@contextmanager
def batch_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of ``rows`` rows at most for what is run inside; the session's own option comes back."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the input folder, through Spark's reader (the folder may be in any store)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: the one that spark.checkpoint.dir names.

    Where none is named, a local session (as in tests) gets a folder of its own; on a cluster that is an
    error, since executors would write to their own disks.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None and not context.master.split("[")[0] == "local":
            raise ValueError("name a folder that driver and executors share in spark.checkpoint.dir")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="checkpoints-"))
    return context.getCheckpointDir()


def written(df: DataFrame, *partition_by: str) -> tuple[DataFrame, str]:
    """``df`` written to the shared folder and read from there (cuts the lineage), and the folder."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    (df.write.partitionBy(*partition_by) if partition_by else df.write).parquet(path)
    where = _path(spark, path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)
    return spark.read.schema(df.schema).parquet(path), path


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read from there; the files go when the session's JVM ends."""
    return written(df)[0]


def remove_folder(spark: SparkSession, path: str) -> None:
    """Deletes a folder of the shared store, through its own file system."""
    where = _path(spark, path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def _path(spark: SparkSession, path: str):  # noqa: ANN202
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def fresh(name: str) -> str:
    """A column name that no caller's column has."""
    return f"{name}_{uuid.uuid4().hex}"


def own_columns(df: DataFrame) -> list[Column]:
    """All columns of ``df``, whatever signs their names hold."""
    return [df[f"`{c.replace('`', '``')}`"] for c in df.columns]


#: Keys of a join that count as hot at most: those of more than this share of the rows.
HOT_KEYS = 1_000


def join_spread(many: DataFrame, one: DataFrame, key: str, n: int, by: Column, how: str = "inner") -> DataFrame:
    """``many`` (of about ``n`` rows) joined with ``one`` (a row a key), with hot keys dealt to many tasks.

    Keys of over n / HOT_KEYS rows are HOT_KEYS at most, so their table can be broadcast: their rows of
    ``many`` are dealt by ``by`` (a hash of the row), and their rows of ``one`` are repeated for each share.
    """
    share, chunks, salt = max(1, n // HOT_KEYS), fresh("chunks"), fresh("salt")
    hot = many.groupBy(key).agg(F.count(F.lit(1)).alias(chunks)).where(F.col(chunks) > share).select(key, F.ceil(F.col(chunks) / share).cast("int").alias(chunks))
    dealt = many.join(F.broadcast(hot), key, "left").withColumn(salt, F.when(F.col(chunks).isNull(), 0).otherwise(F.pmod(by, F.col(chunks))).cast("int"))
    repeated = one.join(F.broadcast(hot), key, "left").withColumn(salt, F.explode(F.sequence(F.lit(0), F.coalesce(F.col(chunks), F.lit(1)) - 1)))
    return dealt.drop(chunks).join(repeated.drop(chunks), [key, salt], how).drop(salt)


def whole_text(name: str = "text") -> Column:
    """The text column with null read as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def text_bytes(df: DataFrame, name: str = "text") -> int:
    """UTF-8 bytes of all texts (one pass); sizes partitions."""
    return int(df.agg(F.sum(F.octet_length(F.col(name).cast("string")))).first()[0] or 0)
