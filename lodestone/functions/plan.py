"""Helpers that shape plans, and the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def settled(value: Column) -> Column:
    """``value``, computed once a row.

    Catalyst copies a projected expression into every filter above it that it pushes down, and so on through
    chains of projections; for large expressions (parsed records, the classifier cascade) the copies grow
    with each step. A condition that is always true but not known to be keeps the expression in its place.
    """
    return F.when(F.spark_partition_id() >= 0, value)


def once(value: Column, use) -> Column:  # noqa: ANN001
    """``use(value)``, with ``value`` computed once a row however often ``use`` names it.

    Catalyst does not share what stands inside conditions and functions of arrays: each mention is computed again.
    """
    return F.element_at(F.transform(F.array(value), use), 1)


def dealt(df: DataFrame) -> DataFrame:
    """``df`` dealt evenly over the cores of the session.

    A table of a few megabytes is one split, or one group of rows, and all that is made of its rows would be one
    task, which more machines do not shorten. The number of parts is given, so that they are not put together
    again for their few bytes. Rows are shuffled as they stand: deal them while they are narrow.
    """
    return df.repartition(3 * max(df.sparkSession.sparkContext.defaultParallelism, 8))


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: the one that spark.checkpoint.dir names.

    Where none is named, a local session (as in tests) gets one of its own; on a cluster that is an error,
    since executors would write to their own disks.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None and context.master.split("[")[0] != "local":
            raise ValueError("name a folder that driver and executors share in spark.checkpoint.dir")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="checkpoints-"))
    return context.getCheckpointDir()


def scratch(spark: SparkSession) -> str:
    """A new folder name under the shared folder; what is written there goes when the session's JVM ends."""
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    where = hadoop_path(spark, path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)
    return path


def written(df: DataFrame, *partition_by: str) -> tuple[DataFrame, str]:
    """``df`` written to the shared folder and read from there (cuts the lineage), and its folder."""
    path = scratch(df.sparkSession)
    (df.write.partitionBy(*partition_by) if partition_by else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read from there, for iterations whose plans would grow."""
    return written(df)[0]


def hadoop_path(spark: SparkSession, path: str):  # noqa: ANN201
    """A path of any store, for its own file system."""
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Deletes a folder of any store."""
    where = hadoop_path(spark, path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def is_file(spark: SparkSession, path: str) -> bool:
    """Whether the path is one file."""
    where = hadoop_path(spark, path)
    store = where.getFileSystem(spark._jsc.hadoopConfiguration())
    return bool(store.exists(where) and store.getFileStatus(where).isFile())


def stored_bytes(spark: SparkSession, path: str) -> int:
    """The bytes of a file or folder."""
    where = hadoop_path(spark, path)
    return int(where.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(where).getLength())
