"""Tables written once between two passes of an operator.

A two-pass operator needs both passes to see the same rows in the same places,
also after an executor is lost.  It therefore writes its intermediate table to
a folder all executors share and reads it back: the session's
``spark.checkpoint.dir``, else its checkpoint folder, else its warehouse, which
every session has.  Everything lies below one folder per application, which
:func:`clean` removes once the results have been consumed.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def staging_root(spark: SparkSession) -> str:
    """The folder shared by the cluster, the same for every master."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    return named or spark.conf.get("spark.sql.warehouse.dir")


def application_folder(spark: SparkSession) -> str:
    return f"{staging_root(spark).rstrip('/')}/almanac/{spark.sparkContext.applicationId}"


def new_folder(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nobody has used yet."""
    return f"{application_folder(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and return the written table."""
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the cluster's checkpoint folder, partitions and their order kept, without its lineage."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(staging_root(df.sparkSession))
    return df.checkpoint()


def clean(spark: SparkSession) -> bool:
    """Remove what this application has staged; results that still read it are lost."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(application_folder(spark))
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
