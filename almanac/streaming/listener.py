"""Watch a directory, take its new files and keep what has been read in an archive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from almanac.staging import new_folder

# Fixed value: how often the directory is looked at.
EVERY = "10 minutes"


def listen(
    spark: SparkSession,
    source: str,
    archive: str | None = None,
    schema: T.StructType | None = None,
    fmt: str = "text",
    files_per_trigger: int = 1,
) -> DataFrame:
    """Stream of the rows of new files with their ``file_name``.

    Files wait in ``source`` until taken, ``files_per_trigger`` at a time, and move
    to ``archive``, on the same file system, in the background after their batch is
    committed.  A batch without files does nothing.
    """
    reader = spark.readStream.format(fmt).option("maxFilesPerTrigger", files_per_trigger)
    if schema is not None:
        reader = reader.schema(schema)
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.load(source).select("*", F.col("_metadata.file_name").alias("file_name"))


def deliver(
    stream: DataFrame, sink: str, checkpoint: str | None = None, every: str | None = EVERY
) -> StreamingQuery:
    """Append the stream to a parquet directory, each file exactly once.

    Give a lasting ``checkpoint`` folder in service, so that a restart goes on where the
    last run stopped.  ``every=None`` takes all waiting files and ends.
    """
    spark = stream.sparkSession
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", sink)
        .option("checkpointLocation", checkpoint or new_folder(spark, "listener-checkpoint"))
    )
    writer = writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)
    return writer.start()


def listen_once(
    spark: SparkSession, source: str, schema: T.StructType | None = None, fmt: str = "text", files_per_trigger: int = 1
) -> DataFrame:
    """Stream of the rows of new files with ``file_path`` and ``file_name``, for :func:`hand_over`."""
    reader = spark.readStream.format(fmt).option("maxFilesPerTrigger", files_per_trigger).option("ignoreMissingFiles", True)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(source).select(
        "*", F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_name").alias("file_name")
    )


def hand_over(
    stream: DataFrame, sink: str, ledger: str, archive: str, checkpoint: str, every: str | None = EVERY
) -> StreamingQuery:
    """Append the stream to ``sink`` and move each file to ``archive``, the last one too, each exactly once.

    A batch writes its rows below ``sink``, then (file_path, file_name, n) below ``ledger``, each in a folder of its own
    number, and moves its files only after that.  A batch that is run again after a failure overwrites its rows unless
    its ledger is complete; if it is, only files that are still there are moved.  So no file is repeated or lost,
    wherever the run stopped.  A file without rows stays where it is.  All folders lie on one file system.
    """

    def batch(rows: DataFrame, number: int) -> None:
        spark = rows.sparkSession
        at, entries = f"{sink}/batch={number}", f"{ledger}/batch={number}"
        if not _exists(spark, f"{entries}/_SUCCESS"):
            rows.write.mode("overwrite").parquet(at)
            written = spark.read.schema(rows.schema).parquet(at)
            written.groupBy("file_path", "file_name").agg(F.count("*").alias("n")).write.mode("overwrite").parquet(entries)
        for file in spark.read.parquet(entries).select("file_path").toLocalIterator():
            _move(spark, file["file_path"], archive)

    writer = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)
    return writer.start()


def _file_system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _exists(spark: SparkSession, path: str) -> bool:
    system, at = _file_system(spark, path)
    return system.exists(at)


def _move(spark: SparkSession, source: str, folder: str) -> None:
    """Move a file into a folder; one that has been moved before is left alone."""
    # The path of a row's file is that of a URI, in which some characters are coded.
    at = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(source))
    system, target = _file_system(spark, folder)
    system.mkdirs(target)
    to = spark._jvm.org.apache.hadoop.fs.Path(target, at.getName())
    if system.exists(at):
        if not system.rename(at, to):
            raise OSError(f"cannot move {source} to {folder}")
    elif not system.exists(to):
        raise FileNotFoundError(source)
