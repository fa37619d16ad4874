"""Typed CSV reads and file listings.

Every read states its schema: nothing is inferred, and a file that does not fit
fails the read instead of shifting its columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from almanac.operators.sparse import to_sparse

# The columns of a station file, in file order.
STATION_SCHEMA = T.StructType(
    [
        T.StructField("station", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField("latitude", T.FloatType()),
        T.StructField("longitude", T.FloatType()),
        T.StructField("elevation", T.FloatType()),
        T.StructField("tmax", T.FloatType()),
    ]
)


def read_station_csv(
    spark: SparkSession,
    directory: str,
    schema: T.StructType = STATION_SCHEMA,
    partitions: int | None = None,
) -> DataFrame:
    """All headerless CSV files of a directory, gzip told by suffix, as one table.

    A gzip file cannot be split, so there is one task per file.  Give
    ``partitions`` when the files are few and large and heavy work follows.
    """
    df = _strict(spark, schema).csv(directory)
    return df if partitions is None else df.repartition(partitions)


def read_typed_csv(spark: SparkSession, path: str, schema: T.StructType = STATION_SCHEMA) -> DataFrame:
    """CSV with a header that must name the schema's columns in order."""
    return _strict(spark, schema).option("header", True).option("enforceSchema", False).csv(path)


def read_matrix_csv(
    spark: SparkSession, path: str, width: int, keys: T.StructType, name: str = "features", prefix: str = "p"
) -> DataFrame:
    """Wide numeric CSV with a header: key columns first, then ``width`` numbers.

    The numbers become one array; row ids and labels stay columns of their own.
    """
    numbers = [T.StructField(f"{prefix}{i}", T.DoubleType()) for i in range(width)]
    wide = read_typed_csv(spark, path, T.StructType([*keys.fields, *numbers]))
    return wide.select(*keys.names, F.array(*[f.name for f in numbers]).alias(name))


def read_sparse_csv(
    spark: SparkSession, path: str, width: int, keys: T.StructType, name: str = "features", prefix: str = "p"
) -> DataFrame:
    """The same file with vectors in the form of :mod:`almanac.operators.sparse`; zeros are gone before any shuffle."""
    return read_matrix_csv(spark, path, width, keys, name, prefix).withColumn(name, to_sparse(name))


def file_inventory(spark: SparkSession, directory: str) -> DataFrame:
    """(path, modificationTime, length) of all files below a directory; reads no content."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(directory)
    return files.select("path", "modificationTime", "length")


def _strict(spark: SparkSession, schema: T.StructType):
    # Without column pruning the whole header is checked, also when few columns are used.
    return spark.read.schema(schema).option("mode", "FAILFAST").option("columnPruning", False)
