"""CSV output."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from almanac.operators.indexing import with_row_index


def write_csv(
    df: DataFrame,
    path: str,
    header: bool = True,
    index_by: Sequence[str] | None = None,
    index: str = "idx",
    compression: str | None = None,
    mode: str = "errorifexists",
) -> None:
    """Write a directory of CSV files, all tasks side by side.

    With ``index_by`` a leading column numbers the rows 0..n-1 in that order.
    """
    if index_by is not None:
        df = with_row_index(df, index_by, index).select(index, *df.columns)
    df.write.mode(mode).csv(path, header=header, compression=compression or "none")
