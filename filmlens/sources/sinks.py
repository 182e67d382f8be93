"""Writers. Every table is written by the executors, one file per task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


FILE_BYTES = 128 * 1024 * 1024


def records_per_file(df: DataFrame, file_bytes: int = FILE_BYTES) -> int:
    """Records that make about ``file_bytes`` of CSV, from the mean size of a row over all rows."""
    size = F.lit(0)
    for field in df.schema.fields:
        size = size + F.coalesce(F.octet_length(F.col(f"`{field.name}`").cast("string")), F.lit(0)) + 1
    mean = df.agg(F.avg(size).alias("mean")).first().mean
    return max(1, int(file_bytes / (mean or file_bytes)))


def write_csv(df: DataFrame, path: str, file_bytes: int = FILE_BYTES, mode: str = "errorifexists", **options: str) -> None:
    """CSV with a header and doubled quotes.

    Files are kept to about ``file_bytes``, so that a reader that has to take a
    file whole (``multiLine``) still works in parallel, whatever the rows' size.
    """
    (
        df.write.mode(mode)
        .option("header", True)
        .option("escape", '"')
        .option("maxRecordsPerFile", records_per_file(df, file_bytes))
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        # The defaults cut times to milliseconds.
        .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
        .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        .options(**options)
        .csv(path)
    )


def save_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Write all rows."""
    df.write.mode(mode).format(fmt).save(path)


def save_head(df: DataFrame, path: str, n: int, order: list[Column], fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Write the first ``n`` rows in the given order, untruncated."""
    save_table(df.orderBy(*order).limit(n), path, fmt, mode)


def show_head(df: DataFrame, n: int = 10, truncate: bool | int = 40, vertical: bool = False) -> None:
    """Print the first ``n`` rows as a table or one value per line."""
    df.show(n, truncate=truncate, vertical=vertical)
