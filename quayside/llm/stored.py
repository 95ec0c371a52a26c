"""Rows that can be recognised when a table is read again."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.session import new_folder

PLACE_TYPE = "struct<file: bigint, row: bigint>"


def stored(docs: DataFrame) -> DataFrame:
    """`docs` itself where its rows come from files with row numbers, else a written copy in the shared folder."""
    try:
        docs.select("_metadata.file_path", "_metadata.row_index")
        return docs
    except AnalysisException:
        path = new_folder(docs.sparkSession, "stored")
        docs.write.parquet(path)
        return docs.sparkSession.read.parquet(path)


def placed(docs: DataFrame, name: str = "place") -> DataFrame:
    """A stored table with each row's place: a hash of its file's path, and its number in the file.

    Unlike numbers that a query gives out, a place is the same however the files are split, also after executors are
    lost or change in number.
    """
    return docs.withColumn(
        name, F.struct(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    )
