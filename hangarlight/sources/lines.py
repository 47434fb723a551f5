"""Lines of text files with an order that does not depend on how the files are split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def line_order() -> Column:
    """The place of a row that was read from line-based files: file, block and line, as a value to compare.

    A task reads the lines of a block in their order, so numbers given in a task order them, whatever those numbers are; the
    block's start orders blocks. So any split of the files gives the same order.
    """
    return F.struct(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line")
    )


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """value, ord of each line."""
    return spark.read.text(path).select("value", line_order().alias("ord"))
