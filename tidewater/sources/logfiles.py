"""Daily log files: one JSON document per line, one file per day."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The names of rolled log files. The open file of the day is not read.
ROLLED_FILES = "app.*.log"
DAY_IN_NAME = r"app\.(\d{4}-\d{2}-\d{2})\.log$"

# Together these follow the lines of a file from top to bottom.
LINE_ORDER = ("day", "file", "block_start", "line")


def read_log_files(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of all rolled files: ``value`` and the order columns ``LINE_ORDER``."""
    lines = spark.read.option("pathGlobFilter", ROLLED_FILES).option("recursiveFileLookup", "true")
    # Ascending within a task, and a task reads each block of a file from its start.
    return _with_order(lines.text(folder)).withColumn("line", F.monotonically_increasing_id())


def stream_log_files(
    spark: SparkSession, folder: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """The same as a stream; files must be complete when they appear in the folder."""
    lines = spark.readStream.option("pathGlobFilter", ROLLED_FILES).option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        lines = lines.option("maxFilesPerTrigger", max_files_per_trigger)
    return _with_order(lines.text(folder)).withColumn("line", line_counter()("block_start"))


def _with_order(lines: DataFrame) -> DataFrame:
    name = F.col("_metadata.file_name")
    return lines.select(
        "value",
        F.to_date(F.nullif(F.regexp_extract(name, DAY_IN_NAME, 1), F.lit(""))).alias("day"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block_start"),
    )


def line_counter():
    """Number the rows of each task; streams do not allow the built-in increasing id."""

    def count(blocks: Iterator[pd.Series]) -> Iterator[pd.Series]:
        seen = 0
        for block in blocks:
            yield pd.Series(range(seen, seen + len(block)))
            seen += len(block)

    # Set by hand: the deferred annotations of this module hide the iterator types.
    count.__annotations__ = {"blocks": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(count, "bigint").asNondeterministic()
