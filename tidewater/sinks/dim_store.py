"""Dimension tables as merged cells: append per batch, compact now and then, merge on read.

Each batch appends the cells it carries, so its cost follows the batch and not the
table. A compaction merges everything into a new base and opens a new epoch, and
readers need the latest base and the changes of its epoch only. Merging cells is
idempotent, so a batch that is replayed after a failure changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.operators.dims import merge_cells, wide_rows
from tidewater.schemas import DIM_CELL
from tidewater.session import read_if_exists

STORED_CELL = f"sink_table string, {DIM_CELL}"


@dataclass(frozen=True)
class DimStore:
    root: str

    def epoch(self, spark: SparkSession) -> int:
        """Number of the latest finished compaction; 0 before the first."""
        done = read_if_exists(spark, f"{self.root}/epochs", "epoch bigint")
        return done.agg(F.max("epoch").alias("epoch")).first()["epoch"] or 0

    def append(self, cells: DataFrame, job: str, batch_id: int) -> DataFrame:
        """Store the merged cells of one batch, replacing an earlier try of the same batch.

        Returns them as they were written.
        """
        spark = cells.sparkSession
        target = f"{self.root}/changes/epoch={self.epoch(spark)}/job={job}/batch_id={batch_id}"
        _write(merge_cells(cells), target)
        return spark.read.schema(STORED_CELL).parquet(target)

    def cells(self, spark: SparkSession) -> DataFrame:
        """All stored cells of the current epoch; several versions of a cell may occur."""
        epoch = self.epoch(spark)
        base = read_if_exists(spark, f"{self.root}/base/epoch={epoch}", STORED_CELL)
        changes = read_if_exists(spark, f"{self.root}/changes/epoch={epoch}", STORED_CELL)
        columns = ("sink_table", "pk", "column", "value", "seq")
        return base.select(*columns).unionByName(changes.select(*columns))

    def table(self, spark: SparkSession, name: str, columns: Sequence[str]) -> DataFrame:
        """One dimension as of now. Only its own folders and cells are read."""
        return wide_rows(self.cells(spark).where(F.col("sink_table") == name), columns)

    def compact(self, spark: SparkSession) -> None:
        """Merge all cells into a new base. Must not run beside a writer of this store."""
        epoch = self.epoch(spark) + 1
        _write(merge_cells(self.cells(spark)), f"{self.root}/base/epoch={epoch}")
        finished = spark.range(1).select(F.lit(epoch).cast("bigint").alias("epoch"))
        finished.write.mode("append").parquet(f"{self.root}/epochs")


def _write(cells: DataFrame, path: str) -> None:
    """One folder per table, in files of a good size.

    Adaptive execution gathers the cells of small tables and splits those of large ones;
    without it they stay where they are, as gathering by table alone could fill one task.
    """
    if cells.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true":
        cells = cells.hint("rebalance", "sink_table")
    cells.write.mode("overwrite").partitionBy("sink_table").parquet(path)
