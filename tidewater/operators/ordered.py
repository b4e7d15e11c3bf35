"""Order within keys, where one key may hold a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewater.session import stored

# Rows that one window may sort, whatever their keys are.
WINDOW_ROWS = 1_000_000


def same_keys(keys: Sequence[str], prefix: str) -> Column:
    """Null-safe equality of ``keys`` with the columns of that prefix."""
    condition = F.lit(True)
    for name in keys:
        condition &= F.col(name).eqNullSafe(F.col(prefix + name))
    return condition


def with_order(rows: DataFrame, keys: Sequence[str], order: str, window_rows: int = WINDOW_ROWS) -> DataFrame:
    """Add ``position`` of a row within its key, from 0, and ``following``, the next row's ``order``.

    Rows with equal ``order`` follow each other by their other columns. The rows are written
    once. More of them than a window may sort are dealt to ranges of (key, order), so that a
    key spreads over as many ranges as it fills. Each range is sorted alone, and what a key
    has in earlier ranges, and where it goes on, is carried over: two short rows a range.
    """
    ties = [name for name in rows.columns if name not in (*keys, order)]
    table = stored(rows, "ordered")
    parts = -(-table.count() // window_rows)
    if parts <= 1:
        along = Window.partitionBy(*keys).orderBy(order, *ties)
        return table.withColumns({"position": F.row_number().over(along) - 1, "following": F.lead(order).over(along)})
    ranged = table.repartitionByRange(parts, *keys, order, *ties)
    table = stored(ranged.withColumn("_part", F.spark_partition_id()), "ranges")
    along = Window.partitionBy("_part", *keys).orderBy(order, *ties)
    local = table.withColumns({"position": F.row_number().over(along) - 1, "following": F.lead(order).over(along)})
    pieces = table.groupBy("_part", *keys).agg(F.count("*").alias("rows"), F.min(order).alias("first"))
    across = Window.partitionBy(*keys).orderBy("_part")
    earlier = F.sum("rows").over(across.rowsBetween(Window.unboundedPreceding, -1))
    carried = pieces.select(
        F.col("_part").alias("c_part"), *[F.col(name).alias(f"c_{name}") for name in keys],
        F.coalesce(earlier, F.lit(0)).alias("earlier"), F.lead("first").over(across).alias("onward"),
    )
    # Only the first and the last key of a range go beyond it.
    carried = F.broadcast(carried.where("earlier > 0 OR onward IS NOT NULL"))
    joined = local.join(carried, (F.col("_part") == F.col("c_part")) & same_keys(keys, "c_"), "left")
    return joined.select(
        *rows.columns,
        (F.col("position") + F.coalesce("earlier", F.lit(0))).alias("position"),
        F.coalesce("following", "onward").alias("following"),
    )
