"""Dimension tables: all-string columns, one key, upsert that touches only listed columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions import jsonops as J

CELL_KEY = ("sink_table", "pk", "column")

# Set apart from any column a rule could name.
ROW_KEY = "row key"


def dim_cells(
    rows: DataFrame, order_by: str = "seq", types: Mapping[tuple[str, str], str] | None = None
) -> DataFrame:
    """One row per column that a change carries: ``sink_table, pk, column, value, seq``.

    A column absent from the change has no cell; an explicit null is a cell with a
    NULL value. Numbers print without zeros at the end unless ``types`` gives a type
    such as ``decimal(10,2)`` for (table, column). The rows are dealt out first, a hot key too:
    merging sorts the cells of a task, which are many times the bytes of a file that one task reads.
    """
    if rows.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true":
        rows = rows.hint("rebalance", "sink_table", "pk", order_by)
    cells = rows.select(
        "sink_table", "pk", F.col(order_by).alias("seq"), F.explode("payload").alias("column", "leaf")
    )
    value = J.path_string(F.col("leaf"))
    for (table, column), kind in (types or {}).items():
        typed = F.try_variant_get("leaf", "$", kind).cast("string")
        chosen = (F.col("sink_table") == table) & (F.col("column") == column)
        value = F.when(chosen, F.coalesce(typed, J.path_string(F.col("leaf")))).otherwise(value)
    return cells.select(*CELL_KEY, value.alias("value"), "seq")


def merge_cells(cells: DataFrame) -> DataFrame:
    """The latest cell per key and column, for any number of tables in one job.

    Merging is idempotent and free of order, so replays and compactions are safe.
    The aggregation is partial before the shuffle: a key that changes all the time
    sends at most one cell per column and task.
    """
    latest = F.max_by("value", "seq").alias("value")
    return cells.groupBy(*CELL_KEY).agg(latest, F.max("seq").alias("seq"))


def wide_rows(cells: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Cells of one dimension as its table: one row per key, the latest value per column."""
    # Cells of other columns have no order here, and rows without one are passed over.
    values = [
        F.max_by("value", F.when(F.col("column") == name, F.col("seq"))).alias(name)
        for name in columns
    ]
    wanted = cells.where(F.col("column").isin(*columns))
    return wanted.groupBy(F.col("pk").alias(ROW_KEY)).agg(*values).select(*[F.col(f"`{name}`") for name in columns])


def merge_dim(rows: DataFrame, columns: Sequence[str], order_by: str = "seq") -> DataFrame:
    """Upsert the changes of one dimension in a single aggregation."""
    return wide_rows(dim_cells(rows, order_by), columns)


def dim_definitions(validated: DataFrame) -> DataFrame:
    """Tables that the valid dimension rules ask for: ``sink_table, sink_pk, columns, sink_extend``.

    The first rule of a table names its key and options. Later rules may add
    columns, which follow in the order of their first mention.
    """
    rules = validated.where("reason IS NULL AND sink_type = 'dim'")
    named = rules.select(
        "sink_table", "sink_pk", "sink_extend", "seq", F.posexplode("columns").alias("position", "column")
    )
    # One row per column first, so the list gathered per table is only as long as the table is wide.
    mentions = named.groupBy("sink_table", "column").agg(
        F.min(F.struct("seq", "position", "sink_pk", "sink_extend")).alias("first")
    )
    tables = mentions.groupBy("sink_table").agg(
        F.min("first").alias("first"),
        F.array_sort(F.collect_list(F.struct("first", "column"))).alias("ordered"),
    )
    columns = F.transform("ordered", lambda item: item["column"])
    return tables.select("sink_table", "first.sink_pk", columns.alias("columns"), "first.sink_extend")
