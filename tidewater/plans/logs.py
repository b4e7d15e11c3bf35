"""Log pipeline over a bounded table: parse, repair, route."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.operators.logs import parse_logs, repair_is_new, route_logs
from tidewater.schemas import DEAD_LETTER_TOPIC


def log_outputs(messages: DataFrame, order_by: Sequence[str] = ("seq",)) -> DataFrame:
    """Everything the log job publishes for ``messages`` (``value`` and order columns)."""
    repaired = repair_is_new(parse_logs(messages), order_by)
    return route_logs(repaired, keep=order_by)


def publishable(outputs: DataFrame, order_by: Sequence[str], stage: str) -> DataFrame:
    """Outputs as ``topic, key, value``.

    The key names the source message and the branch, so a reader can drop repeats.
    A dead letter carries its text, reason and stage as one JSON text.
    """
    branch = ["branch"] if "branch" in outputs.columns else []
    letter = F.to_json(F.struct("value", "reason", F.lit(stage).alias("stage"), *order_by))
    is_dead = F.col("topic") == DEAD_LETTER_TOPIC
    return outputs.select(
        "topic",
        F.concat_ws("/", *[F.col(name).cast("string") for name in (*order_by, *branch)]).alias("key"),
        F.when(is_dead, letter).otherwise(F.col("value")).alias("value"),
    )
