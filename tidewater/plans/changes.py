"""Change pipeline over bounded tables: parse, drop deletes, route by rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.operators.changes import drop_deletes, parse_envelopes
from tidewater.operators.rules import (
    bind_rules,
    current_rules,
    route_changes,
    route_changes_asof,
    rule_intervals,
    validate_rules,
)
from tidewater.schemas import DEAD_LETTER_TOPIC
from tidewater.sources.topics import without_repeats


def routed_changes(
    messages: DataFrame, rule_changes: DataFrame, asof: bool = False, honor_deletes: bool = False
) -> DataFrame:
    """Envelope texts routed by the latest rules, or by those in force at each ``seq``."""
    rules = validate_rules(bind_rules(rule_changes), honor_deletes=honor_deletes)
    changes = drop_deletes(parse_envelopes(messages))
    if asof:
        return route_changes_asof(changes, rule_intervals(rules, honor_deletes))
    return route_changes(changes, current_rules(rules, honor_deletes))


def change_outputs(routed: DataFrame) -> DataFrame:
    """Topic rows and dead letters of routed changes, with ``topic, value, reason``."""
    dead = F.col("reason").isNotNull()
    rows = routed.where(dead | (F.col("sink_type") == "topic"))
    topic = F.when(dead, DEAD_LETTER_TOPIC).otherwise(F.col("sink_table"))
    value = F.when(dead, F.col("value")).otherwise(F.to_json("payload"))
    return rows.withColumns({"topic": topic, "value": value})


def waiting_changes(letters: DataFrame) -> DataFrame:
    """Dead letters (rows of their topic) that only lacked a rule, as messages ``key, value``."""
    letter = F.from_json("value", "value string, reason string")
    rows = letters.withColumn("letter", letter).where("letter.reason = 'no_rule'")
    return rows.select("key", F.col("letter.value").alias("value"))


def replayed_changes(letters: DataFrame, rule_changes: DataFrame, honor_deletes: bool = False) -> DataFrame:
    """Dead letters without a rule, routed by the rules that have arrived since.

    Letters that still have none keep the reason. Each is told by its ``key``, the one the
    message had; repeats of an at-least-once topic are dropped first.
    """
    return routed_changes(waiting_changes(without_repeats(letters)), rule_changes, honor_deletes=honor_deletes)
