"""Routing rules: bind, validate, keep the latest, and route changes by them."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions import jsonops as J
from tidewater.operators.changes import ENVELOPE_COLUMNS, envelope_text
from tidewater.operators.ordered import same_keys, with_order
from tidewater.operators.rulebook import RuleBook
from tidewater.schemas import (
    DEAD_LETTER_TOPIC,
    DEFAULT_PK,
    DEFAULT_TOPIC,
    DIM_SINKS,
    HIDDEN_COLUMNS,
    ROWS_SUFFIX,
    RULE_FIELDS,
    TOPIC_SINKS,
)
from tidewater.session import broadcast_if_small, computed_once, stored

RULE_KEY = ("source_table", "operate_type")
ROUTE_COLUMNS = ("sink_type", "sink_table", "pk", "payload", "reason")
RULE_BODY = ("sink_type", "sink_table", "columns", "sink_pk", "sink_extend")

# Intervals of a rule key that one lookup compares.
FANOUT = 16

# Rule changes that one task follows, unless one group has more.
FOLLOWED_ROWS = 50_000


def bind_rules(changes: DataFrame, order_by: str = "seq", keep: Sequence[str] = ()) -> DataFrame:
    """Rule-table changes as rule rows, whatever the case style of the field names.

    Also keeps what deletions need, the change type and the key in ``before``, and the
    columns in ``keep``.
    """
    bound = {name: J.field_ignoring_style(F.col("after"), name) for name in RULE_FIELDS}
    old = {f"old_{name}": J.field_ignoring_style(F.col("before"), name) for name in RULE_KEY}
    images = changes.select(
        "after", "before", F.col("type").alias("change_type"), F.col(order_by).alias("seq"), *keep
    )
    return J.with_computed(images, **bound, **old).drop("after", "before")


def sink_kind(sink_type: Column) -> Column:
    """``topic`` or ``dim``; other sink types are kept as they are."""
    return (
        F.when(sink_type.isin(*TOPIC_SINKS), "topic")
        .when(sink_type.isin(*DIM_SINKS), "dim")
        .otherwise(sink_type)
    )


def validate_rules(rules: DataFrame, trim_columns: bool = False, honor_deletes: bool = False) -> DataFrame:
    """Add ``columns`` and ``reason``; apply the defaults for key and topic.

    What :func:`checked_rules` finds in a rule by itself comes first. Rules of a dimension
    must also agree on its key and on the spelling of its columns: see
    :func:`reject_other_keys`. With ``honor_deletes`` only rules in force count for the key.
    """
    checked = checked_rules(rules, trim_columns)
    return keys_in_force(reject_other_keys(checked, keys=False)) if honor_deletes else reject_other_keys(checked)


def checked_rules(rules: DataFrame, trim_columns: bool = False) -> DataFrame:
    """Add ``columns`` and what is wrong with a rule by itself; apply the defaults for key and topic.

    Every rule needs the name of a table or topic that is not blank, has no slash and is not
    reserved. Dimension rules also need distinct column names and a key among them. Column
    names match verbatim unless ``trim_columns`` is set.
    """
    columns = J.split_columns(F.col("sink_columns"))
    if trim_columns:
        columns = F.transform(columns, lambda name: F.trim(name))
    kind = sink_kind(F.col("sink_type"))
    pk = F.when(kind == "dim", F.coalesce("sink_pk", F.lit(DEFAULT_PK))).otherwise(F.col("sink_pk"))
    table = F.when(kind == "topic", F.coalesce("sink_table", F.lit(DEFAULT_TOPIC)))
    filled = J.with_computed(
        rules,
        blank=F.coalesce(*RULE_FIELDS).isNull(),
        columns=columns,
        sink_type=kind,
        sink_pk=pk,
        sink_table=table.otherwise(F.col("sink_table")),
        sink_extend=F.coalesce("sink_extend", F.lit("")),
    )
    names = F.transform("columns", lambda name: F.lower(name))
    is_dim = F.col("sink_type").eqNullSafe("dim")
    reason = (
        F.when(F.col("blank"), "empty_rule")
        .when(F.col("columns").isNull(), "no_columns")
        .when(is_dim & (F.trim(F.coalesce("sink_table", F.lit(""))) == ""), "no_table")
        .when(is_dim & (F.col("sink_table").contains("/") | F.col("sink_table").endswith(ROWS_SUFFIX)), "bad_table")
        .when(F.col("sink_type").eqNullSafe("topic") & ~legal_topic(F.col("sink_table")), "bad_topic")
        .when(is_dim & F.array_contains("columns", F.lit("")), "empty_column")
        .when(is_dim & F.arrays_overlap(names, F.array(*map(F.lit, HIDDEN_COLUMNS))), "reserved_column")
        .when(is_dim & (F.size(F.array_distinct(names)) < F.size(names)), "duplicate_column")
        .when(is_dim & ~F.array_contains("columns", F.col("sink_pk")), "pk_not_in_columns")
    )
    return filled.withColumn("reason", reason).drop("blank")


def legal_topic(name: Column) -> Column:
    return (F.trim(name) != "") & ~name.contains("/") & (name != DEAD_LETTER_TOPIC)


def reject_other_keys(rules: DataFrame, keys: bool = True) -> DataFrame:
    """A dimension keeps the key, and the spelling of each column, of its first valid rule.

    Rules naming another key, or a column that differs by case only, are rejected. Of rules
    with the same ``seq`` the one with the least key or spelling counts as the first. Without
    ``keys`` only the spelling is compared.
    """
    is_dim = F.col("reason").isNull() & F.col("sink_type").eqNullSafe("dim")
    named = rules.where(is_dim).select("sink_table", "sink_pk", "seq", F.explode("columns").alias("name"))
    spelled = named.groupBy(F.col("sink_table").alias("keyed_table"), F.lower("name").alias("folded"))
    spelled = spelled.agg(F.min(F.struct("seq", "name")).alias("name"), F.min(F.struct("seq", "sink_pk")).alias("key"))
    tables = spelled.groupBy("keyed_table").agg(
        F.min("key")["sink_pk"].alias("table_pk"), F.collect_set("name.name").alias("table_columns")
    )
    joined = rules.join(tables, is_dim & (F.col("sink_table") == F.col("keyed_table")), "left")
    same_case = F.size(F.array_except("columns", "table_columns")) == 0
    other = F.when(F.lit(keys) & (F.col("sink_pk") != F.col("table_pk")), "other_pk").when(~same_case, "column_case")
    return joined.withColumn("reason", F.coalesce("reason", other)).drop(*tables.columns)


def keys_in_force(rules: DataFrame) -> DataFrame:
    """Reject rules that name another key than the rules of their dimension that are in force.

    A rule that was deleted or moved away no longer binds its table. Only tables for which
    valid rules name several keys can be concerned, so only the changes of their rule keys
    are followed, in the order of ``seq`` and one group per table; tables between which a
    change or a rule key moves form one group. A task holds one entry per rule key.
    """
    rules = stored(rules, "rules")
    named = rules.where(F.col("reason").isNull() & F.col("sink_type").eqNullSafe("dim"))
    several = named.groupBy("sink_table").agg(F.countDistinct("sink_pk").alias("n")).where("n > 1")
    owners = named.join(several, "sink_table", "left_semi").groupBy(*RULE_KEY)
    owners = stored(owners.agg(F.collect_set("sink_table").alias("tables")), "owners")
    if owners.isEmpty():
        return rules
    own = broadcast_if_small(owners.select(*[F.col(name).alias(f"k_{name}") for name in RULE_KEY], F.col("tables").alias("to")))
    old = own.withColumnsRenamed({**{f"k_{name}": f"o_{name}" for name in RULE_KEY}, "to": "from"})
    had = F.col("old_source_table").eqNullSafe(F.col("o_source_table"))
    had &= F.col("old_operate_type").eqNullSafe(F.col("o_operate_type"))
    joined = rules.join(own, same_keys(RULE_KEY, "k_"), "left").join(old, had, "left")
    none = F.array().cast("array<string>")
    tables = F.array_sort(F.array_union(F.coalesce("to", none), F.coalesce("from", none)))
    joined = stored(joined.select(*rules.columns, tables.alias("_tables")), "concerned")
    linked = joined.where(F.size("_tables") > 1).select(F.explode("_tables").alias("_linked")).distinct()
    first = F.try_element_at("_tables", F.lit(1))
    joined = joined.join(linked, first == F.col("_linked"), "left")
    group = F.when(F.col("_linked").isNull(), first).otherwise("")
    joined = joined.withColumn("_group", group).drop("_tables", "_linked")
    order = ["_group", "seq", *RULE_KEY, "sink_table", "sink_pk"]
    followed = joined.where("_group IS NOT NULL")
    # Following is slow for the bytes it reads, so the number of tasks comes from the rows.
    parts = max(rules.sparkSession.sparkContext.defaultParallelism, -(-followed.count() // FOLLOWED_ROWS))
    followed = followed.repartition(parts, "_group").sortWithinPartitions(*order)
    checked = followed.mapInPandas(_follow, joined.schema)
    return joined.where("_group IS NULL").unionByName(checked).drop("_group")


def _follow(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    group = book = None
    for batch in batches:
        reasons = []
        for event in batch.astype(object).where(batch.notna(), None).to_dict("records"):
            if book is None or event["_group"] != group:
                group, book = event["_group"], RuleBook(True, {}, {}, last_only=True)
            reasons.append(book.take(event))
        yield batch.assign(reason=reasons)


def dirty_rules(validated: DataFrame, honor_deletes: bool = False) -> DataFrame:
    """Dead letters of the rule feed: the rule as text, and the reason."""
    text = F.to_json(F.struct(*RULE_FIELDS))
    bad = validated.where("reason IS NOT NULL")
    if honor_deletes:
        bad = bad.where(~F.col("change_type").eqNullSafe("delete"))
    return bad.select(text.alias("value"), "reason", F.lit("validate_rules").alias("stage"), "seq")


def rule_events(validated: DataFrame, honor_deletes: bool = False) -> DataFrame:
    """What each rule change does to a key: set a rule, or remove it (``rule`` NULL).

    By default deletions do nothing and a rule that moves to another key stays
    active under the old one; ``honor_deletes`` removes it in both cases.
    """
    rule = F.struct(*RULE_BODY)
    valid = validated.where("reason IS NULL")
    sets = valid.select(*RULE_KEY, "seq", rule.alias("rule"))
    if not honor_deletes:
        return sets
    moved = ~F.col("source_table").eqNullSafe(F.col("old_source_table")) | ~F.col(
        "operate_type"
    ).eqNullSafe(F.col("old_operate_type"))
    has_old = F.coalesce("old_source_table", "old_operate_type").isNotNull()
    gone = F.col("change_type").eqNullSafe("delete") | (
        F.col("change_type").eqNullSafe("update") & moved & F.col("reason").isNull()
    )
    removals = validated.where(has_old & gone).select(
        F.col("old_source_table").alias("source_table"),
        F.col("old_operate_type").alias("operate_type"),
        "seq",
        F.lit(None).cast(sets.schema["rule"].dataType).alias("rule"),
    )
    return sets.unionByName(removals)


def current_rules(validated: DataFrame, honor_deletes: bool = False) -> DataFrame:
    """The rule in force per (source table, operate type): the last valid one written."""
    latest = rule_events(validated, honor_deletes).groupBy(*RULE_KEY)
    latest = latest.agg(F.max_by("rule", "seq").alias("rule"), F.max("seq").alias("seq"))
    return latest.where("rule IS NOT NULL").select(*RULE_KEY, "rule.*", "seq")


def rule_intervals(validated: DataFrame, honor_deletes: bool = False) -> DataFrame:
    """Every rule with the range of ``seq`` in which it was in force, and its ``position`` in its key."""
    spans = with_order(rule_events(validated, honor_deletes), RULE_KEY, "seq").where("rule IS NOT NULL")
    valid = {"valid_from": F.col("seq"), "valid_to": F.col("following")}
    return spans.select(*RULE_KEY, "rule.*", *[column.alias(name) for name, column in valid.items()], "position")


def route_changes(changes: DataFrame, rules: DataFrame) -> DataFrame:
    """Attach the current rule to each change and keep only the columns it names.

    Adds ``sink_type, sink_table, pk, payload`` and ``reason``. The rule side is computed
    once and broadcast when small, so the changes are not shuffled. A change without a rule,
    with an unknown sink type or without a key for its dimension is a dead letter,
    and so is one that already carries a ``reason``.
    """
    side = broadcast_if_small(computed_once(rules, "rules").select(*RULE_KEY, *RULE_BODY))
    return routed_by(_carried(changes).join(side, _of_rule(), "left"), changes.columns)


def route_changes_asof(changes: DataFrame, intervals: DataFrame, order_by: str = "seq", fanout: int = FANOUT) -> DataFrame:
    """As :func:`route_changes`, with the rule that was in force at each change's ``seq``.

    The intervals of a rule key are looked up in steps. They are grouped by ``fanout`` in
    their order, the groups again, and so on until a key has one group; a change joins the
    group it belongs to from the top down and picks one of its entries. So no change is
    compared with more than ``fanout`` entries a step, however long the history of its key is,
    and the steps grow with the logarithm of the longest history. Every step is broadcast
    when it measures small; otherwise (key, group) is the join key, which spreads one rule
    key with many changes over its groups.
    """
    body = F.struct(*RULE_BODY).alias("rule")
    if "position" not in intervals.columns:
        intervals = with_order(intervals, RULE_KEY, "valid_from")
    entries = intervals.select(*RULE_KEY, "valid_from", "valid_to", body, "position")
    levels = [stored(_groups(entries, fanout), "intervals")]
    while levels[-1].agg(F.max("node").alias("node")).first()["node"]:
        upper = levels[-1].select(*RULE_KEY, F.col("entries")[0]["valid_from"].alias("valid_from"), F.col("node").alias("position"))
        levels.append(stored(_groups(upper, fanout), "intervals"))
    at = F.col(order_by)
    found = _carried(changes).withColumn("_node", F.lit(0).cast("bigint"))
    for level in reversed(levels):
        found = found.join(broadcast_if_small(level), _of_rule() & (F.col("_node") == F.col("node")), "left")
        last = F.try_element_at(F.filter("entries", lambda entry: entry["valid_from"] <= at), F.lit(-1))
        found = found.withColumn("_entry", last).drop(*RULE_KEY, "node", "entries")
        if level is not levels[0]:
            found = found.withColumn("_node", F.col("_entry.position")).drop("_entry")
    in_force = F.col("_entry.valid_to").isNull() | (at < F.col("_entry.valid_to"))
    found = found.select("*", F.when(in_force, F.col("_entry.rule")).alias("_rule")).select("*", "_rule.*")
    return routed_by(found, changes.columns)


def _groups(entries: DataFrame, fanout: int) -> DataFrame:
    """Entries of a key in groups ``node`` of up to ``fanout``, in the order of ``valid_from``."""
    node = F.floor(F.col("position") / fanout).alias("node")
    fields = [name for name in entries.columns if name not in (*RULE_KEY, "position")]
    ordered = F.struct("valid_from", "position", *[name for name in fields if name != "valid_from"])
    return entries.groupBy(*RULE_KEY, node).agg(F.array_sort(F.collect_list(ordered)).alias("entries"))


def _of_rule() -> Column:
    return F.col("tableName").eqNullSafe(F.col("source_table")) & F.col("type").eqNullSafe(F.col("operate_type"))


def _carried(changes: DataFrame) -> DataFrame:
    earlier = F.col("reason") if "reason" in changes.columns else F.lit(None).cast("string")
    return changes.select(*[name for name in changes.columns if name != "reason"], earlier.alias("earlier"))


def routed_by(joined: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Changes beside their rule (or NULL) with their sink, key, kept columns and reason.

    ``earlier`` is the reason a change already had; ``columns`` of it are carried on.
    """
    carried = [name for name in columns if name != "reason"]
    payload = J.keep_keys(F.col("after"), F.coalesce("columns", F.array().cast("array<string>")))
    is_dim = F.col("sink_type").eqNullSafe("dim")
    pk = F.when(is_dim, J.path_string(F.try_element_at("after", F.col("sink_pk"))))
    known = F.col("sink_type").isin("topic", "dim")
    reason = (
        F.when(F.col("earlier").isNotNull(), F.col("earlier"))
        .when(F.col("columns").isNull(), "no_rule")
        .when(~F.coalesce(known, F.lit(False)), "unknown_sink_type")
        .when(is_dim & pk.isNull(), "null_pk")
    )
    return joined.select(
        *carried,
        "sink_type",
        "sink_table",
        pk.alias("pk"),
        payload.alias("payload"),
        reason.alias("reason"),
    )


def topic_rows(routed: DataFrame) -> DataFrame:
    """Changes for topics: the kept columns as text, published under the rule's table name."""
    rows = routed.where("reason IS NULL AND sink_type = 'topic'")
    published = {"topic": F.col("sink_table"), "value": F.to_json("payload")}
    return rows.withColumns(published).drop(*ENVELOPE_COLUMNS, *ROUTE_COLUMNS)


def dim_rows(routed: DataFrame) -> DataFrame:
    """Changes for dimension tables: ``sink_table, pk, payload`` and the order columns."""
    rows = routed.where("reason IS NULL AND sink_type = 'dim'")
    return rows.drop(*ENVELOPE_COLUMNS, "sink_type", "reason", "value")


def unrouted_changes(routed: DataFrame) -> DataFrame:
    """Dead letters of routing: the text that was read, or the envelope, with the reason."""
    bad = routed.where("reason IS NOT NULL")
    if "value" not in routed.columns:
        bad = envelope_text(bad)
    stage = F.when(F.col("reason") == "bad_envelope", "parse_envelopes").otherwise("route_changes")
    dropped = [name for name in (*ENVELOPE_COLUMNS, *ROUTE_COLUMNS) if name != "reason"]
    return bad.withColumn("stage", stage).drop(*dropped)
