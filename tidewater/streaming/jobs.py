"""The streaming jobs. Each is one query with its own checkpoint."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import StructType

from tidewater.operators.changes import drop_deletes, envelope_text, parse_envelopes
from tidewater.operators.dims import dim_cells, dim_definitions
from tidewater.operators.logs import parse_logs, route_logs
from tidewater.operators.rules import (
    bind_rules,
    current_rules,
    dim_rows,
    dirty_rules,
    route_changes,
    validate_rules,
)
from tidewater.plans.changes import change_outputs
from tidewater.plans.logs import publishable
from tidewater.schemas import (
    DEAD_LETTER_TOPIC,
    DISPLAY_TOPIC,
    PAGE_TOPIC,
    RAW_CHANGE_TOPIC,
    START_TOPIC,
)
from tidewater.sinks.catalog import DEFAULT_BUCKETS, create_dim_tables, fill_dim_tables
from tidewater.sinks.dim_store import DimStore
from tidewater.sources.feeds import change_feed
from tidewater.sources.topics import ORDER_COLUMNS, Topics
from tidewater.streaming.lanes import connect_rules, connected_changes, rejected_rules, wanted_tables
from tidewater.streaming.visitors import repair_is_new_stream, state_settings

AVAILABLE_NOW = {"availableNow": True}


def checkpoint_id(spark: SparkSession, checkpoint: str) -> str:
    """The identity that a query got with its checkpoint and keeps over restarts."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first().value)["id"]


def start_log_job(
    messages: DataFrame,
    sink: Topics,
    checkpoint: str,
    order_by: Sequence[str] = ORDER_COLUMNS,
    trigger: Mapping = AVAILABLE_NOW,
    ttl_ms: int | None = None,
    state_partitions: int | None = None,
    known: DataFrame | None = None,
) -> StreamingQuery:
    """Raw logs to start, page, display and dead-letter topics.

    ``messages`` has ``value`` and the ``order_by`` columns. Counts per topic are
    observed under the name ``log_outputs``. ``state_partitions`` spreads the device
    state and cannot change once the checkpoint exists. With ``ttl_ms`` the query has
    no last batch, so it needs a trigger other than ``availableNow``. ``known`` devices were
    seen before the stream begins.
    """
    if ttl_ms and "availableNow" in trigger:
        raise ValueError("state that expires needs a trigger other than availableNow")
    # Other columns of a message would only travel through the state operator.
    messages = messages.select(*dict.fromkeys(["value", *order_by]))
    repaired = repair_is_new_stream(parse_logs(messages), order_by, ttl_ms, state_partitions, known)
    outputs = route_logs(repaired, keep=order_by)
    topics = (START_TOPIC, PAGE_TOPIC, DISPLAY_TOPIC, DEAD_LETTER_TOPIC)
    counts = [F.count_if(F.col("topic") == name).alias(name) for name in topics]
    rows = publishable(outputs.observe("log_outputs", *counts), order_by, "log_job")
    writer = sink.write_stream(rows)
    return _start(writer, checkpoint, trigger, messages.sparkSession, state_partitions)


def start_capture_job(
    messages: DataFrame,
    sink: Topics,
    checkpoint: str,
    order_by: Sequence[str] = ORDER_COLUMNS,
    trigger: Mapping = AVAILABLE_NOW,
    drop_nulls: bool = True,
    decode: bool = False,
) -> StreamingQuery:
    """Landed change records to envelopes in the raw change topic.

    ``decode`` is for connectors that encode decimals, dates and times by a schema block.
    """
    tombstones = F.count_if(F.col("value").isNull()).alias("tombstones")
    feed = change_feed(messages.observe("landed", tombstones), decode, drop_nulls=drop_nulls)
    dead = F.col("reason").isNotNull()
    feed = feed.withColumn("raw", F.col("value"))
    texts = envelope_text(feed).withColumns(
        {
            "topic": F.when(dead, DEAD_LETTER_TOPIC).otherwise(RAW_CHANGE_TOPIC),
            "value": F.when(dead, F.col("raw")).otherwise(F.col("value")),
        }
    )
    counts = [F.count("*").alias("changes"), F.count_if(dead).alias("dead")]
    rows = publishable(texts.observe("captured", *counts), order_by, "capture_job")
    return _start(sink.write_stream(rows), checkpoint, trigger, messages.sparkSession)


def start_change_job(
    messages: DataFrame,
    rule_changes: Callable[[SparkSession], DataFrame],
    sink: Topics,
    dims: DimStore,
    checkpoint: str,
    database: str | None = None,
    order_by: Sequence[str] = ORDER_COLUMNS,
    seq: str = "seq",
    trigger: Mapping = AVAILABLE_NOW,
    honor_deletes: bool = False,
    trim_columns: bool = False,
    types: Mapping[tuple[str, str], str] | None = None,
    compact_every: int | None = None,
    buckets: int = DEFAULT_BUCKETS,
) -> StreamingQuery:
    """Envelopes to one topic per fact table and one upserted table per dimension.

    ``rule_changes`` is called for every micro-batch, so rules added meanwhile apply
    before its rows are routed. ``seq`` orders the changes of a dimension key and is
    one of the columns of ``messages``; ``order_by`` identifies a message. With
    ``database`` the tables named by dimension rules are created in the catalog, with
    ``buckets`` buckets, and every batch rewrites the buckets it touches. ``types`` is passed
    to ``dim_cells``.

    Rejected rules, and tables that the catalog refuses, are dead letters of the batch that
    first meets them; after a restart they are written again under the same keys. Output
    lies under the identity of the checkpoint, so jobs may share a sink and a store.
    ``compact_every`` batches the store is compacted, which must have no other writer then.
    """
    parsed = parse_envelopes(messages)
    counts = [
        F.count("*").alias("changes"),
        F.count_if(F.col("type") == "delete").alias("deletes"),
        F.count_if(F.col("reason").isNotNull()).alias("bad"),
    ]
    parsed = drop_deletes(parsed.observe("changes", *counts))
    # A batch holds all columns of its stream, whether they are read or not.
    parsed = parsed.select(*dict.fromkeys([*order_by, seq, "value", "tableName", "type", "after", "reason"]))

    tables: set = set()
    state: dict = {"job": None, "reported": None}

    def rule_letters(rules: DataFrame, failures: list) -> DataFrame:
        bad = dirty_rules(rules, honor_deletes)
        if state["reported"] is not None:
            bad = bad.where(F.col("seq") > F.lit(state["reported"]))
        return letters_of_rules(bad, failures)

    def process(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        changes = rule_changes(spark)
        rules = validate_rules(bind_rules(changes), trim_columns, honor_deletes).persist(StorageLevel.MEMORY_AND_DISK)
        now = current_rules(rules, honor_deletes).persist(StorageLevel.MEMORY_AND_DISK)
        routed = route_changes(batch, now)
        # The text is needed for dead letters only; routed payloads leave the envelope behind.
        text = F.when(F.col("reason").isNotNull(), F.col("value")).alias("value")
        columns = dict.fromkeys([*order_by, seq])
        routed = routed.select(*columns, "sink_type", "sink_table", "pk", "payload", "reason", text)
        routed = routed.persist(StorageLevel.MEMORY_AND_DISK)
        state["job"] = state["job"] or checkpoint_id(spark, checkpoint)
        failures: list = []
        try:
            if database:
                create_dim_tables(spark, dim_definitions(rules), database, tables, failures, buckets)
            facts = publishable(change_outputs(routed), order_by, "change_job")
            sink.write_batch(facts.unionByName(rule_letters(rules, failures)), batch_id, state["job"])
            stored = dims.append(dim_cells(dim_rows(routed), seq, types), state["job"], batch_id)
            if database:
                fill_dim_tables(spark, database, stored)
            state["reported"] = rules.agg(F.max("seq").alias("seq")).first().seq
            if compact_every and (batch_id + 1) % compact_every == 0:
                dims.compact(spark)
        finally:
            for frame in (routed, now, rules):
                frame.unpersist()

    writer = parsed.writeStream.foreachBatch(process)
    return _start(writer, checkpoint, trigger, messages.sparkSession)


def letters_of_rules(bad: DataFrame, failures: Sequence[tuple[str, str]]) -> DataFrame:
    """Rejected rules, and tables that the catalog refused, as rows of the dead-letter topic."""
    key = F.concat_ws("/", F.lit("rule"), F.col("seq").cast("string"), "reason")
    letter = F.to_json(F.struct("value", "reason", "stage", "seq"))
    letters = bad.select(F.lit(DEAD_LETTER_TOPIC).alias("topic"), key.alias("key"), letter.alias("value"))
    for table, condition in failures:
        text = json.dumps({"value": table, "reason": condition, "stage": "create_dim_tables"})
        row = bad.sparkSession.range(1).select(
            F.lit(DEAD_LETTER_TOPIC).alias("topic"), F.lit(f"table/{table}").alias("key"), F.lit(text).alias("value")
        )
        letters = letters.unionByName(row)
    return letters


def start_connected_job(
    messages: DataFrame,
    rule_messages: DataFrame,
    sink: Topics,
    dims: DimStore,
    checkpoint: str,
    lanes: int,
    database: str | None = None,
    order_by: Sequence[str] = ORDER_COLUMNS,
    seq: str = "seq",
    trigger: Mapping = AVAILABLE_NOW,
    honor_deletes: bool = False,
    trim_columns: bool = False,
    wait_ms: int | None = None,
    types: Mapping[tuple[str, str], str] | None = None,
    buckets: int = DEFAULT_BUCKETS,
) -> StreamingQuery:
    """The change job with the rule topic as a second stream: see ``streaming.lanes``.

    A change takes the rule that was in force at its ``seq``. Rules are never read again:
    they live in the state of ``lanes`` lanes, a number that stays as long as the
    checkpoint. Bad records of the rule topic and rejected rules are dead letters, once.
    ``wait_ms`` lets changes wait for a rule of their key; the query has no last batch then.
    """
    if wait_ms and "availableNow" in trigger:
        raise ValueError("changes that wait need a trigger other than availableNow")
    spark = messages.sparkSession
    connected = connect_rules(messages, rule_messages, lanes, order_by, seq, honor_deletes, trim_columns, wait_ms)
    fields = StructType([messages.schema[name] for name in order_by])
    tables: set = set()
    state: dict = {"job": None}

    def process(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # The state store has one answer for a batch, so what it gave is kept for all sinks.
        # Counting fills it in all lanes at once; the tables below are fetched one lane after another.
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        batch.count()
        routed = connected_changes(batch, fields)
        text = F.when(F.col("reason").isNotNull(), F.col("value")).alias("value")
        columns = dict.fromkeys([*order_by, "seq"])
        routed = routed.select(*columns, "sink_type", "sink_table", "pk", "payload", "reason", text)
        routed = routed.persist(StorageLevel.MEMORY_AND_DISK)
        state["job"] = state["job"] or checkpoint_id(spark, checkpoint)
        failures: list = []
        try:
            if database:
                create_dim_tables(spark, wanted_tables(batch), database, tables, failures, buckets)
            facts = publishable(change_outputs(routed), order_by, "change_job")
            letters = letters_of_rules(rejected_rules(batch), failures)
            sink.write_batch(facts.unionByName(letters), batch_id, state["job"])
            stored = dims.append(dim_cells(dim_rows(routed), "seq", types), state["job"], batch_id)
            if database:
                fill_dim_tables(spark, database, stored)
        finally:
            routed.unpersist()
            batch.unpersist()

    return _start(connected.writeStream.foreachBatch(process), checkpoint, trigger, spark, lanes)


def rule_dead_letters(rule_changes: DataFrame, honor_deletes: bool = False) -> DataFrame:
    """Rules that were rejected, for the operator of the rule table."""
    return dirty_rules(validate_rules(bind_rules(rule_changes), honor_deletes=honor_deletes), honor_deletes)


def start_dim_job(
    rows: DataFrame,
    dims: DimStore,
    checkpoint: str,
    order_by: str = "seq",
    trigger: Mapping = AVAILABLE_NOW,
    compact_every: int | None = None,
) -> StreamingQuery:
    """Upsert a stream of dimension rows (``sink_table, pk, payload``) alone."""

    state: dict = {"job": None}

    def process(batch: DataFrame, batch_id: int) -> None:
        state["job"] = state["job"] or checkpoint_id(batch.sparkSession, checkpoint)
        dims.append(dim_cells(batch, order_by), state["job"], batch_id)
        if compact_every and (batch_id + 1) % compact_every == 0:
            dims.compact(batch.sparkSession)

    return _start(rows.writeStream.foreachBatch(process), checkpoint, trigger, rows.sparkSession)


def _start(
    writer: DataStreamWriter,
    checkpoint: str,
    trigger: Mapping,
    spark: SparkSession,
    state_partitions: int | None = None,
) -> StreamingQuery:
    with state_settings(spark, state_partitions):
        return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()
