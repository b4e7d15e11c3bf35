"""Every operator as a query over the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidewater.functions import jsonops as J
from tidewater.operators import changes as C
from tidewater.operators import dims as D
from tidewater.operators import logs as L
from tidewater.operators import rules as U
from tidewater.plans.changes import change_outputs, replayed_changes, routed_changes
from tidewater.plans.logs import log_outputs, publishable
from tidewater.schemas import RAW_CHANGE_TOPIC, RAW_LOG_TOPIC
from tidewater.session import session_conf, shared_dir, stored
from tidewater.sinks.catalog import create_dim_tables, fill_dim_tables
from tidewater.sources.feeds import change_feed, rule_feed, rule_feed_letters, snapshot_with_changes
from tidewater.sources.growinglogs import stream_growing_logs
from tidewater.sources.logfiles import LINE_ORDER, read_log_files, stream_log_files
from tidewater.sources.topics import FileTopics, without_repeats_within
from tidewater.streaming import jobs
from tidewater.streaming.lanes import connect_rules, connected_changes, lanes_for
from tidewater.streaming.visitors import known_devices, state_settings
from verification import recipes as R

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(function: Query) -> Query:
    REGISTRY[function.__name__] = function
    return function


def field(path: str, name: str, kind: str = "string"):
    """A value inside the published text, so that results do not depend on key order."""
    return F.try_variant_get(F.parse_json("value"), path, kind).alias(name)


def log_fields(outputs: DataFrame) -> DataFrame:
    """Whole-record outputs by their content."""
    return outputs.select(
        "seq",
        field("$.common.mid", "mid"),
        field("$.common.is_new", "is_new"),
        field("$.start.entry", "entry"),
        field("$.page.page_id", "page_id"),
        field("$.props.k", "k", "bigint"),
        F.coalesce(F.size(J.as_array(F.parse_json("value"), "$.displays")), F.lit(-1)).alias("n_displays"),
    )


# ---- logs -------------------------------------------------------------------------------


@query
def log_valid(spark, sf):
    """Records that parse, with the fields the job reads."""
    return L.good_logs(L.parse_logs(R.log_text(spark, sf))).select("seq", "mid", "is_new")


@query
def log_dirty(spark, sf):
    """The original text and the reason of records that do not parse."""
    return L.dirty_logs(L.parse_logs(R.log_text(spark, sf))).select("seq", "value", "reason", "stage")


@query
def is_new_batch(spark, sf):
    """K1, K2 over a bounded table."""
    parsed = L.good_logs(L.parse_logs(R.log_text(spark, sf)))
    return L.repair_is_new(parsed).select("seq", "mid", "is_new", "repaired")


@query
def route_start(spark, sf):
    """R1, J2, J4, J6."""
    return log_fields(log_outputs(R.log_text(spark, sf)).where("topic = 'dwd_start_log'"))


@query
def route_page(spark, sf):
    """R2."""
    return log_fields(log_outputs(R.log_text(spark, sf)).where("topic = 'dwd_page_log'"))


@query
def route_display(spark, sf):
    """R3, J3, J5."""
    shown = log_outputs(R.log_text(spark, sf)).where("topic = 'dwd_display_log'")
    has_common = J.has_path(F.parse_json("value"), "$.common").alias("has_common")
    return shown.select("seq", field("$.item", "item", "int"), field("$.page_id", "page_id"), has_common)


@query
def topic_counts(spark, sf):
    """Rows per output topic."""
    return log_outputs(R.log_text(spark, sf)).groupBy("topic").agg(F.count("*").alias("n"))


@query
def log_topic_sink(spark, sf):
    """All log outputs written to file-backed topics and read back, by counts and a sum over their values."""
    topics = FileTopics(shared_dir(spark, "log_topics"))
    topics.write_batch(publishable(log_outputs(R.log_text(spark, sf)), ("seq",), "log_job"), 0)
    return log_totals(topics.read(spark, ".*", pattern=True))


def log_totals(rows: DataFrame) -> DataFrame:
    """Rows, keys and a sum over the values of every log topic."""
    rows, record = J.with_computed(rows.select("topic", "key", "value"), record=F.parse_json("value")), F.col("record")
    number = lambda path: F.coalesce(F.try_variant_get(record, path, "bigint"), F.lit(0))
    value = (
        F.when(F.col("topic") == "dead_letter", number("$.seq"))
        .when(F.col("topic") == "dwd_display_log", number("$.item"))
        .otherwise(number("$.props.k") + 1000 * number("$.common.is_new"))
    )
    keys = F.countDistinct("key").alias("keys")
    return rows.groupBy("topic").agg(F.count("*").alias("n"), keys, F.sum(value).alias("total"))


@query
def topic_dedup_stream(spark, sf):
    """A topic that holds one batch twice, read as a stream without the repeats."""
    root = shared_dir(spark, "topic_dedup")
    topics = FileTopics(f"{root}/topics")
    # Both batches hold the same rows, which are computed once.
    out = stored(publishable(log_outputs(R.log_text(spark, sf)), ("seq",), "log_job"), "topic_dedup")
    topics.write_batch(out, 0, "first")
    topics.write_batch(out, 0, "repeated")
    rows = without_repeats_within(topics.stream(spark, ".*", pattern=True)).select("topic", "key", "value")
    writer = rows.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/checkpoint")
    finished(writer.trigger(availableNow=True).start())
    return log_totals(spark.read.parquet(f"{root}/out"))


@query
def json_functions(spark, sf):
    """J1, J2, J4, J5, J10, J11 as columns over every parsed record."""
    rec = F.col("rec")
    parsed = L.good_logs(L.parse_logs(R.log_text(spark, sf)))
    top = J.as_object(rec)
    renamed = F.to_variant_object(J.set_field(top, "page", J.to_variant(F.lit("p"))))
    return parsed.select(
        "seq",
        J.path_string(rec, "$.common.mid").alias("mid"),
        J.path_string(rec, "$.page.page_id").alias("page_id"),
        J.nonempty(J.as_object(rec, "$.start")).alias("start_nonempty"),
        J.nonempty(J.as_array(rec, "$.displays")).alias("displays_nonempty"),
        J.has_path(rec, "$.displays").alias("has_displays"),
        F.map_contains_key(top, "start").alias("has_start_key"),
        F.coalesce(J.path_string(rec, "$.start.entry"), F.lit("none")).alias("entry"),
        J.path_string(renamed, "$.page").alias("new_page"),
        J.path_string(renamed, "$.props.k").alias("k"),
    )


@query
def text_functions(spark, sf):
    """J7, J8, J9 on part names: split, lower-case, key pairs and name lists."""
    parts = R.table(spark, sf, "part")
    names = J.split_columns(F.concat_ws(",", F.lower("p_type"), F.replace("p_name", F.lit(" "), F.lit(",")), F.lit("")))
    key = F.struct(F.lower("p_brand"), F.lower("p_type"))
    return parts.select(
        "p_partkey",
        F.size(names).alias("n_names"),
        F.element_at(names, 1).alias("first_name"),
        F.element_at(names, -1).alias("last_name"),
        F.array_contains(names, "bolt").alias("has_bolt"),
        key["col1"].alias("brand"),
        key["col2"].alias("kind"),
    )


def write_daily_files(spark: SparkSession, sf: str, root: str) -> None:
    """Log texts as rolled daily files below numbered folders, all in the order of ``seq``."""
    lines = R.log_text(spark, sf, F.date_format("ts", "yyyy-MM-dd").alias("day"))
    ordered = lines.repartitionByRange("day", "seq").sortWithinPartitions("day", "seq")
    ordered.select("day", "value").write.partitionBy("day").text(f"{root}/lines")
    rename_rolled(spark, f"{root}/lines", f"{root}/logs")


def rename_rolled(spark: SparkSession, folder: str, target: str) -> None:
    """Give each file the name a rolled log would have."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(folder).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    for status in fs.globStatus(hadoop.Path(f"{folder}/day=*/part-*")):
        day = status.getPath().getParent().getName().split("=")[1]
        part = status.getPath().getName().split("-")[1]
        fs.mkdirs(hadoop.Path(f"{target}/{part}"))
        fs.rename(status.getPath(), hadoop.Path(f"{target}/{part}/app.{day}.log"))


@query
def log_files(spark, sf):
    """Lines per daily file, with the day from the file name and the line order."""
    root = shared_dir(spark, "log_files")
    write_daily_files(spark, sf, root)
    lines = read_log_files(spark, f"{root}/logs")
    parsed = L.parse_logs(lines)
    return parsed.groupBy("day").agg(
        F.count("*").alias("n_lines"),
        F.count_if(F.col("reason").isNull()).alias("n_good"),
        F.max_by("mid", F.struct(*LINE_ORDER)).alias("last_mid"),
    )


@query
def log_files_is_new(spark, sf):
    """Repair in line order, with no order column in the text."""
    root = shared_dir(spark, "log_files")
    write_daily_files(spark, sf, root)
    parsed = L.good_logs(L.parse_logs(read_log_files(spark, f"{root}/logs")))
    fixed = L.repair_is_new(parsed, LINE_ORDER)
    return fixed.groupBy("mid").agg(
        F.count_if(F.col("is_new") == "1").alias("n_new"),
        F.count_if("repaired").alias("n_repaired"),
        F.min(F.when(F.col("is_new") == "1", F.col("day"))).alias("first_day"),
    )


# ---- logs as streams --------------------------------------------------------------------


def finished(query) -> None:
    query.awaitTermination()


def run_log_job(spark: SparkSession, sf: str) -> DataFrame:
    root = shared_dir(spark, "log_job")
    source = R.stage_logs(spark, sf, root)
    sink = FileTopics(f"{root}/out")
    messages = R.with_seq(source.stream(spark, RAW_LOG_TOPIC))
    partitions = spark.sparkContext.defaultParallelism
    finished(jobs.start_log_job(messages, sink, f"{root}/checkpoint", ("seq",), state_partitions=partitions))
    return sink.read(spark, ".*", pattern=True)


@query
def is_new_stream(spark, sf):
    """K1, K2, K2a with keyed state: flags of all published whole records."""
    rows = run_log_job(spark, sf).where("topic in ('dwd_start_log', 'dwd_page_log')")
    seq = F.split("key", "/")[0].cast("bigint").alias("seq")
    return rows.select("topic", seq, field("$.common.mid", "mid"), field("$.common.is_new", "is_new"))


@query
def log_job_stream(spark, sf):
    """The log job end to end: rows, distinct keys and a sum over the values per topic."""
    return log_totals(run_log_job(spark, sf))


@query
def is_new_backfilled_stream(spark, sf):
    """Older logs in a batch, later ones in a stream that begins with the devices of the batch."""
    root = shared_dir(spark, "backfill")
    source = R.stage_logs(spark, sf, root)
    half = R.table(spark, sf, "events").agg(F.floor(F.max("event_id") / 2).cast("bigint").alias("seq")).first().seq
    older = R.log_text(spark, sf).where(F.col("seq") <= F.lit(half))
    sink = FileTopics(f"{root}/out")
    messages = R.with_seq(source.stream(spark, RAW_LOG_TOPIC)).where(F.col("seq") > F.lit(half))
    known = known_devices(L.good_logs(L.parse_logs(older)))
    partitions = spark.sparkContext.defaultParallelism
    finished(
        jobs.start_log_job(messages, sink, f"{root}/checkpoint", ("seq",), state_partitions=partitions, known=known)
    )
    later = sink.read(spark, "dwd_start_log,dwd_page_log").select("topic", "key", "value")
    rows = publishable(log_outputs(older), ("seq",), "log_job").where("topic in ('dwd_start_log', 'dwd_page_log')").unionByName(later)
    seq = F.split("key", "/")[0].cast("bigint").alias("seq")
    return rows.select("topic", seq, field("$.common.mid", "mid"), field("$.common.is_new", "is_new"))


@query
def log_files_growing(spark, sf):
    """The open logs of three collectors as they grow, are rolled and begin anew, each line once."""
    root = shared_dir(spark, "log_files_growing")
    for step in R.GROWTH:
        R.write_growing_logs(spark, sf, f"{root}/logs", step)
        parsed = L.parse_logs(stream_growing_logs(spark, f"{root}/logs", 1 << 16)).select("mid", "is_new", "reason", "file", "position")
        writer = parsed.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/checkpoint")
        finished(writer.trigger(availableNow=True).start())
    rows = spark.read.parquet(f"{root}/out")
    return rows.groupBy("mid", "is_new", "reason").agg(F.count("*").alias("n"))


@query
def log_files_stream(spark, sf):
    """S4 as a stream: the log job over daily files, in line order."""
    root = shared_dir(spark, "log_files_stream")
    write_daily_files(spark, sf, root)
    sink = FileTopics(f"{root}/out")
    messages = stream_log_files(spark, f"{root}/logs")
    partitions = spark.sparkContext.defaultParallelism
    finished(jobs.start_log_job(messages, sink, f"{root}/checkpoint", LINE_ORDER, state_partitions=partitions))
    rows = sink.read(spark, "dwd_start_log,dwd_page_log")
    return rows.groupBy("topic", field("$.common.mid", "mid")).agg(
        F.count("*").alias("n"),
        F.count_if(F.try_variant_get(F.parse_json("value"), "$.common.is_new", "string") == "1").alias("n_new"),
    )


# ---- changes ----------------------------------------------------------------------------


def customer_envelopes(spark: SparkSession, sf: str, **options) -> DataFrame:
    return change_feed(R.raw_changes(spark, sf, "customer", "c_custkey"), **options)


@query
def cdc_normalize(spark, sf):
    """N1 (N1a-N1d): envelope columns of every customer change."""
    changes = customer_envelopes(spark, sf)
    after = F.col("after")
    return changes.select(
        "seq",
        "database",
        "tableName",
        "type",
        F.size("before").alias("n_before"),
        F.size("after").alias("n_after"),
        J.path_string(after["c_name"]).alias("c_name"),
        F.try_variant_get(after["c_acctbal"], "$", "double").alias("c_acctbal"),
        J.path_string(F.col("before")["c_mktsegment"]).alias("old_segment"),
    )


@query
def cdc_snapshot_as_insert(spark, sf):
    """Snapshot rows renamed for backfills."""
    changes = customer_envelopes(spark, sf, snapshot_as_insert=True)
    return changes.groupBy("type").agg(F.count("*").alias("n"))


@query
def cdc_envelope_text(spark, sf):
    """N1e, J6, P1: envelopes written as text and parsed again, strictly."""
    texts = C.envelope_text(customer_envelopes(spark, sf)).select("seq", "value")
    parsed = C.parse_envelopes(texts, strict=True)
    return parsed.select(
        "seq",
        "database",
        "tableName",
        "type",
        F.size("before").alias("n_before"),
        F.size("after").alias("n_after"),
        J.path_string(F.col("after")["c_name"]).alias("c_name"),
    )


@query
def cdc_null_columns(spark, sf):
    """N1e, D3: null columns vanish by default and can be kept."""
    rows = R.customer_dim_rows(spark, sf)
    kept = F.size("payload").alias("n_kept")
    return rows.select("seq", kept, F.size(J.drop_null_entries(F.col("payload"))).alias("n_dropped"))


@query
def cdc_drop_deletes(spark, sf):
    """F1."""
    return C.drop_deletes(customer_envelopes(spark, sf)).select("seq", "type")


@query
def cdc_dirty(spark, sf):
    """Texts of all logs read as envelopes; broken ones are dead letters."""
    bad = C.dirty_changes(C.parse_envelopes(R.log_text(spark, sf)), "parse_envelopes")
    return bad.select("seq", "value", "reason", "stage")


@query
def change_feed_kafka_shape(spark, sf):
    """Landed changes of all tables, by topic name, database, table and type."""
    root = shared_dir(spark, "change_feed")
    topics = FileTopics(root)
    raw = R.shop_changes(spark, sf)
    topics.write_batch(raw.withColumn("key", F.col("seq").cast("string")).drop("seq"), 0)
    feed = change_feed(topics.read(spark, r"srv\.shop\..*", pattern=True))
    return feed.groupBy("database", "tableName", "type").agg(F.count("*").alias("n"))


@query
def capture_job_stream(spark, sf):
    """The capture job end to end: landed changes to envelopes in the raw change topic."""
    root = shared_dir(spark, "capture_job")
    source, sink = FileTopics(f"{root}/landed"), FileTopics(f"{root}/out")
    raw = R.raw_changes(spark, sf, "customer", "c_custkey")
    source.write_batch(raw.withColumn("key", F.col("seq").cast("string")).drop("seq"), 0)
    messages = R.with_seq(source.stream(spark, r"srv\.shop\..*", pattern=True))
    finished(jobs.start_capture_job(messages, sink, f"{root}/checkpoint", ("seq",)))
    parsed = C.parse_envelopes(sink.read(spark, RAW_CHANGE_TOPIC))
    return parsed.select(
        F.col("key").cast("bigint").alias("seq"),
        "database",
        "tableName",
        "type",
        J.path_string(F.col("after")["c_name"]).alias("c_name"),
    )


# ---- rules ------------------------------------------------------------------------------


def part_rules(spark: SparkSession, sf: str, **options) -> DataFrame:
    return U.validate_rules(U.bind_rules(R.part_rule_changes(spark, sf)), **options)


RULE_TEXT = ("source_table", "operate_type", "sink_type", "sink_table")


@query
def rules_bind(spark, sf):
    """Rule fields, whatever the case style of their names."""
    bound = U.bind_rules(R.part_rule_changes(spark, sf))
    return bound.select("seq", *RULE_TEXT, "sink_columns", "sink_pk", "sink_extend", "change_type")


@query
def rules_validate(spark, sf):
    """Sink kind, defaults and the reason of every rejected rule."""
    return part_rules(spark, sf).select("seq", "sink_type", "sink_pk", "sink_extend", "reason")


@query
def rules_trim_columns(spark, sf):
    """The same with column names trimmed."""
    rules = part_rules(spark, sf, trim_columns=True)
    return rules.select("seq", F.array_contains("columns", "p_name").alias("has_name"), "reason")


@query
def rules_current(spark, sf):
    """The last valid rule per key; deletions change nothing."""
    now = U.current_rules(part_rules(spark, sf))
    return now.select(*RULE_TEXT, F.array_join("columns", ",").alias("sink_columns"), "seq")


@query
def rules_current_deletes(spark, sf):
    """B1a, D5 with deletions and moved keys honoured."""
    now = U.current_rules(part_rules(spark, sf), honor_deletes=True)
    return now.select(*RULE_TEXT, F.array_join("columns", ",").alias("sink_columns"), "seq")


@query
def rules_dead(spark, sf):
    """Rejected rules as dead letters."""
    dead = U.dirty_rules(part_rules(spark, sf))
    return dead.select("seq", "reason", "stage", field("$.source_table", "source_table"))


@query
def rules_key_after_delete(spark, sf):
    """A rule may name another key for a table once the rules that bound it are deleted."""
    rules = U.validate_rules(U.bind_rules(R.rules_of_deleted_keys(spark, sf)), honor_deletes=True)
    now = U.current_rules(rules, honor_deletes=True).select(F.col("seq").alias("now_seq"))
    joined = rules.join(now, F.col("seq") == F.col("now_seq"), "left")
    return joined.select("seq", "change_type", "sink_pk", "reason", F.col("now_seq").isNotNull().alias("in_force"))


@query
def rule_feed_snapshot(spark, sf):
    """S3: existing brand rules as a snapshot, followed by the later changes."""
    parts = R.table(spark, sf, "part")
    snapshot = parts.groupBy(F.lower("p_type").alias("source_table")).agg(
        F.lit("insert").alias("operate_type"),
        F.lit("kafka").alias("sink_type"),
        F.concat(F.lit("snap_"), F.lower(F.min("p_type"))).alias("sink_table"),
        F.lit("id").alias("sink_columns"),
    )
    feed = rule_feed(snapshot, R.part_rule_changes(spark, sf))
    now = U.current_rules(U.validate_rules(U.bind_rules(feed)))
    return now.select(*RULE_TEXT, "seq")


@query
def rule_snapshot_handover(spark, sf):
    """Rules read in chunks while they change, with their changes; records that cannot be read are dead letters."""
    changes = change_feed(R.line_rule_changes(spark, sf).select("topic", "value", "seq"))
    chunks, marks = R.line_rule_chunks(spark, sf)
    keys = ("source_table", "operate_type")
    feed = snapshot_with_changes(chunks, marks, C.good_changes(changes), keys, "rules", "rules")
    rules = U.checked_rules(U.bind_rules(feed, keep=("row",)))
    good = rules.select("seq", "row", F.col("change_type").alias("type"), "source_table", "old_source_table", "sink_table", "reason")
    letters = rule_feed_letters(changes).select("seq", F.lit(0).alias("row"), "reason")
    return good.unionByName(letters, allowMissingColumns=True)


@query
def rule_snapshot_state(spark, sf):
    """The rules in force after a snapshot in chunks are those after all changes."""
    changes = change_feed(R.line_rule_changes(spark, sf).where("NOT broken").select("topic", "value", "seq"))
    chunks, marks = R.line_rule_chunks(spark, sf)
    feed = snapshot_with_changes(chunks, marks, C.good_changes(changes), ("source_table", "operate_type"), "rules", "rules")
    now = U.current_rules(U.validate_rules(U.bind_rules(feed), honor_deletes=True), honor_deletes=True)
    return now.select("source_table", "operate_type", "sink_table")


@query
def dim_tables(spark, sf):
    """Columns, order and key of every table that dimension rules ask for."""
    tables = D.dim_definitions(part_rules(spark, sf))
    named = tables.select("sink_table", "sink_pk", "sink_extend", F.posexplode("columns").alias("position", "column"))
    is_pk = (F.col("column") == F.col("sink_pk")).alias("is_pk")
    return named.select("sink_table", "position", "column", is_pk, "sink_extend")


# ---- routing ----------------------------------------------------------------------------


def routed(spark: SparkSession, sf: str) -> DataFrame:
    changes = C.drop_deletes(change_feed(R.shop_changes(spark, sf)))
    rules = U.current_rules(U.validate_rules(U.bind_rules(R.rule_changes(spark))))
    return U.route_changes(changes.drop("value"), rules)


@query
def route_topic(spark, sf):
    """What is published for topics."""
    rows = U.topic_rows(routed(spark, sf))
    return rows.select(
        "topic",
        "seq",
        F.size(J.as_object(F.parse_json("value"))).alias("n_columns"),
        field("$.o_orderkey", "o_orderkey", "bigint"),
        field("$.o_custkey", "o_custkey", "bigint"),
        field("$.o_totalprice", "o_totalprice", "double"),
        field("$.o_orderstatus", "o_orderstatus"),
    )


@query
def route_dim(spark, sf):
    """What goes to dimensions."""
    rows = U.dim_rows(routed(spark, sf))
    payload = F.col("payload")
    return rows.select(
        "sink_table",
        "pk",
        "seq",
        F.size("payload").alias("n_columns"),
        J.path_string(payload["c_name"]).alias("c_name"),
        J.path_string(payload["c_mktsegment"]).alias("c_mktsegment"),
        F.try_variant_get(payload["c_acctbal"], "$", "double").alias("c_acctbal"),
    )


@query
def route_unmatched(spark, sf):
    """Dead letters of routing, with the whole envelope as text."""
    dead = U.unrouted_changes(routed(spark, sf))
    return dead.select("seq", "reason", "stage", field("$.tableName", "tableName"), field("$.type", "type"))


@query
def route_asof(spark, sf):
    """B2: the rule in force when each order change arrived."""
    raw = R.raw_changes(spark, sf, "orders", "o_orderkey")
    texts = C.envelope_text(change_feed(raw)).select("seq", "value")
    out = routed_changes(texts, R.rule_changes(spark, R.RULE_HISTORY), asof=True)
    return out.select("seq", "type", "sink_table", F.size("payload").alias("n_columns"), "reason")


def run_connected(spark: SparkSession, sf: str, name: str, steps, trigger, **options) -> DataFrame:
    """Order changes routed by lanes; the rules of ``steps`` arrive one step after another, the changes with the first."""
    root = shared_dir(spark, name)
    source = FileTopics(f"{root}/source")
    changes = C.envelope_text(change_feed(R.raw_changes(spark, sf, "orders", "o_orderkey")))
    key = F.col("seq").cast("string").alias("key")
    source.write_batch(changes.select(F.lit(RAW_CHANGE_TOPIC).alias("topic"), key, "value").repartition(4), 0)
    lanes = lanes_for(source.read(spark, RAW_CHANGE_TOPIC).count(), spark.sparkContext.defaultParallelism)
    for step, rules in enumerate(steps):
        history = C.envelope_text(R.rule_changes(spark, rules)).select(F.lit("rules").alias("topic"), key, "value")
        source.write_batch(history, step + 1)
        messages, rule_messages = (R.with_seq(source.stream(spark, topic)) for topic in (RAW_CHANGE_TOPIC, "rules"))
        rows = connect_rules(messages, rule_messages, lanes, **options)
        fields = StructType([StructField("seq", LongType())])
        out = connected_changes(rows, fields).select("seq", "type", "sink_table", F.size("payload").alias("n_columns"), "reason")
        writer = out.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/checkpoint")
        with state_settings(spark, lanes):
            finished(writer.trigger(**trigger).start())
    return spark.read.parquet(f"{root}/out")


@query
def route_connected_stream(spark, sf):
    """B1, B2 as a stream: changes connected with the rule stream, each by the rule of its time."""
    return run_connected(spark, sf, "connected", [R.RULE_HISTORY], {"availableNow": True})


@query
def unmatched_released_stream(spark, sf):
    """Changes that come before any rule wait and are released when a rule of their key arrives."""
    steps = [R.RULE_HISTORY[2:], R.RULE_HISTORY[:2]]
    return run_connected(spark, sf, "waiting", steps, {"once": True}, wait_ms=24 * 3600 * 1000)


@query
def connected_job_stream(spark, sf):
    """The job over both streams, by its topics and the dimension in the catalog."""
    root = shared_dir(spark, "connected_job")
    source, sink, store = FileTopics(f"{root}/source"), FileTopics(f"{root}/out"), R.dim_store(root)
    key = F.concat_ws("/", "tableName", F.col("seq").cast("string")).alias("key")
    # Rules were written before the changes; two of them cannot be used.
    bad = [(-3, "nation", "read", "hbase", "dim_nation", "n_name", "n_nationkey"), (-2, "nation", "update", "kafka", "a/b", "n_name", None)]
    rules = R.rule_changes(spark, [*bad, *((seq - 10, *rule) for seq, *rule in R.ROUTING_RULES)])
    changes = C.envelope_text(change_feed(R.shop_changes(spark, sf))).select(F.lit(RAW_CHANGE_TOPIC).alias("topic"), key, "value")
    rules = C.envelope_text(rules).select(F.lit("rules").alias("topic"), key, "value")
    broken = rules.limit(1).select("topic", F.lit("rules/-1").alias("key"), F.lit("{broken").alias("value"))
    source.write_batch(changes.unionByName(rules).unionByName(broken), 0)
    seq = F.split("key", "/")[1].cast("bigint")
    messages, rule_messages = (source.stream(spark, topic).withColumn("seq", seq) for topic in (RAW_CHANGE_TOPIC, "rules"))
    database = new_database(spark)
    lanes = lanes_for(source.read(spark, RAW_CHANGE_TOPIC).count(), spark.sparkContext.defaultParallelism)
    job = jobs.start_connected_job(
        messages, rule_messages, sink, store, f"{root}/checkpoint", lanes, database, order_by=("key",)
    )
    finished(job)
    rows = sink.read(spark, ".*", pattern=True)
    letter = F.from_json("value", "reason string, seq bigint")
    rows = rows.select("topic", F.when(F.col("topic") == "dead_letter", letter["reason"]).alias("reason"), "key")
    dims = spark.table(f"{database}.dim_customer").select(
        F.lit("dim_customer").alias("topic"), F.lit(None).cast("string").alias("reason"), F.col("c_custkey").alias("key")
    )
    found = rows.unionByName(dims).groupBy("topic", "reason")
    return found.agg(F.count("*").alias("n"), F.countDistinct("key").alias("keys"))


@query
def route_asof_part_rules(spark, sf):
    """B2 with a history that grows with the data: every part's changes by the rules of its time."""
    intervals = U.rule_intervals(part_rules(spark, sf))
    out = U.route_changes_asof(R.part_changes(spark, sf), intervals)
    return out.select("seq", "type", "sink_table", "pk", F.size("payload").alias("n_columns"), "reason")


@query
def route_by_part_rules(spark, sf):
    """B1b with a rule table that grows with the data: parts routed by their brand's rule."""
    parts = R.table(spark, sf, "part")
    image = F.create_map(
        F.lit("id"), F.col("p_partkey").cast("variant"), F.lit("p_name"), F.col("p_name").cast("variant")
    )
    brand = F.lower(F.replace("p_brand", F.lit("#"), F.lit("_")))
    changes = parts.select(*R.envelope(image), F.col("p_partkey").alias("seq"), brand.alias("brand"))
    changes = changes.withColumn("tableName", F.col("brand")).drop("brand")
    out = U.route_changes(changes, U.current_rules(part_rules(spark, sf)))
    return out.select("seq", "sink_table", "pk", F.size("payload").alias("n_columns"), "reason")


@query
def change_topic_sink(spark, sf):
    """Facts and dead letters written to dynamic topics and read back, by counts and a sum over their values."""
    topics = FileTopics(shared_dir(spark, "change_topics"))
    raw = C.envelope_text(change_feed(R.shop_changes(spark, sf))).select("seq", "value", "tableName")
    out = change_outputs(routed_changes(raw, R.rule_changes(spark)))
    topics.write_batch(publishable(out, ("tableName", "seq"), "change_job"), 0)
    return change_totals(topics.read(spark, ".*", pattern=True))


def change_totals(rows: DataFrame) -> DataFrame:
    """Rows, keys and a sum over the values of every fact topic and of the dead letters."""
    rows, record = J.with_computed(rows.select("topic", "key", "value"), record=F.parse_json("value")), F.col("record")
    number = lambda path, kind="bigint": F.coalesce(F.try_variant_get(record, path, kind), F.lit(0))
    letter = F.length(F.try_variant_get(record, "$.reason", "string"))
    facts = F.round(number("$.o_totalprice", "double") * 100).cast("bigint") + number("$.o_custkey") + number("$.o_orderkey")
    facts = facts + F.coalesce(F.ascii(F.try_variant_get(record, "$.o_orderstatus", "string")), F.lit(0))
    value = F.when(F.col("topic") == "dead_letter", letter).otherwise(facts)
    keys = F.countDistinct("key").alias("keys")
    return rows.groupBy("topic").agg(F.count("*").alias("n"), keys, F.sum(value).alias("total"))


# ---- dimensions -------------------------------------------------------------------------

CUSTOMER_COLUMNS = ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")


def typed_customer(dim: DataFrame) -> DataFrame:
    return dim.withColumn("c_acctbal", F.col("c_acctbal").cast("double"))


@query
def dim_merge(spark, sf):
    """Absent columns keep their value, explicit nulls clear it."""
    return typed_customer(D.merge_dim(R.customer_dim_rows(spark, sf), CUSTOMER_COLUMNS))


@query
def dim_cells(spark, sf):
    """The latest cell per key and column, for all tables in one job."""
    cells = D.merge_cells(D.dim_cells(R.customer_dim_rows(spark, sf)))
    text = F.when(F.col("column") != "c_acctbal", F.col("value")).alias("text")
    return cells.select("sink_table", "pk", "column", text, "seq")


@query
def dim_store_compacted(spark, sf):
    """The same table from the store, half of it compacted, with one batch replayed."""
    store = R.dim_store(shared_dir(spark, "dim_store"))
    cells = D.dim_cells(R.customer_dim_rows(spark, sf))
    full = F.col("seq") % 3 == 0
    store.append(cells.where(full), "load", 0)
    store.compact(spark)
    store.append(cells.where(~full), "load", 1)
    store.append(cells.where(full), "load", 0)
    return typed_customer(store.table(spark, "dim_customer", CUSTOMER_COLUMNS))


@query
def dim_merge_stream(spark, sf):
    """W3 as a stream: dimension rows of customers through the store."""
    root = shared_dir(spark, "dim_stream")
    R.customer_dim_rows(spark, sf).write.parquet(f"{root}/rows")
    schema = spark.read.parquet(f"{root}/rows").schema
    rows = spark.readStream.schema(schema).parquet(f"{root}/rows")
    store = R.dim_store(root)
    finished(jobs.start_dim_job(rows, store, f"{root}/checkpoint"))
    return typed_customer(store.table(spark, "dim_customer", CUSTOMER_COLUMNS))


def new_database(spark: SparkSession) -> str:
    """A database of its own for one run, in the shared folder."""
    name = f"dims_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{shared_dir(spark, 'catalog')}'")
    return name


def run_change_job(spark: SparkSession, sf: str, runs: int = 1, database: str | None = None):
    """The change job over all changes, or several jobs over a share each, on one sink and store."""
    root = shared_dir(spark, "change_job")
    sink, store = FileTopics(f"{root}/out"), R.dim_store(root)
    texts = C.envelope_text(change_feed(R.shop_changes(spark, sf)))
    key = F.concat_ws("/", "tableName", F.col("seq").cast("string")).alias("key")
    for run in range(runs):
        source = FileTopics(f"{root}/ods-{run}")
        share = texts.where(F.pmod(F.floor(F.col("seq") / 4), F.lit(runs)) == run)
        source.write_batch(share.select(F.lit(RAW_CHANGE_TOPIC).alias("topic"), key, "value"), 0)
        messages = source.stream(spark, RAW_CHANGE_TOPIC)
        messages = messages.withColumn("seq", F.split("key", "/")[1].cast("bigint"))
        # Parsing a message costs far more than its bytes: several tasks for each core even out their times.
        tasks = 3 * spark.sparkContext.defaultParallelism
        with session_conf(spark, {"spark.sql.files.minPartitionNum": str(tasks)}):
            job = jobs.start_change_job(
                messages, R.rule_changes, sink, store, f"{root}/checkpoint-{run}", database, order_by=("key",)
            )
            finished(job)
    return sink, store


@query
def change_job_topics(spark, sf):
    """The change job end to end: rows, distinct keys and a sum over the values per topic."""
    sink, _ = run_change_job(spark, sf)
    return change_totals(sink.read(spark, ".*", pattern=True))


@query
def change_job_dims(spark, sf):
    """The change job end to end: the upserted customer dimension."""
    _, store = run_change_job(spark, sf)
    columns = ("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    return typed_customer(store.table(spark, "dim_customer", columns))


@query
def dim_catalog_table(spark, sf):
    """The customer dimension as the catalog serves it after two change jobs."""
    database = new_database(spark)
    run_change_job(spark, sf, runs=2, database=database)
    return typed_customer(spark.table(f"{database}.dim_customer"))


@query
def dim_catalog_merge(spark, sf):
    """Three batches merged into a catalog table, the latest changes first and one of them twice."""
    database = new_database(spark)
    cells = stored(D.dim_cells(R.customer_dim_rows(spark, sf)), "catalog_cells")
    schema = "sink_table string, sink_pk string, columns array<string>, sink_extend string"
    rule = [("dim_customer", "c_custkey", list(CUSTOMER_COLUMNS), "")]
    create_dim_tables(spark, spark.createDataFrame(rule, schema), database)
    for step in (2, 0, 1, 2):
        fill_dim_tables(spark, database, cells.where(F.col("seq") % 3 == step))
    return typed_customer(spark.table(f"{database}.dim_customer"))


@query
def change_job_two_runs(spark, sf):
    """Two jobs with checkpoints of their own on one sink and one store; both stay."""
    sink, store = run_change_job(spark, sf, runs=2)
    order = F.try_variant_get(F.try_parse_json("value"), "$.o_orderkey", "bigint")
    facts = sink.read(spark, ".*", pattern=True).select("topic", "key", order.alias("id"))
    dims = store.table(spark, "dim_customer", ("c_custkey", "c_name"))
    dims = dims.select(F.lit("dim_customer").alias("topic"), F.col("c_custkey").alias("key"), F.col("c_custkey").cast("bigint").alias("id"))
    found = facts.unionByName(dims).groupBy("topic")
    return found.agg(F.count("*").alias("n"), F.countDistinct("key").alias("keys"), F.sum("id").alias("ids"))


@query
def capture_wrapped_records(spark, sf):
    """Records inside a payload, and a tombstone after each delete, which is skipped."""
    raw = R.raw_changes(spark, sf, "customer", "c_custkey")
    text = F.concat(F.lit('{"schema": {"type": "struct"}, "payload": '), F.col("value"), F.lit("}"))
    wrapped = raw.withColumn("value", text)
    feed = change_feed(wrapped.unionByName(wrapped.withColumn("value", F.lit(None).cast("string"))))
    name = F.when(F.col("type") != "delete", J.path_string(F.col("after")["c_name"])).alias("c_name")
    return feed.select("seq", "database", "tableName", "type", name, "reason")


@query
def capture_encoded_values(spark, sf):
    """N1c, N1d, D12: decimals, days and microseconds as a connector encodes them, decoded with their scale."""
    feed = change_feed(R.encoded_changes(spark, sf), decode=True)
    after = F.col("after")
    names = ("price", "total", "day", "at", "status")
    return feed.select("seq", "type", *[J.path_string(after[name]).alias(name) for name in names], "reason")


@query
def rules_bad_names(spark, sf):
    """Rules whose table or topic cannot be written are rejected, with the reason."""
    n = F.col("n_nationkey").cast("bigint")
    names = F.array(*map(F.lit, ("", " ", "dead_letter", "a/b", "good")))
    fields = {
        "source_table": F.concat(F.lit("t"), n.cast("string")),
        "operate_type": F.lit("insert"),
        "sink_type": F.when(n % 2 == 0, "kafka").otherwise("hbase"),
        "sink_table": F.element_at(names, (n % 5 + 1).cast("int")),
        "sink_columns": F.when(n == 19, "id,Name").otherwise("id,name"),
    }
    image = F.create_map(*[part for name, value in fields.items() for part in (F.lit(name), J.to_variant(value))])
    changes = R.table(spark, sf, "nation").select(
        image.alias("after"), J.empty_object().alias("before"), F.lit("insert").alias("type"), n.alias("seq")
    )
    return U.validate_rules(U.bind_rules(changes)).select("seq", "sink_type", "sink_table", "reason")


@query
def dead_letter_replay(spark, sf):
    """Changes that came before their rule, written as dead letters and routed afterwards."""
    topics = FileTopics(shared_dir(spark, "replay"))
    raw = C.envelope_text(change_feed(R.shop_changes(spark, sf))).select("seq", "value", "tableName")
    early = R.rule_changes(spark).where(J.path_string(F.col("after")["source_table"]) != "customer")
    letters = change_outputs(routed_changes(raw, early)).where("reason IS NOT NULL")
    letters = stored(publishable(letters, ("tableName", "seq"), "change_job"), "dead_letters")
    topics.write_batch(letters, 0, "first")
    topics.write_batch(letters, 0, "repeated")
    found = replayed_changes(topics.read(spark, "dead_letter"), R.rule_changes(spark))
    return found.select("key", "sink_table", "pk", F.size("payload").alias("n_columns"), "reason")
