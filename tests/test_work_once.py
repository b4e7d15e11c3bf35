"""What a query or job computes once, and what does not travel through Python."""

import json
import re
from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from tidewater.sources.feeds import change_feed
from tidewater.sources.topics import FileTopics
from tidewater.streaming import jobs
from tidewater.streaming.visitors import first_visit
from verification import recipes as R
from verification import registry


class Stop(Exception):
    pass


@pytest.fixture
def tables(spark, tmp_path):
    """A few rows of the tables that the queries read."""
    day = datetime(2024, 1, 2)
    events = [(i, day, i % 5, kind, 1.0, '{"k": 1}') for i, kind in enumerate(["view", "click", "purchase", "error", "signup"] * 8)]
    rows = {
        "events": (events, "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string"),
        "orders": (
            [(i, i, "O", 1.5, day, "1") for i in range(12)],
            "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string",
        ),
        "customer": ([(i, f"c{i}", 1, 2.5, "X") for i in range(12)], "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
        "nation": ([(i, f"n{i}", 1) for i in range(6)], "n_nationkey int, n_name string, n_regionkey int"),
    }
    for name, (data, schema) in rows.items():
        spark.createDataFrame(data, schema).coalesce(1).write.parquet(f"{tmp_path}/tables/{name}.parquet")
    return f"{tmp_path}/tables"


@pytest.mark.parametrize("name, folder", [("topic_dedup_stream", "topic_dedup-"), ("dead_letter_replay", "dead_letters-")])
def test_rows_written_twice_are_computed_once(spark, tables, monkeypatch, name, folder):
    read = []

    def write_batch(self, rows, batch_id, job="batch"):
        read.append(rows.inputFiles())
        if len(read) == 2:
            raise Stop

    monkeypatch.setattr(FileTopics, "write_batch", write_batch)
    with pytest.raises(Stop):
        registry.REGISTRY[name](spark, tables)
    assert all(files and all(folder in file for file in files) for files in read)


def test_a_repeated_batch_holds_all_rows_of_all_topics(spark, tables, monkeypatch):
    held = {}
    write = FileTopics.write_batch

    def write_batch(self, rows, batch_id, job="batch"):
        held[job] = sorted(map(tuple, rows.collect()))
        write(self, rows, batch_id, job)

    monkeypatch.setattr(FileTopics, "write_batch", write_batch)
    totals = registry.topic_dedup_stream(spark, tables).collect()
    assert list(held) == ["first", "repeated"] and held["first"] == held["repeated"]
    rows = Counter(topic for topic, _, _ in held["first"])
    assert set(rows) == {"dead_letter", "dwd_display_log", "dwd_page_log", "dwd_start_log"}
    assert {r.topic: (r.n, r["keys"]) for r in totals} == {topic: (n, n) for topic, n in rows.items()}


def test_cells_of_several_fills_are_computed_once(spark, tables, monkeypatch):
    read = []
    fill = registry.fill_dim_tables

    def recorded(spark, database, cells):
        read.append(cells.inputFiles())
        return fill(spark, database, cells)

    monkeypatch.setattr(registry, "fill_dim_tables", recorded)
    assert registry.REGISTRY["dim_catalog_merge"](spark, tables).count() == 12
    assert len(read) == 4 and all(files and all("catalog_cells-" in file for file in files) for files in read)


def test_lanes_run_together_before_tables_are_fetched(spark, tables, monkeypatch):
    seen = []
    create = jobs.create_dim_tables

    def recorded(spark, *args):
        stored = spark.sparkContext._jsc.sc().getRDDStorageInfo()
        seen.append([(info.numCachedPartitions(), info.numPartitions()) for info in stored])
        return create(spark, *args)

    monkeypatch.setattr(jobs, "create_dim_tables", recorded)
    registry.REGISTRY["connected_job_stream"](spark, tables).collect()
    assert seen and all(any(filled == parts and parts > 1 for filled, parts in batch) for batch in seen)


def test_state_gives_repaired_and_no_flag():
    """The flag is known before the state operator and follows from ``repaired`` after it."""
    state = set()

    class Seen:
        exists, update = staticmethod(lambda: bool(state)), staticmethod(state.add)

    made = first_visit(["value", "seq", "mid"], ["seq"], None)
    made.seen = Seen
    row = Row("value", "seq", "mid", "settled", "device", "lane")
    rows = [row("v", seq, "a", False, "a", -1) for seq in (4, 2, None, 3)]
    out = {r.seq: r.repaired for r in made.handleInputRows(("a", -1), iter(rows), None)}
    assert out == {None: False, 2: True, 3: True, 4: True} and state == {("1",)}
    again = list(made.handleInputRows(("a", -1), iter(rows[:1]), None))
    assert again == [Row(value="v", seq=4, mid="a", repaired=True)]


def test_only_the_columns_of_a_log_reach_the_state(spark, tables, tmp_path, monkeypatch):
    widths = []
    repair = jobs.repair_is_new_stream

    def recorded(df, *args):
        widths.append(df.columns)
        return repair(df, *args)

    monkeypatch.setattr(jobs, "repair_is_new_stream", recorded)
    source = R.stage_logs(spark, tables, str(tmp_path / "source"))
    messages = R.with_seq(source.stream(spark, "ods_base_log"))
    jobs.start_log_job(messages, FileTopics(f"{tmp_path}/out"), f"{tmp_path}/checkpoint", ("seq",), state_partitions=2).awaitTermination()
    assert not {"topic", "key", "timestamp", "partition", "offset"} & set(widths[0])
    found = FileTopics(f"{tmp_path}/out").read(spark, "dwd_page_log").collect()
    assert found and all(json.loads(r.value)["common"]["mid"] for r in found)


def plan_of(frame):
    return frame._jdf.queryExecution().optimizedPlan().toString()


def test_text_of_a_change_is_made_once(spark, tables):
    """A test of the text must not move below an exchange, where the text would be made a second time."""
    raw = R.raw_changes(spark, tables, "orders", "o_orderkey")
    feed = change_feed(raw)
    assert plan_of(feed).count("StructsToJsonEvaluator") == 1
    assert feed.columns[:2] == ["value", "seq"] and feed.count() == 12
    missing = change_feed(raw.withColumn("value", F.when(F.col("seq") > 3, F.col("value"))))
    assert sorted(r.seq for r in missing.collect()) == list(range(4, 12))


def test_value_of_a_topic_row_is_parsed_once(spark):
    rows = spark.createDataFrame([("t", "a", '{"o_custkey": 2, "o_orderkey": 3}')], "topic string, key string, value string")
    totals = registry.change_totals(rows)
    assert len(re.findall("parse_?json", plan_of(totals), re.IGNORECASE)) == 1
    assert [tuple(r) for r in totals.collect()] == [("t", 1, 1, 5)]


@pytest.mark.parametrize("name, runs", [("change_job_topics", 1), ("dim_catalog_table", 2)])
def test_a_batch_of_changes_holds_what_is_routed(spark, tables, monkeypatch, name, runs):
    columns, tasks = [], []
    route, start = jobs.route_changes, jobs.start_change_job

    def routed(batch, rules):
        columns.append(batch.columns)
        return route(batch, rules)

    def started(*args, **options):
        tasks.append(spark.conf.get("spark.sql.files.minPartitionNum", None))
        return start(*args, **options)

    monkeypatch.setattr(jobs, "route_changes", routed)
    monkeypatch.setattr(jobs, "start_change_job", started)
    assert registry.REGISTRY[name](spark, tables).count() > 0
    assert columns == [["key", "seq", "value", "tableName", "type", "after", "reason"]] * runs
    assert tasks == [str(3 * spark.sparkContext.defaultParallelism)] * runs
    assert spark.conf.get("spark.sql.files.minPartitionNum", None) is None
