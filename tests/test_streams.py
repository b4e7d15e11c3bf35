import json
import random
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidewater.operators.logs import good_logs, parse_logs
from tidewater.plans.logs import log_outputs
from tidewater.session import session_conf
from tidewater.sinks.dim_store import DimStore
from tidewater.sources.topics import FileTopics, without_repeats_within
from tidewater.streaming import jobs
from tidewater.streaming.visitors import known_devices, later_in_batch

SCHEMA = "seq bigint, value string"


def record(seq, mid, flag):
    body = {"common": {"mid": mid, "is_new": flag}, "n": seq}
    body["page" if seq % 2 else "start"] = {"page_id": "p"}
    return json.dumps(body)


def add_file(spark, folder, rows):
    """One more input file; files are streamed in the order of their times."""
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
    time.sleep(0.05)


def run_logs(spark, folder, out, checkpoint, **options):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)
    query = jobs.start_log_job(stream, FileTopics(out), checkpoint, ("seq",), state_partitions=3, **options)
    query.awaitTermination()
    return query


def published(spark, out):
    rows = FileTopics(out).read(spark, "dwd_start_log,dwd_page_log").collect()
    return sorted((json.loads(r.value)["n"], json.loads(r.value)["common"]["is_new"]) for r in rows)


def batch_result(spark, rows):
    out = log_outputs(spark.createDataFrame(rows, SCHEMA)).where("reason IS NULL").collect()
    return sorted((json.loads(r.value)["n"], json.loads(r.value)["common"]["is_new"]) for r in out)


@pytest.mark.parametrize("arrow_batch", ["10000", "7"])
def test_log_stream_equals_batch_for_any_cut_and_after_restart(spark, tmp_path, arrow_batch):
    rng = random.Random(11)
    mids = ["hot"] * 10 + [f"m{i}" for i in range(12)]
    rows = [(seq, record(seq, rng.choice(mids), rng.choice("01"))) for seq in range(300)]
    rows[40] = (40, "{broken")
    cuts = sorted(rng.sample(range(1, 300), 3))
    parts = [rows[a:b] for a, b in zip([0, *cuts], [*cuts, 300])]
    folder, out, checkpoint = (str(tmp_path / name) for name in ("in", "out", "checkpoint"))
    with session_conf(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": arrow_batch}):
        for part in parts[:2]:
            add_file(spark, folder, rng.sample(part, len(part)))
        query = run_logs(spark, folder, out, checkpoint)
        assert len(query.recentProgress) >= 2
        for part in parts[2:]:
            add_file(spark, folder, rng.sample(part, len(part)))
        run_logs(spark, folder, out, checkpoint)
    assert published(spark, out) == batch_result(spark, rows)
    letters = FileTopics(out).read(spark, "dead_letter").collect()
    assert [json.loads(r.value)["value"] for r in letters] == ["{broken"]


def test_state_may_expire(spark, tmp_path):
    folder, out, checkpoint = (str(tmp_path / name) for name in ("in", "out", "checkpoint"))
    add_file(spark, folder, [(0, record(0, "m", "1")), (1, record(1, "m", "1"))])
    once = {"trigger": {"once": True}, "ttl_ms": 1}
    run_logs(spark, folder, out, checkpoint, **once)
    time.sleep(0.2)
    add_file(spark, folder, [(2, record(2, "m", "1"))])
    run_logs(spark, folder, out, checkpoint, **once)
    assert published(spark, out) == [(0, "1"), (1, "0"), (2, "1")]


def test_expiring_state_has_no_last_batch(spark, tmp_path):
    with pytest.raises(ValueError):
        run_logs(spark, str(tmp_path), str(tmp_path), str(tmp_path), ttl_ms=1)


def test_hot_devices_are_settled_before_the_shuffle(spark):
    rows = spark.range(0, 20000, 1, 2).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("mid"),
        (20000 - F.col("id")).alias("seq"),
    )
    marked = rows.withColumn("settled", later_in_batch()(F.struct("mid", "seq"))).cache()
    left = marked.where("NOT settled AND mid = 'hot'")
    assert 1 <= left.count() <= 4
    assert left.agg(F.min("seq")).first()[0] == rows.where("mid = 'hot'").agg(F.min("seq")).first()[0]
    assert marked.where("settled AND mid <> 'hot'").count() == 0
    marked.unpersist()


def test_counts_are_observed(spark, tmp_path):
    folder, out, checkpoint = (str(tmp_path / name) for name in ("in", "out", "checkpoint"))
    add_file(spark, folder, [(0, record(0, "m", "1")), (1, record(1, "m", "1")), (2, "{bad")])
    query = run_logs(spark, folder, out, checkpoint)
    counts = [p["observedMetrics"]["log_outputs"] for p in query.recentProgress if p["observedMetrics"]]
    assert counts[0].dwd_start_log == 1 and counts[0].dwd_page_log == 1 and counts[0].dead_letter == 1


def envelope(table, kind, after):
    return json.dumps({"database": "d", "tableName": table, "type": kind, "before": {}, "after": after})


def rule(source, operate, sink, target, columns, pk=None):
    after = {
        "source_table": source, "operate_type": operate, "sink_type": sink, "sink_table": target,
        "sink_columns": columns, "sink_pk": pk,
    }
    return envelope("rules", "insert", after)


def read_rules(folder):
    from tidewater.operators.changes import parse_envelopes

    return lambda session: parse_envelopes(session.read.schema(SCHEMA).parquet(folder))


def run_changes(spark, folder, rules, tmp_path, **options):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)
    sink, store = FileTopics(str(tmp_path / "out")), DimStore(str(tmp_path / "dims"))
    query = jobs.start_change_job(
        stream, read_rules(rules), sink, store, str(tmp_path / "checkpoint"), order_by=("seq",), **options
    )
    query.awaitTermination()
    return sink, store


def test_rules_added_between_batches_apply(spark, tmp_path):
    folder, rules = str(tmp_path / "in"), str(tmp_path / "rules")
    add_file(spark, rules, [(1, rule("t", "insert", "kafka", "facts", "id,v"))])
    rows = [
        (1, envelope("t", "insert", {"id": 1, "v": "x", "z": 0})),
        (2, envelope("u", "insert", {"id": 5, "a": "O'Brien", "b": 1})),
        (3, envelope("t", "delete", {})),
        (4, "{broken"),
    ]
    add_file(spark, folder, rows)
    sink, store = run_changes(spark, folder, rules, tmp_path, database="job_test")
    assert [json.loads(r.value) for r in sink.read(spark, "facts").collect()] == [{"id": 1, "v": "x"}]
    letters = {r.key: json.loads(r.value) for r in sink.read(spark, "dead_letter").collect()}
    assert {k: v["reason"] for k, v in letters.items()} == {"2": "no_rule", "4": "bad_envelope"}
    assert json.loads(letters["2"]["value"])["tableName"] == "u" and letters["4"]["value"] == "{broken"

    more = [rule("u", "insert", "hbase", "dim_u", "id,a,b"), rule("u", "update", "hbase", "dim_u", "id,b")]
    add_file(spark, rules, [(2, more[0]), (3, more[1])])
    add_file(spark, folder, [(5, envelope("u", "insert", {"id": 5, "a": "O'Brien", "b": 1}))])
    add_file(spark, folder, [(6, envelope("u", "update", {"id": 5, "b": 2})), (7, envelope("u", "update", {"b": 3}))])
    sink, store = run_changes(spark, folder, rules, tmp_path, database="job_test", compact_every=2)
    assert [tuple(r) for r in store.table(spark, "dim_u", ("id", "a", "b")).collect()] == [("5", "O'Brien", "2")]
    assert spark.table("job_test.dim_u").columns == ["id", "a", "b"]
    reasons = [json.loads(r.value)["reason"] for r in sink.read(spark, "dead_letter").collect()]
    assert sorted(reasons) == ["bad_envelope", "no_rule", "null_pk"]
    assert store.epoch(spark) >= 1


def test_replaying_a_batch_changes_nothing(spark, tmp_path):
    folder, rules = str(tmp_path / "in"), str(tmp_path / "rules")
    add_file(spark, rules, [(1, rule("t", "insert", "kafka", "facts", "id")), (2, rule("u", "insert", "hbase", "dim_u", "id,a"))])
    add_file(spark, folder, [(1, envelope("t", "insert", {"id": 1})), (2, envelope("u", "insert", {"id": 5, "a": "x"}))])
    run_changes(spark, folder, rules, tmp_path)
    lost = tmp_path / "checkpoint" / "commits" / "0"
    lost.unlink()
    (tmp_path / "checkpoint" / "commits" / ".0.crc").unlink(missing_ok=True)
    sink, store = run_changes(spark, folder, rules, tmp_path)
    assert sink.read(spark, "facts").count() == 1
    assert [tuple(r) for r in store.table(spark, "dim_u", ("id", "a")).collect()] == [("5", "x")]


def test_rejected_rules_are_reported(spark, tmp_path):
    rules = str(tmp_path / "rules")
    add_file(spark, rules, [(1, rule("t", "insert", "hbase", "d", "name"))])
    dead = jobs.rule_dead_letters(read_rules(rules)(spark)).collect()
    assert [(r.reason, r.stage, r.seq) for r in dead] == [("pk_not_in_columns", "validate_rules", 1)]


def test_bad_names_become_letters_and_the_job_goes_on(spark, tmp_path):
    folder, rules = str(tmp_path / "in"), str(tmp_path / "rules")
    named = [("a", "hbase", ""), ("b", "kafka", " "), ("c", "kafka", "dead_letter"), ("d", "hbase", "dim-user"), ("e", "hbase", "x/y")]
    rows = [(i, rule(t, "insert", sink, target, "id,name")) for i, (t, sink, target) in enumerate(named)]
    rows += [(7, rule("f", "insert", "hbase", "dim_f", "id,name")), (8, rule("f", "update", "hbase", "dim_f", "id,Name"))]
    add_file(spark, rules, rows)
    add_file(spark, folder, [(i, envelope(t, "insert", {"id": i, "name": t})) for i, t in enumerate("abcdef")])
    sink, store = run_changes(spark, folder, rules, tmp_path, database="letters_test")
    letters = {r.key: json.loads(r.value) for r in sink.read(spark, "dead_letter").collect()}
    reasons = {k: v["reason"] for k, v in letters.items() if k.startswith("rule/")}
    assert reasons == {
        "rule/0/no_table": "no_table", "rule/1/bad_topic": "bad_topic", "rule/2/bad_topic": "bad_topic",
        "rule/4/bad_table": "bad_table", "rule/8/column_case": "column_case",
    }
    assert letters["table/dim-user"]["stage"] == "create_dim_tables"
    assert sorted(k for k, v in letters.items() if v["reason"] == "no_rule") == ["0", "1", "2", "4"]
    assert [tuple(r) for r in store.table(spark, "dim_f", ("id", "name")).collect()] == [("5", "f")]
    assert store.table(spark, "dim-user", ("id", "name")).count() == 1


def test_two_jobs_share_a_sink_and_a_store(spark, tmp_path):
    rules = str(tmp_path / "rules")
    add_file(spark, rules, [(1, rule("t", "insert", "kafka", "facts", "id")), (2, rule("u", "insert", "hbase", "dim_u", "id"))])
    sink, store = FileTopics(str(tmp_path / "out")), DimStore(str(tmp_path / "dims"))
    for n in (1, 2):
        folder = str(tmp_path / f"in{n}")
        add_file(spark, folder, [(1, envelope("t", "insert", {"id": n})), (2, envelope("u", "insert", {"id": 10 * n}))])
        stream = spark.readStream.schema(SCHEMA).parquet(folder)
        checkpoint = str(tmp_path / f"checkpoint{n}")
        jobs.start_change_job(stream, read_rules(rules), sink, store, checkpoint, order_by=("seq",)).awaitTermination()
    assert sorted(json.loads(r.value)["id"] for r in sink.read(spark, "facts").collect()) == [1, 2]
    assert sorted(r.id for r in store.table(spark, "dim_u", ("id",)).collect()) == ["10", "20"]


def test_dim_stream_does_not_depend_on_the_cut(spark, tmp_path):
    rng = random.Random(5)
    changes = []
    for seq in range(60):
        body = {"id": rng.choice([1, 1, 2])}
        body.update({n: rng.choice([None, f"{n}{seq}"]) for n in "ab" if rng.random() < 0.6})
        changes.append((seq, json.dumps(body)))
    expected = {}
    for _, text in changes:
        body = json.loads(text)
        expected.setdefault(body["id"], {"a": None, "b": None}).update({k: v for k, v in body.items() if k != "id"})
    folder = str(tmp_path / "in")
    for part in (changes[:7], changes[7:40], changes[40:]):
        add_file(spark, folder, part)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)
    rows = stream.selectExpr(
        "'d' AS sink_table", "get_json_object(value, '$.id') AS pk",
        "from_json(value, 'map<string,variant>') AS payload", "seq",
    )
    store = DimStore(str(tmp_path / "dims"))
    jobs.start_dim_job(rows, store, str(tmp_path / "ck"), compact_every=2).awaitTermination()
    found = {int(r.id): {"a": r.a, "b": r.b} for r in store.table(spark, "d", ("id", "a", "b")).collect()}
    assert found == expected


def test_devices_known_before_the_stream(spark, tmp_path):
    """A stream that begins with the devices of a batch, over a restart; its state holds one entry per device."""
    folder, out, checkpoint = (str(tmp_path / name) for name in ("in", "out", "checkpoint"))
    rows = [(seq, record(seq, f"m{seq % 7}", "1" if seq % 3 else "0")) for seq in range(60)]
    older = spark.createDataFrame(rows[:20], SCHEMA)
    known = known_devices(good_logs(parse_logs(older))).unionByName(spark.createDataFrame([(None,), ("m0",)], "mid string"))
    add_file(spark, folder, rows[20:40])
    run_logs(spark, folder, out, checkpoint, known=known)
    add_file(spark, folder, rows[40:] + [(60, record(60, "late", "1"))])
    run_logs(spark, folder, out, checkpoint, known=known)
    expected = batch_result(spark, rows + [(60, record(60, "late", "1"))])
    assert published(spark, out) == [r for r in expected if r[0] >= 20]
    state = spark.read.format("statestore").option("stateVarName", "seen").load(checkpoint)
    devices = [r.device for r in state.selectExpr("key.device AS device").collect()]
    assert sorted(devices) == sorted({f"m{i}" for i in range(7)} | {"late"})


def test_repeats_of_a_topic_are_dropped_and_forgotten(spark, tmp_path):
    """Repeats within the time are dropped; the keys of older messages leave the state."""
    folder, out, checkpoint = (str(tmp_path / name) for name in ("in", "out", "checkpoint"))
    schema = "topic string, key string, value string, timestamp timestamp"

    def run(*messages):
        spark.createDataFrame([(t, k, v, datetime(2024, 1, 1, hour)) for t, k, v, hour in messages], schema).coalesce(1).write.mode("append").parquet(folder)
        rows = without_repeats_within(spark.readStream.schema(schema).parquet(folder), "1 hour")
        query = rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
        return query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"]

    assert run(("a", "1", "x", 1), ("a", "1", "x", 1), ("b", "1", "y", 1), ("a", "2", "z", 1)) == 3
    assert run(("a", "1", "x", 1), ("a", "3", "w", 2)) == 4
    assert run(("a", "9", "u", 9)) == 1
    found = sorted((r.topic, r.key) for r in spark.read.schema(schema).parquet(out).collect())
    assert found == [("a", "1"), ("a", "2"), ("a", "3"), ("a", "9"), ("b", "1")]
