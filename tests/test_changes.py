import json

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from tidewater.operators import changes as C
from tidewater.sources.feeds import change_feed, rule_feed, snapshot_changes


@pytest.fixture
def feed(spark):
    def make(*rows, **options):
        messages = [(topic, json.dumps(body) if isinstance(body, dict) else body, i) for i, (topic, body) in enumerate(rows)]
        df = spark.createDataFrame(messages, "topic string, value string, seq bigint")
        return change_feed(df, **options)

    return make


def image(text):
    return json.loads(text)


@pytest.mark.parametrize(
    ("op", "expected"),
    [
        ("c", "insert"), ("CREATE", "insert"), ("u", "update"), ("UPDATE", "update"),
        ("d", "delete"), ("r", "read"), ("READ", "read"), ("Truncate", "truncate"),
    ],
)
def test_operation_names(feed, op, expected):
    assert feed(("s.db.t", {"op": op})).first().type == expected


def test_topic_gives_database_and_table(feed):
    row = feed(("srv.shop.orders.x", {"op": "c"})).first()
    assert (row.database, row.tableName, row.reason) == ("shop", "orders", None)


def test_bad_change_records_are_dead_letters(feed):
    rows = feed(
        ("srv", {"op": "c"}), ("srv.shop", {"op": "c"}), ("s.d.t", "{bad"), ("s.d.t", "[1]"),
        ("s.d.t", {"after": {"id": 1}}), ("s.d.t", {"op": "c", "after": 5}),
    )
    assert [r.reason for r in rows.orderBy("seq").collect()] == [
        "short_topic", "short_topic", "bad_record", "bad_record", "bad_record", "bad_record",
    ]
    dead = C.dirty_changes(rows, "capture").orderBy("seq").collect()
    assert dead[2].value == "{bad" and dead[2].stage == "capture"


def test_absent_images_are_empty_objects_and_types_survive(feed):
    body = {"op": "c", "before": None, "after": {"id": 1, "s": "x", "n": None, "o": {"z": [1, None]}}}
    text = C.envelope_text(feed(("s.db.t", body))).first().value
    assert json.loads(text) == {
        "database": "db", "tableName": "t", "before": {},
        "after": {"id": 1, "s": "x", "o": {"z": [1, None]}}, "type": "insert",
    }


def test_nulls_can_be_kept(feed):
    body = {"op": "c", "after": {"id": 1, "n": None}}
    text = C.envelope_text(feed(("s.db.t", body), drop_nulls=False)).first().value
    assert json.loads(text)["after"] == {"id": 1, "n": None}


def test_long_decimals_survive(feed):
    body = '{"op":"c","after":{"d":12345678901234567890123.45}}'
    text = C.envelope_text(feed(("s.db.t", body))).first().value
    assert '"d":12345678901234567890123.45' in text


def test_snapshot_rows_can_count_as_inserts(feed):
    assert feed(("s.db.t", {"op": "r"}), snapshot_as_insert=True).first().type == "insert"


def test_missing_type_is_kept_by_the_delete_filter(spark):
    texts = ['{"type":"delete"}', '{"type":"insert"}', '{"tableName":"t"}']
    df = spark.createDataFrame(list(enumerate(texts)), "seq bigint, value string")
    kept = C.drop_deletes(C.parse_envelopes(df)).orderBy("seq").collect()
    assert [(r.seq, r.type) for r in kept] == [(1, "insert"), (2, None)]
    assert kept[0].before == {} and kept[0].after == {}


def test_bad_envelopes_are_dead_letters_or_fail(spark):
    df = spark.createDataFrame(enumerate(["{bad", "[1]", "", '{"after":5}', None]), "seq bigint, value string")
    assert {r.reason for r in C.parse_envelopes(df).collect()} == {"bad_envelope"}
    with pytest.raises((PySparkException, Py4JJavaError)):
        C.parse_envelopes(df.where("seq = 0"), strict=True).collect()


def test_snapshot_comes_before_changes(spark, feed):
    table = spark.createDataFrame([("orders", "insert", None)], "source_table string, operate_type string, sink_pk string")
    both = rule_feed(table, feed(("s.rules.t", {"op": "u", "after": {"a": 1}}), ("s.x", {"op": "u"})))
    rows = both.orderBy("seq").collect()
    assert [(r.seq, r.type) for r in rows] == [(-1, "read"), (0, "update")]
    assert set(rows[0].after) == {"source_table", "operate_type"}
    assert snapshot_changes(table, "d", "t", 4).first().seq == 4


def test_wrapped_records_and_tombstones(spark):
    from tidewater.operators.changes import drop_deletes, parse_envelopes
    from tidewater.sources.feeds import change_feed

    texts = [
        '{"schema": {"type": "struct"}, "payload": {"op": "c", "before": null, "after": {"id": 1}}}',
        '{"op": "d", "before": {"id": 1}, "after": null}',
        None,
        '{"payload": null}',
    ]
    rows = spark.createDataFrame([("srv.shop.t", t, i) for i, t in enumerate(texts)], "topic string, value string, seq int")
    found = {r.seq: (r.type, r.reason, len(r.before), len(r.after)) for r in change_feed(rows).collect()}
    assert found == {0: ("insert", None, 0, 1), 1: ("delete", None, 1, 0), 3: (None, "bad_record", 0, 0)}
    broken = spark.createDataFrame([('{"type": "delete", "before": 5}',)], "value string")
    assert [r.reason for r in drop_deletes(parse_envelopes(broken)).collect()] == ["bad_envelope"]
