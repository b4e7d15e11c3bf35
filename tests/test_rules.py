import json

import pytest
from pyspark.sql import functions as F

from tidewater.operators import changes as C
from tidewater.operators import dims as D
from tidewater.operators import rules as U
from tidewater.session import broadcast_if_small
from verification import recipes as R

NAMES = ("source_table", "operate_type", "sink_type", "sink_table", "sink_columns", "sink_pk", "sink_extend")


@pytest.fixture
def envelopes(spark):
    """Envelope columns from dictionaries; ``seq`` counts from 1."""

    def make(*bodies):
        rows = [(i + 1, json.dumps({"database": "d", **body})) for i, body in enumerate(bodies)]
        df = spark.createDataFrame(rows, "seq bigint, value string")
        return C.parse_envelopes(df).drop("value")

    return make


@pytest.fixture
def rules(envelopes):
    def make(*values, kind="insert"):
        bodies = [{"type": kind, "after": {k: v for k, v in zip(NAMES, row) if v is not None}} for row in values]
        return U.bind_rules(envelopes(*bodies))

    return make


def reasons(bound, **options):
    return [r.reason for r in U.validate_rules(bound, **options).orderBy("seq").collect()]


def test_names_bind_in_any_case_style(envelopes):
    bound = U.bind_rules(
        envelopes(
            {"type": "insert", "after": {"sourceTable": "a", "OPERATE_TYPE": "insert", "Sink_Pk": 7}},
            {"type": "insert", "after": {"source_table": "b", "sourceTable": "c"}},
        )
    ).orderBy("seq").collect()
    assert (bound[0].source_table, bound[0].operate_type, bound[0].sink_pk) == ("a", "insert", "7")
    assert bound[1].source_table in ("b", "c")


def test_validation(rules):
    bound = rules(
        ("t", "insert", "hbase", "d", "id,name", None, None),
        ("t", "insert", "hbase", "d2", "name", None, None),
        ("t", "insert", "hbase", "d3", "a,b", "a,b", None),
        ("t", "insert", "kafka", None, "name", None, None),
        ("t", "insert", "kafka", "x", None, None, None),
        ("t", "insert", "hbase", None, "id", None, None),
        ("t", "insert", "hbase", "d4", "id,,x", None, None),
        ("t", "insert", "hbase", "d5", "id,ID", None, None),
        ("t", "update", "hbase", "d", "id,name", "name", None),
        ("t", "insert", "clickhouse", "c", "a", None, None),
        (None,) * 7,
    )
    assert reasons(bound) == [
        None, "pk_not_in_columns", "pk_not_in_columns", None, "no_columns", "no_table", "empty_column",
        "duplicate_column", "other_pk", None, "empty_rule",
    ]
    valid = U.validate_rules(bound).orderBy("seq").collect()
    assert (valid[0].sink_type, valid[0].sink_pk, valid[0].sink_extend) == ("dim", "id", "")
    assert (valid[3].sink_type, valid[3].sink_table) == ("topic", "DWD_DEFAULT_TOPIC")
    dead = U.dirty_rules(U.validate_rules(bound))
    assert dead.count() == 8 and json.loads(dead.orderBy("seq").first().value)["sink_table"] == "d2"


def test_spaces_in_columns_match_only_when_trimmed(rules, envelopes):
    bound = rules(("t", "insert", "kafka", "x", "id, name", None, None))
    change = envelopes({"tableName": "t", "type": "insert", "after": {"id": 1, "name": "n", "z": 0}})

    def published(**options):
        now = U.current_rules(U.validate_rules(bound, **options))
        return json.loads(U.topic_rows(U.route_changes(change, now)).first().value)

    assert published() == {"id": 1}
    assert published(trim_columns=True) == {"id": 1, "name": "n"}


def rule_body(kind, after=None, before=None):
    make = lambda values: dict(zip(NAMES, values)) if values else {}
    return {"type": kind, "after": make(after), "before": make(before)}


A = ("t", "insert", "kafka", "a", "id")
B = ("t", "insert", "kafka", "b", "id")
MOVED = ("t", "update", "kafka", "b", "id")


def current(envelopes, *bodies, **options):
    found = U.current_rules(U.validate_rules(U.bind_rules(envelopes(*bodies))), **options)
    return {(r.source_table, r.operate_type): r.sink_table for r in found.collect()}


def test_last_valid_rule_wins(envelopes):
    bad = ("t", "insert", "kafka", "c")
    assert current(envelopes, rule_body("insert", A), rule_body("update", B, A), rule_body("update", bad, B)) == {
        ("t", "insert"): "b"
    }


def test_deleted_rules_stay_unless_deletes_are_honoured(envelopes):
    bodies = (rule_body("insert", A), rule_body("delete", None, A))
    assert current(envelopes, *bodies) == {("t", "insert"): "a"}
    assert current(envelopes, *bodies, honor_deletes=True) == {}
    again = (*bodies, rule_body("insert", B))
    assert current(envelopes, *again, honor_deletes=True) == {("t", "insert"): "b"}


def test_moved_rules(envelopes):
    bodies = (rule_body("insert", A), rule_body("update", MOVED, A))
    assert current(envelopes, *bodies) == {("t", "insert"): "a", ("t", "update"): "b"}
    assert current(envelopes, *bodies, honor_deletes=True) == {("t", "update"): "b"}


def test_routing(rules, envelopes):
    now = U.current_rules(
        U.validate_rules(
            rules(
                ("t", "insert", "kafka", "facts", "id,v", None, None),
                ("t", "update", "hbase", "dims", "id,v", None, None),
                ("t", "read", "clickhouse", "x", "id", None, None),
                ("t", None, "kafka", "untyped", "id", None, None),
                ("t-insert", "x", "kafka", "collides", "id", None, None),
            )
        )
    )
    changes = envelopes(
        {"tableName": "t", "type": "insert", "after": {"id": 1, "v": "O'Brien", "z": 1}},
        {"tableName": "t", "type": "update", "after": {"id": 2, "v": None}},
        {"tableName": "t", "type": "read", "after": {"id": 3}},
        {"tableName": "t", "after": {"id": 4, "z": 1}},
        {"tableName": "u", "type": "insert", "after": {"id": 5}},
        {"tableName": "t", "type": "update", "after": {"v": "no key"}},
        {"tableName": "t", "type": "insert-x", "after": {"id": 7}},
    )
    routed = U.route_changes(changes, now)
    topics = {r.seq: (r.topic, json.loads(r.value)) for r in U.topic_rows(routed).collect()}
    assert topics == {1: ("facts", {"id": 1, "v": "O'Brien"}), 4: ("untyped", {"id": 4})}
    dims = [(r.sink_table, r.pk, sorted(r.payload), r.seq) for r in U.dim_rows(routed).collect()]
    assert dims == [("dims", "2", ["id", "v"], 2)]
    dead = {r.seq: r.reason for r in U.unrouted_changes(routed).collect()}
    assert dead == {3: "unknown_sink_type", 5: "no_rule", 6: "null_pk", 7: "no_rule"}


def test_dead_parse_results_pass_through_routing(spark, rules):
    df = spark.createDataFrame([(1, "{bad")], "seq bigint, value string")
    now = U.current_rules(U.validate_rules(rules(A + (None, None))))
    dead = U.unrouted_changes(U.route_changes(C.drop_deletes(C.parse_envelopes(df)), now)).collect()
    assert [(r.value, r.reason, r.stage) for r in dead] == [("{bad", "bad_envelope", "parse_envelopes")]


def test_asof_uses_the_rule_in_force(rules, envelopes):
    history = U.validate_rules(rules(*[("t", "insert", "kafka", f"v{i}", "id", None, None) for i in range(3)]))
    spans = U.rule_intervals(history.withColumn("seq", history.seq * 10))
    changes = envelopes(*[{"tableName": "t", "type": "insert", "after": {"id": i}} for i in range(35)])
    found = {r.seq: r.sink_table for r in U.route_changes_asof(changes, spans).collect()}
    assert found == {s: None if s < 10 else f"v{min(s // 10, 3) - 1}" for s in range(1, 36)}


def test_small_rule_tables_are_broadcast_and_large_ones_are_not(spark, rules, envelopes, monkeypatch):
    now = U.current_rules(U.validate_rules(rules(A + (None, None))))
    change = envelopes({"tableName": "t", "type": "insert", "after": {"id": 1}})
    plan = lambda: U.route_changes(change, now)._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in plan()
        monkeypatch.setattr(U, "broadcast_if_small", lambda df: broadcast_if_small(df, limit_bytes=10))
        assert "BroadcastHashJoin" not in plan()
        assert U.topic_rows(U.route_changes(change, now)).first().topic == "a"
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_dimension_definitions_keep_first_mention_order(rules):
    validated = U.validate_rules(
        rules(
            ("t", "insert", "hbase", "d", "id,b", None, "comment=x"),
            ("t", "update", "hbase", "d", "a,id,b,c", None, "comment=y"),
            ("t", "read", "kafka", "d", "z", None, None),
        )
    )
    rows = D.dim_definitions(validated).collect()
    assert [r.asDict() for r in rows] == [
        {"sink_table": "d", "sink_pk": "id", "columns": ["id", "b", "a", "c"], "sink_extend": "comment=x"}
    ]


def test_rules_are_followed_in_a_task_per_number_of_rows(spark, tmp_path):
    """Not per number of bytes, of which they have few."""
    spark.range(40).select(F.col("id").alias("p_partkey")).coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    rules = U.validate_rules(U.bind_rules(R.rules_of_deleted_keys(spark, str(tmp_path))), honor_deletes=True)
    assert "REPARTITION_BY_NUM" in rules._jdf.queryExecution().executedPlan().toString()
    assert rules.count() == 100
    assert rules.where("reason = 'other_pk'").count() == 20


def test_a_table_in_one_file_is_dealt_out(spark, tmp_path):
    spark.range(R.FEW_ROWS * 2).coalesce(1).write.parquet(f"{tmp_path}/t.parquet")
    rows = R.table(spark, str(tmp_path), "t")
    assert rows.rdd.getNumPartitions() == 2
    assert rows.agg(F.count("*"), F.countDistinct("id")).first() == (R.FEW_ROWS * 2, R.FEW_ROWS * 2)
