import random

import pytest
from pyspark.sql import functions as F

from tidewater.operators import rules as U
from tidewater.operators.ordered import with_order
from tidewater.operators.rulebook import RuleBook

BOUND = (
    "seq bigint, source_table string, operate_type string, sink_type string, sink_table string, sink_columns string, "
    "sink_pk string, sink_extend string, change_type string, old_source_table string, old_operate_type string"
)


@pytest.mark.parametrize("window_rows", [1000, 40])
def test_order_within_keys_does_not_depend_on_ranges(spark, window_rows):
    rnd = random.Random(2)
    rows = [(rnd.choice(["hot", "hot", "hot", "a", None]), rnd.randrange(100), i) for i in range(400)]
    found = with_order(spark.createDataFrame(rows, "k string, at bigint, n bigint"), ["k"], "at", window_rows).collect()
    groups = {}
    for k, at, n in sorted(rows, key=lambda r: (r[1], r[2])):
        groups.setdefault(k, []).append((at, n))
    expected = {
        (k, at, n, i, group[i + 1][0] if i + 1 < len(group) else None)
        for k, group in groups.items()
        for i, (at, n) in enumerate(group)
    }
    assert {tuple(r) for r in found} == expected and len(found) == 400
    assert with_order(spark.createDataFrame([], "k string, at bigint"), ["k"], "at").count() == 0


def history(rnd, count, tables, keys):
    """Random changes of a rule table: new, changed, moved and deleted rules."""
    present, rows = {}, []
    for seq in range(count):
        kind = rnd.choice(["insert", "insert", "update", "delete"])
        key = (rnd.choice(keys), rnd.choice(["insert", "update"]))
        old = rnd.choice(sorted(present)) if kind != "insert" and present else (None, None)
        if old == (None, None):
            kind = "insert"
        body = (None,) * 6
        if kind != "delete":
            pk = rnd.choice(["id", "id", "x", "absent"])
            body = (rnd.choice(["dim", "dim", "topic"]), rnd.choice(tables), rnd.choice(["id,x", "x,id,y"]), pk, None)
            body = (*key, *body)
            present[key] = True
        else:
            body = (None,) * 7
        rows.append((seq, *body, kind, *old))
    return rows


@pytest.mark.parametrize(("tables", "keys"), [(["a", "b", "c"], ["s", "t", "u"]), ([f"d{i}" for i in range(20)], [f"s{i}" for i in range(20)])])
def test_keys_in_force_equal_one_pass_over_all_changes(spark, tables, keys):
    rows = history(random.Random(len(keys)), 300, tables, keys)
    bound = spark.createDataFrame(rows, BOUND)
    judged = {r.seq: r.reason for r in U.validate_rules(bound, honor_deletes=True).collect()}
    book, expected = RuleBook(True, {}, {}), {}
    for event in sorted(U.reject_other_keys(U.checked_rules(bound), keys=False).collect(), key=lambda r: r.seq):
        expected[event.seq] = book.take(event.asDict())
    assert judged == expected
    assert {"other_pk", "pk_not_in_columns", "empty_rule", None} <= set(expected.values())
    now = {(r.source_table, r.operate_type): r.seq for r in U.current_rules(U.validate_rules(bound, honor_deletes=True), True).collect()}
    pks = {}
    for r in U.validate_rules(bound, honor_deletes=True).where("sink_type = 'dim'").collect():
        if r.seq in now.values():
            pks.setdefault(r.sink_table, set()).add(r.sink_pk)
    assert pks and all(len(found) == 1 for found in pks.values())


@pytest.mark.parametrize("fanout", [2, 16])
def test_long_histories_are_looked_up_in_steps(spark, fanout):
    rnd = random.Random(fanout)
    rules = [(seq, rnd.choice(["hot", "hot", "t", None]), rnd.choice(["insert", None]), seq) for seq in range(0, 900, 3)]
    gone = {seq for seq, *_ in rules if seq % 5 == 0}
    schema = "seq bigint, source_table string, operate_type string, n bigint"
    events = spark.createDataFrame(rules, schema)
    body = F.struct(
        F.lit("topic").alias("sink_type"), F.col("n").cast("string").alias("sink_table"), F.array(F.lit("id")).alias("columns"),
        F.lit(None).cast("string").alias("sink_pk"), F.lit("").alias("sink_extend"),
    )
    events = events.select("source_table", "operate_type", "seq", F.when(F.col("seq") % 5 != 0, body).alias("rule"))
    spans = with_order(events, U.RULE_KEY, "seq").where("rule IS NOT NULL")
    spans = spans.select(*U.RULE_KEY, "rule.*", F.col("seq").alias("valid_from"), F.col("following").alias("valid_to"))
    changes = [(seq, rnd.choice(["hot", "t", "none", None]), rnd.choice(["insert", None, "read"])) for seq in [*range(-2, 905), None]]
    frame = spark.createDataFrame(changes, "seq bigint, tableName string, type string")
    frame = frame.withColumn("after", F.from_json(F.lit('{"id": 1}'), "map<string,variant>"))
    found = U.route_changes_asof(frame, spans, fanout=fanout).collect()
    assert len(found) == len(changes)
    for row in found:
        before = [r for r in rules if r[1:3] == (row.tableName, row.type) and row.seq is not None and r[0] <= row.seq]
        rule = before[-1] if before and before[-1][0] not in gone else None
        assert (row.sink_table, row.reason) == ((str(rule[3]), None) if rule else (None, "no_rule"))


def test_plans_of_lookups_do_not_shuffle_the_changes(spark):
    spans = spark.createDataFrame(
        [("t", "insert", "topic", "x", ["id"], None, "", i, i + 1) for i in range(50)],
        "source_table string, operate_type string, sink_type string, sink_table string, columns array<string>, "
        "sink_pk string, sink_extend string, valid_from bigint, valid_to bigint",
    )
    frame = spark.range(100).select(
        F.col("id").alias("seq"), F.substring(F.lit("tu"), F.lit(1), (F.col("id") % 2 + 1).cast("int")).alias("tableName"),
        F.when(F.col("id") >= 0, "insert").alias("type"),
        F.from_json(F.lit('{"id": 1}'), "map<string,variant>").alias("after"),
    )
    routed = U.route_changes_asof(frame, spans)
    plan = routed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 2 and "hashpartitioning" not in plan and "NestedLoop" not in plan
    assert routed.where("reason IS NULL").count() == 25
