import json
import random

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from tidewater.operators import logs as L
from tidewater.plans.logs import log_outputs, publishable


def record(mid="m", is_new="0", **more):
    return json.dumps({"common": {"mid": mid, "is_new": is_new}, **more})


def outputs(df):
    rows = log_outputs(df).orderBy("seq", "branch").collect()
    return [(r.seq, r.topic, r.value, r.reason) for r in rows]


def flags(df, order_by=("seq",)):
    parsed = L.good_logs(L.parse_logs(df))
    return {r.seq: r.is_new for r in L.repair_is_new(parsed, order_by).collect()}


@pytest.mark.parametrize(
    ("text", "reason"),
    [
        ("{bad", "bad_json"),
        ("{'a':1}", "bad_json"),
        ("", "bad_json"),
        (None, "bad_json"),
        ("[1]", "not_object"),
        ('"x"', "not_object"),
        ("null", "not_object"),
        ("7", "not_object"),
        ('{"page":{"page_id":"p"}}', "no_mid"),
        ('{"common":{}}', "no_mid"),
        ('{"common":{"mid":null}}', "no_mid"),
        ('{"common":5}', "no_mid"),
    ],
)
def test_texts_that_are_no_log_become_dead_letters(logs, text, reason):
    assert outputs(logs(text)) == [(0, "dead_letter", text, reason)]


def test_dead_letters_keep_text_reason_and_stage(logs):
    dirty = L.dirty_logs(L.parse_logs(logs("{bad", record()))).collect()
    assert [r.asDict() for r in dirty] == [
        {"seq": 0, "value": "{bad", "reason": "bad_json", "stage": "parse_logs"}
    ]


@pytest.mark.parametrize("text", ["{bad", "[1]", '{"common":{}}'])
def test_strict_parsing_fails_the_job(logs, text):
    with pytest.raises((PySparkException, Py4JJavaError)):
        L.parse_logs(logs(text), strict=True).collect()


def test_strict_parsing_passes_good_records(logs):
    assert L.parse_logs(logs(record("a")), strict=True).first().mid == "a"


def test_zero_before_the_first_one_does_not_count_as_a_visit(logs):
    texts = [record(is_new=flag) for flag in ("0", "1", "1", "0", "1")]
    assert flags(logs(*texts)) == {0: "0", 1: "1", 2: "0", 3: "0", 4: "0"}


def test_flag_may_be_a_number(logs):
    found = flags(logs(record(is_new=1), record(is_new=1)))
    assert found == {0: "1", 1: "0"}


def test_missing_flag_passes_through(logs):
    text = json.dumps({"common": {"mid": "m"}, "start": {"a": 1}})
    assert outputs(logs(text)) == [(0, "dwd_start_log", text, None)]
    assert flags(logs(text)) == {0: None}


def test_records_without_branches_still_count_as_visits(logs):
    out = outputs(logs(record(is_new="1"), record(is_new="1", start={"a": 1})))
    assert [(seq, topic) for seq, topic, _, _ in out] == [(1, "dwd_start_log")]
    assert json.loads(out[0][2])["common"]["is_new"] == "0"


def test_order_by_several_columns(spark):
    rows = [(2, 0, 0, record(is_new="1")), (1, 9, 1, record(is_new="1")), (1, 3, 2, record(is_new="1"))]
    df = spark.createDataFrame(rows, "timestamp int, offset int, seq bigint, value string")
    assert flags(df, ("timestamp", "offset")) == {0: "0", 1: "0", 2: "1"}


def test_repair_equals_a_sequential_run(logs):
    rng = random.Random(7)
    mids = ["hot"] * 20 + list("abcdef")
    made = [(rng.choice(mids), rng.choice("01")) for _ in range(600)]
    seen, expected = set(), {}
    for seq, (mid, flag) in enumerate(made):
        expected[seq] = "0" if flag == "1" and mid in seen else flag
        if flag == "1":
            seen.add(mid)
    df = logs(*[record(mid, flag) for mid, flag in made]).repartition(5)
    assert flags(df) == expected


def test_repaired_text_changes_nothing_else(logs):
    body = {"page": {"page_id": "p", "n": None, "deep": {"x": [1, None, "é"]}}, "ts": 12345678901}
    out = outputs(logs(record(is_new="1", **body), record(is_new="1", **body)))
    first, second = (json.loads(value) for _, _, value, _ in out)
    assert first["common"] == {"mid": "m", "is_new": "1"}
    assert second["common"] == {"mid": "m", "is_new": "0"}
    assert {k: v for k, v in second.items() if k != "common"} == body


def test_branches_are_not_exclusive(logs):
    out = outputs(logs(record(start={"a": 1}, page={"page_id": "p"}, displays=[{"i": 1}, {"i": 2}])))
    assert [topic for _, topic, _, _ in out] == [
        "dwd_start_log",
        "dwd_page_log",
        "dwd_display_log",
        "dwd_display_log",
    ]


def test_empty_object_is_no_branch_but_a_null_valued_key_is(logs):
    out = outputs(logs(record(start={}), record(start={"a": None}), record(start=None), record(page={})))
    assert [(seq, topic) for seq, topic, _, _ in out] == [(1, "dwd_start_log")]


def test_displays_need_a_page_and_carry_only_its_id(logs):
    out = outputs(
        logs(
            record(displays=[{"i": 1}]),
            record(page={"page_id": "p"}, displays=[{"i": 1, "page_id": "old"}]),
            record(page={"page_id": 7}, displays=[{"i": 2}]),
            record(page={"x": 1}, displays=[{"i": 3, "page_id": "old"}]),
            record(page={"page_id": "p"}, displays=[]),
        )
    )
    shown = {seq: json.loads(value) for seq, topic, value, _ in out if topic == "dwd_display_log"}
    assert shown == {1: {"i": 1, "page_id": "p"}, 2: {"i": 2, "page_id": "7"}, 3: {"i": 3}}


def test_branches_of_the_wrong_type_are_reported_and_the_rest_is_kept(logs):
    out = outputs(
        logs(
            record(start=5, page={"page_id": "p"}),
            record(page=[1]),
            record(page={"page_id": "p"}, displays=5),
            record(page={"page_id": "p"}, displays=[{"i": 1}, 3, None]),
        )
    )
    assert [(seq, topic, reason) for seq, topic, _, reason in out] == [
        (0, "dwd_page_log", None),
        (0, "dead_letter", "bad_start"),
        (1, "dead_letter", "bad_page"),
        (2, "dwd_page_log", None),
        (2, "dead_letter", "bad_displays"),
        (3, "dwd_page_log", None),
        (3, "dwd_display_log", None),
        (3, "dead_letter", "bad_displays"),
    ]


def test_publishable_rows_have_distinct_keys(logs):
    df = logs(record(start={"a": 1}, page={"page_id": "p"}, displays=[{"i": 1}, {"i": 2}]), "{bad")
    rows = publishable(log_outputs(df), ("seq",), "log_job").collect()
    assert len({r.key for r in rows}) == len(rows) == 5
    letter = next(json.loads(r.value) for r in rows if r.topic == "dead_letter")
    assert letter == {"value": "{bad", "reason": "bad_json", "stage": "log_job", "seq": 1}


def test_repair_spreads_a_device_over_tasks(spark, logs):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = log_outputs(logs(record()))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Window" not in plan
    exchanges = [line for line in plan.splitlines() if "hashpartitioning(mid" in line]
    assert any("seq" in line for line in exchanges)
    assert "partial_min" in plan
