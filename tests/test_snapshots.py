import json
import random

import pytest

from tidewater.operators import changes as C
from tidewater.sources.feeds import change_feed, changed_meanwhile, rule_feed_letters, snapshot_with_changes

KEYS = ("a", "b")


def state_after(events, state=None):
    """Rows by key after changes ``(seq, kind, key, value)``."""
    state = dict(state or {})
    for _, kind, key, value in events:
        if kind == "delete":
            state.pop(key, None)
        else:
            state[key] = value
    return state


def histories(rnd, count):
    """Changes of a table with one very busy key, in positions that leave room for marks."""
    present, events = set(), []
    keys = [("hot", None)] * 6 + [(f"k{i}", rnd.choice(["x", "O'Brien"])) for i in range(12)]
    for i in range(count):
        key = rnd.choice(keys)
        kind = rnd.choice(["update", "update", "delete"]) if key in present else "insert"
        (present.discard if kind == "delete" else present.add)(key)
        events.append((i * 10, kind, key, f"v{i}"))
    return events


def record(kind, key, value):
    image = {"a": key[0], "b": key[1], "v": value}
    return json.dumps({"op": kind, "before": image if kind != "insert" else None, "after": None if kind == "delete" else image})


@pytest.mark.parametrize("seed", range(4))
def test_feed_of_a_table_read_while_it_changes(spark, seed):
    """Chunks are read at any time between marks that may overlap; the feed gives the state of all changes."""
    rnd = random.Random(seed)
    events = histories(rnd, 200)
    chunk_of = {}
    marks, rows = [], []
    for chunk in range(3):
        low = rnd.randrange(20, 150) * 10 + 5
        high = low + rnd.randrange(0, 40) * 10
        read_at = rnd.randrange(low, high + 1)
        marks.append((chunk, low, high))
        state = state_after([e for e in events if e[0] <= read_at])
        for key, value in state.items():
            if chunk_of.setdefault(key, rnd.randrange(3)) == chunk:
                rows.append((chunk, *key, value))
    # A key belongs to one chunk, also where it had no row when that was read.
    rows = [row for row in rows if chunk_of[row[1:3]] == row[0]]
    feed = change_feed(spark.createDataFrame([("s.d.t", record(*e[1:]), e[0]) for e in events], "topic string, value string, seq bigint"))
    chunks = spark.createDataFrame(rows, "chunk int, a string, b string, v string")
    frame = snapshot_with_changes(chunks, spark.createDataFrame(marks, "chunk int, low bigint, high bigint"), C.good_changes(feed), KEYS, "d", "t")
    found = frame.selectExpr(
        "seq", "row", "type", "try_variant_get(coalesce(after['a'], before['a']), '$', 'string') AS a",
        "try_variant_get(coalesce(after['b'], before['b']), '$', 'string') AS b", "try_variant_get(after['v'], '$', 'string') AS v",
    ).orderBy("seq", "row").collect()
    assert len({(r.seq, r.row) for r in found}) == len(found)
    first = min(low for _, low, _ in marks)
    assert [r.seq for r in found if r.row == 0] == [e[0] for e in events if e[0] > first]
    read = [r for r in found if r.type == "read"]
    assert len({(r.a, r.b) for r in read}) == len(read)
    low_of = {low: high for _, low, high in marks}
    for r in read:
        assert not [e for e in events if e[2] == (r.a, r.b) and r.seq < e[0] <= low_of[r.seq]]
    state = state_after([(r.seq, "delete" if r.type == "delete" else "set", (r.a, r.b), r.v) for r in found])
    assert state == state_after(events)


def test_changes_are_not_gathered_on_the_driver(spark):
    """However small Spark takes the changes to be, and whatever it would broadcast."""
    rows = [("s.d.t", record("update", ("k", "x"), "v"), 9), ("s.d.t", record("update", ("l", "x"), "v"), 20)]
    changes = C.good_changes(change_feed(spark.createDataFrame(rows, "topic string, value string, seq bigint")))
    spans = spark.createDataFrame(
        [(0, ("k", "x"), 5, 15), (0, ("l", "x"), 5, 15)], "chunk int, key struct<a: string, b: string>, low bigint, high bigint"
    )
    found = changed_meanwhile(spans, changes, KEYS)
    assert [tuple(row.key) for row in found.collect()] == [("k", "x")]
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()


def test_bad_records_of_the_rule_feed_are_dead_letters(spark):
    rows = [("s.rules.rules", "{broken", 1), ("s", record("insert", ("k", "x"), "v"), 2), ("s.rules.rules", record("insert", ("k", "x"), "v"), 3)]
    feed = change_feed(spark.createDataFrame(rows, "topic string, value string, seq bigint"))
    letters = {r.seq: (r.reason, r.stage) for r in rule_feed_letters(feed).collect()}
    assert letters == {1: ("bad_record", "rule_feed"), 2: ("short_topic", "rule_feed")}


def test_empty_snapshots(spark):
    feed = C.good_changes(change_feed(spark.createDataFrame([("s.d.t", record("insert", ("k", "x"), "v"), 9)], "topic string, value string, seq bigint")))
    chunks = spark.createDataFrame([], "chunk int, a string, b string, v string")
    marks = spark.createDataFrame([(0, 5, 5)], "chunk int, low bigint, high bigint")
    for marks in (marks, marks.where("false")):
        assert [(r.seq, r.row, r.type) for r in snapshot_with_changes(chunks, marks, feed, KEYS, "d", "t").collect()] == [(9, 0, "insert")]
