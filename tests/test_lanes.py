import json
import random
import time

import pytest
from pyspark.sql import functions as F

from tidewater.operators import changes as C
from tidewater.operators import rules as U
from tidewater.sinks.dim_store import DimStore
from tidewater.sources.topics import FileTopics
from tidewater.streaming import jobs
from tidewater.streaming.lanes import LANE_ROWS, lanes_for

MESSAGE = "topic string, key string, value string"
ONCE = {"once": True}


def envelope(table, kind, after=None, before=None):
    body = {"database": "d", "tableName": table, "type": kind, "before": before or {}, "after": after or {}}
    return json.dumps(body)


def rule(source, operate, sink, target, columns, pk=None, kind="insert", old=None):
    names = ("source_table", "operate_type", "sink_type", "sink_table", "sink_columns", "sink_pk")
    after = dict(zip(names, (source, operate, sink, target, columns, pk))) if source else None
    return envelope("rules", kind, after, dict(zip(names, old)) if old else None)


class Feeds:
    """Changes and rules as files that arrive one after another, and the job over them."""

    def __init__(self, spark, root, lanes=3):
        self.spark, self.root, self.lanes, self.batches = spark, root, lanes, 0
        self.sink, self.store = FileTopics(f"{root}/out"), DimStore(f"{root}/dims")

    def add(self, topic, rows):
        frame = self.spark.createDataFrame([(topic, str(seq), text) for seq, text in rows], MESSAGE)
        FileTopics(f"{self.root}/{topic}").write_batch(frame.coalesce(1), self.batches)
        self.batches += 1
        time.sleep(0.05)

    def run(self, trigger=None, **options):
        messages, rules = (
            FileTopics(f"{self.root}/{name}", 1 if trigger is None else None)
            .stream(self.spark, name)
            .withColumn("seq", F.col("key").try_cast("bigint"))
            for name in ("changes", "rules")
        )
        query = jobs.start_connected_job(
            messages, rules, self.sink, self.store, f"{self.root}/checkpoint", self.lanes, order_by=("key",),
            trigger=trigger or {"availableNow": True}, **options,
        )
        query.awaitTermination()
        return query

    def published(self):
        rows = self.sink.read(self.spark, ".*", pattern=True).collect()
        return sorted((r.topic, r.key, json.loads(r.value).get("reason") if r.topic == "dead_letter" else r.value) for r in rows)


def rule_changes(rnd, seqs):
    """A history of rules with deletions, moves, other keys and broken texts."""
    present, out = {}, []
    for seq in seqs:
        kind = rnd.choice(["insert", "insert", "update", "delete", "broken"])
        if kind == "broken":
            out.append((seq, "{broken"))
            continue
        old = rnd.choice(sorted(present)) if kind != "insert" and present else None
        key = (rnd.choice("tuv"), rnd.choice(["insert", "update"]))
        sink = rnd.choice([("kafka", rnd.choice("ab"), "id,n", None), ("hbase", "dim", "id,n", rnd.choice(["id", "id", "n"]))])
        if kind == "delete" and old:
            out.append((seq, rule(None, None, None, None, None, kind="delete", old=old)))
        else:
            out.append((seq, rule(*key, *sink, kind="update" if old else "insert", old=old)))
            present[key] = True
    return out


@pytest.mark.parametrize("honor_deletes", [False, True])
def test_random_cuts_and_restarts_equal_the_batch(spark, tmp_path, honor_deletes):
    rnd = random.Random(6)
    rules = rule_changes(rnd, range(0, 200, 5))
    taken = {seq for seq, _ in rules}
    changes = [
        (seq, envelope(rnd.choice("tttuvw"), rnd.choice(["insert", "update", "delete"]), {"id": seq, "n": "x", "z": 1}))
        for seq in range(210)
        if seq not in taken
    ]
    changes[7] = (changes[7][0], "{broken")
    feeds = Feeds(spark, str(tmp_path))
    cuts = [0, *sorted(rnd.sample(range(1, 200), 4)), 300]
    parts = [[[(s, v) for s, v in rows if a <= s < b] for rows in (changes, rules)] for a, b in zip(cuts, cuts[1:])]
    for at, (some, new) in enumerate(parts):
        feeds.add("changes", rnd.sample(some, len(some)))
        feeds.add("rules", rnd.sample(new, len(new)))
        if at in (2, 4):
            feeds.run(honor_deletes=honor_deletes)
    frame = lambda rows: C.parse_envelopes(spark.createDataFrame(rows, "seq bigint, value string"))
    bound = U.validate_rules(U.bind_rules(frame(rules).where("reason IS NULL")), honor_deletes=honor_deletes)
    routed = U.route_changes_asof(C.drop_deletes(frame(changes)), U.rule_intervals(bound, honor_deletes)).collect()
    expected = [("dead_letter", str(r.seq), r.reason) for r in routed if r.reason]
    expected += [
        (r.sink_table, str(r.seq), None) for r in routed if not r.reason and r.sink_type == "topic"
    ]
    bad = U.dirty_rules(bound, honor_deletes).collect()
    expected += [("dead_letter", f"rule/{r.seq}/{r.reason}", r.reason) for r in bad]
    expected += [("dead_letter", f"rule/{seq}/bad_envelope", "bad_envelope") for seq, text in rules if text == "{broken"]
    found = [(topic, key, value if topic == "dead_letter" else None) for topic, key, value in feeds.published()]
    assert sorted(found, key=str) == sorted(expected, key=str)
    dims = sorted(r.id for r in feeds.store.table(spark, "dim", ("id", "n")).collect())
    latest = {r.pk: str(r.seq) for r in sorted(routed, key=lambda r: r.seq) if not r.reason and r.sink_type == "dim"}
    assert dims == sorted(latest.values()) and dims
    assert any(r.reason is None for r in routed) and any(r.reason == "no_rule" for r in routed)


def test_changes_wait_for_their_rule_over_restarts(spark, tmp_path):
    feeds = Feeds(spark, str(tmp_path))
    day = 24 * 3600 * 1000
    feeds.add("rules", [(50, rule("u", "insert", "kafka", "u_facts", "id"))])
    feeds.add("changes", [(i, envelope("t" if i % 2 else "u", "insert", {"id": i})) for i in range(40)] + [(99, "{bad")])
    feeds.run(ONCE, wait_ms=day)
    # The rule of u is younger than its changes, which still take it.
    assert feeds.published() == sorted(
        [("u_facts", str(i), json.dumps({"id": i}, separators=(",", ":"))) for i in range(0, 40, 2)] + [("dead_letter", "99", "bad_envelope")]
    )
    feeds.add("rules", [(60, rule("t", "insert", "kafka", "t_facts", "id")), (70, rule("t", "insert", "kafka", "later", "id"))])
    feeds.add("changes", [(i, envelope("t", "insert", {"id": i})) for i in (5000, 61)])
    feeds.run(ONCE, wait_ms=day)
    feeds.run(ONCE, wait_ms=day)
    found = [(topic, key) for topic, key, _ in feeds.published()]
    assert sorted(key for topic, key in found if topic == "t_facts") == sorted(map(str, [*range(1, 40, 2), 61]))
    assert [key for topic, key in found if topic == "later"] == ["5000"] and len(found) == 43


def test_changes_that_waited_too_long_are_dead_letters(spark, tmp_path):
    feeds = Feeds(spark, str(tmp_path))
    feeds.add("rules", [(1, rule("u", "insert", "kafka", "u", "id"))])
    feeds.add("changes", [(i, envelope("t", "insert", {"id": i})) for i in range(10)])
    feeds.run(ONCE, wait_ms=1)
    time.sleep(0.2)
    feeds.add("changes", [(20, envelope("u", "insert", {"id": 20}))])
    feeds.run(ONCE, wait_ms=1)
    assert feeds.published() == sorted([("dead_letter", str(i), "no_rule") for i in range(10)] + [("u", "20", '{"id":20}')])
    feeds.add("rules", [(30, rule("t", "insert", "kafka", "t", "id"))])
    feeds.run(ONCE, wait_ms=1)
    assert len(feeds.published()) == 11  # nothing waits any more


def test_large_and_missing_order(spark, tmp_path):
    """Positions beyond 2**53 stay apart, also beside a message whose position is not a number."""
    feeds, base = Feeds(spark, str(tmp_path)), 2**60
    rules = [(base + i, rule("t", "insert", "kafka", f"v{i}", "id")) for i in range(4)]
    feeds.add("rules", rules)
    rows = [(base + i, envelope("t", "insert", {"id": i})) for i in range(4)]
    feeds.add("changes", [*rows, ("x", envelope("t", "insert", {"id": 9}))])
    feeds.run()
    assert feeds.published() == sorted(
        [(f"v{i}", str(base + i), json.dumps({"id": i}, separators=(",", ":"))) for i in range(4)] + [("dead_letter", "x", "no_rule")]
    )


def test_waiting_needs_a_trigger_that_goes_on(spark, tmp_path):
    feeds = Feeds(spark, str(tmp_path))
    feeds.add("rules", [(1, rule("u", "insert", "kafka", "u", "id"))])
    feeds.add("changes", [(2, envelope("u", "insert", {"id": 1}))])
    with pytest.raises(ValueError):
        feeds.run(wait_ms=1)


def test_lanes_grow_with_the_messages_of_a_batch():
    assert lanes_for(5, 8) == 8
    assert lanes_for(LANE_ROWS * 50, 8) == 50
    assert lanes_for(LANE_ROWS * 50 + 1, 8) == 51
