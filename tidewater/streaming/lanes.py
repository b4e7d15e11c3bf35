"""Routing in a stream by rules that are a stream themselves, kept in the state of every lane.

Changes are dealt to lanes by a hash of their message, so that no table and no key fills a
lane of its own; every rule change goes to all lanes. A lane applies the rule changes of a
micro-batch in the order of ``seq`` before it looks at its changes, keeps the history of each
rule key, and gives a change the rule that was in force at its ``seq``. No batch reads the
rule table again, and a batch without rule changes does nothing for them.

A change whose key has no rule yet may wait: it stays in the lane until a rule of its key
arrives, and becomes a dead letter when none does in time. While changes may wait, one that
is older than the first rule of its key takes that rule, whichever of them arrived first.

A lane holds its share of one micro-batch in memory while it is routed; the limits of the
sources and the number of lanes set how much that is; see :func:`lanes_for`.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidewater.functions import jsonops as J
from tidewater.operators.changes import drop_deletes, parse_envelopes
from tidewater.operators.rulebook import RuleBook, rule_key
from tidewater.operators.rules import RULE_BODY, RULE_KEY, bind_rules, checked_rules, routed_by

RULE, CHANGE, TABLE = 0, 1, 2
LANE_ROW = "kind int, seq bigint, source_table string, operate_type string, origin string, body string, reason string"
WAITING = "seq bigint, source_table string, operate_type string, origin string, body string, arrived bigint"
# Stands for no ``seq`` inside the lanes, where a NULL would turn the numbers into floats.
NO_SEQ = -(1 << 63)
EVENT = (*RULE_KEY, *RULE_BODY, "change_type", "old_source_table", "old_operate_type")
# Messages of a micro-batch that a lane should hold.
LANE_ROWS = 100_000
TIME_FORMAT = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
BODY = "sink_type string, sink_table string, columns array<string>, sink_pk string, sink_extend string"


def lanes_for(batch_rows: int, parallelism: int) -> int:
    """Lanes for micro-batches of up to ``batch_rows`` messages, at least one per core."""
    return max(parallelism, -(-batch_rows // LANE_ROWS))


def lane_rules(messages: DataFrame, lanes: int, trim_columns: bool = False) -> DataFrame:
    """Messages of the rule topic (``value, seq``) for all lanes, with what is wrong with them by themselves."""
    parsed = parse_envelopes(messages)
    bound = checked_rules(bind_rules(parsed, keep=("value", "reason")).withColumnRenamed("reason", "broken"), trim_columns)
    event = F.to_json(F.struct(*EVENT), {"ignoreNullFields": "false"})
    broken = F.col("broken").isNotNull()
    rows = bound.select(
        F.lit(RULE).alias("kind"), _numbered("seq"), *RULE_KEY, F.lit(None).cast("string").alias("origin"),
        F.when(broken, F.col("value")).otherwise(event).alias("body"), F.coalesce("broken", "reason").alias("reason"),
    )
    return rows.withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))))


def lane_changes(messages: DataFrame, lanes: int, order_by: Sequence[str], seq: str) -> DataFrame:
    """Messages with envelopes, without deletions, each in one lane."""
    parsed = drop_deletes(parse_envelopes(messages))
    return parsed.select(
        F.lit(CHANGE).alias("kind"), _numbered(seq), F.col("tableName").alias("source_table"),
        F.col("type").alias("operate_type"), F.to_json(F.struct(*order_by), TIME_FORMAT).alias("origin"), F.col("value").alias("body"),
        "reason", F.pmod(F.xxhash64(*order_by), F.lit(lanes)).cast("int").alias("lane"),
    )


def _numbered(seq: str) -> Column:
    return F.coalesce(F.col(seq).cast("bigint"), F.lit(NO_SEQ)).alias("seq")


def connect_rules(
    messages: DataFrame,
    rule_messages: DataFrame,
    lanes: int,
    order_by: Sequence[str] = ("seq",),
    seq: str = "seq",
    honor_deletes: bool = False,
    trim_columns: bool = False,
    wait_ms: int | None = None,
) -> DataFrame:
    """Rows of three kinds: routed changes, rejected rule changes, and tables that rules ask for.

    A change has its ``order_by`` columns back in ``origin`` and its rule as text. With
    ``wait_ms`` the query has no last batch, so it needs a trigger other than ``availableNow``.
    """
    rows = lane_rules(rule_messages, lanes, trim_columns).unionByName(lane_changes(messages, lanes, order_by, seq))
    connected = rows.groupBy("lane").transformWithStateInPandas(
        statefulProcessor=rule_lane(honor_deletes, wait_ms),
        outputStructType=T.StructType.fromDDL(f"{LANE_ROW}, rule string"),
        outputMode="Append",
        timeMode="ProcessingTime" if wait_ms else "None",
    )
    return connected.withColumn("seq", F.nullif("seq", F.lit(NO_SEQ)))


def connected_changes(connected: DataFrame, order_fields: T.StructType) -> DataFrame:
    """The changes among the rows, routed: what ``route_changes`` gives, with the text and the ``order_by`` columns."""
    rows = connected.where(F.col("kind") == CHANGE).withColumnsRenamed({"body": "value", "reason": "earlier"})
    rows = rows.withColumn("origin", F.from_json("origin", order_fields, TIME_FORMAT))
    parsed = J.with_computed(parse_envelopes(rows).drop("reason"), body=F.from_json("rule", BODY))
    order = [f"origin.{name}" for name in order_fields.names if name not in parsed.columns]
    plain = parsed.select("seq", *order, "value", "database", "tableName", "before", "after", "type", "earlier", "body.*")
    return routed_by(plain, [name for name in plain.columns if name not in ("earlier", *RULE_BODY)])


def rejected_rules(connected: DataFrame) -> DataFrame:
    """Dead letters of the rule feed: ``value, reason, stage, seq``."""
    bad = connected.where(F.col("kind") == RULE)
    return bad.select(F.col("body").alias("value"), "reason", F.lit("validate_rules").alias("stage"), "seq")


def wanted_tables(connected: DataFrame) -> DataFrame:
    """Definitions of dimension tables that rules ask for."""
    rows = connected.where(F.col("kind") == TABLE).select("seq", F.from_json("body", BODY).alias("rule"))
    return rows.select("rule.sink_table", "rule.sink_pk", "rule.columns", "rule.sink_extend")


def rule_lane(honor_deletes: bool, wait_ms: int | None) -> StatefulProcessor:
    """Processor of one lane. Defined in a function so that it travels to the workers by value."""
    texts = T.StructType([T.StructField("text", T.StringType())])
    names = T.StructType.fromDDL(f"{LANE_ROW}, rule string").names
    waiting_fields = T.StructType.fromDDL(WAITING)
    waiting_names = waiting_fields.names

    class TextMap:
        """JSON values in a map state; what is read is kept until the batch ends."""

        def __init__(self, state) -> None:
            self.state, self.known = state, {}

        def get(self, key):
            if key not in self.known:
                stored = self.state.getValue((key,)) if self.state.containsKey((key,)) else None
                self.known[key] = json.loads(stored[0]) if stored else None
            return self.known[key]

        def __getitem__(self, key):
            return self.get(key)

        def __setitem__(self, key, value) -> None:
            self.known[key] = value
            self.state.updateValue((key,), (json.dumps(value),))

    class RuleLane(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            self.history_state = handle.getMapState("history", texts, texts)
            self.table_state = handle.getMapState("tables", texts, texts)
            self.waiting = handle.getListState("waiting", waiting_fields)

        def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
            rules, changes = [], []
            for chunk in rows:
                is_rule = chunk["kind"] == RULE
                if is_rule.any():
                    rules.append(chunk[is_rule])
                if not is_rule.all():
                    changes.append(chunk[~is_rule])
            history = TextMap(self.history_state)
            if rules:
                yield from self.learn(pd.concat(rules), history, report=key[0] == 0)
                if wait_ms:
                    yield from self.release(history)
            waiting = []
            for chunk in changes:
                found = self.with_rules(chunk.assign(rule=None), history)
                if wait_ms:
                    held = found["unknown"] & found["reason"].isna()
                    waiting.append(found[held])
                    found = found[~held]
                yield found[names]
            if waiting:
                self.hold(pd.concat(waiting), timerValues.getCurrentProcessingTimeInMs())

        def learn(self, rules: pd.DataFrame, history: TextMap, report: bool) -> Iterator[pd.DataFrame]:
            book = RuleBook(honor_deletes, history, TextMap(self.table_state))
            out = []
            for row in rules.sort_values(["seq", "body"]).to_dict("records"):
                broken = row["reason"] if isinstance(row["reason"], str) else None
                event = {} if broken == "bad_envelope" else json.loads(row["body"])
                reason = book.take({**event, "seq": int(row["seq"]), "reason": broken}) if event else broken
                deleted = honor_deletes and event.get("change_type") == "delete"
                if reason and not deleted:
                    out.append({**row, "kind": RULE, "reason": reason})
                elif event.get("sink_type") == "dim":
                    out.append({**row, "kind": TABLE, "source_table": event["sink_table"]})
            if report and out:
                yield pd.DataFrame(out).assign(rule=None)[names]

        def with_rules(self, chunk: pd.DataFrame, history: TextMap) -> pd.DataFrame:
            """``rule`` of every row, and whether its key has none yet."""
            rule = np.full(len(chunk), None, dtype=object)
            unknown = np.zeros(len(chunk), dtype=bool)
            seqs = chunk["seq"].to_numpy(dtype=np.int64)
            for (source, operate), places in chunk.groupby(list(RULE_KEY), dropna=False, sort=False).indices.items():
                entries = history.get(rule_key(*(None if pd.isna(name) else name for name in (source, operate))))
                if not entries:
                    unknown[places] = True
                    continue
                bodies = [None if body is None else json.dumps(body) for _, body in entries]
                at = np.searchsorted(np.array([seq for seq, _ in entries]), seqs[places], side="right") - 1
                at[seqs[places] == NO_SEQ] = -1
                early = next((body for body in bodies if body), None) if wait_ms else None
                rule[places] = np.array([*bodies, early], dtype=object)[at]
            return chunk.assign(rule=rule, unknown=unknown)

        def held(self) -> pd.DataFrame:
            return pd.DataFrame([tuple(row) for row in self.waiting.get()], columns=waiting_names)

        def hold(self, rows: pd.DataFrame, now: int) -> None:
            rows = rows.assign(arrived=now)[waiting_names]
            if len(rows):
                self.waiting.appendList(self.as_rows(rows))
                self.handle.registerTimer(now + wait_ms)

        @staticmethod
        def as_rows(rows: pd.DataFrame) -> list[tuple]:
            plain = rows.astype(object).where(rows.notna(), None)
            return [
                (int(seq), source, operate, origin, body, int(arrived))
                for seq, source, operate, origin, body, arrived in plain.itertuples(index=False, name=None)
            ]

        def keep(self, rows: pd.DataFrame) -> None:
            if len(rows):
                self.waiting.put(self.as_rows(rows))
            else:
                self.waiting.clear()

        def release(self, history: TextMap) -> Iterator[pd.DataFrame]:
            if not self.waiting.exists():
                return
            found = self.with_rules(self.held(), history)
            ready = found[~found["unknown"]]
            if len(ready):
                self.keep(found[found["unknown"]][waiting_names])
                yield ready.assign(kind=CHANGE, reason=None)[names]

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
            if not self.waiting.exists():
                return
            rows = self.held()
            late = rows["arrived"] <= timerValues.getCurrentProcessingTimeInMs() - wait_ms
            if late.any():
                self.keep(rows[~late])
                yield rows[late].assign(kind=CHANGE, reason=None, rule=None)[names]

        def close(self) -> None:
            pass

    return RuleLane()
