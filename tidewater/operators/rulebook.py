"""The rules in force, followed one rule change after another.

Used where validity depends on what is in force at the time: per group of tables in batches,
and per lane in streams, where the two mappings are kept in state.
"""

from __future__ import annotations

import json
from bisect import bisect_right, insort
from collections.abc import Mapping, MutableMapping


def rule_key(source_table: str | None, operate_type: str | None) -> str:
    return json.dumps([source_table, operate_type])


class RuleBook:
    """Rule changes in the order of ``seq``; each is judged by the rules before it.

    ``history`` maps a rule key to its ``[seq, rule]`` pairs, where the rule is None once it is
    removed; ``tables`` maps a dimension to its first key, the spelling of its columns, and
    the keys of the rules in force. Both hold JSON values only.
    """

    def __init__(
        self, honor_deletes: bool, history: MutableMapping[str, list], tables: MutableMapping[str, dict], last_only: bool = False
    ) -> None:
        self.honor_deletes, self.history, self.tables, self.last_only = honor_deletes, history, tables, last_only

    def take(self, event: Mapping) -> str | None:
        """Apply one rule change; returns why it is rejected, or None."""
        key = rule_key(event["source_table"], event["operate_type"])
        reason = event["reason"]
        if reason is None and event["sink_type"] == "dim":
            reason = self._conflict(event)
        old = (event["old_source_table"], event["old_operate_type"])
        if self.honor_deletes and old != (None, None):
            moved = event["change_type"] == "update" and rule_key(*old) != key and reason is None
            if event["change_type"] == "delete" or moved:
                self._enter(rule_key(*old), event["seq"], None)
        if reason is None:
            body = {name: event[name] for name in ("sink_type", "sink_table", "columns", "sink_pk", "sink_extend")}
            self._enter(key, event["seq"], body)
        return reason

    def _conflict(self, event: Mapping) -> str | None:
        table = self.tables.get(event["sink_table"])
        if not table:
            return None
        owners = list(table["keys"].values()) if self.honor_deletes else [table["pk"]]
        if any(owner != event["sink_pk"] for owner in owners):
            return "other_pk"
        if any(table["names"].get(name.lower(), name) != name for name in event["columns"]):
            return "column_case"
        return None

    def _enter(self, key: str, seq: int, rule: dict | None) -> None:
        entries = self.history.get(key) or []
        before = entries[-1][1] if entries else None
        if before and before["sink_type"] == "dim":
            table = self.tables[before["sink_table"]]
            table["keys"].pop(key, None)
            self.tables[before["sink_table"]] = table
        if rule and rule["sink_type"] == "dim":
            table = self.tables.get(rule["sink_table"]) or {"pk": rule["sink_pk"], "names": {}, "keys": {}}
            table["keys"][key] = rule["sink_pk"]
            for name in rule["columns"]:
                table["names"].setdefault(name.lower(), name)
            self.tables[rule["sink_table"]] = table
        if self.last_only:
            entries = []
        insort(entries, [seq, rule], key=lambda entry: entry[0])
        self.history[key] = entries


def rule_at(entries: list, seq: int | None) -> dict | None:
    """The rule in force at ``seq`` among the entries of its key."""
    place = 0 if seq is None else bisect_right(entries, seq, key=lambda entry: entry[0])
    return entries[place - 1][1] if place else None
