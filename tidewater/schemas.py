"""Schemas and fixed names shared by the operators."""

from __future__ import annotations

# Topic names, the key column default and the sink types a rule may carry.
RAW_LOG_TOPIC = "ods_base_log"
RAW_CHANGE_TOPIC = "ods_base_db"
START_TOPIC = "dwd_start_log"
PAGE_TOPIC = "dwd_page_log"
DISPLAY_TOPIC = "dwd_display_log"
DEFAULT_TOPIC = "DWD_DEFAULT_TOPIC"
DEFAULT_PK = "id"
TOPIC_SINKS = ("kafka", "topic")
DIM_SINKS = ("hbase", "dim")

# Our own output for records that cannot be processed.
DEAD_LETTER_TOPIC = "dead_letter"

# An object whose keys are only known per record; variant leaves keep the JSON types.
OPEN_OBJECT = "map<string,variant>"

ENVELOPE = (
    f"database string, tableName string, before {OPEN_OBJECT}, after {OPEN_OBJECT}, type string"
)

# A landed change record; its topic travels next to the text, not inside it.
CHANGE_RECORD = f"op string, before {OPEN_OBJECT}, after {OPEN_OBJECT}"

RULE_FIELDS = (
    "source_table",
    "operate_type",
    "sink_type",
    "sink_table",
    "sink_columns",
    "sink_pk",
    "sink_extend",
)

TOPIC_ROW = "key string, value string"
DIM_CELL = "pk string, column string, value string, seq bigint"

# What a catalog adds to the table of a dimension: its name's end, and columns of its own.
ROWS_SUFFIX = "__rows"
HIDDEN_COLUMNS = ("_key", "_seqs", "_bucket")
