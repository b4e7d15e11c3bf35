"""Change-record operators: normalise to one envelope, serialise, parse, drop deletes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions import jsonops as J
from tidewater.functions.encoded import decoded, encoded_fields
from tidewater.schemas import CHANGE_RECORD, ENVELOPE

ENVELOPE_COLUMNS = ("database", "tableName", "before", "after", "type")

# Operation names that differ from the envelope's, and their short codes.
OPERATION_NAMES = {
    "create": "insert",
    "c": "insert",
    "u": "update",
    "d": "delete",
    "r": "read",
}


def parse_struct(value: Column, schema: str, strict: bool = False) -> Column:
    """A JSON text as a struct; its ``_bad`` field is set when the text does not fit.

    With ``strict`` such a text fails the job.
    """
    options = {**J.PARSE_OPTIONS, "columnNameOfCorruptRecord": "_bad"}
    if strict:
        return F.from_json(value, schema, {**J.PARSE_OPTIONS, "mode": "FAILFAST"})
    return F.from_json(value, f"{schema}, _bad string", options)


def parse_change_records(df: DataFrame, decode: bool = False) -> DataFrame:
    """Landed change texts (``topic, value``) as ``topic, op, before, after``.

    A record may be the text itself or stand in its ``payload``, beside a schema. With
    ``decode`` values that the schema says are encoded are decoded. A text that is no change
    record keeps a NULL ``op`` and is reported by :func:`normalize_changes`.
    """
    record = f"{CHANGE_RECORD}, payload struct<{CHANGE_RECORD}>" + (", schema variant" if decode else "")
    # The text passes the generator too: a filter on it would move below exchanges and make a computed text twice.
    parsed = J.with_computed(df, value=F.col("value"), record=parse_struct(F.col("value"), record))
    parsed = parsed.select(*df.columns, "record")
    good = F.col("record._bad").isNull()
    inner = F.col("record.payload").isNotNull()
    fields = {
        name: F.when(good, F.when(inner, F.col(f"record.payload.{name}")).otherwise(F.col(f"record.{name}")))
        for name in ("op", "before", "after")
    }
    if not decode:
        return parsed.withColumns(fields).drop("record")
    parsed = J.with_computed(parsed, **fields, encoded=F.when(good & inner, encoded_fields(F.col("record.schema"))))
    images = {name: decoded(F.col(name), F.col("encoded")) for name in ("before", "after")}
    images = {name: F.when(F.size("encoded") > 0, image).otherwise(F.col(name)) for name, image in images.items()}
    return J.with_computed(parsed, **images).drop("record", "encoded")


def operation_type(op: Column) -> Column:
    """Lower-case operation name; ``create`` becomes ``insert``, unknown names are kept."""
    name = F.lower(op)
    renames = F.create_map(*[F.lit(x) for pair in OPERATION_NAMES.items() for x in pair])
    return F.coalesce(F.try_element_at(renames, name), name)


def normalize_changes(
    df: DataFrame, drop_nulls: bool = True, snapshot_as_insert: bool = False
) -> DataFrame:
    """Raw change records (``topic, op, before, after``) as envelopes.

    Part 1 of the topic is the database, part 2 the table. Absent images become
    empty objects. With ``drop_nulls`` null columns vanish from the images.
    ``snapshot_as_insert`` renames snapshot rows (``read``) to ``insert``. Adds
    ``reason``, NULL for good records.
    """
    parts = F.split("topic", r"\.")
    kind = operation_type(F.col("op"))
    if snapshot_as_insert:
        kind = F.when(kind == "read", "insert").otherwise(kind)

    def image(name: str) -> Column:
        entries = J.drop_null_entries(F.col(name)) if drop_nulls else F.col(name)
        return F.coalesce(entries, J.empty_object())

    database = F.try_element_at(parts, F.lit(2))
    table = F.try_element_at(parts, F.lit(3))
    reason = F.when(table.isNull(), "short_topic").when(F.col("op").isNull(), "bad_record")
    return df.withColumns(
        {
            "database": database,
            "tableName": table,
            "before": image("before"),
            "after": image("after"),
            "type": kind,
            "reason": reason,
        }
    ).drop("topic", "op")


def envelope_text(df: DataFrame) -> DataFrame:
    """Add ``value``: the envelope as one JSON text."""
    return df.withColumn("value", F.to_json(F.struct(*ENVELOPE_COLUMNS)))


def parse_envelopes(df: DataFrame, strict: bool = False) -> DataFrame:
    """Envelope texts as envelope columns plus ``reason``.

    The default reports a bad text in ``reason``; ``strict`` fails the job on it.
    """
    parsed = J.with_computed(df, envelope=parse_struct(F.col("value"), ENVELOPE, strict))
    fields = {name: F.col(f"envelope.{name}") for name in ENVELOPE_COLUMNS}
    for name in ("before", "after"):
        fields[name] = F.coalesce(fields[name], J.empty_object())
    bad = F.lit(False) if strict else F.col("envelope._bad").isNotNull()
    empty = F.col("envelope").isNull() | F.col("value").isNull()
    fields["reason"] = F.when(bad | empty, "bad_envelope")
    return parsed.withColumns(fields).drop("envelope")


def good_changes(df: DataFrame) -> DataFrame:
    return df.where("reason IS NULL")


def dirty_changes(df: DataFrame, stage: str) -> DataFrame:
    """Dead letters of a change step: the text that was read, and the reason."""
    bad = df.where("reason IS NOT NULL")
    if "value" not in df.columns:
        bad = envelope_text(bad)
    return bad.withColumn("stage", F.lit(stage)).drop(*ENVELOPE_COLUMNS)


def drop_deletes(df: DataFrame) -> DataFrame:
    """Everything but deletes; a change without a type, or one with a ``reason``, is kept."""
    kept = ~F.col("type").eqNullSafe("delete")
    return df.where(kept | F.col("reason").isNotNull() if "reason" in df.columns else kept)
