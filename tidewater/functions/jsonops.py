"""Column helpers over JSON records: variants, and open objects as ``map<string,variant>``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.schemas import OPEN_OBJECT

# Standard JSON only, where a text is read into typed fields.
PARSE_OPTIONS = {"allowSingleQuotes": "false"}


def parse_text(value: Column, strict: bool = False) -> Column:
    """The document in a JSON text as one variant.

    NULL for a text that is not JSON; ``strict`` fails the job on it.
    """
    return F.parse_json(value) if strict else F.try_parse_json(value)


def with_computed(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are evaluated exactly once per row.

    A one-element generator keeps the optimizer from copying an expensive
    expression into every filter and projection that refers to it.
    """
    kept = [name for name in df.columns if name not in columns]
    made = F.struct(*[value.alias(name) for name, value in columns.items()])
    return df.select(*kept, F.inline(F.array(made)))


def path_string(value: Column, path: str = "$") -> Column:
    """Text of the scalar or sub-document at ``path``; JSON null reads as NULL."""
    return F.try_variant_get(value, path, "string")


def as_object(value: Column, path: str = "$") -> Column:
    """The value at ``path`` as an open object; NULL for scalars, arrays and JSON null."""
    return F.try_variant_get(value, path, OPEN_OBJECT)


def as_array(value: Column, path: str = "$") -> Column:
    """The value at ``path`` as an array of variants; NULL for anything else."""
    return F.try_variant_get(value, path, "array<variant>")


def is_present(value: Column) -> Column:
    """Whether a field exists with a value other than JSON null."""
    return value.isNotNull() & ~F.is_variant_null(value)


def has_path(value: Column, path: str) -> Column:
    return is_present(F.try_variant_get(value, path, "variant"))


def nonempty(container: Column) -> Column:
    """Whether an object or array has at least one entry; null-valued ones count."""
    return F.coalesce(F.size(container) > 0, F.lit(False))


def set_field(obj: Column, name: str, value: Column) -> Column:
    """``obj`` with one field added or overwritten; ``value`` must be a variant."""
    rest = F.map_filter(obj, lambda key, _: key != name)
    return F.map_concat(rest, F.create_map(F.lit(name), value))


def to_variant(value: Column) -> Column:
    """A string column as a variant, with SQL NULL becoming JSON null."""
    return F.coalesce(value.cast("variant"), F.parse_json(F.lit("null")))


def keep_keys(obj: Column, names: Column) -> Column:
    """Only the entries whose key is listed in the array ``names``."""
    return F.map_filter(obj, lambda key, _: F.array_contains(names, key))


def drop_null_entries(obj: Column) -> Column:
    return F.map_filter(obj, lambda _, value: is_present(value))


def empty_object() -> Column:
    return F.create_map().cast(OPEN_OBJECT)


def field_ignoring_style(obj: Column, name: str) -> Column:
    """Text of a field whose name may be written in camel or snake case."""
    wanted = name.replace("_", "").lower()
    matches = F.map_filter(
        obj, lambda key, _: F.lower(F.replace(key, F.lit("_"), F.lit(""))) == wanted
    )
    return path_string(F.try_element_at(F.map_values(matches), F.lit(1)))


def split_columns(text: Column) -> Column:
    """Comma-separated names; empty names at the end are ignored, spaces are kept."""
    return F.split(F.regexp_replace(text, ",+$", ""), ",")
