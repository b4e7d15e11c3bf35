"""Values as connectors encode them, decoded by the schema block of their record.

Decimals come as the bytes of a big-endian two's complement number in base64, dates as days and
times as milli-, micro- or nanoseconds since 1970 or since midnight. Decoded, they are texts:
decimals keep their scale, times have no zone and no zeros at the end. A value that does not
fit its encoding, or a decimal of more than 38 digits, stays as it is.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# The names of encodings in schema blocks.
DECIMAL = "org.apache.kafka.connect.data.Decimal"
SCALED_DECIMAL = "io.debezium.data.VariableScaleDecimal"
DAYS = ("io.debezium.time.Date", "org.apache.kafka.connect.data.Date")
# Name and units in a second.
TIMESTAMPS = {
    "io.debezium.time.Timestamp": 1000,
    "org.apache.kafka.connect.data.Timestamp": 1000,
    "io.debezium.time.MicroTimestamp": 1_000_000,
    "io.debezium.time.NanoTimestamp": 1_000_000_000,
}
TIMES = {
    "io.debezium.time.Time": 1000,
    "org.apache.kafka.connect.data.Time": 1000,
    "io.debezium.time.MicroTime": 1_000_000,
    "io.debezium.time.NanoTime": 1_000_000_000,
}
ENCODINGS = (DECIMAL, SCALED_DECIMAL, *DAYS, *TIMESTAMPS, *TIMES)

FIELD = "struct<field:string, name:string, parameters:map<string,string>>"
BLOCK = f"struct<fields:array<struct<field:string, fields:array<{FIELD}>>>>"


def encoded_fields(block: Column) -> Column:
    """The encoded columns of a table, from the schema block of a record (a variant).

    Empty where there is no block, or none that lists columns.
    """
    fields = F.try_variant_get(block, "$", BLOCK)["fields"]
    images = F.filter(fields, lambda field: field["field"].isin("after", "before") & field["fields"].isNotNull())
    columns = F.try_element_at(images, F.lit(1))["fields"]
    found = F.filter(columns, lambda column: column["name"].isin(*ENCODINGS))
    return F.coalesce(found, F.array().cast(f"array<{FIELD}>"))


def decoded(image: Column, encoded: Column) -> Column:
    """An image (``map<string,variant>``) with its encoded columns decoded."""

    def value(name: Column, leaf: Column) -> Column:
        field = F.try_element_at(F.filter(encoded, lambda column: column["field"] == name), F.lit(1))
        return F.coalesce(decoded_text(leaf, field).cast("variant"), leaf)

    return F.transform_values(image, value)


def decoded_text(leaf: Column, field: Column) -> Column:
    """The text of one encoded value; NULL where there is nothing to decode."""
    name = field["name"]
    scaled = F.try_variant_get(leaf, "$", "struct<scale:int, value:string>")
    is_decimal = name.isin(DECIMAL, SCALED_DECIMAL)
    bytes_of = F.when(name == DECIMAL, F.try_variant_get(leaf, "$", "string")).otherwise(scaled["value"])
    scale = F.when(name == DECIMAL, F.coalesce(field["parameters"]["scale"].try_cast("int"), F.lit(0))).otherwise(scaled["scale"])
    units = F.element_at(F.create_map(*[F.lit(part) for pair in (TIMESTAMPS | TIMES | dict.fromkeys(DAYS, 0)).items() for part in pair]), name)
    seconds = F.when(units > 0, F.try_variant_get(leaf, "$", "bigint").cast("decimal(19,0)") / units.cast("decimal(10,0)"))
    seconds = F.coalesce(seconds, F.try_variant_get(leaf, "$", "int").cast("decimal(19,0)") * 86400)
    text = moment(seconds.cast("decimal(18,6)"))
    cut = F.when(name.isin(*DAYS), F.substring_index(text, " ", 1)).when(name.isin(*TIMES), F.substring_index(text, " ", -1))
    return F.when(is_decimal, decimal_text(bytes_of, scale)).when(units.isNotNull(), F.coalesce(cut, text))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value evaluated once, and written once in the plan."""
    return F.element_at(F.transform(F.array(value), body), 1)


def moment(seconds: Column) -> Column:
    """Text of the time so many seconds after the start of 1970, without a zone."""
    start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return (start + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)).cast("string")


def decimal_text(encoded: Column, scale: Column) -> Column:
    """The decimal in base64 of its unscaled bytes, written with all digits of its scale."""
    return let(F.hex(F.try_to_binary(encoded, F.lit("base64"))), lambda digits: _of_digits(digits, scale))


def _of_digits(digits: Column, scale: Column) -> Column:
    negative = F.substring(digits, 1, 1) >= "8"
    sign = F.when(negative, F.struct(F.lit("-").alias("text"), F.lit("F").alias("fill"), F.lit(2**32 - 1).alias("flip"), F.lit(-1).alias("step")))
    sign = sign.otherwise(F.struct(F.lit("").alias("text"), F.lit("0").alias("fill"), F.lit(0).alias("flip"), F.lit(1).alias("step")))

    def written(sign: Column) -> Column:
        filled = F.concat(F.repeat(sign["fill"], 32 - F.length(digits)), digits)
        # Four words of 32 bits, those of a negative number turned over, from the highest on.
        words = F.transform(F.sequence(F.lit(1), F.lit(25), F.lit(8)), lambda at: F.conv(F.substring(filled, at, F.lit(8)), 16, 10).cast("bigint"))
        words = F.transform(words, lambda word: sign["flip"] + sign["step"] * word)
        number = F.aggregate(
            words, F.lit(0).cast("decimal(38,0)"),
            lambda total, word: F.try_add(F.try_multiply(total, F.lit(Decimal(2**32))).cast("decimal(38,0)"), word.cast("decimal(19,0)")).cast("decimal(38,0)"),
        )
        number = F.try_add(number, F.when(sign["step"] < 0, 1).otherwise(0).cast("decimal(1,0)"))
        return let(number.cast("decimal(38,0)").cast("string"), lambda plain: F.concat(sign["text"], _pointed(plain, scale)))

    return F.when(F.length(digits).between(2, 32), let(sign, written))


def _pointed(plain: Column, scale: Column) -> Column:
    """Digits with the decimal point that the scale asks for."""

    def point(padded: Column) -> Column:
        return F.concat(F.left(padded, F.length(padded) - scale), F.lit("."), F.right(padded, scale))

    padded = F.concat(F.repeat(F.lit("0"), scale + 1 - F.length(plain)), plain)
    return F.when(scale > 0, let(padded, point)).otherwise(F.concat(plain, F.repeat(F.lit("0"), -scale)))
