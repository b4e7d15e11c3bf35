import base64
import json
from datetime import date, datetime, timedelta

from tidewater.operators import changes as C
from tidewater.sources.feeds import change_feed

CONNECT, DEBEZIUM = "org.apache.kafka.connect.data.", "io.debezium."


def unscaled(number, width=None):
    width = width or (number.bit_length() // 8 + 1)
    return base64.b64encode(number.to_bytes(width, "big", signed=True)).decode()


def feed(spark, fields, *rows):
    """Records whose schema block describes ``fields`` (name, encoding, parameters)."""
    columns = [{"field": f, "type": "x", **({"name": n} if n else {}), **({"parameters": p} if p else {})} for f, n, p in fields]
    schema = {"type": "struct", "fields": [{"field": image, "type": "struct", "fields": columns} for image in ("before", "after")]}
    texts = [
        (i, "s.d.t", json.dumps({"schema": schema, "payload": {"op": "u", "before": row, "after": row}})) for i, row in enumerate(rows)
    ]
    envelopes = C.envelope_text(change_feed(spark.createDataFrame(texts, "seq bigint, topic string, value string"), decode=True))
    found = {r.seq: json.loads(r.value) for r in envelopes.select("seq", "value").collect()}
    assert all(found[i]["before"] == found[i]["after"] for i in found)
    return [found[i]["after"] for i in sorted(found)]


def test_decimals_keep_all_digits_of_their_scale(spark):
    numbers = [0, 1, -1, 127, 128, -128, -129, 255, 256, 10**18, -(10**18), 2**63, -(2**63), 2**64, 2**96 - 1, -(2**96),
               99999999999999999999999999999999999999, -99999999999999999999999999999999999999, 123456789012345678901234567890]
    for scale in (0, 2, 30):
        fields = [("v", CONNECT + "Decimal", {"scale": str(scale), "connect.decimal.precision": "38"})]
        rows = [{"v": unscaled(n)} for n in numbers] + [{"v": unscaled(n, 16)} for n in numbers]
        texts = [row["v"] for row in feed(spark, fields, *rows)]
        assert texts == [_plain(n, scale) for n in numbers] * 2
    rows = [{"v": {"scale": 3, "value": unscaled(-1500)}}, {"v": {"scale": -2, "value": unscaled(15)}}, {"v": {"scale": 0, "value": unscaled(7)}}]
    assert [r["v"] for r in feed(spark, [("v", DEBEZIUM + "data.VariableScaleDecimal", None)], *rows)] == ["-1.500", "1500", "7"]


def _plain(number, scale):
    digits = str(abs(number)).rjust(scale + 1, "0")
    return ("-" if number < 0 else "") + (f"{digits[:-scale]}.{digits[-scale:]}" if scale else digits)


def test_dates_and_times(spark):
    moment = datetime(2024, 2, 29, 23, 59, 58, 120000)
    micros = (moment - datetime(1970, 1, 1)) // timedelta(microseconds=1)
    early = (datetime(1931, 5, 6, 7, 8, 9) - datetime(1970, 1, 1)) // timedelta(milliseconds=1)
    fields = [
        ("d", DEBEZIUM + "time.Date", None), ("e", CONNECT + "Date", None), ("u", DEBEZIUM + "time.MicroTimestamp", None),
        ("m", DEBEZIUM + "time.Timestamp", None), ("n", DEBEZIUM + "time.NanoTimestamp", None), ("t", DEBEZIUM + "time.MicroTime", None),
        ("k", CONNECT + "Time", None), ("plain", None, None),
    ]
    row = {
        "d": (date(2024, 2, 29) - date(1970, 1, 1)).days, "e": -1, "u": micros, "m": early, "n": micros * 1000, "t": 3_661_000_001,
        "k": 0, "plain": 5,
    }
    assert feed(spark, fields, row) == [
        {
            "d": "2024-02-29", "e": "1969-12-31", "u": "2024-02-29 23:59:58.12", "m": "1931-05-06 07:08:09",
            "n": "2024-02-29 23:59:58.12", "t": "01:01:01.000001", "k": "00:00:00", "plain": 5,
        }
    ]


def test_values_that_do_not_fit_stay(spark):
    fields = [("v", CONNECT + "Decimal", {"scale": "2"}), ("w", CONNECT + "Decimal", None), ("d", DEBEZIUM + "time.Date", None)]
    wide = base64.b64encode(b"\x01" * 17).decode()
    rows = [{"v": "not base64!", "w": unscaled(7), "d": "text"}, {"v": wide, "w": "", "d": {"a": 1}}, {"v": unscaled(10**38, 17), "w": None, "x": 1}]
    found = feed(spark, fields, *rows)
    assert found[0] == {"v": "not base64!", "w": "7", "d": "text"}
    assert found[1] == rows[1]
    assert found[2] == {"v": rows[2]["v"], "x": 1}


def test_records_without_columns_in_their_schema(spark):
    for schema in ('{"type": "struct"}', '{"fields": [{"field": "op"}]}', "7", "null", '"x"', '{"fields": 3}'):
        text = f'{{"schema": {schema}, "payload": {{"op": "c", "after": {{"id": 1}}}}}}'
        found = change_feed(spark.createDataFrame([("s.d.t", text)], "topic string, value string"), decode=True)
        row = C.envelope_text(found).first()
        assert row.reason is None and json.loads(row.value)["after"] == {"id": 1}
