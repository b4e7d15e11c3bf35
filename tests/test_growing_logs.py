import json
import random

import pytest
from pyspark.sql import functions as F

from tidewater.sources.growinglogs import GROWING_ORDER, Folders, GrowingLogsReader, stream_growing_logs


def lines_of(root, parts):
    return [value.decode() for part in parts for values, _ in Folders(str(root)).lines(part) for value in values]


@pytest.mark.parametrize("split", [1, 7, 64, 10_000])
def test_byte_ranges_hold_every_line_once(tmp_path, split):
    rnd = random.Random(split)
    lines = ["é" * rnd.randrange(0, 20) + str(i) for i in range(60)] + ["", "", "last"]
    (tmp_path / "app.log").write_bytes("\n".join(lines).encode() + b"\nunfinished")
    (tmp_path / "app.2024-01-01.log").write_bytes(b"one\r\ntwo\n\nthree")
    reader = GrowingLogsReader(str(tmp_path), split)
    parts = reader.partitions({}, json.loads(json.dumps(reader.latestOffset())))
    assert lines_of(tmp_path, parts) == ["one", "two", "", "three", *lines]
    positions = [at for part in parts if part.name == "app.log" for _, found in Folders(str(tmp_path)).lines(part) for at in found]
    data = (tmp_path / "app.log").read_bytes()
    assert positions == [0, *[i + 1 for i, byte in enumerate(data) if byte == 10][:-1]]


def test_growth_rolls_and_replays(tmp_path):
    reader, log = GrowingLogsReader(str(tmp_path), 16), tmp_path / "a" / "app.log"
    log.parent.mkdir()
    assert reader.latestOffset() == {} and reader.partitions({}, {}) == []
    log.write_bytes(b"no line yet")
    assert reader.partitions({}, reader.latestOffset()) == []
    log.write_bytes(b"first\nsecond\nthi")
    one = reader.latestOffset()
    planned = reader.partitions({}, one)
    assert lines_of(tmp_path, planned) == ["first", "second"]
    assert reader.partitions(one, reader.latestOffset()) == []
    with log.open("ab") as file:
        file.write(b"rd\nfourth\n")
    two = reader.latestOffset()
    grown = reader.partitions(one, two)
    assert lines_of(tmp_path, grown) == ["third", "fourth"]
    # Rolled with another line, and once more, before the next batch.
    with log.open("ab") as file:
        file.write(b"fifth")
    log.rename(log.with_name("app.2999-01-01.log"))
    log.write_bytes(b"other day\n")
    log.rename(log.with_name("app.2999-01-02.log"))
    log.write_bytes(b"today\nmore")
    three = reader.latestOffset()
    assert lines_of(tmp_path, reader.partitions(two, three)) == ["fifth", "other day", "today"]
    # What was planned before the roll reads the same lines again.
    assert lines_of(tmp_path, planned) == ["first", "second"] and lines_of(tmp_path, grown) == ["third", "fourth"]
    assert reader.partitions(three, three) == []


def test_stream_over_restarts(spark, tmp_path):
    folder, out, checkpoint = (str(tmp_path / name) for name in ("logs", "out", "checkpoint"))
    rows = [f"line {i} " + "x" * (i % 50) for i in range(400)]
    files = [tmp_path / "logs" / name / "app.log" for name in ("a", "b")]
    for file in files:
        file.parent.mkdir(parents=True)

    def run():
        lines = stream_growing_logs(spark, folder, 300).select("*", F.lit(1).alias("batch"))
        writer = lines.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
        writer.trigger(availableNow=True).start().awaitTermination()

    files[0].write_text("\n".join(rows[:100]) + "\n")
    run()
    files[1].write_text("\n".join(rows[200:300]) + "\nline 3")
    with files[0].open("a") as file:
        file.write("\n".join(rows[100:150]) + "\n")
    run()
    with files[0].open("a") as file:
        file.write("\n".join(rows[150:190]))
    files[0].rename(files[0].with_name("app.2024-05-05.log"))
    files[0].write_text("\n".join(rows[190:200]) + "\n")
    files[1].write_text("\n".join(rows[200:400]) + "\n")
    run()
    run()
    found = spark.read.parquet(out)
    assert sorted(r.value for r in found.collect()) == sorted(rows)
    first = [r.value for r in found.where("file LIKE '%/a/%'").orderBy(*GROWING_ORDER).collect()]
    assert sorted(first) == sorted(rows[:200])
    assert found.where("day = DATE'2024-05-05'").count() == 40
