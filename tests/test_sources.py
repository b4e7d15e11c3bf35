import pytest
from pyspark.sql import functions as F

from tidewater.session import broadcast_if_small, read_if_exists, session_conf, shared_dir
from tidewater.sources.logfiles import LINE_ORDER, read_log_files, stream_log_files
from tidewater.sources.topics import FileTopics, KafkaTopics


def test_file_topics_read_by_name_list_and_pattern(spark, tmp_path):
    topics = FileTopics(str(tmp_path / "t"))
    rows = spark.createDataFrame([("a", "1", "x"), ("b", "2", "y"), ("ab", "3", "z")], "topic string, key string, value string")
    topics.write_batch(rows, 0)
    topics.write_batch(rows.where("topic = 'a'").withColumn("value", F.lit("again")), 1)
    topics.write_batch(rows.where("topic = 'a'").withColumn("value", F.lit("again")), 1)
    assert sorted(r.value for r in topics.read(spark, "a").collect()) == ["again", "x"]
    assert topics.read(spark, "a,b").count() == 3
    assert topics.read(spark, "a.?", pattern=True).count() == 3
    message = topics.read(spark, "b").first()
    assert message.offset == 0 and message.timestamp is not None and "topic=b" in message.partition


def test_topic_filter_prunes_folders(spark, tmp_path):
    topics = FileTopics(str(tmp_path / "t"))
    topics.write_batch(spark.createDataFrame([("a", "1", "x")], "topic string, key string, value string"), 0)
    plan = topics.read(spark, "a").select("value")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(topic" in plan and "key:string" not in plan


def test_file_topics_have_no_latest_offset(spark, tmp_path):
    with pytest.raises(ValueError):
        FileTopics(str(tmp_path)).stream(spark, "a", starting="latest")


def test_kafka_options():
    topics = KafkaTopics("h1:9092,h2:9092", {"maxOffsetsPerTrigger": "1000"})
    assert topics.read_options("ods_base_log", "latest", False) == {
        "kafka.bootstrap.servers": "h1:9092,h2:9092",
        "subscribe": "ods_base_log",
        "startingOffsets": "latest",
        "maxOffsetsPerTrigger": "1000",
    }
    assert topics.read_options("srv.*", "earliest", True)["subscribePattern"] == "srv.*"


@pytest.fixture
def log_folder(tmp_path):
    folder = tmp_path / "logs"
    folder.mkdir()
    for day in ("2024-01-02", "2024-01-01"):
        lines = "\n".join(f"{day}/{i}" for i in range(5000))
        (folder / f"app.{day}.log").write_text(lines + "\n")
    (folder / "app.log").write_text("still open\n")
    (folder / "other.txt").write_text("not a log\n")
    return str(folder)


def in_order(rows):
    ordered = sorted(rows, key=lambda r: tuple(str(r[c]) if c == "day" else r[c] for c in LINE_ORDER))
    return [r.value for r in ordered]


EXPECTED = [f"2024-01-0{d}/{i}" for d in (1, 2) for i in range(5000)]


def test_log_files_keep_line_order_across_splits(spark, log_folder):
    with session_conf(spark, {"spark.sql.files.maxPartitionBytes": "20000", "spark.sql.files.openCostInBytes": "1"}):
        lines = read_log_files(spark, log_folder)
        assert lines.rdd.getNumPartitions() > 2
        assert in_order(lines.collect()) == EXPECTED


def test_streamed_log_files_keep_line_order(spark, log_folder, tmp_path):
    with session_conf(spark, {"spark.sql.files.maxPartitionBytes": "20000", "spark.sql.files.openCostInBytes": "1"}):
        out = str(tmp_path / "out")
        query = stream_log_files(spark, log_folder, 1).writeStream.format("parquet")
        query = query.option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start(out)
        query.awaitTermination()
    assert in_order(spark.read.parquet(out).collect()) == EXPECTED


def test_session_conf_restores(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with session_conf(spark, {"spark.sql.shuffle.partitions": "3", "tidewater.test": "x"}):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert spark.conf.get("tidewater.test", None) is None


def test_shared_folders_are_below_the_configured_one(spark):
    first, second = shared_dir(spark, "x"), shared_dir(spark, "x")
    assert first != second and first.startswith(spark.conf.get("spark.checkpoint.dir").rstrip("/"))


def test_missing_tables_read_as_empty(spark, tmp_path):
    assert read_if_exists(spark, str(tmp_path / "none"), "a string").count() == 0


def test_broadcast_depends_on_measured_size(spark):
    df = spark.range(1000)
    hinted = lambda d: "broadcast" in d._jdf.queryExecution().logical().toString().lower()
    assert hinted(broadcast_if_small(df)) and not hinted(broadcast_if_small(df, 100))
    assert hinted(broadcast_if_small(df.where("id < 0"), 1))
