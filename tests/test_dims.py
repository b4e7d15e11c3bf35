import json
import random

import pytest

from tidewater.operators import dims as D
from tidewater.sinks.catalog import (
    allowed_options,
    create_dim_tables,
    create_statement,
    fill_dim_tables,
    remove_old_buckets,
    view_statement,
)
from tidewater.sinks.dim_store import DimStore

COLUMNS = ("id", "a", "b")


@pytest.fixture
def rows(spark):
    """Dimension rows from (seq, table, payload); the key is ``id``."""

    def make(*changes):
        data = [(seq, table, str(body["id"]), json.dumps(body)) for seq, table, body in changes]
        df = spark.createDataFrame(data, "seq bigint, sink_table string, pk string, text string")
        return df.selectExpr(
            "seq", "sink_table", "pk", "from_json(text, 'map<string,variant>') AS payload"
        )

    return make


def found(df):
    return {r.id: (r.a, r.b) for r in df.collect()}


def test_absent_columns_keep_and_nulls_clear(rows):
    df = rows(
        (1, "d", {"id": 1, "a": "x", "b": "y"}),
        (2, "d", {"id": 1, "a": None}),
        (3, "d", {"id": 2, "a": "O'Brien"}),
        (4, "d", {"id": 2, "b": {"k": [1, None]}}),
    )
    assert found(D.merge_dim(df, COLUMNS)) == {"1": (None, "y"), "2": ("O'Brien", '{"k":[1,null]}')}


def test_late_changes_do_not_win(rows):
    df = rows((5, "d", {"id": 1, "a": "new"}), (2, "d", {"id": 1, "a": "old", "b": "old"}))
    assert found(D.merge_dim(df, COLUMNS)) == {"1": ("new", "old")}


def test_column_names_may_clash_with_cell_fields(rows):
    df = rows((1, "d", {"id": 1, "pk": "p", "seq": 9, "value": "v", "row.x": "r"}))
    assert D.merge_dim(df, ("pk", "seq", "value", "row.x")).first() == ("p", "9", "v", "r")


def test_numbers_as_text(rows):
    df = rows((1, "d", {"id": 1, "a": 12345678901234567890, "b": True}))
    assert found(D.merge_dim(df, COLUMNS)) == {"1": ("12345678901234567890", "true")}
    types = {("d", "a"): "decimal(10,2)", ("d", "b"): "decimal(10,2)"}
    typed = D.dim_cells(rows((1, "d", {"id": 1, "a": 9.9, "b": "n/a"})), "seq", types)
    assert {r.column: r.value for r in typed.collect()} == {"id": "1", "a": "9.90", "b": "n/a"}


def test_store_does_not_depend_on_batches_replays_or_compactions(spark, rows, tmp_path):
    rng = random.Random(3)
    changes = []
    for seq in range(200):
        body = {"id": rng.choice([1, 1, 1, 2, 3])}
        for name in "ab":
            if rng.random() < 0.5:
                body[name] = rng.choice([None, f"{name}{seq}"])
        changes.append((seq, rng.choice("de"), body))
    expected = {}
    for _, table, body in changes:
        kept = expected.setdefault((table, str(body["id"])), {"a": None, "b": None})
        kept.update({k: v for k, v in body.items() if k != "id"})
    store = DimStore(str(tmp_path / "dims"))
    assert store.cells(spark).count() == 0
    shuffled = changes[:]
    rng.shuffle(shuffled)
    cuts = [shuffled[:50], shuffled[50:60], shuffled[60:150], shuffled[150:]]
    for batch, cut in enumerate(cuts):
        store.append(D.dim_cells(rows(*cut)), "job", batch)
        if batch == 1:
            store.compact(spark)
    store.append(D.dim_cells(rows(*cuts[0])), "job", 0)
    store.append(D.dim_cells(rows(*cuts[3])), "job", 3)
    for repeat in range(2):
        for table in "de":
            seen = found(store.table(spark, table, COLUMNS))
            assert seen == {k: (v["a"], v["b"]) for (t, k), v in expected.items() if t == table}
        store.compact(spark)


def test_half_written_compaction_is_ignored(spark, rows, tmp_path):
    store = DimStore(str(tmp_path / "dims"))
    store.append(D.dim_cells(rows((1, "d", {"id": 1, "a": "x"}))), "job", 0)
    D.dim_cells(rows((9, "d", {"id": 7, "a": "stray"}))).write.partitionBy("sink_table").parquet(
        f"{store.root}/base/epoch=1"
    )
    assert found(store.table(spark, "d", COLUMNS)) == {"1": ("x", None)}
    store.compact(spark)
    assert found(store.table(spark, "d", COLUMNS)) == {"1": ("x", None)}


def test_merge_aggregates_before_the_shuffle(spark, rows):
    plan = D.merge_cells(D.dim_cells(rows((1, "d", {"id": 1}))))._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan and "Window" not in plan


def test_table_statement_takes_options_from_a_list_only():
    assert allowed_options("compression=zstd, comment=it's, LOCATION=/etc, x") == {
        "comment": "it's", "compression": "zstd",
    }
    text = create_statement("w", "d`x", "id", ["id", "a b"], "comment=it's,path=/etc", 8)
    assert text == (
        "CREATE TABLE IF NOT EXISTS `w`.`d``x__rows` (`id` STRING, `a b` STRING, `_key` STRING,"
        " `_seqs` MAP<STRING, BIGINT>, `_bucket` INT) USING parquet PARTITIONED BY (`_bucket`)"
        " COMMENT 'it\\'s' TBLPROPERTIES ('pk' = 'id', 'buckets' = '8')"
    )
    assert view_statement("w", "d", "id", ["id", "a b"], "path=/etc") == (
        "CREATE OR REPLACE VIEW `w`.`d` TBLPROPERTIES ('pk' = 'id') AS SELECT `id`, `a b` FROM `w`.`d__rows`"
    )


@pytest.fixture
def define(spark):
    schema = "sink_table string, sink_pk string, columns array<string>, sink_extend string"
    return lambda name, columns: spark.createDataFrame([(name, "id", columns, "compression=gzip")], schema)


def test_catalog_tables_are_created_and_widened(spark, rows, define):
    assert create_dim_tables(spark, define("dim_x", ["id", "a"]), "warehouse_test") == ["dim_x"]
    assert fill_dim_tables(spark, "warehouse_test", D.dim_cells(rows((1, "dim_x", {"id": 1, "a": "x", "b": "lost"}))))
    known = set()
    assert create_dim_tables(spark, define("dim_x", ["id", "a", "b"]), "warehouse_test", known) == ["dim_x"]
    assert create_dim_tables(spark, define("dim_x", ["id", "a", "b"]), "warehouse_test", known) == []
    table = spark.table("warehouse_test.dim_x")
    assert table.dtypes == [("id", "string"), ("a", "string"), ("b", "string")]
    for name in ("dim_x", "dim_x__rows"):
        properties = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES warehouse_test.{name}").collect()}
        assert properties["pk"] == "id" and properties["parquet.compression"] == "gzip"
    fill_dim_tables(spark, "warehouse_test", D.dim_cells(rows((2, "dim_x", {"id": 1, "b": "y"}), (3, "none", {"id": 1}))))
    assert found(table) == {"1": ("x", "y")}
    assert fill_dim_tables(spark, "warehouse_test", D.dim_cells(rows((3, "none", {"id": 1})))) == {}


def test_catalog_tables_do_not_depend_on_batches_or_replays(spark, rows, define):
    rng = random.Random(8)
    create_dim_tables(spark, define("dim_y", ["id", "a", "b"]), "warehouse_test", buckets=4)
    changes, expected = [], {}
    for seq in range(150):
        body = {"id": rng.choice([1, 1, 1, "O'Brien", 3, 4, "", "é b"])}
        body |= {name: rng.choice([None, f"{name}{seq}", 7]) for name in "ab" if rng.random() < 0.5}
        changes.append((seq, "dim_y", body))
        expected.setdefault(str(body["id"]), {"a": None, "b": None}).update(body)
    rng.shuffle(changes)
    for cut in (changes[:60], changes[60:61], changes[:60], changes[61:]):
        fill_dim_tables(spark, "warehouse_test", D.dim_cells(rows(*cut)))
    texts = {k: tuple(None if v[c] is None else str(v[c]) for c in "ab") for k, v in expected.items()}
    assert found(spark.table("warehouse_test.dim_y")) == texts


def test_only_touched_buckets_are_rewritten(spark, rows, define):
    create_dim_tables(spark, define("dim_z", ["id", "a"]), "warehouse_test", buckets=8)
    files = lambda: set(spark.table("warehouse_test.dim_z__rows").inputFiles())
    fill_dim_tables(spark, "warehouse_test", D.dim_cells(rows(*[(i, "dim_z", {"id": i, "a": "x"}) for i in range(60)])))
    first = files()
    assert len(first) == 8
    touched = fill_dim_tables(spark, "warehouse_test", D.dim_cells(rows((99, "dim_z", {"id": 7, "a": "y"}))))
    second = files()
    assert len(touched["dim_z"]) == 1 and len(first & second) == 7 and len(second) == 8
    assert {r.id: r.a for r in spark.table("warehouse_test.dim_z").collect()} == {
        str(i): "y" if i == 7 else "x" for i in range(60)
    }
    # What a reader may still hold stays until it is old enough.
    old = spark.read.parquet(*(first - second))
    assert old.where("_key = '7'").first().a == "x"
    remove_old_buckets(spark, "warehouse_test", "dim_z", keep_ms=0)
    assert files() == second and spark.table("warehouse_test.dim_z").count() == 60
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        spark.read.parquet(*(first - second)).count()


def test_rows_of_one_task_are_dealt_out_before_their_cells_are_sorted(spark):
    rows = spark.range(50).selectExpr(
        "'t' AS sink_table", "'hot' AS pk", "map('a', cast(id AS variant), 'b', cast(-id AS variant)) AS payload", "id AS seq"
    ).coalesce(1)
    cells = D.dim_cells(rows)
    assert "REBALANCE_PARTITIONS_BY_COL" in cells._jdf.queryExecution().executedPlan().toString()
    found = {(r.column, r.value, r.seq) for r in D.merge_cells(cells).collect()}
    assert found == {("a", "49", 49), ("b", "-49", 49)}
