import pytest
from verification.compare import open_tables, rows_of

import __spark_entry__ as entry_points
import corpus_pipeline
from tests.llm import helpers as H
from tidewater.llm.mixing import with_copies
from tidewater.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, name):
    frame = QUERIES[name](spark, SF)
    result = open_tables(SF).execute(SQL[name])
    columns = [item[0] for item in result.description]
    assert sorted(columns) == sorted(frame.columns)
    assert rows_of(frame.columns, [tuple(r) for r in frame.collect()]) == rows_of(columns, result.fetchall())


def test_every_operator_is_registered():
    names = entry_points.queries()
    assert all(any(name.startswith(f"op{n}_") for name in names) for n in range(1, 14)) and "pipeline" in names


def test_removals_of_the_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    found = QUERIES["op2_suffix_array_dedup"](spark, SF)
    assert found.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert H.by_text(map(tuple, found.collect())) == H.by_text(H.removal_rows(rows, 400))


def test_stages_of_the_pipeline(spark):
    """Every stage beside plain Python over what the stage before it kept."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, [docs]
    work = corpus_pipeline.Workspace(spark, "test")
    for name, stage in corpus_pipeline.STAGES:
        kept.append(work.write(stage(spark, kept[-1], SF), name))
    assert all(frame.columns == columns for frame in kept[:-1])
    tables = [[(r.doc_id, r.text) for r in frame.collect()] for frame in kept[:-1]]
    assert set(tables[1]) < set(tables[0]) or len(tables[1]) == len(tables[0])
    classes = H.jaccard_rows(tables[1])
    assert H.by_text(d for d, _ in tables[2]) == H.by_text({c for _, c, _ in classes})
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    judged = H.contamination_rows(tables[2], items)
    assert H.by_text(d for d, _ in tables[3]) == H.by_text(d for d, n, hit, _ in judged if not (hit and 20 * hit >= n))
    copies = {r.doc_id: r.copies for r in with_copies(kept[3]).collect()}
    assert len(tables[4]) == sum(copies.values()) and {d for d, _ in tables[4]} == {d for d, n in copies.items() if n}
    last = sorted(kept[5].collect(), key=lambda r: r.start)
    assert [r.doc_id for r in last] == sorted(d for d, _ in tables[4])
    assert all(b.start == a.start + a.n_tokens for a, b in zip(last, last[1:], strict=False))
