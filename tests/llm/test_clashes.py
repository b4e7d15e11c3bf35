"""Extra columns whose names the operators use themselves pass through, or are ignored."""

import pytest

import corpus_pipeline
from tidewater.llm import paragraph_dedup, pii, suffix_dedup, toxicity
from tidewater.llm.decontaminate import contamination
from tidewater.llm.jaccard_join import keep_one_per_class
from tidewater.llm.mixing import mixed
from tidewater.llm.permutation_index import valid_vectors

NAMES = ("_id", "_rid", "_key", "_row_key", "_class", "_rows", "_removed", "_passages", "_spans", "_salt", "_hot_piece",
         "row", "rid", "class_id", "kept", "size", "piece", "n", "key", "score", "bucket", "label", "spans", "found")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    frame = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    rows = [tuple(r) for r in frame.collect()]
    rows += [rows[0], (None, None, None, None, None)]
    wide = [(*row, *[f"{name} of {i}" for name in NAMES]) for i, row in enumerate(rows)]
    schema = ", ".join([f"{name} {kind}" for name, kind in frame.dtypes] + [f"`{name}` string" for name in NAMES])
    return spark.createDataFrame(wide, schema)


KEEP_ALL = {
    "near_duplicates": keep_one_per_class,
    "paragraphs": paragraph_dedup.without_repeats,
    "suffixes": suffix_dedup.without_repeats,
    "personal_data": pii.redacted,
    "mixing": mixed,
}


@pytest.mark.parametrize("name", sorted(KEEP_ALL))
def test_columns_of_the_caller_stay(docs, name):
    found = KEEP_ALL[name](docs)
    assert found.columns == docs.columns
    rows = {r["rid"]: r for r in docs.collect()}
    out = found.collect()
    assert out and all(r["_salt"] == rows[r["rid"]]["_salt"] and r["row"] == rows[r["rid"]]["row"] for r in out)
    if name not in ("near_duplicates", "mixing"):
        assert len(out) == len(rows)


@pytest.mark.parametrize("stage", [name for name, _ in corpus_pipeline.STAGES])
def test_columns_through_the_pipeline(spark, docs, stage):
    found = dict(corpus_pipeline.STAGES)[stage](spark, docs, SF)
    if stage == corpus_pipeline.STAGES[-1][0]:
        assert found.count() == docs.count()
    else:
        assert found.columns == docs.columns and 0 < found.count()


def test_columns_beside_results(spark, docs):
    assert contamination(docs, spark.read.parquet(f"{SF}/benchmark.parquet")).count() == docs.count()
    assert paragraph_dedup.paragraph_summary(docs).count() == docs.count()
    assert suffix_dedup.removal_digest(docs).count() == docs.count()
    model = toxicity.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    assert toxicity.score(docs, model).select("row.*").columns == docs.columns
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet")
    for name in NAMES:
        vectors = vectors.selectExpr("*", f"1 AS `{name}`")
    assert valid_vectors(vectors).count() == spark.read.parquet(f"{SF}/embeddings.parquet").count()
