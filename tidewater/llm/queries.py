"""One query per operator over its whole table, and SQL where it can express the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import permutation_index, pii, toxicity
from tidewater.llm.decontaminate import contamination
from tidewater.llm.html_text import extract_text
from tidewater.llm.jaccard_join import jaccard_classes
from tidewater.llm.license_scan import license_digest, license_spans
from tidewater.llm.mixing import HEX_DIGITS, with_copies
from tidewater.llm.paragraph_dedup import paragraph_summary
from tidewater.llm.periodic_runs import periodic_runs, run_digest, with_planted_runs
from tidewater.llm.spelling import misspelt_words, variants, vocabulary
from tidewater.llm.suffix_dedup import removal_digest
from tidewater.llm.tables import Workspace
from tidewater.llm.token_orc import read_token_files, token_digest, write_token_files
from tidewater.session import shared_dir

Query = Callable[[SparkSession, str], DataFrame]


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the class of texts it is similar to, and its number of links."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return jaccard_classes(docs).select("doc_id", "class_id", "n_links")


def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes that 400-byte strings repeat."""
    return removal_digest(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op3_token_orc_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids written to ORC files, and what a reader finds in them."""
    path = shared_dir(spark, "tokens")
    write_token_files(spark.read.parquet(f"{sf_dir}/documents.parquet"), path)
    return token_digest(read_token_files(spark, path))


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The personal data of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = pii.find_spans(docs, pii.fit(docs))
    n_spans = F.size(F.filter(F.split("spans", ","), lambda span: span != "")).cast("bigint").alias("n_spans")
    counts = [f"n_{kind}" for kind in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2("base", 256).alias("base_sha256"), "spans", n_spans)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with a calibrated toxicity score."""
    docs, labels = (spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("documents", "labels"))
    model = toxicity.fit(docs, labels)
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    return scored.select(
        "row.doc_id", toxicity.held_out(F.col("row.doc_id")).alias("held_out"), "score",
        (F.col("score") >= model.parameters.threshold).cast("int").alias("predicted"),
    )


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the words and items of the benchmark that its text repeats."""
    docs, items = (spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("documents", "benchmark"))
    found = contamination(docs, items)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated",
    )


def op7_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors found for every hundredth one."""
    work = Workspace(spark, "vectors")
    vectors = permutation_index.valid_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    index, pivots = permutation_index.build(vectors, work)
    return permutation_index.nearest(index, pivots, index.where("vec_id % 100 = 0"))


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the target of its source and the words the mix takes of it."""
    mixed = with_copies(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return mixed.select("doc_id", "size", "source_size", "target", taken)


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The visible text of every page."""
    pages = extract_text(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "html"))
    return pages.select("page_id", F.length("text").cast("bigint").alias("n_chars"), "text")


def op10_paragraph_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the paragraphs and passages that repeat others and the documents that keep them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return paragraph_summary(docs).drop("rid")


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The periodic runs of every document, every tenth of which has one planted by its id."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return run_digest(periodic_runs(with_planted_runs(docs)))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents, some misspelt by a hash, with the words they are variants of."""
    words = misspelt_words(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return variants(vocabulary(words), Workspace(spark, "spelling"))


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The licences that every document names or quotes."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return license_digest(license_spans(docs.select("doc_id", "text")))


QUERIES: dict[str, Query] = {
    "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
    "op2_suffix_array_dedup": op2_suffix_array_dedup,
    "op3_token_orc_output": op3_token_orc_output,
    "op4_personal_data": op4_personal_data,
    "op5_toxicity": op5_toxicity,
    "op6_benchmark_decontamination": op6_benchmark_decontamination,
    "op7_permutation_index": op7_permutation_index,
    "op8_mix_sources": op8_mix_sources,
    "op9_html_text": op9_html_text,
    "op10_paragraph_dedup": op10_paragraph_dedup,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_license_scan": op13_license_scan,
}

# Words as the operators take them: A-Z lowered, runs of digits, a-z and non-ASCII.
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_sql(column: str) -> str:
    lowered = f"translate(coalesce({column}, ''), '{_UPPER}', '{_LOWER}')"
    return rf"regexp_extract_all({lowered}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def shingles_sql(words: str, width: int = 5) -> str:
    return f"""CASE WHEN len({words}) >= {width}
        THEN list_transform(range(1, len({words}) - {width - 2}), lambda i: array_to_string({words}[i:i + {width - 1}], ' '))
        WHEN len({words}) > 0 THEN [array_to_string({words}, ' ')] ELSE [] END"""


SQL: dict[str, str] = {
    "op1_ngram_jaccard_join": f"""
WITH RECURSIVE w AS (SELECT doc_id, {words_sql("text")} AS words FROM documents),
s AS (SELECT DISTINCT doc_id, unnest({shingles_sql("words")}) AS shingle FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
      FROM s x JOIN s y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM c JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b
      WHERE 10 * common >= 8 * (p.n + q.n - common)),
reach AS (SELECT doc_id AS node, doc_id AS root FROM documents
          UNION SELECT e.b, reach.root FROM reach JOIN e ON e.a = reach.node),
links AS (SELECT a, count(*) AS n FROM e GROUP BY a),
class AS (SELECT node, min(root) AS class_id FROM reach GROUP BY node)
SELECT doc_id, class_id, coalesce(links.n, 0) AS n_links
FROM documents JOIN class ON node = doc_id LEFT JOIN links ON a = doc_id""",
    "op6_benchmark_decontamination": f"""
WITH d AS (SELECT doc_id, {words_sql("text")} AS words FROM documents),
i AS (SELECT item_id::VARCHAR AS item, {words_sql("text")} AS words FROM benchmark),
windows AS (SELECT DISTINCT item, size, unnest(list_transform(range(1, len(words) - size + 2),
              lambda k: array_to_string(words[k:k + size - 1], ' '))) AS phrase
            FROM (SELECT *, least(13, len(words)) AS size FROM i WHERE len(words) > 0)),
sizes AS (SELECT DISTINCT size FROM windows),
places AS (SELECT doc_id, size, unnest(range(1, len(words) - size + 2)) AS pos,
             unnest(list_transform(range(1, len(words) - size + 2), lambda k: array_to_string(words[k:k + size - 1], ' '))) AS phrase
           FROM d, sizes WHERE len(words) >= size),
found AS (SELECT doc_id, pos, p.size, item FROM places p JOIN windows w ON w.size = p.size AND w.phrase = p.phrase),
hit AS (SELECT doc_id, count(DISTINCT word) AS n_hit
        FROM (SELECT doc_id, unnest(range(pos, pos + size)) AS word FROM (SELECT DISTINCT doc_id, pos, size FROM found)) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
          FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id)
SELECT d.doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM d LEFT JOIN hit ON hit.doc_id = d.doc_id LEFT JOIN named ON named.doc_id = d.doc_id""",
    "op8_mix_sources": rf"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS place FROM s),
w AS (SELECT *, 1 + (place - 1) % 3 AS weight, 3 * source_size AS cap,
      sum(source_size) OVER () AS total, sum(1 + (place - 1) % 3) OVER () AS weights FROM r),
b AS (SELECT *, coalesce(sum(cap) OVER before, 0) AS cap_before, coalesce(sum(weight) OVER before, 0) AS weight_before
      FROM w WINDOW before AS (ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
c AS (SELECT *, (total - cap_before)::DOUBLE / (weights - weight_before)::DOUBLE * weight > cap AS capped FROM b),
u AS (SELECT *, (total - coalesce(sum(CASE WHEN capped THEN cap END) OVER (), 0))::DOUBLE
      / (weights - coalesce(sum(CASE WHEN capped THEN weight END) OVER (), 0))::DOUBLE AS unit FROM c),
t AS (SELECT source, source_size, CASE WHEN capped THEN cap::DOUBLE ELSE unit * weight END AS target FROM u),
j AS (SELECT doc_id, size, source_size, target,
      CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate,
      ('0x' || substr(sha256(coalesce(doc_id::VARCHAR, 'null') || '|1'), 1, {HEX_DIGITS}))::BIGINT
        / {float(16**HEX_DIGITS)!r} AS draw
      FROM sized JOIN t ON sized.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size::BIGINT AS size, source_size, target,
  (size * (floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken FROM j""",
}
