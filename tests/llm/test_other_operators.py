import random
import re
import zlib

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm import helpers as H
from tidewater.llm import permutation_index as N
from tidewater.llm import pii, toxicity
from tidewater.llm.html_text import extract_text, render
from tidewater.llm.mixing import mixed, source_targets, with_copies
from tidewater.llm.tables import Workspace
from tidewater.llm.token_orc import Encoder, read_token_files, token_digest, write_token_files

DOC = "doc_id bigint, text string"
SF = "/root/testdata/sf0.01"


def test_pieces_give_the_ids_of_whole_texts():
    encoder = Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    rnd = random.Random(2)
    parts = ["a", "b", "é", " ", "  ", "\n", "'s", "'", "1", "²", "½", "\t", "​", "\x1c", "\x85", "中", "😀", ".", "!!", " x", "×",
             "<|endoftext|>", "\r\n", "ı", "　", "it's", "'LL", "word", " Word", "é" * 60]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randrange(30))) for _ in range(3000)]
    expected = [np.array(e.ids, "<u4").tobytes() for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [ids for at in range(0, 3000, 200) for ids in encoder.encode(texts[at : at + 200])] == expected


def test_words_are_told_apart_without_offsets():
    encoder = Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    whole, words = encoder.tokenizer, [f" {'é' * (i % 3)}word{chr(97 + i % 26)}{'xyz' * (i % 7)}" for i in range(1200)]
    expected = [np.array(e.ids, "<u4").tobytes() for e in whole.encode_batch(words, add_special_tokens=False)]

    class WithoutOffsets:
        encode_batch_fast = staticmethod(whole.encode_batch_fast)

    encoder.tokenizer = WithoutOffsets
    assert encoder._word_ids(words) == expected
    encoder.tokenizer, encoder.sizes = whole, None  # another kind of tokenizer
    assert encoder._word_ids(words) == expected


def test_token_files(spark, tmp_path):
    rows = [*H.ODD_ROWS, *[(i, f"document {i} " * (i % 50)) for i in range(200, 20, -1)]]
    path = str(tmp_path / "tokens")
    docs = spark.createDataFrame([(*row, 3) for row in rows], DOC + ", before int").repartition(4)
    write_token_files(docs, path, files=5)
    files = read_token_files(spark, path)
    assert files.where("doc_id = 77").select("n_tokens").count() == 1  # a filter the row indexes serve
    found = sorted(token_digest(files).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in found] == sorted((d for d, _ in rows), key=lambda d: (d is not None, d))
    assert [r.start for r in found] == np.cumsum([0, *[r.n_tokens for r in found]])[:-1].tolist()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    sums = [zlib.crc32(np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4").tobytes()) for _, t in rows]
    assert sorted(r.ids_crc32 for r in found) == sorted(sums)
    empty = str(tmp_path / "none")
    write_token_files(spark.createDataFrame([], DOC), empty)
    assert token_digest(read_token_files(spark, empty)).count() == 0


FORMS = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def strict(text):
    out = []
    for kind, form in enumerate(FORMS):
        for found in re.finditer(form, text):
            digits = re.sub(r"[^0-9]", "", found[0])
            good = (
                True,
                all(int(x) <= 255 for x in found[0].split(".")) if kind == 1 else False,
                13 <= len(digits) <= 19 and pii.luhn(digits),
                9 <= len(digits) <= 15,
            )[kind]
            if good:
                out.append((kind, *found.span()))
    return sorted(out)


def test_base_spans():
    rnd = random.Random(1)
    for _ in range(20_000):
        text = "".join(rnd.choice("ab@..12345+- ()é") for _ in range(rnd.randrange(45)))
        assert sorted(pii.base_and_failed(text)[0]) == strict(text), text
    assert pii.valid(1, "0" * 5000 + "1.2.3.4") and not pii.valid(1, "1" * 5000 + ".2.3.4")


def test_personal_data(spark):
    people = "mail ann.b@ex-ample.com or call +1 (415) 555-2671 from 10.0.0.7, card 4111 1111 1111 1111"
    rows = [*H.ODD_ROWS, (10, people), (11, "version 1.2.3.400 and 1234567890123"), (12, "9" * 200_000)]
    rows += [(20 + i, f"{people} {i}") for i in range(60)]
    docs = spark.createDataFrame([(*row, "x") for row in rows], DOC + ", row string")
    model = pii.fit(docs)
    found = pii.find_spans(docs, model).collect()
    assert len(found) == len(rows)
    texts = {r[0]: r[1] or "" for r in rows if r[0] and r[0] >= 10}
    for row in found:
        if row.doc_id in texts:
            # The patterns take quadratic time on the long run of digits, which holds no span.
            expected = [] if row.doc_id == 12 else strict(texts[row.doc_id])
            assert row.base == pii.span_text(expected)
            assert set(row.base.split(",")) <= set(row.spans.split(","))
        else:
            assert row.base == row.spans == ""
    clean = {r.doc_id: r.text for r in pii.redacted(docs).collect() if r.doc_id and r.doc_id >= 10}
    assert clean[10] == "mail [EMAIL] or call [PHONE] from [IP], card [CARD]"
    assert pii.find_spans(spark.createDataFrame([], DOC), model).count() == 0


def test_loose_forms_are_scored(spark):
    text = "reach us at joe [at] site [dot] org or phone 415-555-2671 today"
    assert {span[0] for span in pii.proposals(text, [], [])} == {0, 3}
    assert len(pii.features(text, (0, 12, 34))) == pii.FEATURES
    assert pii.chosen([(0, 0, 5)], [(0.9, (3, 4, 9)), (0.95, (2, 6, 12)), (0.91, (3, 8, 15))]) == [(0, 0, 5), (2, 6, 12)]


def test_loose_forms_are_accepted(spark):
    """Trained on the given texts, the trees add loose spellings and leave other numbers alone."""
    model = pii.fit(spark.read.parquet(f"{SF}/documents.parquet"))
    assert all(threshold < 1 for threshold in model.thresholds)
    loose = [
        "please mail joe.b (at) site (dot) org for more", "write to joe [at] site.org today", "contact: ann{at}ex-ample.co.uk now",
        "the host 10 . 0 . 0 . 7 is down", "server address 192. 168. 1. 20 replied", "login from 2001:0db8:85a3:0000:0000:8a2e:0370:7334 today",
        "pay by card 4111.1111.1111.1111 please", "visa 4111/1111/1111/1111 was used", "phone (415) 555-2671 in the evening",
        "call 415-555-2671 or write", "fax 415.555.2671 is open",
    ]
    clean = [
        "version 1 . 2 . 3 . 400 is out", "order 415-555-2671 was sent", "the date 2024-01-15 and 12/05/2024", "we met (at) noon today",
        "card 4111.1111.1111.1112 is a typo", "times 12:30:45:10:11:12:13:14 of the run", "invoice 2024 0001 0002 0003 is paid", "joe (at) 5",
    ]
    rows = list(enumerate([*loose, *clean, "mail ann.b@ex-ample.com and joe [at] site.org"]))
    found = {r.doc_id: r for r in pii.find_spans(spark.createDataFrame(rows, DOC), model).collect()}
    kinds = ["email"] * 3 + ["ip"] * 3 + ["card"] * 2 + ["phone"] * 3
    for i, kind in enumerate(kinds):
        assert found[i].spans.startswith(kind + ":") and found[i].base == "", (loose[i], found[i].spans)
    for i, text in enumerate(clean, len(loose)):
        assert found[i].spans == found[i].base == "", (text, found[i].spans)
    assert found[len(rows) - 1].base == "email:5:23" and found[len(rows) - 1].spans == "email:5:23,email:28:45"


def test_toxicity_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{name}.parquet") for name in ("documents", "labels"))
    model = toxicity.fit(docs, labels)
    odd = spark.createDataFrame(H.ODD_ROWS, DOC)
    scored = toxicity.score(docs.select("doc_id", "text").unionByName(odd), model).select("row.doc_id", "score").toPandas()
    assert len(scored) == docs.count() + len(H.ODD_ROWS) and scored.score.between(0, 1).all()
    held = pd.DataFrame(labels.toPandas())
    held = held[[zlib.crc32(str(i).encode()) % 3 == 1 for i in held.doc_id]].merge(scored.drop_duplicates("doc_id"), on="doc_id")
    assert ((held.score >= 0.7) == held.toxic).mean() > 0.94
    toxic, clean = held[held.toxic == 1].score.values, held[held.toxic == 0].score.values
    assert (toxic[:, None] > clean[None, :]).mean() > 0.9


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "you idiot", 0.5), (2, None, 0.1)], DOC + ", score double")
    model = toxicity.fit(docs, spark.createDataFrame([], "doc_id bigint, toxic int"))
    scored = toxicity.score(docs, model)
    assert [r.score for r in scored.collect()] == [0.0, 0.0]
    assert scored.select("row.*").columns == docs.columns


@pytest.mark.parametrize("shard", [4096, 200])
def test_nearest_neighbours(spark, shard):
    table = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding")
    odd = [(1000, None), (1100, [0.0] * 64), (1200, [None] + [1.0] * 63), (1300, [float("nan")] * 64), (1400, [1.0, 2.0]), (None, [1.0] * 64)]
    table = table.unionByName(spark.createDataFrame(odd, "vec_id bigint, embedding array<float>"))
    p = N.PermutationIndex(shard=shard)
    index, pivots = N.build(N.valid_vectors(table), Workspace(spark, "test"), p)
    found = N.nearest(index, pivots, index.where("vec_id % 100 = 0"), 10, p).toPandas()
    rows = [r for r in table.collect() if r.vec_id is not None and r.vec_id < 1000]
    ids, points = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], dtype=float)
    hits = 0
    for query in ids[ids % 100 == 0]:
        far = np.sqrt(((points - points[ids == query][0]) ** 2).sum(axis=1))
        far[ids == query] = np.inf
        best = ids[np.lexsort((ids, far))[:10]]
        mine = found[found.query_id == query].sort_values("rank")
        assert mine["rank"].tolist() == list(range(1, 11)) and (np.diff(mine.score) >= 0).all()
        assert np.allclose(mine.score, [far[ids == i][0] for i in mine.vec_id], rtol=1e-12)
        hits += len(set(best) & set(mine.vec_id))
    assert hits >= 0.9 * 10 * (ids % 100 == 0).sum()
    assert set(found.query_id) == set(ids[ids % 100 == 0])


def test_a_third_of_equal_vectors(spark):
    rnd = np.random.default_rng(6)
    points = rnd.normal(size=(3000, 16))
    copy = rnd.permutation(3000)[:1000]
    points[copy] = points[copy[0]]
    rows = [(int(i), points[i].tolist()) for i in rnd.permutation(3000)]
    rows += [rows[7], (int(copy[1]), points[copy[1]].tolist())]
    p = N.PermutationIndex(shard=1500)
    index, pivots = N.build(N.valid_vectors(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")), Workspace(spark, "test"), p)
    asked = sorted(copy.tolist())[:3] + sorted(copy.tolist())[-3:]
    others = [i for i in range(3000) if i not in set(copy.tolist())][:10]
    found = N.nearest(index, pivots, index.where(f"vec_id IN ({','.join(map(str, asked + others))})"), 10, p).toPandas()
    hits = 0
    for query in asked + others:
        far = np.sqrt(((points - points[query]) ** 2).sum(axis=1))
        far[query] = np.inf
        best = np.lexsort((np.arange(3000), far))[:10].tolist()
        mine = found[found.query_id == query].sort_values("rank").vec_id.tolist()
        if query in asked:
            assert mine == best
        hits += len(set(mine) & set(best)) * (query in others)
    assert hits >= 0.8 * 10 * len(others)


def test_few_and_no_vectors(spark):
    for rows in ([], [(100, [1.0, 0.0])], [(100, [1.0, 0.0]), (100, [1.0, 0.0]), (3, [1.0, 0.0]), (2, [1.0, 0.0])]):
        table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
        index, pivots = N.build(N.valid_vectors(table), Workspace(spark, "test"))
        found = N.nearest(index, pivots, index.where("vec_id % 100 = 0"))
        if len(rows) < 2:
            assert found.count() == 0
        else:
            assert {tuple(r) for r in found.collect()} >= {(100, 1, 2, 0.0), (100, 2, 3, 0.0)}


def test_targets_and_copies(spark):
    sizes = {"a": 1000, "b": 10, "c": 5000, "d": 40, None: 300, "e": 0}
    rows = [(i, "w " * 10, name) for name, size in sizes.items() for i in range(size // 10)] + [(9000, None, "e"), (None, "", "e")]
    docs = spark.createDataFrame([(*row, "k", "r") for row in rows], DOC + ", source string, copies string, rate string")
    targets = {r.source: r for r in source_targets(with_copies(docs).select("source", "size")).collect()}
    weight = {name: 1 + i % 3 for i, name in enumerate(["a", "b", "c", "d", "e", None])}
    # shares by weight, held at three times the size, the excess going to the others
    held, total = {}, sum(sizes.values())
    while True:
        free = [name for name in sizes if name not in held]
        unit = (total - sum(held.values())) / sum(weight[name] for name in free)
        over = {name: 3 * sizes[name] for name in free if unit * weight[name] > 3 * sizes[name]}
        if not over:
            break
        held |= over
    for name, row in targets.items():
        assert row.source_size == sizes[name]
        assert row.target == pytest.approx(held.get(name, unit * weight[name]))
    taken = {r.source: r.words for r in with_copies(docs).selectExpr("source", "size * copies AS words").groupBy("source").agg({"words": "sum"})
             .withColumnRenamed("sum(words)", "words").collect()}
    for name in ("a", "c", None):
        assert abs(taken[name] - targets[name].target) < 0.15 * targets[name].target
    mix = mixed(docs)
    assert mix.columns == docs.columns and {(r.copies, r.rate) for r in mix.collect()} == {("k", "r")}
    assert H.by_text(mix.collect()) == H.by_text(mixed(docs.repartition(7)).collect())
    assert mixed(docs.where("false")).count() == 0


PAGES = [
    (None, ""), ("", ""), ("plain &amp; text", "plain & text"), ("a < b &lt; c", "a < b < c"),
    ("<p>one<p>two <b>bold</b><br>next", "one\n\ntwo bold\nnext"),
    ("<head><title>t</title></head><body>x<script>if (a<b) '</p>'</script>y<!-- <p>no --></body>", "xy"),
    ("<ul><li>a<li>b<ol start=3><li>c<li>d</ol></ul>e", "- a\n- b\n  3. c\n  4. d\n\ne"),
    ("<table><tr><th>Name<th>N<tr><td>a longer one<td>3<tr><td colspan=2>wide</table>", "Name          N\na longer one  3\nwide"),
    ("<table><tr><td rowspan=2>a</td><td>b</td></tr><tr><td>c</td></tr></table>", "a  b\n   c"),
    ("<div style='display: none'>no<p>no</p></div>yes<span hidden>no</span>", "yes"),
    ("<p style='visibility:hidden'>no <b style='visibility:visible'>seen</b></p>", "seen"),
    ("<pre> a\n  b</pre>c", " a\n  b\n\nc"), ("<details><summary>s</summary>no</details><details open>yes</details>", "s\nyes"),
    ("<p>a</div></td></p></nothing>b", "a\n\nb"), ("<a title='1 > 2' href=\"x>y\">t</a>", "t"), ("<style>p{}", ""), ("x<!-- open", "x"),
    ("<select><option>a<option>b</select>", "a\nb"), ("<dl><dt>t<dd>d<dt>u</dl>", "t\nd\nu"), ("a&nbsp;b  c\n d", "a b c d"),
    ("<h1>T</h1><p>x</p>", "T\n\nx"), ("<td>loose</td><li>x", "loose\n- x"), ("<IMG SRC=x>A<Br/>B", "A\nB"),
]


@pytest.mark.parametrize(("source", "text"), PAGES)
def test_page(source, text):
    assert render(source) == text


def test_pages_of_a_table(spark):
    deep = "<div>" * 100_000 + "deep"
    pages = spark.createDataFrame([(i, source, "t") for i, (source, _) in enumerate(PAGES)] + [(999, deep, "t")], "page_id int, html string, text string")
    found = {r.page_id: r.text for r in extract_text(pages).collect()}
    assert found == {i: text for i, (_, text) in enumerate(PAGES)} | {999: "deep"}
    assert extract_text(pages.where("false")).count() == 0
    render("<a href=\"" * 50_000), render("<table><tr><td>" * 3000), render("</i>" * 100_000), render("<p>x" * 50_000)
