import random

import numpy as np
import pyarrow as pa
import pytest

from tests.llm import helpers as H
from tidewater.llm import words as W
from tidewater.llm.decontaminate import Contamination, contamination, decode_postings, encode_postings
from tidewater.llm.jaccard_join import JaccardJoin, jaccard_classes, keep_one_per_class, least_matches
from tidewater.llm.paragraph_dedup import Paragraphs, keys_and_bands, kept_text, paragraph_summary, pieces_of, sets_of
from tidewater.llm.paragraph_dedup import without_repeats as without_paragraphs
from tidewater.llm.suffix_dedup import Repeats, removal_digest
from tidewater.llm.suffix_dedup import without_repeats as without_strings

DOC = "doc_id bigint, text string"


def sentence(rnd, count, size=400):
    return " ".join(f"w{rnd.randrange(size)}" for _ in range(count))


@pytest.fixture(scope="module")
def copies():
    """Texts of several groups of near and exact copies, and odd rows."""
    rnd = random.Random(5)
    rows = list(H.ODD_ROWS)
    for group in range(6):
        base = sentence(rnd, 90).split()
        for _ in range(9):
            text = list(base)
            for _ in range(rnd.randrange(4)):
                text[rnd.randrange(len(text))] = f"new{rnd.randrange(9)}"
            rows.append((100 * group + rnd.randrange(50) + 10, " ".join(text)))
    rows += [(900 + i, sentence(rnd, 40)) for i in range(10)]
    rows += [(950, rows[20][1]), (951, sentence(rnd, 5000))]
    return rows


def test_words_of_a_column():
    texts = ["Ab cd, éF-9", None, "", "x", "éF ab", "ab" * 300_000]
    hashes, rows = W.word_hashes(pa.array(texts))
    assert np.diff(rows).tolist() == [len(H.words(t)) for t in texts]
    names = [w for t in texts for w in H.words(t)]
    assert len(set(hashes.tolist())) == len(set(names))
    assert hashes[0] == hashes[6] and hashes[2] == hashes[5] != hashes[0]


def test_posterior_bounds():
    bounds = least_matches(0.8, 1e-6, 64, 16)
    assert list(bounds) == sorted(bounds) and bounds[-1] < 0.8 * 64
    assert least_matches(0.8, 1e-3, 64, 16)[-1] > bounds[-1]


@pytest.mark.parametrize("block", [384, 3])
def test_jaccard_classes(spark, copies, block):
    found = jaccard_classes(spark.createDataFrame(copies, DOC), JaccardJoin(block=block))
    found = found.select("doc_id", "class_id", "n_links").collect()
    assert H.by_text(map(tuple, found)) == H.by_text(H.jaccard_rows(copies))


def test_one_document_of_each_class_stays(spark, copies):
    docs = spark.createDataFrame([(*row, "s", 7) for row in copies], DOC + ", rid string, low int")
    kept = keep_one_per_class(docs)
    assert kept.columns == docs.columns
    rows = [(row.doc_id, row.text) for row in kept.collect()]
    assert {(row.rid, row.low) for row in kept.collect()} == {("s", 7)}
    assert not H.similar([H.shingles(text) for _, text in rows])
    assert len(rows) == len(set(H.components(len(copies), H.similar([H.shingles(t) for _, t in copies]))))


def test_empty_tables(spark):
    docs = spark.createDataFrame([], DOC)
    items = spark.createDataFrame([], "item_id bigint, text string")
    assert jaccard_classes(docs).count() == 0
    assert keep_one_per_class(docs).count() == 0
    assert removal_digest(docs).count() == 0
    assert paragraph_summary(docs).count() == 0
    assert contamination(docs, items).count() == 0
    some = spark.createDataFrame([(1, "a b c")], DOC)
    assert contamination(some, items).first().asDict()["contaminated"] is False


@pytest.mark.parametrize("p", [Repeats(length=40, head=21), Repeats(length=40, head=21, batches=3, regions=1, buffer=64),
                               Repeats(length=40, head=15, batches=1)])
def test_repeated_strings(spark, p):
    rnd = random.Random(p.batches)
    letters = lambda n: "".join(rnd.choice("abcé \n") for _ in range(n))
    base = [letters(150) for _ in range(3)]
    rows = [*H.ODD_ROWS, (20, "x" * 39), (21, "x" * 40), (22, "x" * 41), (23, "ab" * 200), (24, "abc" * 50)]
    for i in range(60):
        text, at = rnd.choice(base), rnd.randrange(100)
        rows.append((30 + i, letters(rnd.randrange(40)) + text[at : at + rnd.randrange(30, 90)] + letters(rnd.randrange(40))))
    rows += [rows[-1], (200, base[0]), (201, base[0])]
    docs = spark.createDataFrame(rows, DOC).repartition(3)
    assert H.by_text(map(tuple, removal_digest(docs, p).collect())) == H.by_text(H.removal_rows(rows, p.length))


def test_kept_bytes_have_all_columns(spark):
    rows = [(1, "same text " * 10, "a"), (2, "same text " * 10 + "!", "b"), (3, None, "c")]
    kept = without_strings(spark.createDataFrame(rows, DOC + ", spans string"), Repeats(length=40, head=21))
    assert kept.columns == ["doc_id", "text", "spans", "kept"]
    assert {row.doc_id: bytes(row.kept) for row in kept.collect()} == {1: b"", 2: b"!", 3: b""}


def test_postings_round_trip():
    rnd = np.random.default_rng(1)
    word, place = rnd.integers(0, 5, 4000), np.sort(rnd.choice(10**9, 4000, replace=False))
    keys, counts, data, offsets = encode_postings(word, place)
    for i, key in enumerate(keys):
        found = decode_postings(data[offsets[i] : offsets[i + 1]].tobytes())
        assert found.tolist() == place[word == key].tolist() and counts[i] == len(found)


@pytest.fixture(scope="module")
def benchmark_rows():
    rnd = random.Random(9)
    items = [(i, sentence(rnd, rnd.randrange(8, 40), 60)) for i in range(12)] + [(None, "short item"), (90, None), (91, ""), (5, "short item")]
    rows = list(H.ODD_ROWS)
    for i in range(40):
        item = rnd.choice(items)[1] or ""
        part = item.split()[rnd.randrange(3) :]
        rows.append((10 + i, f"{sentence(rnd, rnd.randrange(60), 60)} {' '.join(part)}, {sentence(rnd, rnd.randrange(200), 60)}"))
    return rows, items


@pytest.mark.parametrize("size", [6 << 20, 100])
def test_contamination(spark, benchmark_rows, size):
    rows, items = benchmark_rows
    found = contamination(
        spark.createDataFrame([(*row, 1) for row in rows], DOC + ", block int"),
        spark.createDataFrame(items, "item_id bigint, text string"), Contamination(block_bytes=size),
    )
    expected = H.contamination_rows(rows, items)
    assert H.by_text((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in found.collect()) == H.by_text(expected)
    flagged = {(r.doc_id, r.n_words) for r in found.where("contaminated").collect()}
    assert flagged == {(d, n) for d, n, hit, _ in expected if hit and 20 * hit >= n}


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "one two x three four"), (2, "one x y z two three four"), (3, "one two three four")], DOC)
    items = spark.createDataFrame([(1, "one two three four")], "item_id bigint, text string")
    near = lambda slop: {r.doc_id for r in contamination(docs, items, Contamination(slop=slop)).where("n_hit > 0").collect()}
    assert near(0) == {3} and near(1) == {1, 3} and near(3) == {1, 2, 3}


def test_paragraphs(spark):
    rnd = random.Random(4)
    shared = [sentence(rnd, 60) for _ in range(3)]
    rows = list(H.ODD_ROWS)
    for i in range(30):
        lines = [sentence(rnd, rnd.randrange(1, 60)) for _ in range(rnd.randrange(4))]
        line = shared[i % 3].split()
        if i % 2:
            line[rnd.randrange(60)] = "changed"
        lines.insert(rnd.randrange(len(lines) + 1), " ".join(line))
        rows.append((10 + i, "\n".join(lines)))
    p = Paragraphs(block=4)
    units = [(row, place, line) for row, (_, text) in enumerate(rows) for place, line in enumerate((text or "").split("\n"))
             if len(H.words(line)) >= p.min_words]
    roots = H.components(len(units), H.similar([H.shingles(line) for *_, line in units]))
    docs = spark.createDataFrame(rows, DOC)
    found = {(r.doc_id, r.n_paragraphs): r for r in paragraph_summary(docs, p).collect() if r.doc_id and r.doc_id >= 10}
    for row, (doc_id, text) in enumerate(rows):
        if doc_id is None or doc_id < 10:
            continue
        mine = [i for i, unit in enumerate(units) if unit[0] == row and roots.count(roots[i]) > 1]
        again = [units[i][1] for i in mine if roots[i] != i]
        got = found[doc_id, text.count("\n") + 1]
        assert (got.n_repeated, sorted(got.removed)) == (len(mine), sorted(again))
        assert set(got.class_ids) == {rows[units[roots[i]][0]][0] for i in mine}
    cleaned = without_paragraphs(docs, p)
    assert cleaned.columns == docs.columns and cleaned.count() == len(rows)
    left = [line for r in cleaned.collect() for line in (r.text or "").split("\n") if len(H.words(line)) >= p.min_words]
    assert not H.similar([H.shingles(line) for line in left])
    assert {r.doc_id for r in cleaned.where("text IS NULL").collect()} == {1}


def test_short_paragraphs(spark):
    rnd = random.Random(8)
    short = [sentence(rnd, n) for n in (5, 6, 8, 12, 19)]
    near = " ".join(short[4].split()[:-1])  # 14 of 15 shingles
    rows = [(i, "\n".join([sentence(rnd, 30), *short, "too short here"])) for i in range(3)] + [(3, near)]
    found = {r.doc_id: r for r in paragraph_summary(spark.createDataFrame(rows, DOC)).collect()}
    assert (found[0].n_repeated, found[0].removed) == (5, [])
    for i in (1, 2):
        assert (found[i].n_repeated, found[i].removed, found[i].class_ids) == (5, [1, 2, 3, 4, 5], [0])
    assert found[3].removed == [0]


def test_passages_inside_and_over_lines(spark):
    rnd = random.Random(11)
    text = lambda n: sentence(rnd, n, 100_000)
    shared, other = text(51).split(), text(90)
    over = "\n".join(" ".join(shared[i : i + 3]) for i in range(0, 51, 3))
    rows = [
        (1, text(300) + " " + " ".join(shared) + " " + text(200)), (2, text(80) + " " + " ".join(shared) + " " + text(300)),
        (3, text(40) + "\n" + over + "\n" + text(40)), (4, text(500)), (5, other), (6, text(70) + " " + other), (7, "\n".join(["a b", *over.split("\n")])),
        (8, "é " * 3 + text(60) + "\n" + text(30) + " " + " ".join(shared)), (9, None), (9, "word"),
    ]
    rows.append((None, rows[1][1]))
    docs = spark.createDataFrame(rows, DOC)
    found = {(r.doc_id): r for r in paragraph_summary(docs).collect()}
    kept = {(r.doc_id, r.text and len(r.text)): r.text for r in without_paragraphs(docs).collect()}
    # The row without an id comes first; its line is also that of document 2.
    assert found[2].n_removed == 1 and not found[2].passages and found[4].n_passages == 0 and found[None].n_passages > 0
    for doc_id in (1, 3, 6, 7, 8):
        row, whole = found[doc_id], dict(rows[:8])[doc_id].encode()
        assert row.n_removed == 0 and row.n_passages == 1 and len(row.passages) == 1
        cut = H.words(whole[row.passages[0].start : row.passages[0].end].decode())
        inside = H.words(other) if doc_id == 6 else shared
        assert len(cut) >= 16 and " ".join(cut) in " ".join(inside)
    assert found[6].passage_ids == [5] and found[5].n_passages == 1 and not found[5].passages
    cleaned = {doc_id: text for (doc_id, _), text in kept.items()}
    assert cleaned[None] == rows[1][1] and cleaned[2] == "" and cleaned[4] == rows[3][1] and len(H.words(cleaned[1])) <= 551 - 16


def test_long_passages_of_a_whole_table(spark):
    """Beside every window of 51 words that another text has, in copies that are kept and removed alike."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    windows = {}
    for r in docs.collect():
        found = H.words(r.text)
        for i in range(len(found) - 50):
            windows.setdefault(tuple(found[i : i + 51]), set()).add(r.doc_id)
    sharing = {doc_id for owners in windows.values() if len(owners) > 1 for doc_id in owners}
    flagged = {r.doc_id for r in paragraph_summary(docs).where("n_long > 0").collect()}
    others = docs.count() - len(sharing)
    assert len(flagged & sharing) >= 0.97 * len(sharing) and len(flagged - sharing) <= 0.03 * others


def test_one_hot_passage(spark):
    """Half of all pieces are one passage; it is counted in every text and removed from all but one."""
    rnd = random.Random(7)
    shared = sentence(rnd, 60)
    rows = [(i, f"{sentence(rnd, 25, 100_000)} {shared} {sentence(rnd, 25, 100_000)}") for i in range(300)]
    rows += [(i, sentence(rnd, 80, 100_000)) for i in range(300, 330)]
    found = {r.doc_id: r for r in paragraph_summary(spark.createDataFrame(rows, DOC)).collect()}
    assert all((found[i].n_long > 0) == (i < 300) for i in found)
    assert [i for i in range(300) if not found[i].passages] == [0]


def test_pieces_of_shared_passages():
    rnd, p = np.random.default_rng(2), Paragraphs()
    for _ in range(300):
        shared = rnd.integers(0, 1 << 60, 51)
        texts = [np.concatenate((rnd.integers(0, 1 << 60, rnd.integers(0, 60)), shared, rnd.integers(0, 1 << 60, rnd.integers(0, 60)))) for _ in range(2)]
        rows = np.cumsum([0, len(texts[0]), 0, 3, len(texts[1])])
        row, first, stop, compared, key = pieces_of(np.concatenate((*texts[:1], shared[:3], *texts[1:])).astype(np.uint64), rows, p)
        assert set(row) == {0, 3} and (np.diff(first) > 0).all() and (stop[:-1][row[1:] == row[:-1]] == first[1:][row[1:] == row[:-1]]).all()
        assert first[0] == 0 and stop[-1] == rows[-1] and stop[row == 0][-1] == rows[1] and compared.max() <= p.window + p.width - 1
        common = np.isin(key[row == 0], key[row == 3])
        assert (compared[row == 0][common] - p.width + 1).sum() + p.width - 1 >= p.passage


def test_kept_text():
    assert kept_text("a b c d", [], [{"start": 2, "end": 5}]) == "a  d"
    assert kept_text("one two\nthree\n\nfour five\nsix", [4], [{"start": 4, "end": 19}]) == "one \n five"
    assert kept_text("é x\ny", [1], [{"start": 0, "end": 2}]) == " x"


def test_sets_of_many_ranges():
    rnd = np.random.default_rng(3)
    words = W.mix(rnd.integers(0, 6, 300).astype(np.uint64))
    starts = np.sort(rnd.integers(0, 280, 40))
    ends = starts + rnd.integers(1, 20, 40)
    values, begin = sets_of(words, starts, ends, 5)
    p = Paragraphs()
    low, high, bands = keys_and_bands(values, begin, p)
    for i, (a, b) in enumerate(zip(starts, ends, strict=True)):
        one = W.distinct(W.shingles(words[a:b], 5))
        assert values[begin[i] : begin[i] + len(one)].tolist() == one.tolist()
        assert (low[i], high[i]) == W.set_key(one)
        assert bands[i].tolist() == W.band_keys(W.minhash(one, p.bands * p.rows, p.seed), p.rows).tolist()
