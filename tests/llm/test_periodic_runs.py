import hashlib
import random
import zlib
from fractions import Fraction

from tests.llm import helpers as H
from tidewater.llm.periodic_runs import periodic_runs, run_digest, runs_of_texts, with_planted_runs
from tidewater.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def runs_of(words, least=24, copies=3):
    """Every maximal stretch of words one period apart that are equal, by its smallest period."""
    found = {}
    for period in range(1, len(words) // copies + 1):
        at = 0
        while at + period < len(words):
            start = at
            while at + period < len(words) and words[at] == words[at + period]:
                at += 1
            if at + period - start >= max(least, copies * period):
                found.setdefault((start, at + period), period)
            at += 1
    return sorted(((s, e - s, p) for (s, e), p in found.items()), key=lambda run: (run[0], run[2]))


def planted(doc_id, words):
    h = zlib.crc32(("null" if doc_id is None else str(doc_id)).encode())
    if h % 10 or not words:
        return words
    g = h // 10
    first = g % len(words)
    period = 1 + (len(words) - first) // (3 + g % 8)
    return words[:first] + [words[first + (i - first) % period] for i in range(first, len(words))]


def digest_row(doc_id, text):
    words = planted(doc_id, (text or "").encode().split())
    runs = runs_of(words)
    best = min(runs, key=lambda run: (-Fraction(run[1], run[2]), run[0], run[2])) if runs else (None,) * 3
    kept = [True] * len(words)
    for start, length, period in runs:
        kept[start + period : start + length] = [False] * (length - period)
    lines = "".join(f"{s},{n},{p}\n" for s, n, p in runs).encode()
    text = b" ".join(word for word, keep in zip(words, kept, strict=True) if keep)
    milli = best[1] * 1000 // best[2] if runs else None
    return (doc_id, len(runs), *best, milli, hashlib.sha256(lines).hexdigest(), hashlib.sha256(text).hexdigest())


def test_runs_equal_brute_force():
    rnd, texts = random.Random(5), []
    for _ in range(600):
        letters, words = rnd.choice([1, 2, 3, 6, 60]), []
        while len(words) < rnd.choice([5, 30, 80, 200]):
            block = [b"%d" % rnd.randrange(letters) for _ in range(rnd.randrange(1, 14))]
            words += block * rnd.randrange(2, 9) if rnd.random() < 0.5 else block
            if rnd.random() < 0.2:
                words += words[: rnd.randrange(len(words) + 1)]
        texts.append(words)
    for least, copies in ((24, 3), (4, 2), (7, 3)):
        found = [runs for at in range(0, 600, 75) for runs in runs_of_texts(texts[at : at + 75], least, copies)]
        assert found == [runs_of(words, least, copies) for words in texts]
    assert sum(map(len, found)) > 600


def test_one_long_text():
    assert runs_of_texts([[b"a"] * 60_000, [], [b"b"] * 23]) == [[(0, 60_000, 1)], [], []]
    block = [b"%d" % i for i in range(20_000)]
    assert runs_of_texts([block * 3 + block[:5]]) == [[(0, 60_005, 20_000)]]


def test_odd_rows_and_clashing_names(spark):
    rows = [*H.ODD_ROWS, (7, "a b " * 12), (8, "a b  c " * 30), (8, "x " * 24), (None, "y z " * 40), (9, "\x0b\x0cq\r" * 24)]
    rows += [(i, "w " * (20 + i)) for i in range(40)]
    schema = "doc_id bigint, text string, runs int, found int, words int, n int, `first` int, row int, h int, n_words int"
    docs = spark.createDataFrame([(*row, *[1] * 8) for row in rows], schema)
    found = run_digest(periodic_runs(with_planted_runs(docs)))
    assert H.by_text(map(tuple, found.collect())) == H.by_text(digest_row(*row) for row in rows)
    kept = periodic_runs(docs)
    assert kept.columns == ["row", "n_words", "runs", "collapsed"]
    assert kept.select("row.*").columns == docs.columns and kept.count() == len(rows)
    assert kept.where("row.doc_id = 7").first().collapsed == "a b"
    assert run_digest(periodic_runs(with_planted_runs(docs.where("false")))).count() == 0


def test_runs_of_the_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    found = QUERIES["op11_periodic_runs"](spark, SF)
    assert found.columns == [
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"
    ]
    assert dict(found.dtypes)["n_runs"] == dict(found.dtypes)["exponent_milli"] == "bigint"
    assert H.by_text(map(tuple, found.collect())) == H.by_text(digest_row(*row) for row in rows)
