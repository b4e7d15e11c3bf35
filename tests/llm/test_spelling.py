import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.llm import helpers as H
from tidewater.llm import spelling as S
from tidewater.llm.queries import QUERIES
from tidewater.llm.tables import Workspace

SF = "/root/testdata/sf0.001"
RUN = re.compile("[A-Za-zÀ-ÿ]+")


def words_of(rows):
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'null' if doc_id is None else doc_id}:{run}".encode())
            at = h % len(run)
            yield run[:at] + run[at + 1 :] if h % 31 == 0 else run


def near(vocabulary):
    """Pairs that share what is left when a letter of one, or the same of both, is taken away."""
    lacking, pairs = defaultdict(set), set()
    for word in vocabulary:
        for i in range(len(word)):
            left = word[:i] + word[i + 1 :]
            if left in vocabulary:
                pairs |= {(word, left), (left, word)}
            lacking[i, left].add(word)
    for group in lacking.values():
        pairs |= {(a, b) for a in group for b in group if a != b}
    return pairs


def variant_rows(vocabulary, ratio=10):
    around = defaultdict(set)
    for a, b in near(vocabulary):
        around[a].add(b)
    form = {}
    for word, others in around.items():
        best = min(others, key=lambda w: (-vocabulary[w], w))
        if vocabulary[best] >= ratio * vocabulary[word]:
            form[word] = best
    out = []
    for word, n in vocabulary.items():
        root = word
        while root in form:
            root = form[root]
        other = form.get(word)
        out.append((word, other, root, n, len(around[word]), vocabulary.get(other)))
    return out


def test_one_edit_on_random_blocks():
    rnd = random.Random(3)
    for size in (1, 2, 5, 9):
        words = sorted({"".join(rnd.choice("abé") for _ in range(rnd.choice([size - 1, size]))) for _ in range(150)} - {""})
        codes = np.array(words, f"U{size}").view(np.uint32).reshape(len(words), size)
        query, answer = S.one_edit(codes, codes[:, -1] != 0)
        found = {(words[a], words[b]) for a, b in zip(query.tolist(), answer.tolist(), strict=True)}
        assert len(found) == len(query)
        assert found == {(a, b) for a, b in near(set(words)) if len(a) == size}


@pytest.mark.parametrize("index", [1024, 16])
def test_variants_equal_brute_force(spark, monkeypatch, index):
    """Also with buckets that hold many times what an index does, and words longer than it holds."""
    monkeypatch.setattr(S, "INDEX_WORDS", index)
    rnd, counts = random.Random(index), Counter()
    for _ in range(1500):
        word = "prefix" + "".join(rnd.choice("ab") for _ in range(rnd.randrange(2, 9)))
        counts[word] = rnd.choice([1, 2, 3, 40, 500])
    for word in list(counts)[::7]:
        counts[word[::-1]] = counts["é" + word] = rnd.choice([1, 30])
    long = "".join(rnd.choice("abc") for _ in range(20_000))
    counts |= Counter({long: 3, long[1:]: 40, long[:-1] + "z": 5, long[:9_000] + "q" + long[9_000:]: 1})
    counts |= Counter({"a": 1, "b": 20, "ab": 300})
    words = spark.createDataFrame(list(counts.items()), "word string, n bigint").repartition(3)
    found = S.variants(words, Workspace(spark, "test"))
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert H.by_text(map(tuple, found.collect())) == H.by_text(variant_rows(counts))


def test_odd_rows(spark):
    rows = [*H.ODD_ROWS, (5, "Grammar grammar GRAMMAR grammer grammar" * 9), (5, "ÉCLAIRÉS éclairés Éclairés × ÷éclair")]
    rows += [(None, "another another"), (6, "x" * 20_000 + " " + "x" * 20_000), (6, "x" * 19_999 + " " + "x" * 19_999)]
    docs = spark.createDataFrame([(*row, 1, 2, 3) for row in rows], "doc_id bigint, text string, word int, n int, h int")
    counts = Counter(word for word in words_of(rows) if len(word) >= 7)
    vocabulary = {word: n for word, n in counts.items() if n >= 2}
    found = S.variants(S.vocabulary(S.misspelt_words(docs)), Workspace(spark, "test"))
    assert H.by_text(map(tuple, found.collect())) == H.by_text(variant_rows(vocabulary))
    assert S.variants(S.vocabulary(S.misspelt_words(docs.where("false"))), Workspace(spark, "test")).count() == 0


def test_variants_of_the_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    counts = Counter(word for word in words_of(rows) if len(word) >= 7)
    found = QUERIES["op12_spelling_variants"](spark, SF)
    expected = variant_rows({word: n for word, n in counts.items() if n >= 2})
    assert any(row[1] for row in expected)
    assert H.by_text(map(tuple, found.collect())) == H.by_text(expected)
