"""Plain Python versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from itertools import combinations

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

# Rows that every operator has to take: nulls, empty and tiny texts, repeated rows and ids.
ODD_ROWS = [(None, "no id at all"), (1, None), (2, ""), (3, "word"), (3, "word"), (3, "another text"), (4, " \n\t ")]


def words(text):
    lowered = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return WORD.findall(lowered)


def shingles(text, width=5):
    found = words(text)
    width = min(width, len(found))
    return frozenset(tuple(found[i : i + width]) for i in range(len(found) - width + 1)) if width else frozenset()


def components(count, edges):
    root = list(range(count))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return [find(i) for i in range(count)]


def least_id(ids):
    return min((i for i in ids if i is not None), default=None)


def similar(sets, threshold=0.8):
    return [
        (a, b) for a, b in combinations(range(len(sets)), 2)
        if sets[a] and len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b])
    ]


def jaccard_rows(rows):
    """``(doc_id, class_id, n_links)`` of rows ``(doc_id, text)``."""
    edges = similar([shingles(text) for _, text in rows])
    roots = components(len(rows), edges)
    links = Counter(i for edge in edges for i in edge)
    classes = {}
    for i, root in enumerate(roots):
        classes.setdefault(root, []).append(rows[i][0])
    return [(rows[i][0], least_id(classes[roots[i]]), links[i]) for i in range(len(rows))]


def removal_rows(rows, length):
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256)``."""
    data = [(text or "").encode() for _, text in rows]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for (doc_id, _), d in zip(rows, data, strict=True):
        mark = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                mark[i : i + length] = b"\1" * length
        runs = sum(bool(m) and (i == 0 or not mark[i - 1]) for i, m in enumerate(mark))
        kept = bytes(b for b, m in zip(d, mark, strict=True) if not m)
        out.append((doc_id, len(d), sum(mark), runs, hashlib.sha256(kept).hexdigest()))
    return out


def contamination_rows(rows, items, window=13, slop=0):
    """``(doc_id, n_words, n_hit, items)``."""
    windows = {}
    for item, text in items:
        found = words(text)
        size = min(window, len(found))
        for i in range(len(found) - size + 1 if size else 0):
            windows.setdefault(tuple(found[i : i + size]), set()).add("null" if item is None else str(item))
    out = []
    for doc_id, text in rows:
        found, hit, named = words(text), set(), set()
        for size in {len(w) for w in windows}:
            for i in range(len(found) - size + 1):
                if tuple(found[i : i + size]) in windows:
                    hit.update(range(i, i + size))
                    named |= windows[tuple(found[i : i + size])]
        out.append((doc_id, len(found), len(hit), sorted(named)))
    return out


def by_text(rows):
    return sorted(rows, key=str)
