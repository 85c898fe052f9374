"""Spelling variants, licence scans and whitening against brute force."""

import random
import re
import zlib
from collections import Counter
from itertools import product

import numpy as np
import pytest

from loamline.llm import licences, variants, whitening

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def near(a, b):
    """Exactly one edit apart."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def variants_of(docs):
    count = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1:]
            count[run] += 1
    count = {w: n for w, n in count.items() if len(w) >= 5 and n >= 3}
    out, form = [], {}
    found = {w: [v for v in count if near(w, v)] for w in count}
    for w, n in count.items():
        best = min(found[w], key=lambda v: (-count[v], v), default=None)
        form[w] = best if best and count[best] >= 2 * n else None
    for w, n in count.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(found[w]), count.get(form[w])))
    return out


def words_text(seed=8, n=120):
    rnd = random.Random(seed)
    stems = ["".join(rnd.choice("abcdeéß") for _ in range(rnd.randint(5, 9))) for _ in range(25)]
    docs = []
    for i in range(n):
        parts = []
        for _ in range(60):
            w = stems[int(len(stems) * rnd.random() ** 2)]
            for _ in range(rnd.choice([0, 0, 1, 1, 2])):
                k = rnd.randrange(len(w) + 1)
                w = w[:k] + rnd.choice(["", rnd.choice("abé")]) + w[k + rnd.randint(0, 1):]
            parts.append(rnd.choice([w, w.upper(), w.capitalize()]))
        docs.append((i, rnd.choice([" ", "-", "\n", "1"]).join(parts)))
    return docs + [(None, "Straße straße " * 4), (500, None), (501, ""), (502, "x" * 9000 + " " + "x" * 8999),
                   (502, "x" * 9000 + " " + "x" * 8999), (503, "x" * 9000 + " " + "x" * 8999)]


@pytest.mark.parametrize("group_rows", [4096, 3])
def test_variants_equal_brute_force(frame, monkeypatch, group_rows):
    """Also with groups dealt anew until their region is one letter."""
    monkeypatch.setattr(variants, "GROUP_ROWS", group_rows)
    docs = words_text()
    got = sorted(tuple(r) for r in variants.variants(frame(docs)).collect())
    want = sorted(variants_of(docs))
    assert [r[0] for r in got] == [r[0] for r in want]
    assert got == want and sum(r[1] is not None for r in got) > 20 and any(r[1] != r[2] for r in got if r[1])


def test_groups_are_bounded(spark, monkeypatch):
    """All words share a prefix: they are dealt by what follows it."""
    monkeypatch.setattr(variants, "GROUP_ROWS", 64)
    words = ["prefix" + "".join(w) for w in product("abc", repeat=6)]
    rows = spark.createDataFrame([(w, 3) for w in words], "word string, n long")
    sizes = variants.grouped(rows).groupBy("key").count()
    assert sizes.agg({"count": "max"}).first()[0] <= 64
    got = {r.word: r.n_near for r in variants.near_words(rows).collect()}
    assert len(got) == len(words) and set(got.values()) == {12}


def test_rows_of_a_long_list_in_blocks(monkeypatch):
    monkeypatch.setattr(variants, "QUERY_ROWS", 7)
    rnd = random.Random(4)
    words = sorted({"".join(rnd.choice("ab") for _ in range(rnd.choice([6, 7]))) for _ in range(150)})
    size = np.array([len(w) for w in words])
    x, y = variants.within_one(variants.letters(words, 7), size, np.zeros(len(words), np.int64), 6, 0)
    got = sorted((words[a], words[b]) for a, b in zip(x.tolist(), y.tolist()))
    assert got == sorted((a, b) for a in words for b in words if len(a) == 6 and near(a, b))


def base_of(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    at, labels = [], set()
    for phrase, label in (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")):
        p = phrase.split()
        for k in range(len(w) - len(p) + 1):
            if w[k:k + len(p)] == p:
                at.append(k)
                labels.add(label)
    return (len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels)))


def test_licences_equal_brute_force(frame):
    rnd = random.Random(6)
    pieces = ["cc", "by", "CC", "BY-NC", "general", "GENERAL", "public", "license", "License,", "all", "rights",
              "reserved", "Reserved.", "é", "\n", "\x85", " ", "a_b", "(c)", "mit", "über", "\x00", "spdx", "\t:"]
    docs = [(i, " ".join(rnd.choice(pieces) for _ in range(rnd.randint(0, 60)))) for i in range(150)]
    docs += [(None, "All rights\nreserved"), (None, None), (900, ""), (901, "cc by cc by " * 30_000), (901, "cc-by"),
             (902, "CCBY cc by-sa"), (903, "général public license")]
    got = [(r.doc_id, *tuple(r)[1:6]) for r in licences.licences(frame(docs)).collect()]
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(got, key=key) == sorted(((i, *base_of(t)) for i, t in docs), key=key)


@pytest.mark.parametrize("text, labels, score", [
    ("SPDX-License-Identifier: MIT OR GPL-2.0-only", {"mit", "gpl"}, 0.2),
    ("SPDX-License-Identifier: MIT AND GPL-2.0-or-later", {"mit", "gpl"}, 0.8),
    ("license: mit or gpl-3.0 and apache-2.0", {"mit", "gpl", "apache"}, 0.2),  # and binds closer
    ("license: (mit or gpl-3.0) and apache-2.0", {"mit", "gpl", "apache"}, 0.3),
    ("License: GPL-2.0 WITH Classpath-exception-2.0 AND MIT", {"gpl", "mit"}, 0.5),
    ("License: ((MIT", {"mit"}, 0.2),
    ("License: MIT AND AND", {"mit"}, 0.2),
    ("License: MIT) OR GPL-3.0", {"mit"}, 0.2),
    ("Licensed under Apache-2.0. And MIT", {"apache"}, 0.3),
    ("licensed under the BSD-3-Clause or LicenseRef-Mine", {"bsd", "other"}, 0.2),
    ("license mit dem", set(), 0.0),
    ("License: mitochondria", set(), 0.0),
    ("Released under the MIT License.", {"mit"}, 0.2),
    ("Licensed under CC BY-NC 4.0.", {"cc-by", "cc-by-nc"}, 0.9),
    ("GNU Lesser General Public License", {"gpl", "lgpl"}, 0.8),
    ("license: " + "(" * 5000 + "mit", {"mit"}, 0.2),
    ("license: mit-" + "1" * 100_000, set(), 0.0),
])
def test_expressions(text, labels, score):
    out = licences.scan(text)
    assert out[5] == labels and out[6] == pytest.approx(score)


def exact(table, top=32):
    """Brute force with Python integers."""
    x = [[int(np.floor(64 * float(np.float32(c)))) + 1000000 for c in v] for v in table]
    n, d = len(x), len(x[0])
    s = [sum(r[k] for r in x) for k in range(d)]
    cov = np.array([[(n * sum(r[i] * r[j] for r in x) - s[i] * s[j]) / n ** 2 for j in range(d)] for i in range(d)])
    values, vectors = np.linalg.eigh(cov)
    order = np.argsort(-values)[:top]
    z = np.array([[(n * r[k] - s[k]) / n for k in range(d)] for r in x])
    deviation = [sum((n * r[k] - s[k]) ** 2 for k in range(d)) for r in x]
    return n, deviation, z @ vectors[:, order] / np.sqrt(values[order]), values[order] / np.trace(cov)


@pytest.mark.parametrize("dims, spread", [(40, 1.0), (5, 300.0)])
def test_whitening_equals_brute_force(spark, monkeypatch, dims, spread):
    monkeypatch.setattr(whitening, "BLOCK_ROWS", 100)
    rng = np.random.default_rng(5)
    mixed = rng.normal(size=(dims, dims))
    table = (rng.normal(size=(350, dims)) @ mixed * spread / dims ** 0.5).astype(np.float32).tolist()
    table[1], table[2] = table[0], [0.0] * dims
    rows = [(i if i != 7 else None, v, 1, 0) for i, v in enumerate(table)]
    rows += [(900, None, 1, 0), (901, [None] * dims, 1, 0), (902, [float("nan")] * dims, 1, 0),
             (903, [float("inf")] + [0.0] * (dims - 1), 1, 0), (904, [], 1, 0), (905, [1.0], 1, 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, component int").repartition(3)
    got = whitening.whiten(df).collect()
    n, deviation, white, explained = exact(table)
    k = min(dims, 32)
    assert len(got) == n * k
    for c in range(k):
        mine = {r.vec_id: r for r in got if r.component == c + 1}
        sign = np.sign(mine[0].whitened * white[0, c])
        for i, r in mine.items():
            j = 7 if i is None else i
            assert (r.n, r.deviation) == (n, deviation[j])
            assert r.whitened == pytest.approx(sign * white[j, c], rel=1e-8, abs=1e-9)
            assert r.explained == pytest.approx(explained[c], rel=1e-9) and 0 <= r.identity_error < 1e-9


def test_whitening_of_extreme_tables(spark):
    schema = "vec_id long, embedding array<float>, label int"
    frame = lambda rows: spark.createDataFrame(rows, schema)
    assert whitening.whiten(frame([])).collect() == []
    assert whitening.whiten(frame([(1, [1.0, 2.0], 0)] * 3)).collect() == []  # no variance
    got = whitening.whiten(frame([(1, [1e30, 0.0], 0), (2, [-1e30, 0.0], 0), (3, [0.5, 0.0], 0)])).collect()
    assert len(got) == 3 and {r.component for r in got} == {1}  # the second dimension has no variance
    assert all(r.deviation is None for r in got if r.vec_id < 3)
    assert got[0].identity_error < 1e-9


def test_edge_rows(frame):
    for operator in (variants.variants, licences.licences):
        assert operator(frame([])).collect() == []
    assert variants.variants(frame([(1, "aa bb"), (2, None)])).collect() == []
