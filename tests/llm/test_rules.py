"""Personal data, quality rules, toxicity and nearest neighbours."""

import random

import brute
import numpy as np
import pytest

from loamline.llm import ann, outliers, pii, toxicity
from loamline.llm.tables import texts, written

BITS = ["a", "é", "🎉", "@", ".", "-", "_", "%", "+", "1", "2", "37", "255", "256", "00", "4111111111111111", " ", "(", ")",
        "5", "\n", "4111-1111-1111-1111", "a@b.c", "+1 (555) 123-4567", "=", '"', "token", "deadbeef0123456789abcdef01234567"]


def test_personal_data_equals_brute_force(frame):
    rnd = random.Random(2)
    docs = [(i, "".join(rnd.choice(BITS) for _ in range(rnd.randint(0, 60)))) for i in range(600)]
    docs += [(1000, None), (1001, ""), (1002, "1 " * 20_000), (1003, "a" * 100_000), (1004, "a@b.cc " * 2000),
             (1005, "1" * 50_000 + "." + "+1" * 500), (1006, "1.2.3.4." * 1000)]
    got = {r.doc_id: r for r in pii.personal_data(frame(docs)).collect()}
    for i, text in docs:
        spans = brute.personal_data(text)
        spelled = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        r = got[i]
        assert tuple(r)[1:5] == tuple(sum(k == kind for k, _, _ in spans) for kind in pii.BASE)
        assert r.base_sha256 == brute.sha(spelled) and r.spans.startswith(spelled)
    assert pii.personal_data(frame([])).collect() == []


def test_extra_spans_and_redaction(frame):
    rnd = random.Random(3)
    secret = lambda: "".join(rnd.choice("0123456789abcdef") for _ in range(40))
    docs = [(i, f'Some words. token = "{secret()}" and more, mail me@site.org or 10.0.0.1.') for i in range(60)]
    docs += [(100 + i, f"see /path/{secret()[:21]}/x and nothing else") for i in range(60)]
    got = {r.doc_id: r.spans for r in pii.personal_data(frame(docs)).collect()}
    assert all("secret:" in got[i] for i in range(60))
    assert not any("secret:" in got[100 + i] for i in range(60))
    out = {r.doc_id: r.text for r in pii.redacted(frame(docs), "doc_id").collect()}
    assert out[0] == 'Some words. token = "[SECRET]" and more, mail [EMAIL] or [IP].'
    assert out[100] == docs[60][1]


def test_running_sums_by_blocks(spark, monkeypatch):
    from pyspark.sql import functions as F
    monkeypatch.setattr(pii, "BLOCK", 4)
    for n in (1, 3, 4, 5, 8, 9, 30):
        row = spark.range(1).select(F.sequence(F.lit(1), F.lit(n)).alias("v")).select(pii.cumulated(F.col("v")).alias("c")).first()
        assert row.c == np.cumsum(np.arange(1, n + 1)).tolist()


def test_em_learns_who_lies():
    honest, lying = ["++++++", "000000"], ["0-0000", "------"]
    counts = [("secret", v, 1, 50) for v in (*honest, *lying)] + [("email", "++++++", 1, 500)]
    p = dict(zip((c[1] for c in counts), pii.expectation_maximisation(counts)))
    assert p["++++++"] > 0.9 > 0.1 > p["------"]


def test_quality_counts_equal_brute_force(frame):
    docs = brute.corpus(seed=9) + [
        (2000, ("a " * 7).strip()), (2001, "a b c d e f g h a b c d e f g h"), (2002, "x\n\nx\n x\nx"),
        (2003, "a b c d e f g h i " * 3), (2004, "z " * 3000), (2005, "#a *b $c %d &e |f <g> " * 4)]
    got = {r.doc_id: r for r in outliers.quality(frame(docs)).collect()}
    for i, text in docs:
        assert tuple(got[i])[1:7] == brute.quality(text), i
        assert not (got[i].base_failed and got[i].kept)
    assert outliers.quality(frame([])).collect() == []


def test_outliers_go_and_ordinary_texts_stay(frame):
    rnd = random.Random(8)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 8)))
    docs = [(2 * i + 1, " ".join(word() for _ in range(rnd.randint(40, 200)))) for i in range(300)]
    junk = [(10_001 + 2 * i, " ".join(word() + "###&&&" for _ in range(60))) for i in range(40)]
    got = {r.doc_id: r.kept for r in outliers.quality(frame(docs + junk)).collect()}
    assert all(got[i] for i, _ in docs) and not any(got[i] for i, _ in junk)


@pytest.mark.parametrize("statistic", ["word_length", "symbols", "dup_lines", "repeats"])
def test_each_statistic_alone_rejects(frame, statistic):
    rnd = random.Random(9)
    word = lambda n=0: "".join(rnd.choice("abcdefghij") for _ in range(n or rnd.randint(2, 8)))
    text = lambda n: " ".join(word() for _ in range(n))
    lines = lambda n: "\n".join(text(10) for _ in range(n))
    once = text(30)
    planted = {
        "word_length": lambda: " ".join(word(40) for _ in range(60)),
        "symbols": lambda: " ".join(word(3) + "##" for _ in range(60)),
        "dup_lines": lambda: "\n".join(f"{text(12)}\nread more" for _ in range(12)),  # 11 of 24 lines
        "repeats": lambda: f"{text(75)} {once} {text(75)} {once}"}[statistic]  # 60 of 210 words
    docs = [(2 * i + 1, lines(rnd.randint(4, 20))) for i in range(300)]
    docs += [(2001 + 2 * i, (t := text(10)) + "\n" + lines(12) + "\n" + t) for i in range(10)]  # one line twice
    bad = [(10_001 + 2 * i, planted()) for i in range(10)]
    got = {r.doc_id: r for r in outliers.quality(frame(docs + bad)).collect()}
    assert all(got[i].kept for i, _ in docs)
    assert not any(got[i].base_failed or got[i].kept for i, _ in bad)


def test_small_groups_are_judged(spark):
    """Left-over rows of rare languages and sources, with null and repeated ids."""
    rnd = random.Random(8)
    text = lambda: " ".join("".join(rnd.choice("abcdefg") for _ in range(rnd.randint(3, 7))) for _ in range(60))
    rows = [(i if i % 9 else None, text(), f"l{i % 5}", f"s{i % 7}") for i in range(60)]
    rows += [(7, text(), "l1", "s1"), (100, " ".join("#$%&" * 6 + str(i) for i in range(60)), "rare", "once")]
    got = outliers.quality(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()
    assert len(got) == len(rows) and all(r.distance is not None for r in got)
    assert [r.doc_id for r in got if not r.kept] == [100]


def test_distance_is_mahalanobis(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 4)) @ rng.normal(size=(4, 4))
    rows = spark.createDataFrame([(1, *map(float, r)) for r in x], ["key", *outliers.STATS])
    from pyspark.sql import functions as F
    p = range(4)
    est = rows.groupBy("key").agg(
        *(F.avg(s).alias(f"m{i}") for i, s in enumerate(outliers.STATS)),
        *(F.avg(F.col(outliers.STATS[i]) * F.col(outliers.STATS[j])).alias(f"q{i}{j}") for i in p for j in range(i + 1)))
    got = [r.d2 for r in outliers.distance(rows.join(outliers.factored(est, 1.0), "key")).orderBy("word_length").collect()]
    d = x - x.mean(axis=0)
    cov = d.T @ d / len(x) + outliers.FLOOR ** 2 * np.eye(4)
    want = np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d)[np.argsort(x[:, 0])]
    assert np.allclose(got, want)
    assert abs(outliers.consistency(0.75) - 1.486) < 0.01


def toxic_corpus(n=500, seed=1):
    rnd = random.Random(seed)
    vocabulary = ["".join(rnd.choice("bcdfghlmnrst") + rnd.choice("aeiou") for _ in range(rnd.randint(1, 4))) for _ in range(500)]
    docs, labels = [], []
    for i in range(n):
        w = [rnd.choice(vocabulary) for _ in range(rnd.randint(30, 120))]
        toxic = i % 4 == 0
        if toxic:
            for k in rnd.sample(range(len(w)), 4):
                w[k] = rnd.choice(["idiot", "Worthless", "zugg" + w[k], "zugg" + w[k][::-1]] if i % 8 else ["zugg" + w[k]])
        docs.append((i, " ".join(w)))
        labels.append((i, None, int(toxic)))
    return docs, labels


def test_toxicity_on_held_out_texts(spark, frame):
    docs, labels = toxic_corpus()
    labels = spark.createDataFrame(labels + [(None, None, 1), (3, 1, None)], "doc_id long, quality int, toxic int")
    chain = toxicity.train(frame(docs), labels)
    fresh, truth = toxic_corpus(seed=2)
    fresh = frame(fresh + [(900, None), (901, "")])
    got = {r.doc_id: r.toxic for r in toxicity.score(fresh, chain).collect()}
    right = np.mean([got[i] == bool(t) for i, _, t in truth])
    assert right > 0.97 and not got[900] and not got[901]
    kept = {r.doc_id for r in toxicity.accepted(fresh, chain).collect()}
    assert kept == {i for i, t in got.items() if not t}


def test_toxicity_without_labels(spark, frame):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    chain = toxicity.train(frame([(1, "idiot")]), none)
    assert [r.toxic for r in toxicity.score(frame([(1, "idiot"), (1, "idiot")]), chain).collect()] == [False, False]
    assert toxicity.score(frame([]), chain).collect() == []


def vectors(spark, x, ids=None):
    rows = [(int(i), None if v is None else [None if a is None else float(a) for a in v], 1) for i, v in zip(ids or range(len(x)), x)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, list int")


def exact(x, q, k=10):
    d = np.sqrt(((x.astype(float) - x[q].astype(float)) ** 2).sum(axis=1))
    d[q] = np.inf
    order = np.lexsort((np.arange(len(x)), d))[:k]
    return order.tolist(), d[order]


def test_neighbours_recall_and_scores(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 16)).astype(np.float32)
    x[::3] = x[5]  # a third of all vectors are equal
    out = ann.search(vectors(spark, x)).toPandas()
    hits = 0
    for q, rows in out.groupby("query_id"):
        rows = rows.sort_values("rank")
        want, d = exact(x, q)
        assert rows["rank"].tolist() == list(range(1, 11))
        assert np.allclose(rows["score"], np.sqrt(((x[rows.vec_id].astype(float) - x[q].astype(float)) ** 2).sum(axis=1)))
        hits += len(set(want) & set(rows.vec_id))
    assert out.query_id.nunique() == 30 and hits / 300 >= 0.9


def test_neighbours_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    x = [[1, 0], None, [0, 0], [1, nan], [inf, 1], [1, None], [], [1, 2, 3], [2, 0], [2, 0], [3, 0]]
    out = ann.search(vectors(spark, x)).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in out] == [(0, 1, 8, 1.0), (0, 2, 9, 1.0), (0, 3, 10, 2.0)]
    assert ann.search(vectors(spark, [])).collect() == []
    twice = vectors(spark, [[1, 0], [1, 0], [5, 0], [5, 0]], [0, 0, 7, 7])
    assert [(r.query_id, r.vec_id) for r in ann.search(twice).collect()] == [(0, 7)]


@pytest.mark.parametrize("n, beam", [(50, 8), (400, 24)])
def test_graph_search_finds_near_centroids(n, beam):
    rng = np.random.default_rng(n)
    c = rng.normal(size=(n, 8))
    graph = ann.Graph.of(c, rng)
    found = 0
    for v in rng.normal(size=(40, 8)):
        ids, d = graph.nearest(v, beam)
        assert np.all(np.diff(d) >= 0)
        found += len(set(ids[:8].tolist()) & set(np.argsort(((c - v) ** 2).sum(axis=1))[:8].tolist()))
    assert found / 320 > 0.95


def test_balanced_centroids_split_evenly():
    x = np.random.default_rng(2).normal(size=(1000, 4))
    c = ann.balanced_centroids(x, 10, np.random.default_rng(3))
    assert len(c) == 10 and np.allclose(c.mean(axis=0), x.mean(axis=0), atol=0.05)


def test_written_tables_keep_rows(spark, frame):
    df = texts(frame([(1, "a"), (2, None)]))
    assert sorted(map(tuple, written(df, "t").collect())) == [(1, "a"), (2, "")]
