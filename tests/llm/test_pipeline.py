"""The pipeline's stages against brute force, and the registered queries."""

import random

import brute
import corpus_pipeline
import pytest

import __spark_entry__ as entry
from loamline.llm import substring, suffix
from loamline.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"


def test_queries_are_registered():
    names = entry.queries()
    assert "pipeline" in names and all(any(q.startswith(f"op{n}_") for q in names) for n in range(1, 11))
    assert set(QUERIES) <= set(names)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet' WHERE doc_id < 80")
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 80")
    operator = {"op1_substring_dedup": substring, "op10_suffix_dedup": suffix}[name]
    got = operator.dedup_digests(docs)
    want = con.sql(ORACLE[name])
    assert sorted(map(tuple, got.select(want.columns).collect())) == sorted(want.fetchall())
    assert [t == "BIGINT" for t in map(str, want.types)] == [t == "bigint" for _, t in got.select(want.columns).dtypes]


@pytest.fixture(scope="module")
def corpus(spark):
    rnd = random.Random(12)
    words = ["".join(rnd.choice("bcdfgl") + rnd.choice("aeiou") for _ in range(2)) for _ in range(300)]
    text = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    shared = text(40)
    docs = [(i, text(60)) for i in range(40)]
    docs += [(40 + i, docs[i][1] + " extra") for i in range(5)]  # near copies
    docs += [(50 + i, f"{text(30)} {shared} {text(30)}") for i in range(5)]
    docs += [(60, "mail me@site.org now " + text(30)), (61, None), (62, "")]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in docs]
    return docs, spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def test_stages(spark, corpus, tmp_path):
    docs, table = corpus
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    names, stages = zip(*corpus_pipeline.STAGES)
    assert names == ("toxicity", "near_dedup", "substring_dedup", "pii", "packing")
    now = stages[0](spark, table, str(tmp_path))
    assert now.count() == len(docs) and tuple(now.columns) == corpus_pipeline.COLUMNS  # no labels: all stay
    now = stages[1](spark, now, str(tmp_path))
    want = {i: t for i, t in docs if brute.near_duplicates(docs)[i][2]}
    assert {r.doc_id for r in now.collect()} == set(want)
    now = stages[2](spark, now, str(tmp_path))
    cut = brute.substring_dedup(list(want.items()))
    got = {r.doc_id: r for r in now.collect()}
    assert {i: brute.sha(" ".join((r.text or "").split())) for i, r in got.items()} == {i: c[2] for i, c in cut.items()}
    assert all(r.n_chars == len(r.text) for r in got.values()) and any(c[1] for c in cut.values())
    now = stages[3](spark, now, str(tmp_path))
    last = {r.doc_id: r.text for r in now.collect()}
    assert last[60].startswith("mail [EMAIL] now ") and all(last[i] == got[i].text for i in last if i != 60)
    packed = stages[4](spark, now, str(tmp_path)).collect()
    assert {r.doc_id for r in packed} == set(want)


def test_toxic_documents_go_and_odd_ids_stay_whole(spark, tmp_path):
    """Labelled toxic rows teach the first stage; null and repeated ids pass all stages."""
    rnd = random.Random(4)
    words = ["".join(rnd.choice("bcdfgl") + rnd.choice("aeiou") for _ in range(2)) for _ in range(300)]
    text = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    toxic = [(i, f"{text(20)} you stupid idiot {text(10)} worthless moron {text(10)}") for i in range(60)]
    clean = [(100 + i, text(40)) for i in range(120)]
    a, b = text(40), text(40)
    odd = [(None, a), (None, a), (None, b), (300, b + " extra"), (301, text(40)), (301, text(40)), (302, None)]
    rows = [(i, t, "en", "s", len(t or ""), 0) for i, t in toxic + clean + odd]
    columns = "doc_id long, text string, lang string, source string, n_chars long, bucket int"
    spark.createDataFrame(rows, columns).write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, 1, 1) for i, _ in toxic[:45]] + [(i, 1, 0) for i, _ in clean[:90]]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = corpus_pipeline.STAGES[0][1](spark, docs, str(tmp_path))
    ids = [r.doc_id for r in kept.collect()]
    assert not set(ids) & {i for i, _ in toxic} and {i for i, _ in clean} <= set(ids) and tuple(kept.columns) == corpus_pipeline.COLUMNS
    kept = corpus_pipeline.STAGES[1][1](spark, kept, str(tmp_path))
    left = sorted((r.doc_id or 0, r.text or "") for r in kept.where("doc_id is null or doc_id >= 300").collect())
    assert left == sorted([(0, a), (300, b + " extra"), *((i or 0, t or "") for i, t in odd[4:])])
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in packed} == {i for i, _ in clean} | {None, 300, 301, 302}


def test_run_on_the_small_tables(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert rows and all(0 < r.length <= 1024 for r in rows)


def test_empty_documents(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    empty = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([], empty).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
