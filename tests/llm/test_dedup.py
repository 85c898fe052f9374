"""Substring, suffix-array and near-duplicate removal against brute force."""

import random

import brute
import numpy as np
import pytest

from loamline.llm import minhash, repeats, sequences, substring, suffix


def rows(df, key="doc_id"):
    return {r[key]: tuple(r)[1:] for r in df.collect()}


def test_substring_dedup_equals_brute_force(frame):
    docs = brute.corpus()
    assert rows(substring.dedup_digests(frame(docs))) == brute.substring_dedup(docs)


def test_suffix_dedup_equals_brute_force(frame):
    docs = brute.corpus(seed=4)
    assert rows(suffix.dedup_digests(frame(docs))) == brute.suffix_dedup(docs)


def test_common_anchor_is_split(frame, monkeypatch):
    """Anchors with many open runs are dealt as single windows, with the same result."""
    monkeypatch.setattr(repeats, "SPLIT", 3)
    docs = brute.corpus(seed=5, n=60)
    spec = substring.windows()
    texts = frame(docs).select("doc_id", "text").toArrow().to_batches()
    filled = [b.set_column(1, "text", b.column(1).fill_null("")) for b in texts]
    import pyarrow as pa
    sifted = repeats._sifted(pa.Table.from_batches(list(repeats._anchored(filled, spec, 1))), spec, 1)
    whole = pa.Table.from_batches(filled)
    dealt = repeats._gathered(whole, sifted, spec, 1)
    resolved = repeats._resolved(dealt, spec, 1, substring.resolve)
    spans = np.concatenate([repeats.unpacked(t, repeats.SPANS, repeats.SPAN) for t in (sifted, resolved)])
    got = substring._digests(whole, spans).to_pylist()
    want = brute.substring_dedup(docs)
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got} == want


def hot_phrase(n, words=12):
    """Documents with one phrase in n contexts, some of which repeat or agree on one side."""
    rnd = random.Random(8)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 7)))
    side = lambda: " ".join(word() for _ in range(14))
    phrase = " ".join("of the common licence text that all documents bring along with them".split()[:words])
    some = [side() for _ in range(4)]
    return [(i, f"{rnd.choice(some) if i % 7 == 0 else side()} {phrase} {rnd.choice(some) if i % 5 == 0 else side()}")
            for i in range(n)]


def sifted_pieces(whole, sifted, spec):
    import pyarrow as pa
    pieces = repeats._sifted(repeats._parted(whole, sifted, spec, 1), spec, 1)
    plain = [k != repeats.HOTS for k in sifted.column("kind").to_pylist()]
    return pa.concat_tables([sifted.filter(pa.array(plain)), pieces])


@pytest.mark.parametrize("operator, want_of", [(substring, brute.substring_dedup), (suffix, brute.suffix_dedup)])
@pytest.mark.parametrize("split", [1, 3, 40])
def test_pieces_of_hot_runs_change_nothing(monkeypatch, operator, want_of, split):
    """Pieces, too, are dealt as single windows where they are hot again (``split`` 1 and 3)."""
    import pyarrow as pa
    monkeypatch.setattr(repeats, "SPLIT", split)
    for docs in (brute.corpus(seed=5, n=60), hot_phrase(120, 8), hot_phrase(120, 5)):
        docs = [(i, t or "") for i, t in docs if i is not None]
        whole = pa.table({"doc_id": pa.array([i for i, _ in docs], pa.int64()), "text": [t for _, t in docs]})
        spec, batches = operator.windows(), whole.combine_chunks().to_batches()
        sifted = repeats._sifted(pa.Table.from_batches(list(repeats._anchored(batches, spec, 1))), spec, 1)
        dealt = repeats._gathered(whole, sifted_pieces(whole, sifted, spec), spec, 1)
        resolved = repeats._resolved(dealt, spec, 1, operator.resolve)
        spans = np.concatenate([repeats.unpacked(t, repeats.SPANS, repeats.SPAN) for t in (sifted, resolved)])
        got = {r["doc_id"]: tuple(r.values())[1:] for r in operator._digests(whole, spans).to_pylist()}
        assert got == want_of(docs)


def test_hot_runs_move_few_bytes():
    """Dealt as single windows, each context of a common phrase took some 4 KB."""
    import pyarrow as pa
    docs, spec = hot_phrase(3000), suffix.windows()
    whole = pa.table({"doc_id": [i for i, _ in docs], "text": [t for _, t in docs]})
    sifted = repeats._sifted(pa.Table.from_batches(list(repeats._anchored(whole.combine_chunks().to_batches(), spec, 1))), spec, 1)
    assert len(repeats.unpacked(sifted, repeats.HOTS, repeats.OPEN)) > 2048
    parted = repeats._parted(whole, sifted, spec, 1)
    pieces = sifted_pieces(whole, sifted, spec)
    gathered = repeats._gathered(whole, pieces, spec, 1)
    assert max(parted.nbytes, pieces.nbytes, gathered.nbytes) < 3 * sum(len(t) for _, t in docs)


def test_hot_phrase_equals_brute_force(frame):
    """More contexts than SPLIT of one phrase, through all steps."""
    docs = hot_phrase(3000)
    assert rows(suffix.dedup_digests(frame(docs))) == brute.suffix_dedup(docs)
    assert rows(substring.dedup_digests(frame(docs))) == brute.substring_dedup(docs)


def test_first_shuffle_is_removed_before_texts_are_dealt(spark, frame, monkeypatch):
    files = lambda: {str(b) for b in spark.sparkContext._jvm.scala.jdk.javaapi.CollectionConverters.asJava(
        spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles())
        if "shuffle_" in str(b)}
    kept, write = [], repeats.written

    def watched(df, name):
        before = files()
        out = write(df, name)
        kept.append(len(files() - before))
        return out

    monkeypatch.setattr(repeats, "written", watched)
    assert suffix.dedup_digests(frame(brute.corpus(seed=4))).count()
    assert kept == [0]


def test_runs_of_one_anchor_are_equal_by_content_only():
    """300,000 different contexts of one phrase: 32 bits of content join about ten pairs."""
    import pyarrow as pa
    phrase = " ".join(f"w{i}" for i in range(12))
    n = 300_000
    batch = pa.record_batch([pa.array(range(n)), pa.array([f"x{i} {phrase}" for i in range(n)])], ["doc_id", "text"])
    out = pa.Table.from_batches(list(repeats._anchored([batch], substring.windows(), 1)))
    runs = repeats.unpacked(out, repeats.RUNS, repeats.RUN)
    assert len(runs) == n and not len(repeats.unpacked(out, repeats.SPANS, repeats.SPAN))
    assert np.unique(runs["h"], return_counts=True)[1].max() > n // 2


@pytest.mark.parametrize("narrow", ["r", "s"])
def test_either_content_hash_tells_runs_apart(monkeypatch, narrow):
    import pyarrow as pa
    made = repeats.runs_of

    def narrowed(*args):
        rows = made(*args)
        rows[narrow] &= np.uint64(3)
        return rows

    monkeypatch.setattr(repeats, "runs_of", narrowed)
    docs = [(i, t or "") for i, t in brute.corpus(seed=6) if i is not None]
    for spec, operator, want in ((substring.windows(), substring, brute.substring_dedup(docs)),
                                 (suffix.windows(), suffix, brute.suffix_dedup(docs))):
        whole = pa.table({"doc_id": pa.array([i for i, _ in docs], pa.int64()), "text": [t for _, t in docs]})
        found = pa.Table.from_batches(list(repeats._anchored(whole.combine_chunks().to_batches(), spec, 1)))
        sifted = repeats._sifted(found, spec, 1)
        resolved = repeats._resolved(repeats._gathered(whole, sifted, spec, 1), spec, 1, operator.resolve)
        spans = np.concatenate([repeats.unpacked(t, repeats.SPANS, repeats.SPAN) for t in (sifted, resolved)])
        got = {r["doc_id"]: tuple(r.values())[1:] for r in operator._digests(whole, spans).to_pylist()}
        assert got == want


def test_pieces_of_a_long_text_change_nothing(frame, monkeypatch):
    docs = [(1, "".join(chr(97 + i * i % 23) for i in range(4000))), (2, "".join(chr(97 + i * i % 23) for i in range(1500, 2600)))]
    spec, want = suffix.windows(), brute.suffix_dedup(docs)
    assert rows(suffix.dedup_digests(frame(docs))) == want
    values = sequences.BYTE_VALUE[np.frombuffer(docs[0][1].encode(), np.uint8)]
    whole = repeats.runs_of(spec, values, np.array([0, 4000]), np.array([1]))
    assert int(whole["n"].astype(int).sum() + len(whole)) == 4000 - 99  # every window in one run


def test_deep_shallow_sort_orders_suffixes():
    rnd = random.Random(1)
    text = bytes(rnd.choice(b"ab") for _ in range(300)) * 2 + b"c" * 200
    start = np.arange(len(text) - 100)
    order, group = suffix.deep_shallow(text, start, 100, 16)
    strings = [text[p:p + 100] for p in order]
    assert strings == sorted(strings)
    assert all((a == b) == (x == y) for a, b, x, y in zip(strings, strings[1:], group, group[1:]))


def test_kept_texts_and_bytes(frame):
    shared = " ".join(f"w{i}" for i in range(20))
    docs = frame([(1, f"one {shared} end"), (2, f"two\n{shared}  tail x"), (3, None)])
    kept = {r.doc_id: (r.text, r.source) for r in substring.dedup_texts(docs, "source").collect()}
    assert kept == {1: (f"one {shared} end", "s"), 2: ("two\ntail x", "s"), 3: ("", "s")}
    assert {r.doc_id: len(r.kept) for r in suffix.dedup_bytes(docs).collect()}[3] == 0


def near_corpus():
    rnd = random.Random(5)
    vocabulary = ["".join(rnd.choice("abcdefg") for _ in range(4)) for _ in range(400)]
    docs = []
    for _ in range(8):
        base = [rnd.choice(vocabulary) for _ in range(rnd.choice([3, 5, 6, 40, 120, 300]))]
        for _ in range(rnd.choice([1, 2, 8, 30])):
            w = list(base)
            for _ in range(rnd.randint(0, max(1, len(w) // 60))):
                w[rnd.randrange(len(w))] = rnd.choice(vocabulary)
            base = w if rnd.random() < 0.3 else base
            docs.append((2 * len(docs) + 1, " ".join(x.upper() if rnd.random() < 0.1 else x for x in w)))
    return docs + [(0, None), (2, ""), (4, "  "), (6, "a b"), (8, "A  b")]


def test_near_duplicates_equal_brute_force(frame):
    docs = near_corpus()
    assert rows(minhash.near_duplicates(frame(docs))) == brute.near_duplicates(docs)


def same_rows(got, want):
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_null_and_repeated_ids_join_nothing(frame):
    rnd = random.Random(9)
    text = lambda: " ".join(rnd.choice("abcdefghijklmnop") + rnd.choice("xyz") for _ in range(40))
    a, b, c, d = text(), text(), text(), text()
    docs = [(5, a), (None, a + " extra"), (None, b), (None, c), (7, b + " z"), (9, c + " y"), (None, d), (None, d),
            (5, d + " x"), (11, a), (12, None), (12, ""), (None, ""), (13, b + " z"), (13, b + " z"), (14, d + " w")]
    same_rows(minhash.near_duplicates(frame(docs)).collect(), brute.near_rows(docs))
    left = [(r.doc_id, r.text) for r in minhash.one_of_each(frame(docs)).collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[1] or "")
    # of each component the smallest id's row; of rows without words each
    want = [(5, a), (5, d + " x"), (7, b + " z"), (9, c + " y"), (12, None), (12, ""), (None, "")]
    assert sorted(left, key=key) == sorted(want, key=key)
    copies = [(None, d), (None, d), (None, d + " x"), (3, a), (3, a), (3, a + " extra")]
    left = [(r.doc_id, r.text) for r in minhash.one_of_each(frame(copies)).collect()]
    assert len(left) == 2 and (3, left[0][1] if left[0][0] else left[1][1]) in left
    assert {t for i, t in left if i is None} <= {d, d + " x"}


def near_group(n=500, words=120, seed=2):
    """A group of near copies whose pairs lie around the threshold."""
    rnd = random.Random(seed)
    base = [f"w{rnd.randrange(5000)}" for _ in range(words)]
    docs = []
    for i in range(n):
        w = list(base)
        for _ in range(rnd.choice([1, 2, 2, 3, 4, 5])):
            w[rnd.randrange(words)] = f"x{rnd.randrange(40)}"
        docs.append((i, " ".join(w)))
    return docs


def test_a_group_around_the_threshold(frame, monkeypatch):
    """Cells smaller than the group; they emit no more links than labels."""
    monkeypatch.setattr(minhash, "CELL_ROWS", 64)
    monkeypatch.setattr(minhash, "PAIRS", 1000)
    docs = near_group()
    same_rows(minhash.near_duplicates(frame(docs)).collect(), brute.near_rows(docs))
    search = minhash.Search(frame(docs))
    apart = search.classes.selectExpr("id", "id as label")  # no class linked yet
    cells = search.cells(apart).select("cell").distinct().count()
    assert search.joining(apart).count() <= cells * 2 * 64
    linked = minhash.components(search.joining(apart)).groupBy("label").count().collect()
    parts = {}
    for _, _, c, _ in brute.near_rows(docs):
        parts[c] = parts.get(c, 0) + 1
    classes = {frozenset(brute.shingles(t)) for _, t in docs}
    assert sum(r["count"] for r in linked) <= len(classes) and len(linked) >= sum(k > 1 for k in parts.values()) - 1


def test_similar_by_products_equals_sets():
    rnd = np.random.default_rng(3)
    sets = [np.unique(rnd.integers(0, 60, rnd.integers(1, 60)).astype(np.uint64)) for _ in range(60)]
    want = [[100 * len(np.intersect1d(a, b)) >= 75 * len(np.union1d(a, b)) for b in sets[30:]] for a in sets[:30]]
    assert (minhash.similar(sets[:30], sets[30:]) == np.array(want)).all()


def test_sketches_and_bands_lose_no_pair_at_the_threshold():
    rnd = np.random.default_rng(4)
    for _ in range(400):
        k = int(rnd.integers(1, 40))  # 6 k shared and k of each side's own: 6 / 8 = 0.75
        both, a, b = np.split(rnd.integers(0, 1 << 63, 8 * k).astype(np.uint64), [6 * k, 7 * k])
        x, y = (minhash.signature(np.concatenate([both, z])) for z in (a, b))
        assert (x.astype(np.uint8) == y.astype(np.uint8)).mean() >= minhash.SKETCH
        assert np.stack([x[r::minhash.ROWS] == y[r::minhash.ROWS] for r in range(minhash.ROWS)]).all(axis=0).any()


def test_second_permutation_is_one():
    x = np.arange(1 << 16, dtype=np.uint32) * np.uint32(65521)
    assert len(np.unique(minhash.second_permutation(x.copy()))) == len(np.unique(x))


@pytest.mark.parametrize("operator", [substring.dedup_digests, suffix.dedup_digests, minhash.near_duplicates])
def test_edge_rows(frame, operator):
    assert operator(frame([])).collect() == []
    text = " ".join(f"w{i}" for i in range(60))
    out = operator(frame([(None, text), (5, text), (5, text), (9, None)])).collect()
    assert len(out) == 4
    same = [tuple(r) for r in out if r.doc_id == 5]
    assert same[0] == same[1]  # repeated rows are one document
    if operator is minhash.near_duplicates:
        assert {(r.doc_id, r.component_id, r.kept) for r in out} == {(None, 5, False), (5, 5, True), (9, 9, True)}
    else:
        assert {r.doc_id: r.n_removed > 0 for r in out} == {None: True, 5: False, 9: False}
