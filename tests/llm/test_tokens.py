"""Token counts, packing and the BPE transducer against the public libraries."""

import random
from collections import defaultdict
from zlib import crc32

import brute
import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

from loamline.llm import bpe, packing, token_counts, vocab

JSON, RANKS = P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken")
FILES = (JSON, RANKS, P.PATTERN)
PARTS = [" ", " ", "\n", "\t", "  ", "a", "the", "'s", "é", "漢", "🎉", "12", ".", "<|endoftext|>", "\x1c", " ", "x" * 40]


def odd_texts(n=300, seed=1):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 60))) for _ in range(n)]


@pytest.fixture(scope="module")
def tok():
    return vocab.tokenizer(JSON)


def ids_of(tok, text):
    return tok.encode(text, add_special_tokens=False).ids


def test_parts_encode_as_the_whole(tok):
    cache = vocab.part_cache(JSON, vocab.little_endian)
    for text in odd_texts():
        assert np.frombuffer(b"".join(cache.parts(text)), "<u4").tolist() == ids_of(tok, text)


def test_ranks_give_the_same_ids(tok):
    ids = vocab.fast_ids(*FILES)
    texts = odd_texts(seed=7) + [s.format(chr(i)) for i in range(0x250) for s in ("{0}", "a{0}b", " {0} 1", "{0}{0}{0}x", "\n{0} {0}")]
    for text in texts:
        assert ids(text).tolist() == ids_of(tok, text)


def test_chunks_are_spliced_exactly(tok):
    for text in odd_texts(seed=2):
        assert token_counts.spliced(tok, text * 4, 90, 40) == ids_of(tok, text * 4)
    for text in ("a" * 40_000, " " * 30_000 + "x" + " " * 20_000, "word " * 9_000):
        assert token_counts.spliced(tok, text) == ids_of(tok, text)


def test_token_counts(frame, tok):
    texts = odd_texts(60) + ["", None, "many words " * 900, "z" * 20_000]
    got = token_counts.token_counts(frame(list(enumerate(texts))), JSON).collect()
    for r in got:
        text = texts[r.doc_id] or ""
        n = len(ids_of(tok, text))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text.encode()), n, n > 1024)
    assert token_counts.token_counts(frame([]), JSON).collect() == []


def check_packing(rows, ids, window=1024):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
        whole = ids[r.doc_id]
        assert r.doc_tokens == len(whole)
        assert r.ids_crc32 == crc32(np.array(whole[r.start:r.start + r.length], "<u4").tobytes())
    assert set(by_doc) == set(ids)
    for doc, pieces in by_doc.items():
        at = 0
        for p in sorted(pieces, key=lambda p: p.start):
            assert p.start == at and p.length > 0
            at += p.length
        assert at == len(ids[doc])
    padding = 0
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= window
        padding += 0 if at & (at - 1) == 0 else window - at
    return padding


def test_packing_covers_every_id_once_without_padding(frame, tok):
    rnd = random.Random(4)
    texts = ["w " * rnd.randint(0, 1500) for _ in range(80)] + [None, "", "long " * 6000, "a<|endoftext|>b"]
    ids = {i: ids_of(tok, t or "") + [0] for i, t in enumerate(texts)}
    assert check_packing(packing.pack(frame(list(enumerate(texts))), *FILES).collect(), ids) == 0
    small = packing.pack(frame(list(enumerate(texts))), *FILES, max_open=3).collect()  # early drains
    assert check_packing(small, ids) == 0
    assert packing.pack(frame([]), *FILES).collect() == []


def test_packing_keeps_repeated_rows(frame):
    rows = packing.pack(frame([(7, "same text"), (7, "same text"), (None, "x")]), *FILES).collect()
    one = {r.doc_id: r.doc_tokens for r in rows}
    assert sum(r.length for r in rows if r.doc_id == 7) == 2 * one[7]
    assert sum(r.length for r in rows if r.doc_id is None) == one[None]


def test_level_choice_minimises_the_sum_of_squares():
    rnd = random.Random(6)
    packer = packing.Packer(0, window=32)
    for _ in range(300):
        size = rnd.randint(1, 31)
        n = packer.counts.copy()

        def total(h):
            m = n.copy()
            if h:
                m[h] -= 1
            if h + size < 32:
                m[h + size] += 1
            return int((m[1:32] ** 2).sum())

        levels = [0] + [h for h in range(1, 33 - size) if n[h]]
        assert total(packer.level(size)) == min(map(total, levels))
        packer.place(1, b"\0\0\0\0" * size)


def test_transducer_equals_the_library():
    ranks = bpe.load_ranks(RANKS)
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    coder = bpe.codec(RANKS, P.PATTERN)
    texts = odd_texts(300, 3) + [t or "" for _, t in brute.corpus(n=40)]
    texts += ["a" * 5000, "the" * 3000, " " * 3000 + "x", "é漢" * 1500, "qwzx" * 800]
    for text in texts:
        ids = coder.encode(text)
        assert ids == library.encode_ordinary(text)
        assert "".join(coder.decode(ids, 3)) == text
    small = bpe.Transducer(ranks, max_states=50)  # tables thrown away again and again
    for text in ("understanding" * 20, "naïveté", "x" * 300):
        assert small.encode(text.encode()) == library.encode_ordinary(text) or " " in text


def test_utf8_stream_splits_anywhere():
    data = "aé漢🎉z".encode() * 3
    for step in range(1, 7):
        stream = bpe.Utf8Stream()
        text = "".join(stream.feed(data[i:i + step]) for i in range(0, len(data), step)) + stream.close()
        assert text == data.decode()
    with pytest.raises(UnicodeDecodeError):
        stream = bpe.Utf8Stream()
        stream.feed(data[:2])
        stream.close()


def test_round_trip(frame):
    texts = odd_texts(40, 5) + ["", None]
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.load_ranks(RANKS), special_tokens={})
    docs = frame(list(enumerate(texts)))
    for r in bpe.round_trip(docs, RANKS, P.PATTERN).collect():
        text = texts[r.doc_id] or ""
        ids = library.encode_ordinary(text)
        assert r.n_tokens == len(ids) and r.decoded_sha256 == brute.sha(text)
        assert r.ids_sha256 == brute.sha(" ".join(map(str, ids)))
    back = bpe.decode(bpe.encode(docs, RANKS, P.PATTERN), RANKS, P.PATTERN)
    assert {r.doc_id: r.text for r in back.collect()} == {i: t or "" for i, t in enumerate(texts)}
    assert bpe.round_trip(frame([]), RANKS, P.PATTERN).collect() == []


def test_letters_after_a_blank_are_not_cut_and_nothing_is_collected_while_coding():
    import gc

    import public_tokenizers
    from loamline.llm import bpe

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    coder = bpe.Codec(bpe.load_ranks(path), public_tokenizers.PATTERN)
    plain, cut = bpe.Codec(bpe.load_ranks(path), public_tokenizers.PATTERN), []
    plain.words = False
    coder.find = lambda text, find=coder.find: (cut.append(text), find(text))[1]
    text = "One don't stop, x1 naïve wordswithoutanend" + "a" * 100 + " end 's sª. " + "b" * 70
    assert coder.encode(text) == plain.encode(text) == [i for p in plain.find(text) for i in plain.fst.encode(p.encode())]
    assert " stop," in cut and not {" end", " s"} & set(cut)
    on = gc.isenabled()
    with bpe.no_collections():
        assert not gc.isenabled()
    assert gc.isenabled() == on
