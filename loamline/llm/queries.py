"""The registered queries of this package: each applies one operator, with
its production parameters, to the whole table it is meant for."""

from __future__ import annotations

import public_tokenizers

from . import (ann, bpe, licences, minhash, outliers, packing, pii, substring, suffix, token_counts, toxicity, variants,
               whitening)
from .oracle import ORACLE  # noqa: F401
from .tables import documents, table


def packing_files():
    """Tokenizer file, the same vocabulary as ranks, and the ranks' pattern."""
    return (public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
            public_tokenizers.PATTERN)


def op1_substring_dedup(spark, sf_dir):
    return substring.dedup_digests(documents(spark, sf_dir))


def op2_personal_data(spark, sf_dir):
    return pii.personal_data(documents(spark, sf_dir))


def op3_minhash_near_dedup(spark, sf_dir):
    return minhash.near_duplicates(documents(spark, sf_dir))


def op4_nearest_neighbours(spark, sf_dir):
    return ann.search(table(spark, sf_dir, "embeddings"))


def op5_token_counts(spark, sf_dir):
    return token_counts.token_counts(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op6_packing(spark, sf_dir):
    return packing.pack(documents(spark, sf_dir), *packing_files())


def op7_bpe_round_trip(spark, sf_dir):
    return bpe.round_trip(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                          public_tokenizers.PATTERN)


def op8_toxicity(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op9_quality_outliers(spark, sf_dir):
    return outliers.quality(table(spark, sf_dir, "documents")).drop("distance")


def op10_suffix_dedup(spark, sf_dir):
    return suffix.dedup_digests(documents(spark, sf_dir))


def op11_spelling_variants(spark, sf_dir):
    return variants.variants(documents(spark, sf_dir))


def op12_licences(spark, sf_dir):
    return licences.licences(documents(spark, sf_dir))


def op13_whitening(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (
    op1_substring_dedup, op2_personal_data, op3_minhash_near_dedup, op4_nearest_neighbours, op5_token_counts, op6_packing, op7_bpe_round_trip,
    op8_toxicity, op9_quality_outliers, op10_suffix_dedup, op11_spelling_variants, op12_licences, op13_whitening)}
