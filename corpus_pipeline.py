"""Corpus pipeline: from raw documents to packed training sequences.

Every stage takes what its predecessor kept and returns the columns of
``documents`` again, the last one the pieces of packed sequences. Stages read
nothing but their input and, for toxicity, the ``labels`` table. Null or empty
texts pass through the filters and are packed as their end id alone; extra
columns end with the third stage at the latest.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from loamline.llm import minhash, packing, pii, substring, toxicity
from loamline.llm.queries import packing_files
from loamline.llm.tables import table, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _columns(docs):
    """The columns of ``documents``, with the length of the text as it is now."""
    return docs.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def toxicity_stage(spark, docs, sf_dir):
    """Documents that the classifier chain rejects go."""
    return toxicity.accepted(docs.select(*COLUMNS), toxicity.train(docs, table(spark, sf_dir, "labels")))


def near_dedup_stage(spark, docs, sf_dir):
    """One row of each group of near-duplicates stays, that of the smallest doc_id."""
    return minhash.one_of_each(docs.select(*COLUMNS))


def substring_stage(spark, docs, sf_dir):
    """Words in 13-word windows that an earlier document has are cut out."""
    return _columns(substring.dedup_texts(docs, "lang", "source"))


def pii_stage(spark, docs, sf_dir):
    """Personal data is replaced by its kind."""
    return _columns(pii.redacted(docs, "doc_id", "lang", "source"))


def packing_stage(spark, docs, sf_dir):
    """All documents are packed into sequences."""
    return packing.pack(docs, *packing_files())


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_dedup", near_dedup_stage),
    ("substring_dedup", substring_stage),
    ("pii", pii_stage),
    ("packing", packing_stage),
]
# no stage can be expressed in SQL as a whole; tests/llm checks each against brute force
ORACLE_SQL = None


def run(spark, sf_dir):
    """Apply all stages to the documents table; each result is a table in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
