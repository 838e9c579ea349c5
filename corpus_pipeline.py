"""A corpus pipeline: clean, de-duplicate, mix and tokenise ``documents``.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. All but the last return the columns of
documents. run() writes each stage's rows to the shared folder and reads them for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from unitflow.llm import bpe_chunks, curriculum, simhash_groups, suffix_dedup, toxicity
from unitflow.llm.common import table, written
from unitflow.llm.queries import tokenizer_file


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the fitted grammar predicts to be toxic go."""
    return toxicity.keep_clean(docs, toxicity.fit_grammar(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near-duplicates (5-word shingles, a Jaccard similarity of 0.8 or more) one document stays."""
    return simhash_groups.keep_one(docs)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes of 100-byte strings that also start earlier go; a document that has nothing left keeps an empty text."""
    return suffix_dedup.without_repeats(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in training order, each as often as the mix takes it; a document taken in part counts as a whole one."""
    return curriculum.mixed_rows(docs)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids and decoded text of every row."""
    return bpe_chunks.encode_texts(docs, tokenizer_file("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_dedup", drop_near_duplicates),
    ("suffix_dedup", drop_repeats),
    ("mix", mix_sources),
    ("bpe", tokenise),
]

#: No SQL says these stages; tests hold them against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs)
    return docs
