"""The training-corpus pipeline: a list of stages over the documents table, each one operator.

Stages take (spark, docs, sf_dir) and return a DataFrame. All but the last return the columns of ``documents``:

1. language ID: documents without a determined language, or with a posterior under 0.5, go;
2. SimHash near-duplicates: the document with the smallest id of each group stays;
3. PII: personal data in the text becomes format-preserving pseudonyms; no document goes;
4. mixing: every document is taken once, those of small sources twice at most, as temperature weights ask for;
5. BPE: token ids and decoded text of every row, as digests.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wikiloom.llm import bpe, feistel, langid, mixing, simhash
from wikiloom.llm.common import documents, written


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.reject(docs, langid.fit(docs.filter(~langid.held_out())))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_first(docs)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return feistel.pseudonymise(docs, key=feistel.configured_key(spark))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs).select(*docs.columns)


def bpe_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(docs, bpe.tokenizer_path(), digest=True).withColumnsRenamed({"ids": "ids_sha256", "decoded": "decoded_sha256"})


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("simhash_near_dedup", near_dedup),
    ("pii", pii),
    ("mix_sources", mix_sources),
    ("bpe_tokens", bpe_tokens),
]

#: No SQL: fingerprints, classifier and tokenizer are beyond it; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written to the shared folder and read again."""
    docs = documents(spark, sf_dir)
    for at, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            docs = written(docs, name)
    return docs
