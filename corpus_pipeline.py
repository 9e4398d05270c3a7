"""From raw documents to token ids: five stages, each written and read again by the next.

Every stage works on all rows its predecessor kept. The first four return the columns of
`documents`; `n_chars`, where there is one, follows the text.

1. language: documents without a language (no letters, or no language likelier than not) go.
2. near_copies: of documents that share 80 of 100 five-word shingles one stays, also along chains.
3. personal_data: spans of personal data are replaced by their kind.
4. mix: sources in their target shares; a document taken twice comes twice, and the one in
   which a source's budget ends comes with its first words only.
5. tokens: ids of the whole text, and the digests that prove the way there and back.

Null texts and texts without letters end at the first stage. Rows with a null id take
part like any other. Columns beyond those of `documents` are carried along until the last stage.
Each stage bounds the Arrow batches of the session by bytes, as whole texts go through Python.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartloom.llm import bpe, jaccard, language, mixture, pii
from chartloom.llm.common import bound_batches, documents
from chartloom.sinks.staging import stage

MIN_LANGUAGE_SCORE = 0.5
TOKENIZER = "byte_bpe_50k.tiktoken"
TOKENIZER_ROOM = 100_000  # half of the default: the workers stand beside heaps that the stages before have filled


def _measured(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.keep_sure(docs, language.fit(docs), MIN_LANGUAGE_SCORE)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.keep_one(docs, 5, 80)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _measured(pii.mask(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _measured(mixture.apply(docs))


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode(docs, public_tokenizers.path(TOKENIZER), public_tokenizers.PATTERN, ("doc_id", "lang", "source"), room=TOKENIZER_ROOM)


def _bounded(step: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    def bounded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        bound_batches(spark)
        return step(spark, docs, sf_dir)

    return bounded


STAGES = [
    ("language", _bounded(identify_language)),
    ("near_copies", _bounded(drop_near_copies)),
    ("personal_data", _bounded(mask_personal_data)),
    ("mix", _bounded(mix_sources)),
    ("tokens", _bounded(encode_tokens)),
]
ORACLE_SQL = None  # models, components and token ids are beyond SQL; tests/llm/test_pipeline.py compares with plain code


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
