"""From raw documents to packed training sequences, in five stages on the table ``documents``."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from foldlog import configure
from foldlog.llm.packing import packed_documents
from foldlog.llm.pii import fit_pii_model, redacted
from foldlog.llm.repetition import keep_unrepetitive
from foldlog.llm.signatures import keep_one_of_each
from foldlog.llm.toxicity import drop_toxic, fit_toxicity
from foldlog.staging import new_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _configured(stage: Stage) -> Stage:
    """A stage may be run by itself. In a session without the settings, batches for Python hold
    10 000 documents, and each worker takes several times the memory."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        return stage(configure(spark), docs, sf_dir)

    return run


@_configured
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that repeat themselves or have too few words go; a null text goes."""
    return keep_unrepetitive(docs)


@_configured
def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the machine takes for toxic go. It is fitted on labelled documents that are
    still there, outside fold 0 of five."""
    return drop_toxic(docs, fit_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


@_configured
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by five-word shingles (similarity 0.8 or more) the smallest id stays."""
    return keep_one_of_each(docs)


@_configured
def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind in the texts; every document stays. ``n_chars``
    stays what it was in the source."""
    return redacted(docs, fit_pii_model(docs))


@_configured
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in sequences of 1024 ids."""
    return packed_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("toxicity", toxicity),
    ("n-gram Jaccard join", near_duplicates),
    ("PII", personal_data),
    ("packing", packing),
]

#: SQL can express neither the suffix array's verdict, the trained machines nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each written to the shared folder and read again."""
    configure(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage_of in STAGES:
        path = new_path(spark, "stage")
        stage_of(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
