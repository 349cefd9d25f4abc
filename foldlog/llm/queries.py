"""One query per training-text operator over the whole provided tables, and the SQL of some."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldlog import configure
from foldlog.llm.bbit import near_duplicates
from foldlog.llm.bpe import round_trip_digests
from foldlog.llm.common import fold
from foldlog.llm.lattice import lattice_scores
from foldlog.llm.licenses import scan_licenses
from foldlog.llm.lzprint import neighbour_fingerprints
from foldlog.llm.packing import packed_documents
from foldlog.llm.perspectives import PERSPECTIVES_SQL, rotate_perspectives
from foldlog.llm.pii import fit_pii_model, pii_spans
from foldlog.llm.planes import CLUSTERS_SQL, cluster_vectors
from foldlog.llm.repetition import repetition_measures
from foldlog.llm.scanning import SEARCH_SQL, ranked_search
from foldlog.llm.signatures import jaccard_components
from foldlog.llm.toxicity import fit_toxicity, toxicity_scores


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_suffix_repetition(spark: SparkSession, folder: str) -> DataFrame:
    return repetition_measures(_table(spark, folder, "documents"))


def op2_subword_lattice(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return lattice_scores(docs, fold("doc_id", 7) == 2, public_tokenizers.path("piece_bpe_32k.model"), learn=True)


def op3_perspective_rotation(spark: SparkSession, folder: str) -> DataFrame:
    return rotate_perspectives(_table(spark, folder, "conversations"))


def op4_bpe_rank_array(spark: SparkSession, folder: str) -> DataFrame:
    return round_trip_digests(_table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op5_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return scan_licenses(_table(spark, folder, "documents"))


def op6_toxicity_string_kernel(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    model = fit_toxicity(docs, _table(spark, folder, "labels"))
    return toxicity_scores(docs, model).select(
        "doc_id",
        F.coalesce(fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )


def op7_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packed_documents(_table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op8_signature_tree_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_components(_table(spark, folder, "documents"))


def op9_lz_fingerprint(spark: SparkSession, folder: str) -> DataFrame:
    return neighbour_fingerprints(_table(spark, folder, "documents"))


def op10_pii_boosting(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return pii_spans(docs, fit_pii_model(docs))


def op11_b_bit_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(_table(spark, folder, "documents"))


def op12_bit_plane_clusters(spark: SparkSession, folder: str) -> DataFrame:
    return cluster_vectors(_table(spark, folder, "embeddings"))


def op13_automaton_search(spark: SparkSession, folder: str) -> DataFrame:
    return ranked_search(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


QUERIES = {
    query.__name__: query
    for query in (
        op1_suffix_repetition,
        op2_subword_lattice,
        op3_perspective_rotation,
        op4_bpe_rank_array,
        op5_license_scan,
        op6_toxicity_string_kernel,
        op7_packing,
        op8_signature_tree_join,
        op9_lz_fingerprint,
        op10_pii_boosting,
        op11_b_bit_minhash,
        op12_bit_plane_clusters,
        op13_automaton_search,
    )
}

#: For the others see the brute-force, round-trip and held-out tests in tests/llm.
ORACLE = {
    "op3_perspective_rotation": PERSPECTIVES_SQL,
    "op12_bit_plane_clusters": CLUSTERS_SQL,
    "op13_automaton_search": SEARCH_SQL,
}
