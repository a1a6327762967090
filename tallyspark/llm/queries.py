"""The queries of this subpackage, by name, and their oracle SQL where SQL can express them."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from tallyspark.llm import (blob_ledger, bpe_index, conversation_repair, decision_list, mixing,
                            online_packing, order_minhash, periodic_runs, quality_em,
                            sentence_spans, simhash_vptree, toxicity_knn, url_cascade)
from tallyspark.llm.common import read_table, scratch_path


def tokenizer_path() -> str:
    """The vocabulary file of the byte-level tokenizer (``TALLYSPARK_TOKENIZER``, else the
    public tokenizers that are installed on every node)."""
    own = os.environ.get("TALLYSPARK_TOKENIZER")
    if own:
        return own
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def _documents(spark, sf_dir):
    return read_table(spark, sf_dir, "documents")


def _labels(spark, sf_dir):
    return read_table(spark, sf_dir, "labels")


def op1_weak_label_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_em.classify(_documents(spark, sf_dir))


def op2_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_documents(spark, sf_dir), _labels(spark, sf_dir))


def op3_url_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_cascade.judge_pages(read_table(spark, sf_dir, "pages"))


def op4_toxicity_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_knn.score_documents(_documents(spark, sf_dir), _labels(spark, sf_dir))


def op5_simhash_vptree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_vptree.simhash_components(_documents(spark, sf_dir))


def op6_bpe_pair_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_index.encode_digests(_documents(spark, sf_dir), tokenizer_path())


def op7_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_spans.dedup_documents(_documents(spark, sf_dir))


def op8_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.edit_neighbours(_documents(spark, sf_dir))


def op9_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decision_list.judge(_documents(spark, sf_dir), _labels(spark, sf_dir))


def op10_blob_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over a new ledger in the shared folder: the first scans every blob, the second
    none, and joins the findings to all documents."""
    docs = _documents(spark, sf_dir)
    path = scratch_path(spark, "ledger")
    blob_ledger.Ledger(spark, path).scan(docs.withColumnRenamed("doc_id", "path"))
    return blob_ledger.scan_documents(docs, blob_ledger.Ledger(spark, path))


def op11_bounded_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return online_packing.packed_pieces(_documents(spark, sf_dir), tokenizer_path())


def op12_target_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair_damaged(read_table(spark, sf_dir, "conversations"))


def op13_frequency_splitting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.run_digests(_documents(spark, sf_dir))


QUERIES = (op1_weak_label_quality, op2_soft_mixing, op3_url_cascade, op4_toxicity_knn,
           op5_simhash_vptree, op6_bpe_pair_index, op7_sentence_spans, op8_order_minhash,
           op9_decision_list, op10_blob_ledger, op11_bounded_packing,
           op12_target_alignment, op13_frequency_splitting)


def queries() -> dict:
    return {f.__name__: f for f in QUERIES}


def oracle_sql() -> dict[str, str]:
    """Only the URL filter can be said in SQL; the others are tested against brute force."""
    return {"op3_url_cascade": url_cascade.ORACLE_SQL}
