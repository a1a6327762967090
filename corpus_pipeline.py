"""A training-corpus pipeline over ``documents``: five stages, each one operator.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that its predecessor kept; its
result is written as Parquet to the shared folder and read again as the next one's input.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession

from tallyspark.llm import blob_ledger, bpe_index, decision_list, mixing, simhash_vptree
from tallyspark.llm.common import discard, kept_step, read_table
from tallyspark.llm.queries import tokenizer_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the learned decision list reject go."""
    return decision_list.keep_good(docs, read_table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays: the one with the least doc_id."""
    return simhash_vptree.keep_one_per_component(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret is masked in its text; all documents stay."""
    return blob_ledger.redact_documents(docs)


#: Junk is gone after the quality rules, so two domains are left to weigh.
TARGETS = {"clean": 0.94, "toxic": 0.06}


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its domains' targets ask: not at all, once or more."""
    return mixing.mixed_documents(docs, read_table(spark, sf_dir, "labels"), TARGETS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the token ids of their whole texts; all ids are decoded again, and must
    give the text."""
    return bpe_index.encode_documents(docs, tokenizer_path())


STAGES = [("quality_rules", quality_rules), ("simhash_near_dedup", near_dedup),
          ("secret_scans", mask_secrets), ("mixing_sources", mix_sources), ("bpe_encoding", encode)]

#: Learned rules, graph components and tokens cannot be written as SQL; the stages are
#: tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``: the columns of that table and ``token_ids``.

    After each stage its result is stored, and what it and its predecessor have written beside
    is deleted, so the shared folder holds two stages' tables at most. The last stage is lazy.
    Null, empty and very long texts, repeated rows and ids, and an empty table pass through each
    stage as its operator says; extra columns stay.
    """
    docs, held = read_table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        docs, made = kept_step(spark, functools.partial(stage, spark, docs, sf_dir), name)
        discard(spark, held)
        held = made
    return STAGES[-1][1](spark, docs, sf_dir)
