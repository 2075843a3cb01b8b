"""From raw documents to packed training sequences, stage by stage.

Every stage gets what its predecessor kept, as written Parquet, and all but the last
return the columns of documents.  Without SQL: no SQL engine has the network, the
fingerprints or the tokenizer, so the stages are tested against brute-force versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rillhouse.llm import exact_dedup, language_id, near_dedup, packing, suffix_dedup
from rillhouse.llm.common import dropped, prepare, stored_result, table

ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognisable language go: no text, or no letter in it."""
    prepare(spark)
    return language_id.recognised(docs, language_id.fit(docs))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts stays."""
    prepare(spark)
    return exact_dedup.deduplicated(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays that five-word similarities of 0.8 or more link."""
    prepare(spark)
    return near_dedup.one_of_each(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of more than 50 words that stand in several places are cut out of the texts."""
    prepare(spark)
    return suffix_dedup.cut_passages(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in sequences."""
    prepare(spark)
    return packing.pack(docs)


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("suffix_array_dedup", cut_repeats),
    ("best_fit_packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written and read again, and what a stage
    stored on its way, its input too, is deleted once the result is there."""
    rows, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        rows = stored_result(lambda: stage(spark, rows, sf_dir), f"pipeline-{name}")
        if before is not None:
            dropped(before)
        before = rows
    return rows
