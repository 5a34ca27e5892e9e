"""From raw documents to token ids: five stages over all that the one before has kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return
the columns of ``docs``.  `run` writes each stage as Parquet below the shared folder and
gives the next stage what it reads back.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tallyward.llm import bpe_codec, decontaminate, pii_crf, quality_rules, simhash_dedup
from tallyward.llm.common import read, ship
from tallyward.session import scratch_path

WORD_BPE = "word_bpe_49k.json"


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    ship(spark)
    return quality_rules.keep_good(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that of the least doc_id."""
    ship(spark)
    return simhash_dedup.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    ship(spark)
    return decontaminate.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in texts is replaced by its kind; n_chars follows."""
    ship(spark)
    return pii_crf.mask_personal_data(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids and their decoding, as digests."""
    ship(spark)
    return bpe_codec.bpe_round_trip(docs, public_tokenizers.path(WORD_BPE))


STAGES = [
    ("quality rules", keep_good),
    ("SimHash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("PII", mask_personal_data),
    ("BPE encoding and decoding", encode),
]

#: SQL has neither zstandard ratios nor XXH64, so it cannot express the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over all `documents`."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        target = scratch_path(spark, "stage-" + name.lower().replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(target)
        docs = spark.read.parquet(target)
    return docs
