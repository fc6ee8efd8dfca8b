"""From raw documents to token ids: quality rules, SimHash near-duplicates, suffix-array dedup, mixing, SentencePiece.

Every stage takes (spark, docs, sf_dir); its result is written as Parquet to
the shared folder and read back as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from offerlens.llm.mixing import stage_mix
from offerlens.llm.quality import stage_quality
from offerlens.llm.sentencepiece_codec import stage_encode
from offerlens.llm.simhash import stage_near_duplicates
from offerlens.llm.suffix_dedup import stage_suffix_dedup
from offerlens.session import materialize

STAGES = [
    ("quality rules", stage_quality),
    ("SimHash near-dedup", stage_near_duplicates),
    ("suffix-array dedup", stage_suffix_dedup),
    ("mixing sources to target weights", stage_mix),
    ("SentencePiece encoding and decoding", stage_encode),
]

#: SQL cannot express the suffix, fingerprint and token stages; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), "pipeline-stage")
    return docs
