"""From documents to packed training sequences: five stages, each written as Parquet and read again by the next.

Quality rules drop documents; line dedup removes lines that occurred before, and documents that
consist of such lines by four fifths or more; near dedup keeps one document of each group whose
SimHash fingerprints of three-word shingles link at up to two differing bits; suffix dedup removes repeated passages of about fifty words (250 bytes) but for their first
occurrence; packing cuts what is left into windows of token ids.

All stages but the last return the columns of documents. Null texts have no words and go in the first stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from hearth.llm import lines, packing, quality, simhash, suffixes
from hearth.llm.common import discard, materialize, table

#: Bytes of a repeated passage. Fifty words of these languages take 260 bytes or more.
PASSAGE = 250


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return lines.clean(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_first(docs, shingle=3, distance=2)


def passage_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffixes.clean(docs, length=PASSAGE)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, packing.tokens(public_tokenizers.path("word_bpe_49k.json"), end=2))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("suffix_array_dedup", passage_dedup),
    ("packing", pack),
]

#: SQL cannot express the tokenizer, so the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        before, docs = docs, materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
        discard(before)
    return STAGES[-1][1](spark, docs, sf_dir)


REGISTRY = {"pipeline": run}
SQL: dict[str, str] = {}
