"""From raw documents to token ids: the stages of a corpus, each written and read by the next.

1. quality rules: documents that the rules reject go;
2. SimHash near-duplicates: of each group the smallest doc_id stays;
3. secret scans: every span found is replaced by a mark in the text;
4. mixing: each document is taken as often as its source's target says;
5. byte-level BPE: ids of each text, and the proof that they decode to it.

All stages but the last return the columns of their input as they came. Nulls,
empty texts, repeated rows, empty tables and extra columns are treated as the
operators say.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from anamnesis.llm import bpe, mixing, quality, secrets, simhash
from anamnesis.llm.common import materialize, table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.passing(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs, shingle=3)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redacted(docs)


def mixing_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def bpe_round_trip(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens, ids_sha256 and decoded_sha256 of every row."""
    return bpe.round_trip(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN, ["doc_id", "source"])


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_duplicates),
    ("secret scans", secret_scan),
    ("mixing sources to target weights", mixing_to_targets),
    ("byte-level BPE encoding and decoding", bpe_round_trip),
]

#: Fingerprints and token ids cannot be had in SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number + 1 < len(STAGES):
            docs = materialize(docs, f"corpus-stage-{number}")
    return docs
