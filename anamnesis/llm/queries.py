"""The registered queries of this subpackage, one per operator, and their checks in SQL."""

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, classifier, lexical, licenses, lines, mixing, quality, runs, secrets, simhash, topk, warc
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = build
        if oracle is not None:
            ORACLES[name] = oracle
        return build

    return register


@query("op2_pivotal_mixing")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


@query("op3_byte_bpe_round_trip")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.round_trip(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


@query("op5_simhash_near_duplicates")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3)


@query("op6_linked_secrets")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(table(spark, sf_dir, "documents"))


@query("op8_license_scan")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


@query("op10_host_quality_rules", quality.host_sql())
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judged(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query("op4_chunked_warc", warc.SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(spark, table(spark, sf_dir, "pages"))


@query("op7_chat_perspectives", chat.SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.perspectives(table(spark, sf_dir, "conversations"))


@query("op9_max_score_top_k", topk.sql())
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


@query("op1_ordinal_quality")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op11_grammar_runs")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.digests(table(spark, sf_dir, "documents"), repeats=True)


@query("op13_line_dedup", lines.sql())
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.digests(table(spark, sf_dir, "documents"), least_documents=10, least_chars=1)


@query("op12_dual_tree_search", lexical.sql())
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)
