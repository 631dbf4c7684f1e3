"""The operators as registered queries, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from verdigrid.llm import collocations, lexical, repetition, topk
from verdigrid.llm.bytenet import fit_quality, score_quality
from verdigrid.llm.packing import pack
from verdigrid.llm.personal import find_personal
from verdigrid.llm.pieces import encode_pieces
from verdigrid.llm.repetition import quality_rules
from verdigrid.llm.secrets import scan_secrets
from verdigrid.llm.sharding import shard_documents
from verdigrid.llm.simhash import simhash_groups
from verdigrid.llm.tokenfiles import token_files
from verdigrid.llm.topk import top_k
from verdigrid.llm.toxicity import fit_toxicity, score_toxicity

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
LLM_SQL: dict[str, str] = {}


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def _register(key: str, sql: str | None = None):
    def register(build):
        LLM_QUERIES[key] = build
        if sql:
            LLM_SQL[key] = sql
        return build

    return register


@_register("op1_secret_scans")
def secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    return scan_secrets(_table(spark, folder, "documents"))


@_register("op9_simhash")
def simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash_groups(_table(spark, folder, "documents"))


@_register("op10_quality_rules", repetition.SQL)
def rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules(_table(spark, folder, "documents"))


@_register("op8_toxicity")
def toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return score_toxicity(docs, fit_toxicity(docs, _table(spark, folder, "labels")))


@_register("op6_quality_classifier")
def quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return score_quality(docs, fit_quality(docs, _table(spark, folder, "labels")))


@_register("op4_best_fit_packing")
def best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(_table(spark, folder, "documents"))


@_register("op5_sharding")
def sharding(spark: SparkSession, folder: str) -> DataFrame:
    return shard_documents(_table(spark, folder, "documents"))


@_register("op7_exact_top_k", topk.SQL)
def exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return top_k(_table(spark, folder, "embeddings"))


@_register("op2_token_files")
def token_id_files(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return token_files(docs, public_tokenizers.path("word_bpe_49k.json"))


@_register("op3_sentencepiece")
def sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return encode_pieces(docs, public_tokenizers.path("piece_bpe_32k.model"))


@_register("op13_collocations", collocations.SQL)
def phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(_table(spark, folder, "documents"))


@_register("op11_lexical_search", lexical.SQL)
def lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    docs, items = _table(spark, folder, "documents"), _table(spark, folder, "benchmark")
    return lexical.lexical_search(docs, items)


@_register("op12_personal_data")
def personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return find_personal(_table(spark, folder, "documents"))
