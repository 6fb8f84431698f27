"""One registered query per operator, over the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import (
    bpe, decontam, filter_audit, html_text, jaccard, langid, multi_index, periodic, repeats, secrets, sharding, simhash, warc,
)
from .tables import table

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


@query
def op1_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.passages(table(spark, sf_dir, "documents"))


@query
def op2_host_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


@query
def op3_inverted_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query
def op4_signature_tree_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"), k=4, share=85)


@query
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


@query
def op6_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.roundtrip(table(spark, sf_dir, "pages")).drop("url")


@query
def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")


@query
def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op9_bpe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(table(spark, sf_dir, "documents"), TOKENIZER)


@query
def op10_shard_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))


@query
def op11_covering_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.summary(periodic.find(table(spark, sf_dir, "documents"), periodic.echoed))
