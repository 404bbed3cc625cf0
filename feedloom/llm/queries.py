"""Queries of the corpus operators, and the SQL that gives the same rows where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from feedloom.llm.decontaminate import benchmark_in_documents
from feedloom.llm import licenses, merkle, middles, mixing, topk, urls
from feedloom.llm.language import language_of_documents
from feedloom.llm.quality import quality_of_documents
from feedloom.llm.secrets import secrets_of_documents
from feedloom.llm.simhash import simhash_of_documents
from feedloom.llm.tokens import whole_token_totals
from feedloom.llm.toxicity import toxicity_of_documents
from feedloom.session import prepare

Query = Callable[[SparkSession, str], DataFrame]


def _prepared(fn: Query) -> Query:
    return lambda spark, sf_dir: fn(prepare(spark), sf_dir)


QUERIES: dict[str, Query] = {
    name: _prepared(fn)
    for name, fn in {
        "op1_license_scan": licenses.licenses_of_documents,
        "op2_mixing": mixing.mixed_documents,
        "op3_secret_scan": secrets_of_documents,
        "op4_simhash": simhash_of_documents,
        "op5_url_filter": urls.urls_of_pages,
        "op6_token_counts": whole_token_totals,
        "op7_quality": quality_of_documents,
        "op8_language_id": language_of_documents,
        "op9_decontamination": benchmark_in_documents,
        "op10_toxicity": toxicity_of_documents,
        "op11_merkle_manifest": merkle.manifest_of_documents,
        "op12_top_k": topk.top_k_of_embeddings,
        "op13_fill_in_middle": middles.middles_of_documents,
    }.items()
}

ORACLES: dict[str, str] = {
    "op1_license_scan": licenses.oracle(),
    "op2_mixing": mixing.oracle(),
    "op5_url_filter": urls.ORACLE,
    "op11_merkle_manifest": merkle.ORACLE,
    "op12_top_k": topk.ORACLE,
    "op13_fill_in_middle": middles.ORACLE,
}
