"""Registered queries of the training-data operators: one per operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir
from . import bpe, filter_audit, html_text, mixing, partenum, quality, recompression, secrets, toxicity, voronoi, vptree, warc, word_bpe
from .common import table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
WORD_VOCABULARY = "word_bpe_49k.json"


def vocab_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _over(name: str, fn: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        ensure_checkpoint_dir(spark)
        return fn(table(spark, sf_dir, name))
    return query


def _with_labels(fn: Callable[[DataFrame, DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        ensure_checkpoint_dir(spark)
        return fn(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return query


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": _with_labels(toxicity.toxicity_report),
    "op2_mixing": _over("documents", mixing.mix_report),
    "op3_quality": _with_labels(quality.quality_report),
    "op4_partenum": _over("documents", partenum.near_duplicates),
    "op5_byte_bpe": _over("documents", lambda d: bpe.round_trip_report(d, vocab_path())),
    "op6_html": _over("pages", html_text.page_report),
    "op7_warc": _over("pages", warc.archive_report),
    "op8_vptree": _over("embeddings", vptree.nearest),
    "op10_voronoi": _over("embeddings", voronoi.top_k),
    "op9_secrets": _over("documents", secrets.secrets_report),
    "op11_runs": _over("documents", recompression.run_report),
    "op12_filter_audit": _with_labels(filter_audit.audit_report),
    "op13_tree_bpe": _over("documents", lambda d: word_bpe.round_trip_report(d, vocab_path(WORD_VOCABULARY))),
}
