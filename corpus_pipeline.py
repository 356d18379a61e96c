"""Corpus pipeline over ``documents``: quality, near duplicates, secrets, mixing, tokens.

Every stage takes (spark, docs, sf_dir), works on all its predecessor kept and returns a DataFrame;
``run`` writes it as Parquet below the shared checkpoint folder and hands the re-read table on. All
stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tsuji.llm import bpe, mixing, partenum, quality, secrets
from tsuji.llm.common import table, written
from tsuji.llm.queries import vocab_path
from tsuji.session import ensure_checkpoint_dir

#: SQL cannot express the classifier, the shuffle hash or the tokenizer.
ORACLE_SQL = None


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier rejects go."""
    model = quality.learn(docs, table(spark, sf_dir, "labels"))
    name = "quality"
    while any(c.startswith(name) for c in docs.columns):       # the score must not hide a column
        name = f"_{name}"
    return quality.score(docs, model, prefix=name).where(F.col(name) >= quality.THRESHOLD).select(*docs.columns)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of documents linked by near-equal shingle sets the smallest id stays."""
    return partenum.one_per_group(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked; ``n_chars`` follows the text."""
    clean = secrets.redact(docs, secrets.train(docs))
    length = F.char_length("text").cast(docs.schema["n_chars"].dataType)
    return clean.select(*[F.coalesce(length, F.col(c)).alias(c) if c == "n_chars" else F.col(c) for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a document as often as its source's share takes it."""
    return mixing.mixed_documents(docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of the text decoded from them."""
    return bpe.round_trip_report(docs, vocab_path())


STAGES = [
    ("quality classifier", quality_classifier),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("secret scans", secret_scan),
    ("mixing sources to target weights", mix_sources),
    ("byte-level BPE encoding and decoding", byte_bpe),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{number}")
    return docs
