"""The corpus pipeline: raw documents in, clean encoded ones out.

Every stage is a function of (spark, docs, sf_dir); its result is written as
Parquet and read again as the docs of the next. All but the last return the
columns of docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dockline.llm import bpe, decontaminate, minhash, quality, secrets
from dockline.llm.common import read_table
from dockline.llm.queries import vocabulary
from dockline.session import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules or the isolation forest reject go."""
    forest = quality.fit(docs, read_table(spark, sf_dir, "labels"))
    return quality.score_rules(docs, forest, docs.columns, only_kept=True).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays."""
    return minhash.drop_near_duplicates(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; its secrets are replaced by a mark."""
    return secrets.redact(docs, secrets.fit(secrets.samples(docs)))


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of every document, with digests of the tokens and of the text decoded from them."""
    keep = [c for c in docs.columns if c != "text"]
    return bpe.round_trip(docs, vocabulary(), keep, with_ids=True)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scan", secret_scan),
    ("bpe_encoding", bpe_encoding),
]

# SQL cannot grow a forest, sketch, or encode; tests/llm compares with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
