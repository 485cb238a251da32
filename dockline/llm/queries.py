"""One query per operator, applied with production parameters to whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockline.llm import bpe, decontaminate, divergence, licences, minhash, mixing, pii, ppm, quality, runs, secrets, toxicity, warc
from dockline.llm.common import WORD, read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def vocabulary() -> str:
    """The tokenizer file; it is installed with the same path on all machines."""
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


@query
def op1_bpe(spark: SparkSession, sf: str) -> DataFrame:
    """Tokens of every document and the text decoded from them, as digests."""
    return bpe.round_trip(read_table(spark, sf, "documents"), vocabulary())


@query
def op2_secrets(spark: SparkSession, sf: str) -> DataFrame:
    """Secrets of every document, by pattern and by character models."""
    docs = read_table(spark, sf, "documents")
    found = secrets.scan(docs, secrets.fit(secrets.samples(docs)), ["doc_id"])
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex", "n_markov",
        F.sha2(secrets.spans_text(F.col("found"), base_only=True), 256).alias("base_sha256"),
        secrets.spans_text(F.col("found")).alias("spans"),
    )


@query
def op3_minhash(spark: SparkSession, sf: str) -> DataFrame:
    """The class of near duplicates of every document."""
    return minhash.near_duplicates(read_table(spark, sf, "documents"))


@query
def op4_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    """Severity of every document."""
    docs = read_table(spark, sf, "documents")
    return toxicity.score(docs, toxicity.fit(docs, read_table(spark, sf, "labels")), ["doc_id"])


@query
def op5_ppm(spark: SparkSession, sf: str) -> DataFrame:
    """Log10 probability of every document; a fifth of them is held out of training."""
    docs = read_table(spark, sf, "documents")
    held_out = F.crc32(docs["doc_id"].cast("string")) % 5 == 1
    return ppm.score(docs, held_out)


@query
def op6_warc(spark: SparkSession, sf: str) -> DataFrame:
    """Pages written to WARC archives and read back."""
    return warc.archive_pages(read_table(spark, sf, "pages")).drop("url")


@query
def op7_pii(spark: SparkSession, sf: str) -> DataFrame:
    """Every document with surrogates for its personal data.

    A fixed key keeps the result repeatable; a deployment passes its own secret.
    """
    return pii.replace(read_table(spark, sf, "documents"), "op7", ["doc_id"])


@query
def op8_quality(spark: SparkSession, sf: str) -> DataFrame:
    """Rule statistics and the verdict of an isolation forest."""
    docs = read_table(spark, sf, "documents")
    forest = quality.fit(docs, read_table(spark, sf, "labels"))
    return quality.score_rules(docs, forest, ["doc_id"])


@query
def op9_licences(spark: SparkSession, sf: str) -> DataFrame:
    """Licences named in every document, with their number."""
    found = licences.scan(read_table(spark, sf, "documents"), ["doc_id"])
    name = F.array_join(F.transform("licences", lambda x: x["licence"]), ",")
    best = F.array_max(F.transform("licences", lambda x: x["dice"]))
    line = F.array_min(F.transform("licences", lambda x: x["line"]))
    return found.select("doc_id", name.alias("licences"), best.alias("dice"), line.alias("line"))


@query
def op10_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    """Every benchmark item that a document holds."""
    return decontaminate.find(read_table(spark, sf, "documents"), read_table(spark, sf, "benchmark"))


def planted_repeats(docs: DataFrame) -> DataFrame:
    """The documents, a tenth of them with a tail that repeats its first words.

    Which ones, from where and with which period follows from the checksum of
    the id. A null id gets no such tail.
    """
    check = F.crc32(docs["doc_id"].cast("string"))
    words = docs.withColumn("_words", F.when(check % 10 == 0, F.regexp_extract_all("text", F.lit(WORD), 0)))
    split = words.withColumns({"_n": F.size("_words").cast("bigint"), "_seed": F.floor(check / 10)})
    placed = split.withColumn("_from", F.when(F.col("_n") > 0, F.col("_seed") % F.col("_n"))).withColumn(
        "_period", F.floor((F.col("_n") - F.col("_from")) / (3 + F.col("_seed") % 8)) + 1)
    taken = F.transform("_words", lambda w, i: F.when(i < F.col("_from"), w).otherwise(
        F.get("_words", (F.col("_from") + (i - F.col("_from")) % F.col("_period")).cast("int"))))
    tail = F.when(F.col("_from").isNotNull(), F.array_join(taken, " "))
    return placed.withColumn("text", F.coalesce(tail, "text")).select(*docs.columns)


@query
def op11_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Periodic runs of words in every document; a tenth of the documents are made to repeat themselves."""
    docs = planted_repeats(read_table(spark, sf, "documents").select("doc_id", "text"))
    found = runs.periodic_runs(docs, ["doc_id"])
    line = F.transform(
        F.arrays_zip("run_starts", "run_lengths", "run_periods"),
        lambda r: F.concat(F.concat_ws(",", r["run_starts"], r["run_lengths"], r["run_periods"]), F.lit("\n")),
    )
    return found.select(
        "doc_id", "n_runs", "start", "length", "period",
        F.floor(F.col("length") * 1000 / F.col("period")).alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query
def op12_mixing(spark: SparkSession, sf: str) -> DataFrame:
    """Words that a mix of all sources takes of every document."""
    return mixing.taken_words(*mixing.mix(read_table(spark, sf, "documents")))


@query
def op13_divergence(spark: SparkSession, sf: str) -> DataFrame:
    """How the terms of each source differ from those of the other sources of its language."""
    return divergence.audit(read_table(spark, sf, "documents"))
