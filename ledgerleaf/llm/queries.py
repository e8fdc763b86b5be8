"""One query for each corpus operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerleaf.llm import (
    bpe,
    collocations,
    decontaminate,
    language_id,
    license_scan,
    line_dedup,
    near_dedup,
    quality,
    resample,
    secret_scan,
    substring_dedup,
    url_filter,
    warc,
)
from ledgerleaf.llm.common import read
from ledgerleaf.scratch import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    ids = bpe.bpe_encode(read(spark, sf_dir, "documents"), path)
    return bpe.bpe_decode(ids, path).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(bpe.joined_ids(F.col("ids")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.quality_rules(read(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "host_verdict",
    )


@query
def op5_license(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.label_documents(read(spark, sf_dir, "documents"))


@query
def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find_secrets(read(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"] != "entropy")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(secret_scan.joined_spans(base), 256).alias("base_sha256"),
        secret_scan.joined_spans(F.col("spans")).alias("spans"),
    )


URL_RULES = (
    url_filter.Rule("org", "/", url_filter.ALLOW),
    url_filter.Rule("example.org", "/es/", url_filter.BLOCK),
    url_filter.Rule("example.org", "/en/1", url_filter.BLOCK),
    url_filter.Rule("com", "/fr/", url_filter.ALLOW),
    url_filter.Rule("com", "/de/", url_filter.BLOCK),
)


@query
def op4_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(read(spark, sf_dir, "pages"), URL_RULES)


@query
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_warc(read(spark, sf_dir, "pages"), path, compress=True)
    return warc.read_warc(spark, path).select(
        warc.page_id_of("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        warc.page_id_of("refers_to").alias("refers_to"),
    )


@query
def op9_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substring_dedup.remove_repeats(read(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    join = near_dedup.SimilarityJoin(percent=85)
    found = near_dedup.near_duplicates(read(spark, sf_dir, "documents"), join)
    return found.select(
        "doc_id",
        "n_shingles",
        "component_id",
        "kept",
    )


@query
def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")
    return decontaminate.contaminated(docs, items)


@query
def op2_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    gone = line_dedup.repeated_lines(read(spark, sf_dir, "documents"))
    return gone.select(F.col("doc").alias("doc_id"), F.col("line").cast("long").alias("line_no"))


@query
def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, target = read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")
    drawn = resample.resample(docs, target, resample.Resampling())
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


@query
def op12_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 4 == 2
    model = language_id.learn(docs.where(~held_out))
    return language_id.identify(docs, model).select(
        "doc_id",
        held_out.alias("held_out"),
        F.col("lang").alias("lang_pred"),
        "score",
        "rejected",
    )


@query
def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read(spark, sf_dir, "documents"), collocations.Collocations())
