"""License notices in texts, also when a few of their words differ.

Method: diagonal voting. All rolling three-word grams of the texts meet the grams
of the templates in a join on their hash (and on the words themselves). A hit at
word ``p`` of a text and ``q`` of a template votes for the diagonal ``p - q``.
Diagonals next to each other are merged, as a missing or added word moves the
rest of a notice by one, and a merged span is verified by the share of the
template's words it covers.

Only built-in functions are used. The templates are a fixed list of a few hundred
grams and are broadcast. Texts stay where they are: only hits are shuffled, keyed
by document, so a frequent notice is spread over all documents that hold it.

Null and empty texts have no words and no labels. Documents are told apart by key
and text: repeated rows each get the same result, a null key is a key. Other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerleaf.llm.common import let, lower_latin, text_or_empty

K = 3
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Phrases that count wherever their words stand consecutively.
BASE_PHRASES = (
    ("mit", "under the mit license"),
    ("apache-2", "apache license version 2"),
    ("cc-by-nc", "cc by nc"),
)

# Notices that are found by the share of their words.
NOTICES = (
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this"
        " software and associated documentation files",
    ),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("cc-by-nc", "creative commons attribution noncommercial"),
    ("cc-by-sa", "creative commons attribution sharealike"),
    ("cc-by-sa", "licensed under cc by sa"),
    ("gpl-3", "gnu general public license version 3"),
    ("gpl-2", "gnu general public license version 2"),
    ("lgpl", "gnu lesser general public license"),
    ("agpl-3", "gnu affero general public license"),
    ("mpl-2", "mozilla public license version 2 0"),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are"
        " permitted provided that the following conditions are met",
    ),
    (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or"
        " without fee is hereby granted",
    ),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
)


def scan_words(text: Column) -> Column:
    """Runs of letters and digits of ASCII and of any other characters, A-Z in lower case."""
    parts = F.split(lower_latin(text), SEPARATORS)
    return let(
        parts,
        lambda p: F.slice(
            p,
            F.when(F.element_at(p, 1) == "", 2).otherwise(1),
            F.size(p)
            - F.when(F.element_at(p, 1) == "", 1).otherwise(0)
            - F.when((F.size(p) > 1) & (F.element_at(p, -1) == ""), 1).otherwise(0),
        ),
    )


def _grams(words: Column) -> Column:
    def gram(i: Column) -> Column:
        parts = [F.element_at(words, i + j) for j in range(K)]
        return F.struct(F.xxhash64(*parts).alias("hash"), F.concat_ws(" ", *parts).alias("gram"))

    return F.when(F.size(words) < K, F.array().cast("array<struct<hash:bigint,gram:string>>")).otherwise(
        F.transform(F.sequence(F.lit(1), F.size(words) - (K - 1)), gram)
    )


def template_grams(spark: SparkSession, templates: tuple[tuple[str, str, bool], ...]) -> DataFrame:
    """Rows (template, label, exact, length, q, hash, gram) of a fixed list of templates."""
    rows = F.array(
        *[
            F.struct(
                F.lit(number).alias("template"),
                F.lit(label).alias("label"),
                F.lit(exact).alias("exact"),
                F.split(F.lit(phrase), " ").alias("words"),
            )
            for number, (label, phrase, exact) in enumerate(templates)
        ]
    )
    listed = spark.range(1).select(F.inline(rows))
    return listed.select(
        "template",
        "label",
        "exact",
        F.size("words").alias("length"),
        F.posexplode(_grams(F.col("words"))).alias("q", "g"),
    ).select("template", "label", "exact", "length", "q", "g.hash", "g.gram")


def scan_licenses(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    share: float = 0.85,
    drift: int = 2,
) -> DataFrame:
    """Verified spans: key, text_hash, label, exact, start and stop (words, stop exclusive), score.

    ``share`` is the least part of a notice's words that a span covers, ``drift``
    the widest step between diagonals that are merged.
    """
    templates = tuple((label, phrase, True) for label, phrase in BASE_PHRASES) + tuple(
        (label, phrase, False) for label, phrase in NOTICES
    )
    known = template_grams(docs.sparkSession, templates)
    whole = text_or_empty(text)
    rows = docs.select(
        F.col(key).alias("key"),
        F.xxhash64(whole).alias("text_hash"),
        F.posexplode(let(scan_words(whole), _grams)).alias("p", "g"),
    ).select("key", "text_hash", "p", "g.hash", "g.gram")
    hits = (
        rows.join(F.broadcast(known.withColumnRenamed("gram", "wanted")), "hash")
        .where(F.col("gram") == F.col("wanted"))
        .select("key", "text_hash", "template", "label", "exact", "length", "p", "q")
        .withColumn("diagonal", F.col("p") - F.col("q"))
        .distinct()
    )
    place = ["key", "text_hash", "template", "label", "exact", "length"]
    ordered = Window.partitionBy("key", "text_hash", "template").orderBy("diagonal", "p")
    # Exact phrases keep to one diagonal, notices may drift.
    step = F.when(F.col("exact"), 0).otherwise(drift)
    fresh = F.col("diagonal") - F.lag("diagonal").over(ordered) > step
    spans = (
        hits.withColumn("fresh", F.coalesce(fresh, F.lit(True)).cast("int"))
        .withColumn("span", F.sum("fresh").over(ordered))
        .groupBy(*place, "span")
        .agg(
            F.min("p").alias("start"),
            (F.max("p") + K).alias("stop"),
            F.sort_array(F.collect_set("q")).alias("places"),
        )
    )
    covered = F.aggregate(
        F.zip_with(
            F.col("places"),
            F.slice("places", 2, F.size("places")),
            lambda a, b: F.coalesce(F.least(b - a, F.lit(K)), F.lit(K)),
        ),
        F.lit(0),
        lambda total, n: total + n,
    )
    least = F.when(F.col("exact"), 1.0).otherwise(share)
    return (
        spans.withColumn("score", covered / F.col("length"))
        .where(F.col("score") >= least)
        .select("key", "text_hash", "label", "exact", "start", "stop", "score")
    )


def label_documents(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each document: key, n_words, and what the spans of its text add up to."""
    spans = scan_licenses(docs, key, text)
    exact = F.col("exact")
    found = spans.groupBy("key", "text_hash").agg(
        F.count(F.when(exact, True)).alias("n_base"),
        F.min(F.when(exact, F.col("start"))).cast("long").alias("first_word"),
        F.max(F.when(exact, F.col("start"))).cast("long").alias("last_word"),
        F.array_join(F.sort_array(F.collect_set(F.when(exact, F.col("label")))), ",").alias(
            "base_labels"
        ),
        F.array_join(F.sort_array(F.collect_set("label")), ",").alias("labels"),
        F.max("score").alias("score"),
    )
    whole = text_or_empty(text)
    rows = docs.select(
        F.col(key).alias("key"),
        F.xxhash64(whole).alias("text_hash"),
        let(scan_words(whole), F.size).cast("long").alias("n_words"),
    ).alias("d")
    same = F.col("d.key").eqNullSafe(F.col("f.key")) & (
        F.col("d.text_hash") == F.col("f.text_hash")
    )
    return rows.join(found.alias("f"), same, "left").select(
        F.col("d.key").alias(key),
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
