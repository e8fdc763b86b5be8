"""Quality rules for documents, with verdicts for whole hosts.

Method: every document is measured by a few rules. Failures are added up by
host (the ``source`` of a document), the failure rate of a host is shrunk towards
the corpus by a beta prior fitted to all hosts, and the bounds of its posterior
decide how strictly the documents of the host are judged:

* ``trusted`` (upper bound at most ``trust``): only the base rules count,
* ``rejected`` (lower bound above ``reject``): all of its documents go,
* ``watched``: a document goes if it fails any rule.

Only built-in functions are used. Measuring stays within a row. Failures are
added up before they are shuffled, so a host with a third of all rows is one row
per task. The verdicts of hosts are stored before they are joined, so they are
broadcast only when they are small; a large table is joined with adaptive
splitting of the hot host.

Null and empty texts have no words and fail the base rules. A null host is a
host of its own. Repeated rows are judged one by one, other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerleaf.llm.common import BLANKS, let, text_or_empty, words_of
from ledgerleaf.scratch import settle

SYMBOL = "[#*$%&|<>]"


@dataclass(frozen=True)
class QualityRules:
    """Limits of the rules and of the verdicts."""

    min_words: int = 50
    max_repeat_percent: int = 50
    max_symbol_percent: int = 10  # symbols per 100 words
    max_dup_line_percent: int = 30
    min_word_length: int = 2  # mean characters of a word
    max_word_length: int = 15
    trust: float = 0.01
    reject: float = 0.5
    spread: float = 2.0  # standard deviations between posterior mean and bound


def _repeat_words(words: Column) -> Column:
    """Words inside a three-word window whose words occur twice or more in the text.

    Windows are told apart by a 64-bit hash within one text.
    """
    hashes = F.transform(
        F.sequence(F.lit(1), F.size(words) - 2),
        lambda i: F.xxhash64(
            F.element_at(words, i), F.element_at(words, i + 1), F.element_at(words, i + 2)
        ),
    )

    def covered(places: Column) -> Column:
        """Places are sorted starts of repeated windows."""
        widths = F.zip_with(
            places,
            F.slice(places, 2, F.size(places)),
            lambda a, b: F.coalesce(F.least(b - a, F.lit(3)), F.lit(3)),
        )
        return F.aggregate(widths, F.lit(0), lambda total, n: total + n)

    def places(ordered: Column) -> Column:
        """Neighbours of equal hash in the list ordered by hash and place."""
        twins = F.zip_with(
            F.slice(ordered, 1, F.size(ordered) - 1),
            F.slice(ordered, 2, F.size(ordered)),
            lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])),
        )
        return F.array_sort(F.array_distinct(F.flatten(F.array_compact(twins))))

    def repeated(h: Column) -> Column:
        ordered = F.sort_array(
            F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))
        )
        found = let(let(ordered, places), covered)
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(found)

    return F.when(F.size(words) < 4, F.lit(0)).otherwise(let(hashes, repeated))


def _line_counts(lines: Column) -> Column:
    n = F.size(lines)
    return F.struct(
        n.cast("long").alias("all"),
        (n - F.size(F.array_distinct(lines))).cast("long").alias("dup"),
    )


def measure(docs: DataFrame, rules: QualityRules, text: str = "text") -> DataFrame:
    """``docs`` with ``m``: counts of each text, which base rule fails and which rule at all."""
    whole = text_or_empty(text)
    lines = F.filter(F.split(whole, "\n"), lambda line: line.rlike(rf"[^{BLANKS}]"))

    def counts(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            F.regexp_count(whole, F.lit(SYMBOL)).cast("long").alias("n_symbols"),
            let(lines, _line_counts).alias("lines"),
            _repeat_words(words).cast("long").alias("n_repeat_words"),
        )

    def judged(c: Column) -> Column:
        n, lines = c["n_words"], c["lines"]
        base = (n < rules.min_words) | (100 * c["n_repeat_words"] > rules.max_repeat_percent * n)
        soft = (
            (100 * c["n_symbols"] > rules.max_symbol_percent * n)
            | (100 * lines["dup"] > rules.max_dup_line_percent * lines["all"])
            | (c["word_chars"] < rules.min_word_length * n)
            | (c["word_chars"] > rules.max_word_length * n)
        )
        return F.struct(
            n.alias("n_words"),
            c["word_chars"].alias("word_chars"),
            c["n_symbols"].alias("n_symbols"),
            lines["dup"].alias("n_dup_lines"),
            c["n_repeat_words"].alias("n_repeat_words"),
            base.alias("base_failed"),
            (base | soft).alias("any_failed"),
        )

    return docs.withColumn("m", let(let(words_of(whole), counts), judged))


def host_verdicts(hosts: DataFrame, rules: QualityRules) -> DataFrame:
    """``hosts`` (host, n, failed) with ``rate``, ``low``, ``high`` and ``verdict``.

    The prior is fitted by moments: its mean is the failure rate of all
    documents; its strength follows from how much more the rates of hosts vary
    than chance alone would make them. It lies between 1 and 10,000 documents.
    """
    n, failed = F.col("n").cast("double"), F.col("failed").cast("double")
    total = hosts.agg(
        F.sum("n").cast("double").alias("docs"),
        F.sum("failed").cast("double").alias("fails"),
        F.sum(failed * failed / n).alias("squares"),
        F.count("*").cast("double").alias("hosts"),
    )
    mean = F.col("fails") / F.col("docs")
    chance = mean * (1 - mean)
    between = F.col("squares") - F.col("docs") * mean * mean - (F.col("hosts") - 1) * chance
    weight = F.col("docs") - (F.col("hosts") - 1)
    variance = between / F.greatest(weight, F.lit(1.0))
    strength = F.when(
        variance > 0, F.least(F.greatest(chance / variance - 1, F.lit(1.0)), F.lit(10000.0))
    ).otherwise(F.lit(10000.0))
    prior = total.select(F.struct(mean.alias("mean"), strength.alias("strength"))).scalar()
    parts = hosts.withColumn("_prior", prior)
    size = n + F.col("_prior.strength")
    rate = (failed + F.col("_prior.mean") * F.col("_prior.strength")) / size
    spread = rules.spread * F.sqrt(F.col("rate") * (1 - F.col("rate")) / (size + 1))
    return (
        parts.withColumn("rate", rate)
        .withColumn("low", F.col("rate") - spread)
        .withColumn("high", F.col("rate") + spread)
        .withColumn(
            "verdict",
            F.when(F.col("low") > rules.reject, "rejected")
            .when(F.col("high") <= rules.trust, "trusted")
            .otherwise("watched"),
        )
        .drop("_prior")
    )


def judge(measured: DataFrame, rules: QualityRules, host: str = "source") -> DataFrame:
    """``measured`` with ``host_verdict`` and ``kept``. The input is read twice: store it first."""
    hosts = measured.groupBy(F.col(host).cast("string").alias("host")).agg(
        F.count("*").alias("n"),
        F.sum(F.col("m.any_failed").cast("long")).alias("failed"),
    )
    verdicts = settle(
        host_verdicts(hosts, rules).select(
            F.col("host").alias("_host"), F.col("verdict").alias("host_verdict")
        ),
        "hosts",
    )
    bad = F.col("m.base_failed") | (F.col("host_verdict") == "rejected") | (
        (F.col("host_verdict") == "watched") & F.col("m.any_failed")
    )
    joined = measured.join(
        verdicts, F.col(host).cast("string").eqNullSafe(F.col("_host")), "left"
    )
    return joined.withColumn("kept", ~bad).drop("_host")


def quality_rules(
    docs: DataFrame,
    rules: QualityRules = QualityRules(),
    key: str = "doc_id",
    text: str = "text",
    host: str = "source",
) -> DataFrame:
    """The key of each document, its counts, ``base_failed``, ``host_verdict`` and ``kept``."""
    rows = docs.select(
        F.col(key).alias("_key"), F.col(host).alias("_source"), F.col(text).alias("_text")
    )
    measured = settle(measure(rows, rules, "_text").drop("_text"), "measures")
    return judge(measured, rules, "_source").select(
        F.col("_key").alias(key), "m.*", "host_verdict", "kept"
    )


def keep_good(docs: DataFrame, rules: QualityRules = QualityRules()) -> DataFrame:
    """The rows of ``docs`` (text, source, any others) that the rules keep."""
    columns = [F.col(c).alias(f"c{i}") for i, c in enumerate(docs.columns)]
    rows = docs.select(*columns, F.col("text").alias("text"), F.col("source").alias("source"))
    measured = settle(measure(rows, rules).drop("text"), "measures")
    good = judge(measured, rules).where("kept")
    return good.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])
