"""Allow and block pages by their address.

Explicit rules come first: a rule names a host and the start of a path, fits the
host and all its subdomains, and the longest rule that fits decides.

Other pages are judged by the reputation of their host. Method: empirical Bayes.
Pages with a known outcome are counted by host; a host's share of bad pages is
shrunk towards that of its registered domain, the domain's towards its suffix's,
the suffix's towards that of all pages. Each step is a beta-binomial posterior
whose prior has the mean of the parent's other members, so that no page counts
twice, and a strength fitted to all members of the level. A host is blocked when the lower bound of its posterior is above a limit,
so hosts with little evidence stay allowed.

In plain columns: counts are added up before they are shuffled, so a host with a
third of all pages is one row per task; everything after works on one row for
each host. The table of hosts is stored before it meets the pages: it is
broadcast only when it is small, else a hot host is split by adaptive execution.

A null address, or one without ``://``, has an empty host and path. Repeated rows
are judged one by one and count one by one. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerleaf.llm.common import lower_az
from ledgerleaf.scratch import settle

ALLOW, BLOCK = "allow", "block"
# Suffixes of two parts under which names are registered.
TWO_PART_SUFFIXES = (
    "co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.nz", "co.jp",
    "or.jp", "ac.jp", "com.br", "com.cn", "com.mx", "com.ar", "co.in", "co.kr", "co.za",
)


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class Reputation:
    """A host is blocked when mean - ``spread`` standard deviations exceeds ``limit``."""

    limit: float = 0.5
    spread: float = 1.645
    weakest: float = 1.0  # bounds of the strength of a prior, in pages
    strongest: float = 10000.0


def host_of(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/``, ``?`` or ``#``, A-Z in lower case."""
    found = F.regexp_extract(url, "://([^/?#]*)", 1)
    return F.coalesce(lower_az(found), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """(text, verdict) of the longest rule that fits, or null."""
    ordered = sorted(rules, key=lambda r: (-len(r.text), r.text))
    found = F.lit(None).cast("struct<text:string,verdict:string>")
    for rule in reversed(ordered):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        value = F.struct(F.lit(rule.text).alias("text"), F.lit(rule.verdict).alias("verdict"))
        found = F.when(fits, value).otherwise(found)
    return found


def _suffix(host: Column) -> Column:
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*TWO_PART_SUFFIXES), two).otherwise(F.substring_index(host, ".", -1))


def _posterior(units: DataFrame, settings: Reputation) -> DataFrame:
    """``units`` (n, bad, prior: the parent's mean) with ``strength`` and ``mean``.

    The strength is fitted by moments: deviations from the parents' means beyond
    those that chance makes are the spread of the beta distribution. Without any
    deviation it is as large as the number of known pages, without repeated
    observations it is the weakest.
    """
    n, bad, prior = F.col("n"), F.col("bad"), F.col("prior")
    chance = prior * (1 - prior)
    seen = units.where("n > 0").agg(
        F.sum((bad - n * prior) * (bad - n * prior) / n - chance).alias("above"),
        F.sum(chance * (n - 1)).alias("room"),
        F.sum(n).alias("pages"),
    )
    share = F.col("above") / F.col("room")
    weakest = F.lit(settings.weakest)
    strongest = F.greatest(weakest, F.least(F.lit(settings.strongest), F.col("pages")))
    fitted = (
        F.when((F.col("room") > 0) & (share > 0), F.least(F.greatest(1 / share - 1, weakest), strongest))
        .when(F.col("room") > 0, strongest)
        .otherwise(weakest)
    )
    return units.withColumn("strength", seen.select(fitted).scalar()).withColumn(
        "mean", (bad + F.col("strength") * prior) / (n + F.col("strength"))
    )


def host_reputation(outcomes: DataFrame, settings: Reputation = Reputation()) -> DataFrame:
    """One row for each host of ``outcomes`` (host, bad: true, false or null for unknown).

    Returns host, n, bad, mean and low, the lower bound of the share of bad pages.
    """
    host = F.col("host")
    hosts = (
        outcomes.groupBy("host")
        .agg(
            F.count("bad").cast("double").alias("n"),
            F.coalesce(F.sum(F.col("bad").cast("int")), F.lit(0)).cast("double").alias("bad"),
        )
        .withColumn("suffix", _suffix(host))
        .withColumn("domain", F.expr("substring_index(host, '.', -1 - size(split(suffix, '[.]')))"))
    )
    hosts = settle(hosts, "hosts")

    def level(*by: str) -> DataFrame:
        return hosts.groupBy(*by).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))

    def below(units: DataFrame, parents: DataFrame, by: list[str]) -> DataFrame:
        """``units`` with the mean of the rest of their parent as ``prior``."""
        p = parents.select(*by, *[F.col(c).alias(f"_{c}") for c in ("n", "bad", "prior", "strength")])
        rest = F.col("_bad") - F.col("bad") + F.col("_strength") * F.col("_prior")
        size = F.col("_n") - F.col("n") + F.col("_strength")
        joined = units.join(p, by).withColumn("prior", rest / size)
        return joined.drop("_n", "_bad", "_prior", "_strength")

    total = hosts.agg(F.struct(F.sum("n").alias("n"), F.sum("bad").alias("bad")))
    suffixes = level("suffix").withColumn("all", total.scalar())
    others = F.col("all.bad") - F.col("bad") + 1
    suffixes = suffixes.withColumn("prior", others / (F.col("all.n") - F.col("n") + 2)).drop("all")
    suffixes = _posterior(suffixes, settings)
    domains = _posterior(below(level("domain", "suffix"), suffixes, ["suffix"]), settings)
    judged = _posterior(below(hosts, domains, ["domain", "suffix"]), settings)
    weight = F.col("n") + F.col("strength")
    deviation = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (weight + 1))
    return judged.select(
        "host", "n", "bad", "mean", (F.col("mean") - settings.spread * deviation).alias("low")
    )


def filter_urls(
    pages: DataFrame,
    rules: Sequence[Rule],
    settings: Reputation = Reputation(),
    key: str = "page_id",
    url: str = "url",
    outcome: str | None = None,
) -> DataFrame:
    """One row for each page: key, host, path, rule, verdict.

    ``outcome`` names a boolean column: true for a page known as bad, null for
    unknown. Without it the verdicts of the rules are the known outcomes.
    """
    link = F.col(url).cast("string")
    known = F.lit(None).cast("boolean") if outcome is None else F.col(outcome)
    rows = (
        pages.select(
            F.col(key).alias("key"),
            host_of(link).alias("host"),
            path_of(link).alias("path"),
            known.alias("known"),
        )
        .withColumn("fit", matching_rule(F.col("host"), F.col("path"), rules))
        .withColumn("by_rule", F.col("fit.verdict"))
    )
    bad = F.col("known") if outcome is not None else F.col("by_rule") == BLOCK
    reputation = settle(
        host_reputation(rows.select("host", bad.alias("bad")), settings)
        .select("host", (F.col("low") > settings.limit).alias("blocked")),
        "reputation",
    )
    by_host = F.when(F.col("blocked"), BLOCK).otherwise(ALLOW)
    return rows.join(reputation, "host", "left").select(
        F.col("key").alias(key),
        "host",
        "path",
        F.col("fit.text").alias("rule"),
        F.coalesce("by_rule", by_host).alias("verdict"),
    )
