"""URL filters: host reputation by empirical Bayes.

Labelled outcomes of pages are counted per host, per registered domain and per suffix. The rate of each
suffix is shrunk towards the overall rate, that of each domain towards its suffix, that of each host
towards its domain, each with a beta prior whose strength is fitted by moments to that level. A host is
blocked when the lower bound of its rate of bad pages is high. Explicit rules come before the verdict.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import ascii_lower, pin


@dataclass(frozen=True)
class UrlRule:
    host: str
    path: str
    verdict: str  # allow or block

    @property
    def name(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class Reputation:
    """A host is blocked when its posterior mean less ``z`` deviations is above ``max_rate``. ``suffixes``
    names public suffixes of several labels; any other suffix is the last label."""

    max_rate: float = 0.5
    z: float = 1.645
    suffixes: Sequence[str] = ("co.uk", "org.uk", "ac.uk", "com.au", "net.au", "co.jp", "co.nz", "com.br")


def host_of(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def suffix_of(host: Column, suffixes: Sequence[str]) -> Column:
    last = F.substring_index(host, ".", -1)
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(list(suffixes)), two).otherwise(last)


def domain_of(host: Column, suffixes: Sequence[str]) -> Column:
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(list(suffixes)), F.substring_index(host, ".", -3)).otherwise(two)


def _level(children: DataFrame, parents: DataFrame, parent: str) -> DataFrame:
    """``children`` (key, parent key, n, bad) with the posterior ``mean`` and ``total`` of their rates.
    ``parents`` has (parent key, prior); the prior's strength is fitted over all children with outcomes."""
    joined = children.join(parents.select(F.col(parent).alias("_parent"), F.col("mean").alias("prior")),
                           F.col(parent).eqNullSafe(F.col("_parent"))).drop("_parent")
    seen = F.col("n") > 0
    part = F.col("n") * F.pow(F.col("bad") / F.col("n") - F.col("prior"), 2) / (F.col("prior") * (1 - F.col("prior")))
    fit = joined.agg(
        F.coalesce(F.sum(F.when(seen, part)), F.lit(0.0)).alias("ss"),
        F.sum(F.when(seen, 1).otherwise(0)).alias("k"),
        F.sum("n").alias("all_n"),
    )
    excess = (F.col("ss") - F.col("k")) / F.greatest(F.col("all_n") - F.col("k"), F.lit(1))
    rho = F.least(F.greatest(F.coalesce(excess, F.lit(0.0)), F.lit(0.0001)), F.lit(0.99))
    fitted = joined.crossJoin(F.broadcast(fit.select((1 / rho - 1).alias("strength"))))  # one row
    total = F.col("n") + F.col("strength")
    mean = (F.col("bad") + F.col("prior") * F.col("strength")) / total
    return fitted.withColumns({"total": total, "mean": mean}).drop("prior", "strength")


def host_rates(counted: DataFrame, params: Reputation = Reputation()) -> DataFrame:
    """(host, mean, total) from ``counted`` (host, n labelled pages, bad ones). Every host gets a rate; one
    without labels has that of its domain."""
    domain, suffix = domain_of(F.col("host"), params.suffixes), suffix_of(F.col("host"), params.suffixes)
    hosts = pin(counted.withColumns({"domain": domain, "suffix": suffix}))
    sums = [F.sum("n").alias("n"), F.sum("bad").alias("bad")]
    domains = hosts.groupBy("domain", "suffix").agg(*sums)
    suffixes = domains.groupBy("suffix").agg(*sums).withColumn("everything", F.lit(1))
    rate = (F.coalesce(F.sum("bad"), F.lit(0)) + 1) / (F.coalesce(F.sum("n"), F.lit(0)) + 2)
    overall = hosts.agg(rate.alias("mean")).withColumn("everything", F.lit(1))
    suffix_rates = _level(suffixes, overall, "everything")
    domain_rates = _level(domains, suffix_rates, "suffix")
    return _level(hosts, domain_rates, "domain").select("host", "mean", "total")


def rule_for(host: Column, path: Column, rules: Sequence[UrlRule]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, NULL without one. The rules are a short list that
    its writer gives; they become one expression, so no page is moved for them."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), len(r.host))):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        name = F.when(fits, F.lit(rule.name)).otherwise(name)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return name, verdict


def judge_urls(
    pages: DataFrame, outcomes: DataFrame, rules: Sequence[UrlRule], params: Reputation = Reputation()
) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict.

    ``outcomes`` (page_id, bad) labels some pages; several labels of a page all count, NULL ones do not.
    Pages without a host share the empty host and are judged like any other; NULL urls are such pages.
    Repeated pages stay repeated. Without any labels nothing is blocked but by rules.
    """
    url = F.col("url").cast("string")
    cut = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"))
    labels = outcomes.select(F.col("page_id").alias("_page"), F.col("bad")).filter("bad is not null")
    # labels are added up per page first, so a page with many labels is one row of the join
    labels = labels.groupBy("_page", "bad").count()
    seen = cut.join(labels, F.col("page_id") == F.col("_page")).select("host", "bad", "count")
    seen = seen.groupBy("host", "bad").agg(F.sum("count").alias("k"))
    counted = cut.select("host").distinct().join(
        seen.groupBy(F.col("host").alias("_host")).agg(
            F.sum("k").alias("n"), F.sum(F.when(F.col("bad"), F.col("k")).otherwise(0)).alias("bad")
        ),
        F.col("host") == F.col("_host"),
        "left",
    )
    n, bad = F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("bad", F.lit(0)).alias("bad")
    rates = host_rates(counted.select("host", n, bad), params)
    deviation = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("total") + 1))
    blocked = rates.filter(F.col("mean") - params.z * deviation > params.max_rate)
    blocked = blocked.select(F.col("host").alias("_blocked"))
    out = cut.join(blocked, F.col("host") == F.col("_blocked"), "left")
    name, verdict = rule_for(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("_blocked").isNotNull(), F.lit("block")).otherwise(F.lit("allow"))
    return out.select("page_id", "host", "path", name.alias("rule"), F.coalesce(verdict, own).alias("verdict"))
