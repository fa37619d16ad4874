"""URL filter: listed rules first, then an empirical-Bayes reputation of the host.

Labelled pages give each host a number of good outcomes out of a number of
trials.  A host with few labels borrows from its registered domain, the domain
from its suffix, the suffix from all pages: at each level the outcomes of the
children are taken as beta-binomial, the prior's mean is the parent's estimate
and its weight is fitted to how much the children differ (moments).  A page
passes if the lower bound of its host's posterior reaches a floor.

Registered domain and suffix are the last two labels and the last label of the host.

Nulls and odd rows: a URL that is null or has no ``://`` has an empty host and an
empty path; all such pages form one host.  A null outcome is no trial.  Repeated
rows count as often as they occur.  Without any label every prior is even
(mean ``DEFAULT_MEAN``).  Columns of the input named like an output column are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almanac.llm.apart import own_columns_apart
from almanac.staging import stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Prior mean without any label; bounds of a fitted prior's weight, in pages.
DEFAULT_MEAN = 0.5
LEAST_WEIGHT, MOST_WEIGHT = 1.0, 10000.0

# Standard deviations below the mean at which the bound lies (a one-sided 95 % bound), and the floor it must reach.
DEVIATIONS = 1.645
FLOOR = 0.5


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, r"://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, its verdict) of the longest rule that fits, else nulls.

    A rule is a host, then a path that begins with ``/``.  It fits its host and all subdomains.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: len(r[0])):
        domain, slash, below = text.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(slash + below)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


def _weight(children: DataFrame, mean: Column) -> DataFrame:
    """One row with the prior weight that explains how the children's rates spread around ``mean``.

    ``children`` has (k, n): successes and trials.  The weight of a beta prior with variance v is mean (1 - mean) / v - 1.
    """
    seen = children.where("n > 0")
    sums = seen.agg(
        F.coalesce(F.sum("k"), F.lit(0)).alias("k"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        F.count("*").alias("groups"),
        F.coalesce(F.sum(F.col("n") * F.col("n")), F.lit(0)).alias("squares"),
        F.coalesce(F.sum(F.col("k") * F.col("k") / F.col("n")), F.lit(0.0)).alias("between"),
    )
    noise = F.col("mean") * (1 - F.col("mean"))
    spread = F.col("between") - F.col("n") * F.col("mean") * F.col("mean") - (F.col("groups") - 1) * noise
    room = F.col("n") - F.col("squares") / F.when(F.col("n") > 0, F.col("n"))
    variance = spread / F.when(room > 0, room)
    fitted = F.when(variance > 0, noise / F.when(variance > 0, variance) - 1).otherwise(MOST_WEIGHT)
    return sums.withColumn("mean", mean).select(
        "mean", F.greatest(F.lit(LEAST_WEIGHT), F.least(F.lit(MOST_WEIGHT), fitted)).alias("weight")
    )


def reputation(outcomes: DataFrame) -> DataFrame:
    """(host, trials, mean, bound) for every host in ``outcomes`` (host, good: boolean or null).

    The tables of hosts and domains are written between the levels, so the joins
    between levels can split a domain that holds many hosts.
    """
    labels = F.split("host", r"\.")
    hosts = stage(
        outcomes.groupBy("host")
        .agg(F.coalesce(F.sum(F.col("good").cast("bigint")), F.lit(0)).alias("k"), F.count("good").alias("n"))
        .withColumn("domain", F.array_join(F.slice(labels, -F.least(F.size(labels), F.lit(2)), 2), "."))
        .withColumn("suffix", F.element_at(labels, -1)),
        "host-outcomes",
    )
    domains = stage(
        hosts.groupBy("domain", "suffix").agg(F.sum("k").alias("k"), F.sum("n").alias("n")), "domain-outcomes"
    )
    suffixes = domains.groupBy("suffix").agg(F.sum("k").alias("k"), F.sum("n").alias("n"))
    overall = F.coalesce(F.col("k") / F.when(F.col("n") > 0, F.col("n")), F.lit(DEFAULT_MEAN))
    top, middle, low = (_weight(level, overall).first() for level in (suffixes, domains, hosts))

    def shrunk(prior_mean: Column, weight: float) -> Column:
        return (F.col("k") + prior_mean * weight) / (F.col("n") + weight)

    suffix_means = suffixes.select("suffix", shrunk(F.lit(top["mean"]), top["weight"]).alias("suffix_mean"))
    domain_means = stage(
        domains.join(suffix_means, "suffix").select(
            "domain", shrunk(F.col("suffix_mean"), middle["weight"]).alias("domain_mean")
        ),
        "domain-means",
    )
    mean = shrunk(F.col("domain_mean"), low["weight"])
    deviation = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("trials") + low["weight"] + 1))
    return (
        hosts.join(domain_means, "domain")
        .select("host", F.col("n").alias("trials"), mean.alias("mean"))
        .withColumn("bound", F.col("mean") - DEVIATIONS * deviation)
    )


@own_columns_apart
def judge(
    pages: DataFrame,
    labels: DataFrame,
    rules: Sequence[tuple[str, str]] = (),
    key: str = "page_id",
    url: str = "url",
    floor: float = FLOOR,
) -> DataFrame:
    """``pages`` with host, path, rule, verdict, host_mean and host_bound.

    ``labels`` has (``key``, good: boolean): outcomes of some pages.  The verdict is the
    longest fitting rule's, else ``allow`` if the bound reaches ``floor``, else ``block``.
    Several labels of one page count as several trials; pages with a null key have none.
    """
    added = ("host", "path", "rule", "verdict", "host_mean", "host_bound")
    host, path = host_of(F.col(url)), path_of(F.col(url))
    outcomes = (
        pages.select(F.col(key).alias("page"), host.alias("host"))
        .join(labels.select(F.col(key).alias("page"), F.col("good")), "page", "left")
        .select("host", "good")
    )
    known = stage(reputation(outcomes), "reputation").select(
        F.col("host").alias("__host"), F.col("mean").alias("host_mean"), F.col("bound").alias("host_bound")
    )
    rule, says = matching_rule(F.col("host"), F.col("path"), rules)
    return (
        pages.drop(*added)
        .withColumn("host", host)
        .withColumn("path", path)
        .join(known, F.col("host") == F.col("__host"), "left")
        .drop("__host")
        .withColumn("rule", rule)
        .withColumn("verdict", F.coalesce(says, F.when(F.col("host_bound") >= floor, "allow").otherwise("block")))
    )
