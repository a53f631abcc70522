"""URL filter: explicit rules first, then empirical-Bayes host reputation.

A host's rate of bad pages is estimated from labelled page outcomes and shrunk through three
beta-binomial levels: suffix towards the overall rate, registered domain towards its suffix, host
towards its registered domain. Each level's prior strength follows from the data by the method of
moments (excess of the squared deviations over the binomial ones). A url is blocked when the lower
posterior bound of its host's bad rate, mean - z * standard deviation of the beta posterior, lies
above ``max_bad_rate``; so a host with few labels is judged mostly by its domain and suffix.

Everything is built-in expressions. Only the three prior strengths and the overall rate, four
numbers, pass through the driver. Hosts are counted by partial aggregation before any shuffle, so
a hot host costs no more than another; the judgement table is joined by the optimizer's choice.

Defined results: a url that is null or has no ``://`` has the empty host and path, and the empty
host is treated like any other; a page without a label is judged like the others; a page with
several labels is bad if one of them says so, and its outcome counts once per row of ``pages``.
A host without labels takes its domain's estimate and so on up. Null ids are kept; ``labels`` rows
with null ids count nowhere. Without any label every verdict of the method is ``allow``.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pick

# Suffixes of two labels under which names are registered.
TWO_LABEL_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "co.jp", "co.nz", "co.za", "com.br")

# The rules of the contract, verdict by rule text.
RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}


@dataclass(frozen=True)
class Reputation:
    max_bad_rate: float = 0.3
    z: float = 1.645
    least_correlation: float = 1e-4  # strongest prior: about 10,000 outcomes
    most_correlation: float = 0.5  # weakest prior: one outcome


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1)
    return F.translate(found, string.ascii_uppercase, string.ascii_lowercase)


def url_path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def host_levels(host: Column) -> tuple[Column, Column]:
    """Suffix and registered domain of a host; port and trailing dot ignored."""
    bare = F.regexp_replace(host, r"\.?(:[0-9]*)?$", "")
    last_two = F.substring_index(bare, ".", -2)
    two = last_two.isin(*TWO_LABEL_SUFFIXES)
    suffix = F.when(two, last_two).otherwise(F.substring_index(bare, ".", -1))
    return suffix, F.when(two, F.substring_index(bare, ".", -3)).otherwise(last_two)


def rule_of(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest rule whose host is the url's or above it and whose path begins the url's, or null."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), r)):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit(slash + rest))
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def correlation(level: DataFrame, limits: Reputation) -> float:
    """How alike outcomes within a group are, given the group's prior mean; columns n, bad, prior."""
    n, bad, prior = F.col("n"), F.col("bad"), F.col("prior")
    spread = prior * (1 - prior)
    row = level.select(
        F.sum((bad - n * prior) * (bad - n * prior) - n * spread).alias("excess"),
        F.sum(n * (n - 1) * spread).alias("room"),
    ).first()
    found = row["excess"] / row["room"] if row["room"] else 0.0
    return min(max(found, limits.least_correlation), limits.most_correlation)


def host_reputation(outcomes: DataFrame, limits: Reputation = Reputation()) -> DataFrame:
    """Judge each host of ``outcomes`` (host, bad: 1, 0 or null where unlabelled).

    Returns host, n, bad, bad_rate (posterior mean), bound (its lower bound), blocked.
    """
    counts = outcomes.groupBy("host").agg(
        F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).cast("long").alias("bad")
    )
    suffix, domain = host_levels(F.col("host"))
    hosts = counts.select("host", suffix.alias("suffix"), domain.alias("domain"), "n", "bad")
    total = hosts.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    overall = total["bad"] / total["n"] if total["n"] else 0.0

    def shrunk(level: DataFrame, name: str) -> tuple[DataFrame, Column, Column]:
        same = correlation(level, limits)
        strength = F.lit(1 / same - 1)
        plus = F.col("bad") + strength * F.col("prior")
        return level.withColumn(name, plus / (F.col("n") + strength)), plus, F.col("n") + strength

    sums = (F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    top = hosts.groupBy("suffix").agg(*sums).withColumn("prior", F.lit(overall))
    top = shrunk(top, "suffix_rate")[0].select("suffix", "suffix_rate")
    middle = hosts.groupBy("suffix", "domain").agg(*sums).join(top, "suffix").withColumnRenamed("suffix_rate", "prior")
    middle = shrunk(middle, "domain_rate")[0].select("suffix", "domain", "domain_rate")
    low = hosts.join(middle, ["suffix", "domain"]).withColumnRenamed("domain_rate", "prior")
    low, plus, size = shrunk(low, "bad_rate")
    deviation = F.sqrt(F.col("bad_rate") * (1 - F.col("bad_rate")) / (size + 1))
    return low.withColumn("bound", F.col("bad_rate") - limits.z * deviation).select(
        "host", "n", "bad", "bad_rate", "bound", (F.col("bound") > limits.max_bad_rate).alias("blocked")
    )


def judge_urls(
    pages: DataFrame, labels: DataFrame, rules: dict[str, str] = RULES, limits: Reputation = Reputation(),
    id_column: str = "page_id", url_column: str = "url",
) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, bad_rate, bound.

    ``labels`` (doc_id, quality, toxic) gives the outcome of the page with that id: bad if its
    quality is 0 or it is toxic.
    """
    parsed = pick(pages, page_id=id_column, url=url_column)
    parsed = parsed.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    bad = F.coalesce((F.col("quality") == 0) | (F.col("toxic") == 1), F.col("quality") == 0, F.col("toxic") == 1)
    marks = pick(labels, label_id="doc_id", quality="quality", toxic="toxic")
    marks = marks.groupBy("label_id").agg(F.max(bad.cast("int")).alias("bad")).where("label_id is not null")
    outcomes = parsed.join(marks, parsed["page_id"] == marks["label_id"], "left").select("host", "bad")
    judged = host_reputation(outcomes, limits).select("host", "bad_rate", "bound", "blocked")
    rule = rule_of(F.col("host"), F.col("path"), rules)
    by_rule = F.lit(None).cast("string")
    for text, verdict in rules.items():
        by_rule = F.when(F.col("rule") == text, F.lit(verdict)).otherwise(by_rule)
    return parsed.withColumn("rule", rule).join(judged, "host").select(
        "page_id", "host", "path", "rule",
        F.coalesce(by_rule, F.when(F.col("blocked"), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
        "bad_rate", "bound",
    )
