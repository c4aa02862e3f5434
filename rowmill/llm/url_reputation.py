"""Host reputation from labelled pages, shrunk from host to registered domain to suffix, and URL rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from rowmill.llm.common import written

#: Public suffixes of two labels that are common on the web. All other suffixes are the last label.
TWO_LABEL_SUFFIXES = (
    "co.uk org.uk ac.uk gov.uk com.au net.au org.au edu.au gov.au co.nz org.nz co.jp ne.jp or.jp ac.jp go.jp "
    "com.br org.br gov.br com.cn net.cn org.cn gov.cn edu.cn com.tw com.hk com.sg co.in net.in org.in gov.in co.kr "
    "or.kr com.mx com.ar com.tr co.za org.za com.ua com.pl"
).split()

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bounds of a prior's weight, in pages: what the moments say is kept between them.
WEAKEST_PRIOR, STRONGEST_PRIOR = 1.0, 1000.0
#: Prior of the suffixes themselves: one good and one bad page around the overall share.
ROOT_PRIOR = 2.0


def host_of(url: Column) -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without one or for null."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def suffix_of(host: Column) -> Column:
    last_two = F.substring_index(host, ".", -2)
    return F.when(last_two.isin(TWO_LABEL_SUFFIXES), last_two).otherwise(F.substring_index(host, ".", -1))


def domain_of(host: Column) -> Column:
    """The registered domain: the suffix and one label before it, or the whole host if there is none."""
    last_two = F.substring_index(host, ".", -2)
    return F.when(last_two.isin(TWO_LABEL_SUFFIXES), F.substring_index(host, ".", -3)).otherwise(last_two)


def ruled(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule (host and path together) and its verdict, or nulls.

    ``rules`` holds ``(verdict, host, path)``, a short list that a person keeps. A rule fits its host and all its
    subdomains if the path starts with the rule's. Of equally long ones the longer host wins, then the earlier rule.
    """
    ranked = sorted(enumerate(rules), key=lambda r: (-len(r[1][1] + r[1][2]), -len(r[1][1]), r[0]))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for _, (what, rule_host, rule_path) in reversed(ranked):
        fits = ((host == rule_host) | F.endswith(host, F.lit("." + rule_host))) & F.startswith(path, F.lit(rule_path))
        rule = F.when(fits, rule_host + rule_path).otherwise(rule)
        verdict = F.when(fits, what).otherwise(verdict)
    return rule, verdict


def posteriors(hosts: DataFrame, z: float) -> DataFrame:
    """``hosts(host, pages, good)``, a row per host with its labelled and its good pages, with ``mean`` and ``bound``.

    Level by level (suffix, registered domain, host) each group's good pages are a beta-binomial draw around its
    parent's posterior mean. How much the groups of a level vary beyond chance is estimated once per level from all of
    them (method of moments), which gives the weight of the prior in pages; the posterior is the beta distribution with
    prior plus counts. The bound is the posterior mean less ``z`` posterior standard deviations.
    """
    hosts = hosts.withColumns({"domain": domain_of(F.col("host")), "suffix": suffix_of(F.col("host"))})
    domains = hosts.groupBy("suffix", "domain").agg(F.sum("pages").alias("pages"), F.sum("good").alias("good"))
    suffixes = domains.groupBy("suffix").agg(F.sum("pages").alias("pages"), F.sum("good").alias("good"))
    overall = suffixes.agg(
        (F.coalesce(F.sum("good"), F.lit(0)) + 1).alias("g"), (F.coalesce(F.sum("pages"), F.lit(0)) + 2).alias("n")
    ).first()
    share = overall["g"] / overall["n"]  # one good and one bad page more, so it is neither 0 nor 1
    suffixes = suffixes.withColumn(
        "mean", (F.col("good") + F.lit(share * ROOT_PRIOR)) / (F.col("pages") + F.lit(ROOT_PRIOR))
    )
    domains = _shrunk(domains, suffixes, "suffix")
    return _shrunk(hosts, domains.select("domain", "pages", "good", "mean"), "domain").withColumn(
        "bound", F.col("mean") - z * F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("pages") + F.col("prior") + 1))
    )


def _shrunk(groups: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """``groups`` with the level's prior weight and their posterior means."""
    joined = groups.join(
        parents.select(F.col(key).alias("of"), F.col("pages").alias("all_pages"), F.col("mean").alias("above")),
        F.col(key) == F.col("of"),
    ).drop("of")
    # observed against expected squares of the groups' deviations from their parents' means
    n, p, m = F.col("pages"), F.try_divide("good", "pages"), F.col("above")
    moments = joined.where("pages > 0").agg(
        F.sum(n * (p - m) * (p - m)).alias("seen"),
        F.sum(m * (1 - m)).alias("chance"),
        F.sum(m * (1 - m) * (n - 1)).alias("spare"),
    ).first()
    excess = (moments["seen"] or 0.0) - (moments["chance"] or 0.0)
    share = excess / moments["spare"] if moments["spare"] else 0.0  # intra-class correlation
    weight = STRONGEST_PRIOR if share <= 0 else min(STRONGEST_PRIOR, max(WEAKEST_PRIOR, 1 / share - 1))
    return joined.withColumns(
        {
            "prior": F.lit(weight),
            "mean": (F.col("good") + weight * F.col("above")) / (F.col("pages") + F.lit(weight)),
        }
    ).drop("all_pages", "above")


def judge_urls(
    pages: DataFrame,
    labels: DataFrame,
    rules: Sequence[tuple[str, str, str]],
    id_column: str = "page_id",
    url_column: str = "url",
    least: float = 0.5,
    z: float = 1.645,
) -> DataFrame:
    """One row per page: ``(id, host, path, rule, verdict, bound)``.

    ``labels(id, good)`` says of some pages whether they are good; several labels of one page count as often as they
    are there, null ids and null labels say nothing. A rule decides where one fits. Elsewhere a page is allowed when
    its host's posterior bound reaches ``least``; a host without labels has its domain's expectation, one of an
    unlabelled domain its suffix's, else the overall one, each with the bound that its prior leaves. Pages without a
    host (null or malformed urls) are a host of their own, the empty one. Repeated pages are judged each; an empty table
    gives no rows; other columns are not looked at.

    Labels and pages are counted per host before anything is joined; the pages meet one row per distinct host.
    """
    url = F.col(f"`{url_column}`")
    parts = pages.select(F.col(f"`{id_column}`").alias("id"), host_of(url).alias("host"), path_of(url).alias("path"))
    counted = labels.where("id is not null and good is not null").groupBy("id").agg(
        F.count("*").alias("n"), F.sum(F.col("good").cast("int")).alias("k")
    )
    per_host = parts.select("id", "host").join(counted, "id", "left").groupBy("host").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("pages"), F.coalesce(F.sum("k"), F.lit(0)).alias("good")
    )
    judged = posteriors(written(per_host, "hosts"), z).select("host", "bound")
    rule, verdict = ruled(F.col("host"), F.col("path"), rules)
    return parts.join(judged, "host").select(
        F.col("id").alias(id_column),
        "host",
        "path",
        rule.alias("rule"),
        F.coalesce(verdict, F.when(F.col("bound") >= least, "allow").otherwise("block")).alias("verdict"),
        F.round("bound", 6).alias("bound"),
    )
