"""URL filtering by rules and by an empirical-Bayes reputation of hosts. DataFrame functions only.

Labelled page outcomes are counted per host, registered domain and suffix. Each level's share of bad pages is
shrunk towards its parent's: a child's prior is a beta distribution around the parent's mean whose strength is
estimated from how much the children differ beyond chance (beta-binomial moments). A host is blocked if the lower
bound of its posterior share of bad pages is above a threshold, so hosts with few labels follow their domain and
nobody is blocked on a single page.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

#: Suffixes under which domains are registered one label deeper than usual (fixed values).
LONG_SUFFIXES = ("ac.uk", "co.in", "co.jp", "co.kr", "co.nz", "co.uk", "co.za", "com.au", "com.br", "com.cn", "com.mx",
                 "com.tr", "gov.uk", "net.au", "ne.jp", "or.jp", "org.au", "org.uk")
#: Bounds of the correlation of outcomes within a level, and its value where the labels cannot tell.
LEAST_RHO, MOST_RHO, UNKNOWN_RHO = 0.001, 0.999, 0.1
#: What is taken for known of all pages before any label: one bad page of ten.
ROOT_BAD, ROOT_PAGES = 1, 10

_URL = r"^(?s:.*?)://([^/?#]*)([^?#]*)"


def parsed(pages: DataFrame) -> DataFrame:
    """(page_id, host, path): the host lower-cased in A-Z with any user and port, the path up to the query.

    Without ``://``, and for null, both are empty.
    """
    host = F.translate(F.regexp_extract("url", _URL, 1), string.ascii_uppercase, string.ascii_lowercase)
    return pages.select("page_id", F.coalesce(host, F.lit("")).alias("host"),
                        F.coalesce(F.regexp_extract("url", _URL, 2), F.lit("")).alias("path"))


def _site(host: Column) -> Column:
    """The host without user, port and closing dot."""
    return F.regexp_replace(host, r"^.*@|\.?(:[0-9]*)?$", "")


def _with_levels(hosts: DataFrame) -> DataFrame:
    """``hosts`` with the registered domain and suffix; an address of numbers is its own domain under ``ip``."""
    site = _site(F.col("host"))
    numbers = site.rlike(r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$") | site.contains("[")
    two = F.substring_index(site, ".", -2)
    long = two.isin(*LONG_SUFFIXES)
    return hosts.withColumns({
        "suffix": F.when(numbers, "ip").when(long, two).otherwise(F.substring_index(site, ".", -1)),
        "domain": F.when(numbers, site).when(long, F.substring_index(site, ".", -3)).otherwise(two)})


def _strength(children: DataFrame) -> float:
    """Prior strength of a level from (n, bad, parent mean): 1 / rho - 1, one number."""
    n, m = F.col("n").cast("double"), F.col("parent")
    extra = F.sum(F.pow(F.col("bad") - n * m, 2.0) - n * m * (1 - m))
    pairs = F.sum(n * (n - 1) * m * (1 - m))
    rho = children.where("n > 0").agg(F.when(pairs > 0, extra / pairs).otherwise(F.lit(UNKNOWN_RHO))).first()[0]
    return 1 / min(max(rho, LEAST_RHO), MOST_RHO) - 1


def _shrunk(children: DataFrame) -> DataFrame:
    """``children`` with alpha and beta of their posterior and its mean."""
    strength = _strength(children)
    return (children.withColumn("alpha", F.col("bad") + strength * F.col("parent"))
            .withColumn("beta", F.col("n") - F.col("bad") + strength * (1 - F.col("parent")))
            .withColumn("mean", F.col("alpha") / (F.col("alpha") + F.col("beta"))))


def host_outcomes(urls: DataFrame, outcomes: DataFrame) -> DataFrame:
    """(host, n, bad) of every host: labelled pages and bad ones among them.

    ``outcomes`` has (page_id, bad) with bad true or false; rows with a null are no label, several labels of a
    page count each. Partial counts are made before any shuffle by host, so that a hot host is a few rows.
    """
    o = (outcomes.where("page_id IS NOT NULL AND bad IS NOT NULL").groupBy("page_id")
         .agg(F.count("*").alias("n"), F.sum(F.col("bad").cast("long")).alias("bad")))
    return urls.select("page_id", "host").join(o, "page_id", "left").groupBy("host").agg(
        F.sum(F.coalesce("n", F.lit(0))).alias("n"), F.sum(F.coalesce("bad", F.lit(0))).alias("bad"))


def reputations(hosts: DataFrame, z: float = 1.645) -> DataFrame:
    """(host, n, bad, domain, suffix, bad_mean, bad_bound) of ``host_outcomes``.

    ``bad_bound`` is the posterior mean less ``z`` posterior standard deviations, 0 at least. Without any label
    all means are that of the root's prior. The three strengths are single numbers; nothing else reaches the driver.
    """
    hosts = _with_levels(hosts)
    sums = [F.sum("n").alias("n"), F.sum("bad").alias("bad")]
    domains = hosts.groupBy("domain", "suffix").agg(*sums)
    suffixes = domains.groupBy("suffix").agg(*sums)
    n, bad = suffixes.agg(*sums).first()
    suffixes = _shrunk(suffixes.withColumn("parent", F.lit(((bad or 0) + ROOT_BAD) / ((n or 0) + ROOT_PAGES))))
    parents = suffixes.select("suffix", F.col("mean").alias("parent"))
    domains = _shrunk(domains.join(parents, "suffix"))
    parents = domains.select("domain", "suffix", F.col("mean").alias("parent"))
    out = _shrunk(hosts.join(parents, ["domain", "suffix"]))
    a, b = F.col("alpha"), F.col("beta")
    spread = F.sqrt(a * b / (F.pow(a + b, 2.0) * (a + b + 1)))
    return out.select("host", "n", "bad", "domain", "suffix", F.col("mean").alias("bad_mean"),
                      F.greatest(F.col("mean") - z * spread, F.lit(0.0)).alias("bad_bound"))


def _rules_of(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, rules): the rules (length, host length, path, rule, verdict) whose host is the host or a parent of it."""
    rules = rules.where("host IS NOT NULL AND path IS NOT NULL AND verdict IS NOT NULL").select(
        F.col("host").alias("_above"), F.struct(
            (F.length("host") + F.length("path")).alias("length"), F.length("host").alias("host_length"),
            F.col("verdict"), F.col("path"), F.concat("host", "path").alias("rule")).alias("_rule"))
    deepest = rules.agg(F.max(F.size(F.split("_above", r"\.")))).first()[0] or 1
    above = F.array_distinct(F.transform(F.sequence(F.lit(1), F.lit(deepest)),
                                         lambda k: F.call_function("substring_index", F.col("host"), F.lit("."), -k)))
    return (hosts.select("host", F.explode(above).alias("_above")).join(rules, "_above")
            .groupBy("host").agg(F.sort_array(F.collect_list("_rule"), asc=False).alias("rules")))


def judge(pages: DataFrame, rules: DataFrame, outcomes: DataFrame, threshold: float = 0.5, z: float = 1.645) -> DataFrame:
    """Every page with (host, path, rule, verdict, host_labelled, host_bad, bad_bound).

    ``rules`` has (verdict, host, path): a rule fits its host and its subdomains where the page's path starts with
    the rule's path (an empty path starts with no ``/``); the longest host and path together wins, then the longer
    host, then ``block``. Pages without a rule are blocked if their host's ``bad_bound`` is above ``threshold``.

    A null or malformed url has the empty host, which is a host like any other. Repeated rows are judged each; an
    empty table gives an empty result; columns besides page_id and url are not read. Pages meet their host's row in
    one join, whose hot hosts Spark splits at run time; the host table is never broadcast unless Spark knows it small.
    """
    urls = parsed(pages)
    hosts = written(host_outcomes(urls, outcomes), "hosts")
    known = (reputations(hosts, z).join(_rules_of(hosts, rules), "host", "left")
             .select("host", F.col("n").alias("host_labelled"), F.col("bad").alias("host_bad"), "bad_bound", "rules"))
    fits = F.filter("rules", lambda r: F.startswith(F.col("path"), r["path"]))
    best = F.get(fits, F.lit(0))
    return (urls.join(known, "host").withColumn("_best", best)
            .select("page_id", "host", "path", F.col("_best.rule").alias("rule"),
                    F.coalesce("_best.verdict", F.when(F.col("bad_bound") > threshold, "block").otherwise("allow")).alias("verdict"),
                    "host_labelled", "host_bad", "bad_bound"))
