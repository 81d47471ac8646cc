"""URL filter: prefix rules first, then empirical-Bayes reputation of the host.

Labelled pages give each host good outcomes out of all outcomes. Rates are shrunk from the suffix
(last label of the host) to the registered domain (last two labels) to the host: each level's posterior
is the prior mean of the level below it, with a strength estimated by moments over the corpus. A page
passes when the lower bound (mean - Z standard deviations) of its host's posterior reaches the threshold.
Everything is counted over all pages; hosts without labels inherit their domain's or suffix's bound.

Cases: a url that is null or has no ``://`` has an empty host and path and is judged as a host of its own;
pages without a label only inherit; repeated label rows each count; a null page_id has no label; repeated pages are judged
each; the registered domain is the host's last two labels (no list of public suffixes is assumed, so that all of ``co.uk``
shares one prior); empty tables give an empty result; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import join_by_key
from tributary.session import materialise

#: (rule, verdict); a rule is host/path and covers the host's subdomains and longer paths.
RULES = (
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
)
Z = 1.64
#: A host passes when the bound of its share of good pages is at least this.
THRESHOLD = 0.5
#: Prior of the whole corpus before any label: one good page in two.
PRIOR_GOOD, PRIOR_ALL = 1.0, 2.0
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path."""
    at = F.instr(url, "://")
    rest = F.substring(url, at + 3, F.length(url))
    has = F.coalesce(at > 0, F.lit(False))
    host = F.when(has, F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), UPPER, LOWER)).otherwise("")
    path = F.when(has, F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)).otherwise("")
    return host, path


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, or null."""
    out = F.lit(None).cast("string")
    for rule, _ in sorted(rules, key=lambda r: len(r[0])):  # later ones are longer and win
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit(slash + rest))
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


def reputation(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """Per host: pages, labelled ones, good ones, posterior mean and lower bound.

    pages: page_id, host. labels: page_id, good (0 or 1).
    """
    hosts = (
        pages.join(labels, "page_id", "left")
        .groupBy("host")
        .agg(F.count("good").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("k"), F.count(F.lit(1)).alias("pages"))
        .withColumn("suffix", F.substring_index("host", ".", -1))
        .withColumn("domain", F.substring_index("host", ".", -2))
    )
    hosts = materialise(hosts, "hosts")  # counted once; all levels read these rows

    def with_strength(level: DataFrame, mean: str) -> DataFrame:
        """Adds the prior's strength (a + b) by moments: how far rates spread beyond the binomial, over entries with two labels or more."""
        p, rate, n = F.col(mean), F.col("k") / F.col("n"), F.col("n")
        several = n > 1
        spread = F.sum(F.when(several, n * (rate - p) * (rate - p))) / F.sum(F.when(several, p * (1 - p)))
        # E[n (rate - p)^2] = p (1 - p) (1 + (n - 1) rho), with rho = 1 / (strength + 1)
        rho = (spread - 1) * F.count(F.when(several, 1)) / F.sum(F.when(several, n - 1))
        one_row = level.agg(F.coalesce(1 / F.least(F.greatest(rho, F.lit(0.001)), F.lit(0.5)) - 1, F.lit(10.0)).alias("strength"))
        return level.join(F.broadcast(one_row), F.lit(True))

    total = hosts.agg(((F.sum("k") + PRIOR_GOOD) / (F.sum("n") + PRIOR_ALL)).alias("p0"))
    summed = lambda df, *keys: df.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("k").alias("k"), F.count(F.lit(1)).alias("below"))
    by_domain = materialise(summed(hosts, "suffix", "domain"), "domains")
    by_suffix = summed(by_domain, "suffix").join(F.broadcast(total), F.lit(True))
    suffixes = with_strength(by_suffix, "p0").select(
        "suffix", "below", ((F.col("k") + F.col("p0") * F.col("strength")) / (F.col("n") + F.col("strength"))).alias("p1")
    )
    # a suffix that a third of all domains has, or a domain of very many hosts, is broadcast: its rows stay where they are
    under = join_by_key(by_domain.withColumnRenamed("below", "hosts"), materialise(suffixes, "suffixes"), ["suffix"], "below")
    domains = with_strength(under, "p1").select(
        "domain", "hosts", ((F.col("k") + F.col("p1") * F.col("strength")) / (F.col("n") + F.col("strength"))).alias("p2")
    )
    last = with_strength(join_by_key(hosts, materialise(domains, "domain-means"), ["domain"], "hosts"), "p2")
    a = F.col("k") + F.col("p2") * F.col("strength")
    n = F.col("n") + F.col("strength")
    mean = a / n
    return last.select(
        "host", "pages", "n", "k", mean.alias("mean"), (mean - Z * F.sqrt(mean * (1 - mean) / (n + 1))).alias("bound")
    )


def judge(pages: DataFrame, labels: DataFrame, rules=RULES, threshold: float = THRESHOLD) -> DataFrame:
    """pages: page_id, url; labels: page_id, good. Returns page_id, host, path, rule, verdict, bound."""
    host, path = split_url(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    bounds = reputation(rows.select("page_id", "host"), labels.select("page_id", "good")).select("host", "bound", "pages")
    verdict = F.lit(None).cast("string")
    for rule, what in rules:
        verdict = F.when(F.col("rule") == rule, F.lit(what)).otherwise(verdict)
    method = F.when(F.col("bound") >= threshold, "allow").otherwise("block")
    return (
        join_by_key(rows, materialise(bounds, "bounds"), ["host"], "pages")
        .withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
        .select("page_id", "host", "path", "rule", F.coalesce(verdict, method).alias("verdict"), "bound")
    )
