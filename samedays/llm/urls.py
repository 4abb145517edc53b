"""URL rules and empirical-Bayes host reputation.

Labelled pages vote on their host. A host's rate of good pages is shrunk to that of its registered domain, this to
that of its suffix, this to the rate of all pages: at each level a beta prior is centred at the parent's posterior
mean, and its strength (pseudo-counts) is fitted over all labelled groups of the level by the method of moments.
A page is blocked if the upper posterior bound of its host's rate is below `min_good`; explicit rules go before.
A host without labels has the prior of its nearest labelled level as its posterior: the rate of its registered domain,
else of its suffix, else of all pages, with the strength fitted for the groups below that level.

The suffix of a host is its last label, or its last two where a table lists them (`SUFFIXES`, a parameter); the
registered domain is one label more.

Everything is a DataFrame expression. Labelled outcomes are counted map-side before any shuffle; the reputations
are joined back by host, and a hot host is one row on that side, which Spark splits or broadcasts by size.

Defined results: a null url or one without `://` has an empty host and path and the reputation of unlabelled hosts.
Null, repeated or conflicting labels: null outcomes do not count, repeated rows count each. Without any label
every page that no rule fits is allowed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from samedays.llm.common import Scratch, lower_ascii

#: (verdict, host, path), as given. A rule's text is host + path.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
#: Suffixes of two labels under which names are registered: a short list of common ones; pass a fuller one if it matters.
SUFFIXES = (
    "co.uk", "org.uk", "ac.uk", "gov.uk", "me.uk", "com.au", "net.au", "org.au", "edu.au", "co.nz", "org.nz", "co.jp", "ne.jp", "or.jp",
    "ac.jp", "com.br", "org.br", "com.cn", "org.cn", "com.hk", "com.tw", "com.sg", "com.my", "co.in", "org.in", "co.kr", "or.kr",
    "co.za", "org.za", "com.mx", "com.ar", "com.co", "com.pe", "com.tr", "com.ua", "co.il", "com.eg", "com.sa", "co.id", "co.th",
)
#: Bounds for the fitted strength of a prior, in pseudo-counts.
STRENGTH = (1.0, 1000.0)


def split_url(pages: DataFrame, url: str = "url") -> DataFrame:
    """The pages with `host` (A-Z lower-cased) and `path`; both are empty for null or without `://`."""
    # the flags let a dot or class run over line ends as well; only the first :// counts
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    source = F.coalesce(F.col(url), F.lit(""))
    return pages.withColumns({"host": lower_ascii(F.regexp_extract(source, pattern, 1)), "path": F.regexp_extract(source, pattern, 2)})


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """The longest rule that fits (ties: the first), as struct(verdict, rule); null if none does.

    A rule fits its host and all subdomains if the path starts with its own. The list is part of the plan, so keep
    it to some hundred rules.
    """
    best = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: -len(r[1] + r[2]), reverse=True):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        best = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(rule_host + rule_path).alias("rule"))).otherwise(best)
    return best


def suffix_of(host: Column, suffixes: Sequence[str] = SUFFIXES) -> Column:
    """The last two labels of a host if they are listed, else the last one."""
    last_two = F.substring_index(host, ".", -2)
    return F.when(last_two.isin(list(suffixes)), last_two).otherwise(F.substring_index(host, ".", -1))


def registered_domain(host: Column, suffixes: Sequence[str] = SUFFIXES) -> Column:
    """The suffix of a host and the label before it; the whole host if it has no more."""
    last_two = F.substring_index(host, ".", -2)
    return F.when(last_two.isin(list(suffixes)), F.substring_index(host, ".", -3)).otherwise(last_two)


def _shrunk(groups: DataFrame, level: str) -> DataFrame:
    """Groups (n, good, parent_rate) with `rate`, the posterior mean, and `strength`, that of the level's prior.

    Moments: the squared distance of a group's rate from its parent's is p(1-p)/n plus the spread between groups,
    p(1-p)/(strength+1); both are summed over all groups, weighted by n.
    """
    base = F.col("parent_rate") * (1 - F.col("parent_rate"))
    moments = groups.agg(
        F.sum(F.col("n") * F.pow(F.col("good") / F.col("n") - F.col("parent_rate"), 2) - base).alias("excess"),
        F.sum((F.col("n") - 1) * base).alias("scale"),
    )
    share = F.least(F.greatest(F.try_divide("excess", "scale"), F.lit(1 / STRENGTH[1])), F.lit(1 / STRENGTH[0]))
    strength = moments.select(F.coalesce(1 / share, F.lit(STRENGTH[1])).alias("strength"))
    # one row of one number
    shrunk = groups.join(F.broadcast(strength))
    rate = (F.col("strength") * F.col("parent_rate") + F.col("good")) / (F.col("strength") + F.col("n"))
    return shrunk.withColumn("rate", rate).withColumnRenamed("strength", f"{level}_strength")


def host_reputation(outcomes: DataFrame, suffixes: Sequence[str] = SUFFIXES) -> dict[str, DataFrame]:
    """Shrunk rates by level from rows (host, good): good is 1 or 0, or null if not known.

    Keys: `all` (one row: rate), `suffix`, `domain`, `host` (name, rate, n, good, strength columns). Each level is
    written once: a row per name, read again by the level below and by whoever joins it.
    """
    scratch = Scratch(outcomes.sparkSession, "reputation")
    counted = scratch.keep(
        outcomes.filter(F.col("good").isNotNull() & (F.col("host") != ""))
        .groupBy("host")
        .agg(F.count("*").cast("double").alias("n"), F.sum("good").cast("double").alias("good"))
        .withColumns({"domain": registered_domain(F.col("host"), suffixes), "suffix": suffix_of(F.col("host"), suffixes)})
    )
    sums = (F.sum("n").alias("n"), F.sum("good").alias("good"))
    # a uniform prior keeps the rate inside (0, 1) whatever the labels are
    prior = (F.coalesce(F.sum("good"), F.lit(0.0)) + 1) / (F.coalesce(F.sum("n"), F.lit(0.0)) + 2)
    everything = scratch.keep(counted.agg(prior.alias("parent_rate")))
    by_suffix = scratch.keep(_shrunk(counted.groupBy("suffix").agg(*sums).join(F.broadcast(everything)), "suffix"))
    domains = counted.groupBy("suffix", "domain").agg(*sums)
    domains = scratch.keep(_shrunk(domains.join(by_suffix.select("suffix", F.col("rate").alias("parent_rate")), "suffix"), "domain"))
    hosts = counted.select("host", "domain", "n", "good").join(domains.select("domain", F.col("rate").alias("parent_rate")), "domain")
    return {
        "all": everything.withColumnRenamed("parent_rate", "rate"),
        "suffix": by_suffix,
        "domain": domains,
        "host": scratch.keep(_shrunk(hosts, "host")),
    }


def judge_urls(
    pages: DataFrame,
    outcomes: DataFrame,
    url: str = "url",
    rules: Sequence[tuple[str, str, str]] = RULES,
    min_good: float = 0.5,
    z: float = 1.645,
    suffixes: Sequence[str] = SUFFIXES,
) -> DataFrame:
    """The pages with host, path, rule, verdict, and the reputation behind it (`good_rate`, `good_bound`).

    `outcomes` has rows (host, good). `good_bound` is the upper posterior bound: mean + z standard deviations of
    the host's beta posterior.
    """
    levels = host_reputation(outcomes, suffixes)

    def strength(level: str) -> DataFrame:
        """One row: the strength fitted for the groups of a level, the greatest without any."""
        return levels[level].agg(F.coalesce(F.max(f"{level}_strength"), F.lit(STRENGTH[1])).alias(f"_{level}_strength"))

    def bound(mean: Column, total: Column) -> Column:
        return F.least(mean + z * F.sqrt(mean * (1 - mean) / (total + 1)), F.lit(1.0))

    hosts = levels["host"].select(F.col("host").alias("_host"), F.col("rate").alias("_host_rate"), F.col("n").alias("_n"))
    domains = levels["domain"].select(F.col("domain").alias("_domain"), F.col("rate").alias("_domain_rate"))
    by_suffix = levels["suffix"].select(F.col("suffix").alias("_suffix"), F.col("rate").alias("_suffix_rate"))
    judged = split_url(pages, url)
    rated = (
        judged.join(hosts, judged.host == hosts._host, "left")
        .join(domains, registered_domain(judged.host, suffixes) == domains._domain, "left")
        .join(by_suffix, suffix_of(judged.host, suffixes) == by_suffix._suffix, "left")
        .join(F.broadcast(levels["all"].select(F.col("rate").alias("_rate"))))
    )
    for level in ("suffix", "domain", "host"):
        rated = rated.join(F.broadcast(strength(level)))
    total = (
        F.when(F.col("_host").isNotNull(), F.col("_host_strength") + F.col("_n"))
        .when(F.col("_domain").isNotNull(), F.col("_host_strength"))
        .when(F.col("_suffix").isNotNull(), F.col("_domain_strength"))
        .otherwise(F.col("_suffix_strength"))
    )
    shrunk = rated.withColumns(
        {
            "good_rate": F.coalesce("_host_rate", "_domain_rate", "_suffix_rate", "_rate"),
            "_total": total,
            "_ruled": rule_for(F.col("host"), F.col("path"), rules),
        }
    ).withColumn("good_bound", bound(F.col("good_rate"), F.col("_total")))
    method = F.when(F.col("good_bound") < min_good, F.lit("block")).otherwise(F.lit("allow"))
    return shrunk.withColumns({"rule": F.col("_ruled.rule"), "verdict": F.coalesce(F.col("_ruled.verdict"), method)}).drop(
        "_ruled", "_host", "_host_rate", "_n", "_domain", "_domain_rate", "_suffix", "_suffix_rate", "_rate", "_total",
        *(f"_{level}_strength" for level in ("suffix", "domain", "host")),
    )
