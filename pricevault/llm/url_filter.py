"""URL filters: explicit rules first, then empirical-Bayes host reputation. Built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Two-label public suffixes; other suffixes are the last label.
LONG_SUFFIXES = ("ac.uk", "co.jp", "co.nz", "co.uk", "com.au", "com.br", "org.uk")
#: A host is blocked if its bad share lies above this with the margin below.
MOST_BAD = 0.5
#: Posterior deviations between mean and bound (one-sided 95 percent).
MARGIN = 1.645
#: Limits of a prior's weight in pages.
PRIOR_LIMITS = (1.0, 1000.0)
#: Copies of a blocked host in the join to pages, so that a hot host's pages spread.
SALTS = 32


def url_host(url: Column) -> Column:
    """What lies between the first ``://`` and ``/``, ``?``, ``#`` or the end; A-Z in lower case."""
    rest = F.when(F.locate("://", url) > 0, url.substr(F.locate("://", url) + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    rest = F.when(F.locate("://", url) > 0, url.substr(F.locate("://", url) + 3, F.length(url))).otherwise("")
    return F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def suffix_of(host: Column) -> Column:
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*LONG_SUFFIXES), two).otherwise(F.substring_index(host, ".", -1))


def domain_of(host: Column) -> Column:
    """Registered domain: the suffix and one label more."""
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*LONG_SUFFIXES), F.substring_index(host, ".", -3)).otherwise(two)


def matching_rule(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest rule ``host/path`` that covers the host or a parent of it and starts the path; else null."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), r)):
        owner, slash, start = rule.partition("/")
        fits = ((host == owner) | host.endswith(f".{owner}")) & path.startswith(slash + start)
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def _shrunk(table: DataFrame, name: str, prior: str) -> DataFrame:
    """Add ``<name>_weight`` and ``<name>_mean``: the shares ``bad / n`` shrunk to the prior column.

    The weight k of the beta prior is found by moments over the whole level: the spread of the
    shares around their priors, less what binomial noise explains. It is one row, so broadcast.
    """
    share = F.when(F.col("n") > 0, F.col("bad") / F.col("n")).otherwise(F.col(prior))
    noise = F.sum(F.col("n") * F.col(prior) * (1 - F.col(prior)))
    moments = table.agg(
        F.sum("n").alias("pages"),
        noise.alias("noise"),
        F.sum(F.when(F.col("n") > 0, F.col(prior) * (1 - F.col(prior)))).alias("within"),
        F.sum(F.col("n") * (share - F.col(prior)) * (share - F.col(prior))).alias("spread"),
    )
    extra = F.col("spread") - F.col("within")
    weight = F.when(extra > 0, F.col("noise") / extra - 1).otherwise(PRIOR_LIMITS[1])
    weight = F.coalesce(F.greatest(F.lit(PRIOR_LIMITS[0]), F.least(F.lit(PRIOR_LIMITS[1]), weight)), F.lit(PRIOR_LIMITS[1]))
    one = moments.select(weight.alias(f"{name}_weight"), F.lit(1).alias("__one"))
    mean = (F.col("bad") + F.col(f"{name}_weight") * F.col(prior)) / (F.col("n") + F.col(f"{name}_weight"))
    return table.withColumn("__one", F.lit(1)).join(F.broadcast(one), "__one").drop("__one").withColumn(f"{name}_mean", mean)


def host_reputation(outcomes: DataFrame, most_bad: float = MOST_BAD, margin: float = MARGIN) -> DataFrame:
    """Posterior share of bad pages of each host, from ``host`` and ``bad`` (boolean; null: unlabelled).

    Counts are summed from hosts to registered domains to suffixes, so pages are shuffled once,
    after partial sums. Suffix shares shrink to the overall share, domain shares to their
    suffix, host shares to their domain. ``blocked`` is true if the posterior mean less ``margin``
    posterior deviations is above ``most_bad``; a host without labels is judged by its prior. With
    no labelled page at all, the overall share is 0 and nothing is blocked. Null hosts are dropped.
    """
    counts = outcomes.where("host IS NOT NULL").groupBy("host").agg(
        F.count("bad").alias("n"), F.coalesce(F.sum(F.col("bad").cast("long")), F.lit(0)).alias("bad")
    )
    hosts = counts.withColumn("domain", domain_of(F.col("host")))
    domains = hosts.groupBy("domain").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"), F.first("host").alias("__any"))
    domains = domains.withColumn("suffix", suffix_of(F.col("domain"))).drop("__any")
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    overall = suffixes.agg(F.coalesce(F.sum("bad") / F.nullif(F.sum("n"), F.lit(0)), F.lit(0.0)).alias("overall"), F.lit(1).alias("__one"))
    suffixes = suffixes.withColumn("__one", F.lit(1)).join(F.broadcast(overall), "__one").drop("__one")
    suffixes = _shrunk(suffixes, "suffix", "overall").select("suffix", "suffix_mean")
    domains = _shrunk(domains.join(suffixes, "suffix"), "domain", "suffix_mean").select("domain", "domain_mean")
    hosts = _shrunk(hosts.join(domains, "domain"), "host", "domain_mean")
    total = F.col("n") + F.col("host_weight")
    deviation = F.sqrt(F.col("host_mean") * (1 - F.col("host_mean")) / (total + 1))
    hosts = hosts.withColumn("bound", F.col("host_mean") - margin * deviation)
    return hosts.select("host", "n", "bad", "domain_mean", "host_mean", "bound", (F.col("bound") > most_bad).alias("blocked"))


def judge_urls(pages: DataFrame, outcomes: DataFrame, rules: dict[str, str], url_col: str = "url", id_col: str = "page_id") -> DataFrame:
    """Pages with ``host``, ``path``, ``rule`` and ``verdict`` (allow or block).

    ``rules`` maps ``host/path`` to allow or block; the longest that fits decides, and where
    none does the reputation of the page's host. Only blocked hosts are joined back, each with
    ``SALTS`` copies, so the pages of one host spread over tasks. Pages are kept row by row: null
    or odd urls have an empty host and path and are judged like any other host; repeated rows get
    equal results; ids may be null. Input columns named like a result column are replaced.
    """
    taken = ("host", "path", "rule", "verdict")
    kept = [F.col(f"`{c}`") for c in pages.columns if c.lower() not in taken]
    url = F.col(url_col)
    pages = pages.select(*kept, url_host(url).alias("host"), url_path(url).alias("path"))
    pages = pages.withColumns({c: F.coalesce(c, F.lit("")) for c in ("host", "path")})
    pages = pages.withColumn("rule", matching_rule(F.col("host"), F.col("path"), rules))
    blocked = host_reputation(outcomes).where("blocked").select(F.col("host").alias("__host"))
    blocked = blocked.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    pages = pages.withColumn("__spread", F.pmod(F.xxhash64(id_col, url_col), F.lit(SALTS)).cast("int"))
    found = pages.join(blocked, (pages["host"] == blocked["__host"]) & (pages["__spread"] == blocked["__salt"]), "left")
    verdict = F.when(F.col("__host").isNotNull(), "block").otherwise("allow")
    for rule, says in rules.items():
        verdict = F.when(F.col("rule") == rule, says).otherwise(verdict)
    return found.withColumn("verdict", verdict).drop("__spread", "__host", "__salt")
