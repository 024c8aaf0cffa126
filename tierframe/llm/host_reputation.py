"""URL filter: list rules first, else the reputation of the host.

The share of good pages of a host is learnt from labelled pages.  A host with
few of them borrows from its registered domain, that from its suffix, and that
from all pages: each level is a beta prior of the next one.  How much is
borrowed is estimated from how far the shares spread inside the parents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierframe.sources.staging import materialize

# The rules, as (verdict, host + path)
RULES = (
    ("block", "net/"),
    ("allow", "example.net/en/"),
    ("block", "example.com/de/"),
    ("allow", "org/fr/"),
)
# a page is blocked if its host is good with less than LEAST_GOOD, even at the
# upper end of what the posterior allows (Z standard deviations)
LEAST_GOOD = 0.5
Z = 1.645
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# correlation of two pages of a group is kept inside these limits, so that a
# prior counts for 3 to 999 pages and one bad page condemns no host
CORRELATION = (0.001, 0.25)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host, A-Z in lower case, and path; both empty for null and without ``://``."""
    known = F.coalesce(F.instr(url, "://") > 0, F.lit(False))
    rest = F.substr(url, F.instr(url, "://") + 3)
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    lower = F.translate(host, UPPER, UPPER.lower())
    return F.when(known, lower).otherwise(""), F.when(known, path).otherwise("")


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null where none does.

    A rule fits its host and all subdomains if the path starts with the rule's.
    """

    def chosen(which: int) -> Column:
        out = F.lit(None).cast("string")
        # the longest ends up outermost; equal lengths keep their order
        for rule in sorted(reversed(rules), key=lambda r: len(r[1])):
            own, slash, tail = rule[1].partition("/")
            fits = (host == own) | host.endswith(f".{own}")
            out = F.when(fits & path.startswith(slash + tail), F.lit(rule[which])).otherwise(out)
        return out

    return chosen(1), chosen(0)


def suffix_of(host: Column) -> Column:
    return F.substring_index(host, ".", -1)


def domain_of(host: Column) -> Column:
    """Registered domain, taking the last label as the suffix."""
    return F.substring_index(host, ".", -2)


def reputations(hosts: DataFrame, outcomes: DataFrame, z: float = Z) -> DataFrame:
    """Posterior of the share of good pages, for every host of ``hosts``.

    ``hosts`` has host, one row each; ``outcomes`` has host and good (boolean,
    null rows are left out).  Returns host, n_labelled, mean and upper, the
    posterior mean and mean + z standard deviations.  Counts are summed before
    they are shuffled; all later steps work on one row per host.
    """
    labelled = outcomes.filter("good IS NOT NULL").groupBy("host").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("good").cast("long")).alias("g")
    )
    # every level is staged: it is read for its own shares and for the next level
    counts = hosts.join(labelled, "host", "left").select(
        "host",
        domain_of(F.col("host")).alias("domain"),
        suffix_of(F.col("host")).alias("suffix"),
        F.coalesce("n", F.lit(0)).alias("n"),
        F.coalesce("g", F.lit(0)).alias("g"),
    )
    counts = materialize(counts, "hosts")
    domains = counts.groupBy("suffix", "domain").agg(F.sum("n").alias("n"), F.sum("g").alias("g"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("g").alias("g"))
    # rule of succession, so that an unlabelled table gives one half
    good, seen = F.coalesce(F.sum("g"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))
    whole = suffixes.agg((good + 1.0) / (seen + 2.0)).scalar()

    def shrunk(joined: DataFrame, kept: list[str]) -> DataFrame:
        """Adds a and b, the posterior; ``parent`` is the mean of the prior."""
        p, n, g = F.col("parent"), F.col("n"), F.col("g")
        spread = joined.filter("n > 0").agg(
            F.sum(n * (g / n - p) * (g / n - p)).alias("between"),
            F.sum(p * (1 - p)).alias("alone"),
            F.sum((n - 1) * p * (1 - p)).alias("pairs"),
        )
        share = F.coalesce(F.try_divide(F.col("between") - F.col("alone"), F.col("pairs")), F.lit(0.0))
        rho = F.least(F.greatest(share, F.lit(CORRELATION[0])), F.lit(CORRELATION[1]))
        k = spread.select(1 / rho - 1).scalar()
        return joined.select(*kept, (g + k * p).alias("a"), (n - g + k * (1 - p)).alias("b"))

    def as_prior(level: DataFrame, *on: str) -> DataFrame:
        mean = F.col("a") / (F.col("a") + F.col("b"))
        return materialize(level.select(*on, mean.alias("parent")), "level")

    top = as_prior(shrunk(suffixes.withColumn("parent", whole), ["suffix"]), "suffix")
    below_top = domains.join(top, "suffix")
    middle = as_prior(shrunk(below_top, ["suffix", "domain"]), "suffix", "domain")
    below_middle = counts.join(middle, ["suffix", "domain"])
    a, b = F.col("a"), F.col("b")
    mean = a / (a + b)
    deviation = F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))
    return shrunk(below_middle, ["host", "n"]).select(
        "host", F.col("n").alias("n_labelled"), mean.alias("mean"), (mean + z * deviation).alias("upper")
    )


def judge(
    pages: DataFrame,
    outcomes: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    rules=RULES,
    least_good: float = LEAST_GOOD,
) -> DataFrame:
    """Verdict on every url.

    ``outcomes`` has url and good (boolean) of labelled pages.  Returns one row
    per row of ``pages``: page_id, host, path, rule (null if none fits), verdict
    (allow or block) and n_labelled (outcomes of the host).  A rule decides
    where one fits; else a page is blocked if the upper bound of its host's good
    share is below ``least_good``.  Urls that are null or without ``://`` share
    the host '', and hosts without outcomes have their domain's reputation.
    """
    host, path = host_and_path(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    labelled = outcomes.select(host_and_path(F.col("url"))[0].alias("host"), "good")
    known = reputations(rows.select("host").distinct(), labelled)
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("upper") < least_good, F.lit("block")).otherwise("allow")
    return rows.join(known, "host").select(
        "page_id",
        "host",
        "path",
        rule.alias("rule"),
        F.coalesce(verdict, own).alias("verdict"),
        "n_labelled",
    )
