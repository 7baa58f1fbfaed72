"""URL filters: rules, and empirical-Bayes host reputation where no rule fits.

Labelled outcomes of pages (bad or not) are counted per host, registered
domain and suffix. Shares are shrunk down that tree: a suffix towards all
pages, a domain towards its suffix, a host towards its domain, each by a
beta-binomial prior. The prior's mean is the parent's posterior without the
child's own pages; its strength falls with how much the shares of that level
differ beyond chance (method of moments) and with how little is known of the
parent. A host is blocked if even
the lower posterior bound of its share of bad pages is over the limit, so a
host without enough evidence is allowed. Everything is DataFrame expressions.

Edge cases: a null url or one without ``://`` has an empty host and path, and
no rule fits it; pages without an outcome, null outcomes and outcomes of
unknown pages add nothing; several outcomes of a page count once, as the
worst; without any outcome all hosts are allowed; repeated rows are judged
each; ties of equally long rules go to the smaller rule text; extra columns
are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deliverylens.llm.common import staged, table

#: Hosts over this share of bad pages are blocked; standard deviations of the bound.
BAD_SHARE = 0.5
DEVIATIONS = 2.0
#: Bounds of a prior's strength, in pages.
WEAKEST, STRONGEST = 1.0, 10_000.0

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


@dataclass(frozen=True)
class Rule:
    """``text`` is a host, and the start of a path from the first ``/`` on."""

    verdict: str
    text: str

    def fits(self, host: Column, path: Column) -> Column:
        name, slash, rest = self.text.partition("/")
        own = (host == name) | host.endswith(f".{name}")
        return own & path.startswith(slash + rest)


#: The rules of the query, and the suffixes under which its hosts register.
RULES = (Rule("block", "net/"), Rule("allow", "example.net/en/"),
         Rule("block", "example.com/de/"), Rule("allow", "org/fr/"))
SUFFIXES = ("example.com", "example.net", "example.org")


def split_url(pages: DataFrame) -> DataFrame:
    """page_id, url, host (A-Z in lower case) and path."""
    part = [F.coalesce(F.regexp_extract("url", _URL, k), F.lit("")) for k in (1, 2)]
    return pages.select("page_id", "url", F.translate(part[0], _UPPER, _LOWER).alias("host"), part[1].alias("path"))


def longest_rule(rules: tuple[Rule, ...]) -> tuple[Column, Column]:
    """(text, verdict) of the longest rule that fits host and path, else null."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.text), [-ord(c) for c in r.text])):
        fits = r.fits(F.col("host"), F.col("path"))  # the last in this order wins
        text = F.when(fits, F.lit(r.text)).otherwise(text)
        verdict = F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return text, verdict


def tree(suffixes: tuple[str, ...]) -> tuple[Column, Column]:
    """(suffix, registered domain) of ``host``: a listed suffix or else the last
    label, and one label more."""
    host = F.col("host")
    suffix = F.substring_index(host, ".", -1)
    domain = F.substring_index(host, ".", -2)
    for s in sorted(suffixes, key=len):
        own = (host == s) | host.endswith(f".{s}")
        suffix = F.when(own, F.lit(s)).otherwise(suffix)
        domain = F.when(own, F.substring_index(host, ".", -2 - s.count("."))).otherwise(domain)
    return suffix, domain


def _strength(level: DataFrame) -> Column:
    """Strength (scalar) of the differences between children with rows (n, bad,
    mean: the prior's)."""
    var = F.col("mean") * (1 - F.col("mean"))
    off = F.col("n") * F.pow(F.col("bad") / F.col("n") - F.col("mean"), F.lit(2.0))
    s = level.where("n > 0").agg(
        F.sum(off).alias("off"), F.sum(var).alias("chance"), F.sum(F.col("n") * var).alias("weight"))
    # off = chance * (1 - rho) + weight * rho, if rho is the correlation within a child
    rho = (F.col("off") - F.col("chance")) / F.nullif(F.col("weight") - F.col("chance"), F.lit(0.0))
    kappa = F.when(rho > 0, (1 - rho) / rho).otherwise(F.lit(STRONGEST))
    return s.select(F.least(F.greatest(kappa, F.lit(WEAKEST)), F.lit(STRONGEST))).scalar()


def _posterior(child: DataFrame) -> DataFrame:
    """Rows (..., n, bad, num, size), the last two the parent's posterior (bad
    pages, all pages), with the child's posterior in their place."""
    prior = (child.withColumn("size", F.col("size") - F.col("n"))  # without the child's own pages
             .withColumn("mean", (F.col("num") - F.col("bad")) / F.col("size")).drop("num"))
    return (prior.withColumn("k", 1 / (1 / _strength(prior) + 1 / F.col("size")))
            .withColumn("num", F.col("bad") + F.col("k") * F.col("mean"))
            .withColumn("size", F.col("n") + F.col("k")).drop("k", "mean"))


def reputations(hosts: DataFrame, deviations: float = DEVIATIONS) -> DataFrame:
    """host, n, bad, mean and ``low``, the lower posterior bound of the bad share.

    ``hosts``: one row per host (host, domain, suffix, n, bad). The levels
    above are sums of it, so labelled pages are grouped once.
    """
    sums = [F.sum("n").alias("n"), F.sum("bad").alias("bad")]
    domains = hosts.groupBy("suffix", "domain").agg(*sums)
    suffixes = domains.groupBy("suffix").agg(*sums)
    total = suffixes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    # all pages, and one more of their average
    num = total.select(F.col("bad") + F.coalesce(F.col("bad") / F.nullif(F.col("n"), F.lit(0)), F.lit(0.0))).scalar()
    size = total.select(F.col("n") + 1.0).scalar()
    # a level is read by the next one's strength and by its shrinking: written once
    top = staged(_posterior(suffixes.withColumn("num", num).withColumn("size", size)).select("suffix", "num", "size"),
                 "suffixes")
    mid = staged(_posterior(domains.join(top, "suffix")).select("suffix", "domain", "num", "size"), "domains")
    low = _posterior(hosts.join(mid, ["suffix", "domain"])).withColumn("mean", F.col("num") / F.col("size"))
    sd = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("size") + 1))
    return low.select("host", "n", "bad", "mean", (F.col("mean") - deviations * sd).alias("low"))


def judge(pages: DataFrame, outcomes: DataFrame, rules: tuple[Rule, ...] = RULES,
          suffixes: tuple[str, ...] = SUFFIXES, bad_share: float = BAD_SHARE) -> DataFrame:
    """page_id, host, path, rule, verdict, and the host's n_labelled and low.

    ``outcomes``: page_id, bad (0 or 1).
    """
    urls = split_url(pages)
    worst = outcomes.groupBy("page_id").agg(F.max("bad").cast("long").alias("bad")).where("bad IS NOT NULL")
    suffix, domain = tree(suffixes)
    counted = (urls.select("page_id", "host").join(worst, "page_id", "left").groupBy("host")
               .agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
               .select("host", suffix.alias("suffix"), domain.alias("domain"), "n", "bad"))
    # every level reads it: one row a host, grouped once
    known = reputations(staged(counted, "host-counts")).select("host", F.col("n").alias("n_labelled"), "low")
    text, verdict = longest_rule(rules)
    own = F.when(F.col("low") > bad_share, F.lit("block")).otherwise(F.lit("allow"))
    return urls.join(known, "host").select(
        "page_id", "host", "path", text.alias("rule"), F.coalesce(verdict, own).alias("verdict"),
        "n_labelled", "low")


def query(spark, sf_dir: str) -> DataFrame:
    """op1: every url of ``pages``; a page is bad if its label says low quality."""
    outcomes = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("page_id"), (1 - F.col("quality")).alias("bad"))
    return judge(table(spark, sf_dir, "pages"), outcomes).drop("low")
