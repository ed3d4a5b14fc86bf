"""URL filtering: explicit host and path rules, then empirical-Bayes host reputation."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import UPPER


@dataclass(frozen=True)
class Rule:
    """``verdict`` for ``host``, its subdomains, and paths that start with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


#: The rules of the query.
RULES = (
    Rule("com", "/en/", "block"),
    Rule("example.com", "/en/7", "allow"),
    Rule("net", "/de/", "allow"),
    Rule("example.net", "/de/8", "block"),
    Rule("org", "/es/", "block"),
)
#: Names of more than one label under which others register their own. Give a full list for real corpora.
SUFFIXES = (
    "co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "edu.au", "co.nz", "org.nz",
    "co.jp", "ne.jp", "or.jp", "ac.jp", "co.kr", "or.kr", "com.cn", "net.cn", "org.cn", "com.br", "org.br", "co.in", "net.in", "co.za", "com.mx", "com.ar",
    "com.tr", "com.tw", "com.hk", "com.sg", "github.io", "blogspot.com", "s3.amazonaws.com",
)


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1)
    return F.translate(host, UPPER, UPPER.lower())


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def best_rule(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """Struct ``(size, name, verdict)`` of the longest rule that fits, or null."""
    fits = [
        F.when(
            ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path),
            F.struct(F.lit(len(r.name)).alias("size"), F.lit(r.name).alias("name"), F.lit(r.verdict).alias("verdict")),
        )
        for r in rules
    ]
    return F.array_max(F.array(*fits)) if fits else F.lit(None).cast("struct<size:int,name:string,verdict:string>")


def suffix_labels(host: Column, suffixes: tuple[str, ...] = SUFFIXES) -> Column:
    """Labels of the longest public suffix that ``host`` is or ends in; 1 where none is listed."""
    out = F.lit(1)
    for k in sorted({s.count(".") + 1 for s in suffixes}):
        listed = F.substring_index(host, ".", -k).isin(*[s for s in suffixes if s.count(".") + 1 == k])
        out = F.when(listed & (F.size(F.split(host, r"\.")) >= k), F.lit(k)).otherwise(out)
    return out


def last_labels(host: Column, n: Column) -> Column:
    parts = F.split(host, r"\.")
    return F.array_join(F.slice(parts, F.greatest(F.size(parts) - n + 1, F.lit(1)), n), ".")


def domain_of(host: Column, suffixes: tuple[str, ...] = SUFFIXES) -> Column:
    """Registered domain: the public suffix and one label more; the host itself if it has no more."""
    return last_labels(host, suffix_labels(host, suffixes) + 1)


def suffix_of(host: Column, suffixes: tuple[str, ...] = SUFFIXES) -> Column:
    return last_labels(host, suffix_labels(host, suffixes))


def beta_quantile(a: Column, b: Column, z: float) -> Column:
    """Quantile of a beta distribution at the normal deviate ``z``, by cube roots of the odds (Paulson's approximation, in built-ins)."""
    sa, sb = 1 / (9 * a), 1 / (9 * b)
    ca, cb = 1 - sa, 1 - sb
    root = (ca * cb + z * F.sqrt(F.greatest(ca * ca * sb + cb * cb * sa - z * z * sa * sb, F.lit(0.0)))) / (cb * cb - z * z * sb)
    odds = F.pow(F.greatest(root, F.lit(0.0)), F.lit(3.0)) * a / b
    return odds / (1 + odds)


def _strength(groups: DataFrame, floor: float, ceiling: float) -> float:
    """Prior pages of a beta-binomial whose groups ``(n, bad, mean)`` scatter about their parents' means.

    Method of moments: the squared deviations beyond the binomial ones give the intraclass
    correlation rho, and 1 / rho - 1 is the prior's weight. Three sums go to the driver.
    """
    spread = F.col("mean") * (1 - F.col("mean"))
    s, one, two = groups.agg(
        F.sum((F.col("bad") - F.col("n") * F.col("mean")) ** 2),
        F.sum(F.col("n") * spread),
        F.sum(F.col("n") * (F.col("n") - 1) * spread),
    ).first()
    if not two:
        return ceiling
    rho = min(max(round((s - one) / two, 6), 1 / (1 + ceiling)), 1 / (1 + floor))
    return 1 / rho - 1


def host_reputation(
    outcomes: DataFrame, suffixes: tuple[str, ...] = SUFFIXES, floor: float = 2.0, ceiling: float = 50.0
) -> tuple[DataFrame, float]:
    """Posterior of the bad share of each host of ``outcomes(host, bad)``: ``host, a, b``; and the share of all pages.

    Suffixes shrink to the share of all pages, registered domains to their suffix and hosts to
    their domain, each with a prior weight fitted to how the level scatters, within
    ``floor`` to ``ceiling`` pages. ``bad`` is 0, 1, or null for a page without outcome; a host without any has its domain's prior.
    """
    hosts = (
        outcomes.where(F.col("host").isNotNull())
        .groupBy("host")
        .agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
        .select("host", "n", "bad", domain_of(F.col("host"), suffixes).alias("domain"), suffix_of(F.col("host"), suffixes).alias("suffix"))
    )
    n, bad = hosts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("bad"), F.lit(0))).first()
    overall = (bad + 1) / (n + 2)
    level = hosts.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).withColumn("mean", F.lit(overall))
    m = _strength(level, floor, ceiling)
    means = level.select("suffix", ((F.col("bad") + m * F.col("mean")) / (F.col("n") + m)).alias("mean"))
    level = hosts.groupBy("suffix", "domain").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).join(means, "suffix")
    m = _strength(level, floor, ceiling)
    means = level.select("domain", ((F.col("bad") + m * F.col("mean")) / (F.col("n") + m)).alias("mean"))
    level = hosts.join(means, "domain")
    m = _strength(level, floor, ceiling)
    posterior = level.select(
        "host", (F.col("bad") + m * F.col("mean")).alias("a"), (F.col("n") - F.col("bad") + m * (1 - F.col("mean"))).alias("b")
    )
    return posterior, overall


def filter_urls(
    pages: DataFrame,
    outcomes: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    suffixes: tuple[str, ...] = SUFFIXES,
    tolerance: float | None = None,
    z: float = -0.8416,
) -> DataFrame:
    """Judge every row of ``pages(page_id, url, ...)``: ``page_id, host, path, rule, verdict, bad_bound``.

    The longest rule that fits decides; else the lower bound (the quantile at ``z``, by default one in five) of the
    posterior bad share of the host, learnt from ``outcomes(page_id, bad)``: pages of hosts whose bound is above ``tolerance``, by default the
    share of all pages, are blocked. A host without labelled pages is judged by its domain's prior. A null url or one
    without ``://`` has an empty host and path, no reputation (``bad_bound`` null) and is allowed. Repeated pages are judged each;
    an outcome counts for every page row of its id; null ids match nothing; without outcomes no host is above the rest.
    """
    judged = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    labelled = outcomes.select(F.col("page_id").alias("__id"), "bad")
    seen = judged.where("host != ''").join(labelled, F.col("page_id") == F.col("__id"), "left").select("host", "bad")
    posterior, overall = host_reputation(seen, suffixes)
    limit = overall if tolerance is None else tolerance
    bounds = posterior.select(F.col("host").alias("__host"), F.round(beta_quantile(F.col("a"), F.col("b"), z), 6).alias("bad_bound"))
    rule = best_rule(F.col("host"), F.col("path"), rules)
    return (
        judged.join(bounds, F.col("host") == F.col("__host"), "left")
        .withColumn("best", rule)
        .select(
            "page_id",
            "host",
            "path",
            F.col("best.name").alias("rule"),
            F.coalesce(F.col("best.verdict"), F.when(F.col("bad_bound") > limit, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
            "bad_bound",
        )
    )
