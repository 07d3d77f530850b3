"""URL filter: explicit rules first, then empirical-Bayes reputation of hosts.

Labelled pages are counted by host. The share of bad pages is shrunk level by level: all pages give
the prior of the suffixes (``com``, ``co.uk``), a suffix that of its registered domains, a domain
that of its hosts. Each level is beta-binomial: a unit with prior mean m, x bad ones among n labelled
pages and the level's strength K has the posterior Beta(K m + x, K (1 - m) + n - x). K comes from the
data of its level by the method of moments: the squared deviations of the units exceed the binomial
ones by the factor 1 + (n - 1) / (K + 1). A host is blocked if the lower bound of its posterior (mean
less ``z`` standard deviations) is above ``max_bad``, so hosts with few labels stand or fall with
their domain, and hosts without labels are seldom blocked.

Only DataFrame functions are used. Pages are reduced to counts by host before any other step (sums
combine in the tasks), domains and suffixes are sums of hosts, and pages meet the verdicts in one
join by host, whose hot keys adaptive execution splits. Nothing is collected or broadcast by hint.
The strengths are scalar subqueries.

Defined cases: a null url, or one without ``://``, has an empty host and path, and the empty host
is judged like others; labels that are null are no labels, and repeated rows count and are returned
as often as they stand there; without any labels no host is blocked; an empty table gives no rows;
further columns are ignored, whatever their names; very long urls are judged whole.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.session import cut_lineage

#: Suffixes of two labels under which names are registered (fixed values; a parameter of the operator).
LONG_SUFFIXES = ("ac.uk", "co.uk", "gov.uk", "org.uk", "com.au", "net.au", "org.au", "co.nz", "co.jp",
                 "ne.jp", "or.jp", "com.br", "com.cn", "com.mx", "com.tr", "com.vn", "edu.vn", "co.in",
                 "co.kr", "co.za")
MAX_BAD = 0.5
Z = 1.645  # one-sided 95 %
#: Bounds of a level's strength, in pages.
WEAKEST, STRONGEST = 0.5, 1000.0


def with_host(pages: DataFrame, url: str = "url") -> DataFrame:
    """``pages`` and the ``host`` and ``path`` of their urls."""
    at = F.instr(F.col(url), "://")
    rest = F.when(at > 0, F.substring(F.col(url), at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    return pages.withColumns({
        "host": F.translate(F.coalesce(host, F.lit("")), string.ascii_uppercase,
                            string.ascii_lowercase),
        "path": F.coalesce(F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), F.lit(""))})


def _name(host: Column) -> Column:
    """The host without user and port."""
    return F.regexp_replace(F.substring_index(host, "@", -1), ":[0-9]*$", "")


def suffix_of(host: Column, long_suffixes: tuple[str, ...] = LONG_SUFFIXES) -> Column:
    """The public suffix; numeric addresses have none."""
    name = _name(host)
    two = F.substring_index(name, ".", -2)
    return (F.when(name.rlike(r"^[0-9.]*$") | name.startswith("["), F.lit(""))
            .when(two.isin(*long_suffixes), two).otherwise(F.substring_index(name, ".", -1)))


def domain_of(host: Column, suffix: Column) -> Column:
    """The registered domain: one label more than the suffix, or the whole name if it has none."""
    name = _name(host)
    return (F.when(suffix == "", name).when(suffix.contains("."), F.substring_index(name, ".", -3))
            .otherwise(F.substring_index(name, ".", -2)))


def _strength(units: DataFrame, prior: str) -> Column:
    """A level's strength as a scalar subquery over its units (``_n, _bad`` and the prior mean)."""
    spread = F.col("_n") * F.col(prior) * (1 - F.col(prior))
    excess = F.sum(F.pow(F.col("_bad") - F.col("_n") * F.col(prior), 2) - spread)
    room = F.sum(spread * (F.col("_n") - 1))
    share = F.when(room > 0, F.greatest(excess / room, F.lit(1 / (1 + STRONGEST))))
    strength = F.greatest(1 / F.coalesce(share, F.lit(1 / (1 + STRONGEST))) - 1, F.lit(WEAKEST))
    return units.agg(strength.alias("_k")).scalar()


def _posterior(units: DataFrame, prior: str, name: str) -> DataFrame:
    k = _strength(units, prior)
    return units.withColumn(name, (k * F.col(prior) + F.col("_bad")) / (k + F.col("_n")))


def host_reputation(labelled: DataFrame, z: float = Z,
                    long_suffixes: tuple[str, ...] = LONG_SUFFIXES) -> DataFrame:
    """Hosts with their posterior, from ``host, bad`` (0, 1 or null for each page of a host).

    ``host, domain, suffix, n_labelled, n_bad, bad_mean, bad_low, bad_high``; one row for each host.
    """
    suffix = suffix_of(F.col("host"), long_suffixes)
    # Every level reads these counts and the level above twice, so they are stored.
    hosts = cut_lineage(labelled.groupBy("host").agg(
        F.count("bad").alias("_n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("_bad")))
    hosts = hosts.withColumn("suffix", suffix).withColumn(
        "domain", domain_of(F.col("host"), F.col("suffix")))

    def summed(units: DataFrame, *keys: str) -> DataFrame:
        return units.groupBy(*keys).agg(F.sum("_n").alias("_n"), F.sum("_bad").alias("_bad"))

    domains = summed(hosts, "suffix", "domain")
    suffixes = cut_lineage(summed(domains, "suffix"))
    overall = suffixes.agg(((F.coalesce(F.sum("_bad"), F.lit(0)) + 0.5)
                            / (F.coalesce(F.sum("_n"), F.lit(0)) + 1)).alias("_m")).scalar()
    suffixes = _posterior(suffixes.withColumn("_prior", overall), "_prior", "_suffix_mean")
    domains = cut_lineage(domains.join(suffixes.select("suffix", "_suffix_mean"), "suffix"))
    domains = _posterior(domains, "_suffix_mean", "_domain_mean")
    hosts = cut_lineage(hosts.join(domains.select("suffix", "domain", "_domain_mean"),
                                   ["suffix", "domain"]))
    k = _strength(hosts, "_domain_mean")
    a = k * F.col("_domain_mean") + F.col("_bad")
    b = k * (1 - F.col("_domain_mean")) + F.col("_n") - F.col("_bad")
    mean = a / (a + b)
    spread = z * F.sqrt(mean * (1 - mean) / (a + b + 1))
    return hosts.select("host", "domain", "suffix", F.col("_n").alias("n_labelled"),
                        F.col("_bad").alias("n_bad"), mean.alias("bad_mean"),
                        (mean - spread).alias("bad_low"), (mean + spread).alias("bad_high"))


def _rules(rules: list[tuple[str, str]]) -> Column:
    """Rules as an array of structs, the longest first (equal lengths: the longer host, then text)."""
    parts = []
    for verdict, text in rules:
        host, slash, path = text.partition("/")
        if verdict not in ("allow", "block") or not host or not slash:
            raise ValueError(f"no rule: {verdict} {text}")
        parts.append((text, host, "/" + path, verdict))
    parts.sort(key=lambda r: (-len(r[0]), -len(r[1]), r))
    if not parts:
        return F.array().cast("array<struct<rule:string,host:string,path:string,verdict:string>>")
    return F.array(*[F.struct(*[F.lit(v).alias(n) for v, n in
                                zip(r, ("rule", "host", "path", "verdict"))]) for r in parts])


def filtered_urls(pages: DataFrame, labelled: DataFrame, rules: list[tuple[str, str]],
                  page_id: str = "page_id", url: str = "url", max_bad: float = MAX_BAD, z: float = Z,
                  long_suffixes: tuple[str, ...] = LONG_SUFFIXES) -> DataFrame:
    """``page_id, host, path, rule, verdict`` and the figures of the host, for each page.

    ``labelled`` holds pages with known outcomes: ``url`` (as in ``pages``) and ``bad``, 1 or 0. A rule
    (``("block", "example.org/es/")``) fits its host and all subdomains if the path starts with its
    path; the longest one decides. The rules are part of the plan: thousands, not millions.
    """
    judged = with_host(pages.select(F.col(page_id).alias("_id"), F.col(url).alias("_url")), "_url")
    known = with_host(labelled.select(F.col(url).alias("_url"), F.col("bad").cast("long")), "_url")
    hosts = host_reputation(
        known.select("host", "bad").unionByName(
            judged.select("host", F.lit(None).cast("long").alias("bad"))), z, long_suffixes)
    fits = F.filter(_rules(rules), lambda r: (F.col("host") == r["host"])
                    | F.endswith(F.col("host"), F.concat(F.lit("."), r["host"])))
    rule = F.get(F.filter("_rules", lambda r: F.startswith(F.col("path"), r["path"])), F.lit(0))
    method = F.when(F.col("bad_low") > max_bad, "block").otherwise("allow")
    return (judged.join(hosts.withColumn("_rules", fits), "host").withColumn("_rule", rule).select(
        F.col("_id").alias("page_id"), "host", "path", F.col("_rule.rule").alias("rule"),
        F.coalesce("_rule.verdict", method).alias("verdict"), "domain", "suffix", "n_labelled",
        "n_bad", "bad_mean", "bad_low", "bad_high"))
