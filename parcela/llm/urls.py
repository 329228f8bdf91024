"""URL filters: explicit rules, and for other pages the reputation of their host."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small, stored

#: A host is blocked if its bad share is above ``LIMIT`` with a posterior margin of ``Z`` deviations.
LIMIT, Z = 0.3, 1.645
#: Correlation within groups is kept in this range, so that priors have 1/99 to 999 pages' weight.
LEAST_RHO, MOST_RHO = 0.001, 0.99


#: Second labels under which a country's names are registered, and the countries that do so.
SECOND = "ac co com edu gob gov gouv ltd me ne net nom or org plc sch"
COUNTRIES = "ae ar at au bd bo br cl cn co cr do ec eg es gt hk hn hu id il in jp ke kr kw lk mx my na ng ni np nz om pa pe ph pk pl pr py qa sa sg sv th tn tr tw tz ua ug uk uy ve vn za zm zw"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


#: The production rules.
RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)


def parts(url: str = "url") -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://``."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    host = F.translate(F.regexp_extract(url, r"://([^/?#]*)", 1), upper, upper.lower())
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def matched(rules: tuple[Rule, ...], what: str) -> Column:
    """``what`` of the longest rule that fits ``host`` and ``path``, else null."""
    out = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.text), r.text)):
        of_host = (F.col("host") == r.host) | F.col("host").endswith("." + r.host)
        out = F.when(of_host & F.col("path").startswith(r.path), F.lit(getattr(r, what))).otherwise(out)
    return out


def _rho(level: DataFrame) -> float:
    """How alike the outcomes of a group are beyond chance, by moments, from (n, bad, up)."""
    p = F.col("up")
    apart = (F.pow(F.col("bad") / F.col("n") - p, 2) * F.col("n") / (p * (1 - p))).alias("q")
    s = level.where("n > 0").select("n", apart).agg(F.sum("q").alias("q"), F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("nn"), F.count("*").alias("k")).first()
    room = s.n - s.nn / s.n - (s.k - 1) if s.n else 0
    rho = (s.q - (s.k - 1)) / room if room > 0 else MOST_RHO
    return min(MOST_RHO, max(LEAST_RHO, round(rho, 9)))


def _shrunk(level: DataFrame) -> DataFrame:
    """``level`` (n, bad, up) with the Beta parameters of its groups: prior mean ``up``, the level's own weight."""
    rho = _rho(level)
    weight = (1 - rho) / rho
    return level.withColumns({"alpha": F.col("bad") + weight * F.col("up"), "beta": F.col("n") - F.col("bad") + weight * (1 - F.col("up"))})


def names_of(host: str = "host") -> tuple[str, str]:
    """SQL for a host's suffix and registered domain, without user name and port.

    A suffix is the last label, or the last two where they are a country and one of its second
    labels; the domain has one label more. An address of numbers is its own suffix and domain.
    """
    bare = f"regexp_replace(regexp_replace({host}, '^.*@', ''), ':[0-9]*$', '')"
    second = "|".join(SECOND.split())
    country = "|".join(COUNTRIES.split())
    deep = rf"{bare} rlike '(^|[.])({second})[.]({country})$'"
    number = rf"({bare} rlike '^[0-9]+([.][0-9]+)+$' or {bare} like '[%')"
    tail = f"substring_index({bare}, '.', {{0}})"
    return tuple(f"case when {number} then {bare} when {deep} then {tail.format(-a - 1)} else {tail.format(-a)} end" for a in (1, 2))


def reputation(hosts: DataFrame) -> DataFrame:
    """Posterior of the bad share of each host, from ``hosts`` (host, n, bad: labelled outcomes).

    Adds alpha, beta, mean, low and high. All outcomes give the prior mean of suffixes, a suffix's
    posterior that of its domains, a domain's that of its hosts; each level's prior weight comes
    from how much its groups differ (beta-binomial, by moments; one number a level comes to the
    driver). ``names_of`` says what suffix and domain of a host are. A host without outcomes has its
    domain's mean with the prior's weight.
    """
    suffix, domain = names_of()
    named = stored(hosts.withColumns({"suffix": F.expr(suffix), "domain": F.expr(domain)}), "hosts")
    sums = (F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    domains = named.groupBy("suffix", "domain").agg(*sums)
    suffixes = domains.groupBy("suffix").agg(*sums)
    every = suffixes.agg(*sums).first()
    mean = (F.col("alpha") / (F.col("alpha") + F.col("beta"))).alias("up")
    over = _shrunk(suffixes.withColumn("up", F.lit(((every.bad or 0) + 1.0) / ((every.n or 0) + 2.0)))).select("suffix", mean)
    over = stored(_shrunk(domains.join(over, "suffix")).select("domain", mean), "domains")
    total = F.col("alpha") + F.col("beta")
    each = _shrunk(named.join(over, "domain")).withColumn("mean", F.col("alpha") / total)
    spread = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (total + 1))
    return each.select("host", "n", "bad", "alpha", "beta", "mean", (F.col("mean") - Z * spread).alias("low"), (F.col("mean") + Z * spread).alias("high"))


def judge(pages: DataFrame, outcomes: DataFrame, rules: tuple[Rule, ...] = RULES, limit: float = LIMIT) -> DataFrame:
    """A row per page: page_id, host, path, rule, verdict, bad_low (the bound that judged it).

    ``outcomes`` (page_id, bad) has labelled pages, each at most once. The longest rule that fits
    decides; without one a page is blocked if the lower bound of its host's bad share is over
    ``limit``. Null and malformed urls belong to the empty host. Repeated page rows are each judged;
    an empty table gives none. Hosts are summed before any shuffle, and the join back is by
    broadcast only while they are few.
    """
    host, path = parts()
    cut = pages.select("page_id", host.alias("host"), path.alias("path"))
    labelled = cut.join(outcomes.select("page_id", F.col("bad").cast("bigint").alias("bad")), "page_id", "left")
    hosts = labelled.groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).cast("bigint").alias("bad"))
    rated = stored(reputation(hosts).select("host", F.col("low").alias("bad_low")), "reputation")
    joined = cut.join(small(rated, 200_000), "host", "left")
    rule, verdict = matched(rules, "text"), matched(rules, "verdict")
    by_host = F.when(F.round("bad_low", 9) > limit, "block").otherwise("allow")
    return joined.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, by_host).alias("verdict"), F.round("bad_low", 6).alias("bad_low"))


def outcomes_of(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(page_id, bad) of pages whose url ends in the id of a labelled document; bad: of no quality, or toxic."""
    number = F.regexp_extract(parts()[1], r"/(\d{1,18})(?:\.html|/)?$", 1)
    named = pages.select("page_id", number.try_cast("bigint").alias("doc_id"))
    bad = labels.groupBy("doc_id").agg(F.max(F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).otherwise(0)).alias("bad"))
    return named.join(bad, "doc_id").groupBy("page_id").agg(F.max("bad").alias("bad"))
