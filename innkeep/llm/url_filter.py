"""URL filters: rules first, then the host's reputation by empirical Bayes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from innkeep.session import stored

#: Prior strengths (in pages) that are considered at least and at most.
STRENGTH = (2.0, 200.0)
#: Standard deviations from the posterior mean to the bound, and the bound's limit.
DEVIATIONS, LIMIT = 2.0, 0.5


@dataclass(frozen=True)
class Rule:
    """``verdict`` for urls of ``host`` and its subdomains whose path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


#: The rules, as given.  Fixed values.
RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without '://' or url."""
    after = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(after, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(after, r"(?s)^[^/?#]*([^?#]*)", 1)
    host = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def longest_rule(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """(rule, verdict) of the longest rule that fits, null if none does.  A rule's length
    is that of host and path together; among equals the first one wins."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: len(r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        out = F.when(fits, F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.verdict).alias("verdict"))).otherwise(out)
    return out


def reputations(pages: DataFrame) -> DataFrame:
    """``host, bound``: upper bound of each host's share of good pages, from rows of
    ``host, domain, suffix, good, labelled`` (pages summed per host).

    A host's outcomes are binomial; its share comes from a beta around its domain's
    posterior mean, the domain's from one around its suffix's, the suffix's from one
    around all pages' mean.  Each level's strength is fitted by moments: from how far
    the shares of its groups spread beyond what chance gives."""
    level = pages.groupBy("suffix").agg(F.sum("good").alias("good"), F.sum("labelled").alias("n"))
    level = level.withColumn("key", F.col("suffix"))
    total = pages.agg(F.sum("good").alias("good"), F.sum("labelled").alias("n")).first()
    mean = (float(total["good"] or 0) + 1) / (float(total["n"] or 0) + 2)
    suffixes = _shrunk(level.withColumn("prior", F.lit(mean)))
    domains = pages.groupBy("domain", "suffix").agg(F.sum("good").alias("good"), F.sum("labelled").alias("n"))
    domains = domains.join(suffixes.select("suffix", F.col("mean").alias("prior")), "suffix")
    domains = _shrunk(domains)
    hosts = pages.groupBy("host", "domain").agg(F.sum("good").alias("good"), F.sum("labelled").alias("n"))
    hosts = hosts.join(domains.select("domain", F.col("mean").alias("prior")), "domain")
    hosts = _shrunk(hosts)
    spread = F.sqrt(F.col("a") * F.col("b") / ((F.col("a") + F.col("b")) * (F.col("a") + F.col("b")) * (F.col("a") + F.col("b") + 1)))
    return hosts.select("host", (F.col("mean") + DEVIATIONS * spread).alias("bound"), F.col("n").alias("n_labelled"))


def _shrunk(groups: DataFrame) -> DataFrame:
    """The groups with their posterior: ``a, b, mean``."""
    groups = stored(groups, "url-level")
    share = F.col("good") / F.col("n")
    chance = F.col("prior") * (1 - F.col("prior"))
    seen = groups.where("n > 1").agg(
        F.sum(F.col("n") * (share - F.col("prior")) * (share - F.col("prior"))).alias("spread"),
        F.sum(chance).alias("chance"),
        F.sum((F.col("n") - 1) * chance).alias("room"),
    )
    found = seen.first()
    strength = STRENGTH[1]
    if found["room"]:
        # E[n (share - prior)^2] = chance * (1 + (n - 1) rho) with rho = 1 / (strength + 1)
        rho = (found["spread"] - found["chance"]) / found["room"]
        strength = min(STRENGTH[1], max(STRENGTH[0], 1 / rho - 1)) if rho > 0 else STRENGTH[1]
    a = F.col("prior") * strength + F.col("good")
    b = (1 - F.col("prior")) * strength + F.col("n") - F.col("good")
    return groups.withColumn("a", a).withColumn("b", b).withColumn("mean", F.col("a") / (F.col("a") + F.col("b")))


def with_domains(hosts: DataFrame, suffixes: DataFrame | None = None) -> DataFrame:
    """``hosts`` with ``suffix`` and registered ``domain``: the suffix and the label before
    it.  ``suffixes`` (a column ``suffix``, like ``co.uk``) lists those of several labels;
    the longest that a host ends in counts, else its last label.  A host that is itself
    a suffix is its own domain.  The table is joined on the hosts' endings, whatever its
    size."""
    labels = F.split("host", r"\.")
    if suffixes is None:
        long = hosts.withColumn("suffix", F.substring_index("host", ".", -1))
    else:
        ends = hosts.select("host", F.explode(F.sequence(F.lit(2), F.greatest(F.lit(2), F.size(labels)))).alias("n"))
        ends = ends.select("host", F.expr("substring_index(host, '.', -n)").alias("end"), "n")
        listed = suffixes.select(F.lower(F.col("suffix")).alias("end")).distinct()
        found = ends.join(listed, "end").groupBy("host").agg(F.max_by("end", "n").alias("listed"))
        long = hosts.join(found, "host", "left")
        long = long.withColumn("suffix", F.coalesce("listed", F.substring_index("host", ".", -1))).drop("listed")
    size = F.size(F.split("suffix", r"\."))
    return long.withColumn("domain", F.array_join(F.slice(labels, F.greatest(F.lit(1), F.size(labels) - size), F.size(labels)), "."))


def filter_urls(
    pages: DataFrame, outcomes: DataFrame, rules: tuple[Rule, ...] = RULES, suffixes: DataFrame | None = None
) -> DataFrame:
    """``page_id, host, path, rule, verdict, n_labelled`` for every page.

    The longest rule that fits decides.  Without one, the page is blocked if even the
    upper posterior bound of its host's share of good pages is below one half, and
    allowed otherwise: a host needs evidence against it.  ``outcomes`` (page_id, good)
    are labelled pages; several labels of a page are good only if all are, null ones
    don't count.  Registered domains and suffixes are those of ``with_domains``: without
    a table of suffixes, a host's last two labels and its last one.

    Null urls, and urls without '://', have an empty host and path and no rule; they
    form a host of their own.  Repeated rows are judged each, and count each.  A very
    common host is summed before its rows move.  An empty table gives no rows; other
    columns don't matter."""
    host, path = host_and_path(F.col("url"))
    judged = pages.select("page_id", host.alias("host"), path.alias("path"))
    known = outcomes.where("page_id is not null and good is not null").groupBy("page_id").agg(F.min(F.col("good").cast("int")).alias("good"))
    labelled = judged.select("page_id", "host").join(known, "page_id", "left")
    by_host = labelled.groupBy("host").agg(F.coalesce(F.sum("good"), F.lit(0)).alias("good"), F.count("good").alias("labelled"))
    by_host = with_domains(stored(by_host, "url-host-counts"), suffixes)
    bounds = stored(reputations(stored(by_host, "url-hosts")), "url-bounds")
    ruled = judged.join(bounds, "host").withColumn("fits", longest_rule(F.col("host"), F.col("path"), rules))
    verdict = F.coalesce("fits.verdict", F.when(F.col("bound") < LIMIT, F.lit("block")).otherwise(F.lit("allow")))
    return ruled.select("page_id", "host", "path", F.col("fits.rule").alias("rule"), verdict.alias("verdict"), "n_labelled")
