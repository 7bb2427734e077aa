"""URL filter: empirical-Bayes host reputation under fixed host and path rules."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

#: What registries put before a country's two letters to register names under, as in
#: ``co.uk`` and ``com.tr``. Fixed values.
SECOND_LEVEL = (
    "ac", "asn", "co", "com", "ed", "edu", "gen", "go", "gob", "gouv", "gov", "gv", "id", "info", "ltd", "me",
    "mil", "ne", "net", "nom", "or", "org", "plc", "sch", "school", "web",
)
#: Names under which their owners let others have names of their own. Fixed values.
SHARED_NAMES = (
    "appspot.com", "azurewebsites.net", "blogspot.com", "cloudfront.net", "fly.dev", "github.io", "gitlab.io",
    "herokuapp.com", "myshopify.com", "netlify.app", "onrender.com", "pages.dev", "readthedocs.io", "tumblr.com",
    "vercel.app", "web.app", "weebly.com", "wixsite.com", "wordpress.com", "workers.dev",
)
#: A host is blocked when its share of good pages is below LEAST_GOOD even at the
#: upper end of an interval of Z standard deviations around the posterior mean.
LEAST_GOOD, Z = 0.5, 1.645
#: Strength of a prior in pages where the data do not tell it, and its bounds.
FEW_PAGES, LEAST_STRENGTH, MOST_STRENGTH = 10.0, 1.0, 1000.0


class Rule(NamedTuple):
    """A verdict for a host with its subdomains, where the path starts with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    rest = _rest(url)
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.locate("://", F.coalesce(url, F.lit("")))
    return F.when(at > 0, F.substring(url, at + 3, F.char_length(url))).otherwise(F.lit(""))


def name_of(host: Column) -> Column:
    """A host as a name: without user info, port and final dots, which make no other host of it."""
    named = F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":\d*$", "")
    return F.regexp_replace(named, r"\.+$", "")


def suffix_of(host: Column, shared: Sequence[str] = SHARED_NAMES) -> Column:
    """The part under which names are registered, of a :func:`name_of`; empty for an address.

    The last label; or the last two where the first of them is one of SECOND_LEVEL
    and the last a country's; or a name of ``shared``, which has two labels.
    """
    two = F.substring_index(host, ".", -2)
    national = two.rlike(rf"^(?:{'|'.join(SECOND_LEVEL)})\.[a-z]{{2}}$")
    return F.when(_is_address(host), F.lit("")).when(national | two.isin(*shared), two).otherwise(F.substring_index(host, ".", -1))


def domain_of(host: Column, shared: Sequence[str] = SHARED_NAMES) -> Column:
    """The registered domain: suffix and one label more; an address is its own."""
    suffix = suffix_of(host, shared)
    return F.when(_is_address(host), host).when(
        suffix.contains("."), F.substring_index(host, ".", -3)
    ).otherwise(F.substring_index(host, ".", -2))


def _is_address(host: Column) -> Column:
    return host.rlike(r"^(\[|\d+\.\d+\.\d+\.\d+(:|$))")


def rule_for(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The name and verdict of the rule that fits; the longest wins."""
    found = F.lit(None).cast("struct<name:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(
            fits, F.struct(F.lit(rule.name).alias("name"), F.lit(rule.verdict).alias("verdict"))
        ).otherwise(found)
    return found


def _strength(groups: DataFrame, by: str | None) -> DataFrame:
    """Prior strength per ``by`` from the spread of the rates of its ``groups``, by moments.

    With rates p_i of n_i pages around mean m, the spread that sampling alone
    gives is m(1-m)/n_i; what is over is m(1-m)/(strength+1).
    """
    rate = F.col("good") / F.col("pages")
    keyed = groups.where("pages > 0").withColumn("by", F.col(by) if by else F.lit(""))
    mean = keyed.groupBy("by").agg(
        F.sum("good").alias("g"), F.sum("pages").alias("p"), F.count("*").alias("k"),
        F.sum(F.col("pages") * rate * rate).alias("s2"),
    )
    m = F.col("g") / F.col("p")
    spread = F.col("s2") / F.col("p") - m * m
    sampling = m * (1 - m) * F.col("k") / F.col("p")
    over = spread - sampling
    strength = F.when(F.col("k") < 2, F.lit(FEW_PAGES)).when(over <= 0, F.lit(MOST_STRENGTH)).otherwise(
        F.least(F.greatest(m * (1 - m) / over - 1, F.lit(LEAST_STRENGTH)), F.lit(MOST_STRENGTH))
    )
    return mean.select("by", strength.alias("strength"))


def _shrunk(groups: DataFrame, above: DataFrame | None, by: str | None) -> DataFrame:
    """Posterior ``a``, ``b`` of each group: its counts and a prior at the mean of the level above.

    That mean leaves the group's own pages out, so they are not counted twice.
    """
    if above is None:
        return groups.select("*", (F.col("good") + 1.0).alias("a"), (F.col("pages") - F.col("good") + 1.0).alias("b"))
    prior = above.select(F.col(above.columns[0]).alias("by"), F.col("a").alias("above_a"), F.col("b").alias("above_b"))
    joined = (
        groups.withColumn("by", F.col(by) if by else F.lit(""))
        .join(prior, "by")
        .join(_strength(groups, by), "by", "left")
        .withColumn(
            "mean",
            (F.col("above_a") - F.col("good")) / (F.col("above_a") + F.col("above_b") - F.col("pages")),
        )
    )
    strength = F.coalesce("strength", F.lit(FEW_PAGES))
    return joined.select(
        *groups.columns,
        (F.col("good") + F.col("mean") * strength).alias("a"),
        (F.col("pages") - F.col("good") + (1 - F.col("mean")) * strength).alias("b"),
    )


def host_reputation(outcomes: DataFrame, shared: Sequence[str] = SHARED_NAMES) -> DataFrame:
    """Posterior of the share of good pages per host.

    ``outcomes`` has ``host`` and ``good`` (boolean, null for pages without an
    outcome). Counts go from hosts to registered domains, suffixes and all
    pages; then each level is shrunk to the posterior mean of the one above it,
    with a beta prior whose strength is told by the spread of the level itself.
    Returns ``host``, ``pages``, ``good``, ``mean``, ``low``, ``high``.
    """
    hosts = stored(
        outcomes.groupBy("host")
        .agg(F.count("good").alias("pages"), F.count_if("good").alias("good"))
        .select("host", domain_of(F.col("host"), shared).alias("domain"), suffix_of(F.col("host"), shared).alias("suffix"), "pages", "good"),
        "hosts",
    )
    add = F.sum("pages").alias("pages"), F.sum("good").alias("good")
    domains = hosts.groupBy("domain", "suffix").agg(*add)
    suffixes = domains.groupBy("suffix").agg(*add)
    everything = suffixes.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("pages", "good")))
    top = _shrunk(everything.select(F.lit("").alias("all"), "pages", "good"), None, None)
    by_suffix = _shrunk(suffixes, top, None)
    by_domain = _shrunk(domains, by_suffix, "suffix")
    posterior = _shrunk(hosts, by_domain.select("domain", "a", "b"), "domain")
    n = F.col("a") + F.col("b")
    mean = F.col("a") / n
    sd = F.sqrt(F.col("a") * F.col("b") / (n * n * (n + 1)))
    return posterior.select(
        "host",
        "pages",
        "good",
        mean.alias("mean"),
        F.greatest(mean - Z * sd, F.lit(0.0)).alias("low"),
        F.least(mean + Z * sd, F.lit(1.0)).alias("high"),
    )


def judge_urls(
    pages: DataFrame,
    good: Column,
    rules: Sequence[Rule] = (),
    id_column: str = "page_id",
    url_column: str = "url",
    least_good: float = LEAST_GOOD,
    shared: Sequence[str] = SHARED_NAMES,
) -> DataFrame:
    """Every page with ``host``, ``path``, ``rule``, ``verdict`` and its host's reputation.

    ``good`` is the outcome of a page, an expression over ``pages``: true, false,
    or null where it has none. Where a rule fits, the longest decides. Else the
    host is blocked if even the upper bound of its posterior share of good pages
    is below ``least_good``, and allowed otherwise, so little evidence never
    blocks. A host has one reputation with and without user info, port and final
    dot (rules look at the host as it stands); ``shared`` are names whose owners let
    others register under them. Pages move as id, url and outcome only; a host with a third of all
    pages is a count per task, and the join back to pages is one that Spark splits.

    A null url, or one without ``://``, has an empty host and path; such pages
    share the reputation of the empty host. Repeated rows count as often as they
    stand; an empty table gives no rows.
    """
    judged = stored(
        pages.select(F.col(id_column).alias("id"), F.col(url_column).alias("url"), good.alias("good")).select(
            "id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "good"
        ).withColumn("name", name_of(F.col("host"))),
        "pages",
    )
    reputation = stored(host_reputation(judged.select(F.col("name").alias("host"), "good"), shared), "reputation")
    fit = rule_for(F.col("host"), F.col("path"), rules)
    return (
        judged.join(reputation.select(F.col("host").alias("name"), "mean", "high"), "name")
        .withColumn("fit", fit)
        .select(
            F.col("id").alias(id_column),
            "host",
            "path",
            F.col("fit.name").alias("rule"),
            F.coalesce("fit.verdict", F.when(F.col("high") < least_good, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
            F.col("mean").alias("reputation"),
            F.col("high").alias("upper_bound"),
        )
    )


def page_outcome(html: Column, most_junk: float = 0.3) -> Column:
    """Whether a page's visible text is good: no spam by its look; null where it has no text.

    Junk are words with runs of signs, words wholly in capitals, and bare bars:
    what is left when markup, scripts and styles are gone is bad if at least
    ``most_junk`` of its words are such. The html decides, never the url. A script,
    style or comment that is never closed goes on to the end of the page.
    """
    text = F.regexp_replace(html, r"(?is)<(script|style)\b.*?(?:</\1\s*>|\z)|<!--.*?(?:-->|\z)|<[^<>]*>", " ")
    words = F.split(F.trim(F.regexp_replace(text, r"\s+", " ")), " ")
    n = F.size(words)
    junk = F.regexp_count(
        F.concat(F.lit(" "), F.array_join(words, "  "), F.lit(" ")),
        F.lit(r" (?:\S*[!#$%&*|]{2,}\S*|[|]|[A-Z]{4,}\S*) "),
    )
    return F.when(text.isNotNull() & (F.get(words, F.lit(0)) != ""), junk < most_junk * n)
