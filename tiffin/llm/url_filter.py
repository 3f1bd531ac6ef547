"""URL filters by rules and by host reputation.

Reputation is empirical Bayes on labelled pages: the share of bad pages of a suffix is drawn towards that of all pages, a registered domain's
towards its suffix's, a host's towards its domain's. A suffix is the last label of a host, or its last two where these are in a table of such suffixes; a domain has one
label more. At each level the parent's mean is the mean of a beta prior, whose strength is estimated
from how much the children's shares differ beyond chance (method of moments over all of them). A url that no rule decides is blocked when
the lower bound of its host's posterior share of bad pages exceeds a limit.

Counts per host are summed on the map side before anything is shuffled, and everything after works on hosts, domains and suffixes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiffin.session import durable

RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
# Suffixes of two labels under which independent sites register.
SUFFIXES = (
    "ac.uk", "co.uk", "gov.uk", "org.uk", "com.au", "net.au", "org.au", "com.br", "org.br", "com.cn", "co.id", "co.il", "co.in", "co.jp", "or.jp",
    "co.kr", "com.mx", "co.nz", "com.sg", "com.tr", "com.tw", "com.ua", "co.za", "com.ar", "com.co", "blogspot.com", "github.io", "gitlab.io",
    "herokuapp.com", "netlify.app", "pages.dev", "readthedocs.io", "tumblr.com", "vercel.app", "wordpress.com",
)
LETTERS = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def after_scheme(url: Column) -> Column:
    """What follows the first ``://``; null without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    """Up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty for null or without ``://``."""
    return F.coalesce(F.translate(F.regexp_extract(after_scheme(url), r"(?s)^([^/?#]*)", 1), *LETTERS), F.lit(""))


def path_of(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or the end; may be empty."""
    return F.coalesce(F.regexp_extract(after_scheme(url), r"(?s)^[^/?#]*([^?#]*)", 1), F.lit(""))


def last_labels(host: Column, labels: int) -> Column:
    parts = F.split(host, r"\.")
    return F.array_join(F.slice(parts, F.greatest(F.size(parts) - labels + 1, F.lit(1)), F.lit(labels)), ".")


def suffix_of(host: Column, suffixes: Sequence[str] = SUFFIXES) -> Column:
    """The last two labels of a host where these are a known suffix, else the last one."""
    return F.when(last_labels(host, 2).isin(*suffixes), last_labels(host, 2)).otherwise(last_labels(host, 1))


def domain_of(host: Column, suffixes: Sequence[str] = SUFFIXES) -> Column:
    """The registered domain: one label more than the suffix, where the host has one."""
    return F.when(last_labels(host, 2).isin(*suffixes), last_labels(host, 3)).otherwise(last_labels(host, 2))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """Rule and verdict of the longest rule that fits; nulls where none does."""
    rule = verdict = None
    for kind, own, start in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r)):
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(start)
        rule = F.when(fits, F.lit(own + start)) if rule is None else rule.when(fits, F.lit(own + start))
        verdict = F.when(fits, F.lit(kind)) if verdict is None else verdict.when(fits, F.lit(kind))
    return (rule, verdict) if rules else (F.lit(None).cast("string"), F.lit(None).cast("string"))


def shrunk(joined: DataFrame, key: str, least: float = 2.0, most: float = 1000.0) -> DataFrame:
    """``key, mean, weight`` of each group's posterior: its counts ``bad`` and ``n`` over a prior with mean ``prior``.

    The prior's strength comes from the spread of the groups' shares around their priors: the variance of a beta-binomial share of n with
    strength s is m (1 - m) (1 + (n - 1) / (s + 1)) / n. It is held between ``least`` and ``most``.
    """
    spread = F.col("prior") * (1 - F.col("prior"))
    seen = joined.where("n > 0").agg(
        F.sum(F.pow(F.col("bad") - F.col("n") * F.col("prior"), 2)).alias("squares"),
        F.sum(F.col("n") * spread).alias("within"), F.sum(F.col("n") * (F.col("n") - 1) * spread).alias("between"),
    )
    # squares = within + between / (strength + 1), in expectation
    excess = F.greatest((F.col("squares") - F.col("within")) / F.nullif(F.col("between"), F.lit(0.0)), F.lit(1e-6))
    strength = seen.select(F.least(F.greatest(F.coalesce(1 / excess - 1, F.lit(most)), F.lit(least)), F.lit(most)).alias("strength")).scalar()
    total = F.col("n") + F.col("strength")
    return joined.withColumn("strength", strength).select(key, ((F.col("bad") + F.col("strength") * F.col("prior")) / total).alias("mean"), total.alias("weight"))


def reputation(outcomes: DataFrame, suffixes: Sequence[str] = SUFFIXES) -> DataFrame:
    """``host, mean, weight`` for the hosts of ``outcomes`` (host, bad: 0, 1 or null for an unlabelled page).

    Three levels, host, domain and suffix, each shrunk to the one above and the suffixes to the mean of all (0.5 where nothing is labelled).
    The counts of hosts and domains are written once, as every level needs them.
    """
    hosts = outcomes.groupBy("host").agg(F.count("bad").cast("double").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).cast("double").alias("bad"))
    hosts = durable(hosts.withColumn("domain", domain_of(F.col("host"), suffixes)).withColumn("suffix", suffix_of(F.col("host"), suffixes)), "hosts")
    domains = durable(hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")), "domains")
    ends = durable(domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")), "suffixes")
    every = ends.agg(F.coalesce((F.sum("bad") + 0.5) / (F.sum("n") + 1), F.lit(0.5)).alias("mean")).scalar()
    top = shrunk(ends.withColumn("prior", every), "suffix")
    middle = durable(shrunk(domains.join(top.select("suffix", F.col("mean").alias("prior")), "suffix"), "domain"), "means")
    return shrunk(hosts.join(middle.select("domain", F.col("mean").alias("prior")), "domain"), "host")


def lower_bound(mean: Column, weight: Column, z: float) -> Column:
    """Lower bound of a beta posterior by its mean and standard deviation."""
    return F.greatest(mean - z * F.sqrt(mean * (1 - mean) / (weight + 1)), F.lit(0.0))


def judge(
    pages: DataFrame, outcomes: DataFrame, rules: list[tuple[str, str, str]] = RULES, limit: float = 0.5, z: float = 1.64, suffixes: Sequence[str] = SUFFIXES,
    id_column: str = "page_id", url_column: str = "url",
) -> DataFrame:
    """``page_id, host, path, rule, verdict, bad_share, bound`` of every page.

    ``outcomes`` has one row per judged page: its id and ``bad`` (0 or 1). A rule fits its host and all subdomains if the url's path starts with
    the rule's; the longest wins. Without a rule, pages of hosts whose posterior bound exceeds ``limit`` are blocked. A null url, or one without
    ``://``, has an empty host and path; the empty host has a reputation like any other. Pages whose id is null count as unlabelled; equal rows
    all stay, several outcomes of one id count by their mean. Other columns are left out. An empty table gives an empty result.
    """
    url = F.col(f"`{url_column}`")
    parsed = pages.select(F.col(f"`{id_column}`").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    judged = outcomes.groupBy("page_id").agg(F.round(F.avg("bad")).alias("bad"))
    known = reputation(parsed.select("page_id", "host").join(judged, "page_id", "left").select("host", "bad"), suffixes)
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    bound = lower_bound(F.col("mean"), F.col("weight"), z)
    rated = parsed.join(known, "host", "left")
    return rated.select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, F.when(bound > limit, "block").otherwise("allow")).alias("verdict"),
        F.col("mean").alias("bad_share"), bound.alias("bound"),
    )


def page_outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """``page_id, bad``: the label of the document a page shows, whose id is the number in the last part of the url's path."""
    number = F.regexp_extract(path_of(F.col("url")), r"/([0-9]{1,18})(?:\.html)?/?$", 1)
    shown = pages.select("page_id", number.try_cast("bigint").alias("doc_id"))
    marks = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.max((F.col("quality") == 0).cast("int")).alias("bad"))
    return shown.where("page_id IS NOT NULL").join(marks, "doc_id").select("page_id", "bad")


SQL = """
WITH parsed AS (
  SELECT page_id, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
  FROM (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS rest FROM pages)
), marks AS (
  SELECT doc_id, max(CASE WHEN quality = 0 THEN 1 ELSE 0 END) AS bad FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id
), judged AS (
  SELECT page_id, round(avg(bad)) AS bad
  FROM (SELECT page_id, try_cast(regexp_extract(path, '/([0-9]{1,18})(?:\\.html)?/?$', 1) AS BIGINT) AS doc_id FROM parsed WHERE page_id IS NOT NULL)
  JOIN marks USING (doc_id) GROUP BY page_id
), hosts AS (
  SELECT host, count(bad)::DOUBLE AS n, coalesce(sum(bad), 0)::DOUBLE AS bad, array_to_string(labels[-CASE WHEN known THEN 3 ELSE 2 END:], '.') AS domain,
         array_to_string(labels[-CASE WHEN known THEN 2 ELSE 1 END:], '.') AS suffix
  FROM (SELECT *, string_split(host, '.') AS labels, array_to_string(string_split(host, '.')[-2:], '.') IN (""" + ", ".join(f"'{s}'" for s in SUFFIXES) + """) AS known FROM parsed)
  LEFT JOIN judged USING (page_id) GROUP BY host, labels, known
), domains AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY domain, suffix),
suffixes AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM domains GROUP BY suffix),
top AS (
  SELECT suffix, n, bad, prior, s,  (bad + s * prior) / (n + s) AS mean FROM (
    SELECT *, coalesce(least(greatest(1 / greatest((sum(pow(bad - n * prior, 2)) FILTER (n > 0) OVER () - sum(n * prior * (1 - prior)) FILTER (n > 0) OVER ())
      / nullif(sum(n * (n - 1) * prior * (1 - prior)) FILTER (n > 0) OVER (), 0), 1e-6) - 1, 2), 1000), 1000) AS s
    FROM (SELECT *, (SELECT coalesce((sum(bad) + 0.5) / (sum(n) + 1), 0.5) FROM suffixes) AS prior FROM suffixes))
), middle AS (
  SELECT domain, (bad + s * prior) / (n + s) AS mean FROM (
    SELECT *, coalesce(least(greatest(1 / greatest((sum(pow(bad - n * prior, 2)) FILTER (n > 0) OVER () - sum(n * prior * (1 - prior)) FILTER (n > 0) OVER ())
      / nullif(sum(n * (n - 1) * prior * (1 - prior)) FILTER (n > 0) OVER (), 0), 1e-6) - 1, 2), 1000), 1000) AS s
    FROM (SELECT d.*, t.mean AS prior FROM domains d JOIN top t USING (suffix)))
), low AS (
  SELECT host, (bad + s * prior) / (n + s) AS mean, n + s AS weight FROM (
    SELECT *, coalesce(least(greatest(1 / greatest((sum(pow(bad - n * prior, 2)) FILTER (n > 0) OVER () - sum(n * prior * (1 - prior)) FILTER (n > 0) OVER ())
      / nullif(sum(n * (n - 1) * prior * (1 - prior)) FILTER (n > 0) OVER (), 0), 1e-6) - 1, 2), 1000), 1000) AS s
    FROM (SELECT h.*, m.mean AS prior FROM hosts h JOIN middle m USING (domain)))
), ruled AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM parsed JOIN low USING (host)
)
SELECT page_id, host, path, rule, CASE rule WHEN 'net/' THEN 'block' WHEN 'example.com/de/' THEN 'block' WHEN 'example.net/en/' THEN 'allow' WHEN 'org/fr/' THEN 'allow'
  ELSE CASE WHEN greatest(mean - 1.64 * sqrt(mean * (1 - mean) / (weight + 1)), 0) > 0.5 THEN 'block' ELSE 'allow' END END AS verdict
FROM ruled
"""
