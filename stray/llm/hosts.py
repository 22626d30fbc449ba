"""URL filter by empirical-Bayes host reputation.

Labelled page outcomes (bad: low quality or toxic) are counted per host and shrunk
through beta-binomial priors: suffix rates towards the overall rate, registered-domain
rates towards their suffix, host rates towards their domain. The strength of each
level's prior comes from the data, by moments of the intra-class correlation. A host is
blocked when the lower bound of its posterior bad rate exceeds `max_rate`. Fixed rules
on host and path take precedence.

Counts pre-aggregate, so one host with a third of all pages is no hot task; the verdict
per host is joined back with the strategy that the planner picks by its size.

Defined cases: a null url, or one without '://', has host and path '' and is judged by
the overall rate; a page whose document has no label, or only null labels, counts
towards no rate; repeated pages count once each; an empty labels table leaves the
overall rate at 1/2 and blocks nothing by reputation.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stray.llm.common import ascii_lower, materialise

#: Fixed values: (verdict, rule).
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
         ("allow", "com/fr/"), ("block", "com/de/"))
#: Public suffixes of two labels; all others are taken as one label.
SECOND_LEVEL = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.jp",
                "ne.jp", "or.jp", "com.br", "co.nz", "co.in", "com.cn", "com.mx", "co.za")


@dataclass(frozen=True)
class Reputation:
    """z: width of the posterior bound in deviations; rho: correlation where none can be measured."""

    z: float = 1.645
    max_rate: float = 0.5
    default_rho: float = 0.1


def url_parts(url: Column) -> tuple[Column, Column]:
    at = F.locate("://", url)
    rest = F.substring(url, at + 3, F.char_length(url))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.char_length(host) + 1, F.char_length(rest)), r"^[^?#]*", 0)
    known = url.isNotNull() & (at > 0)
    return (F.when(known, ascii_lower(host)).otherwise(""), F.when(known, path).otherwise(""))


def rule_of(host: Column, path: Column) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, text in sorted(RULES, key=lambda r: len(r[1])):
        at, _, rest = text.partition("/")
        fits = ((host == at) | host.endswith("." + at)) & path.startswith("/" + rest)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, said).otherwise(verdict)
    return rule, verdict


def domain_and_suffix(host: Column) -> tuple[Column, Column]:
    """Registered domain and public suffix; numeric addresses and single labels stand alone."""
    name = F.regexp_replace(host, r":[0-9]*$", "")
    tail = F.substring_index(name, ".", -2)
    long = tail.isin(*SECOND_LEVEL)
    alone = name.rlike(r"^[0-9.]*$") | ~name.contains(".")
    suffix = F.when(alone, "").when(long, tail).otherwise(F.substring_index(name, ".", -1))
    return F.when(alone, name).when(long, F.substring_index(name, ".", -3)).otherwise(tail), suffix


def shrink(children: DataFrame, parents: DataFrame, child: str, parent: str, p: Reputation) -> DataFrame:
    """Posterior of each child (n, bad) under the beta prior around its parent's rate.

    rho = (sum n (rate - prior)^2 / (prior (1 - prior)) - K) / sum (n - 1), within
    [0.001, 0.999], pooled over the K labelled children; prior strength m = 1 / rho - 1.
    """
    both = children.join(parents.select(parent, F.col("rate").alias("prior")), parent)
    var = F.col("prior") * (1 - F.col("prior"))
    seen = both.where("n > 0").agg(
        F.sum(F.col("n") * F.pow(F.col("bad") / F.col("n") - F.col("prior"), 2) / var).alias("s"),
        F.count("*").alias("k"), F.sum(F.col("n") - 1).alias("extra"))
    rho = F.when(F.col("extra") > 0, F.least(F.lit(0.999), F.greatest(
        F.lit(0.001), (F.col("s") - F.col("k")) / F.col("extra")))).otherwise(p.default_rho)
    out = both.crossJoin(F.broadcast(seen.select((1 / rho - 1).alias("m"))))  # one row
    a, b = F.col("m") * F.col("prior") + F.col("bad"), F.col("m") * (1 - F.col("prior")) + F.col("n") - F.col("bad")
    return out.select(*children.columns, (a / (a + b)).alias("rate"),
                      F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))).alias("sd"))


def host_reputation(outcomes: DataFrame, p: Reputation = Reputation()) -> DataFrame:
    """(host, n, bad, rate, low) for every host of `outcomes` (host, bad 0/1 or null)."""
    domain, suffix = domain_and_suffix(F.col("host"))
    hosts = materialise(
        outcomes.groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).cast("long").alias("bad"))
        .select("host", domain.alias("domain"), suffix.alias("suffix"), "n", "bad"), "hosts")
    counted = [F.sum("n").alias("n"), F.sum("bad").alias("bad")]
    domains = hosts.groupBy("domain", "suffix").agg(*counted)
    suffixes = domains.groupBy("suffix").agg(*counted).withColumn("all", F.lit(1))
    whole = suffixes.groupBy("all").agg(*counted).select("all", ((F.col("bad") + 1) / (F.col("n") + 2)).alias("rate"))
    by_suffix = shrink(suffixes, whole, "suffix", "all", p)
    by_domain = shrink(domains, by_suffix, "domain", "suffix", p)
    by_host = shrink(hosts, by_domain, "host", "domain", p)
    return by_host.select("host", "n", "bad", "rate", (F.col("rate") - p.z * F.col("sd")).alias("low"))


def page_outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(host, bad) per page: the label of the document whose number the path ends in."""
    host, path = url_parts(F.col("url"))
    number = F.try_to_number(F.nullif(F.regexp_extract(path, r"/([0-9]{1,18})(?:\.html|/)?$", 1), F.lit("")), F.lit("9" * 18))
    named = pages.select(host.alias("host"), number.cast("long").alias("doc"))
    known = F.col("quality").isNotNull() | F.col("toxic").isNotNull()
    bad = F.coalesce(F.col("quality") == 0, F.lit(False)) | F.coalesce(F.col("toxic") == 1, F.lit(False))
    marks = (labels.where(known & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("doc"))
             .agg(F.max(bad.cast("int")).alias("bad")))
    return named.join(marks, "doc", "left").select("host", "bad")


def url_filter(pages: DataFrame, labels: DataFrame, p: Reputation = Reputation()) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, and the host's posterior."""
    pages = pages.select("page_id", "url")
    seen = host_reputation(page_outcomes(pages, labels.select("doc_id", "quality", "toxic")), p)
    seen = materialise(seen, "reputation").select(F.col("host").alias("h"), "rate", "low")
    host, path = url_parts(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, said = rule_of(F.col("host"), F.col("path"))
    own = F.when(F.col("low") > p.max_rate, "block").otherwise("allow")
    return rows.join(seen, F.col("host") == F.col("h"), "left").select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(said, own).alias("verdict"),
        F.round("rate", 6).alias("bad_rate"), F.round("low", 6).alias("bad_rate_low"))


def _level(name: str, rows: str, parent: str, prior: str, keys: str) -> str:
    return f"""{name}_b AS (SELECT c.*, p.rate AS prior FROM {rows} c JOIN {prior} p ON c.{parent} = p.{parent}),
{name}_m AS (SELECT 1 / (CASE WHEN sum(n - 1) > 0 THEN least(0.999, greatest(0.001,
  (sum(n * power(bad / n - prior, 2) / (prior * (1 - prior))) - count(*)) / sum(n - 1))) ELSE 0.1 END) - 1 AS m
  FROM {name}_b WHERE n > 0),
{name} AS (SELECT {keys}, a / (a + b) AS rate, sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) AS sd
  FROM (SELECT *, m * prior + bad AS a, m * (1 - prior) + n - bad AS b FROM {name}_b, {name}_m))"""


HOSTS_SQL = rf"""
WITH u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS r FROM pages),
pg AS (SELECT page_id,
  coalesce(translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
  coalesce(regexp_extract(r, '^[^/?#]*([^?#]*)', 1), '') AS path FROM u),
lab AS (SELECT doc_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS bad FROM labels
  WHERE quality IS NOT NULL OR toxic IS NOT NULL GROUP BY doc_id),
o AS (SELECT host, bad FROM pg LEFT JOIN lab ON lab.doc_id =
  try_cast(regexp_extract(path, '/([0-9]{{1,18}})(\.html|/)?$', 1) AS BIGINT)),
hc AS (SELECT host, CASE WHEN host NOT LIKE '%.%' THEN host ELSE regexp_extract(host, '[^.]*\.[^.]*$') END AS domain,
  CASE WHEN host NOT LIKE '%.%' THEN '' ELSE regexp_extract(host, '[^.]*$') END AS suffix,
  count(bad) AS n, coalesce(sum(bad), 0) AS bad FROM o GROUP BY host),
dc AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM hc GROUP BY ALL),
sc AS (SELECT suffix, 1 AS al, sum(n) AS n, sum(bad) AS bad FROM dc GROUP BY suffix),
w AS (SELECT 1 AS al, (sum(bad) + 1) / (sum(n) + 2) AS rate FROM sc),
{_level("s", "sc", "al", "w", "suffix")},
{_level("dm", "dc", "suffix", "s", "domain")},
{_level("hp", "hc", "domain", "dm", "host")},
rl(said, rule) AS (VALUES {", ".join(f"('{v}', '{r}')" for v, r in RULES)}),
fit AS (SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(said, length(rule)) AS said FROM pg, rl
  WHERE (host = split_part(rule, '/', 1) OR ends_with(host, '.' || split_part(rule, '/', 1)))
    AND starts_with(path, substr(rule, strpos(rule, '/'))) GROUP BY page_id)
SELECT page_id, host, path, rule,
  coalesce(said, CASE WHEN rate - 1.645 * sd > 0.5 THEN 'block' ELSE 'allow' END) AS verdict,
  round(rate, 6) AS bad_rate, round(rate - 1.645 * sd, 6) AS bad_rate_low
FROM pg JOIN hp USING (host) LEFT JOIN fit USING (page_id)
"""
