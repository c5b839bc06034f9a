"""URL filters: host rules, then an empirical-Bayes reputation of hosts.

Rules block or allow a host with all its subdomains and a path prefix; the longest
rule that fits decides. Every other url is judged by its host. Labelled outcomes of
pages (good or bad) are counted per host, and shrunk level by level: the corpus mean
is the prior of the suffixes, a suffix's posterior mean that of its registered
domains, a domain's that of its hosts. The strength of each prior is the
beta-binomial moment estimate of that level's overdispersion. A host's share of good
pages then has a beta posterior, and the host is blocked when the ``CONFIDENCE``
quantile of it is under ``least_good``. A host without labels (n = 0) has the prior of
its domain, or else its suffix or the corpus, and is judged by the same quantile.
A page row brings its own host and outcome: pages are never joined to pages, so repeated
and null page ids count once a row.

The quantile test is P(share < least_good) >= CONFIDENCE, summed over ``POINTS`` equal
steps of t, where share = sin(t) squared (which takes the poles of the density away); the
density's largest logarithm is known in closed form, so each point is visited once.

All steps are DataFrame operations: one narrow scan, a partially aggregated count
per host, joins of the (stored) counts by domain and suffix, and one join of the
pages with the verdicts of their hosts whose hot hosts Spark splits. The driver
gets three sums of each level.

The suffix is the last label of a host, or the last two when the last has two
letters and the one before is a generic label (``GENERIC``); an address of digits
is its own domain. Edge cases: null urls and urls without ``://`` have an empty
host and path and are judged as the host ""; pages without labels only make their host known; a
page labelled twice counts twice, repeated pages are judged alike; without any label all priors
stay at one half good and nothing is blocked by the method; very long urls are matched
whole; counts are multiplied as decimals, so hosts of any size are safe. Extra columns
are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, stored, table

#: (verdict, host, path prefix): the contract's rules.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
#: Second-level labels under two-letter domains that are part of a suffix: fixed values.
GENERIC = ("ac", "co", "com", "edu", "gov", "net", "org")
LEAST_GOOD, CONFIDENCE, POINTS = 0.5, 0.95, 400


def host_of(url: Column) -> Column:
    after = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(ascii_lower(after), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def suffix_of(host: Column) -> Column:
    part = F.split(host, r"\.")
    last, before = F.element_at(part, -1), F.try_element_at(part, F.lit(-2))
    two = (F.length(last) == 2) & before.isin(*GENERIC) & (F.size(part) > 2)
    return F.when(host.rlike(r"^[0-9.]+$"), host).when(two, F.concat(before, F.lit("."), last)).otherwise(last)


def domain_of(host: Column, suffix: Column) -> Column:
    labels = F.size(F.split(suffix, r"\.")) + 1
    part = F.split(host, r"\.")
    return F.when(host == suffix, host).otherwise(F.array_join(F.slice(part, F.greatest(F.size(part) - labels + 1, F.lit(1)), labels), "."))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits (as host and path), and its verdict; nulls without one."""
    name = verdict = F.lit(None).cast("string")
    for kind, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):  # later ones override
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, h + p).otherwise(name), F.when(fits, kind).otherwise(verdict)
    return name, verdict


def _low_points(least_good: float) -> int:
    return sum(math.sin((k - 0.5) / POINTS * math.pi / 2) ** 2 < least_good for k in range(1, POINTS + 1))


def beta_below(a: Column, b: Column, least_good: float) -> Column:
    """P(x < least_good) of a beta distribution (a, b > 0)."""
    at = [(k - 0.5) * math.pi / 2 / POINTS for k in range(1, POINTS + 1)]
    points = [F.struct(F.lit(math.log(math.sin(t))).alias("s"), F.lit(math.log(math.cos(t))).alias("c")) for t in at]
    u, v = 2 * a - 1, 2 * b - 1
    value = lambda t: u * math.log(math.sin(t)) + v * math.log(math.cos(t))
    inside = u / 2 * F.ln(u / (u + v)) + v / 2 * F.ln(v / (u + v))
    top = F.when((u > 0) & (v > 0), inside).otherwise(F.greatest(value(at[0]), value(at[-1])))
    total = lambda some: F.aggregate(F.array(*some), F.lit(0.0), lambda s, x: s + F.exp(u * x["s"] + v * x["c"] - top))
    low = _low_points(least_good)
    return F.coalesce(1 / (1 + F.try_divide(total(points[low:]), total(points[:low]))), F.lit(0.0))


def _level(counts: DataFrame, key: str, parent: str | None, mean: float) -> DataFrame:
    """key, (parent,) n, good, prior, post: the posterior mean under this level's prior."""
    m = F.lit(mean) if parent is None else F.col("prior")
    excess = F.when(F.col("n") > 0, (F.col("good") - F.col("n") * m) * (F.col("good") - F.col("n") * m) / (m * (1 - m)))
    # Sums of decimals: the same result in any order of the rows.
    total = counts.select(F.sum(excess.cast("decimal(38,9)")).alias("z"), F.sum("n").alias("n"), F.sum(F.col("n").cast("decimal(19,0)") * (F.col("n") - 1).cast("decimal(19,0)")).cast("double").alias("pairs")).first()
    z, n, pairs = (float(x or 0) for x in total)
    spread = min(max((z - n) / pairs if pairs else 0.01, 0.001), 0.5)
    strength = 1 / spread - 1
    return counts.withColumn("prior_mean", m.cast("double")).withColumn("strength", F.lit(strength)).withColumn("post", (F.col("good") + strength * m) / (F.col("n") + strength))


def host_reputation(outcomes: DataFrame, least_good: float = LEAST_GOOD) -> DataFrame:
    """outcomes: host, good (0, 1, or null: unlabelled), pages (rows that it stands for). Returns host, domain, suffix, n, good, post, below.

    post is the posterior mean of the share of good pages, below the probability that the share is under least_good.
    """
    suffix = suffix_of(F.col("host"))
    hosts = outcomes.groupBy("host").agg(
        F.coalesce(F.sum(F.when(F.col("good").isNotNull(), F.col("pages"))), F.lit(0)).alias("n"), F.coalesce(F.sum(F.col("good").cast("long") * F.col("pages")), F.lit(0)).alias("good")
    )
    hosts = stored(hosts.withColumn("suffix", suffix).withColumn("domain", domain_of(F.col("host"), F.col("suffix"))), "hosts")
    sums = (F.sum("n").alias("n"), F.sum("good").alias("good"))
    domains = stored(hosts.groupBy("domain", "suffix").agg(*sums), "domains")
    suffixes = stored(domains.groupBy("suffix").agg(*sums), "suffixes")
    n, good = (float(x or 0) for x in suffixes.select(F.sum("n"), F.sum("good")).first())
    mean = (good + 1) / (n + 2)
    s = _level(suffixes, "suffix", None, mean)
    d = _level(stored(domains.join(s.select("suffix", F.col("post").alias("prior")), "suffix"), "domain-priors"), "domain", "suffix", mean)
    h = _level(stored(hosts.join(d.select("domain", "suffix", F.col("post").alias("prior")), ["domain", "suffix"]), "host-priors"), "host", "domain", mean)
    ab = h.withColumn("a", F.col("good") + F.col("strength") * F.col("prior")).withColumn("b", F.col("n") - F.col("good") + F.col("strength") * (1 - F.col("prior")))
    return ab.select("host", "domain", "suffix", "n", "good", "post", beta_below(F.col("a"), F.col("b"), least_good).alias("below"))


def outcomes_of(pages: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """host, good, pages: pages (url and the key) counted by host and key, then labelled (labels: key, good).

    Rows are counted before they meet the labels, so a key that a third of the pages share is one row a host.
    """
    counted = pages.groupBy(host_of(F.col("url")).alias("host"), key).agg(F.count(F.lit(1)).alias("pages"))
    return counted.join(labels.select(key, "good"), key, "left").select("host", "good", "pages")


def judge(pages: DataFrame, outcomes: DataFrame, rules=RULES, least_good: float = LEAST_GOOD) -> DataFrame:
    """pages: page_id, url; outcomes: host, good, pages (``outcomes_of``; the hosts of all pages). One row per page."""
    urls = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    bad = stored(host_reputation(outcomes, least_good).select("host", "post", "below"), "reputation")
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("below") >= CONFIDENCE, "block").otherwise("allow")
    return urls.join(bad, "host", "left").select("page_id", "host", "path", name.alias("rule"), F.coalesce(verdict, own).alias("verdict"))


#: The number after the language in a page's path names the document that the page shows.
DOCUMENT = r"://[^/?#]*/[a-z]+/(\d{1,18})(?:[^0-9]|$)"


def op1_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's labelled outcome is the quality label of the document that it shows."""
    pages = table(spark, sf_dir, "pages")
    shown = pages.select("url", F.regexp_extract("url", DOCUMENT, 1).try_cast("bigint").alias("doc_id"))
    return judge(pages, outcomes_of(shown, table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("good")), "doc_id"))


def _sql_level(name: str, source: str, prior: str) -> str:
    return f"""
{name}_fit as materialized (
  select 1 / least(greatest(coalesce((z - n) / nullif(pairs, 0), 0.01), 0.001), 0.5) - 1 as strength from (
    select coalesce(sum(cast((good - n * {prior}) * (good - n * {prior}) / ({prior} * (1 - {prior})) as decimal(38, 9))), 0)::double as z,
      coalesce(sum(n), 0)::double as n, coalesce(sum(n * (n - 1)), 0)::double as pairs from {source})),
{name}_post as materialized (select t.*, f.strength, (good + f.strength * {prior}) / (n + f.strength) as post from {source} t, {name}_fit f)"""


SQL_OP1 = rf"""
with u as (
  select page_id, coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as path, try_cast(regexp_extract(url, '{DOCUMENT}', 1) as bigint) as shown from pages),
hosts0 as (
  select host, count(quality)::bigint as n, coalesce(sum(quality), 0)::bigint as good from u left join labels on shown = doc_id group by host),
hosts1 as (
  select *, string_split(host, '.') as part from hosts0),
hosts2 as (
  select *, case when regexp_matches(host, '^[0-9.]+$') then host
    when length(part[-1]) = 2 and len(part) > 2 and part[-2] in ('ac', 'co', 'com', 'edu', 'gov', 'net', 'org') then part[-2] || '.' || part[-1]
    else part[-1] end as suffix from hosts1),
hosts as materialized (
  select host, n, good, suffix, case when host = suffix then host else array_to_string(part[greatest(len(part) - len(string_split(suffix, '.')), 1):], '.') end as domain from hosts2),
domains as materialized (select domain, suffix, sum(n)::bigint as n, sum(good)::bigint as good from hosts group by all),
suffixes as materialized (
  select suffix, n, good, (sum(good) over () + 1) / (sum(n) over () + 2)::double as prior from (
    select suffix, sum(n)::bigint as n, sum(good)::bigint as good from domains group by all)),
{_sql_level("s", "suffixes", "prior")},
d_in as materialized (select d.*, s.post as prior from domains d join s_post s using (suffix)),
{_sql_level("d", "d_in", "prior")},
h_in as materialized (select h.*, d.post as prior from hosts h join d_post d using (domain, suffix)),
{_sql_level("h", "h_in", "prior")},
logs as (select host, list_transform(range(1, {POINTS} + 1), lambda k: (2 * (good + strength * prior) - 1) * ln(sin((k - 0.5) * {math.pi / 2 / POINTS!r})) + (2 * (n - good + strength * (1 - prior)) - 1) * ln(cos((k - 0.5) * {math.pi / 2 / POINTS!r}))) as l from h_post),
weights as (select host, list_transform(l, lambda x: exp(x - list_max(l))) as w from logs),
judged as (select host, list_sum(w[1:{_low_points(LEAST_GOOD)}]) / list_sum(w) as below from weights),
ruled as (
  select page_id, u.host, path, below, case
    when (u.host = 'example.net' or ends_with(u.host, '.example.net')) and starts_with(path, '/en/') then 'example.net/en/'
    when (u.host = 'example.com' or ends_with(u.host, '.example.com')) and starts_with(path, '/de/') then 'example.com/de/'
    when (u.host = 'org' or ends_with(u.host, '.org')) and starts_with(path, '/fr/') then 'org/fr/'
    when (u.host = 'net' or ends_with(u.host, '.net')) and starts_with(path, '/') then 'net/' end as rule
  from u left join judged using (host))
select page_id, host, path, rule, case when rule in ('example.net/en/', 'org/fr/') then 'allow'
  when rule is not null then 'block' when below >= {CONFIDENCE} then 'block' else 'allow' end as verdict
from ruled
"""
