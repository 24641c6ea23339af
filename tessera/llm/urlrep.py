"""URL filter by empirical-Bayes host reputation, with explicit rules first.

Labelled pages give every host a count of bad outcomes. Counts are shrunk level by level:
a suffix towards the overall rate, a registered domain towards its suffix, a host
towards its domain, each through a beta prior whose strength is the method-of-moments
estimate of the beta-binomial over that level. A url is blocked if the lower bound of its
host's posterior bad rate lies above a threshold; a host without labels has its domain's
posterior, and so on up. A suffix is the last label, or the last two where they are among
``SUFFIXES``, under which others register; a registered domain has one label more.
Reputation goes by the host without user, port and closing dot; the column ``host`` and the
rules keep them.

Cases: a null url, or one without ``://``, has an empty host and path, fits no rule and
takes the overall rate; labels that are null or of unknown pages count nowhere; without
any label every url that no rule blocks is allowed; hot hosts are counted by partial
aggregation and the tables of posteriors have one row per host.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import scratch

#: (verdict, host, path prefix)
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
#: Suffixes of two labels (a parameter; extend it with a public suffix list's entries).
SUFFIXES = (
    "ac.uk", "co.uk", "gov.uk", "ltd.uk", "me.uk", "org.uk", "com.au", "edu.au", "net.au", "org.au", "ac.jp", "co.jp", "ne.jp", "or.jp", "co.nz", "org.nz", "ac.in", "co.in", "org.in",
    "co.kr", "or.kr", "com.br", "org.br", "com.cn", "edu.cn", "org.cn", "com.mx", "com.tr", "co.za", "com.sg", "com.hk", "com.tw", "co.il", "blogspot.com", "github.io",
)
BLOCK_ABOVE = 0.3
Z = 1.6448536269514722
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; empty where there is no ``://``."""
    host = F.translate(F.regexp_extract(url, URL, 1), UPPER, LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, or null."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):  # later, longer ones win
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def with_levels(df: DataFrame, suffixes: tuple[str, ...] = SUFFIXES) -> DataFrame:
    """Site (host without user, port and closing dot), registered domain and suffix."""
    df = df.withColumn("site", F.regexp_replace("host", r"^.*@|:[0-9]*$|\.$", "")).withColumn("site", F.regexp_replace("site", r"\.$", ""))
    two = F.substring_index("site", ".", -2)
    long = two.isin(*suffixes)
    return df.withColumn("domain", F.when(long, F.substring_index("site", ".", -3)).otherwise(two)).withColumn("suffix", F.when(long, two).otherwise(F.substring_index("site", ".", -1)))


def strength(counts: DataFrame) -> Column:
    """Method-of-moments strength (alpha + beta) of a beta-binomial over groups with
    ``n`` trials and ``bad`` successes, as an aggregate expression."""
    n, x = F.sum("n"), F.sum("bad")
    p = x / n
    spread = F.sum(F.col("bad") * F.col("bad") / F.col("n")) - x * x / n  # sum n (p_i - p)^2
    k = F.count(F.lit(1)) - 1
    room = n - F.sum(F.col("n") * F.col("n")) / n - k
    rho = F.try_divide(spread - p * (1 - p) * k, p * (1 - p) * room)
    rho = F.greatest(F.least(F.coalesce(rho, F.lit(0.01)), F.lit(0.5)), F.lit(0.001))
    return 1 / rho - 1


def posteriors(outcomes: DataFrame) -> dict[str, DataFrame]:
    """``outcomes``: site, domain, suffix, bad (0 or 1). Per level the key, alpha, beta;
    under "all" the one row of overall rate and strengths."""
    host = outcomes.groupBy("site", "domain", "suffix").agg(F.count(F.lit(1)).alias("n"), F.sum("bad").alias("bad"))
    host = scratch(host, "hosts")
    domain = host.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffix = host.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    rate = (F.sum("bad") + 1) / (F.sum("n") + 2)  # null without labels: then nothing is blocked
    top = host.agg(rate.alias("rate"), strength(host).alias("m_host"))
    top = top.crossJoin(domain.agg(strength(domain).alias("m_domain"))).crossJoin(suffix.agg(strength(suffix).alias("m_suffix")))  # one row each
    top = scratch(top, "top")

    def shrunk(counts: DataFrame, mean: Column, m: str, key: str) -> DataFrame:
        return counts.select(key, (mean * F.col(m) + F.col("bad")).alias(f"a_{key}"), ((1 - mean) * F.col(m) + F.col("n") - F.col("bad")).alias(f"b_{key}"))

    mean = lambda key: F.col(f"a_{key}") / (F.col(f"a_{key}") + F.col(f"b_{key}"))
    one = F.broadcast(top)  # a single row
    s = shrunk(suffix.crossJoin(one), F.col("rate"), "m_suffix", "suffix")
    d = shrunk(domain.join(s, "suffix").crossJoin(one), mean("suffix"), "m_domain", "domain")
    h = shrunk(host.join(d, "domain").crossJoin(one), mean("domain"), "m_host", "site")
    return {"all": top, "suffix": s, "domain": d, "site": h}


def judge(pages: DataFrame, labels: DataFrame, rules=RULES, block_above: float = BLOCK_ABOVE, z: float = Z) -> DataFrame:
    """``pages``: page_id, url; ``labels``: page_id, bad (0 or 1). Adds host, path,
    rule, verdict and bad_bound, the posterior's lower bound."""
    host, path = parts(F.col("url"))
    pages = with_levels(pages.select("page_id", host.alias("host"), path.alias("path")))
    known = labels.where("bad IS NOT NULL").select(F.col("page_id").alias("l_id"), F.col("bad").cast("long").alias("bad"))
    p = posteriors(pages.join(known, pages["page_id"] == known["l_id"], "inner").where("site <> ''"))
    out = pages
    for key in ("site", "domain", "suffix"):
        out = out.join(p[key], key, "left")
    # m_suffix stands in for a suffix without labels: the overall prior itself
    out = out.crossJoin(F.broadcast(p["all"].select("rate", F.coalesce("m_suffix", F.lit(99.0)).alias("m"))))
    a = F.coalesce("a_site", "a_domain", "a_suffix", F.col("rate") * F.col("m"))
    b = F.coalesce("b_site", "b_domain", "b_suffix", (1 - F.col("rate")) * F.col("m"))
    bound = a / (a + b) - z * F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))
    rule, kind = rule_of(F.col("host"), F.col("path"), rules)
    verdict = F.coalesce(kind, F.when(bound > block_above, "block").otherwise("allow"))
    return out.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("verdict"), bound.alias("bad_bound"))


def op8_url_reputation(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select(F.col("doc_id").alias("page_id"), (F.col("quality") == 0).cast("int").alias("bad"))
    return judge(pages, labels).drop("bad_bound")


_MEAN = "(a_{0} / (a_{0} + b_{0}))"
_MOMENTS = """(SELECT 1 / greatest(least(coalesce((spread - p * (1 - p) * k) / nullif(p * (1 - p) * room, 0), 0.01::DOUBLE), 0.5::DOUBLE), 0.001::DOUBLE) - 1
  FROM (SELECT sum(bad)::DOUBLE / sum(n) AS p, sum(bad * bad / n::DOUBLE) - sum(bad)::DOUBLE * sum(bad) / sum(n) AS spread, count(*) - 1 AS k,
        sum(n) - sum(n * n)::DOUBLE / sum(n) - (count(*) - 1) AS room FROM {0}))"""
SQL = f"""
WITH p AS (
  SELECT page_id, coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), '{UPPER}', '{LOWER}'), '') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages),
sites AS (SELECT *, regexp_replace(regexp_replace(host, '^.*@|:[0-9]*$|\\.$', '', 'g'), '\\.$', '') AS site FROM p),
pairs AS (SELECT *, array_to_string(list_slice(string_split(site, '.'), -2, -1), '.') AS two FROM sites),
l AS (
  SELECT *, CASE WHEN two IN {SUFFIXES} THEN array_to_string(list_slice(string_split(site, '.'), -3, -1), '.') ELSE two END AS domain,
         CASE WHEN two IN {SUFFIXES} THEN two ELSE string_split(site, '.')[-1] END AS suffix FROM pairs),
hosts AS (
  SELECT site, domain, suffix, count(*) AS n, CAST(sum(CASE WHEN quality = 0 THEN 1 ELSE 0 END) AS BIGINT) AS bad
  FROM l JOIN labels ON l.page_id = labels.doc_id WHERE quality IS NOT NULL AND site <> '' GROUP BY ALL),
domains AS (SELECT domain, suffix, CAST(sum(n) AS BIGINT) AS n, CAST(sum(bad) AS BIGINT) AS bad FROM hosts GROUP BY ALL),
suffixes AS (SELECT suffix, CAST(sum(n) AS BIGINT) AS n, CAST(sum(bad) AS BIGINT) AS bad FROM hosts GROUP BY ALL),
top AS (SELECT (sum(bad) + 1)::DOUBLE / (sum(n) + 2) AS rate, {_MOMENTS.format("hosts")} AS m_host,
        {_MOMENTS.format("domains")} AS m_domain, {_MOMENTS.format("suffixes")} AS m_suffix FROM hosts),
s AS (SELECT suffix, rate * m_suffix + bad AS a_suffix, (1 - rate) * m_suffix + n - bad AS b_suffix FROM suffixes, top),
d AS (SELECT domain, {_MEAN.format("suffix")} * m_domain + bad AS a_domain, (1 - {_MEAN.format("suffix")}) * m_domain + n - bad AS b_domain
      FROM domains JOIN s USING (suffix), top),
h AS (SELECT site, {_MEAN.format("domain")} * m_host + bad AS a_site, (1 - {_MEAN.format("domain")}) * m_host + n - bad AS b_site
      FROM hosts JOIN d USING (domain), top),
j AS (
  SELECT page_id, host, path, coalesce(a_site, a_domain, a_suffix, rate * coalesce(m_suffix, 99)) AS a,
         coalesce(b_site, b_domain, b_suffix, (1 - rate) * coalesce(m_suffix, 99)) AS b,
         CASE WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
              WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
              WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
              WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM l LEFT JOIN h USING (site) LEFT JOIN d USING (domain) LEFT JOIN s USING (suffix), top)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
            WHEN a / (a + b) - {Z}::DOUBLE * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) > {BLOCK_ABOVE}::DOUBLE THEN 'block' ELSE 'allow' END AS verdict
FROM j
"""
