"""URL filter: explicit rules first, then empirical-Bayes host reputation.

A host's rate of bad pages is a beta-binomial posterior whose prior mean is the
posterior mean of its registered domain, whose prior mean is that of the suffix,
whose prior mean is that of all labelled pages. How strongly each level is drawn
to its parent is estimated from the labelled pages by moments. A host is blocked
when even the lower bound of its bad rate is above the threshold, so a host with
little evidence is never blocked on its own few pages.

Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowgate.llm.frames import joined, read, with_columns, written

# (verdict, rule): a rule is a host and the start of a path.
RULES = (
    ("block", "net/"),
    ("allow", "example.net/en/"),
    ("block", "example.com/de/"),
    ("allow", "org/fr/"),
)
# Suffixes of more than one label below which domains are registered.
LONG_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "co.jp", "com.br")
# Standard deviations below the posterior mean; one-sided 95 %.
BOUND = 1.645
# A host is blocked when its bad rate is at least this with that confidence.
WORST_RATE = 0.5
# Range of the correlation among a parent's children; the upper end is a prior worth two
# pages, as weak as a prior gets here however different the labelled hosts are.
LEAST_RATIO, MOST_RATIO = 0.001, 1 / 3
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#``; empty without one or for null."""
    host = F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?`` or ``#``; empty where there is no host part."""
    path = F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1)
    return F.coalesce(path, F.lit(""))


def suffix_of(host: Column) -> Column:
    long = F.regexp_extract(host, r"([^.]*\.[^.]*)\z", 1)
    return F.when(long.isin(*LONG_SUFFIXES), long).otherwise(
        F.regexp_extract(host, r"([^.]*)\z", 1)
    )


def domain_of(host: Column, suffix: Column) -> Column:
    """The suffix and one label more; the host itself when it has no more."""
    rest = F.expr("substring(host, 1, length(host) - length(suffix) - 1)")
    label = F.regexp_extract(rest, r"([^.]*)\z", 1)
    return F.when(F.length(host) <= F.length(suffix), host).otherwise(
        F.concat(label, F.lit("."), suffix)
    )


def fits(rule: str, host: Column, path: Column) -> Column:
    name, start = rule[: rule.index("/")], rule[rule.index("/") :]
    return ((host == name) | host.endswith(f".{name}")) & path.startswith(start)


def rule_for(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, else null."""
    ordered = sorted((rule for _, rule in rules), key=len, reverse=True)
    if not ordered:
        return F.lit(None).cast("string")
    return F.coalesce(*(F.when(fits(rule, host, path), F.lit(rule)) for rule in ordered))


def strength(level: DataFrame) -> float:
    """Pseudo-pages of a level's prior, by moments.

    For (pages, bad, prior): a child's squared deviation from its prior mean is
    v(1 + (n - 1) r) / n in expectation with v = prior(1 - prior); r gives 1/r - 1.
    Two sums reach the driver.
    """
    n, v = F.col("pages"), F.col("prior") * (1 - F.col("prior"))
    off = n * F.pow(F.col("bad") / n - F.col("prior"), F.lit(2))
    sums = level.filter("pages > 0").agg(F.sum(off - v), F.sum((n - 1) * v)).first()
    ratio = sums[0] / sums[1] if sums[1] else 0.0
    return 1.0 / min(max(ratio, LEAST_RATIO), MOST_RATIO) - 1.0


def shrunk(level: DataFrame) -> DataFrame:
    """Adds ``alpha``, ``beta`` and ``mean`` of the posterior to (pages, bad, prior)."""
    weight = F.lit(strength(level))
    alpha = F.col("bad") + weight * F.col("prior")
    beta = F.col("pages") - F.col("bad") + weight * (1 - F.col("prior"))
    return level.withColumns({"alpha": alpha, "beta": beta}).withColumn(
        "mean", F.col("alpha") / (F.col("alpha") + F.col("beta"))
    )


def reputations(pages: DataFrame, outcomes: DataFrame) -> DataFrame:
    """One row per host of (host, page_id): pages, bad, posterior mean and bound.

    ``outcomes`` is (page_id, is_bad); a page with several outcomes is bad if one
    is. Hosts without labelled pages get what their domain or suffix is known for.
    """
    known = outcomes.filter("page_id is not null and is_bad is not null")
    known = known.groupBy("page_id").agg(F.max("is_bad").alias("is_bad"))
    seen = pages.select("page_id", "host").join(known, "page_id", "left")
    hosts = seen.groupBy("host").agg(
        F.count("is_bad").alias("pages"), F.count_if("is_bad").alias("bad")
    )
    hosts = hosts.withColumn("suffix", suffix_of(F.col("host")))
    hosts = hosts.withColumn("domain", domain_of(F.col("host"), F.col("suffix")))
    hosts = written(hosts, "hosts")

    def summed(*by: str) -> DataFrame:
        return hosts.groupBy(*by).agg(F.sum("pages").alias("pages"), F.sum("bad").alias("bad"))

    total = hosts.agg(F.sum("pages"), F.sum("bad")).first()
    overall = ((total[1] or 0) + 1.0) / ((total[0] or 0) + 2.0)
    suffixes = written(shrunk(summed("suffix").withColumn("prior", F.lit(overall))), "suffixes")
    priors = suffixes.select("suffix", F.col("mean").alias("prior"))
    domains = written(
        shrunk(summed("suffix", "domain").join(priors, "suffix")), "domains"
    )
    priors = domains.select("domain", F.col("mean").alias("prior"))
    judged = shrunk(hosts.join(priors, "domain"))
    spread = F.sqrt(
        F.col("alpha") * F.col("beta")
        / (F.pow(F.col("alpha") + F.col("beta"), F.lit(2)) * (F.col("alpha") + F.col("beta") + 1))
    )
    return judged.select(
        "host", "domain", "suffix", F.col("pages").alias("labelled"), "bad",
        F.col("mean").alias("bad_rate"), (F.col("mean") - BOUND * spread).alias("bad_rate_bound"),
    )


def judged(pages: DataFrame, outcomes: DataFrame, rules=RULES) -> DataFrame:
    """``pages`` plus host, path, rule, verdict and the host's reputation.

    Columns of ``pages`` with these names give way. A null url, or one without
    ``://``, has an empty host and path, and is judged as that host. Pages with a
    null page_id are judged but carry no label. A very long url is parsed whole.
    """
    placed = with_columns(pages, host=host_of(F.col("url")), path=path_of(F.col("url")))
    placed = with_columns(placed, rule=rule_for(F.col("host"), F.col("path"), rules))
    known = reputations(placed, outcomes).withColumnRenamed("host", "_host")
    known = written(known.select("_host", "labelled", "bad", "bad_rate", "bad_rate_bound"), "known")
    out = joined(
        placed.drop("labelled", "bad", "bad_rate", "bad_rate_bound", "verdict"),
        known, F.col("host") == F.col("_host"), "left",
    )
    by_rule = F.create_map(*(F.lit(x) for verdict, rule in rules for x in (rule, verdict)))
    own = F.when(F.col("bad_rate_bound") >= WORST_RATE, "block").otherwise("allow")
    verdict = F.coalesce(by_rule[F.col("rule")], own) if rules else own
    return out.withColumn("verdict", verdict).drop("_host")


def op9_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's verdict.

    A labelled page is one whose id is in ``labels``; it is bad if it is toxic or
    of low quality.
    """
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    labels = read(spark, sf_dir, "labels")
    toxic, poor = F.col("toxic") == 1, F.col("quality") == 0
    outcomes = labels.select(
        F.col("doc_id").alias("page_id"),
        F.when(toxic | poor, True)
        .when(F.col("toxic").isNotNull() | F.col("quality").isNotNull(), False)
        .alias("is_bad"),
    )
    return judged(pages, outcomes).select(
        "page_id", "host", "path", "rule", "verdict", "labelled", "bad",
        F.round("bad_rate", 6).alias("bad_rate"),
        F.round("bad_rate_bound", 6).alias("bad_rate_bound"),
    )


def _strength_sql(level: str) -> str:
    return f"""(SELECT 1.0 / least(greatest(coalesce(
      sum(pages * pow(bad / pages - prior, 2) - prior * (1 - prior))
      / nullif(sum((pages - 1) * prior * (1 - prior)), 0), 0), {LEAST_RATIO}), {MOST_RATIO!r}) - 1.0
      FROM {level} WHERE pages > 0)"""


def _posterior_sql(level: str) -> str:
    return f"""SELECT *, alpha / (alpha + beta) AS mean FROM (
      SELECT *, bad + s * prior AS alpha, pages - bad + s * (1 - prior) AS beta
      FROM (SELECT *, {_strength_sql(level)} AS s FROM {level}))"""


def _rule_sql() -> str:
    cases = []
    for _, rule in sorted(RULES, key=lambda x: -len(x[1])):
        name, start = rule[: rule.index("/")], rule[rule.index("/") :]
        cases.append(
            f"WHEN (host = '{name}' OR suffix(host, '.{name}')) AND prefix(path, '{start}') "
            f"THEN '{rule}'"
        )
    return f"CASE {' '.join(cases)} END"


OP9_SQL = f"""
WITH placed AS (
  SELECT page_id,
    coalesce(translate(regexp_extract(url, '(?s)\\A.*?://([^/?#]*)', 1), '{UPPER}', '{LOWER}'), '')
      AS host,
    coalesce(regexp_extract(url, '(?s)\\A.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), ruled AS (SELECT *, {_rule_sql()} AS rule FROM placed
), known AS (
  SELECT doc_id AS page_id, max(CASE WHEN toxic = 1 OR quality = 0 THEN 1
    WHEN toxic IS NOT NULL OR quality IS NOT NULL THEN 0 END) AS is_bad
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), hosts0 AS (
  SELECT host, count(is_bad)::DOUBLE AS pages, coalesce(sum(is_bad), 0)::DOUBLE AS bad,
    CASE WHEN regexp_extract(host, '([^.]*\\.[^.]*)$', 1) IN {LONG_SUFFIXES}
      THEN regexp_extract(host, '([^.]*\\.[^.]*)$', 1)
      ELSE regexp_extract(host, '([^.]*)$', 1) END AS suffix
  FROM ruled LEFT JOIN known USING (page_id) GROUP BY host
), hosts AS (
  SELECT *, CASE WHEN length(host) <= length(suffix) THEN host ELSE
    regexp_extract(substr(host, 1, length(host) - length(suffix) - 1), '([^.]*)$', 1)
      || '.' || suffix END AS domain
  FROM hosts0
), suffixes0 AS (
  SELECT suffix, sum(pages) AS pages, sum(bad) AS bad,
    (SELECT (coalesce(sum(bad), 0) + 1.0) / (coalesce(sum(pages), 0) + 2.0) FROM hosts) AS prior
  FROM hosts GROUP BY suffix
), suffixes AS ({_posterior_sql("suffixes0")}
), domains0 AS (
  SELECT h.suffix, h.domain, sum(h.pages) AS pages, sum(h.bad) AS bad, s.mean AS prior
  FROM hosts h JOIN suffixes s USING (suffix) GROUP BY ALL
), domains AS ({_posterior_sql("domains0")}
), judged0 AS (
  SELECT h.host, h.pages, h.bad, d.mean AS prior FROM hosts h JOIN domains d USING (domain)
), judged AS (
  SELECT host, pages, bad, mean AS bad_rate, mean - {BOUND} * sqrt(alpha * beta
    / (pow(alpha + beta, 2) * (alpha + beta + 1))) AS bound
  FROM ({_posterior_sql("judged0")})
)
SELECT r.page_id, r.host, r.path, r.rule,
  CASE {" ".join(f"WHEN r.rule = '{rule}' THEN '{verdict}'" for verdict, rule in RULES)}
    WHEN j.bound >= {WORST_RATE} THEN 'block' ELSE 'allow' END AS verdict,
  j.pages::BIGINT AS labelled, j.bad::BIGINT AS bad,
  round(j.bad_rate, 6) AS bad_rate, round(j.bound, 6) AS bad_rate_bound
FROM ruled r LEFT JOIN judged j ON r.host = j.host
"""

QUERIES = {"op9_url_reputation": op9_url_reputation}
SQL = {"op9_url_reputation": OP9_SQL}
