"""URL filter: rules first, else empirical-Bayes reputation of the host.

Labelled outcomes of pages are counted per host, registered domain and suffix. Beta-binomial priors pass down: the
suffix is shrunk to the overall rate, the domain to its suffix, the host to its domain; each level's prior strength
comes from the spread of the rates at that level. A host is blocked if the lower bound of its posterior rate of bad
pages is above a threshold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import LOWER, UPPER, ascii_lower
from tickloom.plans.sizing import lookup_side

# The rules of the contract.
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
# Public suffixes of two labels that are treated as one suffix.
TWO_LABEL_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "co.jp", "com.br", "co.nz", "co.in", "com.mx")
BAD_RATE = 0.5
Z = 1.64

HOST_PATTERN = r"(?s)^.*?://([^/?#]*)"
PATH_PATTERN = r"(?s)^.*?://[^/?#]*([^?#]*)"


def host_of(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(url, HOST_PATTERN, 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PATH_PATTERN, 1), F.lit(""))


def matched_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> Column:
    """The longest rule that fits, as struct (verdict, rule), or null."""
    found = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        at, slash, rest = rule.partition("/")
        fits = ((host == at) | host.endswith(f".{at}")) & path.startswith(slash + rest)
        found = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))).otherwise(found)
    return found


def domain_of(host: Column) -> Column:
    """Registered domain: the suffix and one label before it."""
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*TWO_LABEL_SUFFIXES), F.substring_index(host, ".", -3)).otherwise(two)


def suffix_of(host: Column) -> Column:
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*TWO_LABEL_SUFFIXES), two).otherwise(F.substring_index(host, ".", -1))


def strength(groups: DataFrame) -> DataFrame:
    """One row: prior strength ``m`` of the groups' rates and the overall rate ``p``, by moments of (n, bad) per group.

    The share of variance between groups is held between 0.001 and 0.5, so ``m`` lies between 1 and 999.
    """
    sums = groups.where("n > 0").agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("double").alias("n"),
        F.coalesce(F.sum("bad"), F.lit(0)).cast("double").alias("b"),
        F.count("*").cast("double").alias("k"),
        F.coalesce(F.sum(F.col("n") * F.col("n")), F.lit(0)).cast("double").alias("nn"),
        F.coalesce(F.sum(F.col("bad") * F.col("bad") / F.col("n")), F.lit(0.0)).alias("s"),
    )
    return sums.select(F.expr("(b + 1) / (n + 2)").alias("p"), F.expr(STRENGTH_SQL).alias("m"))


# Shared by both engines: the same moments give the same strength.
STRENGTH_SQL = """round(1 / least(0.5, greatest(0.001, coalesce(
  (s - b * b / nullif(n, 0) - (b + 1) / (n + 2) * (n - b + 1) / (n + 2) * (k - 1))
  / nullif((b + 1) / (n + 2) * (n - b + 1) / (n + 2) * (n - nn / nullif(n, 0) - (k - 1)), 0), 0.001))) - 1, 6)"""


def host_reputation(outcomes: DataFrame, z: float = Z) -> DataFrame:
    """Posterior of every host from rows (host, bad) with ``bad`` 0, 1 or null (unlabelled).

    Returns host, n, bad, rate (posterior mean) and lower (mean less ``z`` deviations). Counts are combined before the
    shuffle, so a host with a third of the pages costs no more than another.
    """
    host = outcomes.groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    host = host.select("host", "n", "bad", domain_of(F.col("host")).alias("domain"), suffix_of(F.col("host")).alias("suffix"))
    domain = host.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffix = domain.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    # Scalar subqueries of one row each.
    m_suffix, m_domain, m_host = (strength(t).select("m").scalar() for t in (suffix, domain, host))
    p = strength(suffix).select("p").scalar()
    n, bad, above = F.col("n"), F.col("bad"), F.col("above")
    suffix = suffix.select("suffix", ((bad + m_suffix * p) / (n + m_suffix)).alias("above"))
    domain = domain.join(lookup_side(suffix), "suffix")
    domain = domain.select("domain", "suffix", ((bad + m_domain * above) / (n + m_domain)).alias("above"))
    host = host.join(domain, ["domain", "suffix"])
    host = host.select("host", "n", "bad", (bad + m_host * above).alias("a"), (n - bad + m_host * (1 - above)).alias("b"))
    rate = F.col("a") / (F.col("a") + F.col("b"))
    deviation = F.sqrt(rate * (1 - rate) / (F.col("a") + F.col("b") + 1))
    return host.select("host", "n", "bad", rate.alias("rate"), (rate - z * deviation).alias("lower"))


def url_verdicts(
    pages: DataFrame,
    labels: DataFrame,
    rules: Sequence[tuple[str, str]] = RULES,
    bad_rate: float = BAD_RATE,
    z: float = Z,
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """page_id, host, path, rule, verdict, and the host's posterior rate and lower bound, one row per page.

    A page's outcome is the label row with its id; it is bad if any such row has quality 0 or toxic 1. Rules win over
    reputation. Null urls and urls without ``://`` have an empty host and path, share one reputation and fit no rule;
    repeated pages each keep a row; null ids have no label; without labels every host has the prior and is allowed; an
    empty table gives an empty result; further columns are not read.
    """
    verdicts = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("_label_id")).agg(
        F.max(F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).when(F.col("quality").isNull() & F.col("toxic").isNull(), None).otherwise(0)).alias("bad")
    )
    url = F.col(f"`{url_col}`")
    rows = pages.select(F.col(f"`{id_col}`").alias("_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    outcomes = rows.select("_id", "host").join(verdicts, F.col("_id") == F.col("_label_id"), "left").select("host", "bad")
    reputation = host_reputation(outcomes, z).select("host", "rate", "lower")
    out = rows.withColumn("_rule", matched_rule(F.col("host"), F.col("path"), rules)).join(lookup_side(reputation), "host", "left")
    by_host = F.when(F.col("lower") > bad_rate, "block").otherwise("allow")
    return out.select(
        F.col("_id").alias(id_col), "host", "path", F.col("_rule.rule").alias("rule"),
        F.coalesce(F.col("_rule.verdict"), by_host).alias("verdict"), "rate", "lower",
    )


def _sql() -> str:
    """The same verdicts as one DuckDB statement."""
    fits, rank = [], sorted(RULES, key=lambda r: (-len(r[1]), r[1]))
    for verdict, rule in rank:
        at, slash, rest = rule.partition("/")
        fits.append((f"(host = '{at}' OR ends_with(host, '.{at}')) AND starts_with(path, '{slash}{rest}')", verdict, rule))
    rule_case = "CASE " + " ".join(f"WHEN {c} THEN '{r}'" for c, _, r in fits) + " END"
    verdict_case = "CASE " + " ".join(f"WHEN {c} THEN '{v}'" for c, v, _ in fits) + f" WHEN lower > {BAD_RATE} THEN 'block' ELSE 'allow' END"
    two = "array_to_string(list_slice(string_split(host, '.'), -2, -1), '.')"
    three = "array_to_string(list_slice(string_split(host, '.'), -3, -1), '.')"
    known = ", ".join(f"'{s}'" for s in TWO_LABEL_SUFFIXES)
    moments = lambda t: f"""SELECT (b + 1) / (n + 2) AS p, {STRENGTH_SQL} AS m FROM (SELECT coalesce(sum(n), 0)::DOUBLE AS n,
  coalesce(sum(bad), 0)::DOUBLE AS b, count(*)::DOUBLE AS k, coalesce(sum(n * n), 0)::DOUBLE AS nn,
  coalesce(sum((bad * bad)::DOUBLE / n), 0) AS s FROM {t} WHERE n > 0)"""  # noqa: E731
    return f"""WITH l AS (SELECT doc_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 WHEN quality IS NULL AND toxic IS NULL THEN NULL ELSE 0 END) AS bad
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
pg AS (SELECT page_id, coalesce(translate(regexp_extract(url, '{HOST_PATTERN}', 1), '{UPPER}', '{LOWER}'), '') AS host,
  coalesce(regexp_extract(url, '{PATH_PATTERN}', 1), '') AS path FROM pages),
h0 AS (SELECT host, count(bad) AS n, coalesce(sum(bad), 0) AS bad FROM pg LEFT JOIN l ON page_id = doc_id GROUP BY host),
h AS (SELECT host, n, bad, CASE WHEN {two} IN ({known}) THEN {three} ELSE {two} END AS domain,
  CASE WHEN {two} IN ({known}) THEN {two} ELSE list_extract(string_split(host, '.'), -1) END AS suffix FROM h0),
d AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM h GROUP BY ALL),
s AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM d GROUP BY ALL),
ms AS ({moments('s')}), md AS ({moments('d')}), mh AS ({moments('h')}),
us AS (SELECT suffix, (bad + m * p) / (n + m) AS above FROM s, ms),
ud AS (SELECT domain, suffix, (bad + m * above) / (n + m) AS above FROM d JOIN us USING (suffix), md),
ab AS (SELECT host, bad + m * above AS a, n - bad + m * (1 - above) AS b FROM h JOIN ud USING (domain, suffix), mh),
r AS (SELECT host, a / (a + b) - {Z} * sqrt(a / (a + b) * (1 - a / (a + b)) / (a + b + 1)) AS lower FROM ab)
SELECT page_id, host, path, {rule_case} AS rule, {verdict_case} AS verdict FROM pg LEFT JOIN r USING (host)"""


SQL = _sql()
