"""URL filters by empirical-Bayes host reputation (native: built-in functions only).

Labelled page outcomes are summed by host, registered domain and suffix. The
rate of each level shrinks to that of the level above it through a
beta-binomial prior whose strength is fitted by moments over the whole level: a
host with few labelled pages gets its domain's rate, a domain with few its
suffix's. A page passes if the lower posterior bound of its host's rate is high
enough. Rules given by the user go first; of those that fit the longest wins.

Sums are combined before their shuffle, so a host with a third of all pages
costs a row per task; what the driver sees is one row of sums per level.

Defined cases: null or schemeless urls have empty host and path and the
overall rate; a host without labelled pages has its domain's rate at prior
strength; null outcomes don't count; repeated outcomes count each; without any
outcome the rate is ``START_RATE``; other columns pass through, columns with
the names of results are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from flowloom.llm.common import ascii_lower, read
from flowloom.plans.lineage import as_table

#: (verdict, rule): a rule is a host and the start of a path.
RULES = [
    ("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
    ("allow", "com/fr/"), ("block", "com/de/"),
]
START_RATE = 0.5
MIN_RATE = 0.8
Z = 1.645
WEAKEST, STRONGEST = 2.0, 10_000.0
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
LEVELS = ["suffix", "domain", "host"]
RESULTS = ["host", "path", "rule", "verdict", "rate", "bound"]


def with_url_parts(pages: DataFrame, url: str = "url") -> DataFrame:
    """``pages`` with ``host`` (A-Z lower-cased) and ``path``."""
    text = F.coalesce(url, F.lit(""))
    return pages.withColumns({"host": ascii_lower(F.regexp_extract(text, URL, 1)),
                              "path": F.regexp_extract(text, URL, 2)})


def registered_domain(host: Column) -> Column:
    """The last two labels of a host."""
    return F.substring_index(host, ".", -2)


def suffix(host: Column) -> Column:
    """The last label of a host."""
    return F.substring_index(host, ".", -1)


def matching_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """(rule, verdict) of the longest rule that fits a host, or a subdomain, and the start of its path."""
    chosen = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):
        name, slash, start = rule.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + start)
        chosen = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(chosen)
    return chosen


def _strength(children: DataFrame) -> float:
    """Prior strength of a level from (n, good, above): pairs of a beta-binomial have correlation
    1 / (strength + 1), and n (rate - above)^2 / (above (1 - above)) exceeds 1 by (n - 1) times it."""
    spread = F.col("n") * F.pow(F.col("good") / F.col("n") - F.col("above"), 2) / (
        F.col("above") * (1 - F.col("above")))
    row = children.where("n > 1 and above > 0 and above < 1").agg(
        F.sum(spread - 1).alias("excess"), F.sum(F.col("n") - 1).alias("weight")).first()
    if not row.weight:
        return WEAKEST
    rho = max(row.excess / row.weight, 1e-9)
    return min(max((1 - rho) / rho, WEAKEST), STRONGEST)


def reputations(pages: DataFrame, outcomes: DataFrame) -> tuple[dict[str, DataFrame], dict[str, float], float]:
    """By level: (key, alpha, beta) of each key with labelled pages; strengths; the overall rate.

    ``pages`` has page_id and host; ``outcomes`` page_id and good (0 or 1).
    """
    by_host = as_table(
        pages.join(outcomes.where("good is not null"), "page_id").where("host <> ''")
        .groupBy("host").agg(F.count("*").alias("n"), F.sum("good").alias("good"))
        .select("host", registered_domain(F.col("host")).alias("domain"), suffix(F.col("host")).alias("suffix"),
                "n", F.col("good").cast("double").alias("good")), "host-outcomes")
    n, good = by_host.agg(F.sum("n"), F.sum("good")).first()
    overall = good / n if n else START_RATE
    found, strengths, above, upper = {}, {}, None, None
    for level in LEVELS:
        keys = LEVELS[LEVELS.index(level) - 1:LEVELS.index(level) + 1] if upper else [level]
        sums = by_host.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
        if upper:
            sums = sums.join(above, upper)
        else:
            sums = sums.withColumn("above", F.lit(overall))
        strengths[level] = _strength(sums)
        found[level] = as_table(sums.select(
            F.col(level), (strengths[level] * F.col("above") + F.col("good")).alias("alpha"),
            (strengths[level] * (1 - F.col("above")) + F.col("n") - F.col("good")).alias("beta")), f"{level}-rates")
        above = found[level].select(level, (F.col("alpha") / (F.col("alpha") + F.col("beta"))).alias("above"))
        upper = level
    return found, strengths, overall


def judge_urls(pages: DataFrame, outcomes: DataFrame, rules: list[tuple[str, str]] = RULES,
               min_rate: float = MIN_RATE, z: float = Z) -> DataFrame:
    """``pages`` (page_id, url) with host, path, rule, verdict, ``rate`` (posterior mean of the host)
    and ``bound`` (its lower bound)."""
    parts = with_url_parts(pages.select(
        "page_id", "url", F.struct(*[F.col(c) for c in pages.columns if c not in RESULTS]).alias("row")))
    found, strengths, overall = reputations(parts.select("page_id", "host"), outcomes)
    hosts = parts.select("host").distinct().select(
        "host", registered_domain(F.col("host")).alias("domain"), suffix(F.col("host")).alias("suffix"))
    for level in LEVELS:
        rates = found[level].select(level, F.struct("alpha", "beta").alias(f"_{level}"))
        hosts = hosts.join(rates, level, "left")

    def prior(level: str) -> Column:
        """Parameters of a key without labelled pages, from the level above."""
        place = LEVELS.index(level)
        if place:
            up = parameters(LEVELS[place - 1])
            mean = up["alpha"] / (up["alpha"] + up["beta"])
        else:
            mean = F.lit(overall)
        return F.struct((strengths[level] * mean).alias("alpha"), (strengths[level] * (1 - mean)).alias("beta"))

    def parameters(level: str) -> Column:
        return F.coalesce(F.col(f"_{level}"), prior(level))

    weight = F.col("_p.alpha") + F.col("_p.beta")
    judged = (
        hosts.withColumn("_p", parameters("host")).withColumn("rate", F.col("_p.alpha") / weight)
        .withColumn("bound", F.col("rate") - z * F.sqrt(F.col("rate") * (1 - F.col("rate")) / (weight + 1)))
        .select("host", "rate", "bound")
    )
    chosen = matching_rule(F.col("host"), F.col("path"), rules)
    return parts.join(judged, "host", "left").withColumn("chosen", chosen).select(
        "row.*", "host", "path", F.col("chosen.rule").alias("rule"),
        F.coalesce("chosen.verdict", F.when(F.col("bound") >= min_rate, "allow").otherwise("block")).alias("verdict"),
        "rate", "bound")


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, host, path, rule, verdict of every page.

    The outcome of a page is the quality label with its number.
    """
    outcomes = read(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), F.col("quality").alias("good"))
    judged = judge_urls(read(spark, sf_dir, "pages").select("page_id", "url"), outcomes)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def _level_sql(level: str, upper: str | None) -> str:
    source = (f"(SELECT {upper}, {level}, sum(n) AS n, sum(good) AS good FROM by_host GROUP BY ALL) s "
              f"JOIN (SELECT {upper} AS up, alpha / (alpha + beta) AS above FROM {upper}_rates) u ON s.{upper} = u.up"
              if upper else f"(SELECT {level}, sum(n) AS n, sum(good) AS good FROM by_host GROUP BY ALL) s, "
              "(SELECT rate AS above FROM overall) u")
    return f"""
{level}_sums AS (SELECT s.*, above FROM {source}),
{level}_rho AS (
  SELECT sum(n * pow(good / n - above, 2) / (above * (1 - above)) - 1) AS excess, sum(n - 1) AS weight
  FROM {level}_sums WHERE n > 1 AND above > 0 AND above < 1),
{level}_strength AS (
  SELECT CASE WHEN coalesce(weight, 0) = 0 THEN {WEAKEST} ELSE
    least(greatest((1 - greatest(excess / weight, 1e-9)) / greatest(excess / weight, 1e-9), {WEAKEST}), {STRONGEST})
    END AS strength FROM {level}_rho),
{level}_rates AS (
  SELECT {level}, strength * above + good AS alpha, strength * (1 - above) + n - good AS beta
  FROM {level}_sums, {level}_strength),"""


def _mean_sql() -> str:
    """Mean of the prior of a host, by level from the overall rate down."""
    mean = "(SELECT rate FROM overall)"
    for level in ("suffix", "domain"):
        mean = f"coalesce({level}_r.alpha / ({level}_r.alpha + {level}_r.beta), {mean})"
    return mean


_RULE_SQL = "CASE " + " ".join(
    f"WHEN (host = '{r.partition('/')[0]}' OR ends_with(host, '.{r.partition('/')[0]}')) "
    f"AND starts_with(path, '/{r.partition('/')[2]}') THEN '{r}'"
    for _, r in sorted(RULES, key=lambda r: -len(r[1]))) + " END"
_VERDICT_SQL = "CASE rule " + " ".join(f"WHEN '{r}' THEN '{v}'" for v, r in RULES) + " END"

OP6_SQL = rf"""
WITH parts AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '{URL}', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(coalesce(url, ''), '{URL}', 2) AS path FROM pages),
by_host AS (
  SELECT host, array_to_string(list_slice(string_split(host, '.'), -2, -1), '.') AS domain,
         string_split(host, '.')[-1] AS suffix, count(*) AS n, CAST(sum(quality) AS DOUBLE) AS good
  FROM parts JOIN labels ON page_id = doc_id WHERE quality IS NOT NULL AND host <> '' GROUP BY host),
overall AS (SELECT coalesce(sum(good) / sum(n), {START_RATE}) AS rate FROM by_host),
{_level_sql('suffix', None)}
{_level_sql('domain', 'suffix')}
{_level_sql('host', 'domain')}
judged AS (
  SELECT page_id, p.host, path, {_RULE_SQL.replace('host', 'p.host')} AS rule,
         coalesce(host_r.alpha, strength * {_mean_sql()}) AS alpha,
         coalesce(host_r.beta, strength * (1 - {_mean_sql()})) AS beta
  FROM parts p LEFT JOIN host_rates host_r ON host_r.host = p.host
  LEFT JOIN domain_rates domain_r ON domain_r.domain = array_to_string(list_slice(string_split(p.host, '.'), -2, -1), '.')
  LEFT JOIN suffix_rates suffix_r ON suffix_r.suffix = string_split(p.host, '.')[-1], host_strength),
rated AS (
  SELECT *, alpha / (alpha + beta) AS rate FROM judged)
SELECT page_id, host, path, rule, coalesce({_VERDICT_SQL}, CASE WHEN
         rate - {Z} * sqrt(rate * (1 - rate) / (alpha + beta + 1)) >= {MIN_RATE} THEN 'allow' ELSE 'block' END) AS verdict
FROM rated
"""
