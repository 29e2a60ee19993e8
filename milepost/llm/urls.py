"""URL rules by hashed host-suffix and path-prefix expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The rules that the registered query judges by.
RULES = (
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
)
#: Sites that are blocked where no rule fits.
BLOCKED_SITES = ("ads-track.example.com/", "casino-win.example.com/", "cheap-pills.example.com/", "free-bets.example.com/")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Hex digits of the digest that the join is on.
SHORT = 8


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    return F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substr(url, at + 3)).otherwise("")


def rule_table(spark: SparkSession, rules: Iterable[tuple[str, str]], sites: Iterable[str] = ()) -> DataFrame:
    """Rules given as text: (rule, verdict, tier); tier 1 for ``rules``, 0 for blocked ``sites``."""
    rows = [(r, v, 1) for r, v in rules] + [(s, "block", 0) for s in sites]
    return spark.createDataFrame(rows, "rule string, verdict string, tier int")


def judge(
    pages: DataFrame, rules: DataFrame, default: str = "allow", id_col: str = "page_id", url_col: str = "url"
) -> DataFrame:
    """page_id, host, path, rule and verdict of every row.

    ``rules`` has rule (host, then path from its first ``/``), verdict (allow or block) and tier. A rule fits its
    host and all subdomains where the path starts with the rule's. The highest tier wins, then the longest rule,
    then block; ``rule`` is null where only a tier below 1 or ``default`` decides.

    Every url becomes one expression per (labels in host, length of path) that occurs among the rules, so
    its expansion depends on the shapes of the rules and not on the length of the url. Expressions meet the rules
    by an equi-join on short digests, confirmed by the whole digest. Each different url is judged once and
    joined back, so repeated rows and null ids keep their place; null urls have empty host and path; other
    columns are not read. Empty rules leave every url to ``default``; an empty table gives no rows.
    """
    slash = F.locate("/", F.col("rule"))
    host = F.translate(F.when(slash > 0, F.substring_index("rule", "/", 1)).otherwise(F.col("rule")), UPPER, LOWER)
    path = F.when(slash > 0, F.substr("rule", slash)).otherwise("")
    parsed = rules.where("rule IS NOT NULL AND verdict IN ('allow', 'block')").select(
        "rule", "verdict", "tier", F.concat(host, path).alias("expression"),
        F.size(F.split(host, r"\.")).alias("labels"), F.length(path).alias("chars"),
    )
    rank = F.struct("tier", F.length("rule").alias("chars"), (F.col("verdict") == "block").alias("blocks"), "rule", "verdict")
    known = parsed.groupBy("expression").agg(F.max(rank).alias("rank")).select(
        F.sha2("expression", 256).alias("digest"), "rank"
    ).select(F.substring("digest", 1, SHORT).alias("short"), F.col("digest").alias("rule_digest"), "rank")
    shapes = [(r.labels, r.chars) for r in parsed.select("labels", "chars").distinct().collect()]

    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))
    urls = rows.select("url").where("url IS NOT NULL").distinct().select(
        "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")
    )
    dots = F.length("host") - F.length(F.replace("host", F.lit("."), F.lit("")))
    made = [
        F.when(
            (dots >= labels - 1) & (F.length("path") >= chars) & (F.col("host") != ""),
            F.concat(F.substring_index("host", ".", -labels), F.substring("path", 1, chars)),
        )
        for labels, chars in shapes
    ]
    expressions = urls.select("url", F.explode(F.array_compact(F.array(*made)) if made else F.array().cast("array<string>")).alias("expression"))
    digests = expressions.select("url", F.sha2("expression", 256).alias("digest"))
    found = digests.withColumn("short", F.substring("digest", 1, SHORT)).join(known, "short").where("digest = rule_digest")
    best = found.groupBy("url").agg(F.max("rank").alias("rank"))
    return rows.join(best, "url", "left").select(
        "page_id",
        F.coalesce(host_of(F.col("url")), F.lit("")).alias("host"),
        F.coalesce(path_of(F.col("url")), F.lit("")).alias("path"),
        F.when(F.col("rank.tier") >= 1, F.col("rank.rule")).alias("rule"),
        F.coalesce(F.col("rank.verdict"), F.lit(default)).alias("verdict"),
    )


def oracle(rules: Iterable[tuple[str, str]] = RULES, sites: Iterable[str] = BLOCKED_SITES) -> str:
    rows = [(r, v, 1) for r, v in rules] + [(s, "block", 0) for s in sites]
    values = ", ".join(f"('{r}', '{r.split('/', 1)[0]}', '/{r.split('/', 1)[1]}', '{v}', {t})" for r, v, t in rows)
    return f"""
WITH rules(rule, rhost, rpath, verdict, tier) AS (VALUES {values}),
rest AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
fits AS (
  SELECT page_id, rule, verdict, tier,
         row_number() OVER (PARTITION BY page_id ORDER BY tier DESC, length(rule) DESC, verdict DESC) AS k
  FROM parts JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT p.page_id, p.host, p.path, CASE WHEN f.tier = 1 THEN f.rule END AS rule, coalesce(f.verdict, 'allow') AS verdict
FROM parts p LEFT JOIN fits f ON f.page_id = p.page_id AND f.k = 1"""
