"""URL filtering: host-suffix and path-prefix expressions against hashed allow and block rules.

Every URL is expanded into the expressions a rule could have: its host and all parent domains,
each with the path prefixes that have the length of some rule's path. Expressions meet rules on
the first four bytes of their SHA-256 digest; a full digest then confirms the rule.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rules of the registered query: verdict and expression (host, then path).
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)
#: Verdict for a URL that no rule fits.
DEFAULT = "allow"


def host_path(url: Column) -> tuple[Column, Column]:
    """Host with A to Z lower-cased, and path; both empty without ``://``."""
    rest = F.when(F.locate("://", url) > 0, F.substring(url, F.locate("://", url) + 3, F.length(url)))
    rest = F.coalesce(rest, F.lit(""))
    authority = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.translate(authority, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def rules_table(spark, rules=RULES) -> DataFrame:
    """(rule, verdict, n, digest, prefix): one row per expression; a repeated expression blocks if any copy does.

    ``n`` is the length of the path, which starts at the first slash. Hosts are lower-cased.
    """
    given = rules
    if not isinstance(rules, DataFrame):  # inline, so that Spark knows its size
        listed = F.array(*[F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule")) for verdict, rule in rules])
        given = spark.range(1).select(F.inline(listed))
    cut = F.locate("/", F.col("rule"))
    known = given.filter(F.col("rule").isNotNull()).select(
        "verdict",
        F.when(cut > 0, F.concat(F.lower(F.substring(F.col("rule"), F.lit(1), cut - 1)), F.substring(F.col("rule"), cut, F.length("rule"))))
        .otherwise(F.lower("rule")).alias("rule"),
        F.when(cut > 0, F.length("rule") - cut + 1).otherwise(0).alias("n"),
    )
    one = known.groupBy("rule", "n").agg(F.max("verdict").alias("verdict"))  # 'block' sorts after 'allow'
    digest = F.sha2(F.col("rule"), 256)
    return one.select("rule", "verdict", "n", digest.alias("digest"), F.substring(digest, 1, 8).alias("prefix"))


def judge(pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url", default: str = DEFAULT) -> DataFrame:
    """One row per page row: key, host, path, rule (NULL if none fits) and verdict.

    A rule fits its host and all subdomains if the path starts with the rule's. The longest
    expression wins; of equally long ones the longer host, then the one that blocks. Without a
    rule the verdict is ``default``. NULL URLs and URLs without ``://`` have empty host and path,
    and fit no rule. Repeated rows are each judged; an empty table gives an empty table. Only the
    two named columns of pages are used.

    Distinct (host, path) pairs are expanded once, so repeated URLs meet the rules as one row. The
    join on the digest's prefix has no hint: Spark broadcasts rules by their size, and beyond it
    splits frequent expressions, as each finds a few rules only.
    """
    host, path = host_path(F.col(url))
    seen = pages.select(F.col(key).alias("_key"), host.alias("_host"), path.alias("_path"))
    lengths = F.array(*[F.lit(row.n) for row in rules.select("n").distinct().orderBy("n").collect()])  # at most one per path length
    labels = F.split("_host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    expressions = (
        seen.filter("_host <> ''").select("_host", "_path").distinct()
        .withColumn("_suffix", F.explode(suffixes))
        .withColumn("_n", F.explode(F.filter(lengths, lambda n: n <= F.length("_path"))))
        .select("_host", "_path", F.concat("_suffix", F.substring(F.col("_path"), F.lit(1), F.col("_n"))).alias("_expression"))
        .withColumn("_digest", F.sha2("_expression", 256))
        .withColumn("prefix", F.substring("_digest", 1, 8))
    )
    hits = expressions.join(rules, "prefix").filter(F.col("_digest") == F.col("digest"))
    best = F.max(F.struct(F.length("rule").alias("a"), (F.length("rule") - F.col("n")).alias("b"), F.col("verdict").alias("c"), F.col("rule")))
    chosen = hits.groupBy("_host", "_path").agg(best.alias("_best"))
    return seen.join(chosen, ["_host", "_path"], "left").select(
        F.col("_key").alias(key), F.col("_host").alias("host"), F.col("_path").alias("path"),
        F.col("_best.rule").alias("rule"), F.coalesce(F.col("_best.c"), F.lit(default)).alias("verdict"),
    )


def query(spark, sf_dir: str) -> DataFrame:
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet"), rules_table(spark))


#: The rules written out, longest first.
SQL = r"""
WITH split AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(rest, '(?s)^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '(?s)^[^/?#]*([^?#]*)', 1) AS path FROM split),
ruled AS (
  SELECT *, CASE
    WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') THEN 'org/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/' END AS rule FROM parts)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('example.org/en/1', 'example.org/es/', 'com/de/') THEN 'block' ELSE 'allow' END AS verdict FROM ruled
"""
