"""URL rules by host-suffix and path-prefix expressions.

Each distinct URL is expanded into every combination of a host suffix (cut at dots) and a
path prefix (cut after slashes), as deep as the deepest rule: no rule can fit a longer one, and
work grows with the length of a URL and not with its steps. Expressions and rules meet in an equi-join on the first
four bytes of their SHA-256; the full digest and the text then confirm a hit, and the
longest rule decides. Expansion works on distinct URLs, so a URL that a third of all rows
share is judged once.

Null or empty URLs and URLs without ``://`` have an empty host and path and match no rule.
Repeated page ids are judged row by row. Columns of ``pages`` other than the URL are kept
out of the work and carried through unchanged; one that is named like a result (host, path,
rule, verdict) is carried as ``given_<name>``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from claimward.llm.common import table

PREFIX_HEX = 8  # four bytes


@dataclass(frozen=True)
class Rule:
    """``host`` covers itself and all subdomains; ``path`` starts and ends with a slash."""

    verdict: str
    host: str
    path: str

    def __post_init__(self):
        if self.verdict not in ("allow", "block"):
            raise ValueError(f"unknown verdict {self.verdict!r}")
        if not self.host or self.host != self.host.strip(".") or self.host != self.host.lower():
            raise ValueError(f"host {self.host!r} must be lower case without outer dots")
        if not (self.path.startswith("/") and self.path.endswith("/")):
            raise ValueError(f"path {self.path!r} must start and end with a slash")

    @property
    def expression(self) -> str:
        return self.host + self.path


RULES = (
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host in lower case and path of a URL, both empty where there is no ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise("")
    host = lower_ascii(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1))
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def _expressions(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """Every host suffix joined with every path prefix that ends in a slash, as long as rules are."""
    most_labels = max((r.host.count(".") + 1 for r in rules), default=0)
    most_slashes = max((r.path.count("/") for r in rules), default=0)
    dots = F.length(host) - F.length(F.replace(host, F.lit("."), F.lit("")))
    slashes = F.length(path) - F.length(F.replace(path, F.lit("/"), F.lit("")))
    suffixes = [
        F.when(dots >= n - 1, F.substring_index(host, ".", -n)) for n in range(1, most_labels + 1)
    ]
    prefixes = [
        F.when(slashes >= n, F.concat(F.substring_index(path, "/", n), F.lit("/")))
        for n in range(1, most_slashes + 1)
    ]
    pairs = [F.concat(s, p) for s in suffixes for p in prefixes]
    none = F.array().cast("array<string>")
    return F.array_distinct(F.array_compact(F.array(*pairs))) if pairs else none


def rule_table(spark: SparkSession, rules: tuple[Rule, ...]) -> DataFrame:
    """Rules with digest and order; of two rules with one expression, block stays."""
    best = {}
    for rule in sorted(rules, key=lambda r: r.verdict):
        best[rule.expression] = rule.verdict
    rows = [(text, verdict) for text, verdict in sorted(best.items())]
    return spark.createDataFrame(rows, "rule string, rule_verdict string").select(
        "rule",
        "rule_verdict",
        F.sha2("rule", 256).alias("rule_digest"),
        F.substring(F.sha2("rule", 256), 1, PREFIX_HEX).alias("short"),
    )


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES, default: str = "allow") -> DataFrame:
    """``pages`` with host, path, rule and verdict; ``default`` where no rule fits."""
    spark = pages.sparkSession
    own = ["host", "path", "rule", "verdict", "judged_url"]
    kept = pages.withColumnsRenamed({name: f"given_{name}" for name in own})
    urls = pages.select(F.coalesce("url", F.lit("")).alias("url")).distinct()
    host, path = host_and_path(F.col("url"))
    parts = urls.select("url", host.alias("host"), path.alias("path"))
    expanded = parts.filter("host != ''").select("url", F.explode(_expressions(F.col("host"), F.col("path"), rules)).alias("expression"))
    digested = expanded.select("url", "expression", F.sha2("expression", 256).alias("digest"))
    hits = digested.join(
        rule_table(spark, rules), F.substring("digest", 1, PREFIX_HEX) == F.col("short")
    ).filter("digest = rule_digest and expression = rule")
    decided = hits.groupBy("url").agg(
        F.max(F.struct(F.length("rule").alias("size"), "rule", "rule_verdict")).alias("best")
    )
    judged = parts.join(decided, "url", "left").select(
        F.col("url").alias("judged_url"),
        "host",
        "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.rule_verdict", F.lit(default)).alias("verdict"),
    )
    same = F.coalesce(kept["url"], F.lit("")) == judged["judged_url"]
    return kept.join(judged, same, "left").drop("judged_url")


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge(pages).select("page_id", "host", "path", "rule", "verdict")


OP4_SQL = r"""
WITH cut AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), parts AS (
  SELECT page_id,
    translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut
), rules(verdict, rule_host, rule_path) AS (
  VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
)
SELECT p.page_id, p.host, p.path, r.rule_host || r.rule_path AS rule, coalesce(r.verdict, 'allow') AS verdict
FROM parts p LEFT JOIN rules r
  ON (p.host = r.rule_host OR ends_with(p.host, '.' || r.rule_host)) AND starts_with(p.path, r.rule_path)
QUALIFY row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.rule_host || r.rule_path) DESC) = 1
"""
