"""URL filters: pattern rules behind an index on their rarest literal token.

A rule is a host and a path prefix; it fits that host and its subdomains when
the path starts with the prefix. Each rule is kept under one literal token,
the one that the fewest URLs of the table hold. The tokens of a URL fetch the
rules kept under them; only these run their regular expressions, and the
longest rule that fits decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Tokens are runs of letters and digits of ASCII and of anything beyond it.
TOKEN = r"[A-Za-z0-9\x{80}-\x{10FFFF}]+"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty for null or without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.expr("substr({0}, instr({0}, '://') + 3)".format("url"))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"\A[^/?#]*", 0)
    path = F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def rule_table(spark: SparkSession, rules: list[tuple[str, str]]) -> DataFrame:
    """``rule, verdict`` from (verdict, rule) pairs; a rule is written ``host/path``."""
    return spark.createDataFrame([(r, v) for v, r in rules], "rule string, verdict string")


def _quoted(col: Column) -> Column:
    return F.regexp_replace(col, r"([^A-Za-z0-9/])", r"\\$1")


def compiled(rules: DataFrame) -> DataFrame:
    """``rule, verdict, pattern, tokens``: the regular expression and the literal tokens of each rule.

    Only tokens that a fitting URL must hold whole are literal tokens: all of
    the host's, and those of the path but a last one that may go on.
    """
    host = F.regexp_extract("rule", r"\A[^/]*", 0)
    path = F.regexp_extract("rule", r"\A[^/]*(.*)\z", 1)
    whole = F.regexp_replace(path, TOKEN + r"\z", "")
    return rules.select(
        "rule", "verdict",
        F.concat(F.lit(r"(?s)\A([^/]*\.)?"), _quoted(host), _quoted(path)).alias("pattern"),
        F.array_distinct(F.concat(F.regexp_extract_all(host, F.lit(TOKEN), F.lit(0)),
                                  F.regexp_extract_all(whole, F.lit(TOKEN), F.lit(0)))).alias("tokens"))


def _tokens(place: Column) -> Column:
    # The empty token fetches the rules that have no literal token at all.
    return F.concat(F.array(F.lit("")), F.array_distinct(F.regexp_extract_all(place, F.lit(TOKEN), F.lit(0))))


def rule_index(rules: DataFrame, places: DataFrame) -> DataFrame:
    """``token, rule, verdict, pattern``: each rule under its token that the fewest ``places`` hold."""
    ready = compiled(rules)
    literal = ready.select("rule", "verdict", "pattern", F.explode_outer("tokens").alias("token"))
    literal = literal.withColumn("token", F.coalesce("token", F.lit("")))
    wanted = literal.select("token").distinct()
    counts = (
        places.select(F.explode(_tokens(F.concat("host", "path"))).alias("token"))
        .join(wanted, "token", "left_semi").groupBy("token").agg(F.count(F.lit(1)).alias("held"))
    )
    scored = literal.join(counts, "token", "left").withColumn("held", F.coalesce("held", F.lit(0)))
    best = F.min(F.struct("held", "token"))
    return scored.groupBy("rule", "verdict", "pattern").agg(best.alias("best")).select(
        F.col("best.token").alias("token"), "rule", "verdict", "pattern")


def judge_urls(pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url",
               default: str = "allow") -> DataFrame:
    """``key, host, path, rule, verdict`` for every row of ``pages``.

    A null url, or one without ``://``, has an empty host and path, fits no
    rule and gets ``default``; so does any other url that no rule fits. Of
    rules of equal length that fit, the one with the longer host wins. Each distinct host and path is judged once, whatever number of rows holds
    it; only ``key`` and ``url`` are read.
    """
    host, path = host_and_path(F.col("url"))
    rows = pages.select(F.col(key).alias("key"), F.col(url).alias("url")).select(
        "key", host.alias("host"), path.alias("path"))
    places = rows.select("host", "path").distinct()
    index = rule_index(rules, places)
    candidates = places.select("host", "path", F.explode(_tokens(F.concat("host", "path"))).alias("token")).join(
        index, "token")
    fitting = candidates.where(F.expr("concat(host, path) rlike pattern"))
    longest = F.max(F.struct(F.length("rule").alias("n"), F.instr("rule", "/").alias("host"), "rule", "verdict"))
    verdicts = fitting.groupBy("host", "path").agg(longest.alias("best")).select(
        "host", "path", F.col("best.rule").alias("rule"), F.col("best.verdict").alias("verdict"))
    return rows.join(verdicts, ["host", "path"], "left").select(
        F.col("key").alias(key), "host", "path", "rule",
        F.coalesce("verdict", F.lit(default)).alias("verdict"))
