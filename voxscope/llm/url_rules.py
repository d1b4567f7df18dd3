"""Operator 6: URL filter.  Pattern rules are indexed by their rarest literal token; a URL's tokens fetch the rules whose
regular expressions are worth running on it.  DataFrame functions only.

A pattern is matched anywhere in host and path: ``*`` stands for any characters, a leading ``||`` for the start of the
host or of one of its labels, ``|`` for the start or end, ``^`` for a separator or the end.  A leading ``@@`` turns a
blocking pattern into an exception.  A site rule names a host with its subdomains and a path prefix.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage

BROADCAST_RULES = 100_000
_HOST = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_TOKEN = "[A-Za-z0-9]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class SiteRule:
    """``path`` must begin with a slash; the longest site rule that fits decides, before any pattern."""

    verdict: str
    host: str
    path: str

    @property
    def pattern(self) -> str:
        return f"||{self.host}{self.path}"


SITE_RULES = [SiteRule("allow", "org", "/"), SiteRule("block", "example.org", "/es/"), SiteRule("block", "example.org", "/en/1"),
              SiteRule("allow", "com", "/fr/"), SiteRule("block", "com", "/de/")]
PATTERNS = ["spam-farm.", "cheap-pills.", "casino-", "free-bets.", "adult-x.", "ads-track.", "||tracker.*/pixel", "/wp-login.php|",
            "/affiliate/", "^doubleclick^", "@@/robots.txt|"]


def pattern_regex(pattern: str) -> str:
    """The regular expression of a pattern without its ``@@``."""
    out, rest = "", pattern
    if rest.startswith("||"):
        out, rest = r"^(?:[^/]*\.)?", rest[2:]
    elif rest.startswith("|"):
        out, rest = "^", rest[1:]
    end = ""
    if rest.endswith("|"):
        end, rest = "$", rest[:-1]
    special = {"*": r"[\s\S]*", "^": r"(?:[^A-Za-z0-9_.%-]|$)"}
    return out + "".join(special.get(c) or re.escape(c) for c in rest) + end


def pattern_tokens(pattern: str) -> list[str]:
    """Literal tokens that every URL with a match holds whole: both of their ends are fixed by the pattern."""
    inner = pattern.strip("|")
    found = []
    for m in re.finditer(_TOKEN, inner):
        left = pattern.startswith("|") if m.start() == 0 else inner[m.start() - 1] != "*"
        right = pattern.endswith("|") if m.end() == len(inner) else inner[m.end()] != "*"
        if left and right:
            found.append(m.group())
    return sorted(set(found))


def _table(spark, sites: list[SiteRule], patterns: list[str]) -> DataFrame:
    rules = [{"no": k, "rule": s.host + s.path, "verdict": s.verdict, "site": True, "length": len(s.host + s.path),
              "regex": pattern_regex(s.pattern), "tokens": pattern_tokens(s.pattern)} for k, s in enumerate(sites)]
    for k, text in enumerate(patterns, len(sites)):
        body = text.removeprefix("@@")
        rules.append({"no": k, "rule": text, "verdict": "block" if body == text else "allow", "site": False, "length": 0,
                      "regex": pattern_regex(body), "tokens": pattern_tokens(body)})
    kind = "array<struct<no:int,rule:string,verdict:string,site:boolean,length:int,regex:string,tokens:array<string>>>"
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rules)), kind)))


def url_host(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _HOST, 1), F.lit("")), _UPPER, _LOWER)


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _HOST, 2), F.lit(""))


def judge_urls(pages: DataFrame, url: str = "url", sites: list[SiteRule] = SITE_RULES, patterns: list[str] = PATTERNS) -> DataFrame:
    """One row per input row: struct ``row`` (its columns), ``host``, ``path``, ``rule``, ``verdict``, ``pattern``.

    ``rule`` is the longest site rule that fits, of equal ones the first given; its verdict decides.  Else the verdict is
    ``block`` if a blocking pattern matches (``pattern`` names the first) and no exception does, ``allow`` otherwise.
    A url that is null or has no ``://`` has an empty host and path; no site rule fits it.  Distinct urls are judged once,
    so a page that is there a million times costs one judgement.  Judgements are staged: beyond the size Spark broadcasts,
    both sides of the last join are then exchanges, and adaptive execution splits the rows of a hot or null url.
    An empty table gives an empty table.
    """
    spark = pages.sparkSession
    urls = pages.select(F.col(url).alias("__url")).where("__url IS NOT NULL").distinct()
    text = F.concat(url_host(F.col("__url")), url_path(F.col("__url")))
    tokens = F.array_distinct(F.concat(F.array(F.lit("")), F.regexp_extract_all("__text", F.lit(_TOKEN), F.lit(0))))
    held = urls.withColumn("__text", text).select("__url", "__text", F.explode(tokens).alias("__token"))
    rules = _table(spark, sites, patterns)
    rules = F.broadcast(rules) if len(sites) + len(patterns) <= BROADCAST_RULES else rules
    options = rules.select("no", F.explode_outer("tokens").alias("__option"))
    common = held.join(options.select(F.col("__option").alias("__token")).where("__token IS NOT NULL").distinct(), "__token").groupBy(
        F.col("__token").alias("__option")).agg(F.count("*").alias("__urls"))
    rarest = options.join(common, "__option", "left").groupBy("no").agg(F.min(F.struct(
        F.coalesce("__urls", F.lit(0)), "__option")).alias("k")).select("no", F.coalesce("k.__option", F.lit("")).alias("__token"))
    index = rules.drop("tokens").join(rarest, "no")
    index = F.broadcast(index) if len(sites) + len(patterns) <= BROADCAST_RULES else index
    hits = held.join(index, "__token").where(F.expr("__text rlike regex"))
    site = F.max(F.when(F.col("site"), F.struct("length", -F.col("no"), "rule", "verdict")))
    block = F.min(F.when(~F.col("site") & (F.col("verdict") == "block"), F.struct("no", "rule")))
    excuse = F.max((~F.col("site") & (F.col("verdict") == "allow")).cast("int"))
    judged = stage(hits.groupBy("__url").agg(site.alias("s"), block.alias("b"), excuse.alias("x")).select(
        "__url", F.col("s.rule").alias("rule"), F.col("b.rule").alias("pattern"),
        F.coalesce(F.col("s.verdict"), F.when(F.col("b").isNotNull() & (F.col("x") == 0), F.lit("block"))).alias("verdict")), "url-verdicts")
    rows = pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("row"), F.col(url).alias("__of"))
    return rows.join(judged, F.col("__of") == F.col("__url"), "left").select(
        "row", url_host(F.col("__of")).alias("host"), url_path(F.col("__of")).alias("path"), "rule",
        F.coalesce("verdict", F.lit("allow")).alias("verdict"), "pattern")
