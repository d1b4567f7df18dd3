import re

from voxscope.llm.url_rules import SiteRule, judge_urls, pattern_regex, pattern_tokens

URLS = [None, "", "no scheme", "http://example.org", "http://EXAMPLE.org/es/1", "https://a.b.example.org/es/", "http://example.org/es",
        "http://example.org/en/123?x=1", "http://notexample.org/es/", "http://x.com/de/#f", "ftp://com/fr/x", "http://casino-win.net/x",
        "http://a.org/casino-x", "http://x.net/a?casino-", "file:///x", "http://x.net/wp-login.php", "http://x.net/wp-login.php/more",
        "http://tracker.x.net/a/pixel", "a://b://c/d", "http://x.net/affiliate/robots.txt", "http://É.COM/de/É"]


def expected(url):
    m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (re.sub("[A-Z]", lambda x: x.group().lower(), m[1]), m[2]) if m else ("", "")
    rules = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]
    fits = [(len(h + p), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *max(fits)[1:]) if fits else (host, path, None, None)


def test_site_rules_by_definition(make):
    pages = make([(i, u, "") for i, u in enumerate(URLS * 2)], "page_id long, url string, html string")
    rows = judge_urls(pages).collect()
    assert len(rows) == 2 * len(URLS)
    for r in rows:
        host, path, rule, verdict = expected(r.row.url)
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert verdict is None or r.verdict == verdict
    verdicts = {r.row.url: (r.verdict, r.pattern) for r in rows if r.rule is None}
    assert verdicts["http://casino-win.net/x"] == ("block", "casino-") and verdicts["http://x.net/a?casino-"] == ("allow", None)
    assert verdicts["http://x.net/wp-login.php"][0] == "block" and verdicts["http://x.net/wp-login.php/more"][0] == "allow"
    assert verdicts["http://tracker.x.net/a/pixel"] == ("block", "||tracker.*/pixel")
    assert verdicts["http://x.net/affiliate/robots.txt"] == ("allow", "/affiliate/") and verdicts[None] == ("allow", None)


def test_a_match_always_holds_the_tokens():
    for pattern in ("spam-farm.", "||a.b*/c", "|x", "x|", "*mid*", "^doubleclick^", "a*b", "||org/", "/en/1"):
        regex, tokens = re.compile(pattern_regex(pattern)), pattern_tokens(pattern)
        for url in ("spam-farm.org/x", "my-spam-farm.x", "a.b/c", "z.a.bc/d/c", "x", "x/y", "y/x", "amidb/", "ad.doubleclick.net/", "ab/", "a-b/", "net.org/", "e/en/12"):
            if regex.search(url):
                assert set(tokens) <= set(re.findall("[A-Za-z0-9]+", url)), (pattern, url)


def test_rules_without_a_token_see_every_url(make):
    pages = make([(1, "http://a.net/xmidy", ""), (2, "http://a.net/", "")], "page_id long, url string, html string")
    rows = judge_urls(pages, sites=[SiteRule("block", "net", "/x"), SiteRule("allow", "net", "/x")], patterns=["*mid*"]).collect()
    got = {r.row.page_id: (r.rule, r.verdict, r.pattern) for r in rows}
    assert got == {1: ("net/x", "block", "*mid*"), 2: (None, "allow", None)}  # of equal rules the first given


def test_clashing_names_and_empty_tables(make):
    rows = make([(1, "http://a.org/", 3, "x")], "page_id long, url string, no int, rule string")
    assert [(r.row.no, r.row.rule, r.rule) for r in judge_urls(rows).collect()] == [(3, "x", "org/")]
    assert judge_urls(make([], "page_id long, url string")).collect() == []


def test_hot_and_null_urls_are_split(spark, make):
    """With a join by shuffle and small limits, a url and a null that hold a third of the rows each meet in many tasks."""
    from pyspark.sql import functions as F
    pages = spark.range(60000, numPartitions=12).select(F.col("id").alias("page_id"), F.when(F.col("id") % 3 == 0, "http://hot.org/a").when(
        F.col("id") % 3 == 1, F.concat(F.lit("http://h"), "id", F.lit(".org/a"))).alias("url"))
    small = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5"}
    before = {k: spark.conf.get(k, None) for k in small}
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        got = judge_urls(pages).select("row.page_id", "host", "rule")
        parts = got.withColumn("part", F.spark_partition_id()).groupBy("part", "host").count().collect()
        assert got.count() == 60000 and got.where("rule IS NULL").count() == 20000
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert len([r for r in parts if r["host"] == "hot.org"]) > 1 and len([r for r in parts if r["host"] == ""]) > 1
