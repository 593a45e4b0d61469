import re
from collections import Counter

from pyspark.sql import functions as F

from facetide.llm import queries, urls


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def brute(url, rules, default="allow"):
    host, path = split(url)
    best = None
    for verdict, rule in rules:
        h, p = rule.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            best = max(best or (), (len(rule), verdict == "block", rule, verdict)) if best else (len(rule), verdict == "block", rule, verdict)
    return host, path, best and best[2], best[3] if best else default


URLS = [None, "", "no scheme", "http://", "https://Example.COM", "http://example.com/en/", "http://www.example.com/en/x?y", "x://net/es/1",
        "http://a.b.net/fr/#t", "http://notexample.com/en/", "http://net", "ftp://com/", "http://example.com\n/en/q", "http://com/a://net/es/",
        "http://example.com./en/", "http://ex.com:80/en/", "http://user@example.com/en/", "//example.com/en/", "http://É.com/en", "http://a+b.org/x(1)/z"] + [
    "http://www.example.com/" + "p/" * 5000]
RULES = queries.RULES + [("block", "a+b.org/x(1)/"), ("allow", r"q\E.org/"), ("block", "com/p/p/"), ("block", "ww.example.com/en/")]


def test_equals_brute_force(spark):
    rows = [(i, u, "mine", "x") for i, u in enumerate(URLS)] + [(None, URLS[5], None, None)] * 3
    pages = spark.createDataFrame(rows, "page_id long, url string, Host string, token string")
    for rules in (queries.RULES, RULES):
        out = urls.judge(pages, urls.host_rules(spark, rules))
        assert out.columns == ["page_id", "url", "token", "host", "path", "rule", "verdict"]
        got = Counter((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in out.collect())
        assert got == Counter((r[0], *brute(r[1], rules)) for r in rows)
    assert urls.judge(pages.limit(0), urls.host_rules(spark, RULES)).count() == 0
    assert urls.judge(pages, urls.host_rules(spark, RULES).limit(0), default="block").where("verdict = 'block'").count() == len(rows)


def test_any_expression_and_rules_without_tokens(spark):
    pages = spark.createDataFrame([(1, "http://shop.example/ads/banner-1.gif"), (2, "http://shop.example/a")], "page_id long, url string")
    rules = spark.range(1).select(
        F.lit("ads").alias("rule"), F.lit("block").alias("verdict"), F.lit(r"/ads/.*\.gif$").alias("pattern"),
        F.array().cast("array<string>").alias("tokens"))
    assert {r["page_id"]: r["verdict"] for r in urls.judge(pages, rules).collect()} == {1: "block", 2: "allow"}


def test_only_functions(spark, sf_dir):
    plan = queries.op3(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
