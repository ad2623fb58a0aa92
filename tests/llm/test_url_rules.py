"""Operator 10 against all rules for all URLs, and its SQL."""

import random
import re

import duckdb

from starmill.llm import oracles
from starmill.llm.queries import QUERIES
from starmill.llm.url_rules import judge
from tests.compare import compare

RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "www.example.com", "/en/x"),
    ("allow", "www.example.com", "/en/x/y"),
    ("block", "net", ""),
    ("allow", "EXAMPLE.net", "/a"),
    ("allow", "org", "/t"),
    ("block", "org", "/t"),  # twice, with another verdict
    ("block", "", "/all"),
    ("block", "bad/host", "/"),
    ("allow", None, "/null"),
]


def expected(url, rules):
    host = path = ""
    if url and "://" in url:
        host, path = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1], re.S).groups()
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    best = None
    for verdict, rule_host, rule_path in rules:
        rule_host = (rule_host or "").lower()
        fits = rule_host in ("", host) or host.endswith("." + rule_host)
        if fits and path.startswith(rule_path):
            labels = len(rule_host.split(".")) if rule_host else 0
            rank = (len(rule_host + rule_path), labels, rule_host + rule_path, verdict)
            best = max(best or rank, rank)
    return host, path, best and best[2], best[3] if best else "allow"


def urls():
    draw = random.Random(2)
    hosts = [
        "com", "example.com", "www.example.com", "a.www.example.com", "notexample.com", "x.net",
        "example.net", "EXAMPLE.NET", "t.org", "a-b.com", "comx", "a..com", ".com", "", "ex,ample.com",
    ]
    paths = ["", "/", "/en", "/en/", "/en/x", "/en/x/y/z", "/EN/", "/all/", "/t", "/a\nb", "/null", "//"]
    tails = ["", "?q=/en/", "#/en/x", "?a://b"]
    found = [
        f"{draw.choice(['http', 'https', ''])}://{h}{p}{draw.choice(tails)}" for h in hosts for p in paths
    ]
    return [*found, None, "", "no scheme", "com/en/", "://", "http://", found[0], found[0]]


def test_all_rules_for_all_urls(spark):
    rows = [(i % 150 if i % 7 else None, u, "h", "p") for i, u in enumerate(urls())]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, part string")
    rules = spark.createDataFrame(RULES, "verdict string, host string, path string")
    for some in (rules, rules.repartition(5)):
        got = sorted(map(tuple, judge(pages, some).collect()), key=str)
        assert got == sorted(((r[0], *expected(r[1], RULES)) for r in rows), key=str)
    assert {r["verdict"] for r in judge(pages, rules.where("false")).collect()} == {"allow"}
    assert judge(pages.where("false"), rules).count() == 0


def test_a_key_that_most_share(spark):
    pages = spark.range(3000).selectExpr(
        "id AS page_id", "if(id % 3 < 2, 'http://example.com/en/1', concat('http://h', id, '.com/')) AS url"
    )
    rules = spark.createDataFrame(RULES, "verdict string, host string, path string")
    got = judge(pages, rules).groupBy("rule").count().collect()
    assert {r["rule"]: r["count"] for r in got} == {"example.com/en/": 2000, "com/": 1000}


def test_sql(spark, folder):
    con = duckdb.connect()
    con.execute(f"create view pages as select * from read_parquet('{folder}/pages.parquet')")
    df = QUERIES["op10_url_rules"](spark, folder)
    assert compare(df, con, oracles.URL_RULES) == ""
    assert not re.search("Python|Arrow|Pandas", df._jdf.queryExecution().toString())
