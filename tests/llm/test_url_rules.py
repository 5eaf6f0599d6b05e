"""URL rules against a loop over every rule."""

import random
import re

import pytest
from pyspark.sql import functions as F

from strandwise.llm.url_rules import HostRule, PatternRule, compile_rules, judge_urls

RULES = [
    HostRule("allow", "com", "/"), HostRule("block", "example.com", "/en/"), HostRule("allow", "www.example.com", "/en/"),
    HostRule("block", "net", "/es/"), HostRule("block", "net", "/fr"), HostRule("block", "a-b.org", "/x.y/(z)/"),
    HostRule("block", "org", ""), HostRule("allow", "aa.org", "/b"), HostRule("block", "a.org", "/bb"),
]
PATTERNS = [
    PatternRule("casino", r"^([^/]*[.-])?casino[.-]", ("casino",)),
    PatternRule("deep", r"/([^/]+)/\1/", ()),  # no literal: it meets every URL
]


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url[url.index("://") + 3 :]
    host = re.match(r"[^/?#]*", rest)[0]
    return "".join(c.lower() if c.isascii() else c for c in host), re.match(r"[^/?#]*([^?#]*)", rest)[1]


def plain(url, rules, patterns, default="allow"):
    host, path = parts(url)
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    if fits:
        best = max(fits, key=lambda r: (len(r.text), len(r.host), r.text))
        return host, path, best.text, best.action
    if any(re.search(p.pattern, host + path) for p in patterns) and url is not None:
        return host, path, None, "block"
    return host, path, None, default


def urls():
    rng = random.Random(4)
    hosts = ["example.com", "WWW.Example.COM", "x.www.example.com", "notexample.com", "com", "net", "a.net", "a-b.org", "c.a-b.org",
             "aXb.org", "aa.org", "a.org", "my-casino.xyz", "casinos.xyz", "ÉX.net", "été.info", ""]
    paths = ["", "/", "/en/", "/en", "/EN/", "/es/q", "/fr", "/frites", "/x.y/(z)/1", "/xzy/(z)/", "/b", "/bb/c", "/aa/aa/", "/été/été/"]
    out = [f"{s}{h}{p}{t}" for s in ("http://", "://", "a?b://") for h in hosts for p in paths for t in ("", "?q=://x/en/", "#f")]
    out += [None, "", "example.com/en/", "http:/example.com/en/", "http://", "x" * 50_000 + "://net/es/", "http://net/es/" + "y" * 100_000]
    return out + rng.choices(out, k=300)


@pytest.mark.parametrize("patterns", [PATTERNS, PATTERNS[:1], []])
def test_equals_a_loop_over_all_rules(spark, patterns):
    rows = list(enumerate(urls()))
    got = judge_urls(spark.createDataFrame(rows, "page_id long, url string"), RULES, patterns, default="allow")
    assert got.columns == ["page_id", "url", "host", "path", "rule", "verdict"]
    found = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in got.collect()}
    assert len(found) == len(rows)
    for i, url in rows:
        assert found[i] == plain(url, RULES, patterns), url


def test_rules_lie_under_their_rarest_token(spark):
    tokens = [(["example", "com", "en"],)] * 5 + [(["example", "net"],)] * 2
    table = compile_rules(spark.createDataFrame(tokens, "tokens array<string>"), RULES[:2], PATTERNS)
    at = {r["rule"]: r["token"] for r in table.collect()}
    assert at == {"com/": "com", "example.com/en/": "com", "casino": "casino", "deep": None}


def test_odd_tables(spark):
    df = spark.createDataFrame([(1, "http://net/es/", "own")] * 2 + [(2, None, "own")], "id int, url string, host string")
    names = ("_url", "tokens", "token", "best", "spam", "page", "regex", "kind", "size", "_all", "rule", "verdict", "path")
    df = df.withColumns({n: F.lit("kept") for n in names})
    got = judge_urls(df, RULES, PATTERNS)
    assert [r["verdict"] for r in got.orderBy("id").collect()] == ["block", "block", "allow"]
    assert [r["host"] for r in got.orderBy("id").collect()] == ["net", "net", ""]
    assert {r["best"] for r in got.collect()} == {"kept"} and len(set(got.columns)) == len(got.columns)
    assert judge_urls(df.limit(0), RULES, PATTERNS).count() == 0
    assert {r["verdict"] for r in judge_urls(df, [], [], default="block").collect()} == {"block"}
    other = judge_urls(df.select("id", F.col("url").alias("host")), RULES, PATTERNS, url="host")
    assert sorted((r["id"], r["host"], r["rule"]) for r in other.collect()) == [(1, "net", "net/es/")] * 2 + [(2, "", None)]
