from __future__ import annotations

from helpers import table

from loanstrata.llm.queries import URL_RULES
from loanstrata.llm.url_filters import filter_urls, rule_table


def judge(url, rules):
    """The same by hand: every rule against every url."""
    rest = url.split("://", 1)[1] if "://" in url else ""
    n = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:n])
    path = rest[n:].split("?")[0].split("#")[0]
    best = None
    for verdict, pattern in rules:
        h, slash, p = pattern.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith(slash + p):
            best = max(best or ((0,),), ((len(pattern), len(h), pattern, verdict),))
    return host, path, best and best[0][2], best[0][3] if best else "allow"


URLS = [
    "http://www.Example.COM/en/x?y#z", "http://example.com/en/", "http://example.com/en", "http://myexample.com/en/",
    "ftp://a.b.net/fr/://", "http://net/es/1", "http://com", "http://com/", "http://com./", "http://x.com:80/en/",
    "no scheme", "://", "http://É.com/en/", "http://a.net?x=/es/", "http://a.net/es/#", "http://example.com//en/", "a://b://c.com/",
]


def test_contract_rules(spark):
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)], "page_id long, url string")
    for r in filter_urls(pages, rule_table(spark, URL_RULES)).collect():
        assert (r.host, r.path, r.rule, r.verdict) == judge(URLS[r.page_id], URL_RULES), URLS[r.page_id]


def test_patterns(spark):
    rules = [("block", "a.com/*/ads/"), ("allow", "/good/"), ("block", "b*.org"), ("block", "c.com/x.y+[z"), ("block", "*")]
    urls = ["http://www.a.com/q/ads/1", "http://a.com/ads/", "http://zz/good/", "http://bbb.org", "http://c.com/x.y+[z/", "http://c.com/xay+[z/"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    found = {r.page_id: r.rule for r in filter_urls(pages, rule_table(spark, rules)).collect()}
    assert found == {0: "a.com/*/ads/", 1: "*", 2: "/good/", 3: "b*.org", 4: "c.com/x.y+[z", 5: "*"}


def test_only_candidates_run_expressions(spark):
    """The rule is filed under its rarest token, and the plan has no cross join and no Python."""
    plan = filter_urls(table(spark, "pages"), rule_table(spark, URL_RULES))._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan and "Python" not in plan and "Arrow" not in plan
