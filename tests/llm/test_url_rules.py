import random
import re

from quire.llm.queries import URL_RULES
from quire.llm.url_rules import url_verdicts


def brute(url, rules):
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "")
    host, path = (re.sub("[A-Z]", lambda x: x[0].lower(), m[1]), m[2]) if m else ("", "")
    fit = [(len(h) + len(p), len(h), v, h + p) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=None)
    return host, path, best and best[3], best[2] if best else "allow"


def judged(spark, urls, rules):
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)], "page_id long, url string, host string, rule string")
    out = url_verdicts(pages, spark.createDataFrame(rules, "rule_host string, rule_path string, verdict string"))
    assert out.columns == ["page_id", "host", "path", "rule", "verdict"]
    return {r["page_id"]: tuple(r)[1:] for r in out.collect()}


def test_fixed_rules_against_brute_force(spark):
    rng = random.Random(1)
    hosts = ["example.com", "WWW.Example.com", "a.www.example.com", "notexample.com", "com", "x.net", "net", "netx", "org", "", "u@h.com:80", "com.", "a..com"]
    urls = [f"{rng.choice(['http', 'https', ''])}://{rng.choice(hosts)}{rng.choice(['', '/', '/en', '/en/', '/en/1', '/es/x', '/fr/', '?q=/en/', '#/en/', '/EN/', '/a//b'])}"
            for _ in range(300)]
    urls += [None, "", "no scheme.com/en/", "a://b://example.com/en/", "http://h\nx.com/\nen/", "http://x.com/" + "p/" * 20_000, "://.com/"]
    got = judged(spark, urls, list(URL_RULES))
    assert len(got) == len(urls)
    for i, u in enumerate(urls):
        assert got[i] == brute(u, URL_RULES), u


def test_other_rules_and_ties(spark):
    rules = [("b.com", "/x", "block"), ("b.com", "/x/y", "allow"), ("a.b.com", "", "allow"), ("b.com", "/x/y", "block"), ("c.org", "/", "block"), ("d.org", "/long/path", "block")]
    urls = ["http://b.com/x1", "http://b.com/x/y/z", "http://a.b.com/x", "http://q.a.b.com", "http://c.org", "http://c.org/", "http://d.org/long/pathology", "http://d.org/long/"]
    got = judged(spark, urls, rules)
    assert all(got[i] == brute(u, rules) for i, u in enumerate(urls))


def test_repeated_rows_and_empty_tables(spark):
    assert len(judged(spark, ["http://x.com/"] * 3, list(URL_RULES))) == 3
    assert judged(spark, [], list(URL_RULES)) == {}
    none = spark.createDataFrame([], "rule_host string, rule_path string, verdict string")
    pages = spark.createDataFrame([(1, "http://x.com/"), (1, "http://x.com/"), (None, None)], "page_id long, url string")
    assert [r["verdict"] for r in url_verdicts(pages, none).collect()] == ["allow"] * 3
