import re

from flowloom.llm.url_reputation import RULES, judge_urls, op6_url_filters, reputations, with_url_parts


def parts(url):
    after = (url or "").partition("://")[2] if "://" in (url or "") else ""
    host = re.split(r"[/?#]", after, maxsplit=1)[0]
    path = re.split(r"[?#]", after[len(host):], maxsplit=1)[0]
    return host.translate({c: c + 32 for c in range(65, 91)}), path


def rule_of(host, path):
    fits = [r for _, r in RULES for name, _, start in [r.partition("/")]
            if (host == name or host.endswith("." + name)) and path.startswith("/" + start)]
    return max(fits, key=len) if fits else None


URLS = [None, "", "no scheme", "http://", "HTTP://A.Example.ORG", "x://example.org/es/1?q#f", "x://example.org/en/12", "x://sub.example.org/en/2",
        "x://notexample.org/es/", "a://b.com/fr/x", "a://b.com/de/", "a://b.com/it/", "a://ÄÖ.com?x=://y/de/", "a://b.net:80/x", "a://org", "a://org/",
        "://h/p", "a\nb://c.de/x\ny#z"]


def frames(spark, urls, outcomes):
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)], "page_id long, url string, row string, rate string")
    return pages, spark.createDataFrame(outcomes, "page_id long, good int")


def test_parts_and_rules(spark):
    pages, outcomes = frames(spark, URLS, [(0, 1), (10, 0), (11, 1), (11, 1), (None, 1), (12, None), (999, 0)])
    judged = judge_urls(pages, outcomes)
    assert judged.columns == ["page_id", "url", "row", "host", "path", "rule", "verdict", "rate", "bound"]
    for r in judged.collect():
        assert (r.host, r.path) == parts(r.url), r.url
        assert r.rule == rule_of(r.host, r.path), r.url
        assert r.verdict == (dict((b, a) for a, b in RULES)[r.rule] if r.rule else "allow" if r.bound >= 0.8 else "block")
    assert judged.count() == len(URLS)


def test_small_hosts_take_the_rate_of_their_domain(spark):
    urls, outcomes = [], []
    for host, good, n in [("a.good.net", 99, 100), ("b.good.net", 98, 100), ("c.good.net", 1, 1), ("d.good.net", 0, 0),
                          ("a.bad.net", 10, 100), ("b.bad.net", 12, 100), ("c.bad.net", 1, 1), ("mid.io", 50, 100)]:
        for i in range(max(n, 1)):
            if n:
                outcomes.append((len(urls), int(i < good)))
            urls.append(f"http://{host}/{i}")
    pages, table = frames(spark, urls, outcomes)
    rate = {r.host: r.rate for r in judge_urls(pages, table).select("host", "rate").distinct().collect()}
    assert rate["d.good.net"] > 0.9 and rate["c.good.net"] > 0.9 and rate["c.bad.net"] < 0.5
    assert abs(rate["a.bad.net"] - 0.1) < 0.05
    found, strengths, overall = reputations(with_url_parts(pages), table)
    assert set(found) == {"suffix", "domain", "host"} and strengths["host"] > strengths["domain"]
    assert 0 < overall < 1


def test_without_outcomes_and_empty(spark):
    pages, none = frames(spark, URLS, [])
    assert {r.rate for r in judge_urls(pages, none).collect()} == {0.5}
    empty, _ = frames(spark, [], [])
    assert judge_urls(empty, none).collect() == []


def test_whole_query(spark, data):
    rows = op6_url_filters(spark, data).collect()
    assert len(rows) == spark.read.parquet(f"{data}/pages.parquet").count()
    assert {r.verdict for r in rows} <= {"allow", "block"}
