from __future__ import annotations

from thermocline.llm.common import table
from thermocline.llm.url_filter import BAD_WORDS, RULES, judge_urls


def plain(url):
    """host, path, rule and verdict by rule, straight from the definition."""
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    tail = rest[cut:]
    path = tail[: min((tail.find(c) for c in "?#" if c in tail), default=len(tail))]
    fits = [(len(h + p), h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[1:] if fits else (None, None)))


URLS = [None, "", "no scheme", "HTTP://A.Example.NET/en/x?y#z", "http://example.net", "http://xexample.net/en/", "http://net/", "https://w.org/fr/1", "http://a.org/de",
        "http://example.com/de/", "http://example.com/d?/de/", "a://b://c/d", "http://É.COM/#/x", "http://x.com\n/y", "http://" + "a" * 50_000 + ".com/", "http:///p"]


def test_rules_and_odd_rows(spark):
    pages = spark.createDataFrame([(k, u, None, 1, "h") for k, u in enumerate(URLS)] + [(None, "http://a.com/", "", 1, "h"), (1, "", "", 1, "h")], "page_id long, url string, html string, score int, host string")
    rows = judge_urls(pages).collect()
    assert len(rows) == len(URLS) + 2
    for r in rows:
        if r.page_id is not None:
            host, path, rule, verdict = plain(URLS[r.page_id])
            assert (r.host, r.path, r.rule) == (host, path, rule), URLS[r.page_id]
            assert r.verdict == (verdict or ("block" if r.score >= 0.5 else "allow"))
    assert judge_urls(pages.limit(0)).count() == 0


def test_table(spark):
    pages = table(spark, "/root/testdata/sf0.1", "pages")
    rows = {r.page_id: r for r in judge_urls(pages).collect()}
    bad = {p.page_id: bool(set(plain(p.url)[0].replace("-", ".").split(".")) & set(BAD_WORDS)) for p in pages.collect()}
    assert rows.keys() == bad.keys()
    own = [k for k, r in rows.items() if r.rule is None]
    assert sum((rows[k].verdict == "block") == bad[k] for k in own) >= 0.99 * len(own)


def test_given_labels_of_other_hosts(spark):
    """Labels of some hosts carry over to URLs of the same make on other hosts."""
    urls = [(k, f"http://{'x-' * (k % 2) }h{k}.example.org/{k}{'?a=1&b=2' if k % 2 else ''}", "") for k in range(400)]
    pages = spark.createDataFrame(urls, "page_id long, url string, html string")
    labelled = spark.createDataFrame([(u, k % 2) for k, u, _ in urls if k < 200], "url string, label int")
    rows = judge_urls(pages, labelled, rules=()).collect()
    assert sum((r.verdict == "block") == bool(r.page_id % 2) for r in rows if r.page_id >= 200) >= 195
