"""Rules, features and verdicts of the URL filter."""

import math
from collections import Counter

from gridcat.llm import queries, url_filter as U

from .conftest import SF_SMALL

RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def plain(url):
    """Host, path and deciding rule, by the letter of the contract."""
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, tail = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut]), rest[cut:]
    path = tail[:min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
    fits = [(len(h + p), h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, None, None))
    return host, path, best[1], best[2]


URLS = ["http://Example.ORG/es/1", "https://a.example.org/en/12", "https://a.example.org/en/2", "http://x.com/de/1?a=b/c",
        "http://x.com/de", "http://com/fr/", "http://notcom/fr/", "http://x.org", "http://x.org?q=/a", "http://x.org#f/a", "://",
        "no scheme", "", None, "ftp://é.Com/fr/%20", "http://u:p@x.com:80/de/x#y", "http:///path", "a://b://c.org/x",
        "http://x.net/" + "a1" * 20_000]


def test_hosts_paths_and_rules(spark):
    rows = [(i, u, "keep", 7, "x", 1.0) for i, u in enumerate(URLS)] + [(3, URLS[3], None, None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, rule string, label int, host string, length double")
    got = U.judge(pages)
    assert got.columns == ["page_id", "url", "label", "length", "host", "path", "rule", "verdict"]
    for r in got.collect():
        host, path, rule, verdict = plain(r.url)
        assert (r.host, r.path, r.rule) == (host, path, rule), r.url
        assert r.verdict == verdict if verdict else r.verdict in ("allow", "block")
        assert (r.label, r.length) in ((7, 1.0), (None, None))      # clashing names keep their values
    assert got.count() == len(rows)
    assert U.judge(pages.limit(0)).count() == 0


def test_features(spark):
    url = "https://Sub.example.com/a/b2/index.html?x=1&y=22#top"
    row = U.features(spark.createDataFrame([(url,)], "url string")).first()
    assert (row.length, row.depth, row.labels, row.parameters, row.fragment, row.secure) == (len(url), 3, 3, 2, 1, 1)
    assert (row.k_top, row.k_domain, row.k_segment) == ("com", "example.com", "a")
    counts = Counter(url)
    assert math.isclose(row.entropy, -sum(n / len(url) * math.log2(n / len(url)) for n in counts.values()), abs_tol=1e-9)
    assert math.isclose(row.digit_share, sum(map(str.isdigit, url)) / len(url))
    assert row.longest_part == len("example")


def test_trees_learn_labelled_urls(spark):
    """Spam hosts are told from others on URLs whose hosts were never seen."""
    import random

    draw = random.Random(5)
    name = lambda n: "".join(draw.choices("bcdfglmnprst", k=n // 2)) + "".join(draw.choices("aeiou", k=n // 2))

    def make(spam):
        host = f"{name(4)}-{draw.randint(1000, 99999)}-win.biz" if spam else f"www.{name(8)}.info"
        return f"http://{host}/{name(6)}?id={draw.randint(0, 10 ** 8)}&r=1" if spam else f"https://{host}/{name(6)}/{name(5)}"

    rows = [(make(i % 2), i % 2) for i in range(800)]
    train = spark.createDataFrame(rows[:600], "url string, label int")
    test = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(rows[600:])], "page_id long, url string")
    got = {r.page_id: r.verdict for r in U.judge(test, rules=(), labelled=train).collect()}
    right = sum((got[i] == "block") == bool(y) for i, (_, y) in enumerate(rows[600:]))
    assert right >= 195


def test_rates_are_counted_on_all_other_rows(spark):
    """Every labelled row is either one the trees see or counted, however few the trees see."""
    rows = [(f"http://h{i % 200}.example/{i}", i % 200 // 100) for i in range(4000)]
    model = U.fit(spark.createDataFrame(rows, "url string, label int"), max_rows=400, trees=2)
    part = "pmod(xxhash64(url), 1048576) >= ceil(1048576 * 400 / 4000)"
    counted = spark.createDataFrame(rows, "url string, label int").where(part).collect()
    n, hit = Counter(), Counter()
    for url, label in counted:
        n[url.split("/")[2]] += 1
        hit[url.split("/")[2]] += label
    assert len(counted) > 3400
    got = {r.k_host: r.host_rate for r in model.rates["host"].collect()}
    assert set(got) == set(n)
    assert all(math.isclose(got[h], (hit[h] + U.PRIOR * 0.5) / (n[h] + U.PRIOR)) for h in n)


def test_one_class_alone(spark):
    train = spark.createDataFrame([("http://a.b/c", 1)] * 3, "url string, label int")
    asked = spark.createDataFrame([(1, "http://x.y/z"), (2, None)], "page_id long, url string")
    assert {r.verdict for r in U.judge(asked, rules=(), labelled=train).collect()} == {"block"}
    assert {r.verdict for r in U.judge(asked, rules=(), labelled=train.limit(0)).collect()} == {"allow"}


def test_op1_query(spark):
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()}
    got = queries.op1_url_filter(spark, SF_SMALL).collect()
    assert {r.page_id for r in got} == set(pages) and len(got) == len(pages)
    for r in got:
        host, path, rule, verdict = plain(pages[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == verdict if verdict else r.verdict in ("allow", "block")
