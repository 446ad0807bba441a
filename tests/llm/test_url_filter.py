import random
import re

from pyspark.sql import functions as F

from ripplebook.llm import url_filter as u
from ripplebook.llm.queries import URL_RULES

URLS = [
    None, "", "no scheme", "http://", "HTTP://A.Example.ORG/es/1", "https://example.org/en/12?x#y", "https://example.org/en/2", "http://notexample.org/es/", "http://x.com/fr/a?ref=1",
    "http://x.com/de/", "http://x.com/", "http://x.com", "http://x.com#f", "http://com/de/x", "ftp://u@h.com:80/de/", "http://a.net/p?b=2&a=1&ref=z", "http://www.a.net:80/p/index.html?a=1&b=2", "http://a.net/p?a=1&b=2#q", "x://y://z/es/", "http://é.org/\n?q",
]


def brute(url):
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.text), default=None)
    return host, path, best.text if best else None, best.verdict if best else None


def test_hosts_paths_and_rules(spark):
    pages = spark.createDataFrame([(i, x, "h") for i, x in enumerate(URLS)] * 2, "page_id bigint, url string, host string")
    none = spark.createDataFrame([], "canonical_url string")
    got = u.judge_urls(pages, none, URL_RULES).collect()
    assert len(got) == 2 * len(URLS)
    for r in got:
        host, path, rule, verdict = brute(URLS[r.page_id])
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule, verdict or "allow")


def test_listing_is_exact_under_false_positives(spark):
    rng = random.Random(3)
    urls = [f"http://h{rng.randint(0, 40)}.net/p{rng.randint(0, 60)}" for _ in range(3000)] + ["http://hot.net/x"] * 1500
    pages = spark.createDataFrame([(i, x) for i, x in enumerate(urls)], "page_id bigint, url string")
    listed = {x.removeprefix("http://") for x in urls[:400]} | {"hot.net/x", "never.net/seen"}
    frame = spark.createDataFrame([(x,) for x in listed] * 2 + [(None,)], "canonical_url string")
    for blocks in (1, 1 << 18):  # one block of 256 bits lets nearly everything pass
        got = u.judge_urls(pages, frame, max_blocks=blocks).collect()
        assert len(got) == len(urls)
        assert all(r.listed == (urls[r.page_id].removeprefix("http://") in listed) == (r.verdict == "block") for r in got)
        passed = sum(r.maybe_listed for r in got)
        assert (passed > 3000) if blocks == 1 else (passed < 3500)
        assert all(r.maybe_listed for r in got if r.listed)


def test_canonical_forms(spark):
    same = ["http://a.net/p?b=2&a=1&ref=z", "https://www.a.net:80/p/index.html?a=1&b=2", "http://A.NET/p/?a=1&b=2&utm_source=x#q"]
    df = spark.createDataFrame([(x,) for x in same], "url string").select(u.canonical_url(F.col("url")).alias("c"))
    assert {r.c for r in df.collect()} == {"a.net/p?a=1&b=2"}
    assert u.judge_urls(df.filter("false").withColumnRenamed("c", "url"), df.withColumnRenamed("c", "canonical_url")).count() == 0


def test_columns_of_the_same_names_are_replaced(spark):
    names = ("host", "path", "canonical_url", "rule", "maybe_listed", "listed", "verdict")
    pages = spark.createDataFrame([(1, "http://a.org/x", *["old"] * 7, 5)], "page_id bigint, url string, " + ", ".join(f"{n} string" for n in names) + ", other int")
    (r,) = u.judge_urls(pages, spark.createDataFrame([("a.org/x",)], "canonical_url string"), URL_RULES).collect()
    assert (r.host, r.path, r.canonical_url, r.rule, r.listed, r.verdict, r.other) == ("a.org", "/x", "a.org/x", "org/", True, "allow", 5)
