import numpy as np
import pytest
from pyspark.sql import functions as F

from platewise.llm.queries import URL_RULES
from platewise.llm.urlfilter import build_cascade, contains, judge_urls


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, rest = rest[:cut], rest[cut:]
    path = rest[: min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def brute(rows, listed):
    out = []
    for i, url in rows:
        host, path = split(url)
        fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        rule = max(fits, key=lambda r: len(r.host + r.path), default=None)
        verdict = rule.verdict if rule else ("block" if host in listed else "allow")
        out.append(repr((i, host, path, rule and rule.host + rule.path, verdict)))
    return sorted(out)


URLS = [
    None, "", "no scheme", "http://", "http://com/", "http://com", "http://xcom/a", "https://EXAMPLE.com/en/x?y#z",
    "https://www.example.com/en/1", "https://a.www.example.com/en/", "http://m.example.com/en", "http://a.net/es/q",
    "http://a.net/de/q", "http://net/fr/", "http://b.org?x=http://c.com/en/", "http://b.org#f", "ftp://Ünïcode.org/é",
    "http://d.org:80/en/", "a://b://c/d", "http://e.org/\npath", "http://x.example.com//en/",
]


@pytest.mark.parametrize("max_bytes", [1 << 20, 8])
def test_against_plain_rules_and_set(spark, max_bytes):
    hosts = [f"h{i}.org" for i in range(3000)]
    listed = {h for i, h in enumerate(hosts) if i % 7 == 0} | {"b.org", ""}
    rows = list(enumerate([*URLS, *(f"http://{h}/p" for h in hosts), *["http://h7.org/"] * 500])) + [(None, "http://b.org")]
    pages = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, rule string, member int")
    names = spark.createDataFrame([(h,) for h in [*listed, None, "unseen.org", "b.org"]], "anything string")
    got = judge_urls(pages, URL_RULES, names, max_bytes=max_bytes)
    assert got.columns == ["page_id", "host", "path", "rule", "verdict"]
    assert sorted(repr(tuple(r)) for r in got.collect()) == brute(rows, listed)


def universe(spark, keys, every):
    df = spark.range(keys).select(
        F.xxhash64("id").alias("h1"), F.xxhash64(F.lit(1), "id").alias("h2"), (F.col("id") % every == 0).alias("listed")
    )
    return df, df.toPandas()


@pytest.mark.parametrize("keys, every", [(20_000, 9), (5000, 2), (3000, 3000), (50, 1)])
def test_cascade_is_exact_and_alternates(spark, keys, every):
    df, rows = universe(spark, keys, every)
    levels = build_cascade(df)
    assert (contains(levels, rows["h1"].to_numpy(), rows["h2"].to_numpy()) == rows["listed"].to_numpy()).all()
    if every == 9:
        assert len(levels) > 2
        assert sum(level.bits for level in levels) < 64 * 8 * 20 + 12 * keys / every * 4


def test_empty_tables(spark):
    assert build_cascade(spark.range(0).selectExpr("id AS h1", "id AS h2", "true AS listed")) == []
    assert not contains([], np.array([1]), np.array([2])).any()
    pages = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    nothing = spark.createDataFrame([], "host string")
    assert [r.verdict for r in judge_urls(pages, URL_RULES, nothing).collect()] == ["allow"]
    assert judge_urls(pages.limit(0), URL_RULES, nothing).count() == 0
