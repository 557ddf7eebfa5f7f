"""URL rules and host reputation."""

from __future__ import annotations

import pytest
from pricevault.llm.q_urls import RULES
from pricevault.llm.url_filter import domain_of, host_reputation, judge_urls, suffix_of
from pyspark.sql import functions as F

CASES = [
    ("https://WWW.Example.COM/en/1?x#y", "www.example.com", "/en/1", "www.example.com/en/", "allow"),
    ("http://blog.example.com/en/", "blog.example.com", "/en/", "example.com/en/", "block"),
    ("http://blog.example.com/en", "blog.example.com", "/en", "com/", "allow"),
    ("http://notexample.com/en/1", "notexample.com", "/en/1", "com/", "allow"),
    ("http://a.b.www.example.com/en/z", "a.b.www.example.com", "/en/z", "www.example.com/en/", "allow"),
    ("ftp://x.net/fr/a", "x.net", "/fr/a", "net/fr/", "block"),
    ("ftp://x.net/es/a#b", "x.net", "/es/a", "net/es/", "block"),
    ("http://x.net?/es/", "x.net", "", None, "allow"),
    ("http://x.com", "x.com", "", None, "allow"),
    ("http://ÄX.org/a://b/c", "Äx.org", "/a://b/c", None, "allow"),
    ("http://a.org/x\ny?z", "a.org", "/x\ny", None, "allow"),
    ("no scheme/en/", "", "", None, "allow"),
    ("://", "", "", None, "allow"),
    ("", "", "", None, "allow"),
    (None, "", "", None, "allow"),
    ("http://spam.org/1", "spam.org", "/1", None, "block"),
    ("http://new.spam.org/1", "new.spam.org", "/1", None, "block"),
]


@pytest.fixture(scope="module")
def outcomes(spark):
    rows = [("spam.org", True)] * 60 + [("good.org", False)] * 300 + [("other.net", False)] * 50 + [("few.org", True)] * 2
    rows += [("new.spam.org", None), (None, True)]
    return spark.createDataFrame(rows, "host string, bad boolean")


def test_hosts_paths_rules_and_verdicts(spark, outcomes):
    rows = [(i if i else None, url, "old") for i, (url, *_) in enumerate(CASES)]
    pages = spark.createDataFrame(rows, "page_id long, url string, verdict string")
    found = {r.url: tuple(r)[2:] for r in judge_urls(pages, outcomes, RULES).select("page_id", "url", "host", "path", "rule", "verdict").collect()}
    assert found == {url: tuple(rest) for url, *rest in CASES}


def test_shares_shrink_to_their_domain(outcomes):
    found = {r.host: r for r in host_reputation(outcomes).collect()}
    assert found["spam.org"].blocked and found["new.spam.org"].blocked and not found["good.org"].blocked
    assert found["new.spam.org"].host_mean == pytest.approx(found["new.spam.org"].domain_mean)
    assert found["few.org"].domain_mean < found["few.org"].host_mean < 1
    assert found["good.org"].bound < found["good.org"].host_mean < 0.05


def test_no_labels_and_empty_tables(spark):
    kind = "host string, bad boolean"
    assert host_reputation(spark.createDataFrame([], kind)).collect() == []
    none = host_reputation(spark.createDataFrame([("a.org", None)], kind)).collect()
    assert [r.blocked for r in none] == [False]
    pages = spark.createDataFrame([], "page_id long, url string")
    assert judge_urls(pages, spark.createDataFrame([], kind), RULES).collect() == []


def test_domains(spark):
    rows = [("a.b.co.uk", "b.co.uk", "co.uk"), ("x.example.com", "example.com", "com"), ("localhost", "localhost", "localhost"), ("", "", "")]
    frame = spark.createDataFrame(rows, "host string, domain string, suffix string")
    assert frame.where((domain_of(F.col("host")) != F.col("domain")) | (suffix_of(F.col("host")) != F.col("suffix"))).count() == 0
