"""Quarantine rules on edge rows and on the six seed articles."""

from pyspark.sql import functions as F

from gazette.functions.urls import has_broken_host
from gazette.operators import gold, lookups
from gazette.operators.quarantine import (
    split_quarantine,
    suspicious_title,
    suspicious_url,
    with_quarantine,
)

GOOD = "A perfectly normal headline"
SEEDS = [
    ("art1", "Iran Nuclear Deal Talks Resume After Months of Silence", "BBC News",
     "https://bbc.com/news/iran1", "politique"),
    ("art2", "Global Markets Rally on Fed Rate Cut Expectations", "Reuters World",
     "https://reuters.com/markets/global", "économie"),
    ("art3", "Morocco Launches New Tech Initiative", "Hespress",
     "https://hespress.com/tech/morocco", "technologie"),
    ("art4", "UK Parliament Debates Climate Policy", "BBC News",
     "https://bbc.com/news/climate1", "environnement"),
    ("art5", "Tech Giants Post Record Quarterly Earnings", "Reuters World",
     "https://reuters.com/tech/earnings", "technologie"),
    ("art6", "Morocco Announces Education Reforms", "Hespress",
     "https://hespress.com/education", "éducation"),
]


def reasons(spark, rows):
    """rows of (title, url, canonical_url, source, content)"""
    df = spark.createDataFrame(
        [(i, *r) for i, r in enumerate(rows)],
        "i int, title string, url string, canonical_url string, source string, content string",
    ).coalesce(1)
    got = with_quarantine(df).orderBy("i").collect()
    assert all(r["quarantine"] == bool(r["reasons"]) for r in got)
    return [r["reason"] for r in got]


def test_url_rules_come_alone(spark):
    rows = [
        ("", None, None, "BBC", None),
        ("", " ", "", "BBC", None),
        ("", "HTTP://www.bbc.com/news/1", None, "BBC", None),
        ("", "ftp://x/", None, "BBC", None),
        ("", "http://[::1/x", None, "BBC", None),
        (GOOD, "ftp://x/", " https://example.org/ ", "Other", None),
    ]
    assert reasons(spark, rows) == [
        "url_missing", "url_missing", "url_invalid_scheme", "url_invalid_scheme",
        "url_parse_error", "",
    ]


def test_bracketed_hosts(spark):
    """As the standard library's parser and its address module judge them."""
    good = [
        "::", "::1", "1::", "1:2:3:4:5:6:7:8", "1:2:3:4:5:6:7::", "::2:3:4:5:6:7:8", "1::3:4:5:6:7:8",
        "fe80::1%eth0", "::ffff:192.168.0.1", "1:2:3:4:5:6:1.2.3.4", "ABCD:ef01::", "v1.x", "vF0.a:b",
    ]
    bad = [
        "", "::g", "1", "1:2", ":::", "1::2::3", "1:2:3:4:5:6:7:8:9", "1:2:3:4:5:6:7::8", ":1::2", "1::2:",
        "12345::", "fe80::1%", "fe80::1%a%b", "1.2.3.4", "::1.2.3", "::256.1.1.1", "::01.2.3.4", "b", "v1", "vg.x",
    ]
    hosts = [(f"http://[{h}]/x", False) for h in good] + [(f"http://[{h}]/x", True) for h in bad]
    hosts += [
        ("http://u:p@[::1]:80/x", False), ("http://[::1]:", False), ("http://[::1]80/", True),
        ("http://a[b]/x", True), ("http://a[::1]/x", True), ("http://[::1/x", True),
        ("http://::1]/x", True), ("http://][/", True), ("http://[::1][::1]/", True),
        ("http://x.org/[a]?b=]", False), ("http://x.org", False),
    ]
    df = spark.createDataFrame(hosts, "u string, want boolean").coalesce(1)
    got = df.select("u", has_broken_host(F.col("u")).alias("got"), "want").collect()
    assert [(r["u"], r["got"]) for r in got] == [(r["u"], r["want"]) for r in got]


def test_title_rules(spark):
    url = "https://example.org/"
    rows = [
        (t, url, None, "x", None)
        for t in [
            None, "1234567", "12345678", "Please Sign In now", "AAAAAAAAbb", "AAAAAAAAAb",
            "AAAAA", "abcdefg...", "abcdef....",
        ]
    ]
    assert reasons(spark, rows) == [
        "title_missing", "title_too_short", "", "title_generic", "", "title_all_caps",
        "title_too_short", "", "title_overpunctuated",
    ]


def test_sparse_content_needs_a_short_title(spark):
    url = "https://example.org/"
    rows = [
        ("t" * 24, url, None, "x", "c" * 79), ("t" * 25, url, None, "x", "c" * 79),
        ("t" * 24, url, None, "x", "c" * 80), ("t" * 24, url, None, "x", " \n"),
    ]
    assert reasons(spark, rows) == ["content_sparse", "", "", ""]


def test_publisher_rules(spark):
    rows = [
        (GOOD, u, None, s, None)
        for s, u in [
            ("BBC News", "https://www.bbc.com:443/news/x"), ("my bbc", "https://bbc.co.uk/news/x"),
            ("bbc", "https://www.bbc.com"), ("BBC reuters", "https://reuters.com/world/x"),
            ("Hespress", "https://fr.hespress.com/1.html;v=2"), ("Hespress", "https://x.org/a"),
            ("Reuters", "https://www.reuters.com/legal/x"), ("Reuters", "https://reuters.com/x"),
        ]
    ]
    both = "url_domain_mismatch;url_path_unexpected"
    assert reasons(spark, rows) == [
        "", "url_domain_mismatch", "", both, "", both, "", "url_path_unexpected",
    ]


def test_reason_text_is_cut(spark):
    title = "LOGIN!!!!"
    rows = [(title, "https://x.org/a", None, "bbc", "c")]
    text = reasons(spark, rows)[0]
    assert text.split(";") == [
        "title_generic", "title_overpunctuated", "content_sparse", "url_domain_mismatch",
        "url_path_unexpected",
    ]
    assert len(text) <= 200


def test_suspicious(spark):
    titles = [None, "", "  short  ", "A long title of live things", "ABCDEFGHIJKLMNOP",
              "An ordinary headline"]
    df = spark.createDataFrame([(t,) for t in titles], "t string").coalesce(1)
    got = [r[0] for r in df.select(suspicious_title(F.col("t"))).collect()]
    assert got == [True, True, True, True, True, False]
    rows = [
        (None, "x", True), ("ftp://a/", "x", True), ("https://a/", None, False),
        ("https://www.bbc.com/news/1", "BBC News", False), ("https://www.bbc.com", "bbc news", True),
        ("https://hespress.org/a.html", "Hespress", True), ("https://a/", "the bbc news", False),
        ("https://reuters.com/a/world/b", "Reuters World", False),
    ]
    df = spark.createDataFrame(rows, "u string, s string, want boolean").coalesce(1)
    got = df.select(suspicious_url(F.col("u"), F.col("s")).alias("got"), "want").collect()
    assert [r["got"] for r in got] == [r["want"] for r in got]


def test_unknown_flag_is_reliable(spark):
    df = spark.createDataFrame([(1, True), (2, False), (3, None)], "id int, quarantine boolean")
    good, bad = split_quarantine(df)
    assert sorted(r["id"] for r in good.collect()) == [2, 3]
    assert [r["id"] for r in bad.collect()] == [1]


def test_seed_articles(spark):
    df = spark.createDataFrame(
        [(*s, None, None) for s in SEEDS],
        "article_id string, title string, source string, url string, category string, "
        "content string, published_at timestamp_ntz",
    )
    judged = {r["article_id"]: r["reason"] for r in with_quarantine(df).collect()}
    odd = "url_path_unexpected"
    assert judged == {"art1": "", "art2": "", "art3": odd, "art4": "", "art5": odd, "art6": odd}

    def counts(frame, key):
        return {r[key]: r["articles_count"] for r in gold.count_by(frame, key).collect()}

    assert counts(gold.with_theme(df, "content"), "theme") == {
        "autre": 2, "technologie": 2, "economie": 1, "politique": 1,
    }
    assert counts(lookups.with_country(df), "source_country") == {"International": 4, "Maroc": 2}
    assert counts(df, "source") == {"BBC News": 2, "Hespress": 2, "Reuters World": 2}
    words = {r["keyword"]: r["frequency"] for r in gold.top_keywords(df, "title", 100).collect()}
    assert {w for w, n in words.items() if n == 2} == {"morocco", "tech"}
