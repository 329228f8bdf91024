from pyspark.sql import functions as F
from parcela.llm import urls


def test_parts(spark):
    given = ["HTTP://WWW.Example.COM/En/x?q#f", "a://h", "a://h?x/y", "a://h#f", "no scheme/x", None, "", "x://É.COM:80/a://b/c", "://", "a:///p"]
    host, path = urls.parts()
    df = spark.createDataFrame([(i, u) for i, u in enumerate(given)], "i int, url string")
    got = [tuple(r) for r in df.orderBy("i").select(host, path).collect()]
    assert got == [("www.example.com", "/En/x"), ("h", ""), ("h", ""), ("h", ""), ("", ""), ("", ""), ("", ""), ("É.com:80", "/a://b/c"), ("", ""), ("", "/p")]


def test_longest_rule_wins(spark):
    given = {"a://b.com/x": "com/", "a://com/": "com/", "a://xcom/": None, "a://b.com": None, "a://example.com/en/1": "example.com/en/", "a://m.example.com/en/": "example.com/en/", "a://www.example.com/en/1": "www.example.com/en/", "a://x.www.example.com/en/1": "www.example.com/en/", "a://myexample.com/en/1": "com/", "a://b.net/es/1": "net/es/", "a://b.net/es": None, "a://b.net/fr/?x": "net/fr/"}
    pages = spark.createDataFrame(list(enumerate(given)), "page_id bigint, url string")
    out = urls.judge(pages, spark.createDataFrame([], "page_id bigint, bad int")).orderBy("page_id").collect()
    assert [r.rule for r in out] == list(given.values())
    assert {r.verdict for r in out if r.rule in ("net/es/", "net/fr/", "example.com/en/")} == {"block"}
    assert {r.verdict for r in out if r.rule is None} == {"allow"}


def test_reputation_shrinks(spark):
    rows = [("bad.evil.org", 60, 55), ("new.evil.org", 1, 1), ("good.fine.org", 80, 4), ("new.fine.org", 1, 1), ("other.fine.org", 40, 2), ("none.fine.org", 0, 0)]
    out = {r.host: r for r in urls.reputation(spark.createDataFrame(rows, "host string, n bigint, bad bigint")).collect()}
    assert out["bad.evil.org"].low > 0.5 > out["good.fine.org"].high
    assert out["new.evil.org"].mean > out["new.fine.org"].mean  # one page alike, other company
    assert out["none.fine.org"].mean < 0.5 and out["none.fine.org"].high - out["none.fine.org"].low > out["good.fine.org"].high - out["good.fine.org"].low
    pages = spark.createDataFrame([(i, f"http://{h}/x") for i, h in enumerate(["bad.evil.org"] * 60 + ["good.fine.org"] * 60)], "page_id bigint, url string")
    outcomes = spark.createDataFrame([(i, int(i < 56)) for i in range(120)], "page_id bigint, bad int")
    verdicts = {(r.host, r.verdict) for r in urls.judge(pages, outcomes).collect()}
    assert verdicts == {("bad.evil.org", "block"), ("good.fine.org", "allow")}


def test_outcomes_and_odd_rows(spark):
    pages = spark.createDataFrame([(1, "a://h/en/7?x", 1), (1, "a://h/en/7?x", 1), (2, "a://h/en/8.html", 1), (3, "a://h/en/9/", 1), (4, None, 1), (None, "a://h/en/x7", 1)], "page_id bigint, url string, host int")
    labels = spark.createDataFrame([(7, 0, 0), (7, 0, 0), (8, 1, 1), (9, 1, 0), (10, None, None)], "doc_id bigint, quality int, toxic int")
    outcomes = urls.outcomes_of(pages, labels)
    assert sorted(map(tuple, outcomes.collect())) == [(1, 1), (2, 1), (3, 0)]
    assert urls.judge(pages, outcomes).count() == 6
    assert urls.judge(pages.limit(0), outcomes.limit(0)).count() == 0


def test_suffix_and_domain(spark):
    want = {
        "a.b.example.com": ("com", "example.com"), "x.y.co.uk": ("co.uk", "y.co.uk"), "co.uk": ("co.uk", "co.uk"), "user:pw@shop.example.com:8080": ("com", "example.com"),
        "10.0.0.1:80": ("10.0.0.1", "10.0.0.1"), "[::1]:8080": ("[::1]", "[::1]"), "localhost": ("localhost", "localhost"), "": ("", ""), "me.example.de": ("de", "example.de"),
    }
    suffix, domain = urls.names_of()
    out = spark.createDataFrame([(h,) for h in want], "host string").select("host", F.expr(suffix), F.expr(domain)).collect()
    assert {r[0]: (r[1], r[2]) for r in out} == want
