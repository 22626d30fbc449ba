from edge import SF

from stray.llm import hosts as H

PAGES = "page_id long, url string, html string"
LABELS = "doc_id long, quality int, toxic int"


def judged(spark, urls, marks=()):
    pages = spark.createDataFrame([(i, u, None) for i, u in enumerate(urls)], PAGES)
    return {r.page_id: r for r in H.url_filter(pages, spark.createDataFrame(list(marks), LABELS)).collect()}


def test_parts_and_rules(spark):
    urls = ["http://A.Example.ORG/es/1", "https://example.org/en/12?x#y", "http://x.org", "http://x.com/fr/", "http://com/de/2?q",
            None, "no scheme", "http://notexample.org/es/", "ftp://É.net:80/a?b/c", "http://h.net?x=http://y.org/"]
    got = judged(spark, urls)
    assert [(got[i].host, got[i].path, got[i].rule, got[i].verdict) for i in range(len(urls))] == [
        ("a.example.org", "/es/1", "example.org/es/", "block"), ("example.org", "/en/12", "example.org/en/1", "block"),
        ("x.org", "", None, "allow"), ("x.com", "/fr/", "com/fr/", "allow"), ("com", "/de/2", "com/de/", "block"),
        ("", "", None, "allow"), ("", "", None, "allow"), ("notexample.org", "/es/", "org/", "allow"),
        ("É.net:80", "/a", None, "allow"), ("h.net", "", None, "allow")]


def test_bad_hosts_are_blocked_and_small_ones_shrunk(spark):
    urls = ([f"http://bad.one.net/en/{i}" for i in range(60)] + [f"http://good.two.net/en/{i}" for i in range(60, 160)]
            + ["http://new.three.net/en/160"] + ["http://unseen.net/x"] * 2)
    marks = [(i, 0 if i < 60 else 1, 0) for i in range(160)] + [(160, 0, 0), (160, None, None), (None, 0, 1)]
    got = judged(spark, urls, marks)
    assert got[0].verdict == "block" and got[70].verdict == "allow"
    assert got[70].bad_rate < got[160].bad_rate and got[160].bad_rate_low < got[0].bad_rate_low  # one bad page proves little
    assert got[161].verdict == "allow"


def test_domains(spark):
    df = spark.createDataFrame([("a.b.co.uk",), ("b.example.com:8080",), ("10.0.0.1",), ("local",), ("",)], "h string")
    d, s = H.domain_and_suffix(df["h"])
    assert [tuple(r) for r in df.select(d, s).collect()] == [
        ("b.co.uk", "co.uk"), ("example.com", "com"), ("10.0.0.1", ""), ("local", ""), ("", "")]


def test_empty_and_repeated(spark):
    assert judged(spark, []) == {}
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    twice = H.url_filter(pages.unionByName(pages), labels)
    assert twice.count() == 2 * pages.count()
