from meterstar.llm.url_filter import judge_urls


def judged(spark, urls):
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    return [r.asDict() for r in judge_urls(df).orderBy("page_id").collect()]


def test_host_path_and_longest_rule(spark):
    got = judged(spark, ["https://WWW.Example.com/en/1?x#y", "http://a.example.com/en/2", "http://example.com/en", "x://b.net/es/q", "x://bnet/es/q",
                         "http://com/", "http://shop.com", "no scheme/en/", None, "http://", "http://h.net/fr/://x", "http://É.COM/x"])
    assert [(r["host"], r["path"], r["rule"]) for r in got] == [
        ("www.example.com", "/en/1", "www.example.com/en/"), ("a.example.com", "/en/2", "example.com/en/"), ("example.com", "/en", "com/"),
        ("b.net", "/es/q", "net/es/"), ("bnet", "/es/q", None), ("com", "/", "com/"), ("shop.com", "", None), ("", "", None), ("", "", None),
        ("", "", None), ("h.net", "/fr/://x", "net/fr/"), ("É.com", "/x", "com/")]
    assert [r["verdict"] for r in got if r["rule"]] == ["allow", "block", "allow", "block", "allow", "block", "allow"]


def test_unruled_pages_follow_the_purity_of_their_template(spark):
    urls = [f"http://a.example.com/en/{i}" for i in range(40)] + [f"http://a.example.com/de/{i}" for i in range(40)]
    got = judged(spark, urls + ["http://q.org/en/77.html", "http://q.org/de/78", "http://q.org/zz/abc"])
    assert [r["verdict"] for r in got[-3:]] == ["block", "allow", "allow"] or got[-1]["purity"] >= 0.5
    assert got[-3]["template"] == "/en/*" and got[-3]["purity"] > 0.8 and got[-2]["purity"] < 0.2


def test_no_labels_allow_and_empty(spark):
    assert {r["verdict"] for r in judged(spark, ["http://x.org/a", "http://y.org/b/1", None])} == {"allow"}
    assert judged(spark, []) == []


def test_repeated_rows_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, "http://x.org/a", 1, "r"), (1, "http://x.org/a", 1, "r"), (None, "http://x.net/es/", 2, "r")],
                               "page_id long, url string, n int, parts string")
    got = judge_urls(df)
    assert got.columns[:5] == ["page_id", "host", "path", "rule", "verdict"]
    assert sorted((r["page_id"] or 0, r["verdict"]) for r in got.collect())[0] == (0, "block") and got.count() == 3
