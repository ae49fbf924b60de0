from pyspark.sql import functions as F

from moodloom.llm import url_filter

CASES = {
    "http://a.org/x": ("a.org", "/x", "org/", "allow"),
    "http://org/": ("org", "/", "org/", "allow"),
    "http://a.org": ("a.org", "", None, "allow"),
    "http://aorg.com/": ("aorg.com", "/", None, "allow"),
    "HTTP://M.Example.ORG/es/1?q#z": ("m.example.org", "/es/1", "example.org/es/", "block"),
    "http://example.org/ES/1": ("example.org", "/ES/1", "org/", "allow"),
    "http://example.org/en/12": ("example.org", "/en/12", "example.org/en/1", "block"),
    "http://example.org/en/2": ("example.org", "/en/2", "org/", "allow"),
    "http://badexample.org/en/1": ("badexample.org", "/en/1", "org/", "allow"),
    "http://x.com/fr/": ("x.com", "/fr/", "com/fr/", "allow"),
    "http://x.com/de/?": ("x.com", "/de/", "com/de/", "block"),
    "http://x.com#/de/": ("x.com", "", None, "allow"),
    "x.com/de/": ("", "", None, "allow"),
    "": ("", "", None, "allow"),
    None: ("", "", None, "allow"),
    "http://É.com/a://b": ("É.com", "/a://b", None, "allow"),
    "http:///p": ("", "/p", None, "allow"),
}


def test_host_path_and_rules(spark):
    rows = [(i, url, "other") for i, url in enumerate(CASES)]
    pages = spark.createDataFrame(rows, "page_id long, url string, verdict string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.filter_urls(pages, pages.limit(0)).collect()}
    assert got == dict(enumerate(CASES.values()))


def test_canonical(spark):
    same = [
        "http://www.a.net/x/?b=2&utm_source=q&a=1#f", "https://A.NET/x.html?a=1&b=2", "http://a.net:80/x//?a=1&b=2&ref=z",
    ]
    other = ["http://a.net/x", "http://a.net/X?a=1&b=2", "http://a.net/x?a=1&b=2&refer=1"]
    df = spark.createDataFrame([(u,) for u in [*same, *other]], "url string")
    keys = [r[0] for r in df.select(url_filter.canonical(F.col("url"))).collect()]
    assert set(keys[:3]) == {"a.net/x?a=1&b=2"} and len(set(keys)) == 4


def brute_list(urls, listed, key):
    known = {key[u] for u in listed if key[u] is not None}
    return [u is not None and key[u] in known for u in urls]


def check(spark, urls, listed):
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id long, url string, block string")
    table = spark.createDataFrame([(u, 1) for u in listed], "url string, page_id int")
    keys = spark.createDataFrame([(u,) for u in {*urls, *listed}], "url string")
    key = {r.url: r.k for r in keys.select("url", url_filter.canonical(F.col("url")).alias("k")).collect()}
    got = {r.page_id: r.listed for r in url_filter.filter_urls(pages, table, rules=[]).collect()}
    assert [got[i] for i in range(len(urls))] == brute_list(urls, listed, key)
    assert len(got) == len(urls)


def test_list_is_exact(spark, monkeypatch):
    urls = [f"http://h{i % 7}.net/{i}" for i in range(400)] + ["http://hot.net/"] * 200 + [None, "", "x"]
    listed = [f"http://h{i % 7}.net/{i}/" for i in range(0, 400, 3)] + ["http://www.hot.net", None, "http://hot.net/"]
    check(spark, urls, listed)
    # One block is full of bits and lets all through: the join still decides.
    monkeypatch.setattr(url_filter, "MAX_BLOCKS", 1)
    check(spark, urls, listed)


def test_bloom_filter_has_no_false_negatives(spark):
    keys = spark.range(500).select(F.concat(F.lit("u"), "id").alias("k"))
    bloom = url_filter.bloom_blocks(keys, "k", 16)
    assert bloom.count() <= 16
    joined = keys.withColumn("block", url_filter._block(F.col("k"), 16)).join(bloom, "block", "left")
    for i, word in enumerate(url_filter._words(F.col("k"))):
        joined = joined.where(F.col(f"word{i}").bitwiseAND(word) == word)
    assert joined.count() == 500


def test_empty_pages(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    assert url_filter.filter_urls(pages, pages).count() == 0


def test_main_path_is_native(spark):
    pages = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    plan = url_filter.filter_urls(pages, pages)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
