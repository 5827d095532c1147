from pyspark.sql import functions as F

from stayline.llm import url_filter


def judged(spark, urls, listed=()):
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("host", F.lit("extra"))
    rows = spark.createDataFrame([(u,) for u in listed], "url string")
    return {urls[r.page_id]: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(pages, rows).collect()}


def test_hosts_paths_and_rules(spark):
    got = judged(spark, [None, "", "no scheme/here", "http://Ex.ORG", "https://a.example.org/es/x?y#z", "x://example.org/en/12",
                         "x://example.org/en/2", "http://a.com/de/1", "http://com/fr/1", "http://notcom/de/1", "http://a.com?b=/de/",
                         "http://xorg/", "a://b://c/d"])
    assert got[None] == got[""] == got["no scheme/here"] == ("", "", None, "allow")
    assert got["http://Ex.ORG"] == ("ex.org", "", None, "allow")
    assert got["https://a.example.org/es/x?y#z"] == ("a.example.org", "/es/x", "example.org/es/", "block")
    assert got["x://example.org/en/12"] == ("example.org", "/en/12", "example.org/en/1", "block")
    assert got["x://example.org/en/2"] == ("example.org", "/en/2", "org/", "allow")
    assert got["http://a.com/de/1"][2:] == ("com/de/", "block")
    assert got["http://com/fr/1"][2:] == ("com/fr/", "allow")
    assert got["http://notcom/de/1"][2:] == got["http://xorg/"][2:] == (None, "allow")
    assert got["http://a.com?b=/de/"] == ("a.com", "", None, "allow")
    assert got["a://b://c/d"] == ("b:", "//c/d", None, "allow")


def test_list_is_exact(spark):
    listed = [f"site{i}.net/p/{i}" for i in range(2000)]
    urls = [f"https://www.site{i}.net/p/{i}.html?utm_source=f#x" for i in range(0, 4000, 7)]
    got = judged(spark, urls, listed)
    for i, u in zip(range(0, 4000, 7), urls):
        assert got[u][3] == ("block" if i < 2000 else "allow")


def test_filter_rules_out_most(spark):
    keys = spark.range(5000).selectExpr("concat('k', id) AS key")
    n_blocks = 1 << 11
    blocks = url_filter.bloom_filter(keys, n_blocks)
    others = spark.range(5000, 25000).selectExpr("concat('k', id) AS key").withColumn(
        "__block", url_filter.bloom_block(F.col("key"), n_blocks))
    want = url_filter.bloom_bits(F.col("key"))
    passed = others.join(blocks, "__block").filter(F.col("__bits").bitwiseAND(want) == want).count()
    own = keys.withColumn("__block", url_filter.bloom_block(F.col("key"), n_blocks)).join(blocks, "__block").filter(
        F.col("__bits").bitwiseAND(want) == want).count()
    assert own == 5000 and passed < 0.05 * 20000


def test_empty(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    listed = spark.createDataFrame([], "url string")
    assert url_filter.judge(pages, listed).count() == 0
    assert judged(spark, ["http://a.b/c"], [])["http://a.b/c"][3] == "allow"
