from featherloom.llm.queries import RULES
from featherloom.llm.url_filter import BITS_PER_KEY, blocked_bloom, filter_urls, may_hold
from pyspark.sql import functions as F


def truth(url, rules=RULES):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.index(c) for c in "/?#" if c in rest] or [len(rest)])
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        tail = rest[cut:]
        path = tail[:min([tail.index(c) for c in "?#" if c in tail] or [len(tail)])]
    fits = [(len(h + p), h + p, v) for h, p, v in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, None, "allow"))
    return host, path, best[1], best[2]


URLS = [None, "", "no scheme", "http://ORG", "http://Org/", "https://a.example.org/es/x?y=/z#q",
        "https://example.org/en/1", "https://example.org/en/12?x", "http://example.org/en/2",
        "http://notexample.org/es/", "http://x.com/fr/a", "http://x.COM/de/a", "http://com/de",
        "http://x.com?/de/", "http://x.com#/fr/", "http://É.org/é", "a://b://c.org/d",
        "http://x.com/de/" + "a/" * 5000, "http://..org/", "://org/", "http://x.com:80/de/",
        "http://x.com/fr/\n/de/", "http://x.net/de/"]


def test_against_rules_one_by_one(spark):
    rows = [(i % 7, u, "h", 3) for i, u in enumerate(URLS + URLS[:4])]
    df = spark.createDataFrame(rows, "page_id long, url string, host string, judged_host int")
    rules = spark.createDataFrame([*RULES, (None, "/", "block"), RULES[0]],
                                  "host string, path string, verdict string")
    out = filter_urls(df, rules)
    assert out.columns == ["page_id", "url", "judged_host", "host", "path", "rule", "verdict"]
    got = sorted((r.page_id, r.url or "", r.host, r.path, r.rule or "", r.verdict)
                 for r in out.collect())
    want = []
    for page, url, *_ in rows:
        h, p, r, v = truth(url)
        want.append((page, url or "", h, p, r or "", v))
    assert got == sorted(want)
    assert filter_urls(df.limit(0), rules).count() == 0
    assert {r.verdict for r in filter_urls(df, rules.limit(0)).collect()} == {"allow"}


def test_filter_holds_every_key_and_few_others(spark):
    keys = spark.range(2000).select(F.concat(F.lit("k"), "id").alias("key"))
    blocks = 2000 * BITS_PER_KEY // 512
    words = blocked_bloom(keys, "key", blocks)
    assert keys.where(may_hold(words.scalar(), F.col("key"), blocks)).count() == 2000
    other = spark.range(20000).select(F.concat(F.lit("no"), "id").alias("key"))
    assert other.where(may_hold(words.scalar(), F.col("key"), blocks)).count() < 400


def test_columns_named_like_added_ones_in_any_case(spark):
    df = spark.createDataFrame([(1, "http://x.org/", "a", "b", {"k": 1}, 7)],
                               "page_id long, url string, Host string, RULE string, "
                               "m map<string, int>, `__hot` int")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    out = filter_urls(df, rules)
    assert out.columns == ["page_id", "url", "m", "__hot", "host", "path", "rule", "verdict"]
    assert out.first()[:] == (1, "http://x.org/", {"k": 1}, 7, "x.org", "/", "org/", "allow")


def test_rows_of_one_url_spread_over_tasks(spark):
    df = spark.range(0, 4000, 1, 8).select("id", F.when(F.col("id") % 3 == 0, F.concat(
        F.lit("http://h.org/"), "id")).otherwise("http://x.com/de/").alias("url"))
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        hot = filter_urls(df, rules).where("rule = 'com/de/'").groupBy(
            F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
        spark.conf.set("spark.sql.adaptive.enabled", True)
    sizes = [r["count"] for r in hot]
    assert sum(sizes) == 2666 and max(sizes) < 0.5 * sum(sizes)


def test_no_python_in_the_plan(spark, folder, monkeypatch):
    from featherloom.llm import url_filter
    from featherloom.llm.queries import op2_url_filter
    # as one plan, with nothing written in between
    monkeypatch.setattr(url_filter, "materialise", lambda df: df)
    plan = op2_url_filter(spark, folder)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
    assert "NestedLoop" not in plan and "ShuffledHashJoin" in plan
