import random

from pyspark.sql import functions as F

from sparktab.llm import urls
from sparktab.llm.queries import QUERIES, listed_pages
from sparktab.llm.urls import bloom_blocks, canonical, listed_urls, url_filter


def plain(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    at = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, rest = rest[:at], rest[at:]
    end = min([rest.find(c) for c in "?#" if c in rest], default=len(rest))
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), rest[:end]


def plain_rule(host, path):
    rules = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
    best = None
    for rule in rules:
        h, p = rule.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(rule) > len(best)):
            best = rule
    return best, rules.get(best)


URLS = [
    None, "", "example.com/x", "http://", "HTTP://WWW.Example.COM/de/1", "http://a.example.com/de", "http://example.com/de/", "http://notexample.com/de/1",
    "http://x.net", "http://x.net/", "https://example.net/en/a?b#c", "https://sub.example.net/EN/a", "ftp://org/fr/", "ftp://x.org/fr/q", "http://x.org?://y/fr/",
    "http://bad.com/1", "http://bad.com/1/", "https://www.bad.com:80/1?x", "http://m.bad.com/1/index.html", "http://É.com/Ä", "a://b://c/d", "http://bad.com/2", "http://x.com/\n/y",
]


def test_every_kind_of_url(spark):
    rng = random.Random(8)
    more = ["http://" + "".join(rng.choices(["a", "example", ".", "com", "net", "org", "/", "de/", "en/", "fr/", "?", "#", ":", "://", "Z"], k=8)) for _ in range(300)]
    df = spark.createDataFrame([(i, u, "x") for i, u in enumerate(URLS + more + ["http://bad.com/1"] * 50)], "page_id int, url string, verdict string")
    listed = spark.createDataFrame([("bad.com/1",), ("bad.com/1",), (None,), ("other.com",)], "canonical string")
    out, names = url_filter(df, listed)
    rows = out.collect()
    assert len(rows) == df.count() and names["verdict"] == "verdict_"
    for r in rows:
        host, path = plain(r.url)
        rule, verdict = plain_rule(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule), r.url
        assert r.verdict_ == (verdict or ("block" if r.canonical == "bad.com/1" else "allow"))
    assert {r.url for r in rows if r.canonical == "bad.com/1"} == {u for u in URLS if u and "bad.com" in u and "/1" in u}
    assert url_filter(df, listed.where("false"))[0].where("verdict_ = 'block' and rule is null").count() == 0
    assert url_filter(df.where("false"), listed)[0].count() == 0


def test_filter_passes_all_listed_and_few_others(spark):
    listed = spark.range(5000).select(F.concat(F.lit("l.com/"), "id").alias("canonical"))
    others = spark.range(20000).select(F.concat(F.lit("o.com/"), "id").alias("canonical"))
    blocks = 5000 * urls.BITS_PER_URL // 256
    bloom = bloom_blocks(listed, "canonical", blocks)
    block, bits = urls._place(F.col("canonical"), blocks)

    def passed(df):
        probes = df.select("canonical", block.alias("block"), *[b.alias(f"b{i}") for i, b in enumerate(bits)])
        return probes.join(bloom, "block").where(" and ".join(f"w{i} & b{i} <> 0" for i in range(8))).count()

    assert passed(listed) == 5000
    assert passed(others) < 200
    both = listed.unionByName(others)
    assert listed_urls(both, listed).exceptAll(listed).count() == 0
    assert listed_urls(both, listed).count() == 5000


def test_large_filter_is_joined(spark, monkeypatch):
    monkeypatch.setattr(urls, "SEND_BYTES", 0)
    listed = spark.createDataFrame([("a.com/1",), ("b.com/2",)], "canonical string")
    df = spark.createDataFrame([("a.com/1",), ("c.com/3",)], "canonical string")
    assert [r.canonical for r in listed_urls(df, listed).collect()] == ["a.com/1"]


def test_canonical(spark):
    df = spark.createDataFrame([("https://WWW.a.com:443/b//index.htm?x#y",), ("x",), (None,)], "u string")
    assert [r[0] for r in df.select(canonical(F.col("u"))).collect()] == ["a.com/b", None, None]


def test_false_hits_reach_the_join_and_go(spark, monkeypatch):
    """A filter too small for its list lets many others through; none of them stays."""
    monkeypatch.setattr(urls, "BITS_PER_URL", 2)
    listed = spark.range(3000).select(F.concat(F.lit("l.com/"), "id").alias("canonical"))
    others = spark.range(3000).select(F.concat(F.lit("o.com/"), "id").alias("canonical"))
    blocks = 3000 * 2 // 256
    block, bits = urls._place(F.col("canonical"), blocks)
    probes = others.select("canonical", block.alias("block"), *[b.alias(f"b{i}") for i, b in enumerate(bits)])
    assert probes.join(bloom_blocks(listed, "canonical", blocks), "block").where(" and ".join(f"w{i} & b{i} <> 0" for i in range(8))).count() > 500
    assert sorted(listed_urls(others.unionByName(listed), listed).collect()) == sorted(listed.collect())


def test_query_blocks_by_the_list_alone(spark, small):
    rows = QUERIES["op4_url_filter"](spark, small).collect()
    listed = {r.canonical for r in listed_pages(spark).collect()}
    assert len(listed) == 540_000
    seen = {u: c for u, c in spark.read.parquet(f"{small}/pages.parquet").select("page_id", canonical(F.col("url"))).collect()}
    assert all(r.verdict == ("block" if seen[r.page_id] in listed else "allow") for r in rows if r.rule is None)
    assert listed - set(seen.values()) and all((r.host, r.path) == plain(u.url) for r, u in zip(sorted(rows), spark.read.parquet(f"{small}/pages.parquet").orderBy("page_id").collect(), strict=True))


def test_very_long_urls(spark):
    long = "http://bad.com/" + "a" * 300_000
    df = spark.createDataFrame([(1, long), (2, long + "b"), (3, long + "?" + "q" * 1000)], "page_id int, url string")
    listed = spark.createDataFrame([(long[7:],)], "canonical string")
    assert {r.page_id: r.verdict for r in url_filter(df, listed)[0].collect()} == {1: "block", 2: "allow", 3: "block"}
