import duckdb
from pyspark.sql import functions as F

from terravane.llm import urlfilter as uf

from ..conftest import DATA

ODD_URLS = [None, "", "no scheme", "http://", "http://org", "http://org/", "https://A.Org/x", "http://xorg/", "http://example.org/es/1?q", "http://m.example.org/en/12", "http://example.org/en/1", "http://example.com/fr/", "http://example.com/de/a#b", "http://example.com?/fr/", "ftp://b.com/de/x://y", "http://example.org./es/", "http://a.org/\n/x", "http://example.org/es/1?q"]


def plain(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, path = "".join(c.lower() if c.isascii() else c for c in rest[:cut]), rest[cut:]
    path = path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fit = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, key=lambda f: f[:2], default=None)
    return host, path, best and best[2], best[3] if best else "allow"


def test_equals_plain_rules(spark):
    rules = [*uf.RULES, ("net", "", "block"), ("b.net", "/a/b", "allow"), ("a.b.net", "/a", "block"), ("b.net", "/a/b", "block")]
    urls = [*ODD_URLS, "http://net", "http://x.b.net/a/b/c", "http://a.b.net/a/b", "http://z.a.b.net/a", "http://a.b.net/x"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("host", F.lit("clash"))
    rows = {r.page_id: tuple(r)[1:] for r in uf.judge(pages, uf.rule_table(spark, rules)).collect()}
    last = {(h, p): v for h, p, v in sorted(rules)}
    assert rows == {i: plain(u, [(h, p, v) for (h, p), v in last.items()]) for i, u in enumerate(urls)}


def test_equals_sql(spark):
    con = duckdb.connect()
    con.sql(f"create view pages as select * from '{DATA}/pages.parquet'")
    assert sorted(map(tuple, uf.op5_url_filters(spark, DATA).collect()), key=repr) == sorted(map(tuple, con.sql(uf.ORACLE).fetchall()), key=repr)


def test_empty_and_repeated(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    assert uf.judge(none, uf.rule_table(spark, uf.RULES)).count() == 0
    twice = spark.createDataFrame([(1, "http://a.com/fr/")] * 3, "page_id long, url string")
    assert [r.rule for r in uf.judge(twice, uf.rule_table(spark, uf.RULES)).collect()] == ["com/fr/"] * 3
    assert {r.verdict for r in uf.judge(twice, uf.rule_table(spark, []), default="block").collect()} == {"block"}
