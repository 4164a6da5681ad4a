import duckdb
import pytest
from conftest import SF
from starforge.llm import queries, urls

RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("example.org", "/en/12", "allow"),
    ("a.example.org", "", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
    ("com", "/de/", "allow"),
    ("", "/private", "block"),
]
URLS = [
    "http://example.org/es/1", "https://www.Example.ORG/en/12?x=/es/", "http://a.example.org", "http://b.a.example.org/en/1",
    "http://x.org", "http://x.org/", "http://x.org#/es/", "http://notexample.org/es/", "http://organic/es/", "http://shop.com/fr/a",
    "http://shop.com/de/a", "ftp://com/de/", "http://com./de/", "no scheme.com/de/", None, "", "://", "://com/fr/?q", "http://u.net/private/1",
    "a://b://c.org/x", "http://shop.com:80/de/", "http://É.org/ß", "http://" + "a." * 3000 + "org/" + "p" * 5000, "http://shop.com/fr/a", "http://x\n.org/\n",
]


def brute(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.index(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    path = path[: min([path.index(c) for c in "?#" if c in path] or [len(path)])]
    fits = [
        (len(h) + len(p), len(h), h, p, v)
        for h, p, v in RULES
        if (not h or host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fits, default=None)
    return (url, host, path, best and best[2] + best[3], best[4] if best else "allow")


def judge(spark, pairs, rules=RULES):
    pages = spark.createDataFrame([(i, u, "h", 3) for i, u in pairs], "page_id long, url string, host string, key int")
    out = urls.judged(pages, spark.createDataFrame(rules, "host string, path string, verdict string"))
    assert out.columns == ["page_id", "url", "key", "host", "path", "rule", "verdict"]
    return sorted((r["url"], r["host"], r["path"], r["rule"], r["verdict"]) for r in out.collect() if r["url"] is not None), out


def test_against_brute_force(spark):
    got, out = judge(spark, list(enumerate(URLS)))
    assert got == sorted(brute(u) for u in URLS if u is not None)
    assert [(r["host"], r["path"], r["rule"], r["verdict"]) for r in out.collect() if r["url"] is None] == [("", "", None, "allow")]


def test_many_nested_rules_over_many_parts(spark):
    rules = [("x.org", "/a" * k, "block" if k % 2 else "allow") for k in range(1, 40)]
    pairs = [(k, f"http://s{k % 3}.x.org{'/a' * k}/b") for k in range(60)]
    got, _ = judge(spark, pairs, rules)
    assert {u: r for u, _, _, r, _ in got} == {u: None if not k else "x.org" + "/a" * min(k, 39) for k, u in pairs}


@pytest.mark.parametrize("rules", [[], RULES])
def test_empty(spark, rules):
    assert judge(spark, [], rules)[0] == []
    if not rules:
        assert judge(spark, [(1, "http://x.org/")], rules)[0] == [("http://x.org/", "x.org", "/", None, "allow")]


def test_registered_query_against_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{SF}/pages.parquet'")
    want = con.execute(queries.CHECK_SQL["op4_urls"]).fetchall()
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in queries.QUERIES["op4_urls"](spark, SF).collect())
