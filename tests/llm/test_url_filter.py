from __future__ import annotations

from tallywright.llm import queries, url_filter

RULES = list(url_filter.RULES)


def judged_by_hand(url, rules=RULES, default="allow"):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
        path = rest[end:]
        path = path[: min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    fit = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fit, key=lambda r: (len(r[0] + r[1]), len(r[0]), r[2] == "block"), default=None)
    return (host, path, best[0] + best[1] if best else None, best[2] if best else default)


def test_whole_table_like_the_rules_by_hand(spark, sf):
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = queries.op2_url_filter(spark, sf).collect()
    assert len(got) == len(urls)
    assert all(tuple(r)[1:5] == judged_by_hand(urls[r.page_id]) for r in got)


ODD = [
    None,
    "",
    "no scheme",
    "http://",
    "HTTP://A.NET",
    "http://A.NET/",
    "http://net/x",
    "http://xnet/",
    "http://a.example.net/en/x?y=/de/",
    "http://a.example.net/en",
    "http://example.com/de/#f",
    "x://org/fr/a://b",
    "http://É.Net/É",
    "http://b.org:80/fr/",
    "http://" + "a." * 3000 + "net/" + "p/" * 3000,
    "http://net?x/",
]


def test_odd_urls_repeats_and_clashing_columns(spark):
    rows = [(k, u, "x", "y", "z") for k, u in enumerate(ODD)] + [(None, ODD[5], "x", "y", "z"), (5, ODD[5], "x", "y", "z")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, verdict string, rule string")
    got = url_filter.judge_urls(pages, url_filter.rule_table(spark)).collect()
    want = [(r[0], *judged_by_hand(r[1])) for r in rows]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_general_rules_prefixes_ties_and_defaults(spark):
    rules = [("b.c", "/de", "block"), ("a.b.c", "", "allow"), ("b.c", "/x", "allow"), ("b.c", "/x", "block"), ("c", "/yyy", "allow"), ("b.c", "/y", "block")]
    urls = ["h://b.c/deutsch", "h://a.b.c/de", "h://a.b.c/q", "h://b.c/x", "h://b.c/yyyy", "h://z/", "h://c"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = url_filter.judge_urls(pages, url_filter.rule_table(spark, rules), default="block").orderBy("page_id").collect()
    assert [tuple(r)[1:] for r in got] == [judged_by_hand(u, rules, "block") for u in urls]


def test_empty_tables(spark):
    pages = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    assert url_filter.judge_urls(pages.limit(0), url_filter.rule_table(spark)).count() == 0
    (only,) = url_filter.judge_urls(pages, url_filter.rule_table(spark, [])).collect()
    assert (only.rule, only.verdict) == (None, "allow")


def test_no_python_in_the_plan(spark, sf):
    plan = queries.op2_url_filter(spark, sf)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
