from helpers import SF_DIR, nothing, rows

from coldshelf.llm import queries, url_filter


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1].split("#", 1)[0].split("?", 1)[0]
    host, slash, path = rest.partition("/")
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), slash + path


def plain_rule(host, path, rules=url_filter.RULES):
    fit = [r for r in rules if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
    return max(fit, key=lambda r: len(r[1] + r[2]), default=None)


def expected(pages):
    made = []
    for i, url in pages:
        host, path = plain_parts(url)
        rule = plain_rule(host, path)
        made.append((i, host, path, rule and rule[1] + rule[2], rule[0] if rule else "allow"))
    return made


def test_query_on_pages_without_links(spark):
    got = [tuple(r) for r in queries.op6_url_filter(spark, SF_DIR).collect()]
    assert sorted(got) == sorted(expected(rows("pages", "page_id, url")))


PAGES = [
    (1, "http://bad.example.com/en/1", None),  # blocked by rule
    (2, "http://mirror.org/1", '<LINK rel="canonical" href="http://bad.example.com/en/1">'),
    (3, "http://copy.org/x", '<meta http-equiv="refresh" content="0; url=http://mirror.org/1/#top">'),
    (4, "http://fine.org/a", '<link rel=canonical href="https://www.example.com/en/9">'),  # allowed by rule
    (5, "http://both.org/", '<link rel="canonical" href="http://fine.org/a"><meta http-equiv=refresh content="1;url=//bad.example.com/en/7">'),
    (6, "http://example.net/fr/2", '<link rel="canonical" href="http://fine.org/a">'),  # its own rule stays
    (7, "http://alone.org/2", '<link rel="stylesheet" href="http://bad.example.com/en/1">'),
    (8, None, '<link rel="canonical" href="http://bad.example.com/en/1">'),
    (9, "no scheme", ""),
    (None, "HTTP://Mirror.ORG?utm_source=x", None),
    (2, "http://mirror.org/1?utm_source=feed", None),
    (10, "http://rel.org/d/page", '<link rel="canonical" href="other"><p>'),
    (11, "http://rel.org/d/other", '<meta http-equiv="Refresh" content="0;URL=\'http://y.example.com/en/\'">'),
]


def test_aliases(spark):
    frame = spark.createDataFrame([(*p, "x") for p in PAGES], "page_id long, url string, html string, verdict string")
    got = [(r.page_id, r.rule, r.verdict) for r in url_filter.judge(spark, frame).collect()]
    want = [
        (1, "example.com/en/", "block"), (2, None, "block"), (2, None, "block"), (3, None, "block"), (4, None, "allow"),
        (5, None, "allow"), (6, "net/fr/", "block"), (7, None, "allow"), (8, None, "allow"), (9, None, "allow"),
        (10, None, "block"), (11, None, "block"), (None, None, "allow"),
    ]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_aliases_equal_their_sql(spark, tmp_path):
    import duckdb
    from compare import differences

    frame = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    frame.write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    assert differences(queries.op6_url_filter(spark, str(tmp_path)), con, queries.ORACLE["op6_url_filter"]) is None


def test_redirect_table_and_empty_table(spark):
    frame = spark.createDataFrame([(1, "http://a.org/", None)], "page_id long, url string, html string")
    redirects = spark.createDataFrame(
        [("http://a.org", "http://b.org"), ("https://b.org/", "http://example.com/en/"), (None, "http://a.org")],
        "from_url string, to_url string",
    )
    assert [r.verdict for r in url_filter.judge(spark, frame, redirects=redirects).collect()] == ["block"]
    assert url_filter.judge(spark, nothing(frame)).collect() == []
