import datetime as dt
import random

from plover.llm import queries, url_filter as U

DAY = dt.date(2024, 1, 1)


def day(n):
    return DAY + dt.timedelta(n)


def keys(url):
    rest = url.split("://", 1)[1].split("?")[0].split("#")[0]
    host, _, path = rest.partition("/")
    labels = host.lower().split(".")
    parts = [p for p in path.split("/") if p]
    return {".".join(labels[i:]) for i in range(max(len(labels) - 1, 1))} | {
        f"{host.lower()}/{'/'.join(parts[:i + 1])}" for i in range(len(parts))}


def test_random_lists_match_brute_force(spark):
    rnd = random.Random(11)
    hosts = ["a.com", "x.a.com", "y.x.a.com", "b.org", "c"]
    entries = [(rnd.choice([*hosts, "a.com/p", "b.org/p/q"]), rnd.choice("mn"), rnd.choice(("add", "remove")), day(rnd.randrange(400)))
               for _ in range(150)] + [(None, "m", "add", day(0)), ("a.com", "m", None, day(0)), ("b.org", "m", "add", None)]
    caps = [(i, f"http://{rnd.choice(hosts)}{rnd.choice(('', '/', '/p', '/p/q/r?x=1', '/z#p'))}", day(rnd.randrange(-20, 430)))
            for i in range(300)] + [(900, None, day(3)), (901, "nonsense", day(3)), (902, "http://a.com", None), (None, "http://a.com/p", day(100))]
    caps += caps[:5]
    c = spark.createDataFrame([(*r, 1) for r in caps], "page_id long, url string, fetched date, n_entries int")
    e = spark.createDataFrame(entries, "pattern string, category string, action string, day date")
    got = {(r["page_id"], r["url"], r["fetched"]): r for r in U.filter_captures(c, e).collect()}
    assert set(got) == set(caps)
    for cap in set(caps):
        active = []
        if cap[1] and "://" in cap[1] and cap[2]:
            for p, k in {(p, k) for p, k, a, d in entries if p and a and d}:
                if p in keys(cap[1]):
                    since = None  # replay the list
                    for d in sorted({d for q, c2, a, d in entries if (q, c2) == (p, k) and a and d and d <= cap[2]}):
                        acts = {a for q, c2, a, d2 in entries if (q, c2, d2) == (p, k, d) and a}
                        since = None if "remove" in acts else since or d
                    if since:
                        active.append((-len(p), k, p, since))
        r = got[cap]
        assert (r["blocked"], r["n_entries"]) == (bool(active), len(active)), cap
        assert (r["category"], r["pattern"], r["valid_from"]) == (min(active)[1:] if active else (None, None, None))


def test_patterns_of_any_depth(spark):
    deep = "a.com/" + "/".join(f"s{k}" for k in range(30))
    patterns = ["a.com/p/q/r", "a.com/p/q/r/s/t", deep]
    urls = {"http://a.com/p/q": None, "http://a.com/p/q/r?x": patterns[0], "http://a.com/p/q/r/s": patterns[0],
            "http://A.com//p/q/r/s/t/u#z": patterns[1], f"http://{deep}/more": deep, "http://a.com": None,
            f"http://{deep.rsplit('/', 1)[0]}": None}
    c = spark.createDataFrame([(i, u, DAY) for i, u in enumerate(urls)], "page_id long, url string, fetched date")
    e = spark.createDataFrame([(p, "m", "add", day(-1)) for p in patterns], "pattern string, category string, action string, day date")
    got = {r["url"]: (r["pattern"], r["n_entries"]) for r in U.filter_captures(c, e).collect()}
    assert got == {u: (p, 0 if p is None else 1 + (p == patterns[1])) for u, p in urls.items()}


def test_patterns_are_normalised(spark):
    written = ["Example.com", "http://b.org/A/", "https://user@c.net:8080/x//y?q=1#z", "//d.io./p", "e.com.", " f.com ", "/only/path", "", "ftp://"]
    e = spark.createDataFrame([(p, "m", "add", day(-1)) for p in written] + [("EXAMPLE.com/", "m", "remove", day(5))],
                              "pattern string, category string, action string, day date")
    urls = {"http://example.com/q": "example.com", "http://www.EXAMPLE.com": "example.com", "http://b.org/A/b": "b.org/A",
            "http://b.org/a": None, "http://c.net/x/y/z": "c.net/x/y", "http://d.io/p": "d.io/p", "http://e.com": "e.com",
            "http://f.com": "f.com", "http://g.com/only/path": None}
    c = spark.createDataFrame([(i, u, DAY) for i, u in enumerate(urls)] + [(99, "http://example.com", day(6))],
                              "page_id long, url string, fetched date")
    got = {r["url"]: r["pattern"] for r in U.filter_captures(c, e).collect()}
    assert got == {**urls, "http://example.com": None}  # taken off by another spelling
    assert U.filter_captures(spark.createDataFrame([(1, "http://a.com/" + "s/" * 20_000, DAY)], c.schema), e).count() == 1


def test_empty_tables(spark):
    c = spark.createDataFrame([(1, "http://a.com", DAY)], "page_id long, url string, fetched date")
    e = spark.createDataFrame([("a.com", "m", "add", DAY)], "pattern string, category string, action string, day date")
    assert [r["blocked"] for r in U.filter_captures(c, e.limit(0)).collect()] == [False]
    assert U.filter_captures(c.limit(0), e).count() == 0


def test_query_blocks_some_pages(spark):
    out = queries.op1_url_filter(spark, "/root/testdata/sf0.01")
    n = out.count()
    assert n == 250 and 0 < out.filter("blocked").count() < n
