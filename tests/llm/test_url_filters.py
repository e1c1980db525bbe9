import datetime
import random

from corpusflow.llm import queries, url_filters

DAY = datetime.date(2024, 1, 1)


def day(k):
    return None if k is None else DAY + datetime.timedelta(days=k)


def slow(host, when, entries):
    """The verdict by looking at every entry."""
    best = (0, "none", None, None)
    if host is None or when is None:
        return best[1:]
    for pattern in {e[0] for e in entries if e[0]}:
        if host != pattern and not host.endswith("." + pattern):
            continue
        past = [(e[2], e[3], e[1]) for e in entries if e[0] == pattern and e[2] is not None and e[2] <= when]
        if past and max(past)[2] != "lift" and len(pattern) > best[0]:
            best = (len(pattern), max(past)[2], pattern, day(max(past)[0]))
    return best[1:]


def test_every_capture_as_of_its_day(spark):
    rng = random.Random(1)
    names = ["example.com", "a.example.com", "b.a.example.com", "xample.com", "com", "other.org"]
    entries = [
        (rng.choice([*names, None]), rng.choice(["block", "allow", "lift"]), rng.choice([*range(20), None]), k)
        for k in range(60)
    ]
    captures = [(k, rng.choice(names), rng.choice([*range(-2, 25), None])) for k in range(300)]
    # a third of all captures are of one host and day
    captures += [(k, "a.example.com", 7) for k in range(300, 450)]
    left = spark.createDataFrame(
        [(k, f"https://u@{h.upper()}.:80/p?q=http://z.org", day(d), "x", "y") for k, h, d in captures],
        "page_id long, url string, day date, host string, asked string",
    )
    right = spark.createDataFrame(
        [(p, a, day(d), k) for p, a, d, k in entries], "pattern string, action string, day date, entry_id long"
    )
    found = url_filters.judge(left, right)
    assert found.columns == ["page_id", "url", "day", "asked", "host", "verdict", "pattern", "since"]
    got = {r["page_id"]: (r["host"], r["verdict"], r["pattern"], r["since"]) for r in found.collect()}
    assert got == {k: (h, *slow(h, d, entries)) for k, h, d in captures}


def test_odd_captures(spark):
    urls = [None, "", "no url", "http://", "ftp://h.example/x", "http://[::1]/", "HTTP://H.EXAMPLE"]
    rows = [(k, u, DAY) for k, u in enumerate(urls)] + [(0, None, DAY), (None, "http://h.example", None)]
    captures = spark.createDataFrame(rows, "page_id long, url string, day date")
    entries = spark.createDataFrame(
        [("h.example", "block", DAY, 1), ("h.example", "block", DAY, 1)],
        "pattern string, action string, day date, entry_id long",
    )
    found = url_filters.judge(captures, entries).collect()
    assert len(found) == len(rows)
    assert sorted(r["page_id"] for r in found if r["verdict"] == "block") == [4, 6]


def test_empty_sides(spark):
    captures = spark.createDataFrame([], "page_id long, url string, day date")
    entries = spark.createDataFrame([], "pattern string, action string, day date, entry_id long")
    assert url_filters.judge(captures, entries).count() == 0
    one = spark.createDataFrame([(1, "http://a.b", DAY)], captures.schema)
    assert [r["verdict"] for r in url_filters.judge(one, entries).collect()] == ["none"]


def test_no_python(spark, sf_dir, plan):
    assert "Python" not in plan(queries.op10_url_filters(spark, sf_dir))
