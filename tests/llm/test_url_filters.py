"""Temporal URL lists against brute force."""

import random

from kempt.llm import url_filters


def brute(captures, events):
    out = []
    for page, url, day in captures:
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host = rest.split("/")[0].split("?")[0].split("#")[0].split("@")[-1].split(":")[0].lower() or None
        labels = host.split(".") if host else []
        active = []
        for i in range(max(len(labels) - 1, 1) if labels else 0):
            name = ".".join(labels[i:])
            for one in {e[0] for e in events}:
                log = sorted({(e[2], e[3]) for e in events if e[0] == one and e[1] and e[1].lower() == name and e[2] is not None
                              and e[3] in ("add", "remove") and day is not None and e[2] <= day})
                if log and log[-1][1] == "add":
                    active.append((len(name), name))
        out.append((page, host, day, len(active), max(active)[1] if active else None, bool(active)))
    return sorted(out, key=repr)


def test_lists_as_of_the_fetch_day(spark):
    rng = random.Random(1)
    hosts = ["a.example.com", "example.com", "b.a.example.com", "single", "Other.org"]
    events = [(rng.choice(["l1", "l2"]), rng.choice(hosts), rng.randrange(60), rng.choice(["add", "remove"])) for _ in range(60)]
    events += events[:9] + [("l1", None, 3, "add"), ("l1", "example.com", None, "add"), ("l1", "example.com", 4, "other")]
    captures = [(k, rng.choice([f"http://{h}/x?y=1", f"https://u:p@{h.upper()}:8080#z", f"ftp://{h}"]), rng.randrange(70))
                for k, h in enumerate(rng.choices(hosts, k=200))]
    captures += [(1, None, 5), (2, "", 5), (3, "no scheme", 5), (4, "http://example.com", None), (5, captures[0][1], 9), (5, captures[0][1], 9)]
    got = url_filters.evaluate(spark.createDataFrame(captures, "page_id long, url string, day int"),
                               spark.createDataFrame(events, "list string, pattern string, day int, action string"))
    rows = [(r.page_id, r.host, r.day, r.n_active, r.pattern, r.blocked) for r in got.collect()]
    assert sorted(rows, key=repr) == brute(captures, events)


def test_empty_tables(spark):
    captures = spark.createDataFrame([(1, "http://a.b", 3)], "page_id long, url string, day int")
    events = spark.createDataFrame([], "list string, pattern string, day int, action string")
    assert [r.blocked for r in url_filters.evaluate(captures, events).collect()] == [False]
    assert url_filters.evaluate(captures.limit(0), events).count() == 0
