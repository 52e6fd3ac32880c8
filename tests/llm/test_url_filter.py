import random

import pytest

from kindred.llm import url_filter as U

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([i for i in map(rest.find, "/?#") if i >= 0] or [len(rest)])
    path = rest[cut:]
    stop = min([i for i in map(path.find, "?#") if i >= 0] or [len(path)])
    return rest[:cut].translate(UPPER), path[:stop]


def judge(url, rules):
    host, path = split(url)
    fits = [(len(h + p), len(h), v == "block", h + p, v) for v, h, p in rules
            if h and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[3], best[4] if best else "allow", len(set(fits))


RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"),
         ("block", "com", "/de/"), ("block", "net", ""), ("allow", "net", ""), ("block", "b.c", "/x"), ("allow", "a.b.c", ""),
         ("block", "", "/"), ("block", "com", "/de/")]
ODD = [None, "", "no scheme.org/", "http://", "https://ORG/", "http://notexample.org/es/1", "http://a.Example.org/es/1?x=/de/",
       "http://example.org/en/19", "http://example.org", "http://example.org?/es/", "x://y.com/de/#f", "http://a.com://b.net/fr/",
       "http://É.net/ \n/q", "http://a.b.c/x", "http://org./", "http://.org/", "http://a..org/es/", "h://" + "a." * 300 + "com/fr/" + "y" * 5000]


@pytest.mark.parametrize("options", [{}, {"max_broadcast": 0}])
def test_odd_urls(spark, options):
    rng = random.Random(3)
    rows = [(i, u, "h", "p") for i, u in enumerate(ODD)] + [(None, "http://org/", "h", "p")] * 3 + [(1, None, "h", "p")]
    for i in range(300):
        host = ".".join(rng.choice(["a", "b", "c", "org", "com", "example", "net", ""]) for _ in range(rng.randint(1, 4)))
        rows.append((100 + i, "http://" + host + rng.choice(["", "/", "/es/", "/en/1", "/fr/x", "/de/", "/x", "?/fr/"]), "h", "p"))
    frame = spark.createDataFrame(rows, "page_id long, url string, host string, rule string")
    rules = spark.createDataFrame(RULES, "verdict string, host string, path string")
    got = U.judge_urls(frame, rules, **options).collect()
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(str((i, *judge(u, RULES))) for i, u, _, _ in rows)


def test_no_rules_and_no_pages(spark):
    frame = spark.createDataFrame([(1, "http://a.org/x")], "page_id long, url string")
    rules = spark.createDataFrame([], "verdict string, host string, path string")
    assert [tuple(r) for r in U.judge_urls(frame, rules).collect()] == [(1, "a.org", "/x", None, "allow", 0)]
    assert U.judge_urls(frame.filter("1 = 0"), rules).count() == 0
