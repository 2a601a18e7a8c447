import random

import numpy as np
import pytest
import xxhash

from orderlake.llm import url_filter

RULES = [
    ("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"),
    ("com", "/de/", "block"), ("a.b.c", "", "block"), ("ü.de", "/straße", "block"),
]
SCHEMA = "host string, path string, verdict string"


def plain(url, rules):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([i for i in map(rest.find, "/?#") if i >= 0], default=len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
        path = rest[end:].split("?")[0].split("#")[0]
    fits = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fits, key=lambda r: (len(r[0] + r[1]), len(r[0])), default=None)
    return host, path, best and best[0] + best[1], best[2] if best else "allow"


def urls():
    rng = random.Random(9)
    hosts = ["example.org", "x.EXAMPLE.org", "org", "a.com", "com", "notexample.org", "z.a.b.c", "a.b.c", "", "ü.de", "example.org:80", "..", "org."]
    ends = ["", "/", "/es/", "/es", "/en/12", "/en/1?x", "/fr/a#b", "/de/?q", "?a/b", "#/de/", "/de", "/straße/1", "//"]
    return [f"{rng.choice(['http', 'HTTPS', ''])}://{rng.choice(hosts)}{rng.choice(ends)}" for _ in range(500)] + [
        None, "", "no scheme.org/es/", "a://b://c/", "x" * 100_000 + "://" + "l." * 50_000 + "org/" + "p" * 100_000,
    ]


@pytest.mark.parametrize("shards", [1, 3])
def test_judge(spark, shards):
    index = url_filter.build(spark, spark.createDataFrame(RULES, SCHEMA), shards)
    pages = spark.createDataFrame([(i, u, "s", "h") for i, u in enumerate(urls())], "page_id long, url string, _url string, html string")
    found = url_filter.judge(pages, index).collect()
    for r, u in zip(found, urls()):
        assert (r.host, r.path, r.rule, r.verdict) == plain(u, RULES)


def test_no_rules_and_no_pages(spark):
    none = url_filter.build(spark, spark.createDataFrame([], SCHEMA))
    pages = spark.createDataFrame([(None, "http://a.org/"), (1, None)], "page_id long, url string")
    assert [(r.rule, r.verdict) for r in url_filter.judge(pages, none, default="block").collect()] == [(None, "block")] * 2
    some = url_filter.build(spark, spark.createDataFrame(RULES, SCHEMA))
    assert url_filter.judge(pages.filter("page_id = 5"), some).collect() == []


def test_equal_keys_are_told_apart(tmp_path):
    key = xxhash.xxh64_intdigest(b"a.org/x")
    strings = [b"other.org/y", b"a.org/x"]  # as if both had this key
    data = url_filter.Shard.pack(np.array([key, key], np.uint64), strings, [9, 5], [True, True])
    (tmp_path / "0.rules").write_bytes(data)
    index = url_filter.Index(f"file://{tmp_path}", (0,), (key,), (2,), (2,))
    assert url_filter.Matcher(index).match([("a.org", "/xyz"), ("other.org", "/y")]) == [("a.org/x", True), None]
