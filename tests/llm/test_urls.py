import numpy as np
import pytest

from tidegate.llm import urls
from tidegate.llm.urls import ALLOW, BLOCK, Levels, Rule, build_cascade, build_levels, filter_urls

RULES = [Rule(ALLOW, "com"), Rule(BLOCK, "example.com", "/en/"), Rule(ALLOW, "www.example.com", "/en/"), Rule(BLOCK, "net", "/es/")]


def judged(spark, rows, listed=(), **options):
    df = spark.createDataFrame([(k, u) for k, u in enumerate(rows)], "page_id long, url string")
    hosts = spark.createDataFrame([(h,) for h in listed], "host string")
    found = filter_urls(df, RULES, hosts, **options)
    assert found.columns == ["page_id", "url", "host", "path", "rule", "verdict"]
    return [tuple(r)[2:] for r in found.orderBy("page_id").collect()]


def test_parts_and_rules(spark):
    rows = ["http://WWW.Example.com/en/x?q", "https://a.example.com/en/", "http://example.com/EN/", "http://com?x=/", "x://b.net/es/1#f", "http://notnet/es/", None, "", "no", "://", "a://b.org/c://d", "http://É.com/\n"]
    assert judged(spark, rows, ["b.org"]) == [
        ("www.example.com", "/en/x", "www.example.com/en/", ALLOW), ("a.example.com", "/en/", "example.com/en/", BLOCK), ("example.com", "/EN/", "com/", ALLOW),
        ("com", "", None, ALLOW), ("b.net", "/es/1", "net/es/", BLOCK), ("notnet", "/es/", None, ALLOW), ("", "", None, ALLOW), ("", "", None, ALLOW), ("", "", None, ALLOW),
        ("", "", None, ALLOW), ("b.org", "/c://d", None, BLOCK), ("É.com", "/\n", "com/", ALLOW),
    ]


@pytest.mark.parametrize("n, listed", [(1, 1), (2, 1), (1000, 0), (1000, 1), (5000, 40), (5000, 2500), (5000, 4990), (3000, 3000)])
def test_levels_are_exact(n, listed):
    keys = np.random.default_rng(n + listed).integers(0, 1 << 63, (n, 2)).astype(np.uint64)
    levels = Levels(build_levels(keys[:listed], keys[listed:]))
    assert levels.holds(keys).tolist() == [True] * listed + [False] * (n - listed)
    if listed == 40:
        assert len(levels.levels) > 1 and sum(len(f) for _, _, f in levels.levels) < 40 * 3


def test_equal_digests_are_refused():
    keys = np.ones((1, 2), np.uint64)
    with pytest.raises(ValueError):
        build_levels(keys, keys)


@pytest.mark.parametrize("options", [{}, {"shard_keys": 20}, {"shard_keys": 20, "broadcast_bytes": 0}])
def test_membership_of_whole_corpus(spark, options, monkeypatch):
    monkeypatch.setattr(urls, "TASK_ROWS", 50)  # several salts for the hot host
    hosts = [f"h{k}.org" for k in range(400)]
    rows = [f"http://{h}/p" for h in hosts] + ["http://h7.org/q"] * 300 + ["http://h8.org/q"] * 300
    found = judged(spark, rows, [h for k, h in enumerate(hosts) if k % 7 == 0] + ["elsewhere.org", None, ""], **options)
    assert len(found) == len(rows)
    assert all(v == (BLOCK if int(h[1:-4]) % 7 == 0 else ALLOW) for h, _, _, v in found)


def test_odd_tables(spark):
    none = spark.createDataFrame([], "host string")
    assert filter_urls(spark.createDataFrame([], "url string"), RULES, none).collect() == []
    row = {c: "x" for c in ("HOST", "Path", "row", "input", "digest", "shard", "listed", "on_list", "found", "salt", "cascade", "key")} | {"url": "http://a.org/" + "y" * 1_000_000}
    df = spark.createDataFrame([row, row])
    for most in (0, 1 << 20):
        found = filter_urls(df, [], spark.createDataFrame([("a.org",)], "h string"), broadcast_bytes=most)
        assert set(found.columns) == set(row) - {"HOST", "Path"} | {"host", "path", "rule", "verdict"}
        got = found.collect()
        assert [(r["host"], len(r["path"]), r["rule"], r["verdict"], r["row"], r["salt"]) for r in got] == [("a.org", 1_000_001, None, BLOCK, "x", "x")] * 2


def test_rule_order(spark):
    with pytest.raises(ValueError):
        filter_urls(spark.createDataFrame([], "url string"), RULES * 400, spark.createDataFrame([], "h string"))
    df = spark.createDataFrame([("http://b.co/xy",)], "url string")
    none = spark.createDataFrame([], "h string")
    assert filter_urls(df, [Rule(ALLOW, "co", "/xy"), Rule(BLOCK, "b.co", "/"), Rule(ALLOW, "b.co", "/")], none).first()["verdict"] == BLOCK
    assert build_cascade(none, none).n_bytes == 0
