"""Url rules and shards."""

import pytest
from pyspark.sql import functions as F

from playstar.llm import registry, sharding, url_filter
from tests.compare import differences, open_tables
from tests.llm.tables import documents

URLS = [
    (1, "http://example.com/en/x?q=/es/"), (2, "https://WWW.Example.com/en/"), (3, "https://a.www.example.com/en/1"),
    (4, "http://badexample.com/en/"), (5, "http://net/es/"), (6, "http://x.net/fr/a#b"), (7, "http://x.net/frx"),
    (8, None), (9, ""), (10, "no scheme"), (11, "://"), (12, "http://example.com"), (13, "http://example.com.?/en/"),
    (14, "http://..net/es/"), (15, "http://münchen.com/en/"), (16, "a://b://example.com/en/"), (1, "http://example.com/en/x?q=/es/"),
    (None, "http://example.com/en/"), (17, "http://sub.example.com/en"), (18, "http://İ.com/"),
]


def plain(url, rules, default="allow"):
    url = url or ""
    rest = url.split("://", 1)[1] if "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:].split("?")[0].split("#")[0]
    fits = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fits, key=lambda r: (len(r[0] + r[1]), len(r[0])), default=None)
    return (host, path, best[0] + best[1], best[2]) if best else (host, path, None, default)


def urls(spark, rows):
    schema = "page_id long, url string, html string, host string, key string, rule string, salt string, range string"
    return spark.createDataFrame([(*r, *("clash",) * 6) for r in rows], schema)


NESTED = [*registry.URL_RULES, ("net", "/", "block"), ("x.net", "/f", "allow"), ("x.net", "/fr/", "allow"), ("net", "/fr/a/b/c", "allow")]


@pytest.mark.parametrize("rules", [registry.URL_RULES, NESTED, []])
def test_verdicts_equal_plain_rules(spark, rules):
    found = url_filter.judge(urls(spark, URLS), url_filter.rule_table(spark, rules)).collect()
    want = sorted(str((i, *plain(u, rules))) for i, u in URLS)
    assert sorted(str(tuple(r)) for r in found) == want


def test_a_rule_given_twice_blocks_and_nulls_are_ignored(spark):
    rules = url_filter.rule_table(spark, [("com", "/", "block"), ("com", "/", "allow"), (None, "/", "block"), ("net", None, "block")])
    found = url_filter.judge(urls(spark, [(1, "http://a.com/"), (2, "http://a.net/")]), rules).collect()
    assert {(r.page_id, r.verdict) for r in found} == {(1, "block"), (2, "allow")}
    assert url_filter.judge(urls(spark, []), rules).count() == 0


def test_one_host_is_dealt_to_many_ranges(spark):
    rows = [(i, f"http://hot.net/es/{i % 7}") for i in range(3000)]
    found = url_filter.judge(urls(spark, rows), url_filter.rule_table(spark, registry.URL_RULES)).collect()
    assert len(found) == 3000 and {r.rule for r in found} == {"net/es/"}


@pytest.mark.parametrize("name", list(registry.ORACLES))
def test_query_equals_sql(spark, sf_dir, name):
    with open_tables(sf_dir) as tables:
        assert differences(registry.QUERIES[name](spark, sf_dir), tables, registry.ORACLES[name]) == ""


def test_table_is_filled_in_turns_and_moves_little():
    names = [f"s{i}" for i in range(7)]
    table = sharding.lookup_table(names, 1009)
    shares = [table.count(i) for i in range(7)]
    assert max(shares) - min(shares) <= 1
    fewer = sharding.lookup_table(names[:-1], 1009)
    moved = sum(a != b for a, b in zip(table, fewer, strict=True) if a != 6)
    assert moved < 0.2 * 1009
    # Slow and plain: the claims of all turns, one by one.
    plain, turn = {}, 0
    orders = [
        [(sharding._number(f"offset {n}") % 1009 + j * (sharding._number(f"stride {n}") % 1008 + 1)) % 1009 for j in range(1009)]
        for n in names
    ]
    while len(plain) < 1009:
        plain[next(s for s in orders[turn % 7] if s not in plain)] = turn % 7
        turn += 1
    assert [plain[i] for i in range(1009)] == table


@pytest.mark.parametrize("shards, size", [([], 7), (["a", "a"], 7), (["a"], 8), (["a"] * 9, 7), (["a"], 10**9 + 7)])
def test_bad_tables_are_refused(shards, size):
    with pytest.raises(ValueError):
        sharding.lookup_table(shards, size)


def test_every_row_is_placed_and_native(spark):
    docs = documents(spark)
    placed = sharding.assign(docs, ["doc_id", "text"], ["a", "b", "c"], 101)
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    rows = placed.collect()
    assert len(rows) == docs.count() and all(r.shard in "abc" for r in rows)
    assert len({r.shard for r in rows if r.doc_id == 7}) == 1
    assert set(placed.columns) == {*docs.columns, "slot", "shard"}
    assert sharding.assign(documents(spark, []), ["doc_id"], ["a"], 7).count() == 0


def test_shards_are_written_to_folders(spark, tmp_path):
    rows = spark.range(2000).withColumn("_part", F.lit(1))
    sharding.write_shards(rows, ["id"], ["a", "b", "c"], str(tmp_path / "out"), files=2, size=101)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 2000 and {r.shard for r in back.select("shard").distinct().collect()} == {"a", "b", "c"}


def test_very_many_rules_of_one_host(spark):
    rules = [("a.com", f"/{i}/", "block") for i in range(100_000)] + [("com", "/", "allow")]
    urls = spark.createDataFrame([(i, f"http://www.a.com/{i * 1000}/x") for i in range(200)], "page_id long, url string")
    found = url_filter.judge(urls, url_filter.rule_table(spark, rules)).collect()
    assert {(r.page_id, r.rule) for r in found} == {(i, f"a.com/{i * 1000}/" if i < 100 else "com/") for i in range(200)}
