"""Keys, windows, sets and quality reports against plain Python."""

import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from playstar.operators.joins import left_join_in_blocks, left_join_in_ranges
from playstar.operators.keys import arrival_keys, extend_dimension, next_key, ranked_keys
from playstar.operators.quality import fk_orphans, null_profile, pk_duplicates, table_counts
from playstar.operators.sets import difference, head
from playstar.operators.windows import previous_in_group, top_per_group
from playstar.schemas import PRIMARY_KEYS, table_schema

SOME = settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def nulls_first(row):
    return [(value is not None, value if value is not None else 0) for value in row]


@SOME
@given(st.sets(st.tuples(st.none() | st.integers(-9, 9), st.none() | st.sampled_from("abcé ")), max_size=60))
def test_ranked_keys_equal_a_global_row_number(spark, rows):
    df = spark.createDataFrame(list(rows), "a int, b string").repartition(5)
    got = sorted(tuple(r) for r in ranked_keys(df, "k", ["a", "b"], first_key=10).collect())
    ordered = sorted(rows, key=lambda r: (nulls_first(r[:1]), (r[1] is not None, (r[1] or "").encode())))
    assert got == [(10 + i, *row) for i, row in enumerate(ordered)]


def test_ranked_keys_over_many_partitions(spark):
    with_many = {"spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for key, value in with_many.items():
        spark.conf.set(key, value)
    try:
        df = spark.range(20_000).select((F.col("id") * 7919 % 20_000).alias("v"), F.repeat(F.lit("x"), 20).alias("pad"))
        keyed = ranked_keys(df, "k", ["v"])
        assert keyed.where("k <> v + 1").count() == 0
        assert keyed.count() == 20_000
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_ranked_keys_use_no_global_window(spark):
    df = spark.range(100).withColumn("v", F.col("id") % 7)
    plan = ranked_keys(df, "k", ["v", "id"])._jdf.queryExecution().optimizedPlan().toString()
    window = plan[plan.index("Window"):]
    # The only window adds up one row per partition.
    assert "_part" in window and "Aggregate [_part" in window


def test_arrival_keys_are_unique(spark):
    keyed = arrival_keys(spark.range(5000).repartition(7).withColumnRenamed("id", "v"), "k", first_key=100)
    low, distinct = keyed.agg(F.min("k"), F.countDistinct("k")).first()
    assert (low, distinct) == (100, 5000)


def test_extend_dimension_keeps_keys(spark):
    known = spark.createDataFrame([(1, "a", None), (2, "b", 5)], "k bigint, name string, size int")
    seen = spark.createDataFrame([("b", 5), ("a", None), ("a", 1), ("a", 1), (None, None)], "name string, size int")
    assert next_key(known, "k") == 3
    assert next_key(known.limit(0), "k") == 1
    fresh = extend_dimension(known, seen, "k").collect()
    assert sorted(map(tuple, fresh), key=lambda r: r[0]) == [(3, None, None), (4, "a", 1)]


def test_top_per_group_prunes_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), "id").repartition(8)
    best = top_per_group(df, ["g"], [F.desc("id")])
    assert sorted(map(tuple, best.collect())) == [(0, 999), (1, 997), (2, 998)]
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_previous_in_group_with_a_hot_group(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["hot", "hot", "hot", "cold", None]), rng.choice([None, *range(40)]), f"f{i}") for i in range(500)]
    df = spark.createDataFrame(rows, "g string, t int, f string").repartition(6)
    got = {(r.g, r.t, r.f): r.before for r in previous_in_group(df, ["g"], ["t", "f"], "t", "before", block_rows=7).collect()}
    expected, last = {}, {}
    for row in sorted(rows, key=nulls_first):
        expected[row] = last.get(row[0])
        last[row[0]] = row[1]
    assert got == expected


def test_previous_in_small_groups_takes_one_shuffle(spark):
    df = spark.createDataFrame([("a", 2, "y"), ("a", None, "x"), (None, 4, "x"), ("a", 2, "x"), (None, 1, "x")], "g string, t int, f string")
    got = previous_in_group(df, ["g"], ["t"], "t", "before")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [("a", None, "x", None), ("a", 2, "x", None), ("a", 2, "y", 2), (None, 1, "x", None), (None, 4, "x", 1)], key=str
    )
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "Join" not in plan
    assert previous_in_group(df.limit(0), ["g"], ["t"], "t", "before").collect() == []


def test_previous_in_group_of_copies(spark):
    df = spark.createDataFrame([("g", 5)] * 300 + [("g", 4), ("h", 5)], "g string, t int").repartition(6)
    got = previous_in_group(df, ["g"], ["t"], "t", "before", block_rows=50).groupBy("g", "t", "before").count().collect()
    assert sorted(map(tuple, got), key=str) == [("g", 4, None, 1), ("g", 5, 4, 1), ("g", 5, 5, 299), ("h", 5, None, 1)]


@SOME
@given(st.lists(st.sampled_from("abcdef")), st.lists(st.sampled_from("defgh")))
def test_difference_is_a_set_difference(spark, listed, committed):
    frame = lambda names: spark.createDataFrame([(n,) for n in names], "filename string")
    got = [r.filename for r in difference(frame(listed), frame(committed)).collect()]
    assert sorted(got) == sorted(set(listed) - set(committed))


def test_head_zero_means_all(spark):
    df = spark.range(10)
    assert head(df, F.col("id"), 0).count() == 10
    assert head(df, F.col("id"), None).count() == 10
    assert [r.id for r in head(df, F.col("id"), 3).collect()] == [0, 1, 2]


def test_null_profile(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, b string")
    assert {tuple(r) for r in null_profile(df).collect()} == {("a", 1), ("b", 2)}


def empty_tables(spark):
    return {name: spark.createDataFrame([], table_schema(name)) for name in PRIMARY_KEYS}


def one_column(spark, table, column, values):
    """A table in which only ``column`` is filled."""
    df = spark.createDataFrame([(v,) for v in values], f"{column} long")
    return df.select([
        (F.col(column) if f.name == column else F.lit(None)).cast(f.dataType).alias(f.name) for f in table_schema(table)
    ])


def test_key_reports_find_what_is_wrong(spark):
    tables = empty_tables(spark)
    tables["dim_user"] = one_column(spark, "dim_user", "user_key", [1, 1, 2, 2, 2, 3])
    tables["fact_songplay"] = one_column(spark, "fact_songplay", "user_key", [1, 1, 9, 9, 8, None])
    duplicates = {r.table_name: r.duplicate_keys for r in pk_duplicates(tables).collect()}
    assert duplicates["dim_user"] == 2 and duplicates["dim_song"] == 0
    # The six plays have no key of their own.
    assert duplicates["fact_songplay"] == 1
    orphans = {(r.table_name, r.column_name): r.orphan_rows for r in fk_orphans(tables).collect()}
    assert len(orphans) == 6
    assert orphans.pop(("fact_songplay", "user_key")) == 3
    assert set(orphans.values()) == {0}
    counts = {r.table_name: r.row_count for r in table_counts(tables).collect()}
    assert counts["dim_user"] == 6 and counts["dim_date"] == 0


KEY = st.none() | st.sampled_from("xyz")


@SOME
@given(st.lists(st.tuples(KEY, st.integers(0, 2)), max_size=25), st.lists(st.tuples(KEY, st.integers(0, 2), st.integers(0, 9)), max_size=40))
def test_left_join_in_blocks_equals_a_plain_one(spark, left, right):
    a = spark.createDataFrame(left, "a string, n int")
    b = spark.createDataFrame(right, "b string, m int, v int")
    got = left_join_in_blocks(a, b, {"a": "b", "n": "m"}, spread_by="v", block_rows=3)
    assert got.columns == ["a", "n", "b", "m", "v"]
    want = []
    for x, n in left:
        found = [(x, n, *row) for row in right if x is not None and row[:2] == (x, n)]
        want += found or [(x, n, None, None, None)]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))


def test_a_dimension_in_ranges_moves_no_row_of_the_left_side(spark):
    left = spark.range(60).selectExpr("id AS row", "CASE WHEN id % 5 > 0 THEN id % 30 - 3 END AS key").union(spark.range(2).selectExpr("id", "7L"))
    right = spark.range(1, 21).selectExpr("id AS key", "concat('n', id) AS name")
    plain = sorted(map(str, left.join(right, "key", "left").collect()))
    for rows in (1, 6, 20, 100):
        joined = left_join_in_ranges(left, right, "key", rows)
        assert "Exchange hashpartitioning" not in joined._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(str, joined.collect())) == plain
    none = left_join_in_ranges(left, right.limit(0), "key", 6)
    assert none.columns == ["key", "row", "name"] and none.where("name is not null").isEmpty() and none.count() == 62
