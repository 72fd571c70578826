from decimal import Decimal
from math import ceil

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerloom.operators import lookup, quality, ranking
from ledgerloom.operators.keys import dense_key
from ledgerloom.operators.lookup import (
    Lookup,
    payload_bytes,
    require_unique,
    resolve,
    without_match,
)
from ledgerloom.sources.tables import fresh_folder, store


def bag(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows has one key, a third none; many rows are equal in all columns."""
    key = (
        F.when(F.col("id") % 3 == 0, F.lit(7))
        .when(F.col("id") % 3 == 1, F.lit(None))
        .otherwise(F.col("id") % 500)
    )
    df = spark.range(30_000).select(
        key.cast("bigint").alias("k"), F.concat(F.lit("t"), F.col("id") % 11).alias("t")
    )
    return store(df, fresh_folder(spark, "skewed"))


@pytest.fixture(scope="module")
def members(spark):
    df = spark.range(0, 400, 1, 4).select(
        F.col("id").alias("m"), F.concat(F.lit("name"), "id").alias("name")
    )
    return store(
        df.unionByName(spark.createDataFrame([(None, "nobody")], "m bigint, name string")),
        fresh_folder(spark, "members"),
    )


# dense keys


@pytest.fixture(scope="module")
def categories(spark):
    df = spark.range(4000).select(
        F.when(F.col("id") % 9 != 0, F.concat(F.lit("c"), F.col("id") % 9)).alias("c"),
        F.when(F.col("id") % 1000 != 0, F.concat(F.lit("d"), "id")).alias("d"),
    )
    return df.distinct()


@pytest.mark.parametrize("ranges", [None, 1, 7, 100])
def test_dense_key_equals_row_number(spark, categories, ranges):
    found = dense_key(categories, ["c", "d"], "k", ranges=ranges)
    expected = categories.select(
        F.row_number().over(Window.orderBy("c", "d")).cast("bigint").alias("k"), "c", "d"
    )
    assert bag(found) == bag(expected)
    assert bag(found) == bag(found)


def test_dense_key_of_nothing_and_null_first(spark):
    df = spark.createDataFrame([("B",), (None,), ("A",)], "s string")
    assert bag(dense_key(df, ["s"], "k")) == [(1, None), (2, "A"), (3, "B")]
    assert bag(dense_key(df.where("s = 'Z'"), ["s"], "k")) == []


def test_dense_key_has_no_single_task_window_over_members(categories, plan):
    text = plan(dense_key(categories, ["c", "d"], "k", ranges=100))
    # The only single-partition step is the running sum over one row per range.
    assert text.count("Exchange SinglePartition") == 1
    below = text[text.index("Exchange SinglePartition") :].splitlines()[1]
    assert "HashAggregate(keys=[__range" in below


# lookups


@pytest.mark.parametrize("limit", [1 << 30, 0])
def test_resolve_equals_left_join(skewed, members, limit):
    found = resolve(skewed, [Lookup(members, {"k": "m"}, {"n": "name"})], broadcast_bytes=limit)
    expected = skewed.join(members, F.col("k") == F.col("m"), "left").select(
        "k", "t", F.col("name").alias("n")
    )
    assert found.columns == ["k", "t", "n"]
    assert bag(found) == bag(expected)


@pytest.mark.parametrize("limit", [1 << 30, 0])
def test_chained_lookups_and_composite_keys(spark, skewed, members, limit):
    pairs = members.select("m", F.concat(F.lit("t"), F.col("m") % 11).alias("t"), "name")
    found = resolve(
        skewed,
        [
            Lookup(members, {"k": "m"}, {"first": "name"}),
            Lookup(pairs, {"k": "m", "t": "t"}, {"second": "name"}),
        ],
        broadcast_bytes=limit,
    )
    a, b = members.alias("a"), pairs.alias("b")
    expected = (
        skewed.alias("s")
        .join(a, F.col("s.k") == F.col("a.m"), "left")
        .join(b, (F.col("s.k") == F.col("b.m")) & (F.col("s.t") == F.col("b.t")), "left")
        .select("s.k", "s.t", "a.name", F.col("b.name").alias("second"))
    )
    assert bag(found) == bag(expected)


@pytest.mark.parametrize("limit", [1 << 30, 0])
def test_without_match_keeps_null_keys(skewed, members, limit):
    found = without_match(skewed, members, {"k": "m"}, broadcast_bytes=limit)
    expected = skewed.where("k IS NULL OR k >= 400")
    assert bag(found) == bag(expected)


def test_repeated_members_multiply_rows_as_a_join_does(spark, skewed, members):
    twice = members.unionByName(members.where("m = 7"))
    found = resolve(skewed, [Lookup(twice, {"k": "m"}, {"n": "name"})], broadcast_bytes=0)
    assert found.count() == skewed.count() + skewed.where("k = 7").count()


def test_hot_keys_do_not_end_in_one_task(spark, skewed, members):
    before = spark.conf.get("spark.sql.adaptive.enabled")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = resolve(skewed, [Lookup(members, {"k": "m"}, {"n": "name"})], broadcast_bytes=0)
        plain = skewed.join(members, F.col("k") == F.col("m"), "left")

        def largest_task(df):
            sizes = df.groupBy(F.spark_partition_id()).count()
            return sizes.agg(F.max("count")).first()[0]

        rows, parts = skewed.count(), int(spark.conf.get("spark.sql.shuffle.partitions"))
        assert largest_task(plain) > rows / 3
        assert largest_task(found) < 2 * rows / parts
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_hot_keys_are_counted_over_all_rows(skewed):
    hot = lookup._hot_keys(skewed, ["k"], ["key"], "copies", 8).collect()
    shares = {r["k"]: r["n"] for r in skewed.groupBy("k").agg(F.count("*").alias("n")).collect()}
    total = sum(shares.values())
    expected = {k for k, n in shares.items() if k is not None and n * 8 > total}
    assert {row["key"] for row in hot} == expected


def test_hot_keys_of_all_lookups_equal_plain_counts(skewed):
    keys = [["k"], ["t", "k"], ["t"], ["k", "t"], ["k"]]
    names = [[f"__hot_{n}" for n in range(len(key))] for key in keys]
    found = lookup._all_hot_keys(skewed, keys, names, "copies", 40)
    total = skewed.count()
    for key, named, hot in zip(keys, names, found, strict=True):
        assert hot.columns == [*named, "copies"]
        counts = skewed.dropna(subset=key).groupBy(*key).count().collect()
        expected = [
            (*(row[c] for c in key), ceil(row["count"] / total * 40 * lookup._FINER))
            for row in counts
            if row["count"] * 40 > total
        ]
        assert expected
        assert sorted(map(tuple, hot.collect())) == sorted(expected)


def test_no_rows_have_no_hot_keys(skewed):
    names = [["a"], ["a", "b"]]
    found = lookup._all_hot_keys(skewed.where("k = -5"), [["k"], ["k", "t"]], names, "copies", 8)
    assert [hot.count() for hot in found] == [0, 0]


def test_large_lookups_count_their_keys_in_one_pass(skewed, members, monkeypatch):
    stored = []
    monkeypatch.setattr(lookup, "store", lambda df, path: stored.append(path) or store(df, path))
    named = [Lookup(members, {"k": "m"}, {"a": "name"}), Lookup(members, {"t": "name"}, {"b": "m"})]
    resolve(skewed, named, broadcast_bytes=0)
    assert len(stored) == 1
    resolve(skewed, named)
    assert len(stored) == 1


def test_nested_columns_are_larger_than_any_limit(spark):
    plain = spark.range(10).selectExpr("id", "'x' AS name")
    nested = plain.selectExpr("id", "array_repeat(name, 100000) AS names")
    assert lookup.payload_bytes([plain, nested])[0] == 10 * (16 + 17)
    assert lookup.payload_bytes([plain, nested])[1] > 1 << 50
    assert lookup.payload_bytes([nested])[0] > 1 << 50


def test_payload_counts_text_and_fixed_columns(spark):
    df = spark.createDataFrame([(1, "abc"), (2, None)], "a bigint, b string")
    assert payload_bytes([df, df.where("a > 5")]) == [2 * 16 + 2 * 16 + 3, 0]


def test_require_unique(spark, members):
    assert require_unique(members, ["m"], "members") is members
    with pytest.raises(ValueError, match="members: duplicated key"):
        require_unique(members.unionByName(members), ["m"], "members")


# quality


@pytest.fixture(scope="module")
def records(spark):
    rows = [(-1, "a", -5), (-1, None, 2), (1, "a", None), (1, "b", 3), (2, "b", 4), (None, "c", 0)]
    return spark.createDataFrame(rows, "id bigint, t string, n bigint")


def test_uniqueness_and_completeness(records):
    assert bag(quality.uniqueness(records, "id")) == [(6, 3, 3)]
    assert bag(quality.completeness(records)) == [(6, 1, 1, 1)]
    assert bag(quality.completeness(records, ["t"])) == [(6, 1)]


def test_repeated(records):
    assert bag(quality.repeated(records, ["id"], ignore=-1)) == [(1, 2)]
    assert bag(quality.repeated(records, ["id"])) == [(-1, 2), (1, 2)]
    assert [tuple(r) for r in quality.most_repeated(records, ["t"]).collect()] == [
        ("a", 2),
        ("b", 2),
    ]
    assert bag(quality.most_repeated(records, ["t"], 1)) == [("a", 2)]
    assert bag(quality.repeated_count(records, ["id"], ignore=-1)) == [(1,)]


@pytest.mark.parametrize("limit", [1 << 30, 0])
def test_orphans(skewed, members, limit):
    expected = skewed.where("k IS NULL OR k >= 400").count()
    known = members.select(F.col("m").alias("k"))
    count = quality.orphan_count(skewed, known, "k", broadcast_bytes=limit)
    assert bag(count) == [(expected,)]
    assert quality.orphan_rows(skewed, known, "k", broadcast_bytes=limit).count() == expected


def test_no_orphans_count_as_zero(members):
    known = members.where("m IS NOT NULL").select(F.col("m").alias("k"))
    assert bag(quality.orphan_count(known, known, "k")) == [(0,)]


def test_values_and_measures(records):
    assert bag(quality.minima(records, ["n", "id"])) == [(-5, -1)]
    assert bag(quality.negative_count(records, ["n", "id"])) == [(2,)]
    sample = quality.sample_with_value(records, "id", -1, ["id", "t"], 1, ordered=True)
    assert bag(sample) == [(-1, None)]
    assert quality.with_value(records, "id", None).count() == 0


def test_profile(records):
    found = dict(bag(quality.profile(records, "id", sentinel=-1, measures=["n"])))
    assert found == {
        "row_count": 6,
        "null_id": 1,
        "null_t": 1,
        "null_n": 1,
        "sentinel_rows": 2,
        "negative_rows": 1,
        "distinct_ids": 3,
        "possible_duplicates": 3,
        "repeated_ids": 1,
    }
    empty = dict(bag(quality.profile(records.where("id = 99"), "id")))
    assert set(empty.values()) == {0}


def test_drill_down_compares_numbers_by_value(spark):
    raw = spark.createDataFrame(
        [("X", "007"), ("X", "7"), ("X", "seven"), ("x", "7")], "s string, n string"
    )
    assert bag(quality.drill_down(raw, {"s": "X"}, {"n": 7}, 5)) == [("X", "007"), ("X", "7")]


# ranking


def test_ties_go_to_the_smaller_key(spark):
    df = spark.createDataFrame([("b", 5), ("a", 5), ("c", 9), (None, 5)], "g string, v bigint")
    top = ranking.top_groups(df, ["g"], "v", "total", 3)
    assert [tuple(r) for r in top.collect()] == [("c", 9), (None, 5), ("a", 5)]


def test_top_in_top_groups(spark):
    rows = [("A", 1, 10), ("A", 1, 5), ("A", 2, 15), ("A", 3, 1), ("B", 1, 4), (None, 1, 99)]
    df = spark.createDataFrame(rows, "g string, m bigint, v bigint")
    top = ranking.top_in_top_groups(df, "g", ["m"], "v", "total", groups=2, members=2)
    # The NULL group is the largest, but equals no row; B is third.
    assert [tuple(r) for r in top.collect()] == [("A", 1, 15, 1), ("A", 2, 15, 2)]


def test_excluding_drops_null(records):
    assert ranking.excluding(records, "id", -1).count() == 3


def test_ratio(spark):
    df = spark.createDataFrame(
        [(Decimal("10.00"), 3), (Decimal("0.05"), 10), (Decimal("1.00"), 0)],
        "t decimal(28,2), n bigint",
    )
    found = [row[0] for row in df.select(ranking.ratio("t", "n")).collect()]
    assert found == [Decimal("3.33"), Decimal("0.01"), None]
