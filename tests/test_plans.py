"""Physical plans: what is read, what is shuffled, what is broadcast."""

import re

import pytest

from ledgerloom.checks import registry
from ledgerloom.operators import quality, ranking
from ledgerloom.operators.lookup import Lookup, resolve
from ledgerloom.plans import marts, questions, star
from ledgerloom.sources.tables import fresh_folder, store

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def w(spark):
    return registry.warehouse(spark, SF_DIR)


def read_columns(text):
    schemas = re.findall(r"ReadSchema: struct<(.*?)>", text)
    return [set(re.findall(r"(\w+):", schema)) for schema in schemas]


def test_questions_read_only_their_columns(w, plan):
    assert read_columns(plan(w.flat_mart.select("state", "amount"))) == [{"state", "amount"}]
    text = plan(questions.top_states(w.flat_mart))
    assert read_columns(text) == [{"state", "amount"}]
    assert "TakeOrderedAndProject" in text
    assert "Not(EqualTo(state,BR))" in text


def test_top_lists_cut_each_group_before_the_shuffle(w, plan):
    text = plan(questions.top_candidates_in_top_states(w.flat_mart))
    assert "LeftSemi" in text and "BroadcastHashJoin" in text
    assert re.search(r"WindowGroupLimit .* 3, Partial", text)
    assert "rangepartitioning" not in text


def test_small_dimensions_cost_no_shuffle_of_the_fact(w, plan):
    for df in (
        star.expense_fact(w.silver_expenses, *w.dimensions),
        marts.flat_mart(w.fact_expense, *w.dimensions),
        marts.flat_from_expenses(w.silver_expenses, *w.dimensions),
    ):
        text = plan(df)
        assert text.count("BroadcastHashJoin") == 4
        assert "hashpartitioning" not in text and "SortMergeJoin" not in text
        assert "monotonically_increasing_id" not in text


def test_large_dimensions_are_not_broadcast(spark, w, plan):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(star.expense_fact(w.silver_expenses, *w.dimensions, broadcast_bytes=0))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert text.count("SortMergeJoin") == 4
    # Broadcast are only the hot keys: once for each side of each join.
    assert text.count("BroadcastHashJoin") == 8


def test_the_shuffled_lookup_that_widens_rows_most_comes_last(spark, plan):
    folder = fresh_folder(spark, "wide")
    rows = store(spark.range(100).selectExpr("id AS a", "id % 7 AS b"), f"{folder}/rows")
    members = spark.range(50).selectExpr("id AS m", "string(id) AS name", "id * 2 AS twice")
    lookups = [Lookup(members, {"a": "m"}, {"name": "name"}), Lookup(members, {"b": "m"}, {"twice": "twice"})]
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = resolve(rows, lookups, broadcast_bytes=0)
        last, first = re.findall(r"SortMergeJoin \[(\w)#", plan(found))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert (first, last) == ("b", "a")
    assert found.columns == ["a", "b", "name", "twice"]
    expected = [(n, n % 7, str(n) if n < 50 else None, n % 7 * 2) for n in range(100)]
    assert sorted(map(tuple, found.collect())) == expected


@pytest.fixture(scope="module")
def compressible(spark):
    """Members of 20 MB that are some hundred KB as files, far below Spark's own threshold."""
    members = spark.range(100_000).selectExpr("id AS m", "repeat('same text ', 20) AS name")
    return store(members, fresh_folder(spark, "compressible"))


@pytest.mark.parametrize("skewed", [False, True])
def test_the_limit_holds_for_tables_that_compress_well(spark, compressible, skewed):
    key = "IF(id % 3 = 0, 7, id)" if skewed else "id"
    rows = store(spark.range(300_000).selectExpr(f"{key} AS k"), fresh_folder(spark, "rows"))
    assert int(spark.conf.get("spark.sql.autoBroadcastJoinThreshold").rstrip("b")) == 10 << 20
    found = resolve(rows, [Lookup(compressible, {"k": "m"}, {"n": "name"})], broadcast_bytes=1 << 20)
    text = executed(found)
    assert "SortMergeJoin" in text
    # Broadcast are the hot keys alone, which have no text.
    assert not re.search(r"BroadcastExchange[^\n]*\n[^\n]*name#", text)
    assert len(re.findall("BroadcastHashJoin|BroadcastNestedLoopJoin", text)) <= 2
    text = executed(quality.orphan_count(rows.withColumnRenamed("k", "m"), compressible, "m", broadcast_bytes=1000))
    assert "SortMergeJoin" in text and "Broadcast" not in text


def executed(df):
    """The plan that ran, after all that was decided at run time."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text[text.index("Final Plan") : text.index("Initial Plan")]


def test_every_column_of_a_view_is_counted_without_copies_of_its_rows(spark, plan):
    rows = spark.createDataFrame([(1, "x"), (1, None), (2, "x"), (None, None)], "a int, b string")
    store(rows, fresh_folder(spark, "columns")).createOrReplaceTempView("two_columns")
    found = registry._filled(spark, {"two_columns": ["a", "b"]})
    text = plan(found)
    assert "Expand" not in text
    assert read_columns(text) == [{"a"}, {"b"}]
    assert sorted(map(tuple, found.collect())) == [("two_columns", "a", 3, 2), ("two_columns", "b", 2, 1)]


def test_unordered_previews_stop_reading(w, plan):
    show = ["expense_id", "detail"]
    text = plan(quality.sample_with_value(w.silver_expenses, "expense_id", -1, show, 10))
    assert "CollectLimit" in text and "Sort" not in text and "TakeOrdered" not in text
    text = plan(ranking.preview(w.fact_expense, 10))
    assert "CollectLimit" in text and "Sort" not in text


def test_state_mart_sums_before_it_joins(w, plan):
    text = plan(w.state_mart)
    join, partial = text.index("Join"), text.index("partial_sum")
    assert partial > join  # deeper in the plan
    assert read_columns(text)[0] == {"state_key", "amount"}


def test_orphans_are_counted_before_a_shuffled_join(spark, w, plan):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(
            quality.orphan_count(
                w.silver_expenses, w.silver_candidates, "candidate_id", broadcast_bytes=0
            )
        )
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "LeftAnti" in text
    assert text.index("partial_count") > text.index("LeftAnti")
    assert {"candidate_id"} in read_columns(text)


def test_completeness_is_one_pass_without_grouping(w, plan):
    text = plan(quality.completeness(w.silver_electorate))
    assert text.count("FileScan") == 1 and "hashpartitioning" not in text


def test_profile_reads_twice_and_shuffles_keys_only(w, plan):
    text = plan(quality.profile(w.silver_expenses, "expense_id", sentinel=-1))
    assert text.count("FileScan") == 2
    assert re.findall(r"hashpartitioning\((\w+)#", text) == ["expense_id"]


def test_point_lookup_reaches_the_files(w, plan):
    text = plan(quality.with_value(w.silver_expenses, "expense_id", 1102))
    assert "EqualTo(expense_id,1102)" in text


def test_no_python_in_any_plan(w, plan):
    for name in ("dim_date", "dim_candidate", "flat_mart", "silver_expenses"):
        assert "Python" not in plan(registry.QUERIES[name](w.spark, SF_DIR))
    assert "Python" not in plan(star.date_dimension(w.silver_expenses))
