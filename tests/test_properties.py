"""Operators against plain Python on random small tables."""

from collections import Counter, defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ledgerloom.operators import quality, ranking
from ledgerloom.operators.keys import dense_key
from ledgerloom.operators.lookup import Lookup, resolve, without_match
from ledgerloom.sources.tables import fresh_folder, store

FEW = settings(
    max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
KEY = st.one_of(st.none(), st.integers(0, 6))
ROWS = st.lists(st.tuples(KEY, st.sampled_from(["a", "b", None])), min_size=1, max_size=60)


def bag(rows):
    return Counter(map(tuple, rows))


@FEW
@given(ROWS, st.lists(st.tuples(KEY, st.sampled_from("xyz")), max_size=8), st.sampled_from([0, 1 << 20]))
def test_lookup_is_a_left_join(spark, rows, members, limit):
    big = store(spark.createDataFrame(rows, "k bigint, t string"), fresh_folder(spark, "p"))
    small = spark.createDataFrame(members, "m bigint, name string")
    by_key = defaultdict(list)
    for key, name in members:
        by_key[key].append(name)
    expected, unmatched = [], []
    for key, text in rows:
        names = by_key.get(key, []) if key is not None else []
        expected += [(key, text, name) for name in names or [None]]
        unmatched += [] if names else [(key, text)]
    found = resolve(big, [Lookup(small, {"k": "m"}, {"n": "name"})], broadcast_bytes=limit)
    assert bag(found.collect()) == bag(expected)
    rest = without_match(big, small, {"k": "m"}, broadcast_bytes=limit)
    assert bag(rest.collect()) == bag(unmatched)


@FEW
@given(ROWS, st.sampled_from([None, 1, 3, 20]))
def test_dense_keys_count_sorted_members(spark, rows, ranges):
    members = spark.createDataFrame(rows, "k bigint, t string").distinct()
    order = sorted(set(rows), key=lambda r: tuple((v is not None, v) for v in r))
    found = dense_key(members, ["k", "t"], "id", ranges=ranges)
    assert bag(found.collect()) == bag((n, *row) for n, row in enumerate(order, 1))


@FEW
@given(ROWS)
def test_quality_counts(spark, rows):
    df = spark.createDataFrame(rows, "k bigint, t string")
    keys = [key for key, _ in rows if key is not None]
    assert tuple(quality.uniqueness(df, "k").first()) == (
        len(rows),
        len(set(keys)),
        len(rows) - len(set(keys)),
    )
    repeated = {(k, n) for k, n in Counter(keys).items() if n > 1 and k != 3}
    assert set(map(tuple, quality.repeated(df, ["k"], ignore=3).collect())) == repeated


@FEW
@given(st.lists(st.tuples(st.sampled_from("ABC"), st.integers(0, 4), st.integers(0, 9)), min_size=1))
def test_top_in_top_groups(spark, rows):
    df = spark.createDataFrame(rows, "g string, m bigint, v bigint")
    groups, members = Counter(), Counter()
    for g, m, v in rows:
        groups[g] += v
        members[g, m] += v
    leaders = sorted(groups, key=lambda g: (-groups[g], g))[:2]
    expected = []
    for g in sorted(leaders):
        inside = sorted(
            ((m, t) for (h, m), t in members.items() if h == g), key=lambda mt: (-mt[1], mt[0])
        )
        expected += [(g, m, t, rank) for rank, (m, t) in enumerate(inside[:2], 1)]
    found = ranking.top_in_top_groups(df, "g", ["m"], "v", "total", groups=2, members=2)
    assert [tuple(row) for row in found.collect()] == expected
