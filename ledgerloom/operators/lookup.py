"""Joins of a large table with reference tables, safe against hot keys.

A reference table goes to every executor only after its size was measured.
Beyond the limit both sides are shuffled and merged, whatever Spark itself would
take the table's size for, and keys that hold many rows (NULL included) are
spread over many partitions, with the few reference rows of those keys copied to
each. Results are those of the plain join in every case.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.sources.tables import fresh_folder, store

BROADCAST_BYTES = 64 << 20

_ROW = "__row"
_SALT = "__salt"
_FIXED_WIDTH = 16
# A hot key is cut this many times finer than into average partitions, to even out.
_FINER = 4
# Stands for the size of columns that cannot be measured; larger than any limit.
_UNMEASURED = 1 << 60


@dataclass(frozen=True)
class Lookup:
    """Reference rows to find by equality.

    ``on`` maps columns of the large table to columns of ``members``; ``take``
    maps names of new columns to columns of ``members``.
    """

    members: DataFrame
    on: Mapping[str, str]
    take: Mapping[str, str] = field(default_factory=dict)

    @property
    def keys(self) -> list[str]:
        return list(self.on)

    def probe(self, position: int) -> list[str]:
        return [f"__probe_{position}_{n}" for n in range(len(self.on))]

    def slim(self, position: int) -> DataFrame:
        """Only the needed columns; rows with a NULL key can never match and go."""
        probe = self.probe(position)
        found = reduce(and_, (F.col(column).isNotNull() for column in self.on.values()))
        return self.members.where(found).select(
            *(F.col(column).alias(name) for column, name in zip(self.on.values(), probe)),
            *(F.col(column).alias(name) for name, column in self.take.items()),
        )


def _row_bytes(df: DataFrame) -> Column:
    """Bytes of a row; columns with an element type (arrays, maps, structs) have no known width."""
    widths = []
    for f in df.schema:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            widths.append(F.coalesce(F.octet_length(f.name), F.lit(0)) + _FIXED_WIDTH)
        else:
            widths.append(F.lit(_FIXED_WIDTH))
    return reduce(lambda a, b: a + b, widths)


def _added_bytes(lookup: Lookup) -> int:
    """About what a lookup adds to a row: a number takes half the width, a text more than that."""
    taken = lookup.members.select(*lookup.take.values()).schema
    narrow = (T.NumericType, T.DateType, T.BooleanType)
    return sum(_FIXED_WIDTH // 2 if isinstance(f.dataType, narrow) else 2 * _FIXED_WIDTH for f in taken)


def _nested(df: DataFrame) -> bool:
    return any(
        not isinstance(f.dataType, T.AtomicType) or isinstance(f.dataType, T.VariantType)
        for f in df.schema
    )


def payload_bytes(frames: Sequence[DataFrame]) -> list[int]:
    """Uncompressed size of each frame, measured over all its rows in one job.

    A frame with nested columns counts as larger than any limit.
    """
    rows = [
        df.select(F.lit(n).alias("n"), _row_bytes(df).cast("bigint").alias("size"))
        for n, df in enumerate(frames)
        if not _nested(df)
    ]
    if not rows:
        return [_UNMEASURED] * len(frames)
    sizes = reduce(DataFrame.unionByName, rows).groupBy("n").agg(F.sum("size"))
    # One row per frame that has rows.
    found = dict(sizes.collect())
    return [_UNMEASURED if _nested(df) else found.get(n, 0) for n, df in enumerate(frames)]


def broadcast_if_small(members: DataFrame, *, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``members`` with a hint by its measured size: to be broadcast, or else to be merged."""
    [size] = payload_bytes([members])
    return F.broadcast(members) if size <= broadcast_bytes else members.hint("merge")


def _all_hot_keys(
    rows: DataFrame,
    keys: Sequence[Sequence[str]],
    names: Sequence[Sequence[str]],
    copies: str,
    parts: int,
) -> list[DataFrame]:
    """For each of the keys: what has more than a ``1/parts`` share of the rows, and its salts.

    Such values number about ``parts`` a key at most, and the salts of all together
    ``(1 + _FINER) * parts``, whatever the data. Every row is counted, for all keys in one
    pass; counts are added up on each task first, so what is shuffled is a row per value and task.
    """
    sets = list(dict.fromkeys(tuple(sorted(key)) for key in keys))
    columns = sorted(set().union(*sets))
    # Neither a helper's name nor one of the counted columns may stand for two things.
    plain = {column: f"__key_{n}" for n, column in enumerate(columns)}
    # What grouping_id() gives for a set: a bit for every column that is not in it.
    numbers = {s: int("".join("01"[c not in s] for c in columns), 2) for s in sets}
    # Of a stored table, read from the ends of its files.
    shares = F.col("__n") / F.lit(max(rows.count(), 1)) * parts
    found = {
        s: (F.col("__set") == number) & reduce(and_, (F.col(plain[c]).isNotNull() for c in s))
        for s, number in numbers.items()
    }
    counts = (
        rows.select(*(F.col(column).alias(name) for column, name in plain.items()))
        .groupingSets([[plain[c] for c in s] for s in sets], *plain.values())
        .agg(F.grouping_id().alias("__set"), F.count(F.lit(1)).alias("__n"))
        .where((shares > 1) & reduce(or_, found.values()))
        .select("__set", *plain.values(), F.ceil(shares * _FINER).cast("int").alias(copies))
    )
    # Stored, because both sides of a join use it and must use the same values.
    hot = store(counts, fresh_folder(rows.sparkSession, "hot", passing=True))
    return [
        hot.where(F.col("__set") == numbers[tuple(sorted(key))]).select(
            *(F.col(plain[c]).alias(name) for c, name in zip(key, named)), copies
        )
        for key, named in zip(keys, names)
    ]


def _hot_keys(
    rows: DataFrame, keys: Sequence[str], names: Sequence[str], copies: str, parts: int
) -> DataFrame:
    """The same for one key."""
    return _all_hot_keys(rows, [keys], [names], copies, parts)[0]


def _same(left: Sequence[str], right: Sequence[str]) -> Column:
    return reduce(and_, (F.col(a) == F.col(b) for a, b in zip(left, right)))


def _spread_join(
    rows: DataFrame, hot: DataFrame, lookup: Lookup, position: int, parts: int, how: str
) -> DataFrame:
    probe, slim = lookup.probe(position), lookup.slim(position)
    *names, copies = hot.columns

    # The salt comes from the row's place in its file: the same after a lost
    # task runs again, and different for rows that are equal in all columns.
    no_key = reduce(or_, (F.col(key).isNull() for key in lookup.keys))
    spread = F.when(no_key, F.lit(parts)).otherwise(F.coalesce(copies, F.lit(1)))
    salted = (
        rows.join(F.broadcast(hot), _same(lookup.keys, names), "left")
        .withColumn(_SALT, F.pmod(F.xxhash64(_ROW), spread).cast("int"))
        .drop(*names, copies)
    )
    copied = (
        slim.join(F.broadcast(hot), _same(probe, names), "left")
        .withColumn("__probe_salt", F.explode(_salts(F.coalesce(copies, F.lit(1)))))
        .drop(*names, copies)
    )
    matched = _same(lookup.keys, probe) & (F.col(_SALT) == F.col("__probe_salt"))
    return salted.join(copied.hint("merge"), matched, how).drop(_SALT, "__probe_salt")


def _salts(copies: Column) -> Column:
    return F.sequence(F.lit(0), copies - 1)


def _join_all(
    rows: DataFrame, lookups: Sequence[Lookup], how: str, broadcast_bytes: int
) -> DataFrame:
    sizes = payload_bytes([lookup.slim(n) for n, lookup in enumerate(lookups)])
    result = rows.withColumn(_ROW, F.monotonically_increasing_id())
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    large = [n for n, size in enumerate(sizes) if size > broadcast_bytes]
    names = [[f"__hot_{n}" for n in range(len(lookups[n].keys))] for n in large]
    keys = [lookups[n].keys for n in large]
    hot = dict(zip(large, _all_hot_keys(rows, keys, names, "__copies", parts))) if large else {}
    # Shuffled lookups come first, while the rows are narrow, and of those the one that
    # widens them most comes last; what the broadcast ones add is then never shuffled.
    for n in sorted(range(len(lookups)), key=lambda n: (n not in hot, _added_bytes(lookups[n]))):
        lookup = lookups[n]
        if n in hot:
            result = _spread_join(result, hot[n], lookup, n, parts, how)
        else:
            condition = _same(lookup.keys, lookup.probe(n))
            result = result.join(F.broadcast(lookup.slim(n)), condition, how)
        result = result.drop(*lookup.probe(n))
    new = [name for lookup in lookups for name in lookup.take] if how == "left" else []
    return result.select(*rows.columns, *new)


def resolve(
    rows: DataFrame, lookups: Sequence[Lookup], *, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Left outer join with every lookup; new columns are NULL where no member fits.

    Keys compare with ``=``, so a NULL key fits no member. ``rows`` must be a
    stored table: rows are told apart by their place in the files.
    """
    return _join_all(rows, lookups, "left", broadcast_bytes)


def without_match(
    rows: DataFrame,
    members: DataFrame,
    on: Mapping[str, str],
    *,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Anti join: the rows, NULL keys included, whose key is not among ``members``.

    As in :func:`resolve`, ``rows`` must be a stored table.
    """
    return _join_all(rows, [Lookup(members, on)], "left_anti", broadcast_bytes)


def require_unique(members: DataFrame, keys: Sequence[str], label: str) -> DataFrame:
    """``members`` itself, or an error if a key occurs twice: a join would multiply rows."""
    found = members.dropna(subset=list(keys)).groupBy(*keys).count().where("count > 1").take(3)
    if found:
        shown = ", ".join(str(tuple(row[key] for key in keys)) for row in found)
        raise ValueError(f"{label}: duplicated key {shown}")
    return members
