"""Dense integer keys ``1..n`` in sort order, for member lists of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.sources.tables import fresh_folder, store

# monotonically_increasing_id keeps the partition number above this many bits
# and the position within the partition below.
_POSITION_BITS = 33


def dense_key(
    members: DataFrame, order: Sequence[str], key: str, *, ranges: int | None = None
) -> DataFrame:
    """Number distinct rows in the order of ``order`` (ascending, NULL first).

    Gives what ``row_number()`` over one window gives, without moving all
    members into one task: the rows are cut into sorted ranges, numbered inside
    each range, and each range starts after the rows of the ranges before it.
    Spark merges small ranges, so a short list becomes one; ``ranges`` sets the
    number instead.

    ``order`` must identify a row. The cut rows are stored, because a range cut
    depends on a sample: read twice, it must be the same cut.
    """
    spread = [ranges, *order] if ranges else order
    cut = store(
        members.repartitionByRange(*spread)
        .sortWithinPartitions(*order)
        .withColumn("__place", F.monotonically_increasing_id())
        .withColumn("__range", F.shiftright("__place", _POSITION_BITS)),
        fresh_folder(members.sparkSession, key, passing=True),
    )
    # One row per range, so the running sum and the broadcast are small by construction.
    earlier = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        cut.groupBy("__range")
        .agg(F.count(F.lit(1)).alias("__rows"))
        .select("__range", F.coalesce(F.sum("__rows").over(earlier), F.lit(0)).alias("__start"))
    )
    position = F.col("__place").bitwiseAND((1 << _POSITION_BITS) - 1)
    return cut.join(F.broadcast(starts), "__range").select(
        (F.col("__start") + position + 1).alias(key), *members.columns
    )
