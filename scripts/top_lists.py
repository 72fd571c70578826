"""Top lists inside top groups: the plan of the library against one that sums members first.

    python scripts/top_lists.py [rows]

Prints seconds, MB shuffled and million rows read of both, from Spark's event log. Data and
log go to a temporary folder of their own.
"""

from __future__ import annotations

import json
import sys
import tempfile
import time
from collections import defaultdict
from pathlib import Path

from pyspark.sql import Window
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from ledgerloom.operators import ranking  # noqa: E402
from ledgerloom.session import local_session  # noqa: E402

ROWS = int(sys.argv[1]) if len(sys.argv) > 1 else 12_000_000
GROUPS, MEMBERS = 5, 3


def two_scans(table):
    return ranking.top_in_top_groups(
        table, "g", ["m"], "amount", "total", groups=GROUPS, members=MEMBERS
    )


def members_first(table):
    """The members' totals serve the groups' totals as well."""
    totals = ranking.totals(table, ["g", "m"], "amount", "total")
    leaders = ranking.top_groups(totals, ["g"], "total", "all", GROUPS).select("g")
    order = Window.partitionBy("g").orderBy(F.desc_nulls_last("total"), F.asc_nulls_first("m"))
    inside = totals.join(F.broadcast(leaders), "g", "left_semi")
    ranked = inside.withColumn("rank", F.row_number().over(order).cast("bigint"))
    return ranked.where(F.col("rank") <= MEMBERS).orderBy("g", "rank").limit(GROUPS * MEMBERS)


def main() -> None:
    folder = Path(tempfile.mkdtemp(prefix="top-lists-"))
    (folder / "log").mkdir()
    settings = {"enabled": "true", "dir": f"file://{folder}/log", "rolling__enabled": "false", "compress": "false"}
    spark = local_session(4, **{f"spark__eventLog__{k}": v for k, v in settings.items()})
    made = spark.range(ROWS).selectExpr(
        "id % 50 AS g", f"xxhash64(id) % {ROWS // 4} AS m", "CAST(id % 1000 AS DECIMAL(18,2)) AS amount"
    )
    made.write.parquet(f"{folder}/rows")
    table = spark.read.parquet(f"{folder}/rows")
    seconds = {}
    for plan in (two_scans, members_first):
        plan(table).collect()  # code generation
        spark.sparkContext.setJobDescription(plan.__name__)
        start = time.perf_counter()
        plan(table).collect()
        seconds[plan.__name__] = time.perf_counter() - start
        spark.sparkContext.setJobDescription(None)
    spark.stop()

    plan_of, moved = {}, defaultdict(lambda: [0.0, 0.0])
    for line in (line for file in (folder / "log").iterdir() for line in file.open()):
        event = json.loads(line)
        if event["Event"] == "SparkListenerJobStart":
            label = (event.get("Properties") or {}).get("spark.job.description")
            plan_of |= {stage: label for stage in event["Stage IDs"]}
        elif event["Event"] == "SparkListenerTaskEnd":
            metrics, sums = event["Task Metrics"], moved[plan_of.get(event["Stage ID"])]
            sums[0] += metrics["Shuffle Write Metrics"]["Shuffle Bytes Written"] / 1e6
            sums[1] += metrics["Input Metrics"]["Records Read"] / 1e6
    for name, taken in seconds.items():
        print(f"{name}: {taken:.1f} s, {moved[name][0]:.1f} MB shuffled, {moved[name][1]:.1f} million rows read")


if __name__ == "__main__":
    main()
