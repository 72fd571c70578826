"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.shared import Scratch, joined_by_key


#: Edges of a round up to which one task may meet all of a node's.
HUB = 500_000


def connected_components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """``node, component`` for every node that a link names; the component is its smallest node.

    ``links`` has two columns of long ids. Each round hangs every node below the
    smallest neighbour it has (first its larger neighbours, then its smaller
    ones); rounds end when the stars stay the same, after a number of rounds that
    grows with the logarithm of the nodes. Each round is stored in the shared
    folder, so no lineage grows and a lost executor costs no earlier round.

    A star's centre has an edge to every node of its component. From ``HUB`` edges on, the smallest
    neighbours are counted out per node and stored, and a centre's edges stay where they are
    while its one neighbour is sent to them, so no task meets all edges of a node.
    """
    a, b = links.columns
    edges = (
        links.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct()
    )
    edges, seen = scratch.store(edges), None
    n = edges.count()
    while True:
        spread = n > HUB
        both = edges.select("u", "v").union(edges.select("v", "u"))
        least = _smallest_neighbours(both).select("u", F.least("u", "low").alias("low"), "held")
        large = _with_smallest(both.where("v > u"), least, spread, scratch)
        large = large.select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()
        large = scratch.store(large) if spread else large
        low = _smallest_neighbours(large)
        low = scratch.store(low) if spread else low
        small = (
            _with_smallest(large, low, spread)
            .where("v != low")
            .select(F.col("v").alias("u"), F.col("low").alias("v"))
            .union(low.select("u", "low"))
            .distinct()
        )
        edges = scratch.store(small)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen, n = now, now[0]
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)


def _smallest_neighbours(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("low"), F.count("*").alias("held"))


def _with_smallest(edges: DataFrame, smallest: DataFrame, spread: bool, scratch: Scratch | None = None) -> DataFrame:
    """``edges`` with the smallest neighbour of their ``u``; ``smallest`` is stored here if ``scratch`` is given."""
    if not spread:
        return edges.join(smallest, "u")
    return joined_by_key(edges, scratch.store(smallest) if scratch else smallest, ["u"], "held", HUB)


def smallest_ids(rows: DataFrame, node: str, id_: str, found: DataFrame, work: Scratch) -> DataFrame:
    """``node, component_id`` for every node that is in ``found`` or that several of the stored ``rows`` share.

    ``component_id`` is the smallest ``id_`` of all rows of the component's nodes; other rows are
    their own. Copies are counted per node before anything is joined, and what is joined is stored, so
    a node or component of many rows is split like any other.
    """
    nodes = work.store(rows.groupBy(node).agg(F.min(id_).alias("least"), F.count("*").alias("held")))
    found = found.withColumnRenamed("node", node)
    linked = work.store(found.join(nodes, node))
    least = work.store(
        linked.groupBy("component").agg(F.min("least").alias("component_id"), F.count("*").alias("nodes"))
    )
    several = nodes.where("held > 1").join(linked, node, "left_anti")
    return (
        joined_by_key(linked, least, ["component"], "nodes")
        .select(node, "component_id")
        .union(several.select(node, F.col("least").alias("component_id")))
    )
