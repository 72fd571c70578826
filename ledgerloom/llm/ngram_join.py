"""N-gram Jaccard join by a prefix tree.

Texts become sets of hashed word n-grams. The sets are ordered globally, rare
n-grams first, and two sets can only be similar if they share one of their first
few n-grams. Sets that share such n-grams, directly or through others, meet in one
block (or, if they are many, in a few pairs of blocks), where they are stored in a
trie; a walk over it adds up overlaps that sets share and leaves subtrees whose
remaining lengths cannot reach the similarity.

The work runs in these steps, all of them on Spark:

1. ``signatures``: one row per document with the size and hash of its set. Equal
   sets are one class from here on, so a group of copies is one set however large.
2. ``shared_ngrams``: each n-gram goes once per class and batch to the owner of its
   hash range, packed as sorted differences; owners keep n-grams of two classes or more.
   What ``COMMON`` classes of one batch hold is shared for certain and does not go to one owner:
   the owner only learns that it is common, and its entries are dealt out by class.
3. ``alive_sets``: a class with more than a quarter of n-grams of its own (for 0.75)
   is like no other. What is left is a small part of a corpus without copies.
4. Components of classes that share one of their first n-grams.
5. ``trie_links`` in blocks of bounded size; links that suffice to connect all that
   is similar; components of those. In a group of several blocks the first one meets all
   others. Sets that this does not connect to the most of their group are dealt again, by prefix
   n-gram and band of lengths, or to every block of the group where that makes fewer copies.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.components import connected_components, smallest_ids
from ledgerloom.llm.hashed_words import set_hashes, shingle_sets, sliced, word_hashes
from ledgerloom.llm.shared import Scratch, broadcast_if_few, joined_by_key, partitions, scratch, tidied

WIDTH = 5
PERCENT = 75

#: N-grams that are packed at once, sets and n-grams in a block.
PACKED = 1_000_000
#: Classes of a batch that make an n-gram common, and how many classes hold it in the global order then.
COMMON = 64
MANY = 1 << 40
BLOCK_SETS = 1024
BLOCK_NGRAMS = 1_500_000


def least_overlap(sizes: np.ndarray, percent: int) -> np.ndarray:
    """N-grams of a set that any similar set must share."""
    return -(-sizes * percent // 100)


# 1. Sets and their classes.


def _sets(batches: Iterator[pa.RecordBatch], width: int):
    for batch in batches:
        for part in sliced(batch, "text"):
            words, rows = word_hashes(part.column("text"))
            items, bounds = shingle_sets(words, rows, width)
            yield part, items, bounds, set_hashes(items, bounds)


def signatures(docs: DataFrame, width: int = WIDTH, copies: bool = False) -> DataFrame:
    """``doc_id, n_shingles, class``: per row the size and the hash of its set (0: no words).

    With ``copies`` also ``copy``, the 64-bit hash of the text itself.
    """
    more = ["copy"] if copies else []

    def run(batches):
        for part, _, bounds, classes in _sets(batches, width):
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array(np.diff(bounds)),
                    pa.array(classes.view(np.int64)),
                    *(part.column(c) for c in more),
                ],
                names=["doc_id", "n_shingles", "class", *more],
            )

    own = [F.xxhash64("text").alias(c) for c in more]
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), *own).mapInArrow(
        tidied(run), ", ".join(["doc_id long, n_shingles long, class long", *(f"{c} long" for c in more)])
    )


# 2. N-grams of several classes.


def _packed(items, owner, classes, sizes, ranges):
    """One row per hash range: sorted n-grams as byte planes of their differences."""
    order = np.argsort(items)
    items, owner = items[order], owner[order]
    step = (1 << 64) // ranges
    cuts = np.searchsorted(items, (np.arange(1, ranges, dtype=object) * step).astype(np.uint64))
    bounds = [0, *cuts.tolist(), len(items)]
    return _rows(items, owner, classes, sizes, enumerate(zip(bounds[:-1], bounds[1:], strict=True)), False)


def _dealt(items, owner, classes, sizes, ranges):
    """The same for common n-grams, dealt out by class; and one row without classes for each range that owns some."""
    part = (classes[owner] % np.uint64(ranges)).astype(np.int64)
    order = np.lexsort((items, part))
    bounds = np.searchsorted(part[order], np.arange(ranges + 1))
    yield _rows(items[order], owner[order], classes, sizes, enumerate(zip(bounds[:-1], bounds[1:], strict=True)), True)
    each = np.unique(items)
    yield _packed(each, np.zeros(len(each), np.int64), np.zeros(1, np.uint64), np.zeros(1, np.int64), ranges)


def _rows(items, owner, classes, sizes, spans, common):
    out = {"part": [], "common": [], "ngrams": [], "owner": [], "classes": [], "sizes": []}
    for part, (begin, stop) in spans:
        if begin == stop:
            continue
        held, local = np.unique(owner[begin:stop], return_inverse=True)
        gaps = np.diff(items[begin:stop], prepend=np.uint64(0))
        out["part"].append(part)
        out["common"].append(common)
        out["ngrams"].append(gaps.view(np.uint8).reshape(-1, 8).T.tobytes())
        out["owner"].append(local.astype(np.uint32).view(np.uint8).reshape(-1, 4).T.tobytes())
        out["classes"].append(classes[held].tobytes())
        out["sizes"].append(sizes[held].astype(np.uint32).tobytes())
    return pa.RecordBatch.from_pydict(out, schema=PACKED_SCHEMA)


PACKED_SCHEMA = pa.schema(
    [("part", pa.int32()), ("common", pa.bool_()), *((name, pa.binary()) for name in ("ngrams", "owner", "classes", "sizes"))]
)


def _planes(data: bytes, width: int) -> np.ndarray:
    bytes_ = np.frombuffer(data, np.uint8).reshape(width, -1).T
    return np.ascontiguousarray(bytes_).view(f"<u{width}").ravel()


def shared_ngrams(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``class, size, ngram, df`` for n-grams that two classes or more hold.

    The number of hash ranges is that of shuffle partitions; a range takes some
    40 bytes of memory for each of its n-grams.
    """
    ranges = partitions(docs.sparkSession)

    def pack(batches):
        held, count = [], 0

        def flush():
            items = np.concatenate([h[0] for h in held])
            classes = np.concatenate([h[1] for h in held])
            sizes = np.concatenate([h[2] for h in held])
            # Of equal sets in the batch only the first one is packed.
            _, first = np.unique(classes, return_index=True)
            keep = np.zeros(len(classes), dtype=bool)
            keep[first] = True
            keep &= sizes > 0
            owner = np.repeat(np.arange(len(classes)), sizes)
            chosen = keep[owner]
            items, owner = items[chosen], owner[chosen]
            _, at, n = np.unique(items, return_inverse=True, return_counts=True)
            common = n[at] >= COMMON
            yield _packed(items[~common], owner[~common], classes, sizes, ranges)
            if common.any():
                yield from _dealt(items[common], owner[common], classes, sizes, ranges)

        for _, items, bounds, classes in _sets(batches, width):
            held.append((items, classes, np.diff(bounds)))
            count += len(items)
            if count >= PACKED:
                yield from flush()
                held, count = [], 0
        if count:
            yield from flush()

    def rows(classes, sizes, ngrams, df):
        return pa.RecordBatch.from_arrays(
            [
                pa.array(classes.view(np.int64)),
                pa.array(sizes.astype(np.int32)),
                pa.array(ngrams.view(np.int64)),
                pa.array(df.astype(np.int64)),
            ],
            names=["class", "size", "ngram", "df"],
        )

    def merge(batches):
        ngrams, classes, sizes = [], [], []
        for batch in batches:
            for row in batch.to_pylist():
                local = _planes(row["owner"], 4)
                own = np.cumsum(_planes(row["ngrams"], 8), dtype=np.uint64)
                of, size = np.frombuffer(row["classes"], np.uint64)[local], np.frombuffer(row["sizes"], np.uint32)[local]
                if row["common"]:
                    yield rows(of, size, own, np.full(len(own), MANY))
                    continue
                ngrams.append(own)
                classes.append(of)
                sizes.append(size)
        if not ngrams:
            return
        ngrams, classes, sizes = map(np.concatenate, (ngrams, classes, sizes))
        order = np.argsort(ngrams)
        sorted_ngrams = ngrams[order]
        same = sorted_ngrams[1:] == sorted_ngrams[:-1]
        twice = np.concatenate((same, [False])) | np.concatenate(([False], same))
        order = order[twice]
        ngrams, classes, sizes = ngrams[order], classes[order], sizes[order]
        order = np.lexsort((classes, ngrams))
        ngrams, classes, sizes = ngrams[order], classes[order], sizes[order]
        fresh = np.ones(len(ngrams), dtype=bool)
        fresh[1:] = (ngrams[1:] != ngrams[:-1]) | (classes[1:] != classes[:-1])
        ngrams, classes, sizes = ngrams[fresh], classes[fresh], sizes[fresh]
        _, first, group, df = np.unique(ngrams, return_index=True, return_inverse=True, return_counts=True)
        # Class 0, of no words, stands first where the n-gram is common somewhere.
        df = np.where(classes[first] == 0, MANY, df)[group]
        shared = (df > 1) & (classes != 0)
        for begin in range(0, int(shared.sum()), 100_000):
            part = np.flatnonzero(shared)[begin : begin + 100_000]
            yield rows(classes[part], sizes[part], ngrams[part], df[part])

    return (
        docs.select(F.col("text").cast("string"))
        .mapInArrow(tidied(pack), "part int, common boolean, ngrams binary, owner binary, classes binary, sizes binary")
        .repartitionById(ranges, F.col("part"))
        .mapInArrow(tidied(merge), "class long, size int, ngram long, df long")
    )


# 3. Sets that may be similar to another.


def alive_sets(shared: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``class, size, first, ngrams``: sets with enough shared n-grams to be similar to any other.

    ``ngrams`` holds the shared ones in the global order (by df, then hash); ``first``
    tells how many of them belong to the set's prefix.
    """

    def gather(batches):
        tables = [pa.Table.from_batches([b]) for b in batches if b.num_rows]
        if not tables:
            return
        rows = pa.concat_tables(tables)
        classes, sizes, ngrams, df = (rows.column(k).to_numpy() for k in range(4))
        order = np.lexsort((ngrams, df, classes))
        # What is common in one batch only comes from its owner as well.
        fresh = np.ones(len(order), dtype=bool)
        fresh[1:] = (classes[order][1:] != classes[order][:-1]) | (ngrams[order][1:] != ngrams[order][:-1])
        order = order[fresh]
        classes, sizes, ngrams = classes[order], sizes[order].astype(np.int64), ngrams[order]
        starts = np.flatnonzero(np.concatenate(([True], classes[1:] != classes[:-1])))
        counts = np.diff(np.append(starts, len(classes)))
        size = sizes[starts]
        first = counts - least_overlap(size, percent) + 1
        chosen = np.flatnonzero(first > 0)
        for at in range(0, len(chosen), 500):
            some = chosen[at : at + 500]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(classes[starts[some]]),
                    pa.array(size[some].astype(np.int32)),
                    pa.array(first[some].astype(np.int32)),
                    pa.array([ngrams[starts[k] : starts[k] + counts[k]] for k in some], pa.list_(pa.int64())),
                ],
                names=["class", "size", "first", "ngrams"],
            )

    return shared.repartition("class").mapInArrow(
        tidied(gather), "class long, size int, first int, ngrams array<long>"
    )


# 5. The trie.


def trie_links(classes: np.ndarray, sizes: np.ndarray, sets: list, percent: int = PERCENT) -> list:
    """Links ``(class, class)`` that connect all similar sets of a block.

    Sets are ordered by how many sets of the block hold an n-gram, common ones first,
    so that they share long ways from the root. At each branching the overlaps of all
    sets with the way so far are known; a subtree is left when every set that could
    still reach the similarity there, by the lengths that remain, is connected to it.
    """
    m = len(classes)
    owner = np.repeat(np.arange(m), [len(s) for s in sets])
    _, ngram, held = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    order = np.argsort(-held, kind="stable")
    rank = np.empty(len(held), dtype=np.int64)
    rank[order] = np.arange(len(held))
    useful = held[ngram] > 1
    ranks, owner = rank[ngram[useful]], owner[useful]
    by_set = np.lexsort((ranks, owner))
    ranks, owner = ranks[by_set], owner[by_set]
    bounds = np.searchsorted(owner, np.arange(m + 1))
    by_rank = np.lexsort((owner, ranks))
    holders, first = owner[by_rank], np.searchsorted(ranks[by_rank], np.arange(len(held) + 1))
    paths = [ranks[bounds[k] : bounds[k + 1]] for k in range(m)]
    need = least_overlap(sizes, percent)
    leaves = [k for k in range(m) if len(paths[k]) >= need[k]]
    leaves.sort(key=lambda k: paths[k].astype(">u4").tobytes())

    def shared_start(a, b):
        n = min(len(a), len(b))
        differ = np.flatnonzero(a[:n] != b[:n])
        return int(differ[0]) if len(differ) else n

    lcp = [shared_start(paths[a], paths[b]) for a, b in zip(leaves[:-1], leaves[1:], strict=True)] + [0]
    common = np.array(lcp)
    lengths = np.array([len(paths[k]) for k in leaves], dtype=np.int64)
    label, links = np.arange(m), []

    def along(overlap, path):
        """Overlaps of all sets with the way longer by ``path``."""
        if not len(path):
            return overlap
        near = np.concatenate([holders[first[r] : first[r + 1]] for r in path.tolist()])
        return overlap + np.bincount(near, minlength=m)

    def reachable(overlap, low, longest):
        """Sets that may be similar to one of at least ``low`` n-grams with ``longest`` to come."""
        most = overlap + longest
        return (most >= need) & (most * 100 >= percent * np.maximum(low, sizes + low - most))

    stack = [(0, np.zeros(m, dtype=np.int64))]
    at = 0
    while at < len(leaves):
        depth, overlap = stack[-1]
        set_, branch = leaves[at], lcp[at]
        if branch > depth:
            below = np.flatnonzero(common[at:] < branch)
            stop = at + int(below[0]) + 1 if len(below) else len(leaves)
            overlap = along(overlap, paths[set_][depth:branch])
            under = leaves[at:stop]
            near = reachable(overlap, sizes[under].min(), int(lengths[at:stop].max()) - branch)
            near[under] = True
            if (label[near] == label[set_]).all():
                at = stop  # all that could be similar to a set below is connected to it
                while stack[-1][0] > lcp[at - 1]:
                    stack.pop()
                continue
            stack.append((branch, overlap))
            depth = branch
        if not (label == label[set_]).all():
            full = along(overlap, paths[set_][depth:])
            similar = full * 100 >= percent * (sizes + sizes[set_] - full)
            similar[set_] = False
            for other in np.flatnonzero(similar & (label != label[set_])).tolist():
                if label[other] != label[set_]:
                    links.append((int(classes[set_]), int(classes[other])))
                    label[label == label[other]] = label[set_]
        while stack[-1][0] > lcp[at]:
            stack.pop()
        at += 1
    return links


def block_links(blocks: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Links of each ``block``; blocks are bounded by BLOCK_SETS and BLOCK_NGRAMS (twice, for pairs)."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.drop_duplicates("class").sort_values("class")
        links = trie_links(
            rows["class"].to_numpy(), rows["size"].to_numpy().astype(np.int64), list(rows["ngrams"]), percent
        )
        return pd.DataFrame(links, columns=["a", "b"], dtype=np.int64)

    return blocks.groupBy("block").applyInPandas(run, "a long, b long")


def similar_links(alive: DataFrame, work: Scratch, percent: int = PERCENT) -> DataFrame:
    """Links that connect every two similar sets, if not directly, then through others."""
    prefix = alive.select("class", F.explode(F.slice("ngrams", F.lit(1), F.col("first"))).alias("ngram"))
    leader = prefix.groupBy("ngram").agg(F.min("class").alias("leader"), F.count("*").alias("held"))
    near = joined_by_key(prefix, work.store(leader.where("held > 1")), ["ngram"], "held").where("class != leader")
    meeting = connected_components(near.select("class", "leader").distinct(), work)
    members = work.store(alive.join(meeting, alive["class"] == meeting["node"]).drop("node"))

    groups = members.groupBy("component").agg(
        F.count("*").alias("sets"), F.sum(F.size("ngrams")).alias("held")
    )
    groups = work.store(
        groups.select(
            "component",
            "sets",
            F.ceil(F.greatest(F.col("sets") / BLOCK_SETS, F.col("held") / BLOCK_NGRAMS)).cast("int").alias("blocks"),
            F.ceil(F.greatest(F.col("sets") / BLOCK_SETS * 1e6, F.col("held") / BLOCK_NGRAMS * 1e6))
            .cast("long")
            .alias("load"),
        )
    )
    bins = groups.where("blocks = 1").agg(F.sum("load")).first()[0] or 0
    placed = members.join(groups, "component")
    several = F.col("blocks") > 1
    own = F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int")
    # Groups of one block are put together; a larger one is cut, and block 0 meets each other block.
    small = placed.where(~several).select(
        F.concat(F.lit("small "), F.pmod(F.xxhash64("component"), F.lit(int(bins // 1_000_000) + 1))).alias("block"),
        "class", "size", "ngrams",
    )
    large = placed.where(several).select("component", "blocks", own.alias("own"), "class", "size", "first", "ngrams")
    pivot = F.when(F.col("own") == 0, F.sequence(F.lit(1), F.col("blocks") - 1)).otherwise(F.array("own"))
    pairs = large.select("component", F.explode(pivot).alias("with"), "class", "size", "ngrams").select(
        F.concat_ws(" ", "component", "with").alias("block"), "class", "size", "ngrams"
    )
    links = work.store(block_links(small.union(pairs), percent))

    if not groups.where("blocks > 1").limit(1).count():
        return links
    # What block 0 did not connect to the most of its group meets what it may still be similar to.
    left = work.store(_unsettled(large, links, work))
    minor = work.store(left.where("minor").groupBy("component").agg(F.count("*").alias("few")))
    if not minor.limit(1).count():
        return links
    left = left.join(broadcast_if_few(minor.select("component")), "component")
    keys = work.store(_meeting_keys(left, percent))
    ways = work.store(_dear_ways(left, minor, keys))
    by_block = left.join(broadcast_if_few(ways.where("not by_ngram").drop("by_ngram")), "component")
    by_ngram = broadcast_if_few(ways.where("by_ngram").select("component"))
    again = _by_block(by_block).unionByName(
        _by_ngram(left.join(by_ngram, "component"), keys.join(by_ngram, "component"), work, percent)
    )
    return work.store(links.union(block_links(again, percent)))


def _unsettled(large: DataFrame, links: DataFrame, work: Scratch) -> DataFrame:
    """Sets outside of block 0, whose own have met all of their group; ``minor`` are not connected to the most of it."""
    large = work.store(_with_part(large, connected_components(links, work)))
    most = (
        large.groupBy("component", "part")
        .count()
        .groupBy("component")
        .agg(F.max_by("part", F.struct("count", "part")).alias("most"))
    )
    return (
        large.where("own > 0")
        .join(broadcast_if_few(work.store(most)), "component")
        .withColumn("minor", F.col("part") != F.col("most"))
        .drop("most")
    )


def _by_block(left: DataFrame) -> DataFrame:
    """``block, class, size, ngrams``: minor sets, in chunks, beside every block of their group."""
    everywhere = left.where("minor").select(
        F.pmod(F.xxhash64("class", F.lit(1)), F.col("chunks")).alias("chunk"),
        F.explode(F.sequence(F.lit(1), F.col("blocks") - 1)).alias("with"),
        "component", "class", "size", "ngrams",
    )
    against = left.select(
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk"),
        F.col("own").alias("with"), "component", "class", "size", "ngrams",
    )
    return everywhere.unionByName(against).select(
        F.concat_ws(" ", "component", "with", "chunk").alias("block"), "class", "size", "ngrams"
    )


#: What a meeting place of sets goes by: sets that may be similar share a prefix n-gram and a band of lengths.
PLACE = ["component", "ngram", "band"]


def _places(left: DataFrame, percent: int) -> DataFrame:
    """A row for each place of a set: its prefix n-grams, each in its band of lengths and the next longer one.

    A band is a little wider than similar lengths may differ, so similar sets are in one or in
    two that follow each other.
    """
    band = F.floor(F.log("size") / F.log(F.lit(100 / percent * 1.001)))
    narrow = left.select("component", "class", "part", "minor", F.size("ngrams").alias("length"), band.alias("low"),
                         F.explode(F.slice("ngrams", F.lit(1), F.col("first"))).alias("ngram"))
    return narrow.withColumn("band", F.explode(F.array("low", F.col("low") + 1))).drop("low")


def _meeting_keys(left: DataFrame, percent: int) -> DataFrame:
    """Places with a minor set and one of another part: how many they hold, in how many chunks and blocks."""
    found = _places(left, percent).groupBy(*PLACE).agg(
        F.count("*").alias("sets"),
        F.count_if("minor").alias("few"),
        F.sum("length").alias("held"),
        F.min("part").alias("one"),
        F.max("part").alias("other"),
    )

    def cut(n):
        # N-grams of a part of the sets go by their mean.
        return F.ceil(F.greatest(n / BLOCK_SETS, n * F.col("held") / F.col("sets") / BLOCK_NGRAMS)).cast("long")

    return found.where("few > 0 and one != other").select(
        *PLACE,
        "sets",
        "few",
        cut(F.col("few")).alias("chunks"),
        cut(F.col("sets")).alias("parts"),
        F.greatest(F.col("sets") / BLOCK_SETS * 1e6, F.col("held") / BLOCK_NGRAMS * 1e6).cast("long").alias("load"),
    )


def _dear_ways(left: DataFrame, minor: DataFrame, keys: DataFrame) -> DataFrame:
    """``component, chunks, by_ngram``: whether a group's sets go to fewer places by n-gram and length than by block."""
    sets = left.groupBy("component").agg(F.count("*").alias("sets"), F.first("blocks").alias("blocks"))
    chunks = F.ceil(F.col("few") / BLOCK_SETS)
    by_block = F.col("few") * (F.col("blocks") - 1) + F.col("sets") * chunks
    placed = F.when(F.col("parts") == 1, F.col("sets")).otherwise(
        F.col("few") * F.col("parts") + F.col("sets") * F.col("chunks")
    )
    by_ngram = keys.groupBy("component").agg(F.sum(placed).alias("placed"))
    # Without any place no set of the group can be similar to one it is not connected to.
    return sets.join(minor, "component").join(by_ngram, "component").select(
        "component", chunks.alias("chunks"), (F.col("placed") < by_block).alias("by_ngram")
    )


def _by_ngram(left: DataFrame, keys: DataFrame, work: Scratch, percent: int) -> DataFrame:
    """``block, class, size, ngrams``: the sets of each place.

    Places of one block are put together; of larger ones, minor sets in chunks meet all sets in parts.
    A set goes to no more blocks than it has prefix n-grams, times the chunks of a place too large for one block.
    """
    bins = F.lit(int((keys.where("parts = 1").agg(F.sum("load")).first()[0] or 0) // 1_000_000) + 1)
    keys = work.store(keys)
    placed = work.store(
        joined_by_key(_places(left, percent).select(*PLACE, "class", "minor"), keys, PLACE, "sets").drop("sets", "few", "load")
    )
    small = placed.where("parts = 1").select(
        F.concat(F.lit("places "), F.pmod(F.xxhash64(*PLACE), bins)).alias("block"), "class"
    )
    large = placed.where("parts > 1")
    chunk = F.pmod(F.xxhash64("class", F.lit(1)), F.col("chunks"))
    part = F.pmod(F.xxhash64("class", F.lit(2)), F.col("parts"))
    to_all = large.where("minor").select(
        *PLACE, "class", chunk.alias("chunk"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("with")
    )
    of_all = large.select(
        *PLACE, "class", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk"), part.alias("with")
    )
    met = to_all.unionByName(of_all).select(F.concat_ws(" ", *PLACE, "chunk", "with").alias("block"), "class")
    blocks = work.store(small.union(met).distinct())
    return blocks.join(left.select("class", "size", "ngrams"), "class").select("block", "class", "size", "ngrams")


def _with_part(large: DataFrame, found: DataFrame) -> DataFrame:
    found = found.select(F.col("node").alias("class"), F.col("component").alias("part"))
    return large.join(found, "class", "left").withColumn("part", F.coalesce("part", "class"))


def near_duplicates(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, class, component_id``.

    Two documents link when 100 * intersection >= ``percent`` * union of their sets;
    ``component_id`` is the smallest doc_id that links reach, itself included.
    Texts that are null or hold no word have no set and link with nothing, not even
    each other. Rows with equal doc_id are documents of their own with that id; a null
    doc_id links as any other and names no component. Texts of any length are read whole, in
    slices. No rows give no rows; other columns are not read.
    """
    kept = Scratch(docs.sparkSession, "ngram-join")
    signed, found = _signed_and_found(docs, width, percent, kept)
    with scratch(docs.sparkSession, "ngram-join") as work:
        own = signed.where("n_shingles > 0")
        groups = kept.store(smallest_ids(own, "class", "doc_id", found, work))
    # Class 0, of no words, is in no group.
    return signed.join(broadcast_if_few(groups), "class", "left").select(
        "doc_id", "n_shingles", "class", F.coalesce("component_id", "doc_id").alias("component_id")
    )


def near_duplicate_rows(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """``doc_id, copy, part`` for every row with words: the text's 64-bit hash and the component, whatever its ids."""
    kept = Scratch(docs.sparkSession, "ngram-join")
    signed, found = _signed_and_found(docs, width, percent, kept, copies=True)
    found = found.select(F.col("node").alias("class"), F.col("component").alias("part"))
    rows = signed.where("n_shingles > 0").join(broadcast_if_few(found), "class", "left")
    return rows.select("doc_id", "copy", F.coalesce("part", "class").alias("part"))


def _signed_and_found(
    docs: DataFrame, width: int, percent: int, kept: Scratch, copies: bool = False
) -> tuple[DataFrame, DataFrame]:
    signed = kept.store(signatures(docs, width, copies))
    with scratch(docs.sparkSession, "ngram-join") as work:
        shared = work.store(alive_sets(shared_ngrams(docs, width), percent))
        found = kept.store(connected_components(similar_links(shared, work, percent), work))
    return signed, found
