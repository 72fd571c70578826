"""SimHash near-duplicates by pivot distance tables.

A text's fingerprint has a bit set where more than half of its shingles' 64-bit hashes have it.
Two fingerprints link when they differ in at most ``DISTANCE`` bits. The triangle inequality
holds for Hamming distances, so two fingerprints whose distances to one reference fingerprint (a
pivot) differ by more than that cannot link:

1. ``fingerprints``: one row per document. Equal fingerprints are one from here on, so a group
   of copies is one row however large.
2. ``buckets``: distances to pivots alone do not deal fingerprints out well (for random ones, 57
   in 100 lie within 4 of each other's distance to a pivot), so the rows that meet are chosen by
   bits: a bucket that is too large is cut by DISTANCE + 1 disjoint masks, and two fingerprints
   that link agree in all bits of one mask. Masks share out the bits that vary inside the bucket,
   by entropy, so a dense cluster is cut as well; buckets are cut until all are small.
3. ``pivot_links``: in each bucket a table of the distances to all pivots is made first. Rows are
   ordered by the first column, only rows within DISTANCE of each other there are paired, pairs
   with a larger difference in any other column are discarded, and the survivors verified. Links
   that suffice to connect a bucket's rows go on.
4. Components of those links; the smallest doc_id of each.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.components import connected_components, smallest_ids
from ledgerloom.llm.hashed_words import sliced
from ledgerloom.llm.shared import Scratch, broadcast_if_few, scratch, tidied

WIDTH = 4
SEED = 42
DISTANCE = 4

#: Reference fingerprints, and how many fingerprints (by the order of their hashes) they are chosen from.
PIVOTS = 32
SAMPLE = 2048
#: Fingerprints in a bucket, in the slab of buckets that is worked on at once.
BUCKET = 1024
SLAB = 100_000

#: Bytes of a text and shingles that are hashed at once.
PIECE = 1 << 20
HELD = 1 << 17

WHITE = re.compile(rb"[\x20\x09-\x0D]")


# 1. Fingerprints.


def shingle_hashes(text: bytes, width: int = WIDTH, piece: int = PIECE) -> Iterator[list[int]]:
    """XXH64 of all runs of ``width`` words, joined by spaces; of the whole sequence if it is shorter."""
    hashed = xxhash.xxh64_intdigest
    words: list[bytes] = []
    begin, some = 0, False
    while begin < len(text):
        stop = begin + piece
        if stop < len(text):
            white = WHITE.search(text, stop)
            stop = white.start() if white else len(text)
        words += text[begin:stop].lower().split()
        begin = stop
        if len(words) >= width:
            line = b" ".join(words)
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
            starts = [0, *ends[: len(words) - width].tolist()]
            yield [hashed(line[a:b], SEED) for a, b in zip(starts, (ends[width - 1 :] - 1).tolist(), strict=True)]
            words, some = words[len(words) - width + 1 :], True
    if words and not some:
        yield [hashed(b" ".join(words), SEED)]


def fingerprint_array(texts: list[bytes], width: int = WIDTH, piece: int = PIECE) -> np.ndarray:
    """The fingerprints of texts; 0 for one without words."""
    set_ = np.zeros((len(texts), 64), np.int64)
    sizes = np.zeros(len(texts), np.int64)
    rows: list[int] = []
    held: list[list[int]] = []

    def count():
        lengths = np.fromiter(map(len, held), np.int64, len(held))
        hashes = np.fromiter(chain.from_iterable(held), np.uint64, int(lengths.sum()))
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        np.add.at(set_, rows, np.add.reduceat(bits, np.cumsum(lengths) - lengths, axis=0, dtype=np.int64))
        np.add.at(sizes, rows, lengths)
        rows.clear()
        held.clear()

    waiting = 0
    for row, text in enumerate(texts):
        for hashes in shingle_hashes(text, width, piece):
            rows.append(row)
            held.append(hashes)
            waiting += len(hashes)
            if waiting >= HELD:
                count()
                waiting = 0
    if held:
        count()
    bits = (2 * set_ > sizes[:, None]).astype(np.uint8)
    return np.packbits(bits, axis=1, bitorder="little").view("<u8").ravel()


def fingerprints(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``doc_id, fingerprint`` (64 bits as a signed long) for every row."""

    def run(batches):
        for batch in batches:
            for part in sliced(batch, "text"):
                texts = [text or b"" for text in part.column("text").cast(pa.binary()).to_pylist()]
                found = pa.array(fingerprint_array(texts, width).view(np.int64))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), found], names=["doc_id", "fingerprint"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        tidied(run), "doc_id long, fingerprint long"
    )


# 2. Buckets.


def balanced_masks(ones: np.ndarray, n: int, masks: int) -> list[int]:
    """Disjoint masks over all 64 bits with about the same entropy, from how often each bit is set in ``n`` rows."""
    p = np.clip(ones / n, 1e-12, 1 - 1e-12)
    entropy = -(p * np.log2(p) + (1 - p) * np.log2(1 - p))
    out, load = [0] * masks, [0.0] * masks
    for bit in np.argsort(-entropy, kind="stable").tolist():
        least = min(range(masks), key=load.__getitem__)
        out[least] |= 1 << bit
        load[least] += entropy[bit] + 1e-9
    return [mask - (1 << 64) if mask >> 63 else mask for mask in out]


def buckets(prints: DataFrame, work: Scratch, distance: int = DISTANCE, most: int = BUCKET) -> DataFrame:
    """``bucket, fingerprint``: any two of the distinct ``fingerprint`` that link share a bucket of at most ``most`` rows.

    It ends because a bucket's part of one mask no longer varies in that mask's bits, and few
    varying bits make few distinct fingerprints (``most`` must be 2 ** distance or more).
    """
    if most < 1 << distance:
        raise ValueError("most must be at least 2 ** distance")

    def choose(batches):
        for rows in batches:
            ones = rows[[f"bit{k}" for k in range(64)]].to_numpy()
            masks = [balanced_masks(o, n, distance + 1) for o, n in zip(ones, rows["n"], strict=True)]
            yield pd.DataFrame({"bucket": rows["bucket"], "masks": masks})

    one = lambda k: F.sum(F.shiftrightunsigned("fingerprint", k).bitwiseAND(F.lit(1).cast("long")))
    now = work.store(prints.select(F.lit(0).cast("long").alias("bucket"), "fingerprint"))
    ready = []
    while True:
        large = work.store(now.groupBy("bucket").count().where(F.col("count") > most).select("bucket"))
        if large.limit(1).count() == 0:
            return reduce(DataFrame.union, [*ready, now])
        bits = now.join(broadcast_if_few(large), "bucket", "left_semi").groupBy("bucket")
        bits = bits.agg(F.count("*").alias("n"), *(one(k).alias(f"bit{k}") for k in range(64)))
        masks = work.store(bits.mapInPandas(choose, "bucket long, masks array<long>"))
        marked = now.join(broadcast_if_few(masks), "bucket", "left")
        ready.append(marked.where("masks is null").select("bucket", "fingerprint"))
        part = F.xxhash64("bucket", F.col("at"), F.col("fingerprint").bitwiseAND(F.col("mask")))
        now = work.store(
            marked.where("masks is not null")
            .select("bucket", "fingerprint", F.posexplode("masks").alias("at", "mask"))
            .select(part.alias("bucket"), "fingerprint")
        )


# 3. Pivot distance tables.


def pivots_of(prints: DataFrame, n: int = PIVOTS, sample: int = SAMPLE) -> np.ndarray:
    """``n`` reference fingerprints far from each other, of a bounded sample; any choice gives the same links."""
    rows = prints.orderBy(F.xxhash64("fingerprint"), "fingerprint").limit(sample).toArrow()
    some = rows.column(0).to_numpy().view(np.uint64)
    if not len(some):
        return np.zeros(1, np.uint64)
    chosen = [some[0]]
    nearest = np.bitwise_count(some ^ some[0])
    while len(chosen) < n and nearest.max() > 0:
        chosen.append(some[int(np.argmax(nearest))])
        nearest = np.minimum(nearest, np.bitwise_count(some ^ chosen[-1]))
    return np.array(chosen)


def pivot_links(
    bucket: np.ndarray, prints: np.ndarray, pivots: np.ndarray, distance: int = DISTANCE
) -> tuple[np.ndarray, np.ndarray, int]:
    """Links that connect what links inside each bucket, and how many pairs had to be verified."""
    table = np.stack([np.bitwise_count(prints ^ pivot) for pivot in pivots], axis=1).astype(np.int16)
    order = np.lexsort((table[:, 0], bucket))
    bucket, prints, table = bucket[order], prints[order], table[order]
    first = np.ascontiguousarray(table[:, 0])
    parent = np.arange(len(prints))

    def roots(of):
        root = parent[of]
        while True:
            above = parent[root]
            if (above == root).all():
                return root
            root = above

    links: list[tuple[int, int]] = []
    verified = step = 0
    left = np.arange(len(prints))
    while len(left):
        # Ordered by bucket and first distance, so a row without a partner so far on has none beyond.
        step += 1
        left = left[left + step < len(prints)]
        near = (bucket[left + step] == bucket[left]) & (first[left + step] - first[left] <= distance)
        left = left[near]
        a = left
        for column in range(1, table.shape[1]):
            if not len(a):
                break
            a = a[np.abs(table[a + step, column] - table[a, column]) <= distance]
        verified += len(a)
        a = a[np.bitwise_count(prints[a] ^ prints[a + step]) <= distance]
        a = a[roots(a) != roots(a + step)]
        for one in a.tolist():
            x, y = int(roots(np.array([one]))[0]), int(roots(np.array([one + step]))[0])
            if x != y:
                parent[max(x, y)] = min(x, y)
                links.append((one, one + step))
        if len(a):
            parent = roots(np.arange(len(parent)))
    at = np.array(links, dtype=np.int64).reshape(-1, 2)
    return prints[at[:, 0]], prints[at[:, 1]], verified


def links_in_buckets(rows: DataFrame, pivots: np.ndarray, distance: int = DISTANCE, slab: int = SLAB) -> DataFrame:
    """``a, b``: fingerprints that link, enough of them to connect each bucket's rows."""

    def run(batches):
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def found(bucket, prints):
            a, b, _ = pivot_links(bucket, prints.view(np.uint64), pivots, distance)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        for batch in batches:
            held.append(tuple(c.to_numpy(zero_copy_only=False) for c in batch.columns))
            if sum(len(h[0]) for h in held) >= slab:
                bucket, prints = (np.concatenate(c) for c in zip(*held, strict=True))
                cut = int(np.searchsorted(bucket, bucket[-1]))  # the last bucket may go on
                yield found(bucket[:cut], prints[:cut])
                held = [(bucket[cut:], prints[cut:])]
        if held:
            yield found(*(np.concatenate(c) for c in zip(*held, strict=True)))

    return rows.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(tidied(run), "a long, b long")


# 4. Documents.


def near_duplicates(
    docs: DataFrame, *, width: int = WIDTH, distance: int = DISTANCE, pivots: int = PIVOTS, bucket: int = BUCKET
) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row; the fingerprint as 16 hex digits.

    ``component_id`` is the smallest doc_id that links reach, itself included. A text of fewer
    than ``width`` words has its whole sequence as the only shingle; null, empty and white texts
    have fingerprint zero, which links as any other. Texts of any length are read whole, a piece
    at a time. Rows with equal doc_id are documents of their own with that id; a null doc_id
    links as any other and names no component. No rows give no rows; other columns are not read.
    """
    kept = Scratch(docs.sparkSession, "simhash")
    signed = kept.store(fingerprints(docs, width))
    with scratch(docs.sparkSession, "simhash") as work:
        prints = work.store(signed.select("fingerprint").distinct())
        chosen = pivots_of(prints, pivots)
        links = work.store(links_in_buckets(buckets(prints, work, distance, bucket), chosen, distance))
        found = connected_components(links, work)
        groups = kept.store(smallest_ids(signed, "fingerprint", "doc_id", found, work))
    return signed.join(broadcast_if_few(groups), "fingerprint", "left").select(
        "doc_id",
        F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
    )
