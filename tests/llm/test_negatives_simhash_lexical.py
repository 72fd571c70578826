"""Hard negatives, SimHash near-duplicates and ranked lexical search against brute force."""

import math
import random
import re
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from ledgerloom.llm import cover_tree, lexical, simhash
from ledgerloom.llm.shared import scratch

# Hard negatives.

EMBEDDINGS = "vec_id long, embedding array<float>, label int, row string, window string, node string, query string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, label, "r", "w", "n", "q") for i, v, label in rows], EMBEDDINGS)


def negatives_by_hand(rows):
    whole = [
        (i, [math.floor(256 * float(np.float32(x))) for x in v], label)
        for i, v, label in rows
        if i is not None and v is not None and label is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    out = []
    for a, (anchor, q, label) in enumerate(whole):
        if anchor % 50:
            continue
        others = sorted(
            (-sum(x * y for x, y in zip(q, v)), i, other)
            for k, (i, v, other) in enumerate(whole)
            if k != a and len(v) == len(q)
        )
        for p, positive, _ in [o for o in others if o[2] == label][:5]:
            fits = [o for o in others if o[2] != label and 50 * -p <= 100 * -o[0] <= 95 * -p]
            out += [(anchor, positive, r, o[1], -p, -o[0]) for r, o in enumerate(fits[:3], 1)]
    return sorted(out)


def many_vectors():
    rng = np.random.default_rng(11)
    centres = rng.normal(0, 0.4, (6, 5))
    rows = [(i, (centres[i % 6] + rng.normal(0, 0.1, 5)).astype(np.float32).tolist(), i % 4) for i in range(400)]
    rows += [(1000 + i, [0.5] * 5, i % 3) for i in range(60)]  # copies, some of them anchors
    rows += [(50, [0.1, 0.2, 0.3, 0.4, 0.5], 1), (50, [0.5, 0.2, 0.3, 0.1, 0.5], 1), (51, [0.5] * 5, 1)]
    rows += [(2000, None, 1), (2050, [None] * 5, 1), (2100, [float("nan")] * 5, 1), (2150, [float("inf")] * 5, 1)]
    rows += [(2200, [0.1] * 5, None), (None, [0.4] * 5, 1), (2250, [0.0] * 5, 2), (2300, [], 1), (2350, [], 1), (2351, [], 2)]
    rows += [(2400, [1.0, 1.0], 1), (2401, [1.0, 0.9], 1), (2402, [0.9, 0.9], 2), (2450, [-1.0, -1.0], 3), (2451, [1.0, 1.0], 3)]
    return rows


@pytest.mark.parametrize(("leaf", "fan", "first"), [(2048, 32, 4), (60, 6, 1)])
def test_hard_negatives_equal_brute_force(spark, leaf, fan, first):
    rows = many_vectors()
    found = cover_tree.hard_negatives(
        vectors(spark, rows), F.col("vec_id") % 50 == 0, leaf=leaf, fan=fan, sample=40, first=first
    )
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, found.collect())) == negatives_by_hand(rows)


def test_every_row_lies_within_the_radii_above_it(spark):
    with scratch(spark, "test") as work:
        rows = cover_tree.prepared(vectors(spark, many_vectors())).withColumn("row", F.monotonically_increasing_id())
        tree = cover_tree.build(work.store(rows.where("dims = 5")), work, leaf=40, fan=4, sample=30)
        assert len(tree.levels) > 1
        leaves = tree.leaves.collect()
        assert len(leaves) == rows.where("dims = 5").count() and len({r["row"] for r in leaves}) == len(leaves)
        for level in tree.levels:
            for c in level.collect():
                under = f"{c['node']}.{c['child']}"
                for r in leaves:
                    if (r["node"] + ".").startswith(under + ".") and c["label"] in (None, r["label"]):
                        a, b = np.array(r["v"], float), np.array(c["centre"], float)
                        lift = math.sqrt(max(tree.most - a @ a, 0)) - math.sqrt(max(tree.most - b @ b, 0))
                        assert math.sqrt((a - b) @ (a - b) + lift * lift) <= c["radius"] + 1e-3


def test_bounds_leave_out_leaves(spark, monkeypatch):
    """Clustered vectors: most leaves are never visited."""
    rng = np.random.default_rng(2)
    rows = [(i, (np.eye(8)[i % 8] * 2 + rng.normal(0, 0.01, 8)).astype(np.float32).tolist(), i % 2) for i in range(800)]
    with scratch(spark, "test") as work:
        own = cover_tree.prepared(vectors(spark, rows)).withColumn("row", F.monotonically_increasing_id())
        own = work.store(own)
        tree = cover_tree.build(own, work, leaf=120, fan=8, sample=400)
        visited = []
        plain = cover_tree.met

        def counted(visits, others, keys, *rest):
            if "block" in keys:
                visited.append(visits.count())
            return plain(visits, others, keys, *rest)

        monkeypatch.setattr(cover_tree, "met", counted)
        windows = F.array(F.struct(F.lit(0).alias("window"), F.lit(-(1 << 62)).alias("low"), F.lit(1 << 62).alias("high")))
        asked = work.store(own.where("vec_id % 50 = 0").withColumnRenamed("row", "query").withColumn("windows", windows))
        found = cover_tree.search(tree, asked, 5, True, work, first=1)
        assert found.count() == 80 and sum(visited) == 16  # 16 anchors, one leaf of eight each


def test_hard_negatives_of_an_empty_table(spark):
    assert cover_tree.hard_negatives(vectors(spark, []), F.col("vec_id") % 50 == 0).count() == 0


# SimHash.

DOCS = "doc_id long, text string, fingerprint string, bucket string, component string, rows string"


def texts_frame(spark, rows):
    return spark.createDataFrame([(i, t, "f", "b", "c", "r") for i, t in rows], DOCS)


def fingerprint_by_hand(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    shingles = [" ".join(words[k : k + 4]) for k in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked_by_hand(rows):
    prints = [fingerprint_by_hand(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(range(len(rows)), 2):
        if (prints[a] ^ prints[b]).bit_count() <= 4:
            parent[find(a)] = find(b)
    least = defaultdict(list)
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)].append(i)
    return [(i, f"{p:016x}", min(least[find(k)], default=None)) for k, ((i, _), p) in enumerate(zip(rows, prints, strict=True))]


def similar_texts(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice(["Ab", "é", "漢字", "x"]) + str(rng.randrange(400))
    rows = [[word() for _ in range(rng.randrange(1, 40))] for _ in range(150)]
    for base in ([word() for _ in range(300)], [word() for _ in range(120)]):
        for _ in range(120):
            own = list(base)
            for _ in range(rng.randrange(4)):
                own[rng.randrange(len(own))] = word()
            rows.append(own)
    texts = [rng.choice([" ", "\n", "\t \x0b"]).join(w) for w in rows]
    texts += [None, "", " \x0c\r", "One", "ONE", "a b c", "a b c d", texts[0].lower(), texts[-1], texts[-1], "a b c d e", "long " * 40_000]
    return [(3 * k, t) for k, t in enumerate(texts)] + [(7, texts[5]), (7, "other"), (None, texts[6]), (None, "no id, alone here")]


@pytest.mark.parametrize("bucket", [1024, 16])
def test_simhash_components_equal_brute_force(spark, bucket):
    rows = similar_texts(bucket)
    found = simhash.near_duplicates(texts_frame(spark, rows), bucket=bucket, pivots=8 if bucket == 16 else 32)
    assert found.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(linked_by_hand(rows), key=str)


def test_fingerprints_do_not_hang_on_pieces():
    texts = [(t or "").encode() for _, t in similar_texts(5)]
    whole = simhash.fingerprint_array(texts)
    assert [int(f) for f in whole[:200]] == [fingerprint_by_hand(t.decode()) for t in texts[:200]]
    for piece in (1, 7, 100):
        assert (simhash.fingerprint_array(texts[:200], piece=piece) == whole[:200]).all()


@pytest.mark.parametrize("seed", range(4))
def test_buckets_hold_all_that_links_and_stay_small(spark, seed):
    rng = random.Random(seed)
    base = rng.getrandbits(64)
    prints = {base ^ sum(1 << b for b in rng.sample(range(20), rng.randrange(10))) for _ in range(400)}  # a dense cluster
    prints |= {rng.getrandbits(64) for _ in range(200)}
    frame = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "fingerprint long")
    with scratch(spark, "test") as work:
        held = simhash.buckets(frame, work, 4, 32).collect()
    of = defaultdict(set)
    for r in held:
        of[r["fingerprint"] % (1 << 64)].add(r["bucket"])
    assert max(Counter(r["bucket"] for r in held).values()) <= 32
    for a, b in combinations(prints, 2):
        assert (a ^ b).bit_count() > 4 or of[a] & of[b]


@pytest.mark.parametrize("seed", range(4))
def test_pivot_tables_connect_what_links_and_discard_most(seed):
    rng = np.random.default_rng(seed)
    prints = rng.integers(0, 1 << 63, 500, dtype=np.uint64)
    near = prints[:200] ^ (np.uint64(1) << rng.integers(0, 64, 200).astype(np.uint64))
    prints = np.unique(np.concatenate((prints, near)))
    bucket = (prints & np.uint64(1)).astype(np.int64)
    a, b, verified = simhash.pivot_links(bucket, prints, prints[:32])
    pairs = [(x, y) for x, y in combinations(range(len(prints)), 2) if bucket[x] == bucket[y] and int(prints[x] ^ prints[y]).bit_count() <= 4]

    def groups(links):
        own = {int(p): int(p) for p in prints}

        def find(x):
            while own[x] != x:
                x = own[x]
            return x

        for x, y in links:
            own[find(x)] = find(y)
        out = defaultdict(set)
        for p in own:
            out[find(p)].add(p)
        return sorted(map(sorted, out.values()))

    assert groups(zip(a.tolist(), b.tolist(), strict=True)) == groups((int(prints[x]), int(prints[y])) for x, y in pairs)
    assert verified < 0.05 * len(prints) ** 2 / 2


def test_simhash_of_an_empty_table(spark):
    assert simhash.near_duplicates(texts_frame(spark, [])).count() == 0


# Ranked lexical search.

ITEMS = "item_id long, text string, term string, weight string, item string"


def ranked_by_hand(docs, items, k=50):
    def terms(text):
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)

    counts = [Counter(terms(t)) for _, t in docs]
    sizes = [sum(c.values()) for c in counts]
    n_docs, n_terms = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for c in counts for t in c)
    out = []
    for item, text in sorted(set(items), key=str):
        scores = []
        for (doc, _), c, n in zip(docs, counts, sizes, strict=True):
            m = 50 + 50 * n * n_docs // max(n_terms, 1)
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * m))
                for t in set(terms(text)) if c[t]
            )
            if score > 0:
                scores.append((-score, doc is None, doc or 0))
        out += [(item, r, None if none else doc, -s) for r, (s, none, doc) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def corpus(seed):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(300)] + ["É", "naïve", "漢字", "Ab9"]
    weight = [1 / (k + 1) for k in range(len(words))]
    some = lambda n: rng.choice([" ", ", ", "\n-_"]).join(rng.choices(words, weight, k=n))
    docs = [(k, some(rng.randrange(1, 120))) for k in range(700)]
    docs += [(9000, docs[3][1]), (8000, docs[3][1]), (8000, docs[3][1]), (None, docs[4][1]), (9001, None), (9002, ""), (9003, "!? \x00")]
    docs += [(9004, "w5 " * 60_000)]
    items = [(k, some(rng.randrange(1, 25))) for k in range(25)]
    items += [(100, None), (101, ""), (102, "unheard words"), (3, items[3][1]), (5, items[5][1]), (None, "w0 w200"), (103, "w5 W5 w5")]
    return docs, items


@pytest.mark.parametrize("small", [False, True])
def test_lexical_search_equals_brute_force(spark, monkeypatch, small):
    if small:
        for name, value in (("SLAB_DOCS", 40), ("SLAB_ENTRIES", 900), ("GROUP_ENTRIES", 3000), ("CHUNK_TERMS", 60), ("STRIDE", 16)):
            monkeypatch.setattr(lexical, name, value)
        monkeypatch.setattr(lexical, "BROADCAST_ROWS", 3)
    docs, items = corpus(small)
    items_frame = spark.createDataFrame([(i, t, "t", "w", "i") for i, t in items], ITEMS)
    found = lexical.ranked(texts_frame(spark, docs), items_frame)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, found.collect()), key=str) == ranked_by_hand(docs, items)


def test_different_texts_of_one_item_are_ranked_each_for_itself(spark):
    docs, _ = corpus(1)
    items = [(1, "w0 w7"), (1, "w3")]
    found = lexical.ranked(texts_frame(spark, docs), spark.createDataFrame([(i, t, "", "", "") for i, t in items], ITEMS), 4)
    assert sorted(map(tuple, found.collect()), key=str) == ranked_by_hand(docs, items, 4)


def test_bounds_skip_most_of_the_long_lists():
    rng = np.random.default_rng(0)
    n = 40_000
    lists = [np.sort(rng.choice(n, size, replace=False)) for size in (30, 60, 30_000, 35_000)]
    docs = np.concatenate(lists)
    starts = np.cumsum([0, *map(len, lists)])
    values = rng.integers(900, 1000, len(docs))
    slab = lexical.Slab(
        np.arange(1, 5), starts, docs, values, np.maximum.reduceat(values, starts[:-1]), np.arange(n), np.ones(n, bool)
    )
    weight = np.array([8000, 7000, 100, 50])
    best = lexical.Best(50)
    read = lexical.search_slab(slab, np.arange(1, 5), weight, best)
    whole = np.zeros(n, np.int64)
    for k, own in enumerate(lists):
        whole[own] += weight[k] * values[starts[k] : starts[k + 1]]
    order = np.lexsort((np.arange(n), -whole))[:50]
    assert best.ids.tolist() == order.tolist() and best.scores.tolist() == whole[order].tolist()
    assert read < len(docs) / 5


def test_lengths_beyond_64_bits():
    row = type("Row", (), {})()
    row.terms, row.starts = np.array([1], "<u8").tobytes(), np.array([0, 2], "<u4").tobytes()
    row.docs, row.times = np.array([0, 1], "<u4").tobytes(), np.array([1, 5], "<u4").tobytes()
    row.ids, row.named, row.lengths = np.arange(2).astype("<i8").tobytes(), b"\1\1", np.array([10**12, 10], "<i8").tobytes()
    slab = lexical.Slab.unpacked(row, 10**10, 10**13)
    m = [50 + 50 * n * 10**10 // 10**13 for n in (10**12, 10)]
    assert slab.values.tolist() == [10**9 * tf // (1000 * tf + 20 * x) for tf, x in zip((1, 5), m, strict=True)]


def test_lexical_search_of_empty_tables(spark):
    docs, items = corpus(0)
    docs, items = texts_frame(spark, docs), spark.createDataFrame([(i, t, "", "", "") for i, t in items], ITEMS)
    assert lexical.ranked(docs.limit(0), items).count() == 0
    assert lexical.ranked(docs, items.limit(0)).count() == 0
