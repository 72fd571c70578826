"""Near duplicates, decontamination, packing and token counts on small cases."""

import random
import time
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import components, decontaminate, hashed_words, ngram_join, packing, shared, token_counts
from ledgerloom.llm.components import connected_components
from ledgerloom.llm.queries import tokenizer
from ledgerloom.llm.shared import scratch

DOCS = "doc_id long, text string, class string, piece string, words string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "c", "p", "w") for i, t in rows], DOCS)


# The numpy kernel.


def words_of(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    for c in "\t\n\x0b\x0c\r":
        lower = lower.replace(c, " ")
    return [w for w in lower.split(" ") if w]


@pytest.mark.parametrize("size", [8, 64, 1 << 20])
def test_word_hashes_tell_words_apart_whatever_the_slices(monkeypatch, size):
    monkeypatch.setattr(hashed_words, "SLICE_BYTES", size)
    rng = random.Random(5)
    signs = ["a", "B", "é", " ", "\n", "\x0b", "ab", "  ", "漢", "longerword", "\x1c", "\xa0"]
    texts = ["".join(rng.choices(signs, k=rng.randrange(40))) for _ in range(300)] + [None, "", " ", "x" * 5000]
    hashes, rows = hashed_words.word_hashes(pa.array(texts))
    names, seen = {}, {}
    for text, a, b in zip(texts, rows[:-1], rows[1:], strict=True):
        words = words_of(text or "")
        assert len(words) == b - a
        for word, h in zip(words, hashes[a:b].tolist(), strict=True):
            assert names.setdefault(h, word) == word and seen.setdefault(word, h) == h


# Near duplicates.


def sets_by_hand(rows, width=5):
    out = []
    for _, text in rows:
        w = words_of(text or "")
        out.append({tuple(w[k : k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} - {()})
    return out


def components_by_hand(rows):
    sets = sets_by_hand(rows)
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
            parent[find(a)] = find(b)
    least = defaultdict(list)
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)].append(i)
    return [
        (i, len(s), min(least[find(k)], default=None) if s else i) for k, ((i, _), s) in enumerate(zip(rows, sets, strict=True))
    ]


def near_copies(rng, words, n, edits):
    for _ in range(n):
        own = list(words)
        for _ in range(rng.randrange(edits + 1)):
            own[rng.randrange(len(own))] = f"w{rng.randrange(10**6)}"
        yield " ".join(own)


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(3000)}"
    passage = [word() for _ in range(40)]
    texts = [" ".join(word() for _ in range(rng.randrange(1, 120))) for _ in range(60)]
    texts += [" ".join([*passage, *(word() for _ in range(rng.randrange(25)))]) for _ in range(60)]
    texts += list(near_copies(rng, [word() for _ in range(90)], 60, 6))
    texts += list(near_copies(rng, [word() for _ in range(150)], 40, 9))
    texts += [texts[0].upper(), texts[0].replace(" ", "\n\t"), "one two", "ONE  two", "", None, " \n", "a a a a a a a a a", "a a a a a"]
    texts += [texts[70]] * 5
    rng.shuffle(texts)
    return [(3 * k + 1, t) for k, t in enumerate(texts)]


@pytest.mark.parametrize("blocks", [1024, 16])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(ngram_join, "BLOCK_SETS", blocks)
    monkeypatch.setattr(ngram_join, "PACKED", 2000)
    monkeypatch.setattr(ngram_join, "COMMON", 4 if blocks == 16 else 64)
    rows = [*corpus(blocks), (1, "w1 w2 w3 w4 w5 w6"), (None, "w1 w2 w3 w4 w5 w6"), (None, "alone with no id at all")]
    found = ngram_join.near_duplicates(frame(spark, rows)).select("doc_id", "n_shingles", "component_id")
    assert sorted(map(tuple, found.collect()), key=str) == sorted(components_by_hand(rows), key=str)


def families(seed, groups, each):
    """Near copies of each two passages that follow each other: one chain of groups that are not similar to one another."""
    rng = random.Random(seed)
    passages = [[f"w{rng.randrange(10**6)}" for _ in range(rng.choice([30, 40, 60]))] for _ in range(groups + 1)]
    texts = [
        text
        for a, b in zip(passages[:-1], passages[1:], strict=True)
        for text in near_copies(rng, [*a, *b], each, 1)
    ]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize(("by_ngram", "few"), [(True, 0), (False, 500_000)])
def test_groups_without_a_dominant_part(spark, monkeypatch, by_ngram, few):
    """Dealt again by n-gram and length, or block by block; keys sent whole, or heavy ones apart."""
    monkeypatch.setattr(ngram_join, "BLOCK_SETS", 8)
    monkeypatch.setattr(shared, "BROADCAST_ROWS", few)
    ways, seen = ngram_join._dear_ways, []

    def forced(*args):
        found = ways(*args).withColumn("by_ngram", F.lit(by_ngram))
        seen.append(found.count())
        return found

    monkeypatch.setattr(ngram_join, "_dear_ways", forced)
    rows = families(few, 30, 6)
    found = ngram_join.near_duplicates(frame(spark, rows)).select("doc_id", "n_shingles", "component_id")
    assert sorted(map(tuple, found.collect())) == sorted(components_by_hand(rows))
    assert seen and seen[0] > 0


def test_common_ngrams_are_not_sent_to_one_owner(spark, monkeypatch):
    """One line in all texts: its owner's range holds as much as any other's, and the sets are whole."""
    monkeypatch.setattr(ngram_join, "PACKED", 3000)
    monkeypatch.setattr(ngram_join, "COMMON", 8)
    line = "this line stands in every single one of the texts"
    rng = random.Random(0)
    rows = [(k, line + " " + " ".join(f"w{rng.randrange(10**6)}" for _ in range(6))) for k in range(2000)]
    found = ngram_join.shared_ngrams(frame(spark, rows)).toPandas()
    common = found[found["df"] >= ngram_join.MANY]
    own = sets_by_hand(rows)
    shared = {g for g, n in Counter(g for s in own for g in s).items() if n > 100}
    assert len(common.drop_duplicates(["class", "ngram"])) == sum(len(s & shared) for s in own)
    assert common["ngram"].nunique() == len(shared) == 6
    held = ngram_join.shared_ngrams(frame(spark, rows)).groupBy(F.spark_partition_id()).count().toPandas()["count"]
    assert held.max() < 3 * held.median()


def test_near_duplicates_of_nothing(spark):
    assert ngram_join.near_duplicates(frame(spark, [])).count() == 0
    assert [tuple(r)[1:2] for r in ngram_join.near_duplicates(frame(spark, [(1, None)])).collect()] == [(0,)]


@pytest.mark.parametrize("seed", range(6))
def test_the_trie_connects_what_is_similar(seed):
    rng = np.random.default_rng(seed)
    base = [rng.choice(400, 60, replace=False) for _ in range(4)]
    sets = []
    for _ in range(80):
        own = base[rng.integers(4)].copy()
        own[rng.integers(0, 60, rng.integers(0, 14))] = rng.integers(0, 400)
        sets.append(np.unique(own).astype(np.int64))
    sizes = np.array([len(s) + rng.integers(0, 3) for s in sets])
    links = ngram_join.trie_links(np.arange(80), sizes, sets)

    def groups(edges):
        label = np.arange(80)
        for a, b in edges:
            label[label == label[a]] = label[b]
        return [tuple(np.flatnonzero(label == k)) for k in np.unique(label)]

    similar = []
    for a, b in combinations(range(80), 2):
        both = len(np.intersect1d(sets[a], sets[b]))
        if 100 * both >= 75 * (sizes[a] + sizes[b] - both):
            similar.append((a, b))
    assert sorted(groups(links)) == sorted(groups(similar))
    assert len(links) < 80


def test_components_of_a_long_path(spark):
    links = spark.range(200).selectExpr("(id * 7919) % 1000003 AS a", "((id + 1) * 7919) % 1000003 AS b")
    with scratch(spark, "path") as work:
        found = connected_components(links, work).collect()
    nodes = {k * 7919 % 1000003 for k in range(201)}
    assert {r["node"] for r in found} == nodes
    assert {r["component"] for r in found} == {min(nodes)}


def test_components_of_stars_beyond_the_limit_of_edges(spark, monkeypatch):
    """The centre's edges are joined apart from the merged ones; the components are the same."""
    monkeypatch.setattr(components, "HUB", 100)
    star = spark.range(1, 20_001).selectExpr("0L AS a", "id AS b")
    chains = spark.range(100_000, 101_000).where("id % 10 != 9").selectExpr("id AS a", "id + 1 AS b")
    with scratch(spark, "hub") as work:
        found = {r["node"]: r["component"] for r in connected_components(star.union(chains), work).collect()}
    assert found == {k: 0 for k in range(20_001)} | {k: k - k % 10 for k in range(100_000, 101_000)}


# Decontamination.

ITEM = "If Anna buys 3 apples at 2.50 euros and Anna sells 3 apples for 4 euros each hour, how much does she earn in all"
RENAMED = ITEM.replace("Anna", "Bertha").replace("3 ", "17 ").replace("2.50", "9").replace(" 4 ", " 6 ").replace("apples", "apples")
MIXED = ITEM.replace("sells 3", "sells 8")
BENCHMARK = "item_id long, text string, doc_id string, copy string"


def test_templates_find_copies_and_other_values(spark):
    noise = " ".join(f"word{k}" for k in range(60))
    rows = [(1, f"{noise}. {ITEM}? {noise}"), (2, f"{noise}\n{RENAMED} {noise}"), (3, f"{noise} {MIXED} {noise}")]
    rows += [(4, noise), (5, None), (6, ""), (7, " ".join(ITEM.split()[:9])), (None, ITEM), (8, ITEM), (8, ITEM)]
    rows += [(9, f"{noise} " * 300 + ITEM.upper()), (10, f"{ITEM} {ITEM}")]
    items = spark.createDataFrame(
        [(1, ITEM, "x", "y"), (1, ITEM, "x", "y"), (2, "too short to match", "x", "y"), (3, None, "x", "y")], BENCHMARK
    )
    found = decontaminate.contaminated(frame(spark, rows), items).collect()
    assert sorted((str(r["doc_id"]), r["item_id"]) for r in found if r["doc_id"] != 9) == sorted(
        [("1", 1), ("2", 1), ("None", 1), ("8", 1), ("10", 1)]
    )
    changed = {r["doc_id"]: r["changed_slots"] for r in found}
    assert changed[1] == 0 and changed[2] >= 5
    assert next(r["first_word"] for r in found if r["doc_id"] == 1) in (60, 61)
    empty = frame(spark, [])
    assert decontaminate.contaminated(empty, items).count() == 0
    assert decontaminate.contaminated(frame(spark, rows), items.limit(0)).count() == 0


def found_items(spark, docs, items):
    listed = spark.createDataFrame([(k, t, "x", "y") for k, t in items.items()], BENCHMARK)
    rows = decontaminate.contaminated(frame(spark, list(docs.items())), listed).collect()
    return {(r["doc_id"], r["item_id"]): r for r in rows}


def test_short_items_and_items_of_placeholders_are_found_whole(spark):
    chain = " plus ".join(str(k) for k in range(17))
    cities = "Visit " + ", ".join(f"City{chr(97 + k)}" for k in range(21))
    items = {1: "What is the capital of France?", 2: chain, 3: cities, 4: "..."}
    docs = {1: f"so what is the Capital of France, he asked. {chain}", 2: f"word word {cities} word", 3: "What is the capital of Spain?"}
    docs |= {4: chain.replace("16", "17"), 5: None, 6: ""}
    found = found_items(spark, docs, items)
    assert sorted(found) == [(1, 1), (1, 2), (2, 3)]
    assert found[1, 1]["first_word"] == 1 and found[1, 1]["n_words"] == 6
    assert found[1, 2]["first_word"] == 9 and found[1, 2]["n_slots"] == 17


def test_values_that_meet_in_one_value_and_long_copies_with_an_edited_value(spark):
    merged = ITEM.replace("2.50", "5").replace(" 4 ", " 5 ")
    long = f"{ITEM} when the market stays open from early morning until late and nobody else sells fruit there that day"
    items = {1: ITEM, 2: long}
    found = found_items(spark, {1: merged, 2: long.replace("sells 3", "sells 8"), 3: MIXED}, items)
    assert (1, 1) in found and (2, 2) in found and not any(doc == 3 for doc, _ in found)


TOM = "Tom has 2 apples and buys 2 more at the market before he gives 7 pears to his old friend who lives there"


def test_equal_numbers_before_different_words_may_part(spark):
    """A name or a number before the same word is one thing; equal numbers elsewhere are not."""
    names = "So Mary met Paul near the old bridge and then Mary told Paul where Mary and Paul would meet again one day"
    docs = {1: TOM.replace("has 2", "has 3").replace("buys 2", "buys 5").replace("7", "9"), 2: TOM.replace("buys 2", "buys 5")}
    docs |= {3: names.replace("Mary", "Lena").replace("Paul", "Otto"), 4: names.replace("Mary told Paul", "Lena told Otto"), 5: MIXED}
    docs |= {6: names.replace("where Mary", "where Lena")}  # one place of six
    found = found_items(spark, docs, {1: TOM, 2: names, 3: ITEM})
    assert {(1, 1), (2, 1), (3, 2), (6, 2)} <= set(found) and not any(doc in (4, 5) for doc, _ in found)


def agree_by_hand(slots):
    """Slots (kind, item's value, document's value, word after)."""
    thing = [(x, after) if "<num>" in kind else (x,) for kind, x, _, after in slots]
    good = whole = 0.0
    for k, (kind, _, y, _) in enumerate(slots):
        weight = 0.5 if kind == "<unit>" else 1.0
        alike = [slots[j][2] for j in range(len(slots)) if thing[j] == thing[k]]
        whole += weight
        good += weight * (2 * alike.count(y) > len(alike))
    return good >= 0.8 * whole


def test_slots_equal_brute_force(spark):
    """Random places of one template: kept exactly where the values go together by a plain count."""
    rng = random.Random(9)
    item = (
        "if <name> the old man sells <num> pears to them each day and <name> buys <num> pears that they like then walks"
        " <num> <unit> home how far are they now from <name>"
    )
    words = item.split()
    kinds = [(k, w) for k, w in enumerate(words) if w.startswith("<")]
    rows, expected = [], set()
    for doc in range(150):
        own, other = list(words), list(words)
        slots = []
        for k, kind in kinds:
            pool = {"<name>": ["Anna", "Otto"], "<num>": ["2", "3"], "<unit>": ["km"]}[kind]
            own[k] = pool[doc % 2 if kind == "<name>" else rng.randrange(len(pool)) if kind == "<num>" else 0]
            other[k] = own[k] if rng.random() < 0.7 else {"<name>": "Lena", "<num>": "8", "<unit>": "miles"}[kind]
            slots.append((kind, own[k].lower(), other[k].lower(), words[k + 1] if k + 1 < len(words) else ""))
        rows.append((doc, " ".join(own), " ".join(other)))
        same = [a == b for a, b in zip(own, other)]
        run = max(map(len, "".join("x" if s else " " for s in same).split(" ")))
        if agree_by_hand(slots) or run >= decontaminate.VERBATIM:
            expected.add(doc)
    found = set()
    items = {doc: own for doc, own, _ in rows}
    texts = {doc: other for doc, _, other in rows}
    for doc, item_id in found_items(spark, texts, items):
        if doc == item_id:
            found.add(doc)
    assert 20 < len(expected) < 140
    assert found == expected


def test_edited_copies_of_the_given_items_are_found(spark):
    """Every given item of slots or long enough, in a text, with other names and numbers."""
    given = {r["item_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.1/benchmark.parquet").collect()}
    rng = random.Random(3)

    def edited(text):
        names = {}
        words = text.split(" ")
        for k in range(1, len(words)):
            bare = words[k].strip(".,;:!?")
            if bare[:1].isupper() and words[k - 1][-1:].islower():
                words[k] = words[k].replace(bare, names.setdefault(bare, f"Name{chr(97 + len(names))}"))
            if bare.isdigit():
                words[k] = words[k].replace(bare, str(rng.randrange(1000)))
        return " ".join(words)

    noise = " ".join(f"word{k}" for k in range(30))
    docs = {i: f"{noise} {edited(t)} {noise}" for i, t in given.items()}
    found = found_items(spark, docs, given)
    caught = sum((i, i) in found for i in given)
    assert caught >= 0.98 * len(given)


def test_copies_are_found_whatever_their_case_and_punctuation(spark):
    item = "Every day Mary and Paul carry water. Then Susan pours it into the tank. How many days pass until Mary is done with 20 buckets?"
    bare = "".join(c for c in item if c not in ".,?")
    docs = {1: item.upper(), 2: bare, 3: item.lower(), 4: item.replace("Mary", "Lena").replace("20", "70"), 5: item.upper().replace("20", "31")}
    # Of few words each between its names, so that one template lacks them where the other has them.
    other = "Then Mary told Paul that Susan saw Peter near Berlin while Anna met Carl before Emma left Rome with Otto"
    docs |= {6: other.upper(), 7: other}
    found = found_items(spark, docs, {1: item, 2: other})
    assert sorted(found) == [*((k, 1) for k in range(1, 6)), (6, 2), (7, 2)]


def test_a_template_has_a_word_for_each_word(spark):
    texts = ["He met Mary Ann in 5 km , - 3kg", " a\t\nb  ", "", "...", "x 12:30 Uhr, Ort", "é  É 7%"]
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    for r in rows.select("text", decontaminate.template(F.col("text")).alias("t"), decontaminate._words(F.col("text")).alias("w")).collect():
        assert len(r["t"]) == len(r["w"])
    first = rows.select(decontaminate.template(F.col("text")).alias("t")).first()["t"]
    assert first == ["he", "met", "<name>", "<name>", "in", "<num>", "<unit>", "-", "<num><unit>"]


# Packing.


def test_packing_places_every_token_once(spark):
    from tokenizers import Tokenizer

    path = tokenizer("word_bpe_49k.json")
    whole = Tokenizer.from_file(path)
    rng = random.Random(2)
    texts = [" ".join(rng.choices(["Hello", "it's", "naïve", "12", "...", "Wörter", "zzzyq"], k=rng.randrange(200))) for _ in range(80)]
    texts += ["", None, "x <|endoftext|> <|EndOfText|>", "漢字 İstanbul ﬁ", "a\x1cb\x85c\xa0d", "word " * 3000, texts[0]]
    rows = [(k, t) for k, t in enumerate(texts)] + [(0, texts[0]), (None, "no id")]
    found = packing.packed_documents(frame(spark, rows), path, capacity=256).toPandas()
    expected = defaultdict(int)
    for i, text in rows:
        ids = [*whole.encode(text or "", add_special_tokens=False).ids, 1]
        for k, at in enumerate(range(0, len(ids), 256)):
            own = np.array(ids[at : at + 256], "<u4").tobytes()
            expected[str(i), k, at, len(own) // 4, zlib.crc32(own)] += 1
    got = defaultdict(int)
    for r in found.itertuples():
        got["None" if r.doc_id != r.doc_id else str(int(r.doc_id)), r.piece, r.start, r.length, r.ids_crc32] += 1
    assert got == expected
    for _, own in found.sort_values("offset").groupby("sequence_id"):
        assert own["offset"].tolist() == [0, *own["length"].cumsum().tolist()[:-1]]
        assert own["length"].sum() <= 256
    ideal = -(-found["length"].sum() // 256)
    assert found["sequence_id"].nunique() <= ideal + 2
    assert packing.packed_documents(frame(spark, []), path).count() == 0


def test_sequences_hold_the_ids_of_their_pieces(spark):
    path = tokenizer("word_bpe_49k.json")
    rows = [(k, "some words here " * (k + 1)) for k in range(30)]
    placed = packing.pack(packing.pieces(frame(spark, rows), path, capacity=64, with_ids=True), capacity=64)
    for r in packing.sequences(placed).collect():
        assert len(r["ids"]) <= 64 and r["ids"][-1] == 1 or len(r["ids"]) == 64


@pytest.mark.parametrize("seed", range(5))
def test_sum_of_squares_fills_bins(seed):
    rng = np.random.default_rng(seed)
    lengths = np.concatenate((rng.integers(1, 101, 2000), np.full(20, 100), rng.integers(1, 5, 500)))
    bins, offsets = packing.sum_of_squares(lengths, 100)
    load = np.bincount(bins, weights=lengths)
    assert load.max() <= 100
    assert len(load) <= 1.01 * lengths.sum() / 100 + 2
    for b in range(len(load)):
        own = np.argsort(offsets[bins == b])
        assert (offsets[bins == b][own] == np.concatenate(([0], np.cumsum(lengths[bins == b][own])[:-1]))).all()


def squares(gaps):
    return sum(n * n for n in Counter(g for g in gaps if g).values())


def placed_by_hand(lengths, capacity, new_too=False):
    """Each length's gap before it and the bins in the end, by trying every open bin."""
    gaps, out = [], {}
    for at in sorted(range(len(lengths)), key=lambda k: -lengths[k]):
        size = lengths[at]
        tries = [(squares([*gaps[:b], gap - size, *gaps[b + 1 :]]), gap) for b, gap in enumerate(gaps) if gap >= size]
        if new_too or not tries:
            tries.append((squares([*gaps, capacity - size]), capacity))
        gap = out[at] = min(tries)[1]
        if gap == capacity and (new_too or gap not in gaps):
            gaps.append(capacity - size)
        else:
            gaps[gaps.index(gap)] -= size
    return out, len(gaps)


@pytest.mark.parametrize("seed", range(12))
def test_every_piece_goes_where_the_sum_of_squares_is_least(seed):
    rng = np.random.default_rng(seed)
    capacity = int(rng.integers(5, 60))
    lengths = rng.integers(1, capacity + 1, 90)
    bins, offsets = packing.sum_of_squares(lengths, capacity)
    expected, n = placed_by_hand(lengths.tolist(), capacity)
    assert [capacity - o for o in offsets.tolist()] == [expected[k] for k in range(len(lengths))]
    assert bins.max() + 1 == n <= placed_by_hand(lengths.tolist(), capacity, new_too=True)[1]


# Token counts.

ODD = [
    "", None, "  ", "it's 'tis ''s !'s ÀÉ ² \x1c\x1d a\x85b\xa0c", "naïve café İstanbul ﬁ <|endoftext|> x",
    "ЖЖ 漢字 é 12 ٣٤   a", "'S 'LL 12 3½ ÿ×÷ªº", "a_b-c__d\t\n\x0b\x0c", "<|endoftext|><|endoftext|>",
    " <|endoftext|> \n\n a  b   c\n", "we're don't I'll x'漢", "a" * 3000, "!?=" * 700, " " * 900, "ab cd \n" * 400,
]


@pytest.mark.parametrize("chunk", [3, 100, 1 << 16])
def test_token_counts_equal_the_library(spark, chunk):
    from tokenizers import Tokenizer

    path = tokenizer("byte_bpe_50k.json")
    whole = Tokenizer.from_file(path)
    texts = ODD if chunk > 3 else [t for t in ODD if t is None or len(t) < 80]
    rows = [*enumerate(texts), (0, "again"), (None, "no id")]
    found = token_counts.token_counts(frame(spark, rows), path, chunk=chunk).collect()
    expected = []
    for i, text in rows:
        n = len(whole.encode(text or "", add_special_tokens=False).ids)
        expected.append((i, len((text or "").encode()), n, n > 512))
    assert sorted(map(tuple, found), key=str) == sorted(expected, key=str)
    assert token_counts.token_counts(frame(spark, []), path).count() == 0


def test_the_transducer_counts_what_the_merges_give():
    machine = token_counts.scanner(tokenizer("byte_bpe_50k.json")).transducer
    rng = random.Random(7)
    for _ in range(3000):
        piece = "".join(rng.choices(["th", "e", "ing", " ", "x", "é", "1", "ou", "!", "Q"], k=rng.randrange(1, 9))).encode()
        assert machine.count(piece) == len(machine.merge(piece))


@pytest.mark.parametrize("states", [5, 40, 200_000])
def test_states_can_be_forgotten_within_a_piece(monkeypatch, states):
    monkeypatch.setattr(token_counts, "STATES", states)
    monkeypatch.setattr(token_counts, "AGREE", 10 * states)
    machine = token_counts.Transducer(tokenizer("byte_bpe_50k.json"))
    rng = random.Random(8)
    for _ in range(300):
        piece = "".join(rng.choices(["th", "e", "ing", " ", "x", "é", "1", "ou", "!", "aa", "--", "漢"], k=rng.randrange(1, 60))).encode()
        assert machine.count(piece) == len(machine.merge(piece))
        assert len(machine.states) <= states + 3


def test_a_word_of_a_million_letters():
    """Few states, exact, and no slower than the library."""
    from tokenizers import Tokenizer

    path = tokenizer("byte_bpe_50k.json")
    whole = Tokenizer.from_file(path)
    machine = token_counts.Transducer(path)
    rng = random.Random(1)
    for word, most in (("a" * 1_000_000, 20), ("abcab" * 200_000, 50), ("".join(rng.choices("abcdefghij", k=100_000)), token_counts.STATES)):
        before = len(machine.states)
        assert machine.count(word.encode()) == len(whole.encode(word, add_special_tokens=False).ids)
        assert len(machine.states) - before <= most
    assert len(machine.states) < 100_000
    scanner = token_counts.scanner(path)
    begin = time.perf_counter()
    own = scanner.count("a" * 1_000_000)
    middle = time.perf_counter()
    assert own == len(whole.encode("a" * 1_000_000, add_special_tokens=False).ids)
    assert middle - begin < 2 * (time.perf_counter() - middle) + 1
