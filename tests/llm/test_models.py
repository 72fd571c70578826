"""Toxicity, quality and the pipeline: held-out accuracy, odd rows, and a brute-force version of the stages."""

import random
import re
import sys
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from ledgerloom.llm import labelled, quality, toxicity  # noqa: E402
from ledgerloom.llm.shared import table  # noqa: E402

SF_DIR = "/root/testdata/sf0.1"
SMALL = "/root/testdata/sf0.01"

ODD = [(1, None), (2, ""), (3, " \n "), (4, "word"), (4, "word"), (None, "no id"), (5, "long " * 20000), (6, "ß漢🙂\x00")]


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, SF_DIR, "documents")


@pytest.fixture(scope="module")
def labels(spark):
    return table(spark, SF_DIR, "labels")


def odd(spark):
    return spark.createDataFrame([(i, t, "s", 0.5, True) for i, t in ODD], "doc_id long, text string, score string, z double, keep boolean")


def test_folds_are_crc32_of_the_id_as_text(spark):
    rows = spark.range(-5, 50).select("id", labelled.fold("id").alias("f")).collect()
    assert all(r["f"] == zlib.crc32(str(r["id"]).encode()) % 5 for r in rows)


def test_toxicity_of_held_out_documents(docs, labels):
    found = toxicity.toxicity(docs, labels)
    assert found.count() == docs.count()
    rows = found.join(labels, "doc_id").where("held_out").select("toxic", "predicted", "score").collect()
    toxic = [r for r in rows if r["toxic"] == 1]
    clean = [r for r in rows if r["toxic"] == 0]
    assert sum(r["predicted"] for r in toxic) >= 0.88 * len(toxic)
    assert sum(r["predicted"] for r in clean) <= 0.02 * len(clean)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_toxicity_never_learns_from_held_out_labels(spark, docs, labels):
    small = docs.where("doc_id < 1500")
    flipped = labels.withColumn("toxic", F.when(labelled.fold() == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    first, second = (toxicity.toxicity(small, own).select("doc_id", "score").collect() for own in (labels, flipped))
    assert sorted(first) == sorted(second)


def test_odd_texts_have_scores(spark, docs, labels):
    learn = docs.where("doc_id < 400").select("doc_id", "text")
    model = toxicity.train(learn, labels)
    found = odd(spark).select("doc_id", toxicity.score_column(odd(spark), model).alias("p")).collect()
    assert len(found) == len(ODD) and all(0 <= r["p"] <= 1 for r in found)
    assert len({r["p"] for r in found if r["doc_id"] in (1, 2, 3)}) == 1
    found = toxicity.toxicity(odd(spark), labels.limit(0)).collect()
    assert [c["held_out"] for c in found if c["doc_id"] is None] == [False]
    assert toxicity.toxicity(odd(spark).limit(0), labels).count() == 0


def models_by_hand(docs, labels):
    """Mean evidence of each text (share, discount as in the module) from two models made of dictionaries."""
    grade = {}
    for i, toxic in labels:
        if i is not None and toxic is not None and zlib.crc32(str(i).encode()) % 5 in (2, 3, 4):
            grade[i] = max(grade.get(i, 0), toxic)

    def words(text):
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        return [w.encode() for w in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)]

    levels = (lambda w: w, lambda w: w[:5], lambda w: w[:4])
    held = [[Counter() for _ in levels] for _ in range(2)]
    for i, text in docs:
        if i in grade:
            for level, of in enumerate(levels):
                held[grade[i]][level].update({of(w) for w in words(text)})
    off = toxicity.DISCOUNT
    known = [{e for c in (0, 1) for e, n in held[c][level].items() if n > off} for level in range(3)]
    after = [defaultdict(set) for _ in levels]
    for _, text in docs:
        own = words(text)
        for before, word in zip([None, *own[:-1]], own):
            for level, of in enumerate(levels):
                after[level][of(word)].add(before)
    shared = sum(len(after[2][e]) for e in known[2])
    left = [
        sum(min(n, off) for c in (0, 1) for n in held[c][level].values()) / sum(sum(held[c][level].values()) for c in (0, 1))
        for level in range(3)
    ]

    def p(c, level, word):
        e = levels[level](word)
        own = max(held[c][level][e] - off, 0) / sum(held[c][level].values())
        if level == 2:
            return own + left[2] * len(after[2][e]) / shared
        above = levels[level + 1](word)
        return own + left[level] * len(after[level][e]) / len(after[level + 1][above]) * p(c, level + 1, word)

    def evidence(word):
        for level in range(3):
            if levels[level](word) in known[level]:
                return np.log(1 - toxicity.SHARE + toxicity.SHARE * p(1, level, word) / p(0, level, word))
        return 0.0

    return [float(np.mean([evidence(w) for w in words(text)] or [0.0])) for _, text in docs]


@pytest.mark.parametrize("pairs", [30, 2_000_000])
def test_both_models_equal_brute_force(spark, monkeypatch, pairs):
    """Exact counts of both classes and of all documents, however the work is cut; unlabelled documents count as well."""
    monkeypatch.setattr(toxicity, "PAIRS", pairs)
    rng = random.Random(4)
    stems = ["trash", "réeux", "ab", "x", "漢字", "common"]
    word = lambda bias: rng.choice(stems[bias:]) + rng.choice(["", "", "s", "ing", "ou", str(rng.randrange(30))])
    docs, labels = [], []
    for k in range(260):
        toxic = k % 3 == 0
        text = " ".join(rng.choice([str.upper, str])(word(0 if toxic else 1)) for _ in range(rng.randrange(1, 30)))
        docs.append((k, text))
        if k % 4:
            labels.append((k, int(toxic)))
    docs += [(300, None), (301, ""), (302, "?!"), (None, "trash ab"), (5, "second text of five"), (303, docs[7][1])]
    labels += [(7, 1), (None, 1), (9, None)]
    few = [d for d in docs if d[0] is None or d[0] % 2 or any(d[0] == i for i, _ in labels)]
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    seen = []
    for own in (docs, few):
        frame = spark.createDataFrame([(i, t, 1.5, "p") for i, t in own], "doc_id long, text string, score double, part string")
        model = toxicity.train(frame, marks)
        found = model.features(pa.array([t for _, t in own]))[:, 0]
        assert np.allclose(found, models_by_hand(own, labels), atol=2e-6)
        seen.append(dict(zip(own, found.tolist())))
    assert any(abs(seen[0][d] - seen[1][d]) > 1e-6 for d in few)


def test_the_size_of_the_models_is_bounded(spark, docs, labels):
    model = toxicity.train(docs.where("doc_id < 1500"), labels, known=50)
    assert [len(h) for h in model.hashes] == [50, 50, 50] and all(np.isfinite(e).all() for e in model.evidence)


def test_quality_of_held_out_documents(docs, labels):
    rows = quality.rated(docs, labels).join(labels, "doc_id").where("held_out").collect()
    poor = [r for r in rows if r["quality"] == 0]
    good = [r for r in rows if r["quality"] == 1]
    assert sum(not r["keep"] for r in poor) >= 0.97 * len(poor)
    assert sum(r["keep"] for r in good) >= 0.99 * len(good)
    assert all(0 <= r["p_good"] <= r["p_readable"] <= 1 for r in rows)
    assert np.mean([r["expected_grade"] for r in good]) > np.mean([r["expected_grade"] for r in poor]) + 0.5


def test_quality_of_odd_rows(spark, docs, labels):
    found = quality.rated(odd(spark), labels.limit(0)).collect()
    assert len(found) == len(ODD) and all(0 <= r["expected_grade"] <= 2 for r in found)
    assert quality.rated(odd(spark).limit(0), labels).count() == 0


def test_ratings_are_those_of_the_weights(docs, labels):
    """Every text's tails and expected grade, worked out word by word in plain Python."""
    model = quality.train(docs, labels)
    texts = {r["doc_id"]: r["text"] for r in docs.where("doc_id < 60").collect()}
    low, high = model.thresholds
    assert low < high
    for row in quality.rated(docs, labels).where("doc_id < 60").collect():
        cells, _ = quality.features(pa.array([texts[row["doc_id"]]]))
        sums = [sum(model.weights[c] for c in word) for word in cells.T.tolist()]
        z = sum(sums) / max(len(sums), 1)
        readable, good = (1 / (1 + np.exp(t - z)) for t in (low, high))
        assert np.allclose([row["p_readable"], row["p_good"], row["expected_grade"]], [readable, good, readable + good], atol=1e-6)
        assert row["keep"] == (row["p_readable"] >= 0.5)


def test_the_fit_beats_constant_grades(docs, labels):
    """The likelihood of held-out grades under the fit is above that of the best constant probabilities."""
    model = quality.train(docs, labels)
    rows = docs.join(labels, "doc_id").where(labelled.fold() == 0).select(quality.grades(labels).alias("grade"), "text").collect()
    rows = [r for r in rows if r["grade"] is not None]
    z = model.position(pa.array([r["text"] for r in rows]))
    grade = np.array([r["grade"] for r in rows])
    share = np.bincount(grade, minlength=3) / len(grade)
    constant = float(np.log(share[grade]).sum())
    assert quality._gradient(z, grade, model.thresholds)[2] > constant


def test_the_gradient_is_that_of_the_likelihood():
    rng = np.random.default_rng(0)
    z, grade, thresholds = rng.normal(size=9), rng.integers(0, 3, 9), np.array([-0.4, 0.7])
    by_z, by_t, _ = quality._gradient(z, grade, thresholds)
    step = 1e-6
    for k in range(9):
        more, less = z.copy(), z.copy()
        more[k] += step
        less[k] -= step
        slope = (quality._gradient(more, grade, thresholds)[2] - quality._gradient(less, grade, thresholds)[2]) / (2 * step)
        assert abs(slope - by_z[k]) < 1e-5
    for k in range(2):
        more, less = thresholds.copy(), thresholds.copy()
        more[k] += step
        less[k] -= step
        slope = (quality._gradient(z, grade, more)[2] - quality._gradient(z, grade, less)[2]) / (2 * step)
        assert abs(slope - by_t[k]) < 1e-5


# The pipeline.


def test_near_duplicate_stage_keeps_one_of_each_group(spark):
    rng = random.Random(1)
    base = [f"w{rng.randrange(500)}" for _ in range(60)]
    text = " ".join(base)
    near = " ".join([*base[:-2], "other", "end"])
    rows = [(5, text), (3, near), (9, text), (9, text), (7, "alone " + text[::-1]), (7, "alone " + text[::-1])]
    rows += [(1, None), (2, ""), (None, text)]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.near_duplicates(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "2", "3", "7", "None"]


TEXTS = "doc_id long, text string, lang string, source string, n_chars long"


def test_near_duplicates_are_decided_for_each_text(spark):
    base = [f"w{k * 7919 % 500}" for k in range(60)]
    text, near, other = " ".join(base), " ".join([*base[:-2], "other", "end"]), " ".join(reversed(base))
    rows = [(3, text), (3, near), (3, other), (4, None), (4, text), (None, text), (None, text), (None, near), (None, "alone here")]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], TEXTS)
    kept = [(r["doc_id"], r["text"]) for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()]
    assert sorted(i for i, _ in kept if i is not None) == [3, 3, 4]
    assert (3, other) in kept and (4, None) in kept and (None, "alone here") in kept
    assert sum(i is None for i, _ in kept) == 2


def test_decontamination_takes_texts_not_ids(spark, tmp_path):
    item = "how many apples does the old farmer sell each morning at the market when it rains"
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(None, f"so {item}"), (None, "clean text"), (None, None), (5, item), (5, "another text"), (6, "a third text")]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], TEXTS)
    kept = corpus_pipeline.benchmark_decontamination(spark, docs, str(tmp_path))
    assert sorted(str((r["doc_id"], r["text"])) for r in kept.collect()) == sorted(
        str(r) for r in rows if r[1] is None or item not in r[1]
    )


def test_the_pipeline_does_what_its_stages_decide(spark):
    """Each stage's rows against the operator's own verdicts and a plain rule over all rows."""
    docs = table(spark, SMALL, "documents")
    columns = docs.columns
    rows = {r["doc_id"]: r for r in docs.collect()}
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "quality classifier", "n-gram Jaccard join", "benchmark decontamination", "best-fit packing",
    ]
    labelled_rows = {r["doc_id"]: r for r in table(spark, SMALL, "labels").collect()}
    benchmark = [r["text"] for r in table(spark, SMALL, "benchmark").collect()]

    kept = corpus_pipeline.toxicity(spark, docs, SMALL)
    ids = {r["doc_id"] for r in kept.select("doc_id").collect()}
    clean = [i for i, r in labelled_rows.items() if r["toxic"] == 0]
    assert kept.columns == columns and sum(i in ids for i in clean) >= 0.97 * len(clean)

    readable = corpus_pipeline.quality_classifier(spark, docs, SMALL)
    ids = {r["doc_id"] for r in readable.select("doc_id").collect()}
    assert readable.columns == columns
    assert all((i in ids) == (r["quality"] == 1) for i, r in labelled_rows.items())

    clear = corpus_pipeline.benchmark_decontamination(spark, docs, SMALL)
    ids = {r["doc_id"] for r in clear.select("doc_id").collect()}
    assert clear.columns == columns
    assert ids == {i for i, r in rows.items() if not any(item in r["text"] for item in benchmark)}


def test_the_whole_pipeline(spark):
    found = corpus_pipeline.run(spark, SMALL).toPandas()
    assert 0 < found["doc_id"].nunique() < 1000
    assert (found.groupby("sequence_id")["length"].sum() <= 4096).all()
    pieces = found.sort_values(["doc_id", "piece"]).groupby("doc_id")
    assert (pieces["piece"].apply(list).map(lambda p: p == list(range(len(p))))).all()


CLASHES = ["copy", "gone", "own", "n", "stays", "Row_0", "row_1", "part", "unnamed", "first", "all", "grade", "class", "score", "words", "a.b"]


def clashing(spark, rows):
    schema = TEXTS + ", " + ", ".join(f"`{c}` string" for c in CLASHES)
    return spark.createDataFrame([(i, t, "en", "s", 0, *CLASHES) for i, t in rows], schema)


def test_stages_leave_extra_columns_and_odd_rows_alone(spark):
    base = [f"w{k * 7919 % 500}" for k in range(60)]
    rows = [*ODD, (10, " ".join(base)), (11, " ".join([*base[:-2], "other", "end"])), (12, " ".join(base)), (12, " ".join(base))]
    docs = clashing(spark, rows)
    judged = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, SMALL)
        assert kept.columns == docs.columns, name
        found = [(r["doc_id"], r["text"]) for r in kept.collect()]
        assert set(found) <= set(rows) and all(r["a.b"] == "a.b" and r["Row_0"] == "Row_0" for r in kept.collect())
        judged.append(found)
        if name != "n-gram Jaccard join":  # rows are judged by their texts
            gone = [t for _, t in rows if t not in {t for _, t in found}]
            assert sorted(found, key=str) == sorted(((i, t) for i, t in rows if t not in gone), key=str)
    near = judged[2]
    assert sorted(i for i, _ in near if i and i > 6) == [10] and [i for i, _ in near].count(4) == 1
    assert {(1, None), (2, ""), (3, " \n "), (None, "no id")} <= set(near)
    assert sorted(judged[3], key=str) == sorted(rows, key=str)
    packed = corpus_pipeline.best_fit_packing(spark, docs, SMALL)
    assert packed.where("piece = 0").count() == len(rows)


def test_stages_of_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = clashing(spark, ODD)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0, name
        assert stage(spark, docs.limit(0), SMALL).count() == 0, name
    assert corpus_pipeline.toxicity(spark, docs, str(tmp_path)).count() == len(ODD)
    assert corpus_pipeline.benchmark_decontamination(spark, docs, str(tmp_path)).count() == len(ODD)
