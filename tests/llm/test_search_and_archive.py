"""Top-k search, WARC archive, chat formatting and URL filter on small cases."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import chat, topk, url_filter, warc

EMBEDDINGS = "vec_id long, embedding array<float>, score string, rank string"


def brute_top(rows, k):
    whole = [
        (i, [int(np.floor(1024 * float(np.float32(x)))) for x in v])
        for i, v in rows
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    out = []
    for own, (q, a) in enumerate(whole):
        if q % 100 == 0:
            scores = sorted((-sum(x * y for x, y in zip(a, v)), i) for at, (i, v) in enumerate(whole) if at != own and len(v) == len(a))
            out += [(q, r, i, -s) for r, (s, i) in enumerate(scores[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("block", [7, 4096])
def test_top_k_equals_brute_force_with_ties_copies_and_bad_vectors(spark, block):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(0, 0.2, 6).astype(np.float32).tolist()) for i in range(250)]
    rows += [(i, [0.5] * 6) for i in range(300, 345)]  # copies: more than k, one of them a query
    rows += [(400, [0.0] * 6), (500, None), (600, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (700, [float("nan")] * 6)]
    rows += [(800, [float("inf")] * 6), (None, [0.1] * 6), (900, [0.25, -0.5]), (901, [0.5, 0.5]), (1000, [])]
    # Rows with one vec_id are rows of their own: equal ones, other ones, queries.
    rows += [(0, rows[0][1]), (0, rows[9][1]), (1, rows[1][1]), (1, rows[8][1]), (2, [0.4] * 6)]
    frame = spark.createDataFrame([(i, v, "x", "y") for i, v in rows], EMBEDDINGS)
    found = topk.top_k(frame, F.col("vec_id") % 100 == 0, block=block, query_block=block)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, found.collect())) == brute_top(rows, topk.K)


def test_few_rows_with_one_id(spark):
    rows = [(i, [float(i + k), 1.0]) for k, i in enumerate((0, 1, 1, 2, 2))]
    frame = spark.createDataFrame([(i, v, "x", "y") for i, v in rows], EMBEDDINGS)
    found = topk.top_k(frame, F.col("vec_id") % 100 == 0).collect()
    assert sorted(map(tuple, found)) == brute_top(rows, topk.K) and len(found) == 4


@pytest.mark.parametrize("n", [500, 4000])
def test_bounds_leave_few_pairs_to_score(spark, n):
    rng = np.random.default_rng(n)
    rows = [(i, (v / np.linalg.norm(v)).astype(np.float32).tolist()) for i, v in enumerate(rng.normal(0, 1, (n, 32)))]
    frame = spark.createDataFrame([(i, v, "x", "y") for i, v in rows], EMBEDDINGS)
    seen = {}
    found = topk.top_k(frame, F.col("vec_id") % 100 == 0, seen=seen)
    assert found.count() == 10 * (n // 100)
    assert seen["scored"] < 0.35 * seen["given"] and seen["scored"] < 12 * found.count(), seen


def test_top_k_whatever_the_order_of_a_block_in_each_list(spark, monkeypatch):
    """Lists of a block are gathered apart, so shuffled blocks arrive in another order for each."""
    plain = topk._blocks

    def reordered(rows, id_, scratch, block):
        found, n = plain(rows, id_, scratch, block)
        out = []
        for r in found.collect():
            order = sorted(range(len(r["ids"])), key=lambda k: r["ids"][k], reverse=r["list"] == 1)
            width = len(r["parts"]) // len(order)
            parts = [x for k in order for x in r["parts"][k * width : (k + 1) * width]]
            out.append((r["block"], r["dims"], r["list"], [r["ids"][k] for k in order], parts))
        return spark.createDataFrame(out, found.schema), n

    monkeypatch.setattr(topk, "_blocks", reordered)
    rng = np.random.default_rng(4)
    # Vectors of very different length, so that cutoffs differ from query to query.
    rows = [(i * 20, (rng.normal(0, 1, 8) * 10 ** rng.uniform(-1, 1)).astype(np.float32).tolist()) for i in range(200)]
    frame = spark.createDataFrame([(i, v, "x", "y") for i, v in rows], EMBEDDINGS)
    found = topk.top_k(frame, F.col("vec_id") % 100 == 0)
    assert sorted(map(tuple, found.collect())) == brute_top(rows, topk.K)


def test_top_k_of_an_empty_table(spark):
    assert topk.top_k(spark.createDataFrame([], EMBEDDINGS), F.col("vec_id") % 100 == 0).count() == 0


PAGES = "page_id long, url string, html string, header string, digest string"


def test_warc_keeps_each_payload_once_and_restores_records(spark, tmp_path):
    big, other, clash = "é" * 600, "x" * 5000 + "\r\n\r\nWARC/1.1\r\n", "y" * 999
    pages = [(1, "u1", big), (2, "u2", big), (3, "u3", other), (4, None, None), (5, "a\r\nWARC-Type: x", clash)]
    pages += [(6, "u6", clash), (9, "u9", big), (9, "u9", big), (None, "n", big), (8, "u8", "")]
    frame = spark.createDataFrame([(*p, "h", "d") for p in pages], PAGES)
    archive = warc.write_archive(frame)
    assert archive.payloads.count() == len({p[2] or "" for p in pages})
    found = sorted(map(tuple, warc.read_archive(archive).collect()), key=str)
    expected = []
    for page, _, html in pages:
        data = (html or "").encode()
        keeper = max((p[0] for p in pages if p[0] is not None and (p[2] or "") == (html or "")), default=None)
        revisit = len(data) >= 1000 and page != keeper
        expected.append(
            (page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", keeper if revisit else None)
        )
    assert found == sorted(expected, key=str)
    for row in archive.restore().collect():
        length = int(row["header"].split("Content-Length: ")[1].split("\r\n")[0])
        http = row["header"].split("\r\n\r\n", 1)[1]
        body = 0 if "WARC-Type: revisit" in row["header"] else len(row["payload"])
        assert length == len(http.encode()) + body
        assert row["header"].count("\r\nWARC-Type: ") == 1

    folder = str(tmp_path / "files")
    warc.write_warc(archive, folder)
    text = b"".join(p.read_bytes() for p in sorted((tmp_path / "files").glob("part-*")))
    records, at = 0, 0
    while at < len(text):  # by Content-Length alone
        head = text.index(b"\r\n\r\n", at) + 4
        length = int(text[at:head].rsplit(b"Content-Length: ", 1)[1].split(b"\r\n")[0])
        assert text[head + length : head + length + 4] == b"\r\n\r\n"
        at, records = head + length + 4, records + 1
    assert records == len(pages)


def test_a_damaged_payload_ends_the_job(spark):
    archive = warc.write_archive(spark.createDataFrame([(1, "u", "good", "", "")], PAGES))
    broken = spark.createDataFrame([(bytearray(archive.payloads.first()["digest"]), bytearray(b"bad"))], "digest binary, payload binary")
    broken.write.mode("overwrite").parquet(f"{archive.folder}/payloads")
    with pytest.raises(Exception, match="payload missing or damaged"):
        warc.read_archive(archive).collect()


def test_an_empty_archive(spark):
    assert warc.read_archive(warc.write_archive(spark.createDataFrame([], PAGES))).count() == 0


CONVERSATIONS = "conv_id long, turn long, role string, text string, part string, formatted string"


def read_by_hand(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        turns = sorted(
            ((r[1] is not None, r[1] or 0, r[2] or "", r[3] or "") for r in rows if r[0] == conv)
        )
        loss = "".join(t for _, _, role, t in turns if role == "assistant")
        every = "".join(f"{role}\n{text}\n" for _, _, role, text in turns)
        out[conv] = (
            len(turns),
            hashlib.sha256(every.encode()).hexdigest(),
            len(loss),
            hashlib.sha256(loss.encode()).hexdigest(),
        )
    return out


@pytest.mark.parametrize("part", [40, 1 << 20])
def test_chat_reads_back_what_was_written(spark, part):
    clash = r"\### Assistant: </turn> ok"
    rows = [(-7, 0, "user", clash), (-7, 1, "assistant", clash), (1, 0, None, None), (1, 0, "assistant", "")]
    rows += [(2, None, "user", "\n</turn>\n### user:\n"), (2, 3, "assistant", "\\" * 5 + "### "), (2, 3, "assistant", "\\")]
    rows += [(None, 1, "us\ner\\:", "</turn"), (None, 2, "assistant", "ü🙂" * 300), (3, 1, "assistant", "same"), (3, 1, "assistant", "same")]
    rows += [(4, k, "assistant" if k % 2 else "user", "long " * 50) for k in range(120)]
    frame = spark.createDataFrame([(*r, "p", "f") for r in rows], CONVERSATIONS)
    written = chat.format_conversations(frame, part)
    found = {r["conv_id"]: tuple(r)[1:5] for r in chat.read_back(written).collect()}
    assert found == read_by_hand(rows)
    assert written.count() == len(found) if part > 1000 else written.count() > len(found)
    assert chat.formatted_conversations(frame.limit(0)).count() == 0


def test_the_loss_mask_covers_bodies_alone(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "a ### b"), (1, 2, "assistant", "c")]
    row = chat.format_conversations(spark.createDataFrame([(*r, "", "") for r in rows], CONVERSATIONS)).first()
    assert [row["formatted"][s["begin"] : s["stop"]] for s in row["spans"]] == [r"a \### b", "c"]


RULES = [("com", "/", "allow"), ("Example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/es/", "allow")]


def test_rules_with_paths_of_many_lengths(spark):
    rules = spark.createDataFrame([("a.org", "/" + "x" * n, "block") for n in range(1100)] + [("org", "", "allow")], "host string, path string, verdict string")
    urls = ["http://a.org/" + "x" * 700 + "/y", "http://b.a.org/z", "http://c.org", "http://c.net/xx"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    found = {r["page_id"]: (r["rule"], r["verdict"]) for r in url_filter.judged(pages, rules).collect()}
    assert found == {0: ("a.org/" + "x" * 700, "block"), 1: ("a.org/", "block"), 2: ("org", "allow"), 3: (None, "allow")}


def test_urls(spark):
    urls = {
        "http://a.EXAMPLE.com/en/x?y": ("a.example.com", "/en/x", "example.com/en/", "block"),
        "http://www.example.com/en/": ("www.example.com", "/en/", "www.example.com/en/", "allow"),
        "https://x.www.example.com/en/#/a": ("x.www.example.com", "/en/", "www.example.com/en/", "allow"),
        "http://notexample.com/en/": ("notexample.com", "/en/", "com/", "allow"),
        "http://example.com": ("example.com", "", None, "allow"),
        "ftp://b.net/es/": ("b.net", "/es/", "net/es/", "block"),
        "ftp://b.net/es": ("b.net", "/es", None, "allow"),
        "x://h?q=/es/://": ("h", "", None, "allow"),
        "no scheme.net/es/": ("", "", None, "allow"),
        "": ("", "", None, "allow"),
        "://": ("", "", None, "allow"),
        "a://.net/es/ü": (".net", "/es/ü", "net/es/", "block"),
        "a://" + "s." * 200 + "net/es/" + "p" * 5000: ("s." * 200 + "net", "/es/" + "p" * 5000, "net/es/", "block"),
        None: ("", "", None, "allow"),
    }
    rows = [(k, u, "h", "v") for k, u in enumerate(urls)] * 2 + [(None, "http://b.net/es/", "h", "v")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, verdict string")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    found = sorted(map(tuple, url_filter.judged(pages, rules).collect()), key=str)
    expected = [(k, *v) for k, v in enumerate(urls.values())] * 2 + [(None, "b.net", "/es/", "net/es/", "block")]
    assert found == sorted(expected, key=str)
    assert url_filter.judged(pages.limit(0), rules).count() == 0
    none = url_filter.judged(pages, rules.limit(0)).select("rule", "verdict").distinct().collect()
    assert [tuple(r) for r in none] == [(None, "allow")]


def test_the_filter_passes_every_listed_key(spark):
    rules = spark.range(5000).select(
        F.concat(F.lit("h"), "id", F.lit(".org")).alias("host"), F.lit("/a").alias("path"), F.lit("block").alias("verdict")
    )
    pages = rules.select(F.col("path"), F.concat(F.lit("http://x."), "host", "path").alias("url")).select(
        F.monotonically_increasing_id().alias("page_id"), "url"
    )
    assert url_filter.judged(pages, rules).where("verdict = 'block'").count() == 5000
