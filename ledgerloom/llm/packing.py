"""Sum-of-squares packing of tokenized documents into sequences of bounded length.

A document's ids come from a public tokenizer and end with one closing id. Only
documents longer than a sequence are cut. A piece is placed in the open sequence for which the
sum, over all residual gaps, of the squared number of open sequences with that gap becomes
smallest (of equal sums, in the one that it fills most): many sequences with equal gaps are
avoided, so that later pieces find the gap they fit. Only where no open sequence has room does a
new one begin. The rule as published also weighs a new sequence wherever open ones have room;
longest pieces first, that takes more sequences (2,119 against 2,038 for 4,000 uniform lengths up
to 400 in sequences of 400, which hold 2,022 at best).

Pieces are dealt at random into groups of about ``GROUP`` rows and each group is packed
by a task of its own, longest pieces first; a group loses at most a few unfilled
sequences, against some thousand that it fills. Only lengths and numbers take part in
the packing, no text and no ids.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.hashed_words import sliced
from ledgerloom.llm.shared import Scratch, learnt, tidied

CAPACITY = 4096
END_ID = 1
GROUP = 30_000

#: Runs of text whose ids a worker remembers; beyond, it starts anew.
REMEMBERED = 500_000

# Classes of the Latin-1 characters and the tokenizer's way to cut words.
LETTER = "a-zA-ZªµºÀ-ÖØ-öø-ÿ"
NUMBER = "0-9²³¹¼½¾"
WHITE = "\t-\r \u0085\u00a0"
WORD = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d|[{LETTER}]+|[{NUMBER}]|[^{WHITE}{LETTER}{NUMBER}]+"
)


def byte_characters() -> dict[int, str]:
    """The printable character that byte-level vocabularies write for each byte."""
    shown = [c for c in range(256) if 33 <= c < 127 or 161 <= c < 173 or c >= 174]
    hidden = [c for c in range(256) if c not in set(shown)]
    return {c: chr(c) for c in shown} | {c: chr(256 + k) for k, c in enumerate(hidden)}


class RunIds(dict):
    """Little-endian 32-bit ids of runs of text between ASCII white space, filled as runs turn up.

    No token crosses white space, so a text's ids are those of its runs in a row.
    Runs in Latin-1 are cut into words here and each word goes to the tokenizer's
    model; others, and what may hold a special string, go to the tokenizer whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.shown = byte_characters()

    def __missing__(self, run: bytes) -> bytes:
        text = run.decode()
        if b"<|" in run or not (run.isascii() or max(text) <= "ÿ"):
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        else:
            ids = []
            for word in WORD.findall(text.lower()):
                if not word.isascii() or not word.isprintable():
                    word = word.encode().decode("latin-1").translate(self.shown)
                ids += [token.id for token in self.model.tokenize(word)]
        found = self[run] = np.array(ids, "<u4").tobytes()
        return found

    def of(self, texts: list[bytes]) -> Iterator[bytes]:
        """The ids of each text."""
        if len(self) > REMEMBERED:
            self.clear()
        for text in texts:
            # Case goes away anyway; only in special strings it matters.
            runs = (text if b"<|" in text else text.lower()).split()
            yield b"".join(map(self.__getitem__, runs))


def run_ids(path: str) -> RunIds:
    """One per worker and file: what it has learnt serves the worker's next tasks."""
    return learnt("run ids", path, make=lambda: RunIds(path))


def pieces(
    docs: DataFrame, tokenizer: str, *, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` and, if asked, ``ids``: documents cut at ``capacity`` ids.

    ``tokenizer`` is the path of a vocabulary file that every executor has. A null text
    is empty: one piece with the closing id alone.
    """
    end = np.array([end_id], "<u4").tobytes()
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids

    def run(batches):
        known = run_ids(tokenizer)
        for batch in batches:
            for part in sliced(batch, "text", 1 << 20):
                rows: list[tuple] = []
                texts = [text or b"" for text in part.column("text").cast(pa.binary()).to_pylist()]
                for doc, ids in zip(part.column("doc_id").to_pylist(), known.of(texts), strict=True):
                    ids += end
                    for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                        own = ids[at : at + 4 * capacity]
                        row = (doc, k, at // 4, len(own) // 4, zlib.crc32(own))
                        rows.append((*row, np.frombuffer(own, "<i4")) if with_ids else row)
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: 5 + with_ids]
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)], names=names
                )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(tidied(run), schema)


def sum_of_squares(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length, which are placed from the longest to the shortest.

    A bin that is full is closed and no longer counted; a new one begins only where none has room.
    """
    open_ = np.zeros(capacity + 1, dtype=np.int64)  # open bins by residual gap
    bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    bin_of = np.empty(len(lengths), dtype=np.int64)
    offset = np.empty(len(lengths), dtype=np.int64)
    made = 0
    far = np.iinfo(np.int64).max
    for at in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[at])
        # What the sum grows by: one bin less with gap g, one more with gap g - size (0: closed).
        now, then = open_[size:capacity], open_[: capacity - size]
        grows = np.where(now > 0, 2 * (then - now) + 2, far)
        if len(grows) and now[0]:
            grows[0] -= 1
        best = int(np.argmin(grows)) if len(grows) else 0
        if len(grows) and grows[best] < far:
            gap = size + best
            own = bins[gap].pop()
            open_[gap] -= 1
        else:
            gap, own = capacity, made
            made += 1
        bin_of[at], offset[at] = own, capacity - gap
        if gap > size:
            bins[gap - size].append(own)
            open_[gap - size] += 1
    return bin_of, offset


def pack(found: DataFrame, *, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """``found`` (stored pieces) with ``sequence_id`` and ``offset``: gapless from 0 in every sequence."""
    groups = max(1, -(-found.count() // group))
    schema = found.schema.add("sequence_id", "long").add("offset", "long")

    def place(rows: pd.DataFrame) -> pd.DataFrame:
        bins, offsets = sum_of_squares(rows["length"].to_numpy(), capacity)
        own = rows.pop("group").iloc[0]
        return rows.assign(sequence_id=(int(own) << 32) + bins, offset=offsets)

    dealt = found.withColumn("group", F.floor(F.rand(7) * groups))
    return dealt.groupBy("group").applyInPandas(place, schema)


def sequences(placed: DataFrame) -> DataFrame:
    """``sequence_id, ids`` from placed pieces with ids; a sequence holds ``capacity`` ids at most."""
    own = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return placed.groupBy("sequence_id").agg(F.flatten(F.transform(own, lambda p: p["ids"])).alias("ids"))


def packed_documents(docs: DataFrame, tokenizer: str, *, capacity: int = CAPACITY) -> DataFrame:
    """All documents as placed pieces.

    Rows are packed as they are: equal rows, equal ids and null ids are documents of
    their own. No documents give no rows. Other columns of ``docs`` are not read.
    """
    kept = Scratch(docs.sparkSession, "packing")
    return pack(kept.store(pieces(docs, tokenizer, capacity=capacity)), capacity=capacity)
