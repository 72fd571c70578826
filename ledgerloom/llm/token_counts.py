"""Token counts by a finite-state transducer compiled from a byte-level BPE vocabulary.

Two machines work together:

* ``Scanner`` cuts text where the tokenizer's pattern does. No token of the pattern goes
  from a character into white space that follows it, so after such a place the scanner
  is in its start state whatever came before.
* ``Transducer`` reads one piece of the pattern byte by byte. A state holds the tokens that may
  still come out and what stands before them, which the vocabulary bounds whatever the text; each
  transition carries by how many tokens the encoding grows (or shrinks), so the annotations
  along a way add up to its token count. Transitions are compiled as texts need them, and
  forgotten when they get many, in the middle of a piece if need be.

A chunk of text has a map from the state before it to the state after it and the tokens
in between. As every state goes to the start at the first place named above, the map is
given by what comes before the first such place (``head``), the count up to the last one
(``tokens``), and what comes after it (``tail``). Maps compose associatively; those of long
texts are composed in a prefix scan over Spark: neighbours first, then their results.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.hashed_words import sliced
from ledgerloom.llm.packing import byte_characters
from ledgerloom.llm.shared import Scratch, learnt, tidied

LIMIT = 512

#: Characters in a chunk, chunk maps that are composed at once.
CHUNK = 1 << 16
FAN = 32

#: States (and four times as many transitions), pairs of tokens and pieces that a worker remembers.
STATES = 200_000
AGREE = 500_000
PIECES = 500_000

NONE = -1
GROWS = 1 << 12  # above twice the tokens that a token's bytes can have

# Classes of the Latin-1 characters, the pattern of byte-level BPE.
LETTER = "a-zA-ZªµºÀ-ÖØ-öø-ÿ"
NUMBER = "0-9²³¹¼½¾"
WHITE = "\t-\r \u0085 "
PATTERN = (
    "'s|'t|'re|'ve|'m|'ll|'d"
    "| ?[{letter}]+| ?[{number}]+| ?[^{white}{letter}{number}]+"
    "|[{white}]+(?![^{white}])|[{white}]+"
)
PIECE = re.compile(PATTERN.format(letter=LETTER, number=NUMBER, white=WHITE))
#: The same over one sign for each class; contractions keep their letters.
CLASSED = re.compile(PATTERN.format(letter="a-zL", number="N", white=" W"))


class Transducer:
    """Token counts of one piece, read byte by byte in states that the vocabulary bounds.

    A token that may still come out begins at a place since which the bytes read are the beginning
    of some token. Those places are the suffixes of what was read that are ways in the prefix
    tree of all tokens, so one node of the tree, with its suffix links, names them all. A state is
    that node and, for each such place, the last token of the encoding up to there and how many
    tokens have come since. A way's encoding ends with the only token that may follow the last
    token at the place where it begins, so a state knows all that the next byte can bring, and what
    was read before does not matter. A transition carries by how many tokens the encoding grows (or
    shrinks), so the annotations along a way add up to its count.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        back = {char: byte for byte, char in byte_characters().items()}

        def raw(token: str) -> bytes:
            return bytes(back[c] for c in token)

        self.rank = {(raw(a), raw(b)): k for k, (a, b) in enumerate(model["merges"])}
        # A token that its own bytes do not give never comes out.
        merged = {a + b for a, b in self.rank}
        self.tokens = [t for t in map(raw, model["vocab"]) if len(t) == 1 or t in merged]
        self.agree: dict[int, bool] = {}
        self._tree()
        self._compile()

    def _tree(self) -> None:
        """The prefix tree of all tokens, by nodes: children, suffix links, depths, the token that ends there."""
        self.child: dict[int, int] = {}  # by node * 256 + byte
        self.link, self.depth, self.ends, self.inner = [0], [0], [NONE], [True]
        order: list[tuple[int, int, int]] = []
        for number, token in sorted(enumerate(self.tokens), key=lambda t: len(t[1])):
            node = 0
            for byte in token:
                key = node << 8 | byte
                if key not in self.child:
                    self.child[key] = len(self.depth)
                    order.append((self.depth[node], node, byte))
                    self.inner[node] = True
                    for column, value in ((self.link, 0), (self.depth, self.depth[node] + 1), (self.ends, NONE), (self.inner, False)):
                        column.append(value)
                node = self.child[key]
            self.ends[node] = number
        for depth, node, byte in sorted(order):
            if depth:
                self.link[self.child[node << 8 | byte]] = self.goto(self.link[node], byte)
        self.open: dict[int, list[int]] = {}

    def goto(self, node: int, byte: int) -> int:
        """The longest suffix that is a way in the tree after one more byte."""
        while node and (node << 8 | byte) not in self.child:
            node = self.link[node]
        return self.child.get(node << 8 | byte, 0)

    def places(self, node: int) -> list[int]:
        """How long ago each token that may still come out began; 0: begins now."""
        found = self.open.get(node)
        if found is None:
            found, at = [], node
            while at:
                if self.inner[at]:
                    found.append(self.depth[at])
                at = self.link[at]
            found.append(0)
            self.open[node] = found
        return found

    def _compile(self, first: tuple | None = None) -> int:
        """Begins anew with the start state, and with ``first`` if given; its number."""
        start = (0, ((NONE, 0),))
        self.next: dict[int, int] = {}  # by state * 256 + byte: state * GROWS + growth + GROWS / 2
        self.states: list[tuple] = [start]
        self.number = {start: 0}
        return self._state(first) if first else 0

    def _state(self, key: tuple) -> int:
        found = self.number.setdefault(key, len(self.states))
        if found == len(self.states):
            self.states.append(key)
        return found

    def merge(self, piece: bytes) -> list[bytes]:
        """The encoding by the merges themselves."""
        parts = [piece[k : k + 1] for k in range(len(piece))]
        while len(parts) > 1:
            best = min(zip(parts[:-1], parts[1:], strict=True), key=lambda pair: self.rank.get(pair, 1 << 30))
            if best not in self.rank:
                break
            out, k = [], 0
            while k < len(parts):
                if k + 1 < len(parts) and (parts[k], parts[k + 1]) == best:
                    out.append(parts[k] + parts[k + 1])
                    k += 2
                else:
                    out.append(parts[k])
                    k += 1
            parts = out
        return parts

    def _follows(self, before: int, token: int) -> bool:
        """Whether the two tokens stay as they are next to each other (NONE: whether the token begins a piece)."""
        key = (before + 1) << 32 | token
        known = self.agree.get(key)
        if known is None:
            if len(self.agree) > AGREE:
                self.agree.clear()
            both = [self.tokens[before], self.tokens[token]] if before != NONE else [self.tokens[token]]
            known = self.agree[key] = self.merge(b"".join(both)) == both
        return known

    def _step(self, state: int, byte: int) -> int:
        """Compiles a transition."""
        node, held = self.states[state]
        at = dict(zip(self.places(node), held, strict=True))
        new = self.goto(node, byte)
        ending = new
        while True:
            token = self.ends[ending]
            if token != NONE:
                last, since = at[self.depth[ending] - 1]
                if self._follows(last, token):
                    break
            ending = self.link[ending]
        grows = 1 - since
        key = (new, tuple((token, 0) if not back else (at[back - 1][0], at[back - 1][1] + grows) for back in self.places(new)))
        if len(self.states) > STATES or len(self.next) > 4 * STATES:
            # A state knows all that matters, so the others can be forgotten in the middle of a piece.
            state = self._compile(self.states[state])
        found = self.next[state << 8 | byte] = self._state(key) * GROWS + grows + GROWS // 2
        return found

    def count(self, piece: bytes) -> int:
        """Adds up the annotations along the way; compiles the transitions that are new."""
        state = total = 0
        for byte in piece:
            found = self.next.get(state << 8 | byte)
            if found is None:
                found = self._step(state, byte)
            state, grows = divmod(found, GROWS)
            total += grows - GROWS // 2
        return total


class Scanner(dict):
    """Tokens of texts and maps of chunks; remembers the count of each piece of the pattern."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.transducer = Transducer(path)
        tokenizer = Tokenizer.from_file(path)
        self.cutter = tokenizer.pre_tokenizer
        specials = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(map(re.escape, sorted(specials, key=len, reverse=True))) or "(?!)")
        self.opening = min((s[:2] for s in specials), default="\0")
        self.signs: dict[int, str] = {}

    def __missing__(self, piece: str) -> int:
        found = self[piece] = self.transducer.count(piece.encode())
        return found

    def _sign(self, char: str) -> str:
        """The class of a character, as the tokenizer's own cutter sees it."""
        def together(pair):
            return len(self.cutter.pre_tokenize_str(pair)) == 1

        if char == " " or char in "'strevmld":
            return char
        if together("a" + char):
            return "L"
        if together("1" + char):
            return "N"
        return "S" if together("!" + char) else "W"

    def pieces(self, text: str) -> list[str]:
        if text.isascii() or max(text) <= "ÿ":
            return PIECE.findall(text)
        for char in set(text):
            if ord(char) not in self.signs:
                self.signs[ord(char)] = self._sign(char)
        spans = CLASSED.finditer(text.translate(self.signs))
        return [text[span.start() : span.end()] for span in spans]

    def plain(self, text: str) -> int:
        return sum(map(self.__getitem__, self.pieces(text)))

    def count(self, text: str) -> int:
        """Tokens of a text that begins in the start state."""
        if len(self) > PIECES:
            self.clear()
        if self.opening in text:
            parts = self.special.split(text)
            return sum(map(self.plain, parts)) + len(parts) - 1
        return self.plain(text)

    def chunk_map(self, text: str) -> tuple[str, int, str, bool]:
        """``head, tokens, tail, synchronised`` of a chunk."""
        first = SYNCHRONISES.search(text)
        if first is None:
            return text, 0, "", False
        head = first.start() + 1
        # The last such place: the last white space after another character.
        tail = head
        for found in SYNCHRONISES.finditer(text, max(head - 1, len(text) - 256)):
            tail = found.start() + 1
        if tail == head:
            for found in SYNCHRONISES.finditer(text, head - 1):
                tail = found.start() + 1
        return text[:head], self.count(text[head:tail]), text[tail:], True

    def compose(self, maps: list[tuple[str, int, str, bool]]) -> tuple[str, int, str, bool]:
        """One map for neighbours' maps."""
        head, tokens, tails, synchronised = [], 0, [], False
        for own, count, tail, has in maps:
            if not has:
                (tails if synchronised else head).append(own)
            elif not synchronised:
                head.append(own)
                tokens, tails, synchronised = count, [tail], True
            else:
                tails.append(own)
                tokens += self.count("".join(tails)) + count
                tails = [tail]
        return "".join(head), tokens, "".join(tails), synchronised

    def close(self, whole: tuple[str, int, str, bool]) -> int:
        """Tokens from the start state to the end of the text."""
        head, tokens, tail, _ = whole
        return self.count(head) + tokens + (self.count(tail) if tail else 0)


# A character that is no white space and no part of a special string's edge, then ASCII white space.
SYNCHRONISES = re.compile(r"[^\s](?=[ \t\n\r\x0b\x0c])")

def scanner(path: str) -> Scanner:
    """One per worker and file: what it has compiled serves the worker's next tasks."""
    return learnt("scanner", path, make=lambda: Scanner(path))


MAPS = "doc_id long, n_bytes long, row string, at int, head string, tokens long, tail string, whole boolean"


def chunk_maps(docs: DataFrame, tokenizer: str, chunk: int = CHUNK) -> DataFrame:
    """A finished count (``row`` is null) for texts of one chunk, the maps of all chunks for others."""

    def run(batches: Iterator[pa.RecordBatch]):
        known = scanner(tokenizer)
        names = [field.split()[0] for field in MAPS.split(", ")]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.string(), pa.int64(), pa.string(), pa.bool_()]
        for batch in batches:
            for part in sliced(batch, "text", 1 << 20):
                rows = []
                texts = part.column("text").to_pylist()
                for doc, text in zip(part.column("doc_id").to_pylist(), texts, strict=True):
                    text = text or ""
                    size = len(text) if text.isascii() else len(text.encode())
                    if len(text) <= chunk:
                        rows.append((doc, size, None, 0, None, known.count(text), None, True))
                        continue
                    row = uuid.uuid4().hex
                    for k, begin in enumerate(range(0, len(text), chunk)):
                        head, tokens, tail, has = known.chunk_map(text[begin : begin + chunk])
                        rows.append((doc, size, row, k, head, tokens, tail, has))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True), kinds, strict=True)], names=names
                )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(tidied(run), MAPS)


def composed(maps: DataFrame, tokenizer: str, last: bool) -> DataFrame:
    """One round of the scan: the maps of up to FAN neighbours become one."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        known = scanner(tokenizer)
        rows = rows.sort_values("at")
        one = known.compose(list(zip(rows["head"], rows["tokens"], rows["tail"], rows["whole"], strict=True)))
        if last:
            one = (None, known.close(one), None, True)
        out = rows.iloc[:1].assign(at=rows["at"].iloc[0] // FAN, tokens=one[1], whole=one[3])
        out["head"], out["tail"] = [one[0]], [one[2]]
        return out

    return maps.groupBy("row", F.floor(F.col("at") / FAN).alias("near")).applyInPandas(
        lambda rows: run(rows), MAPS
    )


def token_counts(
    docs: DataFrame, tokenizer: str, *, limit: int = LIMIT, chunk: int = CHUNK
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row.

    Counts are those of the tokenizers library for the vocabulary file at ``tokenizer``
    (a path that every executor has) without added special tokens; a special string in a
    text is one token, as the library's default has it. A null text is empty: no bytes,
    no tokens. Rows with equal or null doc_id are counted each for itself. No rows give
    no rows; other columns are not read.
    """
    spark = docs.sparkSession
    kept = Scratch(spark, "token-counts")
    maps = kept.store(chunk_maps(docs, tokenizer, chunk))
    long_ = maps.where("row is not null")
    chunks = (long_.agg(F.max("at")).first()[0] or 0) + 1
    while chunks > 1:
        chunks = -(-chunks // FAN)
        long_ = kept.store(composed(long_, tokenizer, last=chunks == 1))
    return (
        maps.where("row is null")
        .union(long_)
        .select("doc_id", "n_bytes", F.col("tokens").alias("n_tokens"), (F.col("tokens") > limit).alias("over_limit"))
    )
