r"""Chat formatting with a grammar that reads its own output back.

A turn is written as

    ### role:
    text
    </turn>

and a conversation is its turns in a row. The grammar of the output:

    conversation = turn*
    turn         = "### " role ":\n" body "\n</turn>\n"
    role         = characters without line ends; "\\", "\n", "\r" stand for themselves escaped
    body         = characters; a control string, "### " or "</turn>", only behind a backslash

A body is read by taking one backslash from every run of them that stands before a control
string. A text goes through the round trip first as it is: rendered, parsed, compared. If it
does not come back as it was (a control string in it, or backslashes before one), the
conflicting places get one more backslash and the text goes through again, until what is
read is what was written.

Turns are escaped and checked one by one before anything is grouped. The turns of a
conversation are then put in order by Spark's sort and streamed into rows of bounded size
(``PART`` characters, one row for nearly all conversations), with the spans of assistant
texts, so a conversation of any length takes bounded memory.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.shared import Scratch

OPEN, CLOSE, END = "### ", ":\n", "\n</turn>\n"
CONTROL = re.compile(r"\\*(?:### |</turn>)")
ESCAPED = re.compile(r"\\(\\*(?:### |</turn>))")
ROLE_SIGNS = {"\\": "\\\\", "\n": "\\n", "\r": "\\r"}
ROLE_BACK = {own: sign for sign, own in ROLE_SIGNS.items()}

LEARNED_ROLE = "assistant"

#: Characters in a row of output before the next row begins (after a whole turn).
PART = 1 << 20


def render(role: str, body: str) -> str:
    role = re.sub(r"[\\\n\r]", lambda m: ROLE_SIGNS[m[0]], role)
    return f"{OPEN}{role}{CLOSE}{body}{END}"


def parse(text: str, at: int = 0) -> tuple[str, str, tuple[int, int], int]:
    """The turn at a place: its role, its text, the span of its body, and where the next one begins."""
    if not text.startswith(OPEN, at):
        raise ValueError(f"no turn at {at}")
    line = text.find("\n", at)
    if line < 0 or text[line - 1 : line + 1] != CLOSE:
        raise ValueError(f"no role at {at}")
    role = re.sub(r"\\[\\nr]", lambda m: ROLE_BACK[m[0]], text[at + len(OPEN) : line - 1])
    begin = line + 1
    for found in CONTROL.finditer(text, begin - 1):
        place = found.start()
        if text[place] == "\\" or place < begin:
            continue  # escaped: part of the body
        if text.startswith(END, place - 1):
            stop = place - 1
            if stop < begin:
                raise ValueError(f"no body at {begin}")
            return role, ESCAPED.sub(r"\1", text[begin:stop]), (begin, stop), stop + len(END)
        raise ValueError(f"control string at {place}")
    raise ValueError(f"no end after {begin}")


def escape(text: str) -> str:
    """One more backslash before each control string and the backslashes before it."""
    return CONTROL.sub(lambda m: "\\" + m[0], text)


def round_trip(role: str, text: str) -> str:
    """The rendered turn that reads back as role and text."""
    body = text
    while True:
        turn = render(role, body)
        try:
            back, own, _, stop = parse(turn)
            if (back, own, stop) == (role, text, len(turn)):
                return turn
        except ValueError:
            pass
        if body is not text:
            raise ValueError("a turn cannot be written so that it reads back")
        body = escape(text)


def rendered_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with ``formatted``: every turn rendered and checked by itself."""

    @F.arrow_udf("string")
    def formatted(role: pa.Array, text: pa.Array) -> pa.Array:
        return pa.array(list(map(round_trip, role.to_pylist(), text.to_pylist())), pa.string())

    return conversations.select(
        F.col("conv_id").cast("long"),
        F.col("turn").cast("long"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).withColumn("formatted", formatted("role", "text"))


FORMATTED = "conv_id long, part int, last boolean, formatted string, spans array<struct<begin: int, stop: int>>"


def format_conversations(conversations: DataFrame, part: int = PART, learned: str = LEARNED_ROLE) -> DataFrame:
    """``conv_id, part, last, formatted, spans``: conversations in the template, in rows of whole turns.

    ``spans`` are the places in ``formatted`` under the loss mask: the bodies of ``learned``'s
    turns. Turns are in order of ``turn`` (null first), equal ones by role and text; repeated
    rows are turns of their own. A null role or text is empty; rows with a null conv_id are one
    conversation. Other columns are not read.
    """

    def run(batches: Iterator[pd.DataFrame]):
        now, texts, spans, size, number = None, [], [], 0, 0
        begun = False

        def row(last):
            return (now, number, last, "".join(texts), spans)

        rows: list[tuple] = []
        held = 0
        for batch in batches:
            ids = batch["conv_id"].astype("Int64")
            for conv, role, turn in zip(ids, batch["role"], batch["formatted"], strict=True):
                conv = None if conv is pd.NA else int(conv)
                if begun and conv != now:
                    rows.append(row(True))
                    held += size
                    texts, spans, size, number = [], [], 0, 0
                elif begun and size >= part:
                    rows.append(row(False))
                    held += size
                    texts, spans, size, number = [], [], 0, number + 1
                now, begun = conv, True
                if role == learned:
                    begin = len(OPEN) + len(re.sub(r"[\\\n\r]", lambda m: ROLE_SIGNS[m[0]], role)) + len(CLOSE)
                    spans.append((size + begin, size + len(turn) - len(END)))
                texts.append(turn)
                size += len(turn)
                if held >= 4 * part or len(rows) >= 2000:
                    yield _frame(rows)
                    rows, held = [], 0
        if begun:
            rows.append(row(True))
            yield _frame(rows)

    turns = rendered_turns(conversations).repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return turns.select("conv_id", "role", "formatted").mapInPandas(run, FORMATTED)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=["conv_id", "part", "last", "formatted", "spans"])
    out["conv_id"] = out["conv_id"].astype("Int64")
    out["spans"] = [[{"begin": a, "stop": b} for a, b in spans] for spans in out["spans"]]
    return out


READ = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
)


def read_back(formatted: DataFrame) -> DataFrame:
    """What the grammar reads from formatted conversations: ``conv_id``, turns and loss text as counts and digests.

    Conversations in one row are read where they lie; only the rows of longer ones are
    brought together, in order.
    """

    def run(batches: Iterator[pd.DataFrame]):
        turns, loss = hashlib.sha256(), hashlib.sha256()
        n = chars = size = 0
        for batch in batches:
            rows = []
            for conv, last, text, spans in zip(
                batch["conv_id"].astype("Int64"), batch["last"], batch["formatted"], batch["spans"], strict=True
            ):
                at = 0
                masked = {}
                while at < len(text):
                    role, own, span, at = parse(text, at)
                    turns.update(f"{role}\n{own}\n".encode())
                    masked[span] = own
                    n += 1
                for span in spans:
                    own = masked[span["begin"], span["stop"]]
                    loss.update(own.encode())
                    chars += len(own)
                size += len(text)
                if last:
                    rows.append((conv, n, turns.hexdigest(), chars, loss.hexdigest(), size))
                    turns, loss = hashlib.sha256(), hashlib.sha256()
                    n = chars = size = 0
            if rows:
                out = pd.DataFrame(rows, columns=[f.split()[0] for f in READ.split(", ")])
                yield out.assign(conv_id=out["conv_id"].astype("Int64"))

    own = ["conv_id", "last", "formatted", "spans"]
    single = (F.col("part") == 0) & F.col("last")
    several = formatted.where(~single).repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return (
        formatted.where(single).select(own).mapInPandas(run, READ).union(several.select(own).mapInPandas(run, READ))
    )


def formatted_conversations(conversations: DataFrame) -> DataFrame:
    """All conversations written in the template, stored, and read back from what was stored."""
    kept = Scratch(conversations.sparkSession, "chat")
    return read_back(kept.store(format_conversations(conversations)))
