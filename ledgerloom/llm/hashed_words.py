"""Word hashes of whole Arrow columns of text, worked out on the bytes with numpy.

A word is a maximal run of bytes that are no separators. Its hash is a polynomial
over the run, taken from running sums over the column, so no word becomes a Python
object. Texts of any length are read whole; long ones go through in slices that
end at a separator, so memory stays within a few times ``SLICE_BYTES`` (or the
longest single word).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20

# Odd multiplier of the polynomial; its inverse modulo 2^64 undoes a shift.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

#: Space, tab, newline, vertical tab, form feed, carriage return.
WHITE = np.zeros(256, dtype=bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True

#: All of ASCII that is neither letter nor digit.
NOT_WORD = np.array([c < 128 and not chr(c).isalnum() for c in range(256)])


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit numbers over all of them."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))
LOWER_VALUES = BYTE_VALUES[LOWER]

_powers = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for k, base in enumerate((BASE, INVERSE)):
            steps = np.full(n, base, dtype=np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0], _powers[1]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the offsets of its rows; null is empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    rows = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[rows[0] : rows[-1]] if len(rows) else whole, rows - rows[0]


def _slices(data: np.ndarray, rows: np.ndarray, separator: np.ndarray) -> Iterator[tuple[int, int]]:
    """Parts of about SLICE_BYTES that end where a row or a word ends."""
    begin, end = 0, len(data)
    while begin < end:
        stop = min(begin + SLICE_BYTES, end)
        while stop < end and not separator[data[stop]]:
            after = rows[np.searchsorted(rows, stop)]
            found = np.flatnonzero(separator[data[stop : min(stop + 4096, after)]])
            if len(found):
                stop += int(found[0])
            elif stop + 4096 >= after:
                stop = int(after)
                break
            else:
                stop += 4096
        yield begin, stop
        begin = stop


def word_hashes(
    column: pa.Array, separator: np.ndarray = WHITE, *, lower: bool = True, starts_of: tuple[int, ...] = ()
) -> tuple[np.ndarray, ...]:
    """Hashes of all words of a text column, in order, and each row's offset among them.

    ``starts_of`` asks for hashes of the words' first so many bytes as well; they come last.
    """
    data, rows = text_bytes(column)
    values = LOWER_VALUES if lower else BYTE_VALUES
    hashes, starts = [], []
    heads: list[list[np.ndarray]] = [[] for _ in starts_of]
    for begin, stop in _slices(data, rows, separator):
        part = data[begin:stop]
        powers, inverses = _power_tables(len(part))
        inside = ~separator[part]
        first = rows[np.searchsorted(rows, begin) : np.searchsorted(rows, stop)] - begin
        fresh = np.ones(len(part), dtype=bool)  # no word goes on from the byte before
        fresh[1:] = ~inside[:-1]
        fresh[first[first < len(part)]] = True
        last = np.ones(len(part), dtype=bool)
        last[:-1] = fresh[1:] | ~inside[1:]
        start = np.flatnonzero(inside & fresh)
        stops = np.flatnonzero(inside & last) + 1
        sums = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum(values[part] * powers[: len(part)], out=sums[1:])
        hashes.append(mix((sums[stops] - sums[start]) * inverses[start]))
        starts.append(start + begin)
        for held, n in zip(heads, starts_of, strict=True):
            held.append(mix((sums[np.minimum(stops, start + n)] - sums[start]) * inverses[start]))
    if not hashes:
        none = np.zeros(0, np.uint64)
        return (none, np.zeros(len(rows), np.int64), *(none for _ in starts_of))
    return (
        np.concatenate(hashes),
        np.searchsorted(np.concatenate(starts), rows),
        *(np.concatenate(held) for held in heads),
    )


def sliced(batch: pa.RecordBatch, column: str, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about ``limit`` bytes of text each, so that what is made of them stays small."""
    _, rows = text_bytes(batch.column(column))
    at = 0
    while at < batch.num_rows:
        stop = max(at + 1, int(np.searchsorted(rows, rows[at] + limit, side="right")) - 1)
        yield batch.slice(at, stop - at)
        at = stop


def shingle_sets(words: np.ndarray, rows: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Each row's distinct hashes of ``width`` words in a row, sorted, and the rows' offsets.

    A row of fewer words has its whole sequence as the only one; a row without words has none.
    """
    step = np.uint64(BASE)
    count = np.diff(rows)
    span = len(words) - width + 1
    if span > 0:
        windows = words[:span].copy()
        for k in range(1, width):
            windows *= step
            windows += words[k : k + span]
        windows = mix(windows)
    sets = []
    for at, n in zip(rows[:-1].tolist(), count.tolist(), strict=True):
        if n >= width:
            own = np.sort(windows[at : at + n - width + 1])
            sets.append(own[np.concatenate(([True], own[1:] != own[:-1]))])
        elif n:
            whole = np.uint64(n)
            with np.errstate(over="ignore"):
                for word in words[at : at + n]:
                    whole = whole * step + word
            sets.append(mix(np.array([whole], dtype=np.uint64)))
        else:
            sets.append(words[:0])
    sizes = np.fromiter(map(len, sets), dtype=np.int64, count=len(sets))
    return np.concatenate(sets) if sets else words[:0], np.concatenate(([0], np.cumsum(sizes)))


def set_hashes(items: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """One 64-bit hash for each row's set of items; 0 only for sets without items."""
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(items + np.uint64(BASE)), dtype=np.uint64)))
    size = np.diff(rows).astype(np.uint64)
    out = mix((sums[rows[1:]] - sums[rows[:-1]]) + size * np.uint64(INVERSE))
    out[out == 0] = 1
    return np.where(size > 0, out, np.uint64(0))


def byte_planes(numbers: np.ndarray) -> bytes:
    """Numbers as all their first bytes, all their second bytes and so on, which compresses well when they are small."""
    return np.ascontiguousarray(numbers).view(np.uint8).reshape(-1, numbers.itemsize).T.tobytes()


def from_byte_planes(data: bytes, dtype: str) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T).view(dtype).ravel()
