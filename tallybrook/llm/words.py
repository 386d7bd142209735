"""Words and word shingles of whole Arrow batches, as 64-bit hashes.

A word is a run of bytes other than 0x20 and 0x09-0x0D, which for UTF-8 text is the same
as a run of characters other than those. Texts of a batch are hashed together; memory
follows the batch, and a long text is hashed in pieces cut between words.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEPARATORS = np.zeros(256, bool)
SEPARATORS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

# Bytes hashed at once; the arrays made on the way take about 50 times as much.
PIECE = 1 << 18

U64 = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (the finalizer of splitmix64)."""
    x = np.asarray(x, U64)
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_BYTE_CODES = mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))
_LOWER_CODES = _BYTE_CODES.copy()
_LOWER_CODES[ord("A") : ord("Z") + 1] = _BYTE_CODES[ord("a") : ord("z") + 1]
_BASE = U64(0x2545F4914F6CDD1D)
_SHINGLE = U64(0xD6E8FEB86659FD93)


class Words(NamedTuple):
    """Words of some texts in order: hash, first byte, byte behind the last, first word
    of every text (one more than texts)."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray


class Texts(NamedTuple):
    """UTF-8 bytes of some texts on end and the place where each starts (one more than texts)."""

    data: np.ndarray
    offsets: np.ndarray


def text_bytes(column: pa.Array) -> Texts:
    """Bytes of a string column; NULL is the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    places = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8) if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return Texts(raw[places[0] : places[-1]], places - places[0])


def pieces(column: pa.Array, size: int = 4 * PIECE) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts have about ``size`` bytes together, at least one row each."""
    offsets = text_bytes(column).offsets
    at = 0
    while at < len(column):
        upto = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
        yield at, upto
        at = upto


def _hash_near(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, codes: np.ndarray) -> np.ndarray:
    lengths = ends - starts
    if not len(lengths):
        return np.zeros(0, U64)
    firsts = np.cumsum(lengths) - lengths
    inside = np.arange(firsts[-1] + lengths[-1], dtype=np.int64)
    letters = codes[data[inside + np.repeat(starts - firsts, lengths)]]
    inside -= np.repeat(firsts, lengths)
    letters *= np.cumprod(np.full(int(lengths.max()), _BASE, U64))[inside]
    return mix(np.add.reduceat(letters, firsts) + lengths.astype(U64))


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, codes: np.ndarray = _BYTE_CODES) -> np.ndarray:
    """Hashes of non-empty byte ranges in ascending order, some at a time."""
    hashes = np.empty(len(starts), U64)
    at = 0
    while at < len(starts):
        upto = max(at + 1, int(np.searchsorted(ends, starts[at] + PIECE, "right")))
        hashes[at:upto] = _hash_near(data, starts[at:upto], ends[at:upto], codes)
        at = upto
    return hashes


def words(texts: Texts, lower: bool = False, separators: np.ndarray = SEPARATORS) -> Words:
    data, offsets = texts
    codes = _LOWER_CODES if lower else _BYTE_CODES
    size = len(data)
    inner = ~separators[data]
    begins, stops = inner.copy(), inner.copy()
    begins[1:] &= ~inner[:-1]
    stops[:-1] &= ~inner[1:]
    edges = offsets[:-1][offsets[:-1] < size]
    begins[edges] = inner[edges]
    last = offsets[1:][offsets[1:] > 0] - 1
    stops[last] = inner[last]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    return Words(hash_spans(data, starts, ends, codes), starts, ends, np.searchsorted(starts, offsets))


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` neighbouring words, by its first word."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, U64)
    out = np.full(n, U64(width), U64)
    for j in range(width):
        out = mix(out * _SHINGLE + hashes[j : j + n])
    return out


def shingle_sets(found: Words, width: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingles of every text; with fewer words, all of them as one."""
    all_windows = windows(found.hashes, width)
    for at, upto in zip(found.first[:-1], found.first[1:]):
        n = upto - at
        if n >= width:
            yield np.unique(all_windows[at : upto - width + 1])
        elif n:
            yield windows(found.hashes[at:upto], int(n))
        else:
            yield np.zeros(0, U64)


def carrying(documents: DataFrame, **named) -> tuple[DataFrame, str]:
    """Rows with the ``named`` columns and, as the struct ``_rest``, all others; and the
    types of both, as a schema. A name is a column of the documents, or None for a NULL."""
    rest = [F.col(f"`{c}`") for c in documents.columns if c not in named.values()]
    columns = [(F.lit(None).cast("string") if c is None else F.col(f"`{c}`")).alias(n) for n, c in named.items()]
    rows = documents.select(*columns, (F.struct(*rest) if rest else F.lit(None).cast("string")).alias("_rest"))
    return rows, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)


def restored(rows: DataFrame, documents: DataFrame, **named) -> list:
    """The columns of the documents, out of rows made by ``carrying``."""
    back = {c: n for n, c in named.items() if c is not None}
    return [(F.col(back[c]) if c in back else F.col(f"_rest.`{c}`")).alias(c) for c in documents.columns]
