"""Fill-in-the-middle: a text is cut in three, and the middle is moved to its end.

A text is matched once by ``(letters | any other character)*``. The regex library keeps
every repetition of a capture, so the places where its repetitions ended are the number
of units and all places where a cut may fall. Two draws choose the cuts, a third whether the
text stays plain, a fourth the order of the parts. Draws are digits of a hash of seed and
id, so reruns agree, and rows that share an id share their draws. One map over the rows;
nothing is shuffled.

The parts are told apart by markers. A text that holds a marker stays plain; in all others
no marker can arise but those that were put in, also not across the edges of parts, as
they share no beginning with another's end. So ``restored`` gives back every text.

Defined cases: a NULL text is the empty text, and the empty text is plain; a NULL id draws
as an id without digits; texts of any length are cut whole; repeated rows are cut alike;
an empty table gives an empty result; columns other than the two named are not read, so
their names cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybrook.llm.words import pieces

# Possessive: no way back is kept, so memory follows the units and not the tries.
UNITS = regex.compile(r"([A-Za-z]++|[^A-Za-z])*+")

PLAIN, PSM, SPM = "plain", "psm", "spm"


class Markers(NamedTuple):
    """What stands ahead of prefix, suffix and middle."""

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"


def draws(seed: int, owner: object) -> list[int]:
    """Four 32-bit numbers of a seed and an id."""
    digest = hashlib.sha256(f"{seed}:{'' if owner is None else owner}".encode()).digest()
    return [int.from_bytes(digest[i : i + 4], "big") for i in range(0, 16, 4)]


class Cut(NamedTuple):
    """A text's units, its form, the code points of prefix and middle (None if plain), and
    the text as it is put out."""

    n: int
    form: str
    prefix_chars: int | None
    middle_chars: int | None
    output: str


def cut(text: str, owner: object, seed: int, plain_percent: int, spm_percent: int, markers: Markers) -> Cut:
    ends = UNITS.fullmatch(text).ends(1)
    n = len(ends)
    one, two, third, fourth = draws(seed, owner)
    if not text or third % 100 >= 100 - plain_percent or any(m in text for m in markers):
        return Cut(n, PLAIN, None, None, text)
    low, high = sorted((one % (n + 1), two % (n + 1)))
    a, b = (ends[x - 1] if x else 0 for x in (low, high))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if fourth % 100 < spm_percent:
        return Cut(n, SPM, a, b - a, f"{markers.suffix}{suffix}{markers.prefix}{prefix}{markers.middle}{middle}")
    return Cut(n, PSM, a, b - a, f"{markers.prefix}{prefix}{markers.suffix}{suffix}{markers.middle}{middle}")


def whole(output: str, form: str, markers: Markers) -> str:
    """The text that ``cut`` was given."""
    if form == PLAIN:
        return output
    first, second = (markers.prefix, markers.suffix) if form == PSM else (markers.suffix, markers.prefix)
    one, _, rest = output[len(first) :].partition(second)
    two, _, middle = rest.partition(markers.middle)
    return one + middle + two if form == PSM else two + middle + one


def fill_in_middle(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    seed: int = 1,
    plain_percent: int = 10,
    spm_percent: int = 20,
    markers: Markers = Markers(),
) -> DataFrame:
    """Per document its id, ``n`` units, ``form`` (plain, psm: prefix, suffix, middle, or
    spm: suffix, prefix, middle), ``prefix_chars``, ``middle_chars`` and ``output``."""
    starts = {m[:i] for m in markers for i in range(1, len(m) + 1)}
    mixed = any(m[i:] in starts for m in markers for i in range(1, len(m)))
    if not all(markers) or mixed or sum(a in b for a in markers for b in markers) > len(markers):
        raise ValueError("no marker may hold another, or end as one begins")
    rows = documents.select(F.col(id_column).alias("_id"), F.col(text_column).alias("_text"))

    def cut_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, upto in pieces(batch.column(1)):
                part = batch.slice(at, upto - at)
                found = [
                    cut(text or "", owner, seed, plain_percent, spm_percent, markers)
                    for owner, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist())
                ]
                kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
                columns = [pa.array(c, k) for c, k in zip(zip(*found), kinds)]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], ["_id", *Cut._fields])

    kind = rows.schema["_id"].dataType.simpleString()
    made = rows.mapInArrow(cut_rows, f"_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string")
    return made.select(F.col("_id").alias(id_column), *Cut._fields)


def restored(rows: DataFrame, markers: Markers = Markers()) -> DataFrame:
    """The rows with ``restored``: the whole text, out of ``output`` and ``form`` alone."""
    body = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
    kept = rows.select(body.alias("_row"), F.col("form").alias("_form"), F.col("output").alias("_output"))

    def restore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, upto in pieces(batch.column(2)):
                part = batch.slice(at, upto - at)
                found = [whole(o, f, markers) for f, o in zip(part.column(1).to_pylist(), part.column(2).to_pylist())]
                yield pa.record_batch({"_row": part.column(0), "_restored": pa.array(found, pa.string())})

    back = kept.mapInArrow(restore, f"_row {kept.schema['_row'].dataType.simpleString()}, _restored string")
    return back.select("_row.*", F.col("_restored").alias("restored"))
