"""Quality rules with tokeniser fertility.

Base figures of every text come first: words, repeated lines, repeated word windows.
Then public vocabularies measure how well a text fits them: characters per token under
each, the share of tokens that fall back to single bytes, and the entropy of the token
distribution in bits. A document is rejected where a figure leaves the
band of its language, or of its script if the language has no band of its own.

Defined cases: a NULL or empty text has zero figures and fails the base rules; a text
without letters has the script "none"; long texts are measured whole; repeated rows are
judged each; an empty table gives an empty result; columns other than those named are
not read. All of it is one map over the rows: nothing is shuffled.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator, Mapping
from functools import cache
from itertools import chain
from typing import NamedTuple

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybrook.llm.runs import ByteBpe, RunPool, held, load_pieces
from tallybrook.llm.words import PIECE, Texts, Words, carrying, hash_spans, mix, pieces, restored, text_bytes, windows, words

BYTE_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PIECE_VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True

# Scripts by the first word of the names of their letters; letters of any other are "other".
SCRIPTS = (
    "none", "latin", "greek", "cyrillic", "hebrew", "arabic", "indic", "cjk",
    "armenian", "georgian", "ethiopic", "myanmar", "khmer", "other", "latin_marked",
)
_NAMES = {
    **{name.upper(): name for name in SCRIPTS},
    **dict.fromkeys(("FULLWIDTH", "FEMININE", "MASCULINE"), "latin"),
    **dict.fromkeys(("CJK", "HANGUL", "HIRAGANA", "KATAKANA", "HALFWIDTH", "BOPOMOFO", "IDEOGRAPHIC"), "cjk"),
    **dict.fromkeys(
        ("DEVANAGARI", "BENGALI", "GURMUKHI", "GUJARATI", "ORIYA", "TAMIL", "TELUGU", "KANNADA", "MALAYALAM", "SINHALA",
         "THAI", "LAO", "TIBETAN"), "indic"),
}

# A text of Latin letters is "latin_marked" if one in so many code points is a letter or mark
# of Vietnamese and the like, which the vocabularies split into bytes.
MARKED_SHARE = 20


@cache
def script_of() -> np.ndarray:
    """The script of every code point; marks, digits and signs have none."""
    numbers = {name: SCRIPTS.index(script) for name, script in _NAMES.items()}
    table = np.zeros(0x110000, np.int8)
    for code in range(0x110000):
        letter = chr(code)
        if letter.isalpha():
            first = unicodedata.name(letter, "").split(" ")[0].split("-")[0]
            table[code] = numbers.get(first, SCRIPTS.index("other"))
    return table


@cache
def marked_letters() -> np.ndarray:
    marks = np.zeros(0x110000, bool)
    marks[0x1E00:0x1F00] = marks[0x0300:0x0370] = True
    return marks


class Band(NamedTuple):
    """Limits that a document must keep."""

    chars_per_byte_token: float
    chars_per_piece: float
    byte_share: float
    entropy_bits: float


# Least characters per token under either vocabulary, greatest share of byte tokens, least
# entropy. Scripts the vocabularies know little of cost several tokens a character.
BANDS = {
    "latin": Band(1.30, 1.25, 0.10, 4.0),
    "latin_marked": Band(0.70, 1.00, 0.15, 4.0),
    "greek": Band(0.40, 0.60, 0.30, 3.5),
    "cyrillic": Band(0.40, 0.90, 0.30, 4.0),
    "hebrew": Band(0.30, 0.50, 0.30, 3.0),
    "arabic": Band(0.30, 0.50, 0.30, 3.0),
    "indic": Band(0.20, 0.25, 0.80, 2.5),
    "cjk": Band(0.25, 0.35, 0.80, 3.5),
    "armenian": Band(0.30, 0.50, 0.50, 3.0),
    "georgian": Band(0.25, 0.50, 0.30, 3.0),
    "ethiopic": Band(0.25, 0.30, 0.95, 2.5),
    "myanmar": Band(0.20, 0.35, 0.80, 2.5),
    "khmer": Band(0.20, 0.35, 0.80, 2.5),
    "other": Band(0.15, 0.20, 0.98, 2.5),
    "none": Band(0.50, 0.50, 0.20, 3.5),
}

# Latin texts that carry one of these languages are held against its band; they count to
# the band "latin". The limits lie below the least of 4,577 documents that keep the base
# rules. Hex dumps have few characters a piece (1.17), random letters few a byte token (1.74
# and 1.78 in two samples).
LATIN_LANGUAGES = {
    "de": Band(1.85, 1.80, 0.10, 4.0),
    "en": Band(1.90, 1.75, 0.10, 4.0),
    "es": Band(1.80, 1.55, 0.10, 4.0),
    "fr": Band(1.85, 1.60, 0.10, 4.0),
}

# Entropy says little about a text of fewer tokens; it counts as this many bits.
ENTROPY_TOKENS, ENTROPY_FREE = 64, 16.0

REPEAT_WIDTH = 5

# Runs a worker keeps.
WORKER_RUNS = 150_000

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MEASURES = ("chars_per_byte_token", "chars_per_piece", "byte_share", "entropy")


def _per_text(marks: np.ndarray, places: np.ndarray) -> np.ndarray:
    """How many marks lie between neighbouring places."""
    upto = np.concatenate(([0], np.cumsum(marks, dtype=np.int64)))
    return np.diff(upto[places])


def _repeats(hashes: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which values their owner has twice or more, and all of these but one of each."""
    keys = hashes ^ mix(owners.astype(np.uint64) + np.uint64(1))
    order = np.argsort(keys)
    same = keys[order[1:]] == keys[order[:-1]]
    twice, again = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    again[order[1:][same]] = True
    return twice, again


def base_counts(texts: Texts) -> dict[str, np.ndarray]:
    data, offsets = texts
    found = words(texts)
    n_words = np.diff(found.first)
    inside = np.zeros(len(data) + 1, np.int8)
    inside[found.starts] += 1
    inside[found.ends] -= 1
    in_word = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
    return {
        "n_words": n_words,
        "word_chars": _per_text(in_word & ((data & 0xC0) != 0x80), offsets),
        "n_symbols": _per_text(SYMBOLS[data], offsets),
        "n_dup_lines": _dup_lines(texts, found),
        "n_repeat_words": _repeat_words(found, n_words),
    }


def _dup_lines(texts: Texts, found: Words) -> np.ndarray:
    data, offsets = texts
    if not len(data):
        return np.zeros(len(offsets) - 1, np.int64)
    feeds = np.flatnonzero(data == 0x0A)
    starts = np.unique(np.concatenate((offsets[:-1], feeds + 1)))
    starts = starts[starts < len(data)]
    ends = np.concatenate((starts[1:], [len(data)])).astype(np.int64)
    owners = np.searchsorted(offsets, starts, "right") - 1
    # A line ends before its line feed; the last line of a text has none.
    ends = ends - (data[ends - 1] == 0x0A)
    wordy = np.searchsorted(found.starts, ends) > np.searchsorted(found.starts, starts)
    starts, ends, owners = starts[wordy], ends[wordy], owners[wordy]
    # Only lines of one length and one first word can be equal.
    alike, _ = _repeats(found.hashes[np.searchsorted(found.starts, starts)] + (ends - starts).astype(np.uint64), owners)
    starts, ends, owners = starts[alike], ends[alike], owners[alike]
    _, again = _repeats(hash_spans(data, starts, ends), owners)
    return np.bincount(owners[again], minlength=len(offsets) - 1)


def _repeat_words(found: Words, n_words: np.ndarray) -> np.ndarray:
    hashes = windows(found.hashes, REPEAT_WIDTH)
    owners = np.repeat(np.arange(len(n_words)), n_words)
    whole = owners[: len(hashes)] == owners[REPEAT_WIDTH - 1 :] if len(hashes) else np.zeros(0, bool)
    places = np.flatnonzero(whole)
    twice, _ = _repeats(hashes[places], owners[places])
    change = np.zeros(len(owners) + 1, np.int64)
    np.add.at(change, places[twice], 1)
    np.add.at(change, places[twice] + REPEAT_WIDTH, -1)
    covered = np.cumsum(change[:-1]) > 0
    return np.bincount(owners[covered], minlength=len(n_words))


@held
def worker_runs_of(byte_vocabulary: str, piece_vocabulary: str, limit: int) -> RunPool:
    """The worker's own pool of piece ids, and of token counts under the byte vocabulary; it
    stays for all tasks the worker runs."""
    bpe, model = ByteBpe(byte_vocabulary), load_pieces(piece_vocabulary)

    def encode(opening: list[str], other: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        found = model.encode(opening + other, num_threads=1)
        lengths = np.array([len(x) for x in found], np.int64)
        return np.fromiter(chain.from_iterable(found), np.uint16), lengths, bpe.joined(opening, other)[1]

    return RunPool(encode, limit)


@cache
def byte_pieces(piece_vocabulary: str) -> np.ndarray:
    """Which pieces are single bytes. The line feed does not count: the vocabulary has no
    other piece for it."""
    model = load_pieces(piece_vocabulary)
    marks = np.array([model.is_byte(i) for i in range(model.vocab_size())])
    marks[model.piece_to_id("<0x0A>")] = False
    return marks


def fertility(texts: list[str], runs_of: RunPool, fallback: np.ndarray) -> np.ndarray:
    """The four measures of each text; a text without tokens has zeros."""
    all_ids, first, counted, runs = runs_of.of(texts)
    n_byte = np.add.reduceat(counted, runs[:-1])
    n_fallback = _per_text(fallback[all_ids], first)
    out = np.zeros((len(texts), 4))
    for i, text in enumerate(texts):
        n = int(first[i + 1] - first[i])
        if not n:
            continue
        counts = np.bincount(all_ids[first[i] : first[i + 1]])
        counts = counts[counts > 0]
        entropy = np.log2(n) - np.dot(counts, np.log2(counts)) / n
        out[i] = len(text) / max(n_byte[i], 1), len(text) / n, n_fallback[i] / n, entropy if n >= ENTROPY_TOKENS else ENTROPY_FREE
    return out


def scripts(texts: Texts) -> np.ndarray:
    """The number of each text's most frequent script."""
    n = len(texts.offsets) - 1
    codes = np.frombuffer(texts.data.tobytes().decode().encode("utf-32-le"), np.uint32)
    starts = np.concatenate(([0], np.cumsum((texts.data & 0xC0) != 0x80)))[texts.offsets]
    owners = np.repeat(np.arange(n), np.diff(starts))
    table = np.bincount(owners * len(SCRIPTS) + script_of()[codes], minlength=n * len(SCRIPTS)).reshape(n, -1)
    table[:, 0] = 0
    found = np.where(table.any(axis=1), table.argmax(axis=1), 0)
    marked = np.bincount(owners[marked_letters()[codes]], minlength=n) * MARKED_SHARE >= np.diff(starts)
    return np.where((found == SCRIPTS.index("latin")) & marked, SCRIPTS.index("latin_marked"), found)


def quality_rules(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str | None = "lang",
    bands: Mapping[str, Band] = BANDS,
    latin_languages: Mapping[str, Band] = LATIN_LANGUAGES,
    min_words: int = 10,
    max_repeat_percent: int = 20,
    vocabularies: tuple[str, str] = (BYTE_VOCABULARY, PIECE_VOCABULARY),
    worker_runs: int = WORKER_RUNS,
) -> DataFrame:
    """Per document its id, the base figures, ``base_failed``, the fertility measures, the
    ``band`` it was held against, and ``kept``. ``latin_languages`` holds for texts of the
    band "latin" whose language it names, ``bands`` for all others."""
    rows = documents.select(*{c: None for c in (id_column, text_column, lang_column) if c})
    judged = _judged(rows, id_column, text_column, lang_column, bands, latin_languages, min_words, max_repeat_percent, *vocabularies, worker_runs)
    return judged.select(F.col("_id").alias(id_column), *COUNTS, "base_failed", *MEASURES, "band", "kept")


def keep_good(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str | None = "lang",
    bands: Mapping[str, Band] = BANDS,
    latin_languages: Mapping[str, Band] = LATIN_LANGUAGES,
    min_words: int = 10,
    max_repeat_percent: int = 20,
    vocabularies: tuple[str, str] = (BYTE_VOCABULARY, PIECE_VOCABULARY),
    worker_runs: int = WORKER_RUNS,
) -> DataFrame:
    """The documents that the rules keep, with all their columns; one map, no join."""
    judged = _judged(documents, id_column, text_column, lang_column, bands, latin_languages, min_words, max_repeat_percent, *vocabularies, worker_runs)
    names = {"_id": id_column, "_text": text_column, "_lang": lang_column}
    return judged.where("kept").select(*restored(judged, documents, **names))


def _judged(
    documents: DataFrame,
    id_column: str,
    text_column: str,
    lang_column: str | None,
    bands: Mapping[str, Band],
    latin_languages: Mapping[str, Band],
    min_words: int,
    max_repeat_percent: int,
    byte_vocabulary: str,
    piece_vocabulary: str,
    worker_runs: int,
) -> DataFrame:
    rows, schema = carrying(documents, _id=id_column, _text=text_column, _lang=lang_column)
    limits = {name: tuple(band) for name, band in bands.items()}
    finer = {x: tuple(band) for x, band in latin_languages.items()}

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs_of = worker_runs_of(byte_vocabulary, piece_vocabulary, worker_runs)
        fallback = byte_pieces(piece_vocabulary)
        for batch in batches:
            # Executors hold a worker per core, so little text is taken at once.
            for at, upto in pieces(batch.column(1), PIECE):
                part = batch.slice(at, upto - at)
                texts = text_bytes(part.column(1))
                counts = base_counts(texts)
                measures = fertility([t or "" for t in part.column(1).to_pylist()], runs_of, fallback)
                langs = part.column(2).to_pylist()
                names = [str(x) if str(x) in limits else SCRIPTS[s] for x, s in zip(langs, scripts(texts))]
                edges = [finer.get(str(x), limits[name]) if name == "latin" else limits[name] for x, name in zip(langs, names)]
                edges = np.array(edges).reshape(-1, 4)
                inside = (measures[:, 0] >= edges[:, 0]) & (measures[:, 1] >= edges[:, 1])
                inside &= (measures[:, 2] <= edges[:, 2]) & (measures[:, 3] >= edges[:, 3])
                failed = (counts["n_words"] < min_words) | (
                    100 * counts["n_repeat_words"] > max_repeat_percent * counts["n_words"]
                )
                found = {
                    **{c: pa.array(counts[c], pa.int64()) for c in COUNTS},
                    "base_failed": pa.array(failed),
                    **{m: pa.array(measures[:, i]) for i, m in enumerate(MEASURES)},
                    "band": pa.array(names, pa.string()),
                    "kept": pa.array(~failed & inside),
                }
                yield pa.RecordBatch.from_arrays([*part.columns, *found.values()], [*part.schema.names, *found])

    figures = [*[f"{c} long" for c in COUNTS], "base_failed boolean", *[f"{m} double" for m in MEASURES]]
    return rows.mapInArrow(judge, ", ".join([schema, *figures, "band string", "kept boolean"]))
