"""Language identification by compression.

Every language has a zstandard dictionary of raw content: text of a bounded, labelled
sample. A text is compressed with each dictionary, in segments, so that long texts go on
profiting from it; the language with the fewest bytes wins, and the share by which the
second best is larger is the margin. Narrow margins are rejected. Where only one language
is learned, compression without a dictionary stands for the second best: a text that the
dictionary does not help is rejected.

Defined cases: a NULL text, or one without a letter, is "und" with score 0 and rejected;
equal sizes go to the smaller language name with score 0; whole texts count, whatever
their length; repeated rows are judged each; rows with a NULL language or id teach
nothing; with no labelled rows everything is "und"; an empty table gives an empty result;
other columns are carried along by ``keep_identified``, whatever their names.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybrook.llm.words import carrying, restored

UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")
_OTHERS = re.compile(r"[\W\d_]+")

# The sample: texts per language, characters of each, and bytes of a dictionary.
TEXTS_PER_LANGUAGE = 400
CHARS_PER_TEXT = 1_000
DICTIONARY_BYTES = 1 << 17
LANGUAGES = 1_000

SEGMENT_BYTES = 4096
LEVEL = 6
# Short texts differ by few bytes: they are compressed with every part of the dictionary,
# and the bytes are added up.
SHORT_BYTES, SHORT_PARTS = 512, 8

# A margin below this is narrow.
MIN_MARGIN = 0.004


def learn(
    documents: DataFrame,
    usable: Column,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
    texts_per_language: int = TEXTS_PER_LANGUAGE,
    chars_per_text: int = CHARS_PER_TEXT,
    dictionary_bytes: int = DICTIONARY_BYTES,
    languages: int = LANGUAGES,
) -> dict[str, bytes]:
    """Dictionary content per language out of ``usable`` rows: the texts whose ids hash
    lowest. At most ``languages * texts_per_language`` beginnings of texts reach the driver;
    more languages than that are an error."""
    spark = documents.sparkSession
    labelled = documents.where(usable).select(
        F.col(id_column).alias("id"), F.col(lang_column).cast("string").alias("lang"), F.col(text_column).alias("text")
    ).where("id IS NOT NULL AND lang IS NOT NULL AND text IS NOT NULL")
    counted = labelled.groupBy("lang").agg(F.count("*").alias("n")).limit(languages + 1).collect()
    if len(counted) > languages:
        raise ValueError(f"more than {languages} languages")
    # Of a language with n texts the wanted ones have hashes in about this share of all. A
    # language with too few there, as its ids repeat, is given more of them.
    wide = texts_per_language + 6 * math.sqrt(texts_per_language) + 20
    share = {r.lang: min(1.0, wide / r.n) for r in counted}
    while True:
        bounds = [(lang, min((1 << 63) - 1, int(s * (1 << 64)) - (1 << 63))) for lang, s in share.items()]
        bounded = F.broadcast(spark.createDataFrame(bounds, "of string, bound long"))
        hashed = labelled.select("lang", "id", F.xxhash64("id").alias("hash"))
        low = hashed.join(bounded, (F.col("lang") == F.col("of")) & (F.col("hash") <= F.col("bound"))).select("lang", "hash", "id").distinct()
        found = {r.lang: r["count"] for r in low.groupBy("lang").count().collect()}
        few = [lang for lang, s in share.items() if s < 1 and found.get(lang, 0) < texts_per_language]
        if not few:
            break
        share |= {lang: min(1.0, 4 * share[lang]) for lang in few}
    lowest = Window.partitionBy("lang").orderBy("hash", "id")
    chosen = low.withColumn("place", F.row_number().over(lowest)).where(F.col("place") <= texts_per_language)
    # One row per text of the sample, so its size is bounded.
    chosen = F.broadcast(chosen.select(F.col("lang").alias("of"), F.col("id").alias("of_id")))
    snippet = F.min(F.substring("text", 1, chars_per_text))
    picked = labelled.join(chosen, (F.col("lang") == F.col("of")) & (F.col("id") == F.col("of_id")), "left_semi")
    texts = picked.groupBy("lang", "id").agg(snippet.alias("text")).orderBy("lang", "id")
    content: dict[str, list[str]] = {}
    for row in texts.collect():
        content.setdefault(row.lang, []).append(letters(row.text))
    return {lang: " ".join(found).encode()[:dictionary_bytes] for lang, found in content.items()}


def letters(text: str) -> str:
    """The text in lower case, with one space for all between letters."""
    return _OTHERS.sub(" ", text.lower())


def compressors_of(contents: list[bytes], level: int) -> list[zstandard.ZstdCompressor]:
    found = []
    for content in contents:
        known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        known.precompute_compress(level=level)
        options = {"write_content_size": False, "write_dict_id": False, "write_checksum": False}
        found.append(zstandard.ZstdCompressor(level=level, dict_data=known, **options))
    return found


def bare_compressors(level: int) -> list[zstandard.ZstdCompressor]:
    """Compression without a dictionary."""
    return [zstandard.ZstdCompressor(level=level, write_content_size=False, write_checksum=False)]


def split(content: bytes, parts: int) -> list[bytes]:
    size = -(-len(content) // parts) or 1
    return [content[i : i + size] for i in range(0, len(content), size)] or [b""]


def sizes(data: bytes, languages: list[list[zstandard.ZstdCompressor]], segment: int) -> np.ndarray:
    """Bytes of the text under the dictionaries of each language, on average."""
    parts = [data[i : i + segment] for i in range(0, len(data), segment)]
    return np.array([sum([len(c.compress(p)) for p in parts for c in own]) / len(own) for own in languages])


def identify(
    documents: DataFrame,
    dictionaries: dict[str, bytes],
    id_column: str = "doc_id",
    text_column: str = "text",
    min_margin: float = MIN_MARGIN,
    segment_bytes: int = SEGMENT_BYTES,
    level: int = LEVEL,
) -> DataFrame:
    """Per document its id, ``lang_pred``, ``score`` (the margin, 0 to 1) and ``rejected``."""
    found = _judged(documents.select(id_column, text_column), dictionaries, id_column, text_column, min_margin, segment_bytes, level)
    return found.select(F.col("_id").alias(id_column), "lang_pred", "score", "rejected")


def keep_identified(
    documents: DataFrame,
    dictionaries: dict[str, bytes],
    id_column: str = "doc_id",
    text_column: str = "text",
    min_margin: float = MIN_MARGIN,
    segment_bytes: int = SEGMENT_BYTES,
    level: int = LEVEL,
) -> DataFrame:
    """The documents that are not rejected, with all their columns."""
    found = _judged(documents, dictionaries, id_column, text_column, min_margin, segment_bytes, level)
    return found.where("NOT rejected").select(*restored(found, documents, _id=id_column, _text=text_column))


def _judged(
    documents: DataFrame,
    dictionaries: dict[str, bytes],
    id_column: str,
    text_column: str,
    min_margin: float,
    segment_bytes: int,
    level: int,
) -> DataFrame:
    names = sorted(dictionaries)
    shared = documents.sparkSession.sparkContext.broadcast([dictionaries[n] for n in names])
    rows, schema = carrying(documents, _id=id_column, _text=text_column)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        usual = [compressors_of([content], level) for content in shared.value]
        close = [compressors_of(split(content, SHORT_PARTS), level) for content in shared.value]
        if len(names) == 1:
            usual, close = [*usual, bare_compressors(level)], [*close, bare_compressors(level)]
        for batch in batches:
            langs, scores = [], []
            for value in batch.column(1):
                text = value.as_py()
                lang, score = UNKNOWN, 0.0
                if text and names and _LETTER.search(text):
                    data = letters(text).encode()
                    found = sizes(data, close if len(data) <= SHORT_BYTES else usual, segment_bytes)
                    # The size without a dictionary is no language's.
                    best = int(found[: len(names)].argmin())
                    lang = names[best]
                    score = max(0.0, 1.0 - float(found[best]) / float(np.delete(found, best).min()))
                langs.append(lang)
                scores.append(score)
            score = np.array(scores, np.float64)
            rejected = (score < min_margin) | np.array([x == UNKNOWN for x in langs], bool)
            found = {"lang_pred": pa.array(langs, pa.string()), "score": pa.array(score), "rejected": pa.array(rejected)}
            yield pa.RecordBatch.from_arrays([*batch.columns, *found.values()], [*batch.schema.names, *found])

    return rows.mapInArrow(judge, f"{schema}, lang_pred string, score double, rejected boolean")


def held_out(id_column: str = "doc_id") -> Column:
    """Whether a row is kept from learning: CRC-32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 4 == 2, F.lit(False))
