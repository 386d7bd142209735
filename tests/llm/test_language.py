import zlib

import pytest
import zstandard
from pyspark.sql import functions as F
from tallybrook.llm import language as L
from tallybrook.llm.language import LEVEL, SEGMENT_BYTES, SHORT_BYTES, SHORT_PARTS, identify, learn, letters, split


@pytest.fixture(scope="module")
def many(llm_spark):
    return llm_spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


@pytest.fixture(scope="module")
def known(many):
    return L.learn(many, ~L.held_out())


def test_held_out_accuracy(many, known):
    rows = L.identify(many, known).join(many.select("doc_id", "lang"), "doc_id").where(L.held_out()).collect()
    assert len(rows) > 200
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.97
    assert sum(r.rejected for r in rows) / len(rows) < 0.02
    assert all(0 <= r.score <= 1 and r.lang_pred in known for r in rows)


def test_only_usable_rows_teach(many, known):
    spoiled = many.withColumn("lang", F.when(L.held_out(), F.lit("zz")).otherwise(F.col("lang")))
    assert L.learn(spoiled, ~L.held_out()) == known
    assert L.learn(many.repartition(5).withColumn("source", F.lit("x")), ~L.held_out()) == known
    assert {k: len(v) for k, v in L.learn(many, ~L.held_out(), texts_per_language=2, chars_per_text=50).items()}.keys() == known.keys()


def test_the_fold(many):
    rows = many.select("doc_id", L.held_out().alias("out")).collect()
    assert all(r.out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)


def test_odd_rows(odd, none, known):
    found = {r.doc_id: r for r in L.identify(odd.withColumnRenamed("lang", "score"), known).collect()}
    assert len(found) == odd.select("doc_id").distinct().count()
    assert {i for i, r in found.items() if r.lang_pred == "und"} == {1, 2, 3, 10}
    assert all(r.rejected and r.score == 0 for r in found.values() if r.lang_pred == "und")
    assert L.identify(none, known).collect() == []
    assert all(r.lang_pred == "und" for r in L.identify(odd, {}).collect())
    assert L.learn(none, ~L.held_out()) == {}


def test_narrow_margins_are_rejected(many, known):
    same = {"a": known["en"], "b": known["en"]}
    rows = L.identify(many.limit(20), same).collect()
    assert all(r.rejected and r.lang_pred == "a" and r.score == 0 for r in rows)


def test_keep_identified_keeps_columns(many, known):
    frame = many.withColumnRenamed("n_chars", "rejected")
    good = {r.doc_id for r in L.identify(frame, known).where("NOT rejected").collect()}
    kept = L.keep_identified(frame, known)
    assert kept.schema == frame.schema
    assert {tuple(r) for r in kept.collect()} == {tuple(r) for r in frame.collect() if r.doc_id in good}


def test_a_corpus_of_one_language_is_kept(many):
    english = many.where("lang = 'en'")
    known = L.learn(english, ~L.held_out())
    assert list(known) == ["en"]
    rows = L.identify(english, known).where(L.held_out()).collect()
    assert len(rows) > 50 and sum(r.rejected for r in rows) / len(rows) < 0.02
    assert all(r.lang_pred == "en" and 0 <= r.score <= 1 for r in rows if not r.rejected)
    noise = english.sparkSession.createDataFrame([(1, "ጤና ይስጥልኝ እንደምን አላችሁ ዛሬ")], "doc_id long, text string")
    assert [r.rejected for r in L.identify(noise, known).collect()] == [True]


def test_more_languages_than_the_limit_are_an_error(llm_spark):
    rows = [(i, f"text of language {i % 7}", f"l{i % 7}") for i in range(70)]
    frame = llm_spark.createDataFrame(rows, "doc_id long, text string, lang string")
    with pytest.raises(ValueError, match="more than 6"):
        learn(frame, F.lit(True), languages=6, texts_per_language=1)
    assert sorted(learn(frame, F.lit(True), languages=7, texts_per_language=1)) == [f"l{i}" for i in range(7)]


def test_the_sample_is_of_the_lowest_hashes(llm_spark):
    """Against ranking all ids; one id, and one language, have a third of all rows."""
    rows = [(5 if i % 3 == 0 else i, f"w{i}", "many" if i % 3 else "hot") for i in range(6000)]
    rows += [(10_000 + i, f"v{i}", "few") for i in range(3)] + [(None, "x", "many"), (1, None, "many"), (1, "y", None)]
    frame = llm_spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    hashed = {r.doc_id: r.h for r in frame.select("doc_id", F.xxhash64("doc_id").alias("h")).distinct().collect()}
    expected = {}
    for lang in ("many", "hot", "few"):
        ids = sorted({i for i, t, x in rows if x == lang and i is not None and t}, key=lambda i: (hashed[i], i))[:9]
        texts = {i: min(t for j, t, x in rows if j == i and x == lang and t) for i in ids}
        expected[lang] = " ".join(letters(texts[i]) for i in sorted(ids)).encode()
    assert learn(frame, F.lit(True), texts_per_language=9) == expected


def test_sizes_decide_as_stated(llm_spark):
    """Every document against compressing it with each dictionary on its own."""
    learned = {"aa": b"the cat sat on the mat and the dog sat on the log " * 20, "bb": b"le chat est sur le tapis et le chien est sur le banc " * 20}
    texts = ["the dog sat on the mat", "le chien est sur le tapis", "The CAT, and the log. " * 90, "12 34", "zz qq xx jj ww", "le chat the cat"]
    frame = llm_spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in identify(frame, learned).collect():
        data = letters(texts[row.doc_id]).encode()
        if not any(c.isalpha() for c in texts[row.doc_id]):
            assert (row.lang_pred, row.score, row.rejected) == ("und", 0.0, True)
            continue
        found = {}
        for lang, content in learned.items():
            parts = split(content, SHORT_PARTS) if len(data) <= SHORT_BYTES else [content]
            own = [zstandard.ZstdCompressor(level=LEVEL, write_content_size=False, write_dict_id=False, write_checksum=False,
                   dict_data=zstandard.ZstdCompressionDict(p, dict_type=zstandard.DICT_TYPE_RAWCONTENT)) for p in parts]
            found[lang] = sum(len(c.compress(data[i : i + SEGMENT_BYTES])) for c in own for i in range(0, len(data), SEGMENT_BYTES)) / len(own)
        best = min(sorted(found), key=found.get)
        other = next(n for lang, n in found.items() if lang != best)
        assert row.lang_pred == best and abs(row.score - max(0.0, 1 - found[best] / other)) < 0.02
