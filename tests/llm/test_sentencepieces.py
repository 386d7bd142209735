from collections import Counter

import corpus_pipeline
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from tallybrook.llm.runs import load_pieces, runs
from tallybrook.llm.sentencepieces import VOCABULARY, Paths, _merge_few, _merge_many, decode_ids, encode_texts, segment, vocabulary_of
from tallybrook.llm.words import mix


def test_without_dropout_the_library_agrees(documents, odd):
    model = load_pieces(VOCABULARY)
    rows = encode_texts(documents.select("doc_id", "text").union(odd.select("doc_id", "text")), rate=0.0).collect()
    for r in rows:
        # The library takes U+2581 for a space; here it stays itself.
        if r.text is not None and "▁" not in r.text:
            assert r.ids == model.encode(r.text)


@pytest.mark.parametrize("rate", [0.0, 0.3, 1.0])
def test_lossless(documents, odd, rate):
    rows = decode_ids(encode_texts(documents.select("doc_id", "text").union(odd.select("doc_id", "text")), rate=rate))
    assert rows.where(~F.col("text").eqNullSafe(F.col("decoded"))).count() == 0
    assert {r.doc_id: r.ids for r in rows.where("doc_id < 3 AND (text IS NULL OR text = '')").collect()} == {1: None, 2: []}


def test_seeds_and_places_vary_and_reruns_repeat(documents):
    def ids(seed):
        return {r.doc_id: r.ids for r in encode_texts(documents.repartition(3), seed=seed).collect()}

    first = ids(1)
    assert first == ids(1)
    assert sum(first[i] != x for i, x in ids(2).items()) > 0.9 * len(first)


def test_every_variant_is_a_merge_path():
    vocabulary = vocabulary_of(VOCABULARY)
    found = {tuple(segment("international", vocabulary, 0.3, key)) for key in range(200)}
    assert len(found) > 10
    assert {b"".join(vocabulary.bytes[i] for i in ids) for ids in found} == {b" international"}
    # With every merge skipped, characters remain.
    assert len(segment("international", vocabulary, 1.0)) == 14


def test_both_agendas_agree():
    vocabulary = vocabulary_of(VOCABULARY)
    for run in ("international", "a▁b c  d", "aaaaaaaaaaaaaaaa", "日本語のテキスト", "x\0y", "thththththth-the,the"):
        for rate, key in ((0.0, 0), (0.1, 1), (0.4, 2), (0.9, 3)):
            word, limit = hash_of(run, key), int(rate * (1 << 64))
            symbols = ["▁", *run]
            assert _merge_few(list(symbols), vocabulary.ranks, word, limit) == _merge_many(list(symbols), vocabulary.ranks, word, limit)


def hash_of(run, key):
    return xxhash.xxh3_64_intdigest(run.encode(), key)


def test_columns_are_kept_and_replaced(llm_spark, none):
    rows = llm_spark.createDataFrame([(1, "a b", 7, "x")], "doc_id long, text string, ids int, `odd name` string")
    out = encode_texts(rows)
    assert out.columns == ["doc_id", "text", "odd name", "ids"]
    assert decode_ids(out.withColumn("decoded", F.lit(1))).first().decoded == "a b"
    assert decode_ids(encode_texts(none)).collect() == []


def test_runs_join_to_their_text():
    for text in ("a b", " a", "a  b", "a \n b c", "", " ", "a ▁ b c", "\t x y"):
        assert " ".join(runs(text)) == text


def test_every_occurrence_draws_its_own_path(llm_spark):
    """Long words vary from place to place, from document to document and by copy."""
    rows = llm_spark.createDataFrame([(d, "international " * 40, c) for d in (1, 2) for c in (1, 2)], "doc_id long, text string, c int")
    found = {(r.doc_id, r.c): r.ids for r in encode_texts(rows, copy_column="c").collect()}
    assert len(set(map(tuple, found.values()))) == 4
    vocabulary = vocabulary_of(VOCABULARY)
    paths = Paths(VOCABULARY, 0.1, 1000)
    for run in ("international", "an internationally known"):
        ids, lengths = paths.of([run] * 200, mix(np.arange(200)))
        outcomes = {tuple(x) for x in np.split(ids.tolist(), np.cumsum(lengths)[:-1])}
        assert len(outcomes) > 8
        assert {b"".join(vocabulary.bytes[i] for i in x).decode() for x in outcomes} == {f" {run}"}


@pytest.mark.parametrize("rate", [0.1, 0.4, 1.0])
def test_columns_and_agenda_draw_alike(rate):
    """Each outcome is as frequent as under a hash per candidate."""
    vocabulary, n = vocabulary_of(VOCABULARY), 20_000
    for run in ("other", "x▁y", "nations", "ጤና☃s"):
        ids, lengths = Paths(VOCABULARY, rate, 0).of([run] * n, mix(np.arange(n)))
        columns = Counter(tuple(x) for x in np.split(ids.tolist(), np.cumsum(lengths)[:-1]))
        agenda = Counter(tuple(segment(run, vocabulary, rate, hash_of(str(k), 5))) for k in range(n))
        for outcome in columns | agenda:
            assert abs(columns[outcome] - agenda[outcome]) < 6 * max(columns[outcome], agenda[outcome], 9) ** 0.5 + 1


def test_copies_of_the_mix_differ(llm_spark):
    rows = [(1, "en", "a", "international committees negotiate " * 20)] * 3 + [(2, None, None, None)] * 2
    out = corpus_pipeline.pieces_stage(llm_spark, llm_spark.createDataFrame(rows, "doc_id long, lang string, source string, text string"), "").collect()
    assert len(out) == 5 and all(r.lossless for r in out)
    assert len({tuple(r.ids) for r in out if r.doc_id == 1}) == 3
