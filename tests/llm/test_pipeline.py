from collections import Counter
from pathlib import Path

import corpus_pipeline as P
import duckdb
import pytest
from pyspark.sql import functions as F
from tallybrook.llm import language, mixing, quality
from tallybrook.llm.queries import ORACLE, QUERIES

from test_jaccard import brute as brute_components


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_agrees_with_sql(llm_spark, sf_dir, name):
    connection = duckdb.connect()
    for table in ("conversations", "embeddings", "documents", "benchmark"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{Path(sf_dir) / table}.parquet')")
    found = QUERIES[name](llm_spark, sf_dir)
    columns = sorted(found.columns)
    relation = connection.sql(ORACLE[name])
    assert sorted(relation.columns) == columns
    places = [relation.columns.index(c) for c in columns]
    expected = Counter(tuple(r[i] for i in places) for r in relation.fetchall())
    assert Counter(tuple(r[c] for c in columns) for r in found.collect()) == expected


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_covers_its_table(llm_spark, sf_dir, documents, name):
    rows = QUERIES[name](llm_spark, sf_dir).collect()
    ids = {r.doc_id for r in documents.collect()}
    found = {r.doc_id for r in rows}
    assert found <= ids and (name.startswith("op9") or (found == ids and len(rows) == len(ids)))


@pytest.fixture(scope="module")
def stages(llm_spark, documents, tmp_path_factory):
    """What goes into and comes out of every stage."""
    folder, docs, seen = tmp_path_factory.mktemp("stages"), documents, []
    for number, (_, stage) in enumerate(P.STAGES):
        stage(llm_spark, docs, "").write.parquet(f"{folder}/{number}")
        out = llm_spark.read.parquet(f"{folder}/{number}")
        seen.append((docs, out))
        docs = out
    return seen


def rows(frame):
    return Counter(map(tuple, frame.collect()))


def test_stages_keep_the_columns(stages):
    for before, after in stages[:-1]:
        assert after.columns == before.columns and after.count() > 0


def test_quality_and_language(stages):
    before, after = stages[0]
    kept = quality.quality_rules(before).where("kept").select("doc_id")
    assert rows(after) == rows(before.join(kept, "doc_id", "left_semi"))
    before, after = stages[1]
    known = language.learn(before, ~language.held_out())
    kept = language.identify(before, known).where("NOT rejected").select("doc_id")
    assert rows(after) == rows(before.join(kept, "doc_id", "left_semi"))


def test_one_of_each_group_stays(stages):
    before, after = stages[2]
    expected = {c for _, c in brute_components([(r.doc_id, r.text) for r in before.collect()], 5, 80).values()}
    assert rows(after) == rows(before.where(F.col("doc_id").isin(list(expected))))


def test_the_mix_takes_effect(stages):
    before, after = stages[3]
    words = lambda f: {r.source: r.n for r in f.groupBy("source").agg(F.sum(F.regexp_count("text", F.lit(mixing.WORD))).alias("n")).collect()}
    targets = mixing.source_targets(words(before), 150, 2)
    taken = words(after)
    # A source of a few documents is met to within one of them.
    longest = {r.source: r.n for r in before.groupBy("source").agg(F.max(F.regexp_count("text", F.lit(mixing.WORD))).alias("n")).collect()}
    assert all(abs(taken.get(s, 0) - t) <= longest[s] for s, t in targets.items())
    assert max(rows(after).values()) == 2 and set(rows(after)) <= set(rows(before))


def test_ids_decode(stages):
    before, after = stages[4]
    assert after.where("NOT lossless").count() == 0 and after.count() == before.count()


def test_run_and_repeated_rows(llm_spark, sf_dir, documents, odd, stages):
    assert P.run(llm_spark, sf_dir).count() == stages[-1][1].count()
    assert P.ORACLE_SQL is None
    frame = documents.unionByName(documents.limit(30)).unionByName(odd, allowMissingColumns=True)
    once = P.near_duplicate_stage(llm_spark, frame, "")
    assert once.columns == documents.columns
    known = rows(once)
    assert max(known.values()) == 1
    # Texts without words link with nothing; the row without an id stays.
    assert {r.doc_id for r in once.collect()} >= {1, 2, 3, None}
    mixed = P.mixing_stage(llm_spark, frame, "")
    assert set(rows(mixed)) <= set(rows(frame))


def test_rows_that_differ_in_one_column_are_rows_of_their_own(llm_spark):
    """Alike in id and text, but not in source or language; some of them repeated."""
    text = " ".join(f"w{i}" for i in range(40))
    other = " ".join(f"v{i}" for i in range(40))
    docs = [(1, text, "en", "a"), (1, text, "en", "b"), (1, text, None, "a"), (1, text, "en", "a"), (2, other, "en", "b"), (2, other, "en", "b")]
    frame = llm_spark.createDataFrame(docs, "doc_id long, text string, lang string, source string")
    mixed = rows(P.mixing_stage(llm_spark, frame, ""))
    assert set(mixed) == set(docs)
    # Source a is met at twice its words, b at what is left of 150 %: its own.
    assert [sum(n for r, n in mixed.items() if r[3] == s) for s in "ab"] == [6, 3]
    # Near duplicates: one document of the group, whichever of the rows that share its id.
    once = rows(P.near_duplicate_stage(llm_spark, frame, ""))
    assert len(once) == 2 and set(once) <= set(docs) and max(once.values()) == 1


def test_a_text_in_a_third_of_the_rows(llm_spark):
    """Its copies are one group; NULL, empty and wordless texts stay by themselves."""
    hot = " ".join(f"hot{i}" for i in range(60))
    docs = [(i, hot if i % 3 == 0 else f"text {i} " + " ".join(f"w{i}x{j}" for j in range(20)), "en", "a") for i in range(1, 121)]
    docs += [(500 + i, t, None, None) for i, t in enumerate([None, "", " \n", None])] + [(None, hot, "en", "a")]
    frame = llm_spark.createDataFrame(docs, "doc_id long, text string, lang string, source string").repartition(6)
    kept = P.near_duplicate_stage(llm_spark, frame, "").collect()
    assert sorted(r.doc_id for r in kept) == sorted([3, *[i for i in range(1, 121) if i % 3], 500, 501, 502, 503])


@pytest.mark.parametrize("stage", [s for _, s in P.STAGES])
def test_stages_of_empty_tables(llm_spark, none, stage):
    out = stage(llm_spark, none, "")
    assert out.collect() == []


def test_ids_are_written_before_they_are_decoded(llm_spark, documents):
    """Two maps in Python in one task are two workers at once, which an executor then keeps."""
    found = P.pieces_stage(llm_spark, documents.limit(40), "")
    assert found._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert found.where("lossless").count() == 40
