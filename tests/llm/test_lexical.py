import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tallybrook.llm import lexical
from tallybrook.llm.lexical import Best, Bucket, rank_documents, weights

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def expected(documents, items, k):
    """Ranks by scoring every document for every item."""
    counted = [(i, Counter(terms(t))) for i, t in documents]
    counted = [(i, c) for i, c in counted if c]
    n, total = len(counted), sum(c.total() for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    weight = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for t, d in df.items()}
    asked: dict = {}
    for i, text in items:
        asked.setdefault(i, set()).update(terms(text))
    rows = []
    for item, wanted in asked.items():
        scores = []
        for i, c in counted:
            m = 50 + (50 * c.total() * n) // total
            score = sum(weight[t] * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in wanted if t in c)
            scores += [(-score, i is None, i or 0)] * (score > 0)
        rows += [(item, r, None if null else i, -s) for r, (s, null, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(rows, key=str)


def found(documents, items, **options):
    return sorted(map(tuple, rank_documents(documents, items, **options).collect()), key=str)


@pytest.fixture(scope="module")
def corpus(llm_spark):
    """Zipf-like words, lengths from one word to thousands, a text in a third of the rows."""
    chance = random.Random(11)
    vocabulary = [f"w{i}" for i in range(400)] + ["Ünder", "日本", "MiXed"]
    share = [1 / (i + 1) for i in range(len(vocabulary))]

    def text(n):
        return " ".join(chance.choices(vocabulary, share, k=n))

    copied = text(40)
    documents = [(i, text(int(chance.paretovariate(0.7)) % 3000 + 1)) for i in range(500)]
    documents += [(1000 + i, copied) for i in range(250)] + [(1000, copied), (None, copied), (7, documents[7][1])]
    items = [(i, text(chance.randrange(1, 40))) for i in range(25)] + [(30, copied), (30, "w399 w398"), (None, "w1, w2; MIXED")]
    items += [(31, "nowhere to be found"), (32, None), (33, ""), (34, ", . !")]
    return documents, items


@pytest.mark.parametrize("options", [{}, {"bucket_rows": 16, "first_share": 0.1, "focus": (0.2,)}, {"block_terms": 60, "focus": (1.0,)}, {"k": 3}])
def test_equals_brute_force(llm_spark, corpus, options):
    documents, items = corpus
    docs = llm_spark.createDataFrame(documents, "doc_id long, text string").repartition(5)
    asked = llm_spark.createDataFrame(items, "item_id long, text string")
    assert found(docs, asked, **options) == expected(documents, items, options.get("k", 50))


def test_odd_rows_and_clashing_names(llm_spark, odd, documents):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    asked = [(1, "long text WITHOUT end"), (2, "日本語のテキスト s 12"), (3, None), (4, "x" * 30_000)]
    items = llm_spark.createDataFrame(asked, "item_id long, text string")
    assert found(odd.withColumnRenamed("lang", "score").withColumnRenamed("source", "rank"), items) == expected(rows, asked, 50)
    renamed = odd.select(F.col("doc_id").alias("item"), F.col("text").alias("id"), F.lit(1).alias("n"), F.lit(2).alias("terms"))
    assert found(renamed, items, id_column="item", text_column="id") == expected(rows, asked, 50)


def test_test_tables(llm_spark, documents):
    items = llm_spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    rows, asked = [(r.doc_id, r.text) for r in documents.collect()], [(r.item_id, r.text) for r in items.collect()]
    assert found(documents, items) == expected(rows, asked, 50)


def test_empty_tables(llm_spark, none):
    items = llm_spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert found(none, items) == []
    assert found(llm_spark.createDataFrame([(1, " . ")], "doc_id long, text string"), items) == []
    assert found(llm_spark.createDataFrame([(1, "other words")], "doc_id long, text string"), items) == []
    assert found(llm_spark.createDataFrame([(1, "a")], "doc_id long, text string"), items.where("false")) == []


def test_bounds_hold_and_prune():
    """No document above a threshold is lost, and most of those far below it are not scored."""
    chance = np.random.default_rng(3)
    weight = weights(100_000, chance.integers(1, 100_000, 300))
    places = [np.sort(chance.choice(300, chance.integers(1, 60), replace=False)).astype(np.int32) for _ in range(2000)]
    adds = [chance.integers(1, 900_000, len(p)).astype(np.int32) for p in places]
    norms = [math.sqrt(float((weight[p] * a.astype(float) ** 2).sum())) for p, a in zip(places, adds)]
    kinds = {"id": pa.array(range(2000), pa.int64()), "norm": pa.array(norms), "terms": pa.array([p.tobytes() for p in places])}
    bucket = Bucket(pa.record_batch({**kinds, "impacts": pa.array([a.tobytes() for a in adds])}), weight)
    for _ in range(30):
        terms = chance.choice(300, 20, replace=False)
        terms = terms[np.argsort(-weight[terms], kind="stable")]
        weight_of = np.zeros_like(weight)
        weight_of[terms] = weight[terms]
        scores = bucket.scores(np.arange(2000), weight_of)
        least = int(np.sort(scores)[-50])
        for steps in ([4], [12], [4, 12, 20]):
            kept = bucket.survivors(terms, steps, weight, least)
            assert set(np.flatnonzero(scores >= least)) <= set(kept.tolist())
        assert len(kept) < 250


def test_best_keeps_small_ids_on_ties():
    best = Best(3, 0)
    for start in (9, 6, 3):
        ids = np.arange(start, start + 3)
        best.add(np.full(3, 5), ids, ids == 3)
    assert sorted(best.ids.tolist()) == [4, 5, 6] and best.least == 5
    assert lexical.SEPARATORS.sum() == 128 - 62
