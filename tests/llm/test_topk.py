import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from tallybrook.llm.topk import annuli_for, fit_pivots, quantised, top_k


def brute(rows, is_query, k):
    out = []
    for own, (q, v) in enumerate(rows):
        if is_query(q):
            found = sorted((-sum(a * b for a, b in zip(v, w)), i) for m, (i, w) in enumerate(rows) if m != own)[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(found)]
    return sorted(out)


def ours(vectors, k, **options):
    found = top_k(vectors, F.col("id") % 10 == 0, k, **options).collect()
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in found)


@pytest.mark.parametrize("seed, options", [(1, {}), (2, {"pivots": 3, "rings": 2, "slice_rows": 7, "query_rows": 2, "rounds": (1, 3)})])
def test_against_brute_force_with_ties_and_hot_vectors(llm_spark, seed, options):
    random = np.random.default_rng(seed)
    rows = [(i, random.integers(-40, 40, 6).tolist()) for i in range(300)]
    rows += [(i, [3, 3, 3, 3, 3, 3]) for i in range(300, 450)]
    rows += [(450, [900, 0, 0, 0, 0, 0]), (451, [0] * 6)]
    vectors = llm_spark.createDataFrame(rows, "id long, v array<long>").repartition(5)
    assert ours(vectors, 4, **options) == brute(rows, lambda i: i % 10 == 0, 4)


def test_few_candidates_and_one_vector(llm_spark):
    rows = [(10, [1, 2]), (11, [3, 4])]
    assert ours(llm_spark.createDataFrame(rows, "id long, v array<long>"), 5) == [(10, 1, 11, 11)]
    assert ours(llm_spark.createDataFrame(rows[:1], "id long, v array<long>"), 5) == []


def test_unusable_vectors_take_no_part(llm_spark):
    rows = [(1, [0.5, -0.0001], 1), (2, None, 1), (3, [0.1, None], 1), (4, [math.nan, 0.0], 1), (5, [math.inf, 0.0], 1), (None, [1.0, 1.0], 1), (6, [], 1)]
    frame = llm_spark.createDataFrame(rows, "vec_id long, embedding array<float>, id int")
    assert [tuple(r) for r in quantised(frame).collect()] == [(1, [512, -1])]


def test_empty_table(llm_spark):
    assert ours(llm_spark.createDataFrame([], "id long, v array<long>"), 5) == []


def test_equal_rows_make_one_pivot():
    assert len(fit_pivots(np.ones((50, 3)))) == 1


@pytest.mark.parametrize("size", [3_000_000, 1 << 24, 1 << 29])
def test_scores_beyond_32_bits_and_2_to_the_53(llm_spark, size):
    """Products of up to 2 ** 58, which doubles do not hold exactly."""
    random = np.random.default_rng(size)
    rows = [(100, [size, 1, 3]), (1, [1, 1, 0]), (2, [-1, 0, 0])]
    rows += [(i, random.integers(-size, size, 3).tolist()) for i in range(3, 60)] + [(70 + i, [size, i % 3, size]) for i in range(9)]
    assert ours(llm_spark.createDataFrame(rows, "id long, v array<long>"), 10) == brute(rows, lambda i: i % 10 == 0, 10)


def test_products_beyond_64_bits_are_an_error(llm_spark):
    rows = [(10, [1 << 40, 1]), (11, [1 << 40, 2])]
    with pytest.raises(Exception, match="64-bit"):
        ours(llm_spark.createDataFrame(rows, "id long, v array<long>"), 5)


def test_repeated_ids_are_rows_of_their_own(llm_spark):
    rows = [(10, [1, 2]), (10, [3, 4]), (10, [3, 4]), (11, [5, 5]), (11, [5, 5]), (20, [0, 1])]
    found = ours(llm_spark.createDataFrame(rows, "id long, v array<long>").repartition(3), 4)
    assert found == brute(rows, lambda i: i % 10 == 0, 4)


def test_other_columns_may_have_any_name(llm_spark):
    rows = [(1, [0.5, 1.0], 7, 8), (100, [1.0, 1.0], 7, 8)]
    frame = quantised(llm_spark.createDataFrame(rows, "vec_id long, embedding array<double>, v int, row int"))
    assert [tuple(r) for r in top_k(frame, F.col("id") % 100 == 0).collect()] == [(100, 1, 1, 1572864)]


def test_annuli_follow_the_vectors():
    assert annuli_for(10) == (1, 1) and annuli_for(10**9) == (64, 16)
    assert all(p * r >= min(1024, n // 1024) for n in (5_000, 51_282, 400_000, 10**6) for p, r in [annuli_for(n)])
