import random
import re
from collections import defaultdict

from tallybrook.llm.mixing import fit, knapsack, mix_sources, source_targets


def test_targets_are_capped_and_reshared():
    sizes = {"b": 100, "a": 10, None: 50, "c": 0}
    targets = source_targets(sizes, 150, 2)
    # Weights a 5, b 2, c 1, None 5; a stops at 20 and c at 0; the rest is shared 2 : 5.
    assert targets == {"a": 20.0, "c": 0.0, None: 100.0, "b": 120.0}
    assert source_targets({}, 150, 2) == {}


def test_knapsack_is_optimal():
    chance = random.Random(3)
    for _ in range(200):
        lengths = chance.sample(range(1, 30), 5)
        counts = [chance.randint(0, 3) for _ in lengths]
        budget = chance.randint(0, 80)
        sums = {0}
        for n, c in zip(lengths, counts):
            sums = {s + n * i for s in sums for i in range(c + 1)}
        chosen = knapsack(lengths, counts, budget)
        assert all(0 < n <= counts[i] for i, n in chosen.items())
        assert sum(lengths[i] * n for i, n in chosen.items()) == max(s for s in sums if s <= budget)


def test_fit_meets_large_budgets():
    chance = random.Random(5)
    lengths = list(range(1, 900, 3))
    counts = [chance.randint(1, 2000) for _ in lengths]
    total = sum(n * c for n, c in zip(lengths, counts))
    for budget in (0, 1, 777, total // 3, total - 1, total, total + 9):
        taken = fit(lengths, counts, budget, window=4096)
        assert all(0 <= t <= c for t, c in zip(taken, counts))
        assert sum(n * t for n, t in zip(lengths, taken)) == min(budget, total)
    assert fit([10], [5], 25) == [2]


def figures(rows):
    sums = defaultdict(int)
    for r in rows:
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.copies * r.size
        sums[r.source_size, r.target] += r.taken
    return sums


def test_mix_of_documents(documents):
    rows = mix_sources(documents).collect()
    texts = {r.doc_id: r.text for r in documents.collect()}
    assert {r.doc_id: r.size for r in rows} == {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in texts.items()}
    sizes = defaultdict(list)
    for r in documents.collect():
        sizes[r.source].append(len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")))
    # With so few documents the nearest sum can be found by trying all.
    best = defaultdict(set)
    for found in sizes.values():
        sums = {0}
        for n in found:
            sums |= {s + n for s in sums}
        best[sum(found)] |= {p * sum(found) + s for s in sums for p in (0, 1)}
    for (size, target), taken in figures(rows).items():
        assert taken in best[size] and abs(taken - target) <= min(abs(s - round(target)) for s in best[size]) + 1
    assert sorted(rows) == sorted(mix_sources(documents.repartition(7)).collect())


def test_hot_length_is_dealt_over_buckets(llm_spark):
    rows = [(i, "w w w", "a") for i in range(9000)] + [(9000 + i, "w " * (i % 9), "b") for i in range(4000)]
    frame = llm_spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = mix_sources(frame).collect()
    assert len(found) == 13_000
    assert all(abs(taken - target) <= 2 for (_, target), taken in figures(found).items())
    again, other = mix_sources(frame.repartition(3)).collect(), mix_sources(frame, seed=30).collect()
    assert sorted(found) == sorted(again) != sorted(other)


def test_odd_rows(odd, none):
    rows = mix_sources(odd.withColumnRenamed("lang", "size")).collect()
    assert len(rows) == odd.count()
    assert {r.doc_id: r.size for r in rows if r.size == 0} == {1: 0, 2: 0, 3: 0}
    assert mix_sources(none).collect() == []
