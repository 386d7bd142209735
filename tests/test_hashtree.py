"""Reconciliation by a tree of checksums."""

import random

import pytest

from tallybrook.operators import hashtree as h
from tallybrook.operators.reconcile import reconcile_diff

ROWS = "id BIGINT, a STRING, b INT"
SHAPE = {"leaf_keys": 8, "fanout": 4, "levels": 3}


def sides(spark, n=400, seed=1, changes=6):
    draw = random.Random(seed)
    ours = [(i * 3 - 300, draw.choice(["x", "y", None]), draw.choice([1, None])) for i in range(n)] + [(None, "k", 1)]
    theirs = list(ours)
    for _ in range(changes):
        at = draw.randrange(n)
        theirs[at] = draw.choice([(theirs[at][0], "z", 1), (theirs[at][0], None, theirs[at][2]), (theirs[at][0] + 1, "x", 1)])
    draw.shuffle(theirs)
    return spark.createDataFrame(ours, ROWS), spark.createDataFrame(theirs[: n - 1], ROWS)


@pytest.mark.parametrize("options", [{}, {"most": 0}])
def test_equals_the_full_comparison(spark, options):
    ours, theirs = sides(spark)
    full = sorted(map(str, reconcile_diff(ours, theirs, "id", ["a", "b"]).collect()))
    assert full and sorted(map(str, h.reconcile_tree(ours, theirs, "id", ["a", "b"], **SHAPE, **options).collect())) == full


def test_only_leaves_that_differ_are_read(spark, tmp_path, capsys):
    rows = spark.range(-4000, 4000).selectExpr("id", "CAST(id % 7 AS STRING) AS a", "CAST(id % 5 AS INT) AS b")
    rows.write.parquet(f"{tmp_path}/source")
    source = spark.read.parquet(f"{tmp_path}/source")
    target = source.where("id <> 77").selectExpr("id", "IF(id IN (-9, 200), 'other', a) AS a", "b")
    trees = [h.hash_tree(t, "id", ["a", "b"], **SHAPE) for t in (source, target)]
    leaves = h.differing_leaves(*trees, fanout=4, levels=3)
    assert sorted(leaves) == [-2, 9, 25]
    assert h.in_leaves(source, "id", leaves, 8).count() == 24
    h.in_leaves(source, "id", leaves, 8).explain()
    pushed = capsys.readouterr().out.split("PushedFilters: [")[1].split("]")[0]
    assert "GreaterThanOrEqual(id,-16)" in pushed and "GreaterThanOrEqual(id,72)" in pushed
    assert h.in_leaves(source, "id", leaves, 8, ranges=1).count() == 24
    assert h.differing_leaves(trees[0], trees[0], 4, 3) == []
    assert h.reconcile_tree(source, source, "id", ["a", "b"], **SHAPE).count() == 0


def test_order_does_not_matter_and_nulls_count(spark):
    ours = spark.createDataFrame([(1, None, 1), (2, "a", None), (None, "n", 1)], ROWS)
    tree = lambda f: sorted(map(str, h.hash_tree(f, "id", ["a", "b"], **SHAPE).collect()))
    assert tree(ours) == tree(ours.orderBy("a").repartition(3))
    moved = spark.createDataFrame([(1, "1", None), (2, "a", None), (None, "n", 1)], ROWS)
    assert tree(ours) != tree(moved)
    # NULL keys never match: their leaf differs where their rows do.
    other = spark.createDataFrame([(1, None, 1), (2, "a", None), (None, "m", 1)], ROWS)
    assert h.differing_leaves(*[h.hash_tree(f, "id", ["a", "b"], **SHAPE) for f in (ours, other)], 4, 3) == [None]


def test_empty_tables(spark):
    none, some = spark.createDataFrame([], ROWS), spark.createDataFrame([(5, "a", 1)], ROWS)
    assert h.reconcile_tree(none, none, "id", ["a", "b"], **SHAPE).collect() == []
    assert [tuple(r) for r in h.reconcile_tree(some, none, "id", ["a", "b"], **SHAPE).collect()] == [(5, "missing")]
