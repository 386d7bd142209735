"""Reconciliation by a tree of checksums: equal key ranges are not read again.

A node stands for a range of keys and holds the number of its rows and a checksum that
does not depend on their order; a node of the next level stands for ``fanout`` of them.
Trees of source and target are compared from the root on, level by level, below nodes that
differ alone, and rows are read in full only in leaves that differ: their key ranges are
predicates that reach the scan. Trees are tables: a side's tree may be written once, kept
with the data, and compared as often as wanted.

A checksum is the exclusive or of the rows' 64-bit hashes and the sum of a second, 32-bit
one; two ranges that differ in rows and agree in both, and in the number of rows, are taken
for equal.

Defined cases: NULL keys are in a leaf of their own, which is always read, as they never
match another row; keys may be negative; tables may be empty.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column as C
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybrook.operators.reconcile import reconcile_diff

LEAF_KEYS, FANOUT, LEVELS = 1 << 12, 16, 4
# Leaves up to this number are read by their key ranges; beyond it their rows are joined to
# the leaves. The result is the same.
RANGES = 1_000
# Nodes of a level that may differ; beyond it the tables are compared in full.
MOST = 100_000

SUMS = ("rows", "xor", "sum")


def _part(column: str, width: int) -> C:
    """The whole part of a number divided by a width, also of negative ones."""
    return F.expr(f"(`{column}` - pmod(`{column}`, {width})) div {width}").cast("bigint")


def hash_tree(
    rows: DataFrame, key: str, columns: list[str], leaf_keys: int = LEAF_KEYS, fanout: int = FANOUT, levels: int = LEVELS
) -> DataFrame:
    """Nodes (level, node, rows, xor, sum) of the rows; leaves have level 0. The rows are
    read once, and only sums by leaf are shuffled."""
    # Hashes pass over NULLs, so each column goes in together with whether it is NULL.
    row = [F.col(key), *[c for name in columns for c in (F.col(name), F.col(name).isNull())]]
    leaves = rows.groupBy(_part(key, leaf_keys).alias("node")).agg(
        F.count("*").alias("rows"), F.bit_xor(F.xxhash64(*row)).alias("xor"), F.sum(F.hash(*row).cast("bigint")).alias("sum")
    )
    # A leaf counts for the node above it on every level.
    up = F.array(*[F.struct(F.lit(n).alias("level"), _part("node", fanout**n).alias("node")) for n in range(levels)])
    placed = leaves.select(F.explode(up).alias("at"), *SUMS).select("at.level", "at.node", *SUMS)
    return placed.groupBy("level", "node").agg(F.sum("rows").alias("rows"), F.bit_xor("xor").alias("xor"), F.sum("sum").alias("sum"))


def _differing(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """Nodes of one level that are not the same on both sides."""
    other = theirs.select(F.col("node").alias("of"), *[F.col(c).alias(f"_{c}") for c in SUMS])
    both = ours.join(other, F.col("node").eqNullSafe(F.col("of")), "full_outer")
    same = F.lit(True)
    for c in SUMS:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    # A node that only one side has: the join gives a NULL for the other's name.
    return both.where(~same).select(F.coalesce("node", "of").alias("node"))


def differing_leaves(
    source: DataFrame, target: DataFrame, fanout: int = FANOUT, levels: int = LEVELS, most: int = MOST
) -> list[int | None] | None:
    """Leaves that differ, from the top level down; the leaf None holds NULL keys. Nothing
    is told apart (None for the list) where more than ``most`` nodes of a level differ."""
    found: list[int | None] | None = None
    for level in reversed(range(levels)):
        sides = [tree.where(F.col("level") == level) for tree in (source, target)]
        if found is not None:
            parent = _part("node", fanout)
            known = [n for n in found if n is not None]
            below = parent.isin(known) if known else F.lit(False)
            sides = [s.where(below | F.col("node").isNull() if None in found else below) for s in sides]
        found = [r.node for r in _differing(*sides).limit(most + 1).collect()]
        if not found:
            return []
        if len(found) > most:
            return None
    return found


def in_leaves(rows: DataFrame, key: str, leaves: Iterable[int | None], leaf_keys: int = LEAF_KEYS, ranges: int = RANGES) -> DataFrame:
    """The rows of some leaves, neighbouring ones as one range of keys."""
    leaves = list(leaves)
    numbered = sorted(n for n in leaves if n is not None)
    runs: list[list[int]] = []
    for n in numbered:
        if runs and runs[-1][1] == n - 1:
            runs[-1][1] = n
        else:
            runs.append([n, n])
    wanted = F.col(key).isNull() if None in leaves else F.lit(False)
    if len(runs) <= ranges:
        for first, last in runs:
            wanted = wanted | F.col(key).between(first * leaf_keys, (last + 1) * leaf_keys - 1)
        return rows.where(wanted)
    listed = rows.sparkSession.createDataFrame([(n,) for n in numbered], "_leaf bigint")
    some = rows.join(listed, _part(key, leaf_keys) == F.col("_leaf"), "left_semi")
    return some.unionByName(rows.where(F.col(key).isNull())) if None in leaves else some


def reconcile_tree(
    source: DataFrame,
    target: DataFrame,
    key: str,
    columns: list[str],
    source_tree: DataFrame | None = None,
    target_tree: DataFrame | None = None,
    leaf_keys: int = LEAF_KEYS,
    fanout: int = FANOUT,
    levels: int = LEVELS,
    most: int = MOST,
) -> DataFrame:
    """What ``reconcile_diff`` gives, out of the leaves that differ. Trees that are not
    given are computed; given ones must have the same shape and columns."""
    shape = {"leaf_keys": leaf_keys, "fanout": fanout, "levels": levels}
    trees = [
        tree if tree is not None else hash_tree(rows, key, columns, **shape)
        for rows, tree in ((source, source_tree), (target, target_tree))
    ]
    leaves = differing_leaves(*trees, fanout, levels, most)
    if leaves is None:
        return reconcile_diff(source, target, key, columns)
    # NULL keys never match, so equal checksums say nothing of them.
    leaves = {*leaves, None}
    some = [in_leaves(rows, key, leaves, leaf_keys) for rows in (source, target)]
    return reconcile_diff(*some, key, columns)
