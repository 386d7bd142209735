"""Joins whose many-side may have hot keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPREAD = "_spread"


def join_many_to_one(
    many: DataFrame, one: DataFrame, key: str, how: str = "inner", keep_spread: bool = False
) -> DataFrame:
    """Join rows to their parent, where very many rows may share one parent.

    AQE splits such a key over several tasks, but only between two plain shuffles. Parents
    out of ``latest`` are partitioned by the key already, so Spark would shuffle the other
    side alone and leave the hot key in one task. A second key column, derived from the
    first, makes it shuffle both.

    ``keep_spread`` keeps that column: an aggregate that groups by it, next to the key,
    uses the partitioning of the join and needs no further shuffle.
    """
    # Few values, so that shuffles compress it to nothing.
    spread = F.pmod(F.hash(key), F.lit(16)).cast("byte")
    joined = many.withColumn(SPREAD, spread).join(one.withColumn(SPREAD, spread), [key, SPREAD], how)
    return joined if keep_spread else joined.drop(SPREAD)
