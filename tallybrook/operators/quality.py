"""Integrity rules as queries that list what breaks them."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column as C
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybrook.functions.measures import line_value
from tallybrook.operators.skew import join_many_to_one
from tallybrook.schema import TABLES, TableSpec


def check_unique(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Values held by more than one row; NULLs are not compared."""
    whole = reduce(C.__and__, [F.col(c).isNotNull() for c in columns])
    return rows.where(whole).groupBy(*columns).agg(F.count("*").alias("copies")).where(F.col("copies") > 1)


def check_unique_columns(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """Repeated values of the key and of every unique column, in one pass."""
    pairs = [
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
        for c in (spec.key, *spec.unique)
    ]
    return check_unique(rows.select(F.inline(F.array(*pairs))), ["column_name", "value"])


def _broken(rows: DataFrame, spec: TableSpec, rules: list[tuple[str, str, C]]) -> DataFrame:
    """One row per broken rule, all rules in one pass: (key, column_name, rule, value)."""
    if not rules:
        rules = [(spec.key, "none", F.lit(False))]
    found = [
        F.when(
            broken,
            F.struct(
                F.lit(column).alias("column_name"),
                F.lit(rule).alias("rule"),
                F.col(column).cast("string").alias("value"),
            ),
        )
        for column, rule, broken in rules
    ]
    return rows.select(spec.key, F.inline(F.array_compact(F.array(*found))))


def check_domain(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """Values outside the set a column allows."""
    return _broken(rows, spec, _domain_rules(spec))


def _domain_rules(spec: TableSpec) -> list[tuple[str, str, C]]:
    return [(c.name, "domain", ~F.col(c.name).isin(*c.domain)) for c in spec.columns if c.domain]


def check_range(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """Numbers below their bound and texts over their length."""
    return _broken(rows, spec, _range_rules(spec))


def _range_rules(spec: TableSpec) -> list[tuple[str, str, C]]:
    rules = [(c.name, "range", ~F.expr(c.check)) for c in spec.columns if c.check]
    return rules + [(c.name, "length", F.char_length(c.name) > c.max_length) for c in spec.columns if c.max_length]


def check_not_null(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """NULLs per column that must have none, counted in one pass over the table."""
    required = [c.name for c in spec.columns if c.not_null]
    counts = rows.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("nulls")) for c in required]
    return counts.select(F.inline(F.array(*pairs))).where(F.col("nulls") > 0)


def check_foreign_key(children: DataFrame, parents: DataFrame, column: str, parent_key: str) -> DataFrame:
    """Rows that refer to a parent that is not there; NULL refers to nothing."""
    keys = parents.select(F.col(parent_key).alias(column))
    referring = children.where(F.col(column).isNotNull())
    return join_many_to_one(referring, keys, column, "left_anti").select(*children.columns)


def check_references(tables: Mapping[str, DataFrame]) -> dict[tuple[str, str], DataFrame]:
    """Rows with a missing parent, for every declared reference between given tables."""
    return {
        (name, key.column): check_foreign_key(
            tables[name], tables[key.parent], key.column, TABLES[key.parent].key
        )
        for name in tables
        for key in TABLES[name].foreign_keys
        if key.parent in tables
    }


def check_tables(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Every value set, bound, length and uniqueness rule of all given tables that is
    broken: (table_name, key, column_name, rule, value); of a repeated value, ``key`` is NULL.

    Every table is read once: what is to be unique and what is broken leave it together, and
    all of it is counted in one shuffle of numbered rules and values."""
    named: list[tuple[str, str, str]] = []
    found = []
    for name, rows in tables.items():
        spec = TABLES[name]

        def entry(column: str, rule: str, key: C, when: C, name: str = name) -> C:
            named.append((name, column, rule))
            number = F.lit(len(named)).alias("number")
            return F.when(when, F.struct(number, key.cast("bigint").alias("key"), F.col(column).cast("string").alias("value")))

        entries = [entry(c, rule, F.col(spec.key), broken) for c, rule, broken in (*_domain_rules(spec), *_range_rules(spec))]
        entries += [entry(c, "unique", F.lit(None), F.col(c).isNotNull()) for c in (spec.key, *spec.unique)]
        found.append(rows.select(F.inline(F.array_compact(F.array(*entries)))))
    counted = reduce(DataFrame.unionByName, found).groupBy("number", "key", "value").agg(F.count("*").cast("int").alias("copies"))
    names = F.array(*[F.struct(*[F.lit(x).alias(n) for n, x in zip(("table_name", "column_name", "rule"), entry)]) for entry in named])
    told = counted.withColumn("of", F.element_at(names, F.col("number")))
    # A rule is broken by every row that breaks it, and a value is repeated once.
    times = F.when(F.col("of.rule") != "unique", F.col("copies")).when(F.col("copies") > 1, 1).otherwise(0)
    each = told.withColumn("time", F.explode(F.array_repeat(F.lit(0), times)))
    return each.select("of.table_name", "key", "of.column_name", "of.rule", "value")


def check_nulls(tables: Mapping[str, DataFrame]) -> DataFrame:
    """NULLs per table and column that must have none."""
    counted = [
        check_not_null(rows, TABLES[name]).select(F.lit(name).alias("table_name"), "column_name", "nulls")
        for name, rows in tables.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def missing_parents(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows without their parent, per declared reference: how many, and of how many values."""
    counted = [
        rows.agg(F.count("*").alias("rows"), F.count_distinct(column).alias("parents")).select(
            F.lit(name).alias("table_name"), F.lit(column).alias("column_name"), "rows", "parents"
        )
        for (name, column), rows in check_references(tables).items()
    ]
    return reduce(DataFrame.unionByName, counted)


def check_one_to_one(parents: DataFrame, children: DataFrame, key: str) -> DataFrame:
    """Parents with no child or with several, and how many."""
    counts = children.groupBy(key).agg(F.count("*").alias("_n"))
    matched = parents.select(key).join(counts, key, "left")
    return matched.select(key, F.coalesce("_n", F.lit(0)).alias("children")).where(F.col("children") != 1)


def check_order_totals(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Orders whose total is not the sum of their lines. Lines are summed per order
    ahead of the join, so an order with very many lines weighs one row in it."""
    sums = items.groupBy("order_id").agg(F.sum(line_value()).alias("items_total"))
    compared = orders.select("order_id", "total_amount").join(sums, "order_id", "left")
    total = F.coalesce("items_total", F.lit(0).cast("decimal(31,2)"))
    return compared.select("order_id", "total_amount", total.alias("items_total")).where(
        ~F.col("total_amount").eqNullSafe(F.col("items_total"))
    )
