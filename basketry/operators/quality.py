"""Table constraints of the metadata store, checked as Spark aggregations (Q1-Q3).

Each check returns rows ``(table, column, rule, violations)``; a clean table
gives zero counts. Keys are counted with partial aggregation, foreign keys
together with the keys they refer to, ranges and lengths with one aggregate
pass per table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .. import schemas as S

# Integer ranges of the store's unsigned column types.
TINYINT_U = (0, 255)
SMALLINT_U = (0, 65535)
MEDIUMINT_U = (0, 16777215)
INT_U = (0, 4294967295)

# The store's table definitions.
PRIMARY_KEYS = {"user": S.COMP_MEMBER_ID, "product": S.PRODUCT_NO, "category": S.CATEGORY_NO}
NOT_NULL = {"user": [S.MEMBER_ID]}
FOREIGN_KEYS = [  # (child table, column, parent table, parent column)
    ("deal_item", S.DEAL_NO, "product", S.PRODUCT_NO),
    ("deal_item", S.ITEM_NO, "product", S.PRODUCT_NO),
    ("prod_category", S.PRODUCT_NO, "product", S.PRODUCT_NO),
    ("prod_category", S.CATEGORY_NO, "category", S.CATEGORY_NO),
]
RANGES = {  # table -> [(column, (lo, hi))]
    "user": [(S.SEX, TINYINT_U), (S.AGE, SMALLINT_U)],
    "product": [(S.PRODUCT_NO, INT_U), (S.PRICE, INT_U)],
    "category": [(S.CATEGORY_NO, MEDIUMINT_U), (S.DEPTH1_NO, MEDIUMINT_U), (S.DEPTH2_NO, MEDIUMINT_U),
                 (S.DEPTH0_DISPLAY_ORDER, TINYINT_U), (S.DEPTH1_DISPLAY_ORDER, TINYINT_U),
                 (S.DEPTH2_DISPLAY_ORDER, TINYINT_U)],
    "deal_item": [(S.DEAL_NO, INT_U), (S.ITEM_NO, INT_U)],
    "prod_category": [(S.PRODUCT_NO, INT_U), (S.CATEGORY_NO, MEDIUMINT_U)],
}
MAX_LENGTHS = {  # table -> [(column, max characters)]
    "user": [(S.COMP_MEMBER_ID, 5), (S.MEMBER_ID, 64)],
    "product": [(S.PRODUCT_NAME, 200), (S.DEAL_CONSTRUCTION, 700)],
    "category": [(S.DEPTH0_NAME, 30), (S.DEPTH1_NAME, 30), (S.DEPTH2_NAME, 30)],
}

RESULT_COLUMNS = ["table", "column", "rule", "violations"]


def _rows(df: DataFrame, table: str, checks: list[tuple[str, str, Column]]) -> DataFrame:
    """One aggregate pass: count rows where each condition holds; one output row per check."""
    aggs = [F.sum(F.when(cond, 1).otherwise(0)).cast("long").alias(f"c{i}") for i, (_, _, cond) in enumerate(checks)]
    rows = [F.struct(F.lit(table).alias("table"), F.lit(col).alias("column"), F.lit(rule).alias("rule"),
                     F.coalesce(F.col(f"c{i}"), F.lit(0)).cast("long").alias("violations"))
            for i, (col, rule, _) in enumerate(checks)]
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def _null_checks(table: str, key: str) -> list[tuple[str, str, Column]]:
    return [(key, "null_key", F.col(key).isNull())] + [(c, "not_null", F.col(c).isNull()) for c in NOT_NULL.get(table, [])]


def _duplicate_keys(df: DataFrame, table: str, key: str) -> DataFrame:
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.where(F.col(key).isNotNull() & (F.col("_n") > 1)).agg(F.sum("_n").alias("c")) \
        .select(F.lit(table).alias("table"), F.lit(key).alias("column"), F.lit("duplicate_key").alias("rule"),
                F.coalesce(F.col("c"), F.lit(0)).cast("long").alias("violations"))


def _range_checks(df: DataFrame, table: str) -> list[tuple[str, str, Column]]:
    checks = [(c, f"range {lo}..{hi}", F.col(c).isNotNull() & ~F.col(c).cast("long").between(lo, hi))
              for c, (lo, hi) in RANGES.get(table, []) if c in df.columns]
    return checks + [(c, f"length <= {n}", F.char_length(F.col(c)) > n)
                     for c, n in MAX_LENGTHS.get(table, []) if c in df.columns]


def primary_key_violations(df: DataFrame, table: str, key: str | None = None) -> DataFrame:
    """Q1: rows whose key is null, rows whose key occurs more than once, NOT NULL columns."""
    key = key or PRIMARY_KEYS[table]
    return _duplicate_keys(df, table, key).unionByName(_rows(df, table, _null_checks(table, key)))


def _references(tables: dict[str, DataFrame]) -> dict[tuple[str, str], list[tuple[str, str]]]:
    """Parent (table, column) -> its children (table, column), where both tables are given."""
    out = {}
    for child, col, parent, pcol in FOREIGN_KEYS:
        if child in tables and parent in tables:
            out.setdefault((parent, pcol), []).append((child, col))
    return out


def _orphans(tables: dict[str, DataFrame], parent: str, pcol: str, children: list[tuple[str, str]]) -> DataFrame:
    """Child rows without a parent, by child: parent and child keys in one tagged union, counted by key in one shuffle.

    Each table is read once. Rows merge by key before the shuffle, so a hot key crosses it once per task.
    """
    tags = {name: [i for i, (child, _) in enumerate(children) if child == name] for name, _ in children}
    counts = lambda at: [F.lit(1 if i == at else 0).cast("long").alias(f"c{i}") for i in range(len(children))]
    keys = tables[parent].select(F.col(pcol).alias("key"), F.lit(True).alias("parent"), *counts(None))
    for name, at in tags.items():
        rows = F.array(*[F.struct(F.col(children[i][1]).alias("key"), F.lit(False).alias("parent"), *counts(i)) for i in at])
        keys = keys.unionByName(tables[name].select(F.inline(rows)))
    per_key = keys.where(F.col("key").isNotNull()).groupBy("key").agg(
        F.max("parent").alias("parent"), *[F.sum(f"c{i}").alias(f"c{i}") for i in range(len(children))])
    rows = [F.struct(F.lit(child).alias("table"), F.lit(col).alias("column"), F.lit(f"references {parent}.{pcol}").alias("rule"),
                     F.coalesce(F.col(f"c{i}"), F.lit(0)).cast("long").alias("violations")) for i, (child, col) in enumerate(children)]
    return per_key.where(~F.col("parent")).agg(*[F.sum(f"c{i}").alias(f"c{i}") for i in range(len(children))]).select(F.inline(F.array(*rows)))


def foreign_key_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """Q2: child rows whose non-null key has no parent row; one aggregate per parent key."""
    return reduce(DataFrame.unionByName, [_orphans(tables, *parent, children) for parent, children in _references(tables).items()])


def range_violations(df: DataFrame, table: str) -> DataFrame:
    """Q3: values outside the unsigned range of their type, strings over their length."""
    return _rows(df, table, _range_checks(df, table))


def all_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """Q1-Q3 of all ``tables``: per table one aggregate for nulls, ranges and lengths and one
    count per key; one count of parent and child keys for each referenced key."""
    parts = []
    for t, df in tables.items():
        key = PRIMARY_KEYS.get(t)
        parts.append(_rows(df, t, (_null_checks(t, key) if key else []) + _range_checks(df, t)))
        if key:
            parts.append(_duplicate_keys(df, t, key))
    if _references(tables):
        parts.append(foreign_key_violations(tables))
    return reduce(DataFrame.unionByName, parts)
