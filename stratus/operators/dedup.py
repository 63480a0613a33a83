"""Keep-first dedup and duplicate-key accounting.

Null keys compare equal (a null key is one group), as in pandas.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, Window

from stratus.schema import KEY_COLUMNS

DEFAULT_ORDER = ["file_path", "split_start", "row_id"]


def dedup_keep_first(df: DataFrame, keys: list[str] = KEY_COLUMNS,
                     order: list[str] = DEFAULT_ORDER) -> DataFrame:
    """Keep the first row of each key in input order.

    ``row_number() == 1`` lets Spark insert a partial ``WindowGroupLimit``
    before the shuffle, so each map task ships at most one row per key (a hot
    key costs one row per task, not its whole group).
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def same_keys(a: DataFrame, b: DataFrame, keys: list[str]) -> list:
    """Null-safe equality of the keys of two frames."""
    return [a[k].eqNullSafe(b[k]) for k in keys]


def repeated_keys(df: DataFrame, keys: list[str] = KEY_COLUMNS, order: str = "pos") -> DataFrame:
    """Keys that stand on several rows, with their first row's ``order``.

    Keys are counted in a hash aggregate first; only rows of repeated keys are
    looked at for the first, in a partial and a final step, so neither a key on
    a third of the rows nor many keys on one row gather in a task.
    """
    many = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1).select(*keys)
    rows = df.select(*keys, order)
    rows = rows.join(many, same_keys(rows, many, keys), "left_semi")
    return rows.groupBy(*keys).agg(F.min(order).alias("_first"))


def key_counts(df: DataFrame, keys: list[str] = KEY_COLUMNS) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def duplicates_all(df: DataFrame, keys: list[str] = KEY_COLUMNS) -> DataFrame:
    """Rows that belong to a repeated key (every member counted)."""
    return (key_counts(df, keys)
            .agg(F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).cast("long")
                 .alias("duplicates")))


def duplicates_extra(df: DataFrame, keys: list[str] = KEY_COLUMNS) -> DataFrame:
    """Rows beyond the first of each key."""
    return (key_counts(df, keys)
            .agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("duplicates")))


def unique_key_violations(df: DataFrame, keys: list[str] = KEY_COLUMNS) -> DataFrame:
    """K8: keys held by more than one row, with their row count."""
    return key_counts(df, keys).filter(F.col("n") > 1)


def assert_unique(df: DataFrame, keys: list[str] = KEY_COLUMNS) -> None:
    """K8 (raise form): fail like a unique-index build when a key repeats."""
    bad = unique_key_violations(df, keys).limit(1).collect()
    if bad:
        raise ValueError(f"duplicate key {[bad[0][k] for k in keys]}")
