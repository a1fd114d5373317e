"""Latest-wins merge of upsert files, deduplication and picks.

Winners come from an aggregate (max_by) that reduces map-side, not from a window: a key with very many
versions is never sorted in one task. Its struct buffers make it a sort-based aggregate.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the greatest order columns for each key; nulls in the order are least."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("__r")).select(*keys, "__r.*").select(*df.columns)


def winners(parent: DataFrame, key: str, date: str = "file_dt_source", name: str = "file_name_source") -> DataFrame:
    """(key, name): the file whose record of the key is current; equal dates go by name."""
    return parent.groupBy(key).agg(F.max(F.struct(date, name)).alias("__w")).select(key, F.col(f"__w.{name}").alias(name))


def merged(tables: Mapping[str, DataFrame], parent: str, key: str, date: str = "file_dt_source", name: str = "file_name_source") -> dict[str, DataFrame]:
    """Every table with only the rows of each key's winning file; the parent has one row per key.

    Children are replaced wholesale: a child row of an older file never survives.
    """
    if not tables[parent].columns:
        raise ValueError("no input")
    won = winners(tables[parent], key, date, name)
    out = {t: df.join(won, [key, name], "left_semi") for t, df in tables.items()}
    rest = [c for c in tables[parent].columns if c != key]
    out[parent] = out[parent].groupBy(key).agg(F.max(F.struct(*rest)).alias("__r")).select(key, "__r.*").select(*tables[parent].columns)
    return out


def deduplicated(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in a total order."""
    return df.withColumn("__n", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where("__n = 1").drop("__n")


def pick(df: DataFrame, key: str, order: Sequence[Column], columns: Sequence[str]) -> DataFrame:
    """key and columns of the first row of each key; give orders with their nulls last."""
    return deduplicated(df, [key], order).select(key, *columns)


def top_values(df: DataFrame, key: str, value: str, top: int) -> DataFrame:
    """(key, value, n, rank): the most frequent values of each key; ties by value."""
    counts = df.where(F.col(value).isNotNull()).groupBy(key, value).agg(F.count("*").alias("n"))
    order = W.partitionBy(key).orderBy(F.col("n").desc(), F.col(value).asc())
    return counts.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)


def flags(df: DataFrame, key: str, conditions: Mapping[str, Column]) -> DataFrame:
    """One pass over a child table: for each key whether any row meets each condition."""
    return df.groupBy(key).agg(*(F.bool_or(F.coalesce(c, F.lit(False))).alias(n) for n, c in conditions.items()))
