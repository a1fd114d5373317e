"""Non-transitive entity grouping by two signals with hub suppression.

A signal that meets too many values of the other one is a hub.  A record takes its name
unless that is a hub, else its address unless that is a hub, else whatever it has.
Degrees are distinct counts; records are joined to hubs only.  While these are few, they are
broadcast, and the large side is not shuffled by a hub key.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written


@dataclass(frozen=True)
class Variant:
    """mode: name_first, addr_first, name_only or addr_only; a degree above the cap makes a hub."""

    mode: str
    name_cap: int = 50
    addr_cap: int = 25


VARIANTS = {
    "shipped": Variant("name_first"),
    "strict_hubs": Variant("name_first", 25, 12),
    "loose_hubs": Variant("name_first", 100, 50),
    "addr_first": Variant("addr_first"),
    "name_only": Variant("name_only"),
    "addr_only": Variant("addr_only"),
}


#: a table of so many hubs or fewer goes to all executors; records meet a larger one by a shuffle
BROADCAST_ROWS = 1_000_000


def hubs(df: DataFrame, signal: str, other: str, cap: int) -> DataFrame:
    """Values of signal that meet more than cap values of other; pairs are made distinct first."""
    pairs = df.where(F.col(signal).isNotNull() & F.col(other).isNotNull()).select(signal, other).distinct()
    return pairs.groupBy(signal).agg(F.count("*").alias("degree")).where(F.col("degree") > cap).select(signal)


def _signal(df: DataFrame, c: str) -> Column:
    """The column as a signal: empty texts are none."""
    return F.nullif(F.col(c), F.lit("")) if df.schema[c].dataType.typeName() == "string" else F.col(c)


def _met(rows: DataFrame, lists: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """rows with the degrees of each (signal, list); a list's other column is __key.

    Lists are written first, so their sizes are known before any record moves.  Those met by a
    shuffle come first, so that no record carries along what a broadcast list gives it.
    """
    lists = [(signal, written(found, "degrees")) for signal, found in lists]
    for n, signal, found in sorted(((found.count(), signal, found) for signal, found in lists), key=lambda x: -x[0]):
        found = F.broadcast(found) if n <= BROADCAST_ROWS else found.hint("merge")  # BROADCAST_ROWS at most
        rows = rows.join(found, _signal(rows, signal) == found["__key"], "left").drop("__key")
    return rows


def measured(df: DataFrame, variants: Sequence[Variant], name: str = "name", addr: str = "addr") -> DataFrame:
    """df with __nd and __ad, the degrees of its signals where these exceed the least cap of the variants.

    Distinct pairs are found once, for both degrees and all variants.
    """
    ladders = [v for v in variants if v.mode in ("name_first", "addr_first")]
    if not ladders:
        return df.withColumns({"__nd": F.lit(None).cast("long"), "__ad": F.lit(None).cast("long")})
    pairs = df.select(_signal(df, name).alias("__n"), _signal(df, addr).alias("__a"))
    pairs = written(pairs.where("__n is not null and __a is not null").distinct(), "pairs")
    over = lambda key, degree, cap: pairs.groupBy(F.col(key).alias("__key")).agg(F.count("*").alias(degree)).where(F.col(degree) > cap)
    lists = [(name, over("__n", "__nd", min(v.name_cap for v in ladders))), (addr, over("__a", "__ad", min(v.addr_cap for v in ladders)))]
    return _met(df, lists).select(*df.columns, "__nd", "__ad")


def laddered(rows: DataFrame, variant: Variant, out: str = "op_key", name: str = "name", addr: str = "addr") -> DataFrame:
    """Rows of measured() with out added; rows with neither signal are left out."""
    n, a = F.concat(F.lit("N:"), _signal(rows, name).cast("string")), F.concat(F.lit("A:"), _signal(rows, addr).cast("string"))
    good_n, good_a = F.when(F.coalesce("__nd", F.lit(0)) <= variant.name_cap, n), F.when(F.coalesce("__ad", F.lit(0)) <= variant.addr_cap, a)
    ladder = {"name_only": n, "addr_only": a, "name_first": F.coalesce(good_n, good_a, n, a), "addr_first": F.coalesce(good_a, good_n, a, n)}[variant.mode]
    return rows.withColumn(out, ladder).where(F.col(out).isNotNull()).drop("__nd", "__ad")


def assigned(df: DataFrame, variant: Variant, name: str = "name", addr: str = "addr", out: str = "op_key") -> DataFrame:
    """df with out added, as N:<name> or A:<addr>; rows with neither signal are left out.  Empty signals count as none."""
    return laddered(measured(df, [variant], name, addr), variant, out, name, addr)
