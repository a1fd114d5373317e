"""Publish gates and the data profile of a build."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: fixed values: the date gate
DATE_FLOOR = "1870-01-01"
SHORT_AHEAD_DAYS, LONG_AHEAD_YEARS = 120, 40
TOLERANCE = 0.001
FUTURE_LONG = frozenset({"renewal_dt", "for_reg_exp_dt", "for_renewal_dt", "for_renewal_exp_dt", "ir_renewal_dt", "ir_death_dt", "ir_auto_reg_dt", "irregularity_reply_by_dt"})
FUTURE_SHORT = frozenset({"publication_dt", "registration_dt", "ir_publication_dt", "ir_registration_dt"})


class GateError(RuntimeError):
    """All failures of a build together."""

    def __init__(self, failures: list[str]):
        self.failures = failures
        super().__init__("the build does not pass its gates:\n  - " + "\n  - ".join(failures))


def duplicated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: keys that stand more than once."""
    return df.groupBy(*keys).count().where("count > 1").agg(F.count("*").alias("duplicated_keys"))


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str, name: str) -> DataFrame:
    """One row: child rows without a parent."""
    keys = parent.select(F.col(parent_key).alias(child_key))  # an anti join needs no distinct keys
    return child.join(keys, child_key, "left_anti").agg(F.count("*").alias("orphans")).select(F.lit(name).alias("child"), "orphans")


def date_outliers(df: DataFrame, table: str, ceilings: Mapping[str, str], floor: str = DATE_FLOOR) -> DataFrame:
    """(table_name, column_name, below, above, total, failed) of every date column, in one pass.

    ceilings: column to its greatest allowed date.  total counts nulls too.
    """
    aggs = [F.count("*").alias("total")]
    for c, top in ceilings.items():
        d = F.col(c).cast("date")
        aggs += [F.count_if(d < F.lit(floor).cast("date")).alias(f"b_{c}"), F.count_if(d > F.lit(top).cast("date")).alias(f"a_{c}")]
    rows = F.explode(F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(f"b_{c}").alias("below"), F.col(f"a_{c}").alias("above")) for c in ceilings)))
    out = df.agg(*aggs).select("total", rows.alias("r")).select(F.lit(table).alias("table_name"), "r.*", "total")
    return out.withColumn("failed", F.coalesce((F.col("below") + F.col("above")) > TOLERANCE * F.col("total"), F.lit(False)))


def ceiling_of(column: str, today: str) -> str:
    """The greatest allowed date of a column on a given day."""
    from datetime import date, timedelta

    day = date.fromisoformat(today)
    if column in FUTURE_LONG:
        try:
            return day.replace(year=day.year + LONG_AHEAD_YEARS).isoformat()
        except ValueError:
            return day.replace(year=day.year + LONG_AHEAD_YEARS, day=28).isoformat()
    return (day + timedelta(days=SHORT_AHEAD_DAYS if column in FUTURE_SHORT else 0)).isoformat()


def unknown_sources(df: DataFrame, column: str, known: DataFrame) -> DataFrame:
    """Distinct source names that are not among the known ones."""
    return df.select(column).where(F.col(column).isNotNull()).distinct().join(known.select(F.col(known.columns[0]).alias(column)), column, "left_anti")


def null_rates(df: DataFrame, table: str, columns: Sequence[str] | None = None) -> DataFrame:
    """(table_name, column_name, null_rate) to six places; one pass for all columns."""
    names = list(columns or df.columns)
    one = df.agg(*(F.avg(F.col(c).isNull().cast("double")).alias(f"c{k}") for k, c in enumerate(names)))
    rows = F.explode(F.array(*(F.struct(F.lit(c).alias("column_name"), (F.floor(F.col(f"c{k}") * 1e6 + 0.5) / 1e6).alias("null_rate")) for k, c in enumerate(names))))
    return one.select(rows.alias("r")).select(F.lit(table).alias("table_name"), "r.*")


def volume(now: DataFrame, before: DataFrame, *by: str) -> DataFrame:
    """(by, n, n_before, failed) of two states of a table: a group, or without groups the table, that lost rows has failed."""
    a = now.groupBy(*by).agg(F.count("*").alias("n"))
    b = before.groupBy(*by).agg(F.count("*").alias("n_before"))
    both = a.join(b, list(by), "full") if by else a.join(b)  # one row each
    n = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return both.select(*by, n("n"), n("n_before")).withColumn("failed", F.col("n") < F.col("n_before"))


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, n) of every table; empty ones count 0."""
    return reduce(DataFrame.unionByName, (df.agg(F.count("*").alias("n")).select(F.lit(t).alias("table_name"), "n") for t, df in tables.items()))


def date_profile(tables: Mapping[str, DataFrame], today: str) -> DataFrame:
    """date_outliers() of every table's date columns."""
    dated = {t: [c for c, k in df.dtypes if k == "date" and c != "file_dt_source"] for t, df in tables.items()}
    return reduce(DataFrame.unionByName, (date_outliers(df, t, {c: ceiling_of(c, today) for c in dated[t]}) for t, df in tables.items() if dated[t]))


def failures(tables: Mapping[str, DataFrame], parent: str, key: str, dates: DataFrame, known_sources: DataFrame | None = None, previous: DataFrame | None = None) -> list[str]:
    """What each gate finds, all gates together; empty if the build passes.  Only counts reach the driver.

    dates: date_profile(); previous: the parent table of the released build.
    """
    out = []
    twice = duplicated_keys(tables[parent], [key]).first()[0]
    if twice:
        out.append(f"{parent}: {twice} repeated keys")
    for t, df in tables.items():
        if t != parent and (n := orphans(df, tables[parent], key, key, t).first()["orphans"]):
            out.append(f"{t}: {n} rows without a {parent}")
    out += [f"{r.table_name}.{r.column_name}: {r.below} early and {r.above} late dates in {r.total} rows" for r in dates.where("failed").collect()]
    if previous is not None and (r := volume(tables[parent], previous).first()).failed:
        out.append(f"{parent}: {r.n} rows, {r.n_before} before")
    if known_sources is not None:
        for t, df in tables.items():
            if n := unknown_sources(df, "file_name_source", known_sources).count():
                out.append(f"{t}: {n} source files are unknown")
    return out
