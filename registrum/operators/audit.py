"""Grouping audits: samples with evidence, sensitivity to variants, co-location and verdict scores."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.stats import quantiles, ranked, rounded, safe_corr, wilson
from ..session import written
from . import grouping, merge
from .profile import WEIGHTS, weighted_score

#: fixed values: strata of operation sizes (from, below, how many), and the largest that are always taken
STRATA = ((20, 100, 45), (100, 1000, 35), (1000, None, 20))
FORCED = 5


def hash_sample(df: DataFrame, key: str, n: int) -> DataFrame:
    """The n rows that come first by md5 of their key: the same in every engine and run."""
    return df.orderBy(F.md5(F.col(key).cast("string")), key).limit(n)


def audit_sample(ops: DataFrame, key: str = "op_key", size: str = "n_marks", strata: Sequence[tuple] = STRATA, forced: int = FORCED) -> DataFrame:
    """key, size and stratum (0 for the largest): the forced ones, then each stratum's first by sha1 of their key."""
    top = ops.select(key, size).orderBy(F.col(size).desc(), F.col(key).asc()).limit(forced).withColumn("stratum", F.lit(0))
    rest = ops.select(key, size).join(F.broadcast(top.select(key)), key, "left_anti")  # `forced` rows
    stratum, quota = F.lit(None).cast("int"), F.lit(0)
    for k, (lo, hi, q) in enumerate(strata, 1):
        inside = (F.col(size) >= lo) if hi is None else (F.col(size) >= lo) & (F.col(size) < hi)
        stratum, quota = F.when(inside, F.lit(k)).otherwise(stratum), F.when(inside, F.lit(q)).otherwise(quota)
    rest = rest.withColumns({"stratum": stratum, "__q": quota}).where("stratum is not null")
    order = W.partitionBy("stratum").orderBy(F.sha1(F.col(key).cast("string")), F.col(key))
    rest = rest.withColumn("__n", F.row_number().over(order)).where(F.col("__n") <= F.col("__q"))
    return top.unionByName(rest.select(key, size, "stratum"))


def names_at(rows: DataFrame, addr: str, name: str, at: Sequence | DataFrame, top: int = 10) -> DataFrame:
    """(addr, name, n, rank): the most frequent names at each of the given addresses, a list of keys or a table of them."""
    wanted = at if isinstance(at, DataFrame) else rows.sparkSession.createDataFrame([(a,) for a in at], f"`{addr}` {dict(rows.dtypes)[addr]}")
    return merge.top_values(rows.join(wanted.select(addr).distinct(), addr, "left_semi"), addr, name, top)


def variants_compared(base: DataFrame, variants: Mapping[str, grouping.Variant], key: str, name: str, addr: str, aggregates: Mapping[str, Column], min_marks: int, weights: Mapping[str, float] = WEIGHTS, top: int = 100) -> DataFrame:
    """One row per variant: its sensitivity summary, and against the first variant the rank correlation of filing scores and the Jaccard of top deciles and of the `top` operations' filings."""
    scores: dict[str, DataFrame] = {}
    heads: dict[str, DataFrame] = {}
    out = None
    base = measured(base, list(variants.values()), name, addr)
    for label, variant in variants.items():
        ops, filings = filing_scores(base, variant, name, addr, aggregates, min_marks, weights)
        filings = written(filings.select(key, "op_key", "score"), "filings")
        best = ops.orderBy(F.col("score").desc(), F.col("n_marks").desc(), F.col("op_key").asc()).limit(top).select("op_key")
        scores[label] = written(filings.groupBy(key).agg(F.max("score").alias("score")), "scores")
        heads[label] = filings.join(F.broadcast(best), "op_key", "left_semi").select(key).distinct()  # `top` rows
        first = next(iter(variants))
        row = sensitivity_summary(ops, filings).select(F.lit(label).alias("variant"), "*")
        both = heads[first].withColumn("a", F.lit(1)).join(heads[label].withColumn("b", F.lit(1)), key, "full")
        head = both.agg(F.try_divide(F.count_if(F.col("a").isNotNull() & F.col("b").isNotNull()).cast("double"), F.count("*").cast("double")).alias("top_jaccard"))
        row = row.join(spearman(scores[first], scores[label], key, "score")).join(top_decile_jaccard(scores[first], scores[label], key, "score")).join(head)  # one row each
        out = row if out is None else out.unionByName(row)
    return out


def evidence(members: DataFrame, key: str, values: Mapping[str, int]) -> DataFrame:
    """key and, for each value column, an array of its most frequent values with their counts."""
    out = members.select(key).distinct()
    for c, top in values.items():
        found = merge.top_values(members, key, c, top).groupBy(key).agg(F.array_sort(F.collect_list(F.struct("rank", F.col(c).cast("string").alias("value"), "n"))).alias(c))
        out = out.join(found, key, "left")
    return out


def measured(base: DataFrame, variants: Sequence[grouping.Variant], name: str, addr: str) -> DataFrame:
    """base with the degrees that the variants need, written once for all of them."""
    return written(grouping.measured(base, variants, name, addr), "measured")


#: rows that one task of an aggregation by operation gets, about; an operation of more is not left to one task
TASK_ROWS = 1_000_000


def by_operation(rows: DataFrame, *aggregates: Column) -> DataFrame:
    """aggregates of each op_key; every row moves once, as it is.

    Distinct counts would move a buffer for each row by key and value, and one more by key.
    An operation of over TASK_ROWS rows, or a thousandth of all, takes that way, so it is spread over all tasks.
    """
    total = rows.count()
    parts, tracked = max(rows.sparkSession.sparkContext.defaultParallelism, -(-total // TASK_ROWS)), 1000
    large: list[str] = []
    if total > TASK_ROWS:
        top = rows.agg(F.expr(f"approx_top_k(op_key, {tracked}, {16 * tracked})").alias("t")).first()["t"]  # for balance only: any list gives the same rows
        large = [x["item"] for x in top if x["count"] > max(TASK_ROWS, total // tracked)]
    if not large:
        return rows.repartition(parts, "op_key").groupBy("op_key").agg(*aggregates)
    inside = F.col("op_key").isin(large)
    few = rows.where(inside).groupBy("op_key").agg(*aggregates)
    return rows.where(~inside).repartition(parts, "op_key").groupBy("op_key").agg(*aggregates).unionByName(few)


def filing_scores(base: DataFrame, variant: grouping.Variant, name: str, addr: str, aggregates: Mapping[str, Column], min_marks: int, weights: Mapping[str, float] = WEIGHTS) -> tuple[DataFrame, DataFrame]:
    """(operations with score, filings with op_key and score) under one grouping variant; base may come from measured()."""
    rows = grouping.laddered(base if "__nd" in base.columns else measured(base, [variant], name, addr), variant, name=name, addr=addr)
    ops = by_operation(rows, F.count("*").alias("n_marks"), *(v.alias(k) for k, v in aggregates.items())).where(F.col("n_marks") >= min_marks)
    ops = written(ops.withColumn("score", rounded(weighted_score(weights))), "operations")
    return ops, rows.join(ops.select("op_key", "score"), "op_key")


def sensitivity_summary(ops: DataFrame, filings: DataFrame) -> DataFrame:
    """One row: operations, p50 and p90 of their score, filings, and filings in operations of score 0.5 or more."""
    a = ops.agg(F.count("*").alias("n_ops")).join(quantiles(ops, "score", {"p50": 0.5, "p90": 0.9}, digits=6))
    b = filings.agg(F.count("*").alias("n_filings"), F.coalesce(F.sum(F.when(F.col("score") >= 0.5, 1)), F.lit(0)).cast("long").alias("filings_scored"))
    return a.join(b)  # one row each


def spearman(left: DataFrame, right: DataFrame, key: str, value: str) -> DataFrame:
    """One row: shared keys and the correlation of minimum ranks; null where either side does not vary."""
    both = written(left.select(key, F.col(value).alias("a")).join(right.select(key, F.col(value).alias("b")), key), "ranks")
    both = ranked(ranked(both, "a", "ra"), "b", "rb").withColumns({"ra": F.col("ra").cast("double"), "rb": F.col("rb").cast("double")})
    return both.agg(F.count("*").alias("n_shared"), safe_corr("ra", "rb").alias("spearman"))


def top_decile_jaccard(left: DataFrame, right: DataFrame, key: str, value: str) -> DataFrame:
    """One row: Jaccard of the keys at or over each side's own 90th percentile; a missing side counts as outside."""

    def flagged(df: DataFrame, out: str) -> DataFrame:
        df = written(df.select(key, value), "decile")
        cut = quantiles(df, value, {"__c": 0.9}, digits=6)
        return df.join(F.broadcast(cut)).select(key, (F.col(value) >= F.col("__c")).alias(out))  # one row

    both = flagged(left, "a").join(flagged(right, "b"), key, "full")
    a, b = F.coalesce("a", F.lit(False)), F.coalesce("b", F.lit(False))
    return both.agg(F.try_divide(F.count_if(a & b).cast("double"), F.nullif(F.count_if(a | b), F.lit(0)).cast("double")).alias("jaccard"))


def colocated(rows: DataFrame, addr: str, name: str, aggregates: Mapping[str, Column], score: Column, min_filings: int = 5, name_hub: int = 50, addr_hub: int = 25, top: int = 200, in_turn: bool = False) -> DataFrame:
    """Addresses where several non-hub names meet and at least one scores high.

    Groups (addr, name) of min_filings or more are scored; names at more than name_hub
    addresses and addresses of more than addr_hub names are left out; kept are addresses
    with two names or more and a best score of at least the groups' 75th percentile.
    An address's names are counted with the hubs among them, or without if in_turn.
    Columns: addr, n_names, n_peculiar (score of that percentile or more), max_score, n_filings.
    """
    live = rows.where(F.col(addr).isNotNull() & F.col(name).isNotNull())
    clear = live.join(written(grouping.hubs(live, name, addr, name_hub), "hubs"), name, "left_anti")
    live = clear.join(grouping.hubs(clear if in_turn else live, addr, name, addr_hub), addr, "left_anti")
    groups = live.groupBy(addr, name).agg(F.count("*").alias("n"), *(v.alias(k) for k, v in aggregates.items())).where(F.col("n") >= min_filings).withColumn("score", rounded(score))
    groups = written(groups.select(addr, name, "n", "score"), "groups")
    cut = quantiles(groups, "score", {"p75": 0.75}, digits=6).select(F.coalesce("p75", F.lit(1e9)).alias("p75"))
    per = groups.join(F.broadcast(cut)).groupBy(addr, "p75").agg(F.count("*").alias("n_names"), F.count_if(F.col("score") >= F.col("p75")).alias("n_peculiar"), F.max("score").alias("max_score"), F.sum("n").alias("n_filings"))  # one row of cut
    per = per.where((F.col("n_names") >= 2) & (F.col("max_score") >= F.col("p75"))).drop("p75")
    return per.orderBy(F.col("n_peculiar").desc(), F.col("max_score").desc(), F.col("n_filings").desc(), F.col(addr).asc()).limit(top)


def verdict_scores(verdicts: DataFrame, sample: DataFrame, strata: Sequence[tuple] = STRATA) -> DataFrame:
    """stratum ('all' or its label), counts by verdict, precision and its Wilson bounds.

    verdicts: op_key, verdict; sample: op_key, n_marks.  An empty verdict is unreviewed, an
    unknown one invalid, one for an operation outside the sample stale.
    """
    v = F.trim(F.coalesce("verdict", F.lit("")))
    kind = F.when(F.col("n_marks").isNull(), "stale").when(v == "", "unreviewed").when(v.isin("coherent", "mixed", "unclear"), v).otherwise("invalid")
    rows = verdicts.join(sample.select("op_key", "n_marks"), "op_key", "left").withColumn("kind", kind)
    label = F.lit(None).cast("string")
    for lo, hi, _ in strata:
        inside = (F.col("n_marks") >= lo) if hi is None else (F.col("n_marks") >= lo) & (F.col("n_marks") < hi)
        label = F.when(inside, F.lit(f"{lo}+" if hi is None else f"{lo}-{hi - 1}")).otherwise(label)
    rows = rows.withColumn("stratum", F.explode(F.array(F.lit("all"), label))).where("stratum is not null")
    kinds = ("coherent", "mixed", "unclear", "unreviewed", "invalid", "stale")
    out = rows.groupBy("stratum").agg(*(F.count_if(F.col("kind") == k).alias(k) for k in kinds))
    n = F.col("coherent") + F.col("mixed")
    lo, hi = wilson(F.col("coherent"), n)
    return out.withColumns({"precision": rounded(F.try_divide(F.col("coherent").cast("double"), F.nullif(n, F.lit(0)).cast("double"))), "wilson_lo": lo, "wilson_hi": hi})
