"""Monthly composition series, interrupted time series and difference in differences.

Series are aggregates in Spark; the regressions run on the driver, over at most a few
hundred monthly rows.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.stats import rate
from .merge import flags
from .profile import COINED, MARKETPLACE_CLASSES, goods_items, owner_pick

#: fixed values
BREAKS = (("fee_2017", "2017-04-01"), ("counsel_rule_2019", "2019-08-01"), ("tma_2021", "2021-12-01"))
SERIES_START, TAIL_TRIM = "2013-01-01", 2
METRICS = ("coined_rate", "marketplace_rate", "cn_share", "use1a_rate", "mean_goods", "log_volume")


def trimmed_months(df: DataFrame, date: str, start: str, tail: int = TAIL_TRIM) -> DataFrame:
    """df with ym, the first of the month, from start on and without the last `tail` months, which still fill."""
    last = df.agg(F.add_months(F.trunc(F.max(F.col(date).cast("date")), "MM"), -(tail - 1)).alias("__end"))
    rows = df.withColumn("ym", F.trunc(F.col(date).cast("date"), "MM")).where(F.col(date).cast("date") >= F.lit(start).cast("date"))
    return rows.join(F.broadcast(last)).where(F.col("ym") < F.col("__end")).drop("__end")  # one row


def event_series(tables: Mapping[str, DataFrame], features: DataFrame) -> DataFrame:
    """Twelve monthly columns; filings without a feature row count as not coined."""
    market = flags(tables["intl_class"].where(F.col("intl_class_cd").isin(*MARKETPLACE_CLASSES)), "serial_no", {"mkt": F.lit(True)})
    rows = trimmed_months(tables["case_file"], "filing_dt", SERIES_START)
    for child in (features.select("serial_no", "coined_token_max"), owner_pick(tables["owner"]), market, goods_items(tables["statement"])):
        rows = rows.join(child, "serial_no", "left")
    attorney, cn, us = F.col("attorney_name").isNotNull(), F.col("own_addr_country_cd") == "CN", F.col("own_addr_country_cd") == "US"
    return rows.groupBy("ym").agg(
        F.count("*").alias("n"), rate(F.coalesce("coined_token_max", F.lit(0.0)) >= COINED).alias("coined_rate"), rate(F.coalesce("mkt", F.lit(False))).alias("marketplace_rate"), rate(cn).alias("cn_share"),
        rate(F.col("use_af_in")).alias("use1a_rate"), F.avg("goods_item_count").alias("mean_goods"), rate(attorney).alias("atty_rate"), rate(F.when(cn, attorney)).alias("atty_cn"), rate(F.when(us, attorney)).alias("atty_us"),
        F.count_if(cn).alias("n_cn"), F.count_if(us).alias("n_us"),
    ).orderBy("ym")


def did_means(df: DataFrame, treated: Column, post: Column, y: Column, weight: Column | None = None) -> DataFrame:
    """One row: the four weighted cell means and the difference in differences, did."""
    w = F.lit(1.0) if weight is None else weight.cast("double")
    mean = lambda c: F.sum(F.when(c & y.isNotNull(), y * w)) / F.sum(F.when(c & y.isNotNull(), w))
    cells = df.agg(mean(treated & ~post).alias("t_pre"), mean(treated & post).alias("t_post"), mean(~treated & ~post).alias("c_pre"), mean(~treated & post).alias("c_post"))
    return cells.withColumn("did", (F.col("t_post") - F.col("t_pre")) - (F.col("c_post") - F.col("c_pre")))


def _p(t: float) -> float:
    return math.erfc(abs(t) / math.sqrt(2))


def wls(x: np.ndarray, y: np.ndarray, w: np.ndarray, lags: int | None = None) -> tuple[np.ndarray, np.ndarray, float]:
    """(coefficients, errors, r2) of weighted least squares: Newey-West errors with Bartlett weights for lags, else HC1."""
    root = np.sqrt(w)
    xw, yw = x * root[:, None], y * root
    bread = np.linalg.pinv(xw.T @ xw)
    b = bread @ xw.T @ yw
    g = xw * (yw - xw @ b)[:, None]
    meat = g.T @ g
    for k in range(1, (lags or 0) + 1):
        c = g[k:].T @ g[:-k]
        meat += (1 - k / (lags + 1)) * (c + c.T)
    cov = bread @ meat @ bread
    if lags is None:
        cov *= len(y) / max(1, len(y) - x.shape[1])
    centred = yw - root * np.average(y, weights=w)
    r2 = 1 - ((yw - xw @ b) ** 2).sum() / max((centred**2).sum(), 1e-300)
    return b, np.sqrt(np.maximum(np.diag(cov), 0)), float(r2)


def interrupted(months: Sequence[str], values: Sequence[float], volume: Sequence[float], breaks=BREAKS, lags: int = 12) -> dict:
    """Level and slope changes at each break, with trend and month of the year; months as yyyy-mm-dd in order."""
    n = len(months)
    t = np.arange(n)
    columns, names = [np.ones(n), t.astype(float)], ["const", "trend"]
    for key, day in breaks:
        later = [m >= day for m in months]
        at = later.index(True) if any(later) else n
        columns += [(t >= at).astype(float), np.maximum(t - at, 0).astype(float)]
        names += [f"level_{key}", f"slope_{key}"]
    for m in range(2, 13):
        columns.append(np.array([float(int(x[5:7]) == m) for x in months]))
        names.append(f"seas_{m}")
    b, se, r2 = wls(np.column_stack(columns), np.asarray(values, float), np.asarray(volume, float), lags)
    out = {}
    for key, _ in breaks:
        i, j = names.index(f"level_{key}"), names.index(f"slope_{key}")
        out[key] = {"level_shift": round(float(b[i]), 5), "level_se": round(float(se[i]), 5), "level_p": round(_p(b[i] / max(se[i], 1e-300)), 4), "slope_change_per_month": round(float(b[j]), 6), "slope_se": round(float(se[j]), 6), "slope_p": round(_p(b[j] / max(se[j], 1e-300)), 4)}
    return {"n_months": n, "r2": round(r2, 4), "breaks": out}


def _shift(month: str, by: int) -> str:
    k = int(month[:4]) * 12 + int(month[5:7]) - 1 + by
    return f"{k // 12:04d}-{k % 12 + 1:02d}-01"


def counsel_rule(rows: Sequence[Mapping], rule: str = "2019-08-01", window: int = 10) -> dict:
    """Attorney presence, foreign against domestic filers, around a month that is left out; rows: ym, atty_cn, atty_us, n_cn, n_us."""
    post_start, lo, hi = _shift(rule, 1), _shift(rule, -window), _shift(rule, 1 + window)
    panel = []
    for r in rows:
        if lo <= r["ym"] < hi and r["ym"] != rule:
            post = float(r["ym"] >= post_start)
            panel += [(r["atty_cn"], 1.0, post, r["n_cn"]), (r["atty_us"], 0.0, post, r["n_us"])]
    panel = np.array([p for p in panel if p[0] is not None and p[3] is not None and not math.isnan(p[0])], dtype=float)
    y, cn, post, n = panel.T
    b, se, _ = wls(np.column_stack([np.ones(len(y)), cn, post, cn * post]), y, n)
    mean = lambda c, p: round(float(np.average(y[(cn == c) & (post == p)], weights=n[(cn == c) & (post == p)])), 4)
    eve = _shift(rule, -1)
    peak = [r["n_cn"] for r in rows if r["ym"] == eve]
    prior = [r["n_cn"] for r in rows if _shift(eve, -12) <= r["ym"] < eve]
    rush = round(float(peak[0] / np.median(prior)), 2) if peak and prior and np.median(prior) else None
    return {"did_estimate": round(float(b[3]), 4), "did_se": round(float(se[3]), 4), "did_p": round(_p(b[3] / max(se[3], 1e-300)), 4), "cn_pre": mean(1, 0), "cn_post": mean(1, 1), "us_pre": mean(0, 0), "us_post": mean(0, 1), "pre_deadline_rush_ratio": rush}


def analyzed(series: DataFrame) -> dict:
    """Interrupted series of all METRICS and the counsel-rule estimate, from event_series()."""
    rows = [r.asDict() | {"ym": r["ym"].isoformat(), "log_volume": math.log(r["n"])} for r in series.orderBy("ym").collect()]  # a row a month
    months, n = [r["ym"] for r in rows], [r["n"] for r in rows]
    its = {m: interrupted(months, [r[m] if r[m] is not None else 0.0 for r in rows], n) for m in METRICS}
    return {"n_months": len(rows), "behavioral_its": its, "us_counsel_did": counsel_rule(rows)}
