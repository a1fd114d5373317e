"""Outcome labels, holdout, standardized features, logistic and transparent scores."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.stats import auc, rounded

#: fixed values
SANCTION_EVENTS, SANCTION_STATUS = ("KBOC", "KOFS", "KONO"), "610"
INSTITUTED_EVENTS, DENIED_EVENTS = ("BXPI", "BRPI"), ("BDXD", "BPXX", "BDRD", "BPRD")
TRANSPARENT = {"neg_min_zipf": 0.20, "ngram_coined": 0.25, "single_token": 0.10, "standard_char": 0.05, "marketplace_class": 0.20, "goods_items": 0.10, "use_basis": 0.10, "real_translation": -0.20}
LABEL_YEARS = (2015, 2018)
MIN_CLASS, MIN_POSITIVES = 30, 100


def labels(tables: Mapping[str, DataFrame]) -> DataFrame:
    """serial_no, filing_year and label: sanctioned, tma_instituted, tma_denied or survivor, the first that fits; others are dropped."""
    codes = F.col("event_cd")
    found = tables["event"].groupBy("serial_no").agg(F.bool_or(codes.isin(*SANCTION_EVENTS)).alias("s"), F.bool_or(codes.isin(*INSTITUTED_EVENTS)).alias("i"), F.bool_or(codes.isin(*DENIED_EVENTS)).alias("d"))
    label = F.when(F.col("s") | (F.col("status_cd") == SANCTION_STATUS), "sanctioned").when(F.col("i"), "tma_instituted").when(F.col("d"), "tma_denied").when(F.col("use_afdv_acc_in") & F.col("registration_dt").isNotNull(), "survivor")
    return tables["case_file"].join(found, "serial_no", "left").select("serial_no", F.year("filing_dt").cast("long").alias("filing_year"), label.alias("label")).where("label is not null")


def real_translation(statement: DataFrame, key: str = "serial_no", kind: str = "statement_type_cd", text: str = "statement_text") -> DataFrame:
    """key and whether any translation statement gives a real meaning."""
    t = F.col(text)
    real = (t.ilike("%mean%") & ~t.ilike("%no meaning%")) | (t.ilike("%translat%") & ~t.ilike("%no%translat%"))
    return statement.where(F.col(kind).startswith("TR") | F.col(kind).startswith("TLIT")).groupBy(key).agg(F.bool_or(real).alias("has_real_tr"))


def evaluation_pool(label_rows: DataFrame, features: DataFrame, statement: DataFrame, since: int = 2015) -> DataFrame:
    """Sanctioned and surviving marks with a coined score; missing flags count as 0."""
    rows = label_rows.where(F.col("label").isin("sanctioned", "survivor")).drop("filing_year").join(features, "serial_no").join(real_translation(statement), "serial_no", "left")
    bit = lambda c: F.coalesce(c.cast("int"), F.lit(0))
    rows = rows.where((F.col("coined_token_max").isNotNull()) & (F.col("filing_year") >= since))
    return rows.select(
        "serial_no", (F.col("label") == "sanctioned").cast("int").alias("y"), "mark_id_char", F.col("coined_token_max").alias("ngram_coined"), F.col("coined_mark_score").alias("ngram_whole"), bit(F.col("single_token")).alias("single_token"),
        bit(F.col("is_standard_char")).alias("standard_char"), bit(F.col("is_marketplace_class")).alias("marketplace_class"), F.coalesce("goods_item_count", F.lit(0)).alias("goods"), bit(F.col("filing_basis") == "use").alias("use_basis"), bit(F.col("has_real_tr")).alias("real_translation"), "filing_year",
    )


def token_zipf(df: DataFrame, key: str, text: str, frequencies: DataFrame) -> DataFrame:
    """(key, max_zipf, min_zipf) over tokens [a-z']+; frequencies: token, zipf.  Unknown tokens and no tokens give 0."""
    tokens = df.select(key, F.explode(F.regexp_extract_all(F.lower(text), F.lit("[a-z']+"), 0)).alias("token"))
    z = tokens.join(frequencies, "token", "left").groupBy(key).agg(F.max(F.coalesce("zipf", F.lit(0.0))).alias("max_zipf"), F.min(F.coalesce("zipf", F.lit(0.0))).alias("min_zipf"))
    return df.select(key).join(z, key, "left").select(key, F.coalesce("max_zipf", F.lit(0.0)).alias("max_zipf"), F.coalesce("min_zipf", F.lit(0.0)).alias("min_zipf"))


def corpus_zipf(texts: DataFrame, text: str) -> DataFrame:
    """token and zipf, log10 of its count in a thousand million tokens of the corpus."""
    counts = texts.select(F.explode(F.regexp_extract_all(F.lower(text), F.lit("[a-z']+"), 0)).alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    return counts.join(F.broadcast(counts.agg(F.sum("n").alias("all")))).select("token", F.log10(1e9 * F.col("n") / F.col("all")).alias("zipf"))


def held_out(key: Column) -> Column:
    """About 30 % of keys by their md5, the same in every engine and run."""
    return F.substring(F.md5(key.cast("string")), 1, 2) < "4d"


def standardized(df: DataFrame, columns: Sequence[str], train: Column) -> DataFrame:
    """Columns less their mean over the training rows, by their population deviation there (plus 1e-9)."""
    stats = df.where(train).agg(*(F.avg(c).alias(f"__m_{c}") for c in columns), *((F.stddev_pop(c) + 1e-9).alias(f"__s_{c}") for c in columns))
    out = df.join(F.broadcast(stats))  # one row
    return out.withColumns({c: (F.col(c) - F.col(f"__m_{c}")) / F.col(f"__s_{c}") for c in columns}).drop(*(f"__{k}_{c}" for c in columns for k in "ms"))


def transparent(weights: Mapping[str, float] = TRANSPARENT) -> Column:
    out = F.lit(0.0)
    for c, w in weights.items():
        out = out + F.lit(w) * F.col(c)
    return out


def brier(df: DataFrame, probability: str, y: str) -> DataFrame:
    return df.agg(rounded(F.avg(F.pow(F.col(probability) - F.col(y), 2))).alias("brier"))


def logistic(train: DataFrame, columns: Sequence[str], y: str):
    """(coefficients, intercept): ridge logistic regression with unit penalty over standardized columns."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    rows = VectorAssembler(inputCols=list(columns), outputCol="__x").transform(train.select(*(F.col(c).cast("double") for c in columns), F.col(y).cast("double").alias("__y")))
    model = LogisticRegression(featuresCol="__x", labelCol="__y", maxIter=1000, regParam=1.0 / train.count(), elasticNetParam=0.0, standardization=False).fit(rows)
    return list(model.coefficients), model.intercept


def logistic_score(columns: Sequence[str], coefficients: Sequence[float], intercept: float) -> Column:
    out = F.lit(float(intercept))
    for c, w in zip(columns, coefficients, strict=True):
        out = out + F.lit(float(w)) * F.col(c)
    return 1 / (1 + F.exp(-out))


def evaluate(pool: DataFrame, zipf: DataFrame) -> dict:
    """Signal and model quality on the label-complete cohorts; degrades to a status where labels are too few.

    pool: evaluation_pool(); zipf: serial_no, max_zipf, min_zipf.
    """
    import math

    rows = pool.join(zipf, "serial_no").withColumns({"neg_min_zipf": -F.col("min_zipf"), "neg_max_zipf": -F.col("max_zipf"), "goods_items": F.least("goods", F.lit(50)) / 50.0})
    n = rows.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0))).first()
    out: dict = {"pool": {"n": n[0], "sanctioned": n[1]}}
    if min(n[1], n[0] - n[1]) < MIN_CLASS:
        return out | {"status": "too few labels for an AUC or a model"}
    score = lambda df, c: df and round(auc(df, c, F.col("y") == 1).first()["auc"], 4)
    out["auc"] = {c: score(rows, c) for c in ("neg_min_zipf", "neg_max_zipf", "ngram_coined", "ngram_whole")}
    out["auc"]["metric_correlation_r"] = round(rows.agg(F.corr("ngram_coined", "neg_min_zipf")).first()[0], 4)
    names = list(TRANSPARENT)
    lo, hi = LABEL_YEARS
    window = rows.where(F.col("filing_year").between(lo, hi))
    test = held_out(F.col("serial_no"))
    sizes = window.groupBy(test.alias("t")).agg(F.sum("y").alias("y")).collect()
    if len(sizes) < 2 or min(r["y"] for r in sizes) < MIN_POSITIVES:
        return out | {"model": {"status": "too few positives in the label-complete window"}}

    def fitted(train_rows: Column, test_rows: Column) -> tuple[list[float], DataFrame]:
        z = standardized(window, names, train_rows)
        w, b = logistic(z.where(train_rows), names, "y")
        return w, z.where(test_rows).withColumn("p", logistic_score(names, w, b))

    w, scored = fitted(~test, test)
    out["model"] = {"test_auc": score(scored, "p"), "standardized_coefficients": dict(sorted(zip(names, (round(x, 4) for x in w), strict=True), key=lambda t: -abs(t[1])))}
    equal = sum((F.col(c) for c in names[1:]), F.col(names[0]))
    more = scored.withColumns({"t": transparent(), "e": equal})
    out["comparison"] = {"transparent_test_auc": score(more, "t"), "equal_weight_test_auc": score(more, "e"), "fitted_brier": brier(scored, "p", "y").first()[0]}
    mid = (lo + hi) // 2
    early, late = F.col("filing_year") <= mid, F.col("filing_year") > mid
    parts = window.groupBy(early.alias("e"), test.alias("t")).agg(F.sum("y").alias("y"), F.count("*").alias("n")).collect()
    if len(parts) == 4 and all(0 < r["y"] < r["n"] for r in parts):
        (we, se), (wl, sl) = fitted(~test & early, test & late), fitted(~test & late, test & early)
        me, ml = sum(we) / len(we), sum(wl) / len(wl)
        cov = sum((a - me) * (b - ml) for a, b in zip(we, wl, strict=True))
        r = cov / math.sqrt(sum((a - me) ** 2 for a in we) * sum((b - ml) ** 2 for b in wl))
        out["comparison"]["cross_cohort"] = {"split_year": mid, "early_fit_late_test_auc": score(se, "p"), "late_fit_early_test_auc": score(sl, "p"), "coef_correlation": round(r, 4)}
    return out
