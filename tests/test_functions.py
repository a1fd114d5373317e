import math

import pytest
from pyspark.sql import functions as F

from registrum.functions import stats, text
from registrum.operators import evaluate, series


def one(spark, expr, **values):
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField(k, T.StringType()) for k in values])
    return spark.createDataFrame([tuple(values.values())], schema).select(expr.alias("x")).first()[0]


@pytest.mark.parametrize(
    "name, want",
    [
        ("Dana K. Rivers", "DANA RIVERS"), ("Rivers, Dana", "DANA RIVERS"), ("Dana Rivers, Esq.", "DANA RIVERS"), ("A and B", None), ("Jo Fox & Al Day", "FOX JO"), ("QO2281", None), ("Single", None), ("A B", "A B"), ("", None), (None, None), ("Mary-Ann O'Neil PLLC", "MARY-ANN O'NEIL"),
    ],
)
def test_canonical_name(spark, name, want):
    assert one(spark, text.canonical_name(F.col("n")), n=name) == want


def test_keys_of_other_letters_equal_their_sql(spark):
    """Letters that have no single capital, and letters beside AND."""
    import duckdb
    import pandas as pd

    from registrum import queries as Q

    names = [*(f"rivers mo{c}er dana{c}" for c in text.UNPAIRED), *(f"dana rivers {c}and jo fox" for c in "\u00e9\u00df\u00b5\u4e2d_x1"), "chte er\u00dfie", "\u0131da \u017fol", "ana\u000bfox\u00a0day", None]
    t = pd.DataFrame({"k": range(len(names)), "n": names})  # noqa: F841
    want = duckdb.sql(f"SELECT k, {Q._CANON} AS name, nullif(regexp_replace(upper(concat_ws(' ', n)), '[^A-Z0-9]', '', 'g'), '') AS addr FROM {Q._CANON_FROM.format('n', 't')} ORDER BY k").fetchall()
    df = spark.createDataFrame(list(enumerate(names)), "k int, n string")
    got = df.select("k", text.canonical_name(F.col("n")).alias("name"), text.address_key(F.col("n")).alias("addr")).orderBy("k").collect()
    assert [tuple(r) for r in got] == want


def test_keys(spark):
    assert one(spark, text.address_key(F.col("a"), F.col("b")), a="1 Main St.", b=None) == "1MAINST"
    assert one(spark, text.address_key(F.col("a"), F.col("b")), a="", b=None) is None
    assert one(spark, text.mark_key(F.col("a")), a="Vo-fu ly! é") == "VOFULY"
    assert one(spark, text.operation_key(F.col("n"), F.col("a")), n="Dana Rivers", a="9 Elm") == "ADDR:9ELM"
    assert one(spark, text.operation_key(F.col("n"), F.col("a")), n="Dana Rivers", a=None) == "NAME:DANA RIVERS"


@pytest.mark.parametrize("v, want", [("20200105", "2020-01-05"), ("19870000", None), ("2020", None), ("20201340", None), (None, None), (" 20200105 ", "2020-01-05")])
def test_compact_date(spark, v, want):
    got = one(spark, text.compact_date(F.col("v")), v=v)
    assert (got and got.isoformat()) == want


def test_field_parsers(spark):
    assert [one(spark, text.flag(F.col("v")), v=v) for v in ("T", "F", "", None, "X")] == [True, False, None, None, None]
    assert [one(spark, text.zero_filled(F.col("v"), 8), v=v) for v in ("123", "1234567890")] == ["00000123", "1234567890"]
    assert [one(spark, text.registration_number(F.col("v")), v=v) for v in ("0000000", "0012", None)] == [None, "0012", None]
    assert [one(spark, text.whole_number(F.col("v")), v=v) for v in ("12", "x", None)] == [12, None, None]
    assert one(spark, text.item_count(F.col("v")), v="a; b; c") == 3


@pytest.mark.parametrize("k, n", [(0, 0), (0, 5), (5, 5), (97, 105)])
def test_wilson(spark, k, n):
    lo, hi = stats.wilson(F.lit(k), F.lit(n))
    lo, hi = spark.range(1).select(lo, hi).first()
    assert 0 <= lo <= hi <= 1
    if n:
        assert lo <= k / n <= hi
    if (k, n) == (97, 105):
        assert (lo, hi) == (0.8568, 0.9609)


def test_auc_against_all_pairs(spark):
    data = [(x % 7, int(x % 3 == 0)) for x in range(60)]
    got = stats.auc(spark.createDataFrame(data, "s int, y int"), "s", F.col("y") == 1).first()["auc"]
    pos, neg = [s for s, y in data if y], [s for s, y in data if not y]
    assert got == pytest.approx(sum((a > b) + (a == b) / 2 for a in pos for b in neg) / len(pos) / len(neg))
    flipped = stats.auc(spark.createDataFrame([(-s, y) for s, y in data], "s int, y int"), "s", F.col("y") == 1).first()["auc"]
    assert got + flipped == pytest.approx(1)


def test_order_statistic_and_flat_correlation(spark):
    df = spark.createDataFrame([(float(x),) for x in (5, 1, 1, 3, 9)], "v double")
    assert stats.order_statistic(df, "v", 0.5, "m").first()["m"] == 3.0
    assert df.withColumn("c", F.lit(1.0)).agg(stats.safe_corr("v", "c").alias("r")).first()["r"] is None


def test_interrupted_series_finds_a_step():
    months = [f"{2014 + k // 12}-{k % 12 + 1:02d}-01" for k in range(96)]
    values = [0.3 + 0.0001 * k + 0.05 * (m >= "2019-08-01") + 0.001 * ((k * 7919) % 11 - 5) for k, m in enumerate(months)]
    found = series.interrupted(months, values, [1000.0] * 96)["breaks"]["counsel_rule_2019"]
    assert found["level_shift"] == pytest.approx(0.05, abs=0.01) and found["level_p"] < 0.05


def test_counsel_rule_difference():
    rows = [{"ym": f"{2018 + k // 12}-{k % 12 + 1:02d}-01", "atty_cn": 0.55 if k < 20 else 0.78, "atty_us": 0.68, "n_cn": 20000 if k == 18 else 5000, "n_us": 8000} for k in range(36)]
    found = series.counsel_rule(rows)
    assert found["did_estimate"] == pytest.approx(0.23, abs=1e-6) and found["pre_deadline_rush_ratio"] == 4.0


def test_logistic_separates(spark):
    data = [(float(x), float((x * 37) % 5), int(x + (x * 37) % 5 > 25)) for x in range(50)]
    df = spark.createDataFrame(data, "a double, b double, y int")
    z = evaluate.standardized(df, ["a", "b"], F.lit(True))
    w, b = evaluate.logistic(z, ["a", "b"], "y")
    scored = z.withColumn("p", evaluate.logistic_score(["a", "b"], w, b))
    assert stats.auc(scored, "p", F.col("y") == 1).first()["auc"] > 0.97 and w[0] > 0
    assert 0 <= evaluate.brier(scored, "p", "y").first()[0] < 0.2
    assert not math.isnan(b)
