import pytest
from pyspark.sql import functions as F

from registrum.operators import audit, gates, grouping, merge, scorer


def test_merge_is_idempotent_and_replaces_children(spark):
    cases = spark.createDataFrame([("1", "a", "2020-01-01", "f1"), ("1", "b", "2020-02-01", "f2"), ("2", "c", "2020-01-01", "f1"), ("1", "b", "2020-02-01", "f2")], "serial_no string, v string, file_dt_source string, file_name_source string")
    kids = spark.createDataFrame([("1", 1, "f1"), ("1", 2, "f1"), ("1", 3, "f2"), ("2", 4, "f1")], "serial_no string, k int, file_name_source string")
    out = merge.merged({"case_file": cases, "kid": kids}, "case_file", "serial_no")
    assert sorted((r.serial_no, r.v) for r in out["case_file"].collect()) == [("1", "b"), ("2", "c")]
    assert sorted(r.k for r in out["kid"].collect()) == [3, 4]
    again = merge.merged(out, "case_file", "serial_no")
    assert again["case_file"].exceptAll(out["case_file"]).isEmpty() and again["kid"].exceptAll(out["kid"]).isEmpty()


def test_equal_dates_go_by_name(spark):
    df = spark.createDataFrame([("1", "x", "2020-01-01", "b"), ("1", "y", "2020-01-01", "c")], "serial_no string, v string, file_dt_source string, file_name_source string")
    assert merge.merged({"p": df}, "p", "serial_no")["p"].first()["v"] == "y"


def test_pick_puts_nulls_last(spark):
    df = spark.createDataFrame([("1", None, 2, "n"), ("1", None, None, "o"), ("1", "20", 1, "m")], "k string, t string, s int, v string")
    order = [F.coalesce(F.col("t") == "10", F.lit(False)).desc(), F.col("s").asc_nulls_last()]
    assert merge.pick(df, "k", order, ["v"]).first()["v"] == "m"


def test_gates_report_all_failures(spark):
    cases = spark.createDataFrame([("1", "2099-01-01", "f"), ("1", "1823-03-06", "g")], "serial_no string, filing_dt string, file_name_source string").withColumn("filing_dt", F.to_date("filing_dt"))
    kids = spark.createDataFrame([("9", "f")], "serial_no string, file_name_source string")
    rows = {"case_file": cases, "kid": kids}
    found = gates.failures(rows, "case_file", "serial_no", gates.date_profile(rows, "2026-01-01"), spark.createDataFrame([("f",)], "n string"), spark.range(3))
    assert len(found) == 5 and str(gates.GateError(found)).count("\n") == 5
    assert gates.failures({"case_file": cases.where("file_name_source = 'g'").drop("filing_dt").withColumn("d", F.lit("2020-01-01").cast("date"))}, "case_file", "serial_no", gates.date_profile({"c": cases.limit(0)}, "2026-01-01"), None, spark.range(1)) == []
    assert gates.ceiling_of("renewal_dt", "2026-01-01") == "2066-01-01" and gates.ceiling_of("filing_dt", "2026-01-01") == "2026-01-01"


def keys(rows, mode, name_cap, addr_cap):
    from collections import defaultdict

    n, a = defaultdict(set), defaultdict(set)
    for _, name, addr in rows:
        if name and addr:
            n[name].add(addr)
            a[addr].add(name)
    out = {}
    for s, name, addr in rows:
        nk, ak = name and f"N:{name}", addr and f"A:{addr}"
        good_n, good_a = nk if name and len(n[name]) <= name_cap else None, ak if addr and len(a[addr]) <= addr_cap else None
        got = {"name_first": good_n or good_a or nk or ak, "addr_first": good_a or good_n or ak or nk, "name_only": nk, "addr_only": ak}[mode]
        if got:
            out[s] = got
    return out


@pytest.mark.parametrize("mode", ["name_first", "addr_first", "name_only", "addr_only"])
def test_grouping_ladder_against_brute_force(spark, mode):
    rows = [(k, None if k % 11 == 0 else f"n{k % 7}", None if k % 13 == 0 else "" if k % 17 == 0 else f"a{(k * k) % 19}") for k in range(200)]
    df = spark.createDataFrame(rows, "s int, name string, addr string")
    for caps in ((3, 2), (50, 25), (8, 1)):
        got = {r.s: r.op_key for r in grouping.assigned(df, grouping.Variant(mode, *caps)).collect()}
        assert got == keys(rows, mode, *caps)


@pytest.mark.parametrize("query", ["top_decile_jaccard", "spearman_variants"])
def test_variants_share_one_table_of_pairs(spark, monkeypatch, query):
    """Whatever the number of variants, pairs are made distinct once and line items meet the hubs once."""
    from registrum import queries as Q

    names = []
    for module in (grouping, audit):
        monkeypatch.setattr(module, "written", lambda df, name, w=module.written: names.append(name) or w(df, name))
    got = Q.queries()[query](spark, "/root/testdata/sf0.001").collect()
    assert len(got) == 1 and [names.count(x) for x in ("pairs", "measured", "degrees", "operations")] == [1, 1, 2, 2]


@pytest.mark.parametrize("task_rows", [10**6, 20])
def test_rows_move_once_to_their_operation(spark, monkeypatch, task_rows):
    """Operations take one shuffle of rows as they are, unless they are large; the signals are not moved twice."""
    from collections import defaultdict

    saved = {}
    monkeypatch.setattr(audit, "written", lambda df, name, w=audit.written: saved.setdefault(name, df) and w(df, name))
    monkeypatch.setattr(audit, "TASK_ROWS", task_rows, raising=False)
    rows = [(k // 3, f"n{k % 5 if k % 4 else k}", f"a{k % 37}", None if k % 6 == 0 else k % 2 == 0) for k in range(400)]
    df = spark.createDataFrame(rows, "s int, name string, addr string, flag boolean")
    ops, filings = audit.filing_scores(df, grouping.Variant("name_first", 50, 25), "name", "addr", {"owner_turnover": F.count_distinct("s") / F.count("*").cast("double"), "coined_rate": F.avg(F.col("flag").cast("int"))}, 2, {"owner_turnover": 0.5, "coined_rate": 0.5})
    assert saved["measured"].columns == ["s", "name", "addr", "flag", "__nd", "__ad"]
    moves = saved["operations"]._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(")
    assert (moves == 1) if task_rows > 400 else (moves > 1)
    want = defaultdict(list)
    found = keys([(k, *r[1:3]) for k, r in enumerate(rows)], "name_first", 50, 25)
    for k, op in found.items():
        want[op].append(rows[k])
    want = {op: (len(v), len({r[0] for r in v}) / len(v)) for op, v in want.items() if len(v) >= 2}
    assert {r.op_key: (r.n_marks, r.owner_turnover) for r in ops.collect()} == want
    assert filings.count() == sum(n for n, _ in want.values())


def test_packed_conditions(spark):
    from itertools import product

    from registrum.functions import stats

    rows = list(product([True, False, None], repeat=3))
    df = spark.createDataFrame(rows, "a boolean, b boolean, c boolean").withColumn("p", stats.packed([F.col(x) for x in "abc"]))
    assert all(r[:3] == r[3:] for r in df.select("a", "b", "c", *(stats.unpacked(F.col("p"), k) for k in range(3))).collect())


@pytest.mark.parametrize("rows_at_most", [0, 10**6])
def test_hubs_met_by_broadcast_and_by_shuffle(spark, monkeypatch, rows_at_most):
    """Equal keys for numbers and texts, and for degrees measured for several variants at once."""
    monkeypatch.setattr(grouping, "BROADCAST_ROWS", rows_at_most)
    rows = [(k, None if k % 11 == 0 else k % 7, None if k % 13 == 0 else (k * k) % 19) for k in range(300)]
    variants = [grouping.Variant(m, *c) for m in ("name_first", "addr_first", "name_only", "addr_only") for c in ((3, 2), (8, 1), (50, 25))]
    both = grouping.measured(spark.createDataFrame(rows, "s int, name long, addr long"), variants)
    for v in variants:
        want = keys([(s, n if n is None else str(n), a if a is None else str(a)) for s, n, a in rows], v.mode, v.name_cap, v.addr_cap)
        assert {r.s: r.op_key for r in grouping.laddered(both, v).collect()} == want


def test_profile_moves_no_copies_of_rows(spark):
    """No plan expands rows once per distinct count; nulls count nowhere, and a screening profile agrees with the whole one."""
    from registrum.operators import profile

    rows = [("N:a", None, "a", k % 3, None if k % 2 else k, "CN", k % 2, 1, None, 0, None if k % 5 else 3, 0, 0, f"2020-01-0{k % 4 + 1}") for k in range(20)] + [("N:b", "x", None, None, None, None, *[None] * 7, None)] * 20 + [("N:c", "y", "c", 1, 1, "US", *[1] * 7, "2021-01-01")]
    df = spark.createDataFrame(rows, "op_key string, attorney_name string, name string, addr int, applicant int, country string, coined int, mkt int, use1a int, design int, goods int, refused int, no_use int, d string").withColumn("filing_dt", F.to_date("d"))
    got = profile.operation_profile(df)
    few = profile.operation_profile(df, screening=True)
    for out in (got, few):
        assert "Expand" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert few.exceptAll(got.select(few.columns)).isEmpty() and few.count() == got.count()
    a, b = sorted(got.collect(), key=lambda r: r.op_key)
    assert (a.op_key, a.n_marks, a.n_name_spellings, a.n_canonical_names, a.n_addresses, a.owner_turnover, a.pct_cn, a.coined_rate, a.use1a_rate, a.avg_goods_items, a.max_marks_one_day, a.first_year) == ("N:a", 20, 0, 1, 3, 0.5, 1.0, 0.5, None, 3.0, 5, 2020)
    assert (b.op_key, b.n_name_spellings, b.n_canonical_names, b.owner_turnover, b.pct_cn, b.goods_chaos, b.max_marks_one_day, b.first_year, b.is_shared_service) == ("N:b", 1, 0, 0.0, None, 1.0, 20, None, False)


WORDS = "the quick brown fox jumps over lazy dog mountain river garden silver golden summer winter little bright market village story".split() * 10


def test_scorer_against_plain_python(spark):
    import math
    from collections import Counter

    model = scorer.fit(spark.createDataFrame([(w,) for w in WORDS], "word string"), "word")
    grams, ctx = Counter(), Counter()
    for w in WORDS:
        p = f"^^{w}$"
        for k in range(len(p) - 2):
            grams[p[k : k + 3]] += 1
            ctx[p[k : k + 2]] += 1
    v = len(set("".join(WORDS))) + 1

    def lp(w):
        p = f"^^{w}$"
        return sum(math.log((grams[p[k : k + 3]] + 1) / (ctx[p[k : k + 2]] + v)) for k in range(len(p) - 2)) / (len(p) - 2)

    lps = sorted(map(lp, WORDS))
    lo, hi = lps[int(0.02 * (len(lps) - 1))], lps[int(0.98 * (len(lps) - 1))]
    marks = ["vofuly xqzt", "mountain", "Zyx9", "", "!!", "river-garden", None]
    got = {r.k: r for r in scorer.scored(spark.createDataFrame(list(enumerate(marks)), "k int, m string"), "k", F.col("m"), model).collect()}
    for k, m in enumerate(marks):
        prep = ["".join(c for c in w.lower() if "a" <= c <= "z") for w in (m or "").split()]
        want = max((max(0, min(1, (hi - lp(w)) / (hi - lo))) for w in prep if len(w) >= 2), default=None)
        assert got[k].token_max is None if want is None else got[k].token_max == pytest.approx(want, abs=1e-4)
    assert got[0].token_max > got[1].token_max


def test_audit_sample_takes_largest_and_quotas(spark):
    ops = spark.createDataFrame([(f"k{n}", n) for n in range(20, 420)], "op_key string, n_marks int")
    got = audit.audit_sample(ops).collect()
    assert sorted(r.n_marks for r in got if r.stratum == 0) == list(range(415, 420))
    assert [sum(r.stratum == s for r in got) for s in (1, 2, 3)] == [45, 35, 0]
    assert {r.op_key for r in got} == {r.op_key for r in audit.audit_sample(ops.repartition(7)).collect()}


def test_colocation_counts_names_with_or_without_hubs(spark, tmp_path):
    """An address of 50 names, ten of them hubs, is none itself once the hubs are left out, as in the SQL."""
    import compare
    import duckdb

    from registrum import queries as Q

    pairs = [(1, s) for s in range(50)] + [(2, s) for s in range(50, 60)] + [(p, s) for s in range(10) for p in range(10, 640)]
    rows = [(3 * k + j, p, s, j + 1, 30.0 * j, "R", "F") for k, (p, s) in enumerate(pairs) for j in range(2)]
    table = spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_returnflag string, l_linestatus string")
    table.coalesce(1).write.parquet(str(tmp_path / "lineitem.parquet"))
    got = Q.queries()["colocation"](spark, str(tmp_path)).toPandas()
    duckdb.execute(f"CREATE OR REPLACE TEMP VIEW lineitem AS SELECT * FROM '{tmp_path}/lineitem.parquet/*.parquet'")
    want = duckdb.execute(Q.oracle_sql()["colocation"]).df()
    assert compare.rows(got) == compare.rows(want) and set(got.l_partkey) == {1, 2}
    both = audit.colocated(table, "l_partkey", "l_suppkey", {"coined_rate": F.avg("l_quantity")}, F.col("coined_rate"), 2, 620, 45)
    assert [r.l_partkey for r in both.collect()] == [2]


def test_evidence_is_ordered(spark):
    df = spark.createDataFrame([("a", "x")] * 3 + [("a", "y")] * 5 + [("b", "z")], "op_key string, v string")
    got = {r.op_key: [(e["value"], e["n"]) for e in r.v] for r in audit.evidence(df, "op_key", {"v": 2}).collect()}
    assert got == {"a": [("y", 5), ("x", 3)], "b": [("z", 1)]}


def test_running_and_quantiles_against_sorting(spark):
    import numpy as np

    from registrum.functions import stats

    rng = np.random.default_rng(4)
    # a skewed column: most values alike, a few far away
    values = [*([7.0] * 3000), *rng.exponential(2.0, 2000).round(2), *(10.0**k for k in range(9)), None]
    rows = [(("a", "b")[k % 3 == 0], None if v is None else float(v)) for k, v in enumerate(values)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: r for r in stats.quantiles(df, "v", {"p10": 0.1, "p50": 0.5, "p99": 0.99, "top": 1.0}, ("g",)).collect()}
    for g in "ab":
        own = [v for h, v in rows if h == g and v is not None]
        assert [got[g].p10, got[g].p50, got[g].p99, got[g].top] == pytest.approx(np.quantile(own, [0.1, 0.5, 0.99, 1.0]), abs=1e-4)
    live = sorted(v for _, v in rows if v is not None)
    for r in stats.ranked(df, "v").collect():
        assert r["rank"] == (None if r.v is None else 1 + int(np.searchsorted(live, r.v)))
    for p in (0.0, 0.02, 0.5, 0.98, 1.0):
        assert stats.order_statistic(df, "v", p, "x").first().x == live[int(p * (len(live) - 1))]
    assert stats.quantiles(df.where("v is null"), "v", {"p": 0.5}).first().p is None and stats.ranked(df.limit(0), "v").count() == 0


def test_evaluation_of_a_pool(spark):
    """Separable classes: signals above chance, a fitted model over the single ones, both cohorts alike."""
    import random

    from registrum.operators import evaluate

    rng = random.Random(3)
    rows, zipf = [], []
    for k in range(3000):
        y = int(k % 4 == 0)
        pull = rng.gauss(1.2 * y, 1.0)
        rows.append((str(k), y, f"m{k}", 0.5 + 0.1 * pull, 0.5 + 0.1 * rng.gauss(y, 2), rng.randint(0, 1), rng.randint(0, 1), int(rng.random() < 0.3 + 0.4 * y), rng.randint(0, 30) + 10 * y, rng.randint(0, 1), int(rng.random() < 0.3 - 0.2 * y), 2015 + k // 4 % 4))
        zipf.append((str(k), 4.0 - y + rng.gauss(0, 1), 3.0 - y + rng.gauss(0, 1)))
    pool = spark.createDataFrame(rows, "serial_no string, y int, mark_id_char string, ngram_coined double, ngram_whole double, single_token int, standard_char int, marketplace_class int, goods int, use_basis int, real_translation int, filing_year long")
    frequencies = spark.createDataFrame(zipf, "serial_no string, max_zipf double, min_zipf double")
    doc = evaluate.evaluate(pool, frequencies)
    assert doc["pool"] == {"n": 3000, "sanctioned": 750} and all(0.5 < doc["auc"][c] < 1 for c in ("neg_min_zipf", "neg_max_zipf", "ngram_coined", "ngram_whole"))
    assert doc["model"]["test_auc"] > doc["auc"]["ngram_coined"] and doc["comparison"]["transparent_test_auc"] > 0.7 and 0 < doc["comparison"]["fitted_brier"] < 0.25
    cross = doc["comparison"]["cross_cohort"]
    assert cross["split_year"] == 2016 and cross["coef_correlation"] > 0.8 and min(cross["early_fit_late_test_auc"], cross["late_fit_early_test_auc"]) > 0.7
    few = evaluate.evaluate(pool.where("y = 0 or int(serial_no) < 40"), frequencies)
    assert few["status"] and "auc" not in few
    narrow = evaluate.evaluate(pool.where("filing_year > 2018 or int(serial_no) < 400"), frequencies)
    assert narrow["model"]["status"] and narrow["auc"]


def test_analysis_of_a_monthly_series(spark):
    """A jump of the right size at the right month."""
    from datetime import date

    from registrum.operators import series

    rows = []
    for k in range(96):
        day = date(2014 + k // 12, k % 12 + 1, 1)
        after = day >= date(2019, 8, 1)
        rows.append((day, 1000, 5000 if day != date(2019, 7, 1) else 20000, 8000, 0.78 if after else 0.55, 0.68, *(0.3 + 0.05 * after for _ in series.METRICS)))
    extra = [m for m in series.METRICS if m not in ("n", "n_cn", "n_us", "atty_cn", "atty_us", "log_volume")]
    table = spark.createDataFrame([(*r[:6], *r[6 : 6 + len(extra)]) for r in rows], "ym date, n long, n_cn long, n_us long, atty_cn double, atty_us double" + "".join(f", {m} double" for m in extra))
    doc = series.analyzed(table)
    assert doc["n_months"] == 96 and set(doc["behavioral_its"]) == set(series.METRICS)
    shifts = [b["level_shift"] for b in doc["behavioral_its"][extra[0]]["breaks"].values()]
    assert max(shifts) == pytest.approx(0.05, abs=0.01)
    assert doc["us_counsel_did"]["did_estimate"] == pytest.approx(0.23, abs=1e-6) and doc["us_counsel_did"]["pre_deadline_rush_ratio"] == 4.0
