"""Feature tables, operation profiles, composite scores and screening lists."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.stats import rate, rounded
from ..functions.text import address_key, canonical_name, item_count, mark_key, single_token
from ..session import written
from . import merge

#: fixed values: codes and thresholds of the registry's analytics
MARKETPLACE_CLASSES = ("009", "011", "018", "020", "021", "025", "028")
REFUSAL_EVENTS = ("CNCF", "CNFR", "GNCF", "GNCN", "GNFN", "GNFR")
NO_USE_EVENTS = ("ABN6", "ABN7", "MAB6", "MAB7")
SANCTION_EVENTS, SANCTION_STATUS = ("KBOC", "KOFS", "KONO"), "610"
COINED, MIN_MARKS = 0.85, 20
WEIGHTS = {"owner_turnover": 0.25, "coined_rate": 0.25, "marketplace_rate": 0.20, "use1a_rate": 0.15, "goods_chaos": 0.15}
TIER2_SCORE, TIER3_MARKS, TIER3_TURNOVER = 1.8, 1000, 0.6


def weighted_score(weights: Mapping[str, float]) -> Column:
    """Sum of weight * coalesce(column, 0) in the order given."""
    out = F.lit(0.0)
    for k, (c, w) in enumerate(weights.items()):
        term = F.lit(w) * F.coalesce(F.col(c), F.lit(0.0))
        out = term if k == 0 else out + term
    return out


def owner_pick(owner: DataFrame) -> DataFrame:
    """serial_no, own_name and own_addr_country_cd of the first owner: type 10 before others, then sequence, then name."""
    order = [(F.coalesce(F.col("own_type_cd") == "10", F.lit(False))).desc(), F.col("own_seq").asc_nulls_last(), F.col("own_name").asc_nulls_last()]
    return merge.pick(owner, "serial_no", order, ["own_name", "own_addr_country_cd"])


def goods_items(statement: DataFrame) -> DataFrame:
    """serial_no and the longest goods list, in items."""
    goods = statement.where(F.col("statement_type_cd").startswith("GS"))
    return goods.groupBy("serial_no").agg(F.max(item_count(F.col("statement_text"))).alias("goods_item_count"))


def mark_features(tables: Mapping[str, DataFrame], scores: DataFrame) -> DataFrame:
    """One row per record with a mark.  scores: serial_no, whole, token_max.

    Child tables are reduced to one row per record first, so the joins share one partitioning.
    """
    cf = tables["case_file"].where("mark_id_char is not null")
    market = merge.flags(tables["intl_class"], "serial_no", {"is_marketplace_class": F.col("intl_class_cd").isin(*MARKETPLACE_CLASSES)})
    events = merge.flags(tables["event"], "serial_no", {"final_refusal_in": F.col("event_cd").isin(*REFUSAL_EVENTS), "abandoned_no_use_in": F.col("event_cd").isin(*NO_USE_EVENTS)})
    rows = cf
    for child in (market, events, owner_pick(tables["owner"]), goods_items(tables["statement"]), scores):
        rows = rows.join(child, "serial_no", "left")
    basis = F.when(F.col("use_af_in"), "use").when(F.col("use_intent_in"), "intent").when(F.col("for_app_in") | F.col("for_reg_in"), "foreign").when(F.col("intl_reg_in"), "madrid")
    no = lambda c: F.coalesce(F.col(c), F.lit(False)).alias(c)
    return rows.select(
        "serial_no", "mark_id_char", F.col("whole").alias("coined_mark_score"), F.col("token_max").alias("coined_token_max"), single_token(F.col("mark_id_char")).alias("single_token"),
        (F.col("mark_draw_cd") == "4").alias("is_standard_char"), no("is_marketplace_class"), basis.alias("filing_basis"), F.col("own_addr_country_cd").alias("owner_country"), "goods_item_count",
        no("final_refusal_in"), no("abandoned_no_use_in"), F.year("filing_dt").cast("long").alias("filing_year"),
    )


def filings_base(tables: Mapping[str, DataFrame], scores: DataFrame, since: str = "2015-01-01") -> DataFrame:
    """Attributable filings: from a day on, with an attorney or an address; keys, flags and owner of each."""
    cf = tables["case_file"].where(F.col("filing_dt") >= F.lit(since).cast("date"))
    rows = cf.join(tables["correspondent"].dropDuplicates(["serial_no"]).select("serial_no", "cor_addr_2", "cor_addr_3", "cor_addr_4"), "serial_no", "left")
    rows = rows.where("attorney_name is not null or cor_addr_2 is not null")
    market = merge.flags(tables["intl_class"], "serial_no", {"mkt": F.col("intl_class_cd").isin(*MARKETPLACE_CLASSES)})
    events = merge.flags(tables["event"], "serial_no", {"refused": F.col("event_cd").isin(*REFUSAL_EVENTS), "no_use": F.col("event_cd").isin(*NO_USE_EVENTS)})
    for child in (market, events, owner_pick(tables["owner"]), goods_items(tables["statement"]), scores.select("serial_no", "token_max")):
        rows = rows.join(child, "serial_no", "left")
    bit = lambda c: F.coalesce(F.col(c), F.lit(False)).cast("int").alias(c)
    return rows.select(
        "serial_no", "filing_dt", "attorney_name", canonical_name(F.col("attorney_name")).alias("name"), address_key(F.col("cor_addr_2"), F.col("cor_addr_3"), F.col("cor_addr_4")).alias("addr"),
        F.col("own_name").alias("applicant"), F.col("own_addr_country_cd").alias("country"), (F.coalesce(F.col("token_max"), F.lit(0.0)) >= COINED).cast("int").alias("coined"), F.col("use_af_in").cast("int").alias("use1a"),
        F.col("mark_draw_cd").isin("2", "3").cast("int").alias("design"), F.col("goods_item_count").alias("goods"), bit("mkt"), bit("refused"), bit("no_use"),
    )


def aggregates() -> dict[str, Column]:
    """Rates of an operation over filings_base(), as far as a score needs them."""
    mean = lambda c: F.avg(F.col(c).cast("double"))
    turnover = F.count_distinct("applicant") / F.count("*").cast("double")
    return {"owner_turnover": turnover, "coined_rate": mean("coined"), "marketplace_rate": mean("mkt"), "use1a_rate": mean("use1a"), "goods_chaos": F.least(mean("goods") / 20.0, F.lit(1.0))}


def _distinct(rows: DataFrame, key: str, column: str, out: str) -> DataFrame:
    """(key, out): the distinct values of column, nulls not counted."""
    return rows.where(F.col(column).isNotNull()).select(key, column).distinct().groupBy(key).agg(F.count("*").alias(out))


def operation_profile(rows: DataFrame, key: str = "op_key", min_marks: int = MIN_MARKS, screening: bool = False) -> DataFrame:
    """One row per operation of min_marks filings or more.

    rows: key, attorney_name, name, addr, applicant, country, coined, mkt, use1a, design, goods,
    refused, no_use (numbers 0 and 1) and filing_dt.  screening leaves out the columns that no
    list reads: spellings, addresses, rates other than those of a shared service, years, days and score.

    Rows are written once; each distinct count has a pass of its own, which moves two columns only.
    """
    counted = {"n_canonical_names": "name", "owner_turnover": "applicant"} | ({} if screening else {"n_name_spellings": "attorney_name", "n_addresses": "addr"})
    numbers = ("coined", "goods") if screening else ("coined", "goods", "mkt", "use1a", "design", "refused", "no_use")
    rows = written(rows.select(key, *counted.values(), "country", *numbers, *(() if screening else ("filing_dt",))), "filings")
    mean = lambda c: F.avg(F.col(c).cast("double"))
    shares = {"n_marks": F.count("*"), "pct_cn": rate(F.col("country") == "CN"), "coined_rate": mean("coined"), "avg_goods_items": mean("goods")}
    if not screening:
        shares |= {"marketplace_rate": mean("mkt"), "use1a_rate": mean("use1a"), "design_rate": mean("design"), "refusal_rate": mean("refused"), "no_use_abandon_rate": mean("no_use")}
        shares |= {"goods_chaos": F.least(mean("goods") / 20.0, F.lit(1.0)), "first_year": F.year(F.min("filing_dt")).cast("long"), "last_year": F.year(F.max("filing_dt")).cast("long")}
    ops = rows.groupBy(key).agg(*(c.alias(name) for name, c in shares.items())).where(F.col("n_marks") >= min_marks)
    for out, column in counted.items():
        ops = ops.join(_distinct(rows, key, column, out), key, "left").withColumn(out, F.coalesce(out, F.lit(0)))
    ops = ops.withColumn("owner_turnover", F.col("owner_turnover") / F.col("n_marks").cast("double"))
    shared = (F.col("n_canonical_names") >= 20) & (F.col("coined_rate") < 0.20) & (F.col("pct_cn") < 0.30) & (F.col("avg_goods_items") < 6)
    if screening:
        return ops.withColumn("is_shared_service", shared)
    day = rows.groupBy(key, "filing_dt").agg(F.count("*").alias("n")).groupBy(key).agg(F.max("n").alias("max_marks_one_day"))
    ops = ops.join(day, key).withColumn("peculiarity_score", rounded(weighted_score(WEIGHTS))).withColumn("is_shared_service", shared)
    columns = "n_marks n_name_spellings n_canonical_names n_addresses owner_turnover pct_cn coined_rate marketplace_rate use1a_rate design_rate avg_goods_items goods_chaos refusal_rate no_use_abandon_rate first_year last_year max_marks_one_day peculiarity_score is_shared_service"
    return ops.select(key, *columns.split())


def tier2_score() -> Column:
    """Null where the coined score is; a null flag or count adds nothing."""
    bit = lambda c: F.coalesce(c.cast("int"), F.lit(0)).cast("double")
    return F.col("coined_token_max") + 0.5 * bit(F.col("is_marketplace_class")) + 0.3 * bit(F.col("goods_item_count") > 20) + 0.2 * bit(F.col("single_token"))


def keys_of(df: DataFrame, mark: str = "mark_id_char") -> DataFrame:
    """Distinct non-empty mark keys."""
    return df.select(mark_key(F.col(mark)).alias("key")).where("key != ''").distinct()


def tier1(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Keys of sanctioned records, by event or by status."""
    by_event = tables["event"].where(F.col("event_cd").isin(*SANCTION_EVENTS)).select("serial_no")
    by_status = tables["case_file"].where(F.col("status_cd") == SANCTION_STATUS).select("serial_no")
    hit = by_event.unionByName(by_status).distinct()
    return keys_of(tables["case_file"].join(hit, "serial_no", "left_semi"))


def tier2(features: DataFrame, threshold: float = TIER2_SCORE) -> DataFrame:
    """Keys whose best score reaches the threshold."""
    best = features.select(mark_key(F.col("mark_id_char")).alias("key"), tier2_score().alias("s")).where("key != ''").groupBy("key").agg(F.max("s").alias("s"))
    return best.where(F.col("s") >= threshold).select("key")


def tier3(membership: DataFrame, profile: DataFrame, cases: DataFrame, marks: int = TIER3_MARKS, turnover: float = TIER3_TURNOVER) -> DataFrame:
    """Keys of the members of large operations with a high turnover that are no shared service; profile is small beside membership."""
    ops = profile.where((F.col("n_marks") >= marks) & (F.col("owner_turnover") >= turnover) & ~F.col("is_shared_service")).select("op_key")
    return keys_of(cases.join(membership.join(ops, "op_key", "left_semi"), "serial_no", "left_semi"))


def origin(features: DataFrame, country: str) -> DataFrame:
    """Keys of the owners of one country."""
    return keys_of(features.where(F.col("owner_country") == country))
