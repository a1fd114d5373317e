"""Relational character n-gram scorer: how unlike ordinary words a word is.

A word, letters only and in lower case, is padded to ^^word$.  Every position adds
ln((c(context, char) + 1) / (c(context) + V)) with V = letters + 1; the mean is scaled by
two order statistics of the training words to 0 (ordinary) .. 1 (coined).  Fitting and
scoring are joins and aggregates; distinct words are scored once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.stats import order_statistic, rounded

LOW, HIGH = 0.02, 0.98


def prepared(word: Column) -> Column:
    """Letters only, lower case; null for fewer than two."""
    w = F.regexp_replace(F.lower(word), "[^a-z]", "")
    return F.when(F.length(w) >= 2, w)


def _trigrams(words: DataFrame, word: str) -> DataFrame:
    padded = F.concat(F.lit("^^"), F.col(word), F.lit("$"))
    at = F.explode(F.sequence(F.lit(1), F.length(F.col(word)) + 1))
    rows = words.withColumns({"__p": padded}).withColumn("__i", at)
    return rows.withColumns({"context": F.expr("substring(__p, __i, 2)"), "char": F.expr("substring(__p, __i + 2, 1)")}).drop("__p", "__i")


@dataclass
class Model:
    """grams (context, char, n), contexts (context, n) and one row of v, lo and hi."""

    grams: DataFrame
    contexts: DataFrame
    scale: DataFrame


def counts(words: DataFrame, word: str, times: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(context, char, n) and (context, n) of prepared words, each counted `times`."""
    t = F.sum(times) if times else F.count("*")
    grams = _trigrams(words, word).groupBy("context", "char").agg(t.cast("long").alias("n"))
    return grams, grams.groupBy("context").agg(F.sum("n").alias("n"))


def log_probability(words: DataFrame, word: str, grams: DataFrame, contexts: DataFrame, v: DataFrame) -> DataFrame:
    """(word, lp): mean log-probability of distinct prepared words.  grams and contexts have at most 29^3 and 29^2 rows."""
    rows = _trigrams(words.select(word).distinct(), word)
    rows = rows.join(F.broadcast(grams.withColumnRenamed("n", "__g")), ["context", "char"], "left").join(F.broadcast(contexts.withColumnRenamed("n", "__c")), "context", "left").join(F.broadcast(v))
    lp = F.avg(F.ln((F.coalesce("__g", F.lit(0)) + 1.0) / (F.coalesce("__c", F.lit(0)) + F.col("v"))))
    return rows.groupBy(word).agg(lp.alias("lp"))


def fit(train: DataFrame, word: str) -> Model:
    """From a column of words; repeated words count as often as they stand."""
    words = train.select(prepared(F.col(word)).alias("w")).where("w is not null").groupBy("w").agg(F.count("*").alias("times"))
    grams, contexts = counts(words, "w", "times")
    v = grams.where("char != '$'").agg((F.count_distinct("char") + 1).alias("v"))
    lps = log_probability(words, "w", grams, contexts, v).join(words, "w").select(F.explode(F.expr("array_repeat(lp, int(times))")).alias("lp"))
    scale = v.join(order_statistic(lps, "lp", LOW, "lo")).join(order_statistic(lps, "lp", HIGH, "hi"))
    return Model(grams, contexts, scale)


def scored_words(words: DataFrame, word: str, model: Model) -> DataFrame:
    """(word, score) of distinct prepared words; null where the model has no range."""
    lps = log_probability(words, word, model.grams, model.contexts, model.scale.select("v")).join(F.broadcast(model.scale))
    s = F.when(F.col("hi") != F.col("lo"), F.greatest(F.lit(0.0), F.least(F.lit(1.0), (F.col("hi") - F.col("lp")) / (F.col("hi") - F.col("lo")))))
    return lps.select(word, rounded(s).alias("score"))


def scored(df: DataFrame, key: str, text: Column, model: Model) -> DataFrame:
    """(key, whole, token_max): the score of the whole text as one word, and the best of its tokens."""
    tokens = df.select(key, F.explode(F.split(F.trim(text), r"\s+")).alias("__t")).select(key, prepared(F.col("__t")).alias("w")).where("w is not null")
    whole = df.select(key, prepared(text).alias("w")).where("w is not null")
    table = scored_words(tokens.select("w").union(whole.select("w")), "w", model)
    best = tokens.join(table, "w").groupBy(key).agg(F.max("score").alias("token_max"))
    one = whole.join(table, "w").select(key, F.col("score").alias("whole"))
    return df.select(key).join(one, key, "left").join(best, key, "left")


def training_sample(df: DataFrame, key: str, text: str, date: str, before: str, rows: int = 300_000, least: int = 500) -> DataFrame:
    """The training texts: those dated before a day that come first by md5 of their key; all rows if these are under `least`."""
    early = df.where(F.col(text).isNotNull() & (F.col(date) < F.lit(before).cast("date"))).orderBy(F.md5(F.col(key).cast("string")), key).limit(rows)
    few = early.agg(F.count("*").alias("__n"))
    everything = df.where(F.col(text).isNotNull()).join(F.broadcast(few)).where(F.col("__n") < least).select(text)
    return early.join(F.broadcast(few)).where(F.col("__n") >= least).select(text).union(everything)
