"""Quality rules by document, and host verdicts from shrunk failure rates.

Rule counts come from one Arrow pass.  Failures are summed by host (map-side first, so a
host with a third of all rows is no hot task), an empirical beta prior is fitted to the
hosts' rates by moments, each host's rate is shrunk towards it, and the verdict is joined
back to the documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import kernel as K
from .workspace import Workspace

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: symbols per hundred words
MAX_SYMBOL_PERCENT = 20
#: of all lines that hold a word
MAX_DUP_LINE_PERCENT = 50
#: a host whose shrunk failure rate is above this is rejected
HOST_RATE = 0.5

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def _sums(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=total[1:])
    return total[at[1:]] - total[at[:-1]]


def _block(raw: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    n = len(at) - 1
    starts, ends, words = K.word_spans(raw, at)
    solid = ~K._SEPARATOR[raw]
    chars = _sums(solid & ((raw & 0xC0) != 0x80), at)
    symbols = _sums(_SYMBOL[raw], at)
    # lines
    breaks = np.flatnonzero(raw == 10)
    begin = np.union1d(breaks + 1, at[:-1])
    begin = begin[begin < len(raw)]
    end = np.minimum(np.searchsorted(breaks, begin), len(breaks))
    end = np.append(breaks, len(raw))[end]
    doc = np.searchsorted(at, begin, side="right") - 1
    end = np.minimum(end, at[doc + 1])
    live = np.searchsorted(starts, end) > np.searchsorted(starts, begin)
    begin, end, doc = begin[live], end[live], doc[live]
    key = K.mix64(K.hash_words(raw, begin, end) ^ K.mix64(doc.astype(np.uint64)))
    _, first = np.unique(key, return_index=True)
    lines = np.bincount(doc, minlength=n)
    dup_lines = lines - np.bincount(doc[first], minlength=n)
    # three-word windows
    h = K.hash_words(raw, starts, ends)
    owner = np.repeat(np.arange(n), np.diff(words))
    inside = np.flatnonzero(owner[2:] == owner[:-2]) if len(h) > 2 else np.zeros(0, np.int64)
    marked = np.zeros(len(h), dtype=bool)
    if len(inside):
        key = K.mix64(K.chain(h, 3)[inside] ^ K.mix64(owner[inside].astype(np.uint64)))
        order = np.argsort(key)
        same = key[order][1:] == key[order][:-1]
        twice = np.zeros(len(key), dtype=bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        for k in range(3):
            marked[inside[twice] + k] = True
    return [np.diff(words), chars, symbols, dup_lines, _sums(marked, words), lines]


def counts(rows: DataFrame, text: str) -> DataFrame:
    """rows with the COUNTS and n_lines of column `text` added; a null text has zeros.

    Columns of rows pass through untouched; none may be named like a count.
    """
    at = rows.columns.index(text)
    names = [*rows.columns, *COUNTS, "n_lines"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [_block(raw, cut) for _, _, raw, cut in K.blocks(batch.column(at))]
            got = [np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, np.int64) for k in range(6)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(x.astype(np.int64)) for x in got)], names)

    return rows.mapInArrow(K.sliced(run), T.StructType([*rows.schema.fields, *(T.StructField(c, T.LongType()) for c in (*COUNTS, "n_lines"))]))


def base_failed():
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def rule_failed():
    """The base rules, too many symbols for the words, or mostly repeated lines."""
    return base_failed() | (100 * F.col("n_symbols") > MAX_SYMBOL_PERCENT * F.col("n_words")) | (100 * F.col("n_dup_lines") > MAX_DUP_LINE_PERCENT * F.col("n_lines"))


def host_rates(judged: DataFrame, host: str = "host", failed: str = "rule_failed") -> DataFrame:
    """(host, n, k, rate): failures k of n documents and the rate shrunk to the beta prior of all hosts.

    Prior: mean m = sum(k) / sum(n); strength from the weighted variance v of the hosts' rates,
    (m(1-m) - v) / (v - m(1-m) H/N) for H hosts and N documents, kept within 1 and 1e6 (1e6
    also where the rates vary no more than chance).  A null host is a host of its own.
    """
    per = judged.groupBy(F.col(host).alias("host")).agg(F.count("*").alias("n"), F.sum(F.col(failed).cast("long")).alias("k"))
    mean = per.agg(F.sum("n").alias("all_n"), F.sum("k").alias("all_k"), F.count("*").alias("hosts")).withColumn("m", F.expr("double(all_k) / nullif(all_n, 0)"))
    with_mean = per.withColumn("one", F.lit(0)).join(F.broadcast(mean.withColumn("one", F.lit(0))), "one")
    moment = with_mean.agg(F.first("m").alias("m"), F.first("all_n").alias("all_n"), F.first("hosts").alias("hosts"), F.expr("sum(n * pow(double(k) / n - m, 2)) / sum(n)").alias("v"))
    prior = moment.select("m", F.expr("m * (1 - m)").alias("u"), "v", F.expr("double(hosts) / all_n").alias("share"))
    strength = F.expr("case when v - u * share > 0 then greatest(1.0D, least(1e6D, (u - v) / (v - u * share))) else 1e6D end")
    prior = prior.select("m", strength.alias("strength")).withColumn("one", F.lit(0))
    out = per.withColumn("one", F.lit(0)).join(F.broadcast(prior), "one")  # one row
    return out.select("host", "n", "k", F.expr("(k + m * strength) / (n + strength)").alias("rate"))


def _verdicts(base: DataFrame, host_rate: float, ws: Workspace) -> DataFrame:
    """base (with host and rule_failed) with host_share, host_failed and kept.

    The rates are written first, so that their size is known and decides how they are joined.
    """
    rates = ws.save(host_rates(base), "rates").select(F.col("host").alias("__host"), F.col("rate").alias("host_share"))
    out = base.join(rates, base.host.eqNullSafe(F.col("__host")), "left").drop("__host")
    out = out.withColumn("host_failed", F.col("host_share") > host_rate)
    return out.withColumn("kept", ~F.col("rule_failed") & ~F.col("host_failed"))


def judged(docs: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source", host_rate: float = HOST_RATE) -> DataFrame:
    """One row per input row: id, host, the counts, base_failed, rule_failed, host_failed, host_share and kept.

    kept: no rule failed, and the host's shrunk failure rate (host_share) is at most host_rate.

    A null or empty text has zero counts and fails the base rules.  Null hosts form one host.
    Null ids and repeated rows are rows like others.  Other columns are not read.  No rows
    give no rows.
    """
    ws = Workspace(docs.sparkSession, "rules")
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(host).cast("string").alias("host"), F.col(text).cast("string").alias("text"))
    base = counts(rows, "text").drop("text").withColumn("base_failed", base_failed()).withColumn("rule_failed", rule_failed())
    return _verdicts(ws.save(base, "counts"), host_rate, ws)


def filtered(docs: DataFrame, text: str = "text", host: str = "source", host_rate: float = HOST_RATE) -> DataFrame:
    """The rows of docs that judged() keeps, with the columns of docs."""
    ws = Workspace(docs.sparkSession, "rules")
    names = [f"_{k}" for k in range(len(docs.columns))]
    rows = docs.toDF(*names).withColumn("_text", F.col(names[docs.columns.index(text)]).cast("string")).withColumn("host", F.col(names[docs.columns.index(host)]).cast("string"))
    base = ws.save(counts(rows, "_text").withColumn("rule_failed", rule_failed()).select(*names, "host", "rule_failed"), "counted")
    return _verdicts(base, host_rate, ws).where("kept").select(*names).toDF(*docs.columns)
