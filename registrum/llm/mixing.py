"""Mixing sources to target weights by hierarchical budgeting, in DataFrame functions only.

The documents form a tree of domain, language and source.  A budget in tokens goes down
the tree: children share their parent's budget by weight, no child gets more than its
subtree can give (its tokens times the epochs allowed), and what a child cannot use goes
to its siblings before it goes to siblings of an ancestor.  Each leaf then takes a prefix
of its budget's length from its stream of epochs, each a seeded order of the leaf's documents.

Order inside a leaf needs no task that holds a leaf: documents fall into BUCKETS ranges
of their seeded hash, positions are running sums inside a bucket plus the totals of the
buckets before it.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .workspace import Workspace

HEX = 3
#: hash ranges in a leaf and epoch
BUCKETS = 16**HEX
WORD = r"[^\x20\x09-\x0D]+"

#: production parameters: integer weights by level; names that are not listed weigh DEFAULT
DEFAULT = 1
DOMAIN_WEIGHTS = {"hub": 2, "tail": 3}
LANGUAGE_WEIGHTS = {"en": 5, "de": 2, "fr": 2, "es": 1}
SOURCE_WEIGHTS: dict[str, int] = {}
EPOCHS = 3
SEED = "mix-1"


def domain_of(source: Column) -> Column:
    """The default domain: the hub source src0, or the tail of all others."""
    return F.when(source == "src0", F.lit("hub")).otherwise(F.lit("tail"))


def tokens_of(text: Column) -> Column:
    """Words of a text, and one for its end."""
    return (F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)) + 1).cast("long")


def _weight(name: Column, weights: Mapping[str, int]) -> Column:
    out = F.lit(DEFAULT)
    for k, v in weights.items():
        out = F.when(name == k, F.lit(v)).otherwise(out)
    return out.cast("long")


def _share(nodes: DataFrame, parent: Sequence[str]) -> DataFrame:
    """Fill children (weight w, capacity c) from their parent's budget b: adds `got`.

    Children in order of c / w take c as long as the even share of what is left covers it; the
    first that it does not cover, and all after it, share the rest by weight.  Shares are whole
    numbers, rounded down: less than a token a child stays unspent.
    """
    order = W.partitionBy(*parent).orderBy((F.col("c").cast("double") / F.col("w")).asc(), F.col("name").asc())
    before = order.rowsBetween(W.unboundedPreceding, -1)
    after = order.rowsBetween(0, W.unboundedFollowing)
    out = nodes.withColumns({"c0": F.coalesce(F.sum("c").over(before), F.lit(0)), "w0": F.sum("w").over(after)})
    out = out.withColumn("fits", (F.col("b") - F.col("c0")) * F.col("w") >= F.col("c") * F.col("w0"))
    # all() over the prefix: once a child is not covered, none after it is
    out = out.withColumn("fits", F.min("fits").over(order.rowsBetween(W.unboundedPreceding, 0)))
    rest = W.partitionBy(*parent)
    out = out.withColumns({"cf": F.coalesce(F.sum(F.when(F.col("fits"), F.col("c"))).over(rest), F.lit(0)), "wr": F.sum(F.when(~F.col("fits"), F.col("w"))).over(rest)})
    got = F.when(F.col("fits"), F.col("c")).otherwise(F.expr("((b - cf) * w) div wr"))
    return out.withColumn("got", got.cast("long")).drop("c0", "w0", "fits", "cf", "wr")


def budgets(leaves: DataFrame, budget: Column, domains: Mapping[str, int], languages: Mapping[str, int], sources: Mapping[str, int], epochs: int) -> DataFrame:
    """(domain, lang, source, available, want) of leaves (domain, lang, source, available).

    budget: an expression over the total `all_tokens`.  The tables here have one row per node.
    """
    leaf = leaves.withColumn("cap", F.col("available") * epochs)
    lang = leaf.groupBy("domain", "lang").agg(F.sum("cap").alias("cap"))
    dom = lang.groupBy("domain").agg(F.sum("cap").alias("cap"))
    total = leaf.agg(F.sum("available").alias("all_tokens")).select(F.lit(0).alias("one"), budget.cast("long").alias("b"))
    top = dom.withColumn("one", F.lit(0)).join(total, "one").select("one", "b", "domain", F.col("domain").alias("name"), F.col("cap").alias("c"), _weight(F.col("domain"), domains).alias("w"))
    top = _share(top, ["one"]).select("domain", F.col("got").alias("b"))
    mid = lang.join(top, "domain").select("b", "domain", "lang", F.col("lang").alias("name"), F.col("cap").alias("c"), _weight(F.col("lang"), languages).alias("w"))
    mid = _share(mid, ["domain"]).select("domain", "lang", F.col("got").alias("b"))
    low = leaf.join(mid, ["domain", "lang"]).select("b", "domain", "lang", "source", "available", F.col("source").alias("name"), F.col("cap").alias("c"), _weight(F.col("source"), sources).alias("w"))
    return _share(low, ["domain", "lang"]).select("domain", "lang", "source", "available", F.col("got").alias("want"))


LEAF = ["domain", "lang", "source"]


def _rows(docs: DataFrame, key: str, text: str, lang: str, source: str, domain: Column | None, *more: Column) -> DataFrame:
    """__id, the leaf, tokens and __tie of every document, and more."""
    named = F.coalesce(F.col(source).cast("string"), F.lit(""))
    return docs.select(
        F.col(key).alias("__id"),
        (domain if domain is not None else domain_of(named)).alias("domain"),
        F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("lang"),
        named.alias("source"),
        tokens_of(F.col(text)).alias("tokens"),
        F.xxhash64(text).alias("__tie"),
        *more,
    )


def _order(seed: str) -> Column:
    """The seeded hash of a document in an epoch."""
    return F.md5(F.concat_ws(":", F.lit(seed), "epoch", F.coalesce(F.col("__id").cast("string"), F.lit(""))))


def _plan(light: DataFrame, ws: Workspace, budget: Column | None, domains: Mapping[str, int], languages: Mapping[str, int], sources: Mapping[str, int], epochs: int) -> DataFrame:
    budget = F.col("all_tokens") if budget is None else budget
    return ws.save(budgets(light.groupBy(*LEAF).agg(F.sum("tokens").alias("available")), budget, domains, languages, sources, epochs), "plan")


def selection(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    domain: Column | None = None,
    domains: Mapping[str, int] = DOMAIN_WEIGHTS,
    languages: Mapping[str, int] = LANGUAGE_WEIGHTS,
    sources: Mapping[str, int] = SOURCE_WEIGHTS,
    epochs: int = EPOCHS,
    budget: Column | None = None,
    seed: str = SEED,
) -> DataFrame:
    """The drawn documents: doc_id, domain, lang, source, epoch, start, tokens, take.

    start: position of the document in its leaf's stream of the epoch; take: its tokens inside
    the leaf's budget, fewer than `tokens` only for the last document of a leaf's prefix.  A
    document can come back once in each epoch.  budget: over `all_tokens`.

    A null text has one token, its end.  A null language or source is a leaf of its own, named
    ''.  Rows that repeat are rows: each is drawn by itself; rows with equal id (or a null id,
    counted as '') tie in the seeded order and are told apart by their text's hash; equal rows
    are interchangeable.  No rows give no rows.
    """
    ws = Workspace(docs.sparkSession, "mixing")
    light = ws.save(_rows(docs, key, text, lang, source, domain), "rows")
    plan = _plan(light, ws, budget, domains, languages, sources, epochs)
    drawn = light.join(plan.where("want > 0"), LEAF).withColumn("epoch", F.explode(F.sequence(F.lit(0), F.expr("int((want - 1) div available)"))))
    drawn = drawn.withColumn("__h", _order(seed))
    drawn = drawn.withColumn("__bucket", F.substring("__h", 1, HEX))
    totals = drawn.groupBy(*LEAF, "epoch", "__bucket").agg(F.sum("tokens").alias("__sum"))
    before = W.partitionBy(*LEAF, "epoch").orderBy("__bucket").rowsBetween(W.unboundedPreceding, -1)
    totals = totals.withColumn("__before", F.coalesce(F.sum("__sum").over(before), F.lit(0))).drop("__sum")
    inside = W.partitionBy(*LEAF, "epoch", "__bucket").orderBy("__h", "__id", "__tie").rowsBetween(W.unboundedPreceding, -1)
    drawn = drawn.withColumn("__in", F.coalesce(F.sum("tokens").over(inside), F.lit(0)))
    drawn = drawn.join(totals, [*LEAF, "epoch", "__bucket"]).withColumn("start", (F.col("__before") + F.col("__in")).cast("long"))
    drawn = drawn.withColumn("take", F.least("tokens", F.expr("want - epoch * available - start")).cast("long")).where("take > 0")
    return drawn.select(F.col("__id").alias("doc_id"), *LEAF, F.col("epoch").cast("long").alias("epoch"), "start", "tokens", "take")


def mixed(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    n_chars: str | None = "n_chars",
    lang: str = "lang",
    source: str = "source",
    domain: Column | None = None,
    domains: Mapping[str, int] = DOMAIN_WEIGHTS,
    languages: Mapping[str, int] = LANGUAGE_WEIGHTS,
    sources: Mapping[str, int] = SOURCE_WEIGHTS,
    epochs: int = EPOCHS,
    budget: Column | None = None,
    seed: str = SEED,
) -> DataFrame:
    """docs as selection() draws them, with the columns of docs: a document once for each epoch that takes it.

    The document at the end of a leaf's budget is cut to its first words, joined by spaces, and
    its n_chars, where docs has it, brought up to date.

    Texts stay where they are: a leaf's prefix ends in one range of the hash of its last epoch;
    ranges before it are drawn whole, and only the documents of that one range are put in order.
    """
    ws = Workspace(docs.sparkSession, "mixing")
    light = ws.save(_rows(docs, key, text, lang, source, domain), "rows")
    plan = _plan(light, ws, budget, domains, languages, sources, epochs).where("want > 0").withColumn("last", F.expr("int((want - 1) div available)"))
    sums = light.join(plan, LEAF).withColumn("epoch", F.col("last")).groupBy(*LEAF, "want", "available", "last", F.substring(_order(seed), 1, HEX).alias("cut")).agg(F.sum("tokens").alias("n"))
    before = W.partitionBy(*LEAF).orderBy("cut").rowsBetween(W.unboundedPreceding, -1)
    # tokens of the last epoch that are left for a range; at most BUCKETS rows a leaf
    sums = sums.withColumn("left", F.expr("want - last * available") - F.coalesce(F.sum("n").over(before), F.lit(0)))
    cuts = ws.save(sums.where("left > 0 and left <= n").select(*LEAF, "last", "cut", "left"), "cuts")
    names = list(docs.columns)
    kept = [f"__c{k}" for k in range(len(names))]
    rows = _rows(docs, key, text, lang, source, domain, *(F.col(c).alias(k) for c, k in zip(names, kept, strict=True)))
    rows = rows.join(cuts, LEAF).withColumn("epoch", F.explode(F.sequence(F.lit(0), "last"))).withColumn("__h", _order(seed))
    bucket, ends = F.substring("__h", 1, HEX), F.col("epoch") == F.col("last")
    whole = rows.where(~ends | (bucket < F.col("cut"))).select(*kept)
    inside = W.partitionBy(*LEAF).orderBy("__h", "__id", "__tie").rowsBetween(W.unboundedPreceding, -1)
    edge = rows.where(ends & (bucket == F.col("cut"))).withColumn("take", F.col("left") - F.coalesce(F.sum("tokens").over(inside), F.lit(0))).where("take > 0")
    at, short = F.col(kept[names.index(text)]), F.col("take") < F.col("tokens")
    # regexp_extract_all would hold a very long text's words at once; only a leaf's last document is cut
    words = F.when(short, F.array_join(F.slice(F.regexp_extract_all(at, F.lit(WORD), 0), F.lit(1), F.col("take").cast("int")), " ")).otherwise(at)
    edge = edge.withColumn(kept[names.index(text)], words)
    if n_chars in names:
        count = kept[names.index(n_chars)]
        edge = edge.withColumn(count, F.when(short, F.length(at)).otherwise(F.col(count)).cast(docs.schema[n_chars].dataType))
    return whole.union(edge.select(*kept)).toDF(*names)
