"""Embedding near-duplicates by a pivot-permutation index.

A vector is described by its nearest reference points (pivots), in order.  Inverted
lists hold the vectors under every pair of their nearest pivots, PREFIX or more, so two
vectors meet in a list if and only if they share at least two of these: retrieval by
shared-pivot counts.  Of more pivots more are taken, so that no size loses links.

Lists hold ids; vectors come to a list only where its blocks meet, in the precision of the
input.  Two blocks are verified by one product in double precision; a pair counts only in
the first list that it shares, and only link counts and a local spanning forest leave a
block, never all pairs of a group.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .components import components
from .workspace import Workspace, grouped, join_counted

PREFIX = 6
#: members of a block, and rows of a product held at a time
BLOCK, ROWS = 4096, 256
#: distinct vectors that may serve as pivots
SAMPLE = 16384


def pivot_count(n: int) -> int:
    """128 pivots, more with the square root of the number of vectors, SAMPLE at most: lists keep their length."""
    return max(128, min(SAMPLE, math.isqrt(max(0, n) // 4)))


def prefix_length(pivots: int) -> int:
    """PREFIX nearest of up to 128 pivots, one more whenever pivots double: near vectors share two as often."""
    return PREFIX + (max(0, pivots - 1) // 128).bit_length()


def _rows(column: pa.Array) -> list[np.ndarray]:
    return [np.asarray(x, dtype=np.float64) for x in column.to_pylist()]


def _fit(v: np.ndarray, dim: int) -> np.ndarray:
    out = np.zeros(dim)
    out[: min(dim, len(v))] = v[:dim]
    return out


def _unit(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max(axis=-1, keepdims=True)
    return v / np.linalg.norm(v, axis=-1, keepdims=True)


def _described(classes: DataFrame, pivots: np.ndarray, kind: str) -> DataFrame:
    """rep, copies, vector in the precision `kind` and the nearest pivots in order of nearness (ties: the smaller number)."""
    shared, length = classes.sparkSession.sparkContext.broadcast(pivots), prefix_length(len(pivots))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = shared.value
        for batch in batches:
            raw, near = [], []
            for v in _rows(batch.column(2)):
                raw.append(v.astype(kind).tobytes())
                score = -(p @ _fit(_unit(v), p.shape[1]))
                if len(score) > 4 * length:
                    at = np.flatnonzero(score <= np.partition(score, length - 1)[length - 1])
                else:
                    at = np.arange(len(score))
                near.append(at[np.argsort(score[at], kind="stable")[:length]].tolist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(raw, pa.binary()), pa.array(near, pa.list_(pa.int32()))], ["rep", "copies", "raw", "near"])

    return classes.select("rep", "copies", "vector").mapInArrow(run, "rep long, copies long, raw binary, near array<int>")


def _roots(n: int, a: np.ndarray, b: np.ndarray, root: np.ndarray) -> np.ndarray:
    """The least place that links a - b, and those already in root, reach from each of n places."""
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, root):
            return root
        root = new


def _first_shared(near: np.ndarray, x: np.ndarray, y: np.ndarray, p: int, q: int) -> np.ndarray:
    """Whether p and q are the two smallest pivots that the descriptions x[k] and y[k] share."""
    out = np.zeros(len(x), dtype=bool)
    for k in range(0, len(x), 65536):
        a, b = near[x[k : k + 65536]], near[y[k : k + 65536]]
        both = (a[:, :, None] == b[:, None, :]).any(axis=2)
        out[k : k + 65536] = (both & (a < q) & (a != p)).sum(axis=1) == 0
    return out


def _compare(t: pa.Table, cosine: float, kind: str) -> pa.RecordBatch | None:
    """Links between block i and block j of one list: per vector its linked rows so far and a root of its local component."""
    i, j, mine = (t.column(k).to_numpy() for k in ("i", "j", "mine"))
    rep, copies = t.column("rep").to_numpy(), t.column("copies").to_numpy()
    raw = [x.as_buffer() for x in t.column("raw")]
    first, second = t.column("p")[0].as_py(), t.column("q")[0].as_py()
    near = np.array(t.column("near").to_pylist(), dtype=np.int32)
    one, two = np.flatnonzero(mine == i[0]), np.flatnonzero(mine == j[0])
    links, root = np.zeros(len(rep), dtype=np.int64), np.arange(len(rep))
    sizes = np.array([len(x) for x in raw])
    for size in np.unique(sizes):
        a, b = one[sizes[one] == size], two[sizes[two] == size]
        if not len(a) or not len(b):
            continue
        left, right = (_unit(np.stack([np.frombuffer(raw[k], kind) for k in at]).astype(np.float64)) for at in (a, b))
        for k in range(0, len(a), ROWS):
            x, y = np.nonzero(left[k : k + ROWS] @ right.T >= cosine)
            x, y = a[k + x], b[y]
            if i[0] == j[0]:
                once = x < y
                x, y = x[once], y[once]
            if len(x):
                own = _first_shared(near, x, y, first, second)
                x, y = x[own], y[own]
            if len(x):
                links += np.bincount(x, weights=copies[y], minlength=len(rep)).astype(np.int64)
                links += np.bincount(y, weights=copies[x], minlength=len(rep)).astype(np.int64)
                root = _roots(len(rep), x, y, root)
    at = np.flatnonzero(links)
    if not len(at):
        return None
    return pa.RecordBatch.from_arrays([pa.array(rep[at]), pa.array(links[at]), pa.array(rep[root[at]])], ["rep", "links", "root"])


def near_vectors(table: DataFrame, key: str = "vec_id", vector: str = "embedding", cosine: float = 0.9, pivots: int | None = None) -> DataFrame:
    """One row per input row: id, n_links, component_id (smallest id that links reach) and kept (id = component_id).

    n_links counts the other rows linked directly: a cosine of `cosine` or more, in double
    precision.  pivots: their number, by default pivot_count(); they are chosen by a hash
    from the distinct vectors, SAMPLE at most, and every row is indexed.

    A vector that is null, empty or zero, or that holds a null or non-finite component, links
    with nothing; neither do vectors of different lengths.  Equal vectors are one class and
    are compared once.  A row with a null id links with nothing and is kept, its
    component_id null.  Rows that share an id are judged each by its own vector.  Other columns are not read.  No rows give no rows.
    """
    spark = table.sparkSession
    ws = Workspace(spark, "pivots")
    given = table.schema[vector].dataType
    kind = "<f4" if isinstance(given, T.ArrayType) and isinstance(given.elementType, T.FloatType) else "<f8"
    rows = table.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    good = F.col("id").isNotNull() & F.coalesce(F.size("vector") > 0, F.lit(False))
    good &= F.coalesce(F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))), F.lit(False))
    good &= F.coalesce(F.exists("vector", lambda x: x != 0), F.lit(False))
    # adding 0.0 makes a negative zero a plain one
    rows = rows.withColumn("vector", F.when(good, F.transform("vector", lambda x: x + F.lit(0.0))))
    # classes are told apart by the vectors themselves; rows find theirs by 96 bits of hash
    rows = rows.withColumns({"h1": F.xxhash64("vector"), "h2": F.hash("vector")})
    live = rows.where("vector is not null")
    classes = live.groupBy("vector").agg(F.min("id").alias("id"), F.count("*").alias("copies"))
    classes = ws.save(classes.withColumn("rep", F.monotonically_increasing_id()), "classes")
    many = classes.count()
    want = pivots or pivot_count(many)
    chosen = [np.asarray(r[0]) for r in classes.orderBy(F.xxhash64("vector", F.lit("pivot")), "id").limit(want).select("vector").collect()]
    out = rows.where("vector is null").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    if chosen:
        dim = max(len(v) for v in chosen)
        p = _unit(np.stack([_fit(v / np.abs(v).max(), dim) for v in chosen]))
        described = ws.save(_described(classes, p, kind), "described")
        pair = "transform(filter(sequence(0, size(near) * size(near) - 1), k -> element_at(near, int(k div size(near)) + 1) < element_at(near, int(k % size(near)) + 1)), k -> struct(element_at(near, int(k div size(near)) + 1) as p, element_at(near, int(k % size(near)) + 1) as q))"
        listed = described.select("rep", F.explode(F.expr(pair if len(chosen) > 1 else "array(struct(near[0] as p, near[0] + 1 as q))")).alias("at")).select("rep", "at.p", "at.q")
        lists = listed.groupBy("p", "q").agg(F.count("*").alias("n")).where("n > 1").withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
        length = prefix_length(len(chosen))
        met = join_counted(listed, lists, ["p", "q"], "n", many * max(1, length * (length - 1) // 2))
        met = met.withColumn("mine", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        met = met.select("p", "q", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine", "rep").join(described, "rep")
        found = ws.save(grouped(met, ["p", "q", "i", "j"], lambda t: _compare(t, cosine, kind), "rep long, links long, root long"), "found")
        labels = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")), ws)
        links = found.groupBy("rep").agg(F.sum("links").alias("links"))
        per = classes.join(links, "rep", "left").join(labels.withColumnRenamed("id", "rep"), "rep", "left")
        per = per.select("id", F.xxhash64("vector").alias("h1"), F.hash("vector").alias("h2"), "copies", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component"))
        per = ws.save(per, "judged")
        least = per.groupBy("component").agg(F.min("id").alias("component_id"), F.count("*").alias("n"))
        per = join_counted(per.drop("id"), least, "component", "n", many)
        out = out.union(join_counted(live.select("id", "h1", "h2"), per, ["h1", "h2"], "copies", live.count()).select("id", "n_links", "component_id"))
    out = out.select("id", F.col("n_links").cast("long").alias("n_links"), "component_id")
    return out.withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)))
