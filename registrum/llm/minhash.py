"""MinHash near-duplicates with sequential Bayesian verification.

Plan.  (1) One Arrow pass gives each document its number of distinct shingles, two
64-bit fingerprints of the shingle set and a signature of 128 minima.  (2) Documents
with equal sets become one class, so copies cost no pairs.  (3) Signatures are banded;
a bucket offers the pairs of its smallest member with all others.  (4) A pair's
signatures are compared batch by batch; it is pruned once the posterior probability of
similarity >= threshold (uniform prior) is under the miss probability.  (5) Survivors
are confirmed on full shingle sets.  (6) Buckets whose members are still in several
components offer their remaining pairs, block against block, to the same test.  A
bucket of any size is thus resolved exactly and no task holds a whole bucket.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import kernel as K
from .components import components
from .workspace import Workspace, empty, grouped, join_counted

HASHES, BANDS, ROWS, BATCH = 128, 32, 4, 16
#: members of a block; two blocks of a bucket meet in one task
BLOCK = 1024


@lru_cache
def _family(seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.integers(0, 2**31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1), rng.integers(0, 2**32, HASHES, dtype=np.uint32)


def signature(shingles: np.ndarray) -> np.ndarray:
    """The HASHES minima of a non-empty set of 64-bit hashes."""
    a, b = _family()
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(HASHES, 0xFFFFFFFF, dtype=np.uint32)
    for k in range(0, len(x), 1024):
        np.minimum(least, (x[k : k + 1024, None] * a + b).min(axis=0), out=least)
    return least


@lru_cache
def least_matches(threshold: float, miss: float) -> tuple[int, ...]:
    """After each batch of n comparisons the fewest matches m with P(similarity >= threshold | m of n) >= miss."""
    grid = (np.arange(20_000) + 0.5) / 20_000
    out = []
    for n in range(BATCH, HASHES + 1, BATCH):
        for m in range(n + 1):
            logs = m * np.log(grid) + (n - m) * np.log1p(-grid)
            mass = np.exp(logs - logs.max())
            if mass[grid >= threshold].sum() >= miss * mass.sum():
                break
        out.append(m)
    return tuple(out)


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _binary(rows: list[bytes]) -> pa.Array:
    return pa.array(rows, type=pa.binary())


def _matrix(column: pa.Array | pa.ChunkedArray, kind: type = np.uint32) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.frombuffer(b"".join(column.to_pylist()), dtype=kind).reshape(len(column), HASHES)


def _survivors(left: np.ndarray, right: np.ndarray, bounds: tuple[int, ...], p: np.ndarray | None = None, q: np.ndarray | None = None) -> np.ndarray:
    """Indexes of the pairs (row p of left, row q of right; by default row by row) that no batch prunes."""
    p = np.arange(len(left)) if p is None else p
    q = p if q is None else q
    alive, found = np.arange(len(p)), np.zeros(len(p), dtype=np.int64)
    for k, least in enumerate(bounds):
        at = slice(k * BATCH, (k + 1) * BATCH)
        found = found + (left[p[alive], at] == right[q[alive], at]).sum(axis=1)
        keep = found >= least
        alive, found = alive[keep], found[keep]
        if not len(alive):
            break
    return alive


def _sketch(s: np.ndarray) -> tuple[int, int, int]:
    """Size and two 64-bit fingerprints of a set."""
    return len(s), int(s.sum(dtype=np.uint64)), int(K.mix64(s + K.U64(0x1234567)).sum(dtype=np.uint64))


def sketches(docs: DataFrame, key: str, text: str, words: int) -> DataFrame:
    """One row per document: row (unique), id, n_shingles, fingerprints f1 and f2, and the signature (null without words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            prints, sig = [], []
            for s in K.shingle_sets(batch.column(1), words):
                prints.append(_sketch(s))
                sig.append(signature(s).tobytes() if len(s) else None)
            n, f1, f2 = np.array(prints, np.uint64).reshape(-1, 3).T
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(n)) + row), batch.column(0), pa.array(n.astype(np.int64)), _long(f1), _long(f2), _binary(sig)], ["row", "id", "n_shingles", "f1", "f2", "sig"])
            row += len(n)

    return docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text")).mapInArrow(K.sliced(run), "row long, id long, n_shingles long, f1 long, f2 long, sig binary")


def _band_keys(sig: np.ndarray) -> np.ndarray:
    """A 64-bit key of each of the BANDS bands of each signature."""
    sig = sig.astype(np.uint64)
    out = np.empty((len(sig), BANDS), np.uint64)
    for b in range(BANDS):
        h = np.full(len(sig), b + 1, np.uint64)
        for r in range(ROWS):
            h = K.mix64(h * K.U64(0xD6E8FEB86659FD93) + sig[:, b * ROWS + r])
        out[:, b] = h
    return out


def _bands(classes: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                keys, rep = _band_keys(_matrix(batch.column(1))), batch.column(0).to_numpy()
                yield pa.RecordBatch.from_arrays([_long(keys.T.ravel()), pa.array(np.repeat(np.arange(BANDS, dtype=np.int32), len(rep))), pa.array(np.tile(rep, BANDS))], ["bucket", "band", "rep"])

    return classes.select("rep", "sig").mapInArrow(run, "bucket long, band int, rep long")


def _prune(pairs: DataFrame, signatures: DataFrame, bounds: tuple[int, ...]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                keep = _survivors(_matrix(batch.column(2)), _matrix(batch.column(3)), bounds)
                yield batch.select([0, 1]).take(pa.array(keep))

    left = signatures.select(F.col("rep").alias("a"), F.col("sig").alias("sig_a"))
    right = signatures.select(F.col("rep").alias("b"), F.col("sig").alias("sig_b"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "sig_a", "sig_b").mapInArrow(K.sliced(run), "a long, b long")


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs with 100 * intersection >= percent * union."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for i in range(batch.num_rows):
                x, y = (np.frombuffer(batch.column(c)[i].as_buffer(), np.uint64) for c in (2, 3))
                both = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * both >= percent * (len(x) + len(y) - both):
                    keep.append(i)
            yield batch.select([0, 1]).take(pa.array(keep, pa.int64()))

    left = sets.select(F.col("rep").alias("a"), F.col("hashes").alias("set_a"))
    right = sets.select(F.col("rep").alias("b"), F.col("hashes").alias("set_b"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "set_a", "set_b").mapInArrow(K.sliced(run), "a long, b long")


def _sets(docs: DataFrame, key: str, text: str, wanted: DataFrame, words: int) -> DataFrame:
    """(rep, hashes): the shingle sets of wanted (id, f1, f2, rep), a document's by its id and fingerprints."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rep, out = [], []
            for f1, f2, r, s in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3)), K.shingle_sets(batch.column(0), words), strict=True):
                if _sketch(s)[1:] == (f1 % 2**64, f2 % 2**64):
                    rep.append(r)
                    out.append(s.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(rep, pa.int64()), _binary(out)], ["rep", "hashes"])

    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    return rows.join(wanted, "id").select("text", "f1", "f2", "rep").mapInArrow(K.sliced(run), "rep long, hashes binary")


def _suspects(members: DataFrame, labels: DataFrame, classes: DataFrame, bounds: tuple[int, ...], percent: int) -> DataFrame:
    """Members of buckets that are not yet in one component, with the partners that no test has ruled out.

    Rows (bucket, range, i, j, rep, place, partners) of block i against block j of a bucket: a row
    for every member of a pair, the partners, a bit for each place, in the row of one of them; rows
    are no more than the block's members.  Two sets whose sizes differ too much cannot be near, so a bucket falls into ranges
    of sizes, each met by itself and by the next, and only these into blocks.  A member travels
    with one byte of each minimum, whose chance agreements spare pairs and rule none out, and 32
    bits of each band's key, since a pair belongs to the first bucket that it shares.
    """
    total = members.count()
    rows = members.where("n > 2").drop("n").join(labels.select("rep", "component"), "rep", "left").withColumn("label", F.coalesce("component", "rep"))
    # members of a bucket's largest component are done with each other; only the others meet all
    sizes = rows.groupBy("bucket", "label").agg(F.count("*").alias("c"))
    mixed = sizes.groupBy("bucket").agg(F.max_by("label", F.struct("c", "label")).alias("main"), F.sum("c").alias("n"), F.count("*").alias("labels")).where("labels > 1").drop("labels")
    rows = join_counted(rows.where("rep != center"), mixed, "bucket", "n", total).select("bucket", "band", "rep", "label", (F.col("label") == F.col("main")).alias("inside"))
    # wider ranges than the limit's are as good; this keeps rounding from splitting a pair
    scale = max(math.log(100 / percent), 0.01) * (1 + 1e-9)
    rows = rows.join(classes.select("rep", "n_shingles"), "rep").withColumn("span", F.floor(F.log(F.col("n_shingles").cast("double")) / scale).cast("long"))
    # range r holds the pairs inside span r, and those of r with r + 1
    rows = rows.withColumn("range", F.explode(F.array(F.col("span") - 1, "span")))
    per = rows.groupBy("bucket", "range").agg(F.count_if("inside").alias("in"), F.count_if(~F.col("inside")).alias("out")).where("out > 0 and in + out > 1")
    per = per.select("bucket", "range", (F.col("in") + F.col("out")).alias("n"), F.ceil(F.col("in") / BLOCK).cast("int").alias("first"), F.ceil(F.col("out") / BLOCK).cast("int").alias("others"))
    rows = join_counted(rows, per, ["bucket", "range"], "n", total)
    hashed = F.xxhash64("rep")
    rows = rows.withColumn("mine", F.when(F.col("inside"), F.pmod(hashed, F.col("first"))).otherwise(F.col("first") + F.pmod(hashed, F.col("others"))).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.when(F.col("inside"), F.col("first")).otherwise(F.lit(0)), F.col("first") + F.col("others") - 1)))
    rows = rows.select("bucket", "range", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine", "band", "rep", "label", "n_shingles", "span").join(_bytes(classes), "rep")

    def work(t: pa.Table) -> pa.RecordBatch | None:
        i, j, mine, rep, label, size, span = (t.column(k).to_numpy() for k in ("i", "j", "mine", "rep", "label", "n_shingles", "span"))
        sig, band = _matrix(t.column("sig"), np.uint8), t.column("band")[0].as_py()
        keys = np.frombuffer(b"".join(t.column("keys").to_pylist()), np.uint32).reshape(len(rep), BANDS)
        one, two = np.flatnonzero(mine == i[0]), np.flatnonzero(mine == j[0])
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for k in range(0, len(one), 64):
            part = one[k : k + 64]
            near = label[part][:, None] != label[two][None, :]
            small, large = np.minimum(size[part][:, None], size[two][None, :]), np.maximum(size[part][:, None], size[two][None, :])
            near &= 100 * small >= percent * large
            # pairs inside the next range are that range's
            near &= np.minimum(span[part][:, None], span[two][None, :]) == t.column("range")[0].as_py()
            if i[0] == j[0]:
                near &= rep[part][:, None] < rep[two][None, :]
            p, q = np.nonzero(near)
            p, q = part[p], two[q]
            for b in range(band):
                new = keys[p, b] != keys[q, b]
                p, q = p[new], q[new]
            keep = _survivors(sig, sig, bounds, p, q)
            found.append((p[keep].astype(np.int32), q[keep].astype(np.int32)))
        p, q = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, int), np.zeros(0, int))
        if not len(p):
            return None
        named, place = np.unique(np.concatenate([p, q]), return_inverse=True)
        bits = np.zeros((len(named), len(named)), dtype=bool)
        bits[place[: len(p)], place[len(p) :]] = True
        bits = np.packbits(bits, axis=1)
        first = t.slice(0, 1).select(["bucket", "range", "i", "j"]).to_pylist()[0]
        columns = [pa.array([first[c]] * len(named), k) for c, k in (("bucket", pa.int64()), ("range", pa.int64()), ("i", pa.int32()), ("j", pa.int32()))]
        return pa.RecordBatch.from_arrays([*columns, pa.array(rep[named]), pa.array(np.arange(len(named), dtype=np.int32)), _binary([x.tobytes() for x in bits])], ["bucket", "range", "i", "j", "rep", "place", "partners"])

    return grouped(rows, ["bucket", "range", "i", "j"], work, "bucket long, range long, i int, j int, rep long, place int, partners binary")


def _bytes(classes: DataFrame) -> DataFrame:
    """(rep, sig, keys): the lowest byte of each minimum, and 32 bits of each band's key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                sig = _matrix(batch.column(1))
                low, keys = (sig & 0xFF).astype(np.uint8), _band_keys(sig).astype(np.uint32)
                yield pa.RecordBatch.from_arrays([batch.column(0), _binary([x.tobytes() for x in low]), _binary([x.tobytes() for x in keys])], ["rep", "sig", "keys"])

    return classes.select("rep", "sig").mapInArrow(run, "rep long, sig binary, keys binary")


def _resolved(suspects: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links that join the suspects of a block: exact comparison of all named pairs, a spanning forest out."""

    def work(t: pa.Table) -> pa.RecordBatch | None:
        rep = dict(zip(t.column("place").to_pylist(), t.column("rep").to_pylist(), strict=True))
        held = {k: np.frombuffer(h.as_buffer(), np.uint64) for k, h in zip(rep, t.column("hashes"), strict=True)}
        root = {k: k for k in held}

        def top(k: int) -> int:
            while root[k] != k:
                root[k] = root[root[k]]
                k = root[k]
            return k

        out = []
        for u, bits in zip(rep, t.column("partners"), strict=True):
            partners = np.flatnonzero(np.unpackbits(np.frombuffer(bits.as_buffer(), np.uint8))).tolist()
            partners = [v for v in partners if v in held and top(v) != top(u)]
            if not partners:
                continue
            x, ys = held[u], [held[v] for v in partners]
            joined = np.concatenate(ys)
            at = np.minimum(np.searchsorted(x, joined), len(x) - 1)
            size = np.array([len(y) for y in ys])
            both = np.add.reduceat((x[at] == joined).astype(np.int64), np.cumsum(size) - size)
            for k in np.flatnonzero(100 * both >= percent * (len(x) + size - both)):
                a, b = top(u), top(partners[k])
                if a != b:
                    root[max(a, b)] = min(a, b)
                    out.append((rep[u], rep[partners[k]]))
        if not out:
            return None
        return pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int64()), pa.array([y for _, y in out], pa.int64())], ["a", "b"])

    rows = suspects.join(sets, "rep").select("bucket", "range", "i", "j", "rep", "place", "partners", "hashes")
    return grouped(rows, ["bucket", "range", "i", "j"], work, "a long, b long")


def _classes(docs: DataFrame, key: str, text: str, words: int, percent: int, miss: float, ws: Workspace) -> tuple[DataFrame, DataFrame]:
    """(sketch, classes): sketches(), and every class of equal sets (f1, f2, n_shingles), with its smallest id, and its component."""
    sketch = ws.save(sketches(docs, key, text, words), "sketches")
    least = F.min(F.struct("id", "row"))
    classes = sketch.where("n_shingles > 0 and id is not null").groupBy("f1", "f2", "n_shingles").agg(least.alias("least"), F.count("*").alias("copies"), F.first("sig").alias("sig"))
    classes = ws.save(classes.select("f1", "f2", "n_shingles", F.col("least.id").alias("id"), F.col("least.row").alias("rep"), "copies", "sig"), "classes")
    bands = _bands(classes)
    multi = bands.groupBy("bucket").agg(F.min("rep").alias("center"), F.count("*").alias("n")).where("n > 1")
    members = ws.save(join_counted(bands, multi, "bucket", "n", classes.count() * BANDS), "members")
    bounds = least_matches(percent / 100, miss)
    stars = ws.save(_prune(members.where("rep != center").select(F.col("center").alias("a"), F.col("rep").alias("b")).distinct(), classes, bounds), "stars")
    reps = stars.select("a").union(stars.select("b")).union(members.where("n > 2").select("rep")).distinct().toDF("rep")
    sets = ws.save(_sets(docs, key, text, classes.select("id", "f1", "f2", "rep").join(reps, "rep"), words), "sets")
    links = ws.save(_confirm(stars, sets, percent), "links")
    labels = ws.save(components(links, ws, "first").withColumnRenamed("id", "rep"), "labels")
    suspects = ws.save(_suspects(members, labels, classes, bounds, percent), "suspects")
    if not empty(suspects):
        labels = ws.save(components(links.union(_resolved(suspects, sets, percent)), ws, "second").withColumnRenamed("id", "rep"), "relabels")
    return sketch, classes.drop("sig").join(labels, "rep", "left").withColumn("component", F.coalesce("component", "rep"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80, miss: float = 1e-6) -> DataFrame:
    """One row per input row: id, n_shingles, component_id (smallest id that links reach) and kept (id = component_id).

    words: words per shingle, after lower-casing A-Z.  percent: pairs with
    100 * intersection >= percent * union are links.  miss: probability at which a
    signature comparison may give up a pair at the threshold.

    A null or wordless text has no shingles and is linked with nothing.  A row whose id is
    null takes part in no link and comes back with component_id null and kept true.  Rows
    that share an id are judged each by its own text.  Other columns are not read.  No rows
    give no rows.
    """
    ws = Workspace(docs.sparkSession, "minhash")
    sketch, classes = _classes(docs, key, text, words, percent, miss, ws)
    return _labelled(sketch, classes, ws).select("id", "n_shingles", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))


def _labelled(sketch: DataFrame, classes: DataFrame, ws: Workspace) -> DataFrame:
    """Every row of sketch with component_id (the component's smallest id) and chosen, whether its class holds that id (of several classes the first).

    Rows without a class are their own.
    """
    classes = ws.save(classes, "components")
    least = classes.groupBy("component").agg(F.min(F.struct("id", "rep")).alias("least"), F.count("*").alias("n"))
    found = join_counted(classes, least, "component", "n", classes.count())
    found = ws.save(found.select("f1", "f2", "n_shingles", "copies", F.col("least.id").alias("component_id"), (F.col("least.rep") == F.col("rep")).alias("chosen")), "found")
    rows = sketch.drop("sig")
    live = F.col("id").isNotNull() & (F.col("n_shingles") > 0)
    held = join_counted(rows.where(live), found, ["f1", "f2", "n_shingles"], "copies", rows.count()).drop("copies")
    alone = rows.where(~live).withColumns({"component_id": F.col("id"), "chosen": F.lit(True)})
    return held.unionByName(alone)


def deduplicated(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80, miss: float = 1e-6) -> DataFrame:
    """docs without near-duplicates: of each group of linked texts the row with the smallest id stays.

    Rows are judged each by its own text, also where ids repeat: of rows with equal id and text the
    first by a hash of all their columns stays.  Null and wordless texts, and rows with a null
    id, are linked with nothing and all stay.  Columns of docs are kept, whatever their names.
    No rows give no rows.
    """
    ws = Workspace(docs.sparkSession, "minhash")
    sketch, classes = _classes(docs, key, text, words, percent, miss, ws)
    rows = ws.save(_labelled(sketch, classes, ws).where("id is not null"), "rows")
    rows = rows.withColumn("stays", (F.col("n_shingles") == 0) | (F.col("chosen") & (F.col("id") == F.col("component_id"))))
    ids = ws.save(rows.groupBy("id").agg(F.count("*").alias("n"), F.count_if("stays").alias("s")).where("n > s or n > 1"), "ids")
    names = [f"_{k}" for k in range(len(docs.columns))]
    plain = docs.toDF(*names).withColumn("id", F.col(names[docs.columns.index(key)]).cast("long"))
    kept = plain.join(ids.select("id"), "id", "left_anti").select(*names)
    several = ids.where("n > 1 and s > 0")
    if not empty(several):
        # ids that repeat: their rows are told apart by their texts
        again = plain.join(several.select("id"), "id", "left_semi")
        marks = F.struct("n_shingles", "f1", "f2")
        good = rows.where("stays").join(several.select("id"), "id", "left_semi").select(F.col("id").alias("__id"), marks.alias("__mark")).distinct()
        again = _marked(again, names[docs.columns.index(text)], words).join(good, (F.col("id") == F.col("__id")) & (F.col("__mark") == F.struct("__n", "__f1", "__f2")))
        order = W.partitionBy("id", "__n", "__f1", "__f2").orderBy(F.xxhash64(*names))
        again = again.withColumn("__at", F.row_number().over(order)).where("__at = 1 or __n = 0").select(*names)
        kept = kept.union(again)
    return kept.toDF(*docs.columns)


def _marked(rows: DataFrame, text: str, words: int) -> DataFrame:
    """rows with __n, __f1 and __f2 of their texts."""
    at = rows.columns.index(text)
    names = [*rows.columns, "__n", "__f1", "__f2"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, f1, f2 = np.array([_sketch(s) for s in K.shingle_sets(batch.column(at).cast(pa.string()), words)], np.uint64).reshape(-1, 3).T
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(n.astype(np.int64)), _long(f1), _long(f2)], names)

    return rows.mapInArrow(K.sliced(run), T.StructType([*rows.schema.fields, *(T.StructField(c, T.LongType()) for c in names[-3:])]))
