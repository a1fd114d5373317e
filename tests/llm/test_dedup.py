import itertools
import random
import re

import numpy as np
import pytest

from registrum.llm import embeddings, kernel, minhash
from registrum.llm.components import components
from registrum.llm.workspace import Workspace


def roots(nodes, links):
    root = {n: n for n in nodes}

    def top(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = top(a), top(b)
        root[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def shingles(text, n):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: chr(ord(m[0]) + 32), text or ""))
    return {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()


def test_components_against_union_find(spark):
    rng = random.Random(1)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(1000, 1060)] + [(2000, k) for k in range(2001, 2100)] + [(5, 5)]
    want = roots({x for a, b in links if a != b for x in (a, b)}, links)
    got = components(spark.createDataFrame(links, "a long, b long"), Workspace(spark, "t"))
    assert {r.id: r.component for r in got.collect()} == want
    assert components(spark.createDataFrame([], "a long, b long"), Workspace(spark, "t")).count() == 0


def texts():
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(400)]
    out = []
    shared = [rng.choice(words) for _ in range(60)]
    for k in range(12):  # groups of near copies at many similarities
        base = [rng.choice(words) for _ in range(rng.choice((8, 30, 120)))]
        for _ in range(8):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 12))):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            out.append(" ".join(copy))
        out += [" ".join(base)] * 3
    out += [" ".join(shared + [rng.choice(words) for _ in range(20)]) for _ in range(40)]  # a common passage
    out += [None, "", " \n", "One", "one", "a b", "A\tB", "x " * 5000]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("words", [2, 5])
@pytest.mark.parametrize("block", [512, 4])
def test_minhash_against_all_pairs(spark, monkeypatch, words, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    rows = list(enumerate(texts()))
    sets = {k: shingles(t, words) for k, t in rows}
    links = [(a, b) for a, b in itertools.combinations(sets, 2) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    want = roots(sets, links)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.id: r for r in minhash.near_duplicates(df, words=words).collect()}
    assert {k: r.component_id for k, r in got.items()} == want
    assert {k: r.n_shingles for k, r in got.items()} == {k: len(s) for k, s in sets.items()}
    assert all(r.kept == (k == r.component_id) for k, r in got.items())


def test_prune_bounds_rise_and_spare_the_threshold():
    bounds = minhash.least_matches(0.8, 1e-6)
    assert list(bounds) == sorted(bounds) and bounds[-1] < 0.8 * minhash.HASHES
    rng = np.random.default_rng(0)
    match = rng.random((4000, minhash.HASHES)) < 0.8
    assert len(minhash._survivors(match.astype(np.uint32), np.ones_like(match, dtype=np.uint32), bounds)) >= 3995


def test_minhash_nulls_repeats_and_clashing_columns(spark):
    df = spark.createDataFrame([(None, "a b c", 1, "z"), (1, "a b c", 2, "z"), (1, "a b c", 3, "z"), (2, "a b c", 4, None), (3, None, 5, "z")], "doc_id long, text string, component_id long, sig string")
    got = sorted((r.id or -1, r.component_id, r.kept) for r in minhash.near_duplicates(df).collect())
    assert got == [(-1, None, True), (1, 1, True), (1, 1, True), (2, 1, False), (3, 3, True)]
    kept = minhash.deduplicated(df)
    assert kept.columns == df.columns and sorted(r.doc_id or -1 for r in kept.collect()) == [-1, 1, 3]
    assert minhash.near_duplicates(df.limit(0)).count() == 0


def test_shingles_of_awkward_texts():
    for text in ("", None, "x", "é à", "a  b\nc", "A" * 100_000, "w " * 3000):
        for n in (1, 2, 5):
            import pyarrow as pa

            assert len(next(iter(kernel.shingle_sets(pa.array([text], pa.string()), n)))) == len(shingles(text, n))


def vectors():
    rng = np.random.default_rng(3)
    out = [list(rng.normal(size=24)) for _ in range(150)]
    for k in range(6):
        out += [list(np.array(out[k]) + 0.05 * rng.normal(size=24)) for _ in range(12)]
    out += [out[0]] * 5 + [[2 * x for x in out[1]]]
    return out


@pytest.mark.parametrize(("block", "kind"), [(4096, "double"), (7, "double"), (30, "float")])
def test_vectors_against_all_pairs(spark, monkeypatch, block, kind):
    monkeypatch.setattr(embeddings, "BLOCK", block)
    monkeypatch.setattr(embeddings, "ROWS", 16)
    v = vectors()
    if kind == "float":
        v = [[float(x) for x in row] for row in np.array(v, np.float32)]
    m = np.array(v)
    m /= np.linalg.norm(m, axis=1)[:, None]
    near = m @ m.T >= 0.9
    links = [(a, b) for a, b in zip(*np.nonzero(near), strict=True) if a < b]
    bad = [None, [], [0.0] * 24, [1.0, None], [float("nan")] * 24, [float("inf")] + [1.0] * 23, [1.0] * 3]
    rows = [(k, x if x is None else [a if a is None else float(a) for a in x]) for k, x in enumerate(v + bad)]
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], f"vec_id long, embedding array<{kind}>, component string, rep int")
    got = {r.id: r for r in embeddings.near_vectors(table).collect()}
    want = roots(range(len(rows)), links)
    assert {k: r.component_id for k, r in got.items()} == want
    assert [got[k].n_links for k in range(len(v))] == [int(x) - 1 for x in near.sum(axis=1)]
    assert all(got[k].n_links == 0 and got[k].kept for k in range(len(v), len(rows)))


def test_index_recall_at_the_threshold(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(1500, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    z = rng.normal(size=x.shape)
    z -= (z * x).sum(1)[:, None] * x
    z /= np.linalg.norm(z, axis=1)[:, None]
    c = rng.uniform(0.9001, 0.99, 1500)[:, None]
    rows = [(k, [float(a) for a in v]) for k, v in enumerate(np.concatenate([x, c * x + np.sqrt(1 - c * c) * z]))]
    got = embeddings.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert got.where("n_links > 0 and not kept").count() / 1500 >= 0.9


@pytest.mark.parametrize("pivots", [128, 1024, 4096])
def test_index_recall_does_not_fall_with_pivots(spark, pivots):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(2100, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    z = rng.normal(size=x.shape)
    z -= (z * x).sum(1)[:, None] * x
    z /= np.linalg.norm(z, axis=1)[:, None]
    c = rng.uniform(0.9001, 0.91, 2100)[:, None]
    rows = [(k, [float(a) for a in v]) for k, v in enumerate(np.concatenate([x, c * x + np.sqrt(1 - c * c) * z]))]
    got = embeddings.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), pivots=pivots)
    recall = got.where("n_links > 0 and not kept").count() / 2100
    assert recall >= 0.98, recall


def test_vectors_empty_and_null_ids(spark):
    df = spark.createDataFrame([(None, [1.0, 2.0]), (4, [1.0, 2.0]), (7, [1.0, 2.0]), (7, [-1.0, 0.0]), (8, [-1.0, 0.01])], "vec_id long, embedding array<double>")
    got = sorted((r.id or -1, r.n_links, r.component_id, r.kept) for r in embeddings.near_vectors(df).collect())
    assert got == [(-1, 0, None, True), (4, 1, 4, True), (7, 1, 4, False), (7, 1, 7, True), (8, 1, 7, False)]
    assert embeddings.near_vectors(df.limit(0)).count() == 0


def test_deduplication_judges_rows_not_ids(spark):
    a, b, c = "the first text of all", "a wholly other set of words", "and one more that stands alone"
    rows = [(1, a, "p"), (5, a, "q"), (5, b, "r"), (5, b, "r"), (5, b, "s"), (7, b, "t"), (8, c, "u"), (8, None, "v"), (8, "", "v"), (None, a, "w"), (8, None, "v")]
    df = spark.createDataFrame(rows, "doc_id long, text string, id string")
    got = sorted((r.doc_id or -1, r.text or "", r.id in "rs") for r in minhash.deduplicated(df, words=2).collect())
    assert got == sorted([(1, a, False), (5, b, True), (8, c, False), (8, "", False), (8, "", False), (8, "", False), (-1, a, False)])
    assert [sorted(map(str, minhash.deduplicated(df.repartition(k), words=2).collect())) for k in (1, 3)][0] == sorted(map(str, minhash.deduplicated(df, words=2).collect()))
    assert minhash.deduplicated(df.limit(0)).count() == 0


@pytest.mark.parametrize("heavy", [1000, 2])
def test_a_bucket_of_many_distinct_texts(spark, monkeypatch, heavy):
    """Texts that share a long passage but are not near, and near pairs among them."""
    from registrum.llm import workspace

    monkeypatch.setattr(workspace, "LEAST_HEAVY", heavy)
    monkeypatch.setattr(workspace, "HEAVY_PARTS", 8)
    monkeypatch.setattr(minhash, "BLOCK", 300)
    rng = random.Random(9)
    shared = " ".join(f"s{k}" for k in range(80))
    rows = [(k, shared + " " + " ".join(f"w{rng.randrange(10**6)}" for _ in range(rng.choice((60, 90))))) for k in range(1500)]
    rows += [(2000 + k, rows[7 * k][1] + f" more{k}") for k in range(100)]
    sets = {k: shingles(t, 2) for k, t in rows}
    by = {}
    for k in range(100):
        assert len(sets[7 * k] & sets[2000 + k]) / len(sets[7 * k] | sets[2000 + k]) >= 0.8
        by[2000 + k] = 7 * k
    got = {r.id: r.component_id for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=2).collect()}
    assert got == {k: by.get(k, k) for k, _ in rows}
