import random
import re
import zlib

import compare
import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from registrum.llm import minhash, mixing, packing, pii, queries, rules

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(packing.default_tokenizer())


def test_encoder_equals_the_tokenizer(tokenizer):
    enc, rng = packing.encoder(packing.default_tokenizer()), random.Random(1)
    assert enc.fast is not None
    texts = ["".join(rng.choice("ab1 ²Ⅷ\n\t '!_\x1c\x85éé中一\U0001f600 don't<|endoftext|>") for _ in range(rng.randint(0, 14))) for _ in range(4000)]
    for t in [*texts, "", "<|endoftext|> a", "x" * 5000]:
        assert enc.encode(t).tolist() == tokenizer.encode(t, add_special_tokens=False).ids


def packed_ok(pieces, texts, tokenizer):
    """Every id lies in one piece, sequences have no gaps, only the last is short."""
    ids = {k: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for k, t in texts.items()}
    docs, seqs = {}, {}
    for r in pieces:
        docs.setdefault(r.id, []).append(r)
        seqs.setdefault(r.sequence_id, []).append(r)
    assert set(docs) == set(ids)
    for k, rs in docs.items():
        rs.sort(key=lambda r: r.start)
        got = []
        for r in rs:
            assert r.start == len(got) and r.doc_tokens == len(ids[k]) and r.length * 4 == len(r.ids) and r.ids_crc32 == zlib.crc32(r.ids)
            got += np.frombuffer(r.ids, "<u4").tolist()
        assert got == ids[k]
    for rs in seqs.values():
        at = 0
        for r in sorted(rs, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    assert sum(sum(r.length for r in rs) < 2048 for rs in seqs.values()) <= 1


def test_packing_round_trip(spark, tokenizer):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()} | {10**6: None, 10**6 + 1: "", 10**6 + 2: "long text " * 3000}
    df = spark.createDataFrame([(k, t, "x") for k, t in texts.items()], "doc_id long, text string, part string").repartition(5)
    packed_ok(packing.packed(df).collect(), texts, tokenizer)
    assert packing.packed(df.limit(0)).count() == 0
    twice = spark.createDataFrame([(None, "a"), (1, "b"), (1, "b")], "doc_id long, text string")
    assert packing.packed(twice).count() == 3


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    got = queries.queries()[name](spark, SMALL).toPandas()
    assert compare.rows(got) == compare.rows(compare.connection(SMALL).execute(queries.oracle_sql()[name]).df())


def test_shares_fill_siblings_first(spark):
    leaves = spark.createDataFrame([("d", "en", "s1", 10), ("d", "en", "s2", 1000), ("d", "de", "s3", 1000), ("e", "en", "s4", 5)], "domain string, lang string, source string, available long")
    got = {r.source: r.want for r in mixing.budgets(leaves, F.lit(400), {"d": 1, "e": 1}, {}, {}, 2).collect()}
    # e can give 10 of its 200, the rest goes to d: 390, 195 for each language; s1 gives 20 of 97, its sibling the rest
    assert got == {"s4": 10, "s1": 20, "s2": 175, "s3": 195}


def test_mixing_takes_prefixes_of_seeded_epochs(spark):
    rows = [(k, "w " * (k % 7), "en" if k % 3 else None, f"src{k % 4}") for k in range(200)] + [(None, None, None, None), (None, "a b", "en", "src0"), (7, "x", "en", "src3"), (7, "x", "en", "src3")]
    df = spark.createDataFrame([(*r, "c", 5) for r in rows], "doc_id long, text string, lang string, source string, epoch string, n_chars int")
    got = mixing.selection(df, budget=F.expr("all_tokens * 2")).collect()
    leaves = {}
    for r in got:
        leaves.setdefault((r.domain, r.lang, r.source), []).append(r)
    for rs in leaves.values():
        for e in {r.epoch for r in rs}:
            at = 0
            for r in sorted((r for r in rs if r.epoch == e), key=lambda r: (r.start, r.tokens)):
                assert r.start == at
                at += r.tokens
        assert sum(r.take < r.tokens for r in rs) <= 1
    total = sum(len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) + 1 for _, t, _, _ in rows)
    assert total * 2 - len(leaves) <= sum(r.take for r in got) <= total * 2
    for budget in (None, F.expr("all_tokens * 2"), F.expr("all_tokens div 3"), F.lit(7), F.lit(0)):
        drawn = [(r.doc_id, r.take) for r in mixing.selection(df, budget=budget).collect()]
        parts = [(r.doc_id, len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))) for r in mixing.mixed(df, budget=budget).collect()]
        # a document has a token more than words, its end; the last of a leaf may be cut before it
        last = {(r.doc_id, r.take) for r in mixing.selection(df, budget=budget).where("take < tokens").collect()}
        order = lambda r: (r[0] is None, r[0], r[1])
        assert sorted(parts, key=order) == sorted([(k, n if (k, n) in last else n - 1) for k, n in drawn], key=order), budget
    out = mixing.mixed(df)
    assert out.columns == df.columns and out.dtypes == df.dtypes and out.count() == mixing.selection(df).count()
    assert mixing.mixed(df.limit(0)).count() == 0


def test_pipeline_against_its_stages_by_hand(spark, tokenizer):
    import corpus_pipeline as cp

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    good = {r.id for r in rules.judged(docs).where("kept").collect()}
    import itertools

    from test_dedup import roots, shingles

    sets = {k: shingles(rows[k].text, 5) for k in good}
    links = [(a, b) for a, b in itertools.combinations(sorted(sets), 2) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    first = {k for k, c in roots(good, links).items() if k == c}
    texts = {k: pii.redact(rows[k].text, pii.all_spans(rows[k].text, pii.judge())[1]) for k in first}
    stage = docs
    for name, f in cp.STAGES[:3]:
        stage = f(spark, stage, SMALL)
        assert stage.columns == docs.columns, name
    assert {r.doc_id: r.text for r in stage.collect()} == texts
    drawn = mixing.selection(stage).collect()
    pieces = cp.run(spark, SMALL).collect()
    words = {(r.doc_id, r.epoch): texts[r.doc_id] if r.take == r.tokens else " ".join(re.findall(r"[^\x20\x09-\x0D]+", texts[r.doc_id])[: r.take]) for r in drawn}
    want = sorted((k, t) for (k, _), t in words.items())
    got, left = [], sorted(pieces, key=lambda r: (r.sequence_id, r.offset))
    for k, t in want:
        got.append((k, len(tokenizer.encode(t, add_special_tokens=False).ids) + 1))
    assert sorted(got) == sorted((r.doc_id, r.doc_tokens) for r in left if r.start == 0)
    assert sum(r.length for r in left) == sum(n for _, n in got)


def test_minhash_default_is_five_words():
    import inspect

    assert inspect.signature(minhash.near_duplicates).parameters["words"].default == 5


def test_pipeline_of_awkward_and_empty_tables(spark, tmp_path, tokenizer):
    import corpus_pipeline as cp

    rng = random.Random(5)
    words = [f"word{k}" for k in range(3000)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    long, copy = prose(60_000), prose(80)
    rows = [(k, prose(70), rng.choice(("en", "de", None)), rng.choice(("src0", "src1", None)), None) for k in range(40)]
    rows += [(100, copy, "en", "src0", 1), (101, copy + " tail", "en", "src1", 2), (101, prose(90), "en", "src1", 3), (102, copy, None, None, None), (102, copy, None, None, None), (None, copy, "en", "src0", 4), (103, None, "en", "src0", 5), (104, "", None, "src1", 6), (105, long, "fr", "src0", 7)]
    rows += [(106, copy.replace("word", "Word", 3) + " call +1 (269) 555-3296 or mail jo.fox@mail.example.com now", "en", "src1", 8)]
    df = spark.createDataFrame([(*r, "a", "b", 1) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, id string, host string, n_words int")
    df.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    df.limit(0).coalesce(1).write.parquet(str(tmp_path / "none/documents.parquet"))
    stage = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, f in cp.STAGES[:4]:
        stage = f(spark, stage, str(tmp_path))
        assert stage.columns == df.columns, name
        stage = stage.cache()
        if name == "quality_rules":
            assert {r.doc_id for r in stage.collect()} == set(range(40)) | {100, 101, 102, 105, 106, None}
        if name == "minhash_near_dedup":
            kept = [(r.doc_id, r.text) for r in stage.collect()]
            assert sorted(k for k, _ in kept if k is not None) == [*range(40), 100, 101, 105] and sum(k is None for k, _ in kept) == 1
            assert dict(kept)[101] != copy + " tail"
    pieces = cp.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in pieces} <= set(range(40)) | {100, 101, 105, None} and sum(r.length for r in pieces if r.doc_id == 105) > 0
    assert cp.run(spark, str(tmp_path / "none")).count() == 0
