"""LM scoring by cross-entropy difference.

Two word bigram models, of a target (well-rated documents) and of a background (all
documents), share one vocabulary.  Both are counted over the whole corpus and keep every
word and every bigram.

    p1(w) = (c(w) + 1) / (N + V + 1)            with one entry for unseen words
    p(w | u) = (c(u, w) + MU p1(w)) / (c(u, .) + MU)

A document's score is the mean over its tokens of log p_target - log p_background: the
background's loss less the target's.

The tables grow with the corpus, so tokens go to their counts: a token travels to the
partition of its word, where the word, its bigrams and its uses as a context are counted
and the gains summed by document.  Frequent words and bigrams would fill one partition;
their exact counts are broadcast instead.  A word is frequent with a share of HEAVY of all
tokens, a bigram with that share of a sample: at most about 1 / HEAVY entries each.  What
counts as frequent decides only where a token is scored, not its score.  A bigram of a rare
word is told from others of this word by 32 bits of its context's hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernel as K
from .workspace import Workspace

HEAVY = 1e-6
#: one document in so many is looked at for frequent bigrams
SAMPLE = 16
#: ranges of the hash, one of which is held at a time, and tasks that score rare tokens: the least, and tokens of the corpus for each
RANGES, RANGE_TOKENS = 256, 500_000
TASKS, TASK_TOKENS = 64, 20_000_000
#: texts whose rare tokens of a range travel as one row
RARE_BYTES = 4 << 20
MU = 100.0
HELD = 4_000_000


class _Counts:
    """Sums of counts by key, merged whenever HELD keys have gathered."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, keys: np.ndarray, target: np.ndarray) -> None:
        k, inverse, n = np.unique(keys, return_inverse=True, return_counts=True)
        self.parts.append((k, n, np.bincount(inverse.ravel(), weights=target, minlength=len(k)).astype(np.int64)))
        self.held += len(k)
        if self.held > HELD:
            self.merge()
            self.held = len(self.parts[0][0]) // 2  # a table that stays large is not merged at every block

    def merge(self) -> None:
        if len(self.parts) > 1:
            keys = np.concatenate([p[0] for p in self.parts])
            k, inverse = np.unique(keys, return_inverse=True)
            inverse = inverse.ravel()
            self.parts = [(k, *(np.bincount(inverse, weights=np.concatenate([p[j] for p in self.parts]), minlength=len(k)).astype(np.int64) for j in (1, 2)))]

    def batches(self) -> Iterator[pa.RecordBatch]:
        self.merge()
        for k, n, t in self.parts:
            for i in range(0, len(k), 100_000):
                at = slice(i, i + 100_000)
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(k[at]).view(np.int64)), pa.array(n[at]), pa.array(t[at])], ["k", "n", "t"])


def _counted(marked: DataFrame, keys_of) -> DataFrame:
    """(k, n, t): all and target occurrences of each key, pre-aggregated by task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _Counts()
        for batch in batches:
            target = batch.column(2).to_numpy(zero_copy_only=False)
            for i, j, raw, at in K.blocks(batch.column(1)):
                keys, row = keys_of(raw, at)
                if len(keys):
                    counts.add(keys, target[i:j][row])
        yield from counts.batches()

    rows = marked.select("doc_id", "text", "target").mapInArrow(run, "k long, n long, t long")
    return rows.groupBy("k").agg(F.sum("n").alias("n"), F.sum("t").alias("t"))


def _word_keys(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, words = K.word_spans(raw, at)
    return K.hash_words(raw, starts, ends, lower=True), np.repeat(np.arange(len(at) - 1), np.diff(words))


def marked(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text and target: 1 for documents rated of good quality and not toxic (all their ratings), else 0."""
    good = F.coalesce((F.col("quality") == 1) & (F.col("toxic") == 0), F.lit(False))
    rated = labels.groupBy(F.col("doc_id").cast("long").alias("__id")).agg(F.min(good.cast("long")).alias("target")).where("target = 1")
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    # ratings grow with the documents: a merge join at every size
    return rows.join(rated.hint("merge"), F.col("doc_id") == F.col("__id"), "left").select("doc_id", "text", F.coalesce("target", F.lit(0)).alias("target"))


_START = np.uint64(0x5EED5EED5EED5EED)


def _tokens(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word, context, bigram, row and whether it ends its text, of every token."""
    w, row = _word_keys(raw, at)
    first = np.diff(row, prepend=-1) != 0
    u = np.empty_like(w)
    u[1:] = w[:-1]
    u[first] = _START
    return w, u, K.mix64(u * np.uint64(0xD6E8FEB86659FD93) + w), row, np.append(first[1:], np.ones(min(1, len(w)), dtype=bool))


def _pair_keys(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    _, _, pair, row, _ = _tokens(raw, at)
    return pair, row


def _at(keys: np.ndarray, h: np.ndarray) -> np.ndarray:
    """The place of each h in sorted keys, or -1."""
    if not len(keys):
        return np.full(len(h), -1)
    at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
    return np.where(keys[at] == h, at, -1)


class Frequent:
    """Sizes of the corpus, frequent words with their counts, and frequent bigrams."""

    def __init__(self, size: int, all_n: int, all_t: int, words: pa.Table, pairs: np.ndarray):
        self.size, self.total = size, (all_n, all_t)
        key = words["k"].to_numpy().view(np.uint64)
        order = np.argsort(key)
        self.key, self.pair = key[order], np.sort(pairs.view(np.uint64))
        self.p1 = [self.smooth(words[c].to_numpy()[order], j) for j, c in enumerate("nt")]
        self.count = [words[c].to_numpy()[order] for c in "nt"]

    def smooth(self, c: np.ndarray, which: int) -> np.ndarray:
        return MU * (c + 1) / (self.total[which] + self.size + 1)

    def places(self, w: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        word = _at(self.key, w)
        return word, np.where(word >= 0, _at(self.pair, pair), -1)

    def counted(self, found: pa.Table) -> None:
        """found: (k, n, t) by frequent bigram, then texts that end in each frequent word, then all texts with words."""
        sums = np.zeros((2, len(self.pair) + len(self.key) + 1))
        for j, c in enumerate("nt"):
            sums[j, found["k"].to_numpy()] = found[c].to_numpy()
        self.pairs = sums[:, : len(self.pair)]
        context = np.array(self.count) - sums[:, len(self.pair) : -1]
        self.context_gain = np.log(context[0] + MU) - np.log(context[1] + MU)
        self.start_gain = float(np.log(sums[0, -1] + MU) - np.log(sums[1, -1] + MU))


def _frequent(corpus: DataFrame, ws: Workspace) -> Frequent:
    words = ws.save(_counted(corpus, _word_keys), "words")
    size, all_n, all_t = (int(x or 0) for x in words.agg(F.count("*"), F.sum("n"), F.sum("t")).first())
    often = words.where(F.col("n") >= max(2.0, HEAVY * all_n)).toArrow()
    ws.drop("words")
    some = _counted(corpus.where(F.pmod(F.xxhash64("text"), F.lit(SAMPLE)) == 0), _pair_keys)
    pairs = some.where(F.col("n") >= max(4.0, HEAVY * all_n / SAMPLE)).select("k").toArrow()["k"].to_numpy()
    frequent = Frequent(size, all_n, all_t, often, pairs)
    shared = corpus.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = shared.value
        m, size = len(f.pair), len(f.pair) + len(f.key) + 1
        n, t = np.zeros(size, np.int64), np.zeros(size, np.int64)
        for batch in batches:
            target = batch.column(1).to_numpy(zero_copy_only=False)
            for i, j, raw, at in K.blocks(batch.column(0)):
                w, _, pair, row, last = _tokens(raw, at)
                word, place = f.places(w, pair)
                ends = last & (word >= 0)
                k = np.concatenate([place[place >= 0], word[ends] + m, np.full(int(last.sum()), size - 1)])
                of = target[i:j][np.concatenate([row[place >= 0], row[ends], row[last]])]
                n += np.bincount(k, minlength=size)
                t += np.bincount(k[of == 1], minlength=size)
        k = np.flatnonzero(n)
        for i in range(0, len(k), 100_000):
            at = k[i : i + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[at]), pa.array(t[at])], ["k", "n", "t"])

    found = corpus.select("text", "target").mapInArrow(run, "k long, n long, t long")
    frequent.counted(found.groupBy("k").agg(F.sum("n").alias("n"), F.sum("t").alias("t")).toArrow())
    return frequent


_RARE = "range int, row long, key binary, side binary, code binary, doc_id array<long>, n_tokens array<long>, gain array<double>"


def _planes(x: np.ndarray) -> bytes:
    """Numbers under 2^32 as four planes of bytes, which compress."""
    return np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _unplaned(x: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(x, np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def _rare(corpus: DataFrame, shared, ranges: int) -> DataFrame:
    """Rows of documents with the gains of frequent tokens, and of the rare tokens of a block that fall into a range.

    A rare token has a key (its word, even; or its bigram, odd, if only that is rare), a side
    (the context, or the frequent word's place), and a code: steps of rows, end of text, target.
    """
    schema = pa.schema([("range", pa.int32()), ("row", pa.int64()), ("key", pa.binary()), ("side", pa.binary()), ("code", pa.binary()), ("doc_id", pa.list_(pa.int64())), ("n_tokens", pa.list_(pa.int64())), ("gain", pa.list_(pa.float64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        f, one = shared.value, np.uint64(1)
        base = TaskContext.get().partitionId() << 33
        start = 0
        for batch in batches:
            target, ids = batch.column(2).to_numpy(zero_copy_only=False), batch.column(0)
            for i, j, raw, at in K.blocks(batch.column(1), RARE_BYTES):
                w, u, pair, row, last = _tokens(raw, at)
                word, place = f.places(w, pair)
                gain = np.zeros(len(w))
                hit = place >= 0
                gain[hit] = np.log(f.pairs[1][place[hit]] + f.p1[1][word[hit]]) - np.log(f.pairs[0][place[hit]] + f.p1[0][word[hit]])
                inner = (word >= 0) & ~last
                gain[inner] += f.context_gain[word[inner]]
                own = np.bincount(row, weights=gain, minlength=j - i)
                n = np.bincount(row, minlength=j - i)
                own[n > 0] += f.start_gain
                first = base + start
                start += j - i
                out = [(int(K.mix64(np.array([first], np.uint64))[0] % np.uint64(ranges)), first, None, None, None, ids.slice(i, j - i).to_pylist(), n.tolist(), own.tolist())]
                rare = np.flatnonzero(~hit)
                light = word[rare] < 0
                key = np.where(light, w[rare] & ~one, pair[rare] | one)
                side = np.where(light, u[rare] >> np.uint64(32), word[rare].astype(np.uint64)).astype("<u4")
                part = (K.mix64(key) % np.uint64(ranges)).astype(np.int32)
                order = np.argsort(part, kind="stable")
                rare, key, side, part = rare[order], key[order], side[order], part[order]
                code = (row[rare] << 2) | (last[rare] << 1) | (target[i:j][row[rare]] == 1)
                cuts = np.flatnonzero(np.diff(part, prepend=-1)) if len(part) else np.zeros(0, int)
                for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(part)], strict=False):
                    c = code[a:b].copy()
                    c[1:] = (np.diff(c >> 2) << 2) | (c[1:] & 3)
                    out.append((int(part[a]), first, key[a:b].tobytes(), side[a:b].tobytes(), _planes(c), None, None, None))
                yield pa.RecordBatch.from_arrays([pa.array(x, type=t.type) for x, t in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    return corpus.select("doc_id", "text", "target").mapInArrow(run, _RARE)


def _rare_gains(f: Frequent, key: np.ndarray, side: np.ndarray, last: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The gain of each of all rare tokens of a range."""
    order = np.lexsort((side, key))
    k, s = key[order], side[order]
    last, target = last[order], target[order]
    new = np.append(True, k[1:] != k[:-1])
    word = np.cumsum(new) - 1
    new |= np.append(True, s[1:] != s[:-1])
    pair = np.cumsum(new) - 1
    light = (k & np.uint64(1)) == 0
    p1, c1, c2 = [], [], []
    for j, of in enumerate((np.ones(len(k)), target)):
        n = np.bincount(word, weights=of)
        rare, often = f.smooth(n, j)[word], np.zeros(len(k))
        often[~light] = f.p1[j][s[~light]]
        p1.append(np.where(light, rare, often))
        c1.append(np.log(n - np.bincount(word, weights=of * last) + MU))
        c2.append(np.bincount(pair, weights=of)[pair])
    gain = np.log(c2[1] + p1[1]) - np.log(c2[0] + p1[0]) + np.where(light & ~last, (c1[0] - c1[1])[word], 0.0)
    out = np.empty(len(k))
    out[order] = gain
    return out


def _summed(rare: DataFrame, shared, tasks: int) -> DataFrame:
    """(row, doc_id, n_tokens, gain): parts of the documents' sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[np.ndarray] = []
        gains: list[np.ndarray] = []
        held = 0
        keys, sides, codes, places = [], [], [], []

        def score() -> None:
            if keys:
                code = np.concatenate(codes)
                gain = _rare_gains(shared.value, np.concatenate(keys), np.concatenate(sides), (code & 2) > 0, (code & 1).astype(float))
                add(np.concatenate(places), gain)
                for x in (keys, sides, codes, places):
                    x.clear()

        def add(row: np.ndarray, gain: np.ndarray) -> None:
            nonlocal held
            r, inverse = np.unique(row, return_inverse=True)
            rows.append(r)
            gains.append(np.bincount(inverse.ravel(), weights=gain))
            held += len(r)

        def merge() -> None:
            nonlocal held
            r, inverse = np.unique(np.concatenate(rows), return_inverse=True)
            rows[:], gains[:] = [r], [np.bincount(inverse.ravel(), weights=np.concatenate(gains))]
            held = len(r)

        def emit() -> Iterator[pa.RecordBatch]:
            nonlocal held
            for r, g in zip(rows, gains, strict=True):
                for i in range(0, len(r), 100_000):
                    a = r[i : i + 100_000]
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.nulls(len(a), pa.int64()), pa.nulls(len(a), pa.int64()), pa.array(g[i : i + 100_000])], ["row", "doc_id", "n_tokens", "gain"])
            rows.clear(), gains.clear()
            held = 0

        now = None
        for batch in batches:
            for r in range(batch.num_rows):
                at, first, key, side, code, ids, n, own = (batch.column(c)[r] for c in range(8))
                if not key.is_valid:
                    k = len(n)
                    yield pa.RecordBatch.from_arrays([pa.array(np.arange(k) + first.as_py()), pa.array(ids.as_py(), pa.int64()), n.values, own.values], ["row", "doc_id", "n_tokens", "gain"])
                    continue
                if at.as_py() != now:
                    score()
                    now = at.as_py()
                    if held > HELD:
                        merge()
                        if held > HELD // 2:
                            yield from emit()
                c = _unplaned(code.as_py())
                keys.append(np.frombuffer(key.as_py(), np.uint64))
                sides.append(np.frombuffer(side.as_py(), "<u4"))
                codes.append((c & 3).astype(np.int8))
                places.append(np.cumsum(c >> 2) + first.as_py())
        score()
        if rows:
            merge()
            yield from emit()

    return rare.repartition(tasks, "range").sortWithinPartitions("range").mapInArrow(run, "row long, doc_id long, n_tokens long, gain double")


def scored(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_tokens and score (mean loss difference, higher is closer to the target).

    All words and bigrams count.  A document is scored by models that counted it too, as a target
    document if it is one, so its own words stand out to the models.

    A null or wordless text has n_tokens 0 and score 0.  Without a target document the target
    model knows nothing, and all scores are the background's against an even guess.  Null
    ids and repeated rows are rows like others, of a text of any length.  Labels of unknown ids
    are ignored.  Other columns are not read.  No rows give no rows.
    """
    ws = Workspace(docs.sparkSession, "lm")
    corpus = ws.save(marked(docs, labels, key, text), "marked")
    frequent = _frequent(corpus, ws)
    common, total = docs.sparkSession.sparkContext.broadcast(frequent), frequent.total[0]
    parts = _summed(_rare(corpus, common, max(RANGES, total // RANGE_TOKENS)), common, max(TASKS, total // TASK_TOKENS))
    # every row has one part with its tokens
    sums = parts.groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.max("n_tokens").alias("n_tokens"), F.sum("gain").alias("gain"))
    return sums.select("doc_id", "n_tokens", F.when(F.col("n_tokens") > 0, F.col("gain") / F.col("n_tokens")).otherwise(0.0).alias("score"))
