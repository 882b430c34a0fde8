import math
import random
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from weft.llm import common, decontaminate, lm_score, packing, quality
from weft.llm.common import ROW_GROUP, fold

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def words(t):
    return (t or "").encode().lower().split() + [b""]


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(2)
    tongues = [[f"{p}{i}" for i in range(60)] for p in ("la", "en", "du")]
    return [(i, " ".join(rng.choice(tongues[i % 3]) for _ in range(rng.randint(3, 60)))) for i in range(400)]


def test_lm_score(frame, odd, corpus):
    rows = odd + [(1000 + i, t) for i, t in corpus]
    got = lm_score.score(frame(rows), fold(F.col("id"), 7) != 2).collect()
    assert len(got) == len(rows)
    learn = [t for i, t in rows if zlib.crc32(str(i if i is not None else "").encode()) % 7 != 2]
    c = Counter(w for t in learn for w in words(t))
    total, types = sum(c.values()), len(c)
    want = sorted((i if i is not None else -1, len(words(t)), sum(c[w] > 0 for w in words(t)), round(sum(math.log10((c[w] + 1) / (total + types + 1)) for w in words(t)), 6)) for i, t in rows)
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in got) == want
    assert {r.train_tokens for r in got} == {total}
    held = [r for r in got if r.doc_id and r.doc_id >= 1000 and zlib.crc32(str(r.doc_id).encode()) % 7 == 2]
    # Context tells the language, which the unigram base can't know.
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_lm_empty(frame):
    assert lm_score.score(frame([]), F.lit(True)).collect() == []
    r = lm_score.score(frame([(1, "a b")]), F.lit(False)).first()
    assert (r.n_tokens, r.n_known, r.train_tokens) == (3, 0, 0) and math.isfinite(r.score)


def test_lm_sums_to_one():
    """The softmaxes of all levels, with one unseen word a class of endings, make a distribution."""
    counts = Counter({b"": 50} | {b"w%d" % i: 1 + 2000 // (i + 1) for i in range(6000)})
    head = sorted((w for w in counts if w), key=lambda w: (-counts[w], w))
    voc = lm_score.Vocabulary(b" ".join(head), np.array([counts[b""], *(counts[w] for w in head)]), np.ones(lm_score.ENDINGS))
    rng = np.random.default_rng(0)
    tables = [lm_score.weights(rng.poisson(0.3, (1 << bits, w))) for bits, w in zip(lm_score.ROW_BITS, lm_score.WIDTHS, strict=True)]
    scales = lm_score.start_scales()
    for own in scales:
        own[1:] = rng.normal(0.3, 0.2, len(own) - 1)
    net = lm_score.Net(lm_score.scoring_weights(tables, scales), scales, voc)
    history = [voc.codes[w] for w in (b"w1", b"w7", b"w900")]
    every = [*range(len(head) + 1), *(lm_score.HEAD + e for e in range(lm_score.ENDINGS))]
    codes = np.array([c for x in every for c in (*history, x)])
    starts = np.zeros(len(codes), bool)
    starts[::4] = True
    assert abs((10 ** net.run(codes, starts)[3::4]).sum() - 1) < 1e-4


def brute_counts(docs):
    """Counts of (level, row, outcome), token by token."""
    out = Counter()
    for doc in docs:
        stream = np.array([0, 0, 0, *doc])
        for i in range(3, len(stream)):
            before = lm_score.contexts(stream, np.array([i]))
            for level, path, y in brute_outcomes(int(stream[i])):
                for f, c in enumerate(before):
                    out[level, int(lm_score.rows_of(f, c, np.array([path]), level)[0]), y] += 1
    return out


def brute_outcomes(code):
    if code >= lm_score.HEAD:
        return [(0, 0, 64 + (code - lm_score.HEAD) % 32)]
    return [(0, 0, code // 4096), (1, code // 4096, code // 64 % 64), (2, code // 64, code % 64)]


def brute_log(stream, i, target, counts, scales, voc, leave_out):
    """log P of one outcome chain, from the raw counts."""
    total = 0.0
    before = lm_score.contexts(np.array(stream), np.array([i]))
    for level, path, y in brute_outcomes(target):
        own, width = scales[level], lm_score.WIDTHS[level]
        logit = max(own[0], 0.01) * voc.unigram[level][path].astype(float)
        if level == 0:
            logit[64:] += own[-1]
        for f, c in enumerate(before):
            row = int(lm_score.rows_of(f, c, np.array([path]), level)[0])
            n = np.array([counts[level, row, k] for k in range(width)], float)
            n[y] -= leave_out
            band = min(int(math.log2(max(n.sum(), 0) + 1) / 1.5), lm_score.BANDS - 1)
            logit += own[1 + f * lm_score.BANDS + band] * np.log1p(n / lm_score.ALPHA)
        total += logit[y] - np.log(np.exp(logit - logit.max()).sum()) - logit.max()
    return total


@pytest.fixture(scope="module")
def small_model():
    rng = random.Random(8)
    texts = [" ".join(rng.choice("abcdefgh") * rng.randint(1, 2) for _ in range(rng.randint(1, 25))).encode() for _ in range(30)]
    c = Counter(w for t in texts for w in [*t.split(), b""])
    head = sorted((w for w in c if w), key=lambda w: (-c[w], w))
    voc = lm_score.Vocabulary(b" ".join(head), np.array([c[b""], *(c[w] for w in head)]), np.ones(lm_score.ENDINGS))
    (_, codes, sizes, _), = lm_score.encoded(texts, voc.codes, 1 << 30)
    counted = lm_score.Counts()
    counted.add(codes, lm_score.starts_of(sizes))
    docs = np.split(codes, np.cumsum(sizes)[:-1])
    rng = np.random.default_rng(1)
    scales = [s + rng.normal(0, 0.05, len(s)) for s in lm_score.start_scales()]
    return voc, counted, docs, codes, lm_score.starts_of(sizes), scales


def test_lm_brute_force(small_model):
    """Counts and scores, token by token from raw counts."""
    voc, counted, docs, codes, starts, scales = small_model
    want = brute_counts(docs)
    for level, table in enumerate(counted.tables):
        got = {(level, int(i) // lm_score.WIDTHS[level], int(i) % lm_score.WIDTHS[level]): int(table[i]) for i in np.flatnonzero(table)}
        assert got == {k: n for k, n in want.items() if k[0] == level}
    tables = [lm_score.weights(t.astype(np.int64).reshape(-1, w)) for t, w in zip(counted.tables, lm_score.WIDTHS, strict=True)]
    logs = lm_score.Net(lm_score.scoring_weights(tables, scales), scales, voc).run(codes, starts) * math.log(10)
    at = 0
    for doc in docs:
        for i in range(len(doc)):
            # Log counts are kept in steps, and weights in 16 bits.
            assert logs[at] == pytest.approx(brute_log([0, 0, 0, *doc], i + 3, int(doc[i]), want, scales, voc, 0), abs=0.15)
            at += 1


def test_lm_counts_carry(monkeypatch):
    """Counts beyond 16 bits are kept, in pieces and in their sums."""
    monkeypatch.setattr(lm_score.Counts, "CARRY", 40)
    counts = lm_score.Counts()
    codes, starts = np.zeros(300, np.int64), np.zeros(300, bool)
    starts[0] = True
    for _ in range(3):
        counts.add(codes, starts)
    assert any(counts.over)
    pieces = list(counts.pieces())
    # Every feature adds one a token and level.
    assert [sum(int(own.sum()) for lv, _, own in pieces if lv == level) for level in range(3)] == [900 * lm_score.FEATURES] * 3
    big = np.zeros(lm_score.PIECE * 64, np.int64)
    big[5] = 1 << 40
    assert lm_score.opened(lm_score.packed(big), 1).reshape(-1)[5] == 1 << 40 and lm_score.opened(lm_score.packed(big * 0 + 3), 1).sum() == 3 * len(big)


def test_lm_gradient(small_model, monkeypatch):
    """A step's gradient is that of the log probability with every token left out of its counts."""
    voc, counted, docs, codes, starts, scales = small_model
    want = brute_counts(docs)
    tables = [lm_score.weights(t.astype(np.int64).reshape(-1, w)) for t, w in zip(counted.tables, lm_score.WIDTHS, strict=True)]
    learner = lm_score.Learner(tables, scales, voc)
    level, tokens, path, y = list(lm_score.outcomes(codes))[2]
    stream, real = lm_score.laid_out(codes, starts)
    before = [c[tokens] for c in lm_score.contexts(stream, real)]
    monkeypatch.setattr(lm_score, "RATE", 1.0)
    learner.squares = [np.zeros(len(s)) for s in scales]
    held = np.array(scales[2])
    learner.step(2, path, y, before, np.arange(len(y)))
    signs = np.sign(learner.scales[2] - held)  # with no squares before, a step is the gradient's sign

    def total(own):
        three = [scales[0], scales[1], own]
        out = 0.0
        for doc in docs:
            stream = [0, 0, 0, *doc]
            for i in range(3, len(stream)):
                with pytest.MonkeyPatch.context() as m:
                    m.setitem(globals(), "brute_outcomes", lambda c: [(2, c // 64, c % 64)])
                    out += brute_log(stream, i, int(stream[i]), want, three, voc, 1)
        return out

    for k in (0, 3, 4, 11, 12):
        more = held.copy()
        more[k] += 1e-4
        slope = (total(more) - total(held)) / 1e-4
        if abs(slope) > 3:  # beyond what the steps of log counts blur
            assert signs[k] == np.sign(slope)


def test_lm_beats_a_bigram(spark):
    """Held out, on the driver's documents: at least as good as an absolute-discount bigram over the add-one unigram."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [(r.doc_id, words(r.text)) for r in docs.collect()]
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    c, pairs, after, kinds = Counter(), Counter(), Counter(), Counter()
    for i, ws in rows:
        if not held(i):
            c.update(ws)
            for a, b in zip([b"", *ws], ws, strict=False):
                kinds[a] += (a, b) not in pairs
                pairs[a, b] += 1
                after[a] += 1
    n, v, bigram, tokens = sum(c.values()), len(c), 0.0, 0
    for i, ws in rows:
        if held(i):
            for a, b in zip([b"", *ws], ws, strict=False):
                p = (c[b] + 1) / (n + v + 1)
                bigram += math.log10((max(pairs[a, b] - 0.75, 0) + 0.75 * kinds[a] * p) / after[a] if after[a] else p)
            tokens += len(ws)
    got = lm_score.score(docs, fold(F.col("id"), 7) != 2).filter(fold(F.col("doc_id"), 7) == 2).agg(F.sum("score"), F.sum("n_tokens")).first()
    assert got[1] == tokens and got[0] / tokens > bigram / tokens


def test_lm_doesn_t_depend_on_partitions(frame, corpus, odd, monkeypatch):
    """The same scores from one partition or seven, in any order, over several tasks and shards."""
    monkeypatch.setattr(lm_score, "COUNT_TOKENS", 1000)
    monkeypatch.setattr(lm_score, "SHARD_TOKENS", 1500)
    rows = odd + [(1000 + i, t) for i, t in corpus]
    learn = fold(F.col("id"), 7) != 2
    runs = []
    for df in (frame(rows).coalesce(1), frame(rows[::-1]).repartition(7)):
        runs.append(sorted((r.doc_id if r.doc_id is not None else -1, r.n_tokens, round(r.base_score, 6), r.score) for r in lm_score.score(df, learn).collect()))
    assert [r[:3] for r in runs[0]] == [r[:3] for r in runs[1]]
    assert all(a[3] == pytest.approx(b[3], abs=1e-6) for a, b in zip(*runs, strict=True))


def test_lm_whole_head_has_context(frame):
    """Words beyond the commonest are told apart by what stands before them."""
    ring = [f"{i}zz" for i in range(300)]  # one class by ending
    rng = random.Random(5)
    texts = []
    for i in range(600):
        at = rng.randrange(300)
        texts.append((i, " ".join(ring[(at + k) % 300] for k in range(60))))
    got = lm_score.score(frame(texts), F.lit(True)).agg(F.sum("score"), F.sum("n_tokens")).first()
    assert got[0] / got[1] > -0.3


def test_lm_words_outside_of_the_head_have_context(frame, monkeypatch):
    """All words are outside of the head and in one class by ending: leaves of it are told apart by what stands before."""
    monkeypatch.setattr(lm_score, "head_words", lambda counts: [])
    monkeypatch.setattr(lm_score, "LEAF_WORDS", 1, raising=False)
    ring = [f"{i}zz" for i in range(2048)]
    rng = random.Random(6)
    texts = []
    for i in range(600):
        at = rng.randrange(len(ring))
        texts.append((i, " ".join(ring[(at + k) % len(ring)] for k in range(60))))
    got = lm_score.score(frame(texts), F.lit(True)).agg(F.sum("score"), F.sum("base_score"), F.sum("n_tokens")).first()
    # One of 2,048 words costs 3.3, one of a leaf's about 1.5.
    assert got[0] / got[2] > -2 > -3 > got[1] / got[2]


def test_lm_leaves_sum_to_one():
    """All leaves of words outside of the head, at the finest, each with all of its share, and the head."""
    rng = np.random.default_rng(3)
    head = [b"w%d" % i for i in range(300)]
    totals = rng.integers(1, 9, lm_score.ENDINGS << 5)
    voc = lm_score.Vocabulary(b" ".join(head), np.arange(301, 0, -1), totals)
    tables = [lm_score.weights(rng.poisson(0.3, (1 << bits, w))) for bits, w in zip(lm_score.ROW_BITS, lm_score.WIDTHS, strict=True)]
    scales = lm_score.start_scales()
    for own in scales:
        own[1:] = rng.normal(0.3, 0.2, len(own) - 1)
    net = lm_score.Net(lm_score.scoring_weights(tables, scales), scales, voc)
    history = [voc.codes[w] for w in (b"w1", b"another", b"w7")]
    every = [*range(301), *(lm_score.HEAD + leaf for leaf in range(len(totals)))]
    codes = np.array([c for x in every for c in (*history, x)])
    starts = np.zeros(len(codes), bool)
    starts[::4] = True
    logs = net.run(codes, starts)[3::4]
    logs[301:] += np.log10(totals)  # P of a leaf, not of one word with a count of none
    assert abs((10**logs).sum() - 1) < 1e-4


def test_lm_leaf_of_a_code():
    """Words' codes name their leaf, for any number of bits, and fit in 32 bits."""
    for bits in (0, 3, 12):
        codes = lm_score.Codes([b""], bits)
        for i in range(500):
            word = b"x%d" % i
            own = codes[word]
            assert lm_score.HEAD <= own < 1 << 31 and (own - lm_score.HEAD) % (lm_score.ENDINGS << 12) == lm_score.leaf_of(word, bits)
    assert [lm_score.leaf_bits(n) for n in (0, 511, 512, 10**9)] == [0, 0, 0, 12] and lm_score.leaf_bits(1 << 13) == 4


def test_lm_counts_are_written_in_small_row_groups(frame, corpus):
    """Pieces of counts come after many small rows; the JVM holds a row group and its pages at once, of all tasks together beyond an executor's memory."""
    src = frame(corpus).select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("xh"), F.lit(True).alias("learn"), "text").coalesce(1)
    vocabulary = ("small-row-groups", src.sparkSession.sparkContext.broadcast((b"", np.array([1]), np.ones(lm_score.ENDINGS, np.int64))))
    rows = lm_score.encode(src, vocabulary, 1.0, 1)
    held = []
    for path in Path(rows.__dict__["_weft_folder"].removeprefix("file:")).rglob("*.parquet"):
        meta = pq.ParquetFile(path).metadata
        held += [meta.row_group(g).column(c).total_uncompressed_size for g in range(meta.num_row_groups) for c in range(meta.num_columns)]
    assert max(held) < ROW_GROUP // 2
    level, k, data = rows.filter("kind = 2").select("id", "xh", "counts").orderBy("id", "xh").first()
    counts = lm_score.opened(data, level)
    assert (level, k, counts.shape) == (0, 0, (lm_score.PIECE, lm_score.WIDTHS[0])) and counts.sum() > 0 and lm_score.packed(counts.reshape(-1)) == data


def test_written_looks_at_sizes_in_time(spark, monkeypatch):
    """Large rows that follow many small ones don't make a row group of their own size."""
    monkeypatch.setattr(common, "ROW_GROUP", 1 << 20)
    rows = spark.range(9200, numPartitions=1).select("id", F.when(F.col("id") >= 9000, F.expr("aggregate(sequence(1, 400), '', (a, i) -> a || sha2(cast(id * 1000 + i as string), 512))")).alias("x"))
    out = common.written(rows, "late", 16)
    groups = []
    for path in Path(out.__dict__["_weft_folder"].removeprefix("file:")).rglob("*.parquet"):
        meta = pq.ParquetFile(path).metadata
        groups += [meta.row_group(g).total_byte_size for g in range(meta.num_row_groups)]
    assert out.count() == 9200 and max(groups) < 3 << 20 and sum(groups) > 9 << 20


def test_lm_rows_of_all_features():
    rng = np.random.default_rng(3)
    stream = rng.integers(0, lm_score.HEAD + 1000, 500)
    before = lm_score.contexts(stream, np.arange(3, 500))
    for level in range(len(lm_score.WIDTHS)):
        path = rng.integers(0, 4096, 497)
        want = [lm_score.rows_of(f, before[f], path, level) for f in range(lm_score.FEATURES)]
        assert np.array_equal(lm_score.all_rows(before, path, level), want)


def test_lm_sums_pieces_as_a_stream():
    """Pieces of any number of tasks are added in one pass, few at a time."""
    rng = np.random.default_rng(2)
    pieces = [(level, k, rng.integers(0, 9, lm_score.PIECE * lm_score.WIDTHS[level])) for level, k in ((0, 0), (0, 256), (2, 0)) for _ in range(40)]
    batches = [pa.RecordBatch.from_arrays([pa.array(x) for x in (levels, ks)] + [pa.array([lm_score.packed(o) for o in own], pa.binary())], ["level", "k", "counts"]) for levels, ks, own in (zip(*pieces[i : i + 7], strict=True) for i in range(0, 120, 7))]
    got = [r for b in lm_score.summed(batches) for r in b.to_pylist()]
    assert [(r["level"], r["k"]) for r in got] == [(0, 0), (0, 256), (2, 0)]
    for i, r in enumerate(got):
        want = lm_score.weights(sum(own for _, _, own in pieces[40 * i : 40 * i + 40]).reshape(-1, lm_score.WIDTHS[r["level"]]))
        assert [r["steps"], r["bands"], r["less"]] == [x.tobytes() for x in want]


def labelled(n=300):
    rng = random.Random(4)
    good = lambda: " ".join(rng.choice(["the", "of", "and", "walks", "river", "stone", "was", "green"]) for _ in range(40)) + "."
    bad = lambda: " ".join(rng.choice(["buy", "now", "cheap"]).upper() + "!!" for _ in range(40))
    return [(i, good() if i % 4 else bad()) for i in range(n)]


def test_quality(spark, frame, odd):
    rows = labelled()
    labels = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i, _ in rows] + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    docs = frame(rows + [(10_000 + (i or 0), t) for i, t in odd])
    model = quality.train(docs.select("doc_id", "text"), labels, lambda k: fold(k, 4) != 2)
    got = quality.score(docs.select("doc_id", "text"), model).collect()
    assert len(got) == len(rows) + len(odd) and all(0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.doc_id < 10_000 and zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert len(held) > 30 and all((r.score >= 0.7) == (r.doc_id % 4 > 0) for r in held)


def test_quality_without_labels(spark, frame):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = frame([(1, "a"), (2, None)])
    model = quality.train(docs, none, lambda k: k > 0)
    assert [r.score for r in quality.score(docs, model).collect()] == [0.5, 0.5]
    assert quality.score(frame([]), model).collect() == []


def test_quality_takes_one_row_of_an_id(spark, frame, monkeypatch):
    """Labelled ids bound what is collected, however often a row is repeated."""
    rows = labelled(60)
    labels = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i, _ in rows], "doc_id long, quality int, toxic int")
    seen = []
    monkeypatch.setattr(quality, "log_ratios", lambda own, y: seen.append(len(own)) or np.zeros(quality.DIMS))
    quality.train(frame(rows + [(1, "again and again")] * 3000), labels, lambda k: k >= 0, max_train=40)
    assert seen and seen[0] <= 40


def test_quality_ratios_by_hand():
    """Log-count ratios of indicators, with one added to each class's count."""
    rows, y = [np.array([3, 9]), np.array([3]), np.array([9, 11])], [1, 1, 0]
    got = quality.log_ratios(rows, y)
    n1, n0 = quality.DIMS + 3, quality.DIMS + 2
    for k, (a, b) in {3: (2, 0), 9: (1, 1), 11: (0, 1), 5: (0, 0)}.items():
        assert got[k] == pytest.approx(math.log((a + 1) / n1 / ((b + 1) / n0)))


def test_quality_hinge_is_the_optimum():
    """Dual coordinate descent reaches the optimum of the squared hinge loss: no small step improves it, and the duality gap closes."""
    rng = np.random.default_rng(3)
    rows = [np.unique(rng.integers(0, 40, rng.integers(1, 12))) for _ in range(60)]
    y = [int(r.sum() % 3 > 0) for r in rows]
    ratios = np.zeros(quality.DIMS)
    ratios[:40] = rng.normal(size=40)
    w = quality.fit_hinge(rows, y, ratios, epochs=2000)[:40]
    share = {s: len(y) / (2 * y.count(s)) for s in (0, 1)}
    x = np.zeros((60, 40))
    for i, r in enumerate(rows):
        x[i, r] = quality.unit(ratios[r])
    sign, cost = np.where(np.array(y) == 1, 1.0, -1.0), np.array([share[v] for v in y])

    def loss(v):
        return 0.5 * v @ v + (cost * np.maximum(0, 1 - sign * (x @ v)) ** 2).sum()

    slope = w - (2 * cost * np.maximum(0, 1 - sign * (x @ w)) * sign) @ x
    assert np.abs(slope).max() < 0.05
    assert all(loss(w) <= loss(w + rng.normal(0, 0.05, 40)) for _ in range(50))


def test_quality_reads_no_labels():
    assert list(quality.indicators(b"", quality.WordKeys())) == []
    a, b = (set(quality.indicators(t, quality.WordKeys()).tolist()) for t in (b"one two two two", b"one two three four"))
    assert a != b


def test_packing(spark, frame, odd, corpus):
    from tokenizers import Tokenizer

    rows = odd + [(1000 + i, t * (1 + i % 7)) for i, t in corpus]
    tok = Tokenizer.from_file(TOKENIZER)
    got = packing.pack(frame(rows).repartition(3), TOKENIZER).collect()
    want = Counter()
    for i, t in rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [1]
        want[i, len(ids)] += 1
    assert Counter((r.doc_id, r.doc_tokens) for r in got if r.start == 0) == want
    by_doc: dict = {}
    for r in got:
        by_doc.setdefault((r.doc_id, r.doc_tokens), []).append(r)
    texts = {(i, len(tok.encode(t or "", add_special_tokens=False).ids) + 1): t for i, t in rows}
    for key, own in by_doc.items():
        ids = np.array(tok.encode(texts[key] or "", add_special_tokens=False).ids + [1], "<u4")
        assert sum(r.length for r in own) == len(ids) * want[key]
        assert all(zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32 for r in own)
    seqs: dict = {}
    for r in got:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in seqs.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048
    used = sum(r.length for r in got)
    assert used > 0.97 * (len(seqs) - 1) * 2048
    assert packing.pack(frame([]), TOKENIZER).collect() == []


def test_word_ids():
    from tokenizers import Tokenizer

    tok, own = Tokenizer.from_file(TOKENIZER), packing.WordIds(TOKENIZER)
    rng = random.Random(9)
    signs = [chr(c) for c in range(1, 0x250)] + list("'strvemld<|>σΣİﬁ①٣中文😀́ ")
    for i in range(1500):
        t = "".join(rng.choice(signs) for _ in range(rng.randint(0, 30))) + ("<|endoftext|> x" if i % 40 == 0 else "")
        assert np.frombuffer(own.of([t.encode().split()])[0], "<u4").tolist() == tok.encode(t, add_special_tokens=False).ids


def test_cuts():
    for n in [*range(1, 5000), 100_000]:
        own = packing.cuts(n, 2048)
        assert sum(own) == n and all(0 < x <= 2048 for x in own)


def edit_distance_within(item, text):
    prev = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        cur = [i]
        for j, b in enumerate(text, 1):
            cur.append(min(prev[j] + 1, cur[-1] + 1, prev[j - 1] + (a != b)))
        prev = cur
    return min(prev)


def test_myers():
    rng = random.Random(6)
    for _ in range(300):
        item = "".join(rng.choice("abc ") for _ in range(rng.randint(1, 80)))
        text = "".join(rng.choice("abc ") for _ in range(rng.randint(0, 60))) + item[: rng.randint(0, len(item))]
        d, end = decontaminate.myers(item, text, len(item))
        assert d == edit_distance_within(item, text)


def test_leaks(spark, frame, odd):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8)))
    items = [" ".join(word() for _ in range(rng.randint(12, 40))) for _ in range(10)]
    rows = list(odd)
    for n in range(50):
        text = [word() for _ in range(60)]
        item = list(items[n % 10])
        for _ in range(rng.randint(0, 2 + len(item) // 12)):
            k = rng.randrange(len(item))
            item[k] = rng.choice(["", "z", "q" + item[k]])
        if n % 2:
            text.insert(30, "".join(item).upper())
        rows.append((1000 + n, "\n".join(text)))
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(items)] + [(90, None), (91, "  "), (None, items[0])], "item_id long, text string")
    got = decontaminate.find_leaks(frame(rows), bench).collect()
    want = set()
    for i, t in rows:
        norm = decontaminate.normalise(t or "")
        for k, item in enumerate(items):
            most = int(len(item) * decontaminate.RATE)
            if (d := edit_distance_within(decontaminate.normalise(item), norm) if len(norm) < 2000 else 999) <= most:
                want.add((i, k, d))
                if k == 0:
                    want.add((i, None, d))
    assert {(r.doc_id, r.item_id, r.edits) for r in got} == want and len(want) > 10
    clean = decontaminate.drop_leaks(frame(rows), bench).collect()
    assert len(clean) == len(rows) - len({i for i, *_ in want})
    assert decontaminate.find_leaks(frame([]), bench).collect() == []
    assert decontaminate.find_leaks(frame(rows), bench.limit(0)).collect() == []
