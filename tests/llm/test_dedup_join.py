import hashlib
import random
import re

import pytest

from weft.llm import exact_dedup, jaccard_join
from weft.llm.components import components

WS = re.compile(r"[\x20\x09-\x0D]")


def brute_dedup(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(WS.sub("", t or ""), []).append((-len(t or ""), i is None, i or 0, i))
    out = []
    for i, t in rows:
        key = WS.sub("", t or "")
        out.append((i, sorted(groups[key])[0][3], len(groups[key]), hashlib.sha256(key.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("digest", [exact_dedup.sha256, lambda b: hashlib.sha256(b).hexdigest()[:1]])
def test_exact_dedup(frame, odd, digest):
    rng = random.Random(1)
    rows = odd + [(100 + i, rng.choice(["p q", "pq", "p  q r", "zz"]) * rng.randint(1, 3)) for i in range(60)]
    got = exact_dedup.dedup(frame(rows), digest=digest).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=repr) == brute_dedup(rows)
    # One row of each group stays.
    assert sum(r.kept for r in got) == len({WS.sub("", t or "") for _, t in rows})


def test_exact_dedup_empty(frame):
    assert exact_dedup.dedup(frame([])).collect() == []
    assert exact_dedup.keep_one(frame([])).collect() == []


def test_keep_one(frame, odd):
    got = exact_dedup.keep_one(frame(odd))
    assert got.columns[0] == "doc_id" and "digest" in got.columns
    texts = [WS.sub("", r.text or "") for r in got.collect()]
    assert sorted(texts) == sorted({WS.sub("", t or "") for _, t in odd})


def test_stream_goes_on(spark, frame, tmp_path):
    """State outlives a run: a second stream over new files meets the digests of the first."""
    from pyspark.sql import functions as F

    src, out, state = (str(tmp_path / x) for x in ("src", "out", "state"))
    part = lambda rows: spark.createDataFrame(rows, "id long, n long, digest string, copies long").withColumn("locator", F.struct(F.col("id").alias("row")))
    for rows in ([(1, 5, "d", 1), (2, 7, "e", 1)], [(3, 9, "d", 2)]):
        part(rows).write.mode("append").parquet(src)
        exact_dedup.dedup_stream(spark.readStream.schema(part(rows).schema).parquet(src), out, state)
    last = spark.read.parquet(out).orderBy("trigger").collect()
    assert [(r.digest, r.size, -r.best.neg) for r in last if r.trigger == 1] == [("d", 3, 3)]


def shingle_set(t, k):
    w = (t or "").encode().lower().split()
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute_groups(rows, k, num, den):
    sets = [shingle_set(t, k) for _, t in rows]
    adj = [[j for j in range(len(rows)) if j != i and sets[i] and sets[j] and den * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j])] for i in range(len(rows))]
    out = []
    for i in range(len(rows)):
        seen, todo = {i}, [i]
        while todo:
            for j in adj[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        out.append((rows[i][0], len(sets[i]), min(ids) if ids else None, len(adj[i])))
    return sorted(out, key=repr)


def near_copies(rng, n, words, edits):
    base = [rng.choice("abcdefghijklmnop") * rng.randint(1, 4) for _ in range(words)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(len(w))] = f"e{rng.randint(0, 400)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize(("k", "num"), [(3, 90), (5, 80)])
def test_near_groups(frame, odd, monkeypatch, k, num):
    monkeypatch.setattr(jaccard_join, "BLOCK", 8)  # several blocks a component
    rng = random.Random(k)
    texts = near_copies(rng, 60, 70, 4) + near_copies(rng, 15, 25, 1) + near_copies(rng, 10, 8, 1) + ["common passage here " * 3 + " ".join(f"w{rng.randint(0, 50)}" for _ in range(20)) for _ in range(20)]
    rows = odd + [(1000 + i, t) for i, t in enumerate(texts)]
    got = jaccard_join.near_groups(frame(rows), k, num, 100).collect()
    assert sorted(((r.id, r.n_shingles, r.component_id, r.n_links) for r in got), key=repr) == brute_groups(rows, k, num, 100)


def test_near_groups_empty(frame, odd):
    assert jaccard_join.near_groups(frame([])).collect() == []
    assert jaccard_join.near_groups(frame([(1, None), (2, " ")])).count() == 2
    kept = jaccard_join.keep_one(frame(odd), 3, 90, 100).collect()
    assert sum((r.text or "").lower().split() == list("abcde") for r in kept) == 1


def test_prefix_lemma():
    """Any linked pair shares a window token among the rarest of both prefixes."""
    rng = random.Random(5)
    for num in (80, 90):
        for _ in range(300):
            n = rng.randint(1, 60)
            x = set(rng.sample(range(200), n))
            y = set(x)
            for _ in range(rng.randint(0, max(1, n // 8))):
                y.discard(rng.choice(sorted(y))) if len(y) > 1 else None
                y.add(rng.randint(200, 400)) if rng.random() < 0.5 else None
            if 100 * len(x & y) < num * len(x | y):
                continue
            win = [sorted(s)[: jaccard_join.window_size(len(s), num, 100)] for s in (x, y)]
            df = {t: sum(t in w for w in win) + rng.randint(0, 3) for w in win for t in w}
            pre = [sorted(w, key=lambda t: (df[t], t))[: jaccard_join.prefix_size(len(s), num, 100)] for w, s in zip(win, (x, y), strict=True)]
            assert set(pre[0]) & set(pre[1])


def test_components(spark):
    edges = [(1, 2), (2, 3), (5, 4), (9, 9), (3, 10), (11, 10), (20, 21), (22, 21), (21, 22)] + [(i, i + 1) for i in range(100, 160)]
    got = dict(components(spark.createDataFrame(edges, "u long, v long")).collect())
    want = dict.fromkeys([1, 2, 3, 10, 11], 1) | {4: 4, 5: 4, 9: 9, 20: 20, 21: 20, 22: 20} | dict.fromkeys(range(100, 161), 100)
    assert got == want
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []


@pytest.mark.parametrize("local", [1 << 20, 0])
def test_components_chain_and_hub(spark, local):
    """Both ways: one task, and rounds over written tables."""
    rng = random.Random(3)
    chain = [(i, i + 1) for i in range(10_000)]
    hub = [(50_000, 50_001 + i) for i in range(3_000)] + [(90_000, 60_000 + i) for i in range(3_000)]
    loop = [(99_999, 99_999)]
    edges = chain + hub + loop
    rng.shuffle(edges)
    got = components(spark.createDataFrame(edges, "u long, v long").repartition(5), local).collect()
    assert len(got) == len({x for e in edges for x in e})
    want = dict.fromkeys(range(10_001), 0) | {50_000 + i: 50_000 for i in range(3_001)} | {60_000 + i: 60_000 for i in range(3_000)} | {90_000: 60_000, 99_999: 99_999}
    assert dict(got) == want


def test_signatures_never_lose_a_common_key():
    import numpy as np

    rng = np.random.default_rng(1)
    for _ in range(50):
        pool = rng.integers(-(1 << 63), 1 << 63, 40) >> 30 << 30  # many have 16 bits in common
        pool = np.unique(np.concatenate([pool, pool + 1, pool + 2]))
        a, b = (np.sort(rng.choice(pool, 30, replace=False)) for _ in range(2))
        x, y = (jaccard_join.signed(jaccard_join.signature(s)) for s in (a, b))
        assert len(x) == len(y) == 30 and len(x & y) >= len(set(a) & set(b))


def test_group_pairs_are_filtered():
    """A shared shingle alone ties nothing: sizes and the number of shared shingles decide."""
    import numpy as np

    sig = lambda xs: np.asarray(xs, np.uint16).tobytes()
    pairs = jaccard_join.Pairs(90, 100)  # with 100 shingles, 4 of a prefix must be shared
    pairs.bucket([(100, 1, sig([1, 2, 3, 4, 5])), (100, 2, sig([1, 7, 8, 9])), (50, 3, sig([1, 2, 3, 4, 5])), (101, 4, sig([1, 2, 3, 4, 6]))])
    assert pairs.edges() == [(4, 1)]


@pytest.mark.parametrize("size", [4, 16])
def test_long_prefixes_in_classes(frame, monkeypatch, size):
    """Prefixes that are dealt to several classes, of sizes on both sides of a step."""
    monkeypatch.setattr(jaccard_join, "CLASS", size)
    rng = random.Random(size)
    texts = [t for words in (60, 64, 70, 130, 260) for t in near_copies(rng, 12, words, words // 12)]
    texts += [t.rsplit(" ", rng.randint(1, 6))[0] for t in texts[::3]]
    rows = list(enumerate(texts))
    got = jaccard_join.near_groups(frame(rows), 3, 90, 100).collect()
    assert sorted(((r.id, r.n_shingles, r.component_id, r.n_links) for r in got), key=repr) == brute_groups(rows, 3, 90, 100)


def test_frequent_shingle_in_blocks(frame, monkeypatch):
    """Groups of one shingle that are dealt to several blocks still all meet."""
    monkeypatch.setattr(jaccard_join, "BUCKET", 3)
    rng = random.Random(11)
    rows = list(enumerate(near_copies(rng, 50, 40, 3)))
    got = jaccard_join.near_groups(frame(rows), 3, 90, 100).collect()
    assert sorted(((r.id, r.n_shingles, r.component_id, r.n_links) for r in got), key=repr) == brute_groups(rows, 3, 90, 100)


def test_edges_don_t_repeat_for_each_shared_shingle(spark, frame, monkeypatch):
    """Tasks send on few edges for each group of a large cluster, not one from every shingle where it meets the others."""
    rng = random.Random(12)
    rows = list(enumerate(near_copies(rng, 150, 60, 3)))
    sent = []
    real = jaccard_join.components

    def counted(edges, *args, **kwargs):
        sent.append(edges.count())
        return real(edges, *args, **kwargs)

    monkeypatch.setattr(jaccard_join, "components", counted)
    settings = {"spark.sql.shuffle.partitions": "32", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        got = jaccard_join.near_groups(frame(rows), 5, 80, 100).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted(((r.id, r.n_shingles, r.component_id, r.n_links) for r in got), key=repr) == brute_groups(rows, 5, 80, 100)
    assert sum(sent) < 4 * len(rows)
