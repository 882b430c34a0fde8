"""N-gram Jaccard join with grouped prefixes.

A document is the set of its hashed word shingles; two link when their Jaccard similarity reaches
num/den. With n shingles, slack s(n) = floor(n * (1 - num/den)) and l(n) = floor(s(n)/3) + 1:

* Linked documents share at least l of the first s + l shingles of each (in hash order), l being that
  of the smaller one. These windows are the prefixes; of them only shingles that several sets have count.
* Documents with equal sets are one node; nodes with the same prefix and size are one group.
* A group is found by the rarest shingles of its prefix: all but l(least partner size) - 1 of them, of
  which linked documents share at least one (a long prefix is dealt to classes, each with its share of
  l). Documents without near copies mostly have nothing to join.

Pairs of groups that meet at a shingle are filtered by their sizes and by how many shingles their
prefixes share. The pairs that pass aren't sent on one by one: each task keeps a forest of them, whose
components hold every pair that passes. Groups meet twice: first at their most frequent probe alone,
where most of a large group of near copies is tied, one edge a group; then at all probes, where only
edges between what isn't tied yet are kept, so they don't repeat for each shingle that copies share.
Components are expanded to their nodes, in blocks, and all pairs of blocks are verified over whole sets.
"""

from __future__ import annotations

import hashlib
import math

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weft.llm.common import drop_written, fresh, one_of_each, text_or_empty, worker_cache, written
from weft.llm.components import components

#: Words whose hashes a worker keeps.
CACHED_WORDS = 150_000
#: Nodes in a block; two blocks meet in a task.
BLOCK = 512
#: Keys in a class of a long prefix, about, at most.
CLASS = 128
#: Groups of one shingle that meet in one task; more are dealt to blocks of this size, of which two meet.
BUCKET = 1024
#: Sets that are broadcast when documents are led to their node: those with the most copies.
HOT_SETS = 1000
#: Slots of the sieve that keeps texts without candidates out of the shuffle.
SIEVE = 1 << 20


class WordHashes(dict):
    def __missing__(self, word):
        import xxhash

        h = xxhash.xxh3_64_intdigest(word)
        if len(self) >= CACHED_WORDS:
            self.clear()
        if len(word) <= 64:
            self[word] = h
        return h


def shingles(text: bytes, k: int, hashes: WordHashes):
    """The sorted distinct hashes of the k-word shingles; fewer words make one shingle, none an empty set."""
    import numpy as np

    words = text.lower().split()
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(hashes.__getitem__, words), np.uint64, n)
    width = min(k, n)
    h = np.full(n - width + 1, width, np.uint64)
    for j in range(width):
        h = (h ^ w[j : n - width + 1 + j]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h.sort()
    return h[np.concatenate(([True], h[1:] != h[:-1]))]


def slack(n: int, num: int, den: int) -> int:
    return n - -(-num * n // den)


def shared_least(n: int, num: int, den: int) -> int:
    """l(n)"""
    return slack(n, num, den) // 3 + 1


def window_size(n: int, num: int, den: int) -> int:
    return min(n, slack(n, num, den) + shared_least(n, num, den))


def prefix_size(n: int, num: int, den: int) -> int:
    return window_size(n, num, den) - shared_least(-(-num * n // den), num, den) + 1


def links(sets, sizes, num: int, den: int, cols: int = 4096):
    """Boolean matrix of the pairs of sets that link, from intersection counts taken in slices of shingles."""
    import numpy as np

    m = len(sets)
    owner = np.repeat(np.arange(m), [len(s) for s in sets])
    keys = np.concatenate(sets)
    order = np.argsort(keys, kind="stable")
    keys, owner = keys[order], owner[order]
    new = np.concatenate(([True], keys[1:] != keys[:-1]))
    col = np.cumsum(new) - 1
    often = np.bincount(col)[col] > 1
    owner, col = owner[often], col[often]
    both = np.zeros((m, m), np.float32)
    if len(col):
        col = np.cumsum(np.concatenate(([True], col[1:] != col[:-1]))) - 1
        for lo in range(0, int(col[-1]) + 1, cols):
            a, b = np.searchsorted(col, (lo, lo + cols))
            x = np.zeros((m, min(cols, int(col[-1]) + 1 - lo)), np.float32)
            x[owner[a:b], col[a:b] - lo] = 1
            both += x @ x.T
    both = both.astype(np.int64)
    n = np.asarray(sizes, np.int64)
    linked = den * both >= num * (n[:, None] + n[None, :] - both)
    np.fill_diagonal(linked, False)
    return linked


def roots(linked):
    """Least index that is reachable, per row of a boolean link matrix."""
    import numpy as np

    lab = np.arange(len(linked))
    while True:
        new = np.minimum(lab, np.where(linked, lab[None, :], len(lab)).min(1))
        new = new[new]
        if (new == lab).all():
            return lab
        lab = new


def signature(keys) -> bytes:
    """16 bits of each 64-bit key, in order."""
    import numpy as np

    return np.sort((keys.view(np.uint64) >> np.uint64(48)).astype(np.uint16)).tobytes()


def signed(signature: bytes) -> frozenset[int]:
    """A signature as a set: each 16 bits with how often they have come before, so no key that two lists share is lost."""
    import numpy as np

    x = np.frombuffer(signature, np.uint16).astype(np.int64)
    at = np.arange(len(x))
    first = np.maximum.accumulate(np.where(np.concatenate(([True], x[1:] != x[:-1])), at, 0))
    return frozenset((x << 16 | at - first).tolist())


def lane(r: int, a: int, b: int) -> int:
    """Classes and blocks of a probe as one number."""
    return r.bit_length() << 56 | a << 28 | b


def classes(n: int, num: int, den: int) -> int:
    """Classes (by the low bits of a key) that the prefixes of sets of n shingles are dealt to: 128 keys a class, about, at most."""
    w = window_size(n, num, den)
    return 1 << ((w - 1) // CLASS).bit_length()


def probes(num: int, den: int, rows_out: int = 20_000, last: bool = False):
    """A function for mapInArrow over groups (g, home, n, keys, counts): rows (key, lane, g, home, n, sig).

    A long prefix is dealt to ``r`` classes: of sets that share l keys some class shares ceil(l / r), and
    so one of the rarest keys of that class, all but that many less one. A row has the signature of
    its key's class alone. Sizes near a step of :func:`classes` take both numbers of classes. At a
    frequent key there is a row for each block that the group's block meets. ``last``: only the most
    frequent probe of each class.
    """

    def run(batches):
        import numpy as np

        kinds = (*[pa.int64()] * 5, pa.binary())

        def out(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["key", "lane", "g", "home", "n", "sig"])

        rows = []
        for batch in batches:
            lists, counts = batch.column(3), np.asarray(batch.column(4).flatten())
            ends = np.concatenate([[0], np.cumsum(lists.value_lengths())]).astype(np.int64)
            keys = np.asarray(lists.flatten())
            for i, (g, home, n) in enumerate(zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True)):
                own, often = keys[ends[i] : ends[i + 1]], counts[ends[i] : ends[i + 1]]
                least = -(-num * n // den)
                for r in {classes(least, num, den), classes(n, num, den), classes(n * den // num, num, den)}:
                    part = own.view(np.uint64) % np.uint64(r)
                    shared = -(-shared_least(least, num, den) // r)
                    for c in range(r) if r > 1 else (0,):
                        at = np.flatnonzero(part == c)
                        if len(at) < shared:
                            continue
                        sig = signature(own[at])
                        for j in at[len(at) - shared if last else 0 : len(at) - shared + 1].tolist():
                            parts = -(-int(often[j]) // BUCKET)
                            h = (g * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF) % parts
                            rows += [(int(own[j]), lane(r, min(h, o), max(h, o)), g, home, n, sig) for o in range(parts)]
                    if len(rows) >= rows_out:
                        yield out(rows)
                        rows = []
        if rows:
            yield out(rows)

    return run


class Pairs:
    """Filters pairs of groups and keeps the forest of those that pass; a group with a home is tied to it already."""

    def __init__(self, num: int, den: int):
        self.num, self.den, self.up, self.homes = num, den, {}, {}

    def root(self, x):
        up = self.up
        while (y := up.setdefault(x, x)) != x:
            up[x] = up[y]
            x = y
        return x

    def bucket(self, rows, r: int = 1):
        """Groups (n, g, sig) that meet at one key: any that aren't tied yet are compared, unless their sizes are too far apart."""
        home = lambda g: self.homes.get(g, g)
        if len({home(g) for _, g, _ in rows}) == 1:
            return
        sets: dict = {}

        def set_of(g, sig):
            got = sets.get(g)
            if got is None:
                got = sets[g] = signed(sig)
            return got

        left = sorted({g: (n, g, sig) for n, g, sig in rows}.values())
        while left:
            todo = [left.pop()]
            while todo and left:
                n, g, sig = todo.pop()
                mine, rest = self.root(home(g)), []
                for other in left:
                    m, there = other[0], self.root(home(other[1]))
                    if there != mine:
                        lo, hi = (m, n) if m < n else (n, m)
                        if self.den * lo < self.num * hi or len(set_of(g, sig) & set_of(other[1], other[2])) < -(-shared_least(lo, self.num, self.den) // r):
                            rest.append(other)
                            continue
                        mine, there = min(mine, there), max(mine, there)
                        self.up[there] = mine
                    todo.append(other)
                left = rest

    def edges(self):
        return [(x, r) for x in list(self.up) if (r := self.root(x)) != x]


def ties(num: int, den: int):
    """A function for mapInArrow over probes in order of (key, lane): a forest (u, v) of the pairs of groups that pass the filters."""

    def run(batches):
        pairs, at, held = Pairs(num, den), None, []

        def meet():
            if held:
                pairs.bucket(held, 1 << (at[1] >> 56) - 1)

        for batch in batches:
            for key, where, g, home, n, sig in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if at != (key, where):
                    meet()
                    at, held = (key, where), []
                held.append((n, g, sig))
                if home != g:
                    pairs.homes[g] = home
        meet()
        if found := pairs.edges():
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], ["u", "v"])

    return run


def near_groups(df: DataFrame, k: int = 3, num: int = 90, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, xh (xxhash64 of the text), n_shingles, component_id, n_links, kept.

    ``component_id`` is the smallest id reachable by links, the row's own included (null only if no
    row of the component has an id); ``n_links`` counts the rows that it links with, equal texts
    included. ``kept`` marks one row of each component: that of the smallest id, and of the smallest
    xh among rows with that id; rows that repeat id and text are marked alike. Null texts are empty;
    empty sets link with nothing, not even one another. Repeated rows link as copies. An empty table
    gives an empty result. Only the two named columns are read, whole. Words are lower-cased (A-Z) and
    parted by [\\x20\\x09-\\x0D].
    """
    text = text_or_empty(text_col)
    src = df.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("xh"), text.alias("text"))

    def windows(batches):
        import numpy as np

        hashes = worker_cache("shingle_words", WordHashes)
        for b in batches:
            n, d1, d2, win = [], [], [], []
            for t in b.column(2).cast(pa.binary()).to_pylist():
                s = shingles(t, k, hashes)
                d = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
                n.append(len(s))
                d1.append(int.from_bytes(d[:8], "little", signed=True))
                d2.append(int.from_bytes(d[8:], "little", signed=True))
                win.append(s[: window_size(len(s), num, den)].view(np.int64))
            ends = np.cumsum([0, *map(len, win)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(win) if win else np.empty(0, np.int64)))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()), lists], ["id", "xh", "n", "d1", "d2", "win"])

    sets = written(src.mapInArrow(windows, "id long, xh long, n long, d1 long, d2 long, win array<bigint>"), "sets")
    docs = written(sets.select("id", "xh", "n", "d1", "d2"), "docs")
    # A null id comes last: it stays only in a component without ids.
    lead = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "xh")).alias("lead")
    first = sets.filter("n > 0").groupBy("d1", "d2", "n").agg(lead, F.count("*").alias("copies"), F.first("win").alias("win"))
    whole = written(first.withColumn("node", F.monotonically_increasing_id()), "whole")
    nodes = written(whole.drop("win"), "nodes")
    drop_written(sets)

    # The prefix of a node: the shingles of its window that several nodes have, the rarest first.
    entries = whole.select("node", "n", F.explode("win").alias("key"))
    often = entries.groupBy("key").agg(F.count("*").alias("c")).filter("c > 1")
    prefix = entries.join(often, "key").groupBy("node", "n").agg(F.array_sort(F.collect_list(F.struct("c", "key"))).alias("seen"))
    # m is l of the least partner size.
    m = f"(floor((ceil({num} * n / {den}) - ceil({num} * ceil({num} * n / {den}) / {den})) / 3) + 1)"
    prefix = prefix.filter(F.expr(f"size(seen) >= {m}")).withColumn("name", F.md5(F.concat_ws(",", F.col("n").cast("string"), F.transform("seen", lambda x: x["key"].cast("string")))))
    prefix = written(prefix, "prefixes")
    drop_written(whole)

    # Groups, and the forest of the pairs of groups that pass.
    groups = prefix.groupBy("name").agg(F.min("node").alias("g"), F.count("*").alias("members"), F.first("n").alias("n"), F.first("seen").alias("seen"))
    groups = written(groups, "groups")
    listed = groups.select("g", "n", F.transform("seen", lambda x: x["key"]).alias("keys"), F.transform("seen", lambda x: x["c"]).alias("counts"))

    def forests(rows, last):
        met = rows.select("g", "home", "n", "keys", "counts").mapInArrow(probes(num, den, last=last), "key long, lane long, g long, home long, n long, sig binary")
        return met.repartition("key", "lane").sortWithinPartitions("key", "lane").mapInArrow(ties(num, den), "u long, v long")

    early = written(forests(listed.withColumn("home", F.col("g")), True), "early")
    homes = written(components(early, contracted=True).toDF("g", "root"), "homes")
    late = forests(listed.join(homes, "g", "left").withColumn("home", F.coalesce("root", "g")), False)
    tied = components(early.unionByName(late), contracted=True)

    # Groups of a component, or of several nodes, are expanded to their nodes; large components to blocks within bands of size.
    base = math.log(den / num) * (1 + 1e-9) if num < den else 1.0
    band = F.floor(F.log(F.col("n").cast("double")) / F.lit(base)) if num < den else F.col("n")
    own = groups.join(tied.withColumnRenamed("node", "g"), "g", "left").filter("root is not null or members > 1")
    own = written(own.select("name", F.coalesce("root", "g").alias("comp")), "open")
    drop_written(early, homes)
    cand = prefix.select("node", "name").join(own, "name").join(nodes.select("node", "n", "copies", F.col("lead.id").alias("r_id"), F.col("lead.xh").alias("r_xh")), "node")
    cand = written(cand.select("node", "n", "copies", "r_id", "r_xh", "comp", band.cast("long").alias("band")), "cand")
    drop_written(prefix, groups)
    sizes = cand.groupBy("comp", "band").agg(F.count("*").alias("members"))
    parts = sizes.withColumn("total", F.sum("members").over(Window.partitionBy("comp"))).filter(f"total > {BLOCK}")
    parts = written(parts.select("comp", "band", F.ceil(F.col("members") / BLOCK).cast("int").alias("parts")), "parts")
    cand1 = cand.join(parts, ["comp", "band"], "left")
    small = cand1.filter("parts is null").select("node", "n", "copies", "r_id", "r_xh", "comp", F.lit(None).cast("string").alias("task"), F.lit(0).alias("side"))
    # A node of block (band, h) meets the blocks of its own band and of both neighbours.
    spread = cand1.filter("parts is not null").withColumn("h", F.expr("int(pmod(xxhash64(node), parts))")).drop("parts")
    nearby = parts.select("comp", F.col("band").alias("b"), "parts")
    step = spread.withColumn("b", F.explode(F.expr("array(band - 1, band, band + 1)"))).join(nearby, ["comp", "b"])
    step = step.withColumn("o", F.explode(F.expr("sequence(0, parts - 1)"))).withColumn("lower", F.expr("b > band or (b = band and o >= h)"))
    pair = F.when(F.col("lower"), F.concat_ws(":", "band", "h", "b", "o")).otherwise(F.concat_ws(":", "b", "o", "band", "h"))
    wide = step.select("node", "n", "copies", "r_id", "r_xh", "comp", pair.alias("task"), F.when(F.expr("b = band and o = h"), 2).when(F.col("lower"), 0).otherwise(1).alias("side"))

    # Texts of the nodes that are candidates.
    slot = lambda c: F.pmod(c, F.lit(SIEVE)).cast("int")
    sieve = cand.select(slot(F.col("r_xh")).alias("slot")).distinct()  # at most SIEVE rows
    got = src.withColumn("slot", slot(F.col("xh"))).join(F.broadcast(sieve), "slot", "left_semi").drop("slot")
    work = got.join(small.unionByName(wide), F.expr("id <=> r_id and xh = r_xh")).select("comp", "task", "side", "node", "n", "copies", "text")

    def verify(key, t):
        import numpy as np

        hashes = worker_cache("shingle_words", WordHashes)
        node = np.asarray(t.column("node"))
        _, once = np.unique(node, return_index=True)
        t = t.take(pa.array(once))
        node, n, copies, side = (np.asarray(t.column(c)) for c in ("node", "n", "copies", "side"))
        if len(node) < 2:
            return pa.Table.from_batches([], schema=out)
        own = [shingles(x, k, hashes) for x in t.column("text").cast(pa.binary()).to_pylist()]
        linked = links(own, n, num, den)
        if key[1].as_py() is not None and (side < 2).any():
            linked &= side[:, None] != side[None, :]
        some = linked.any(1)
        root = roots(linked)
        weight = linked @ copies.astype(np.int64)
        return pa.Table.from_arrays([pa.array(node[some]), pa.array(node[root][some]), pa.array(weight[some]), pa.array([key[1].as_py() is not None] * int(some.sum()), pa.bool_())], schema=out)

    out = pa.schema([("node", pa.int64()), ("root", pa.int64()), ("links", pa.int64()), ("part", pa.bool_())])
    found = written(work.groupBy("comp", "task").applyInArrow(verify, "node long, root long, links long, part boolean"), "found")
    n_links = found.groupBy("node").agg(F.sum("links").alias("links"))
    root_of = found.filter("not part").select("node", "root")
    parted = found.filter("part").select(F.col("node").alias("u"), F.col("root").alias("v"))
    if not parted.isEmpty():
        root_of = root_of.unionByName(components(parted))
    # Linked nodes take the least id and the kept row of their component; the tops are written, so that this join can be split.
    linked = written(root_of.join(n_links, "node").join(nodes.select("node", "d1", "d2", "n", "copies", "lead"), "node"), "linked")
    tops = written(linked.groupBy("root").agg(F.min("lead").alias("top")), "tops")
    near = linked.join(tops, "root").select("d1", "d2", "n", "copies", "top", (F.col("links") + F.col("copies") - 1).alias("n_links"))
    far = nodes.join(linked.select("node"), "node", "left_anti").select("d1", "d2", "n", "copies", F.col("lead").alias("top"), (F.col("copies") - 1).alias("n_links"))
    heads = written(near.unionByName(far), "heads")
    drop_written(cand, found, nodes, linked, tops, parts, own)
    return led(docs, heads)


def led(docs: DataFrame, heads: DataFrame) -> DataFrame:
    """Each document with its node's row. The sets with the most copies are broadcast, the others joined."""
    keys, more = ["d1", "d2", "n"], ["top", "n_links"]
    hot = written(heads.filter("copies > 32").orderBy(F.desc("copies"), "d1").limit(HOT_SETS).select(*keys, *more), "hot")
    near = docs.filter("n > 0").join(F.broadcast(hot), keys, "left")
    cold = heads.join(F.broadcast(hot.select(*keys)), keys, "left_anti").select(*keys, *more)
    far = near.filter("n_links is null").select("id", "xh", *keys).join(cold, keys)
    names = ["id", "xh", F.col("n").alias("n_shingles"), F.col("top.id").alias("component_id"), "n_links", F.expr("id <=> top.id and xh = top.xh").alias("kept")]
    lone = docs.filter("n = 0").select("id", "xh", F.col("n").alias("n_shingles"), F.col("id").alias("component_id"), F.lit(0).cast("long").alias("n_links"), F.lit(True).alias("kept"))
    return near.filter("n_links is not null").select(*names).unionByName(far.select(*names)).unionByName(lone)


def keep_one(df: DataFrame, k: int = 5, num: int = 80, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df``, all columns, that stay when one of each component does. Of repeated rows one stays.

    Texts are shuffled once, by a key of id and text; columns of ``df`` may have any names.
    """
    row_key = lambda i, x: F.md5(F.concat_ws("|", F.coalesce(i.cast("string"), F.lit("null")), x.cast("string")))
    found = near_groups(df, k, num, den, id_col, text_col).filter("kept")
    key = fresh("near_key", df)
    kept = written(found.select(row_key(F.col("id"), F.col("xh")).alias(key)).distinct(), "kept")
    rows = df.withColumn(key, row_key(F.col(f"`{id_col}`").cast("long"), F.xxhash64(text_or_empty(F.col(f"`{text_col}`")))))
    return one_of_each(rows.join(kept, key), key).select(*[F.col(f"`{c}`") for c in df.columns])
