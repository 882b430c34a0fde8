"""Benchmark decontamination by pigeonhole edit matching.

A test item of m characters may differ from a passage by at most floor(m * rate) edits; cut into one
piece more than that, at least one piece is unharmed in the passage. Pieces are found exactly (one
automaton over all pieces), and each hit's surroundings are verified with Myers' bit-parallel
distance.
"""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weft.llm.common import worker_cache

#: Edits allowed, per character of the item.
RATE = 0.08
#: Characters of items in one automaton; a larger benchmark is matched in blocks of this size.
BLOCK_CHARS = 4_000_000


def normalise(text: str) -> str:
    """Lower case, white space to single spaces."""
    return " ".join(text.lower().split())


def pieces(item: str, rate: float = RATE) -> list[tuple[int, str]]:
    """The item in floor(m * rate) + 1 pieces of nearly equal length: (offset, piece)."""
    m, k = len(item), int(len(item) * rate)
    cut = [m * i // (k + 1) for i in range(k + 2)]
    return [(a, item[a:b]) for a, b in zip(cut, cut[1:], strict=False) if b > a]


def peq(item: str) -> dict[str, int]:
    out: dict[str, int] = {}
    for i, c in enumerate(item):
        out[c] = out.get(c, 0) | 1 << i
    return out


def myers(item: str, text: str, most: int, table: dict[str, int] | None = None) -> tuple[int, int]:
    """(least distance between ``item`` and a substring of ``text``, its end), by Myers' bit vectors.

    Distances over ``most`` come back as ``most + 1`` with end -1.
    """
    m = len(item)
    if not m:
        return 0, 0
    table = peq(item) if table is None else table
    mask, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score = mask, 0, m
    best, end = (m, 0) if m <= most else (most + 1, -1)
    for j, c in enumerate(text):
        eq = table.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv) & mask
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph = ph << 1 & mask
        mh = mh << 1 & mask
        pv = mh | ~(xv | ph) & mask
        mv = ph & xv
        if score < best:
            best, end = score, j + 1
    return best, end


def blocks(items: list[tuple[int, str]], most: int = BLOCK_CHARS):
    held, size = [], 0
    for item in items:
        if held and size + len(item[1]) > most:
            yield held
            held, size = [], 0
        held.append(item)
        size += len(item[1])
    if held:
        yield held


def match_text(text: str, automaton, items, rate: float):
    """[(item index, end, distance)]: the best match of each item that the text holds."""
    tried: dict[int, list[tuple[int, int]]] = {}
    found: dict[int, tuple[int, int]] = {}
    for end, uses in automaton.iter(text):
        for i, offset, size in uses:
            if found.get(i, (1, 0))[0] == 0:
                continue
            item, table = items[i][1], items[i][2]
            m, k = len(item), int(len(item) * rate)
            start = end + 1 - size - offset
            if 0 <= start and text.startswith(item, start):
                found[i] = (0, start + m)
                continue
            lo, hi = max(0, start - k), min(len(text), start + m + k)
            if any(a <= lo and hi <= z for a, z in tried.get(i, ())):
                continue
            tried.setdefault(i, []).append((lo, hi))
            if hi - lo < m - k:
                continue
            d, z = myers(item, text[lo:hi], k, table)
            if d <= k and (i not in found or d < found[i][0]):
                found[i] = (d, lo + z)
    return [(i, z, d) for i, (d, z) in sorted(found.items())]


def matchers(benchmark: DataFrame, item_col: str, item_text_col: str, rate: float):
    """A factory per block of test items, broadcast: it gives the function text -> [(item, end, edits)], made once a worker."""
    listed = benchmark.select(F.col(item_col).cast("long").alias("i"), F.col(item_text_col).alias("t")).filter("t is not null").orderBy("i", "t")
    for block in blocks([(i, n) for i, t in listed.toLocalIterator() if (n := normalise(t))]):
        shared = benchmark.sparkSession.sparkContext.broadcast(block)

        def build(shared=shared):
            import ahocorasick

            items = [(i, t, peq(t)) for i, t in shared.value]
            uses: dict[str, list] = {}
            for k, (_, t, _) in enumerate(items):
                for offset, piece in pieces(t, rate):
                    uses.setdefault(piece, []).append((k, offset, len(piece)))
            automaton = ahocorasick.Automaton()
            for piece, who in uses.items():
                automaton.add_word(piece, who)
            automaton.make_automaton()
            return lambda text: [(items[i][0], z, d) for i, z, d in match_text(normalise(text or ""), automaton, items, rate)]

        name = f"benchmark:{uuid.uuid4().hex}"
        yield lambda name=name, build=build: worker_cache(name, build)


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", rate: float = RATE) -> DataFrame:
    """One row per document and test item it holds: id, item_id, edits, end.

    Texts are compared in lower case with single spaces; ``edits`` is the least edit distance between
    the item and a passage around a piece hit, at most floor(length * rate), and ``end`` the code
    points of the normalised text up to the passage's end. Items that are null or blank match nothing;
    items with equal texts match alike. A null text is empty; null ids pass through; repeated
    documents give repeated rows; an empty table on either side gives none. Other columns aren't
    read. The items are read by the driver in blocks of BLOCK_CHARS characters, each broadcast and
    matched in turn, so all of a benchmark of any size is used.
    """
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    spec = "id long, item_id long, edits int, end long"
    out = None
    for make in matchers(benchmark, item_col, item_text_col, rate):

        def run(batches, make=make):
            match = make()
            for b in batches:
                rows = [(rid, i, d, z) for rid, t in zip(*(c.to_pylist() for c in b.columns), strict=True) for i, z, d in match(t)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.int32(), pa.int64()), strict=True)], ["id", "item_id", "edits", "end"])

        got = src.mapInArrow(run, spec)
        out = got if out is None else out.unionByName(got)
    if out is None:
        out = docs.sparkSession.createDataFrame([], spec)
    return out.withColumnRenamed("id", id_col)


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", rate: float = RATE) -> DataFrame:
    """The documents, with all their columns, that hold no test item; they stay where they are."""
    at = docs.columns.index(text_col)
    for make in matchers(benchmark, item_col, item_text_col, rate):

        def run(batches, make=make):
            match = make()
            for b in batches:
                yield b.filter(pa.array([not match(t) for t in b.column(at).to_pylist()], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
