"""Harmonic packing of token ids into fixed-length sequences.

Class j holds pieces of (capacity/(j+1), capacity/j] ids, and a bin of class j takes exactly j of
them, so a worker fills its bins alone. Documents are cut so that pieces come to the top of their
class: full sequences first, then the largest floor(capacity/j) that fits, until the rest is small.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections import defaultdict
from itertools import filterfalse

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weft.llm.common import text_or_empty, worker_cache, written

#: Rests of at most capacity / SMALL ids aren't cut further.
SMALL = 16
#: Words, and runs of them, whose ids a worker keeps; the first ones it meets.
CACHED_WORDS = 200_000
#: Tasks whose open bins are closed together.
POOL = 256

PIECES = "length long, ids_crc32 long, doc_tokens long"


class WordIds(dict):
    """Ids of a white-space-free piece of text, as little-endian 32-bit bytes.

    The vocabulary's pre-tokenizer never joins text across white space and drops the white space
    itself, so a text's ids are those of its pieces, one after the other. In words of plain Latin
    letters, where lower case and composed forms are as the normalizer's, the runs that the
    pre-tokenizer parts (letters, a digit, other signs) go to the vocabulary's model one by one and
    are kept, so that a run is merged once however it is capitalised or punctuated.
    """

    # The pre-tokenizer's runs, over ASCII and the letters U+00C0 to U+00FF; line breaks part words.
    ODD = re.compile("[^\n\x21-\x7e\xc0-\xd6\xd8-\xf6\xf8-\xff]|<[|]")
    RUNS = re.compile("\n|'s|'t|'re|'ve|'m|'ll|'d|[a-z\xdf-\xf6\xf8-\xff]+|[0-9]|[^\na-z0-9\xdf-\xf6\xf8-\xff]+")

    def __init__(self, path):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.runs: dict[str, bytes] = {}
        # The signs of each letter's bytes, as the byte-level pre-tokenizer writes them.
        own = ByteLevel(add_prefix_space=False, use_regex=False)
        self.signs = {c: own.pre_tokenize_str(chr(c))[0][0] for c in [*range(0x21, 0x7F), *range(0xC0, 0x100)]}

    def of(self, texts: list[list[bytes]]) -> list[bytes]:
        """The ids of each text, given as its words."""
        got = [list(map(self.get, words)) for words in texts]
        gaps = [[i for i, ids in enumerate(own) if ids is None] for own in got]
        new = {words[i] for words, own in zip(texts, gaps, strict=True) for i in own}
        if new:
            more = dict(self.learn(list(new)))
            for words, own, at in zip(texts, got, gaps, strict=True):
                for i in at:
                    own[i] = more[words[i]]
            if len(self) < CACHED_WORDS:
                self.update(more)
        return list(map(b"".join, got))

    def learn(self, words: list[bytes]):
        """(word, ids) of new words."""
        text = b"\n".join(words).decode("utf-8", "replace")
        if self.ODD.search(text):
            plain = []
            for word in words:
                own = word.decode("utf-8", "replace")
                if self.ODD.search(own):
                    yield word, array("I", self.tokenizer.encode(own, add_special_tokens=False).ids).tobytes()
                else:
                    plain.append(word)
            words, text = plain, b"\n".join(plain).decode()
        if not words:
            return
        flat = self.RUNS.findall(text.lower())
        flat.append("\n")
        runs = self.runs
        new = set(filterfalse(runs.__contains__, flat))
        new.discard("\n")
        new = list(new)
        signs = "\n".join(new).translate(self.signs).split("\n") if new else []
        for run, tokens in zip(new, map(self.tokenizer.model.tokenize, signs), strict=True):
            runs[run] = array("I", [t.id for t in tokens]).tobytes()
        at, held = 0, []
        for run in flat:
            if run == "\n":
                yield words[at], held[0] if len(held) == 1 else b"".join(held)
                at += 1
                held = []
            else:
                held.append(runs[run])
        if len(runs) > CACHED_WORDS:
            for run in new:
                del runs[run]


def cuts(n: int, capacity: int) -> list[int]:
    """Piece lengths for a document of ``n`` ids."""
    out = [capacity] * (n // capacity)
    rest = n % capacity
    while rest > capacity // SMALL:
        j = -(-capacity // rest)  # least j with capacity / j <= rest
        top = capacity // j
        if top > rest:
            top = capacity // (j + 1)
        out.append(top)
        rest -= top
    if rest:
        out.append(rest)
    return out


def pack_open(pieces, capacity):
    """Place leftover pieces (any order, each with its length first): whole classes by count, the rest by best fit.

    Returns [(bin, offset, piece)]. The pieces of fewer than ``j`` that no bin of class j takes are
    placed, longest first, in the fullest bin that has room.
    """
    import bisect

    classes = defaultdict(list)
    for p in pieces:
        classes[capacity // p[0]].append(p)
    out, n, rest = [], 0, []
    for j, own in sorted(classes.items()):
        whole = len(own) // j * j
        for i in range(0, whole, j):
            at = 0
            for p in own[i : i + j]:
                out.append((n, at, p))
                at += p[0]
            n += 1
        rest += own[whole:]
    room: list[tuple[int, int]] = []  # (free, bin), sorted
    for p in sorted(rest, key=lambda p: -p[0]):
        k = bisect.bisect_left(room, (p[0], -1))
        if k < len(room):
            free, b = room.pop(k)
        else:
            free, b = capacity, n
            n += 1
        out.append((b, capacity - free, p))
        if free > p[0]:
            bisect.insort(room, (free - p[0], b))
    return out


def pack(df: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pack all documents; a row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Null and empty texts are the end id alone; null ids pass through; repeated rows are packed
    again, each whole. An empty table gives no rows. Only the two named columns are read. A worker
    fills the bins of each class alone; the bins it leaves open (less than one a class) are closed
    by pools of POOL workers, whose size doesn't depend on the data. ``sequence_id`` is unique, not
    dense. The pieces are written to the shared folder before open bins are closed, so both parts
    see the same cuts even if executors are lost.
    """
    src = df.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text"))
    spec = f"id long, start long, {PIECES}, sequence_id long, offset long, worker int"

    def documents(b, ids_of, chars=1 << 21):
        """(id, ids) of a batch's rows, some megabytes of text at a time."""
        who, held, size = [], [], 0
        for rid, text in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist(), strict=True):
            who.append(rid)
            held.append(text.split())
            size += len(text)
            if size >= chars:
                yield from zip(who, ids_of.of(held), strict=True)
                who, held, size = [], [], 0
        yield from zip(who, ids_of.of(held), strict=True)

    def run(batches):
        import numpy as np
        from pyspark import TaskContext

        ids_of = worker_cache(f"word_ids:{tokenizer}", lambda: WordIds(tokenizer))
        worker = TaskContext.get().partitionId()
        base, bins = worker << 32, 0
        end = np.array([end_id], dtype="<u4").tobytes()
        open_bins = defaultdict(list)
        for b in batches:
            rows = []
            for rid, data in documents(b, ids_of):
                data += end
                n, start = len(data) // 4, 0
                for size in cuts(n, capacity):
                    piece = (size, rid, start, zlib.crc32(data[4 * start : 4 * (start + size)]), n)
                    start += size
                    j = capacity // size
                    own = open_bins[j]
                    own.append(piece)
                    if len(own) == j:
                        at = 0
                        for p in own:
                            rows.append((p[1], p[2], p[0], p[3], p[4], base + bins, at, worker))
                            at += p[0]
                        bins += 1
                        own.clear()
            if rows:
                yield batch(rows)
        rows = [(p[1], p[2], p[0], p[3], p[4], None, None, worker) for own in open_bins.values() for p in own]
        if rows:
            yield batch(rows)

    def batch(rows):
        names = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        cols = list(zip(*rows, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols[:7]] + [pa.array(cols[7], pa.int32())], [*names, "worker"])

    pieces = written(src.mapInArrow(run, spec), "pieces")

    def close(key, got):
        pool = key[0].as_py()
        rows = sorted((r["length"], r["id"] is None, r["id"] or 0, r["start"], r["ids_crc32"], r["doc_tokens"]) for r in got.select(["length", "id", "start", "ids_crc32", "doc_tokens"]).to_pylist())
        base = (1 << 62) + (pool << 32)
        rows = [(None if p[1] else p[2], p[3], p[0], p[4], p[5], base + b, at, 0) for b, at, p in pack_open(rows, capacity)]
        return pa.Table.from_batches([batch(rows)])

    left = pieces.filter("sequence_id is null").withColumn("pool", F.expr(f"worker div {POOL}"))
    names = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    closed = left.groupBy("pool").applyInArrow(close, spec).select(names)
    return pieces.filter("sequence_id is not null").select(names).unionByName(closed).withColumnRenamed("id", id_col)
