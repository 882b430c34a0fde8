"""Connected components of an edge table: contraction in partitions, then stars over written tables."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weft.llm.common import drop_written, written

#: Edges that one task may hold; also those that a task gathers before it contracts them.
LOCAL_EDGES = 1 << 20
SPEC = "u long, v long"


def contract(u, v):
    """(ids, root of each) of an edge list, as numpy arrays; ids are sorted, roots the least that are reachable."""
    import numpy as np

    ids, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    lab = np.arange(len(ids))
    while True:
        x, y = lab[a], lab[b]
        a, b = np.maximum(x, y), np.minimum(x, y)
        apart = a != b
        if not apart.any():
            return ids, ids[lab]
        a, b = a[apart], b[apart]
        np.minimum.at(lab, a, b)
        while not np.array_equal(up := lab[lab], lab):
            lab = up


def forest(most: int = LOCAL_EDGES):
    """A function for mapInArrow: a partition's edges to stars (u, least v), for each run of ``most`` less than its nodes; loops stay, once each."""

    def run(batches):
        import numpy as np

        held, size = [], 0

        def out(edges):
            u, v = edges
            return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

        def stars():
            u, v = (np.concatenate(x) for x in zip(*held, strict=True))
            ids, root = contract(u, v)
            far, own = ids != root, np.unique(u[u == v])
            return np.concatenate([ids[far], own]), np.concatenate([root[far], own])

        for b in batches:
            held.append((np.asarray(b.column(0)), np.asarray(b.column(1))))
            size += b.num_rows
            if size >= most:
                held = [stars()]
                size = len(held[0][0])
                if 2 * size >= most:
                    yield out(held.pop())
                    size = 0
        if size:
            yield out(stars())

    return run


def label(batches):
    """All edges of a small table, in one task: (node, root) of every node."""
    import numpy as np

    held = [(np.asarray(b.column(0)), np.asarray(b.column(1))) for b in batches]
    if sum(len(u) for u, _ in held):
        ids, root = contract(np.concatenate([u for u, _ in held]), np.concatenate([v for _, v in held]))
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(root, pa.int64())], ["node", "root"])


def components(edges: DataFrame, local: int = LOCAL_EDGES, contracted: bool = False) -> DataFrame:
    """(node, root) for every node of an edge table (u, v), root being the least node that is reachable.

    Loops (u = v) and repeated edges are allowed; null ends aren't; an empty table gives an empty one.
    Each partition contracts its edges to stars first, unless they are ``contracted`` already. If at most ``local`` edges remain, by count,
    one task labels them; while there are more, rounds go on. A round ties every greater neighbour of
    a node to the least one (least ones are found before the shuffle and written, so the join that
    follows can be split at a hub), contracts what a partition has, deals the rest by the greater end,
    of which a partition has one edge at most, and contracts again. Rounds end when an edge table
    repeats itself; it then is one of stars.
    """
    edges = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    # A second Python node in a stage would be a second worker a task.
    all_edges = written(edges if contracted else edges.mapInArrow(forest(), SPEC), "edges")
    if all_edges.count() <= local:
        return all_edges.coalesce(1).mapInArrow(label, "node long, root long")
    e, before, mark = all_edges.filter("u <> v"), None, ()
    while mark != before:
        before = mark
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = written(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "least")
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        after = written(large.mapInArrow(forest(), SPEC).repartition("u").mapInArrow(forest(), SPEC).distinct(), "stars")
        drop_written(least, *([] if before == () else [e]))
        e, mark = after, after.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    ends = e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(e.select("v", F.col("v").alias("root")).toDF("node", "root"))
    loops = all_edges.filter("u = v").toDF("node", "root")
    return ends.unionByName(loops).groupBy("node").agg(F.min("root").alias("root"))
