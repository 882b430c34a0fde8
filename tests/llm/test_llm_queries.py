"""The registered queries on the smallest tables, against SQL where there is any; the pipeline."""

import glob
import os

import duckdb
import pytest

import corpus_pipeline
from weft.llm import queries
from weft.llm.common import table

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    df = queries.QUERIES[name](spark, SF)
    cur = con.execute(queries.ORACLE_SQL[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    assert sorted(map(repr, (tuple(r) for r in df.select(names).collect()))) == sorted(map(repr, cur.fetchall()))


def test_pipeline(spark):
    docs = table(spark, SF, "documents")
    labels = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    kept = docs
    sizes = [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, SF)
        assert kept.columns == docs.columns
        sizes.append(kept.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > 0
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    packed = corpus_pipeline.run(spark, SF)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == ids
    good = [i for i, q in labels.items() if q == 1]
    first = {r.doc_id for r in corpus_pipeline.STAGES[0][1](spark, docs, SF).select("doc_id").collect()}
    assert sum(i in first for i in good) >= 0.95 * len(good)


def clashing(spark, rows):
    """Documents with columns of every name that stages use for their own ends."""
    names = ["quality_score", "copy_key", "near_key", "copy", "k_id", "k_row", "k_row_sha", "k_n", "id", "xh", "n", "node", "digest", "score", "top"]
    return spark.createDataFrame([(i, t, *names) for i, t in rows], "doc_id long, text string, " + ", ".join(f"{n} string" for n in names)), names


def test_stages_keep_clashing_columns(spark):
    text = "one two three four five six seven eight nine ten"
    docs, names = clashing(spark, [(1, text), (2, text + "  "), (3, text + " eleven"), (3, text + " eleven"), (4, None), (None, "alone in here")])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, SF)
        assert got.columns == docs.columns
        assert all(r[n] == n for r in got.collect() for n in names)


def test_stages_by_brute_force(spark):
    """Each stage on its predecessor's result: what stays is what a plain program keeps."""
    from test_dedup_join import brute_dedup, brute_groups
    from test_text_models import edit_distance_within

    from weft.llm import decontaminate, quality
    from weft.llm.common import fold

    docs = table(spark, SF, "documents")
    pairs = lambda df: sorted((r.doc_id, r.text or "") for r in df.collect())
    ids = lambda df: {r.doc_id for r in df.collect()}
    stages = dict(corpus_pipeline.STAGES)
    good = stages["quality classifier"](spark, docs, SF).cache()
    model = quality.train(docs, table(spark, SF, "labels"), lambda k: fold(k, 4) != 2)
    want = set()
    for i, t in pairs(docs):
        z = model.slope * quality.margin(quality.indicators(t.encode(), quality.WordKeys()), model.weights, model.ratios) + model.shift
        want |= {i} if 1 / (1 + 2.718281828459045 ** -z) >= 0.7 else set()
    assert ids(good) == want
    once = stages["exact dedup"](spark, good, SF).cache()
    assert ids(once) == {keep for _, keep, *_ in brute_dedup(pairs(good))}
    apart = stages["n-gram jaccard join"](spark, once, SF).cache()
    assert ids(apart) == {root for _, _, root, _ in brute_groups(pairs(once), 5, 80, 100)}
    clean = stages["benchmark decontamination"](spark, apart, SF)
    items = [decontaminate.normalise(r.text) for r in table(spark, SF, "benchmark").collect() if r.text]
    leaks = set()
    for i, t in pairs(apart):
        norm = decontaminate.normalise(t)
        for item in items:
            most = int(len(item) * decontaminate.RATE)
            # The full distance only where a piece of the item occurs: elsewhere it can't be small enough.
            if any(x in norm for _, x in decontaminate.pieces(item)) and edit_distance_within(item, norm) <= most:
                leaks.add(i)
    assert ids(clean) == ids(apart) - leaks and leaks
