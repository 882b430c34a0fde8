"""Exact deduplication with keyed streaming state.

The state, kept by digest in RocksDB on the executors' disks and checkpointed in the shared folder,
has no expiry; it holds the digest, the stable id of the row that stays, a content locator and a
count. Partial aggregates reach it, so a large group of copies is a few rows. Groups with hits are
then checked over their full bytes; where a digest stands for several texts, the text is the key.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weft.llm.common import fresh, one_of_each, shared_dir, text_or_empty, written

#: Fixed values of the contract: the characters that are deleted, [\x20\x09-\x0D].
DELETED = b"\x20\x09\x0a\x0b\x0c\x0d"
#: Groups that are broadcast when rows are led to their group; the largest ones, at most this many.
HOT_GROUPS = 1000
#: Bits of the sieve that keeps digests without hits out of the byte check.
SIEVE_BITS = 1 << 18
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "100",
    # Many small stores: no space is set aside for their logs, and changes are uploaded, not whole stores.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def sha256(norm: bytes) -> str:
    return hashlib.sha256(norm).hexdigest()


def best_row():
    """The row that stays: most code points, then the smallest id, nulls last."""
    return F.max(F.struct("n", F.col("id").isNotNull().alias("has"), (-F.col("id")).alias("neg"), F.col("locator")))


def dedup_stream(rows: DataFrame, out: str, checkpoint: str) -> None:
    """Run the keyed state over a stream of (digest, id, n, locator, copies) until its source is read.

    Each trigger writes the groups it changed under ``out``: digest, the row that stays with its
    locator, and the number of rows so far. A later call with the same folders goes on from there.
    """
    spark = rows.sparkSession
    groups = rows.groupBy("digest").agg(best_row().alias("best"), F.sum("copies").alias("size"))

    def keep(changed: DataFrame, trigger: int) -> None:
        changed.write.mode("overwrite").parquet(f"{out}/trigger={trigger}")

    before = {k: spark.conf.get(k, None) for k in STATE}
    try:
        for k, v in STATE.items():
            spark.conf.set(k, v)
        groups.writeStream.outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(keep).start().awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def stream_groups(rows: DataFrame) -> DataFrame:
    """Groups (digest, best, size) of a written table, by way of the stream; rows may not be empty."""
    spark = rows.sparkSession
    folder, source = shared_dir(spark), rows.inputFiles()[0].rsplit("/", 1)[0]
    dedup_stream(spark.readStream.schema(rows.schema).parquet(source), f"{folder}/groups", f"{folder}/state")
    last = spark.read.parquet(f"{folder}/groups").groupBy("digest").agg(F.max(F.struct("trigger", "best", "size")).alias("g"))
    return last.select("digest", "g.best", "g.size")


def dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest=sha256) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical without white space; of equal ones the row with the most
    code points in the original stays, then the smallest id. Null texts count as empty, and empty
    texts equal each other. A null id is last in order. Of rows that repeat id and text, one is
    kept. An empty table gives an empty result. Other columns, whatever their names, aren't read.
    ``digest`` (normalised bytes to text) is the key of the state; it may collide, since groups with
    hits are checked byte by byte.
    """
    src = df.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text"))

    def hashed(batches):
        for b in batches:
            texts = b.column(1).to_pylist()
            norm = [t.encode("utf-8", "surrogatepass").translate(None, DELETED) for t in texts]
            shas = [hashlib.sha256(x).hexdigest() for x in norm]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array(shas, pa.string()), pa.array([digest(x) for x in norm], pa.string()) if digest is not sha256 else pa.array(shas, pa.string())], ["id", "n", "sha", "digest"])

    rows = src.mapInArrow(hashed, "id long, n long, sha string, digest string")
    rows = rows.groupBy("id", "n", "sha", "digest").agg(F.count("*").alias("copies"))
    # The locator leads to the content: the row's id and the hash of its normalised bytes.
    rows = written(rows.withColumn("locator", F.struct(F.col("id").alias("row"), F.col("sha"))), "rows")
    if not rows.inputFiles() or rows.isEmpty():
        return rows.select(F.col("id").alias(id_col), F.col("id").alias("keep_id"), F.col("copies").alias("group_size"), F.lit(True).alias("kept"), F.col("sha").alias("text_sha256")).limit(0)
    groups = written(stream_groups(rows), "groups")
    bad = written(colliding(src, groups, digest), "bad")
    if bad.isEmpty():
        out = led(rows, groups)
    else:
        out = led(rows.join(bad, "digest", "left_anti"), groups.join(bad, "digest", "left_anti")).unionByName(by_text(src, bad, digest))
    kept = F.expr("copy = 1 and id <=> keep and n = keep_n and sha = kept_sha")
    out = out.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    return out.select(F.col("id").alias(id_col), F.col("keep").alias("keep_id"), F.col("size").alias("group_size"), kept.alias("kept"), F.col("sha").alias("text_sha256"))


def led(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Each row with its group. The largest groups are broadcast, so no digest is dealt to one task."""
    flat = groups.select("digest", (-F.col("best.neg")).alias("keep"), F.col("best.n").alias("keep_n"), F.col("best.locator.sha").alias("kept_sha"), "size")
    hot = written(flat.filter("size > 32").orderBy(F.desc("size"), "digest").limit(HOT_GROUPS), "hot")
    near = rows.select("id", "n", "sha", "digest", "copies").join(F.broadcast(hot), "digest", "left")
    cold = flat.join(F.broadcast(hot.select("digest")), "digest", "left_anti")
    far = near.filter("size is null").select("id", "n", "sha", "digest", "copies").join(cold, "digest")
    return near.filter("size is not null").unionByName(far)


def colliding(src: DataFrame, groups: DataFrame, digest) -> DataFrame:
    """Digests whose rows don't all have the same normalised bytes.

    A fixed-size sieve of the digests with hits keeps most other texts in place; the rest meet as
    the least and greatest bytes of a digest, of which each task sends one pair.
    """
    slot = F.pmod(F.crc32(F.col("digest").cast("binary")), F.lit(SIEVE_BITS)).cast("int")
    slots = bytearray(SIEVE_BITS // 8)
    for (k,) in groups.filter("size > 1").select(slot.alias("k")).distinct().collect():  # at most SIEVE_BITS numbers
        slots[k >> 3] |= 1 << (k & 7)
    sieve = src.sparkSession.sparkContext.broadcast(bytes(slots))

    def hits(batches):
        import zlib

        bits = sieve.value
        for b in batches:
            keys, texts = [], []
            for t in b.column(0).to_pylist():
                norm = t.encode("utf-8", "surrogatepass").translate(None, DELETED)
                key = digest(norm)
                k = zlib.crc32(key.encode()) % SIEVE_BITS
                if bits[k >> 3] >> (k & 7) & 1:
                    keys.append(key)
                    texts.append(norm)
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(texts, pa.binary())], ["digest", "norm"])

    found = src.select("text").mapInArrow(hits, "digest string, norm binary")
    return found.groupBy("digest").agg(F.min("norm").alias("a"), F.max("norm").alias("z")).filter("a <> z").select("digest")


def by_text(src: DataFrame, bad: DataFrame, digest) -> DataFrame:
    """The rows of colliding digests, grouped by their full normalised bytes."""

    def norms(batches):
        for b in batches:
            texts = b.column(1).to_pylist()
            norm = [t.encode("utf-8", "surrogatepass").translate(None, DELETED) for t in texts]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array([hashlib.sha256(x).hexdigest() for x in norm], pa.string()), pa.array([digest(x) for x in norm], pa.string()), pa.array(norm, pa.binary())], ["id", "n", "sha", "digest", "norm"])

    rows = src.mapInArrow(norms, "id long, n long, sha string, digest string, norm binary").join(bad, "digest", "left_semi")
    rows = rows.groupBy("id", "n", "sha", "digest", "norm").agg(F.count("*").alias("copies")).withColumn("locator", F.struct(F.col("id").alias("row"), F.col("sha")))
    groups = rows.groupBy("norm").agg(best_row().alias("best"), F.sum("copies").alias("size"))
    flat = groups.select("norm", (-F.col("best.neg")).alias("keep"), F.col("best.n").alias("keep_n"), F.col("best.locator.sha").alias("kept_sha"), "size")
    return rows.join(flat, "norm").select("digest", "id", "n", "sha", "copies", "keep", "keep_n", "kept_sha", "size")


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that stay, with all their columns. Of rows that repeat id and text, one stays.

    What stays is settled on slim keys; whole rows are shuffled once, by a key of id and normalised
    text. Columns of ``df`` may have any names.
    """
    row_key = lambda i, sha: F.concat_ws("|", F.coalesce(i.cast("string"), F.lit("null")), sha)
    key = fresh("copy_key", df)
    text = text_or_empty(F.col(f"`{text_col}`"))
    kept = written(dedup(df, id_col, text_col).filter("kept").select(row_key(F.col(id_col), F.col("text_sha256")).alias(key)), "kept")
    rows = df.withColumn(key, row_key(F.col(f"`{id_col}`").cast("long"), F.sha2(F.translate(text, DELETED.decode(), ""), 256)))
    return one_of_each(rows.join(kept, key), key, F.length(text).desc()).select(*[F.col(f"`{c}`") for c in df.columns])
