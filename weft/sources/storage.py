"""Objects in a bucket: push, pull and listing, through Spark's own file systems."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: What a host of an object store ends with, unless told otherwise.
HOST = "s3.amazonaws.com"


def bucket_and_host(bucket: str, locations: dict[str, str] | None = None, default: str = HOST, suffix: str = "amazonaws.com") -> tuple[str, str]:
    """(bucket, host) of ``host/bucket``, or of a bucket alone, whose location is known or the default."""
    host, slash, name = bucket.partition("/")
    if not slash:
        return bucket, (locations or {}).get(bucket) or default
    if "/" in name:
        raise ValueError(f"{bucket!r} has more than one slash")
    if not host.endswith(suffix):
        raise ValueError(f"{host!r} isn't a host of *.{suffix}")
    return name, host


def bucket_columns(bucket: Column, default: str = HOST) -> Column:
    """Struct (bucket, host) of texts as :func:`bucket_and_host` reads them; null where that raises."""
    parts = F.split(bucket, "/")
    host = F.when(F.size(parts) == 1, F.lit(default)).when((F.size(parts) == 2) & F.endswith(parts[0], F.lit("amazonaws.com")), parts[0])
    return F.when(host.isNotNull(), F.struct(parts[F.size(parts) - 1].alias("bucket"), host.alias("host")))


def push(df: DataFrame, folder: str, key: str, content: str, mode: str = "append", encryption: str | None = None) -> None:
    """Write each row's content as an object, under a folder of its key: many at once, one file a key and task.

    ``encryption`` is the server-side algorithm to ask an object store for.
    """
    conf = df.sparkSession.sparkContext._jsc.hadoopConfiguration()
    before = conf.get("fs.s3a.encryption.algorithm")
    if encryption:
        conf.set("fs.s3a.encryption.algorithm", encryption)
    try:
        df.select(F.col(key).cast("string").alias("object"), F.col(content).cast("string").alias("value")).write.mode(mode).partitionBy("object").option("lineSep", "\x00").text(folder)
    finally:
        conf.unset("fs.s3a.encryption.algorithm") if before is None else conf.set("fs.s3a.encryption.algorithm", before)


def pull(spark: SparkSession, folder: str, prefix: str = "") -> DataFrame:
    """(object, content) of the pushed objects whose key starts with ``prefix``; others aren't opened."""
    objects = spark.read.option("lineSep", "\x00").schema("value string, object string").text(folder)
    return objects.filter(F.startswith("object", F.lit(prefix))).select("object", F.col("value").alias("content"))


def keys(spark: SparkSession, folder: str, prefix: str = "") -> DataFrame:
    """Keys of the pushed objects that start with ``prefix``."""
    return pull(spark, folder, prefix).select("object").distinct()


def safe_key(text: str) -> str:
    return re.sub(r"[^A-Za-z0-9._-]", "_", text)
