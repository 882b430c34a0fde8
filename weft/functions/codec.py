"""Payload codec: JSON or raw values, oversized fields, task ids, command lines."""

from __future__ import annotations

import json
import zlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weft.schemas import EXTERNAL_PREFIX, LIMITS, MAX_EXTERNAL


def parsed(text: Column) -> Column:
    """The variant of a JSON text; null for anything else, text after a value included.

    The parser stops after a value, so the text is parsed as the one element of an array and, lest it
    close that itself, as the one member of an object.
    """
    items = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))), "$", "array<variant>")
    member = F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit("}")))
    return F.when((F.size(items) == 1) & member.isNotNull(), F.try_element_at(items, F.lit(1)))


def json_or_raw(text: Column) -> Column:
    """Struct of the parsed value as canonical JSON text (null if it isn't JSON or is empty) and the raw text."""
    raw = F.nullif(text, F.lit(""))
    return F.struct(F.to_json(parsed(raw)).alias("parsed"), raw.alias("raw"))


def truncate(text: Column, limit: int = LIMITS["identity"], suffix: str = " ...") -> Column:
    """Text over ``limit`` characters is cut to it, the suffix included."""
    return F.when(F.length(text) > limit, F.concat(F.left(text, F.lit(limit - len(suffix))), F.lit(suffix))).otherwise(text)


def blob_path(text: Column) -> Column:
    return F.concat(F.lit("blobs/"), F.md5(text))


def encode_field(text: Column, limit: int) -> Column:
    """What stands in the field: the value, or beyond ``limit`` characters a reference of path and size."""
    return F.when(F.length(text) <= limit, text).otherwise(F.concat(F.lit(EXTERNAL_PREFIX), blob_path(text), F.lit(" "), F.length(text).cast("string")))


def too_large(text: Column, limit: int, external: bool = True) -> Column:
    """Whether a value can neither stand in the field nor be kept outside."""
    return F.length(text) > (MAX_EXTERNAL if external else limit)


def externalise(df: DataFrame, key: str, field: str, limit: int) -> tuple[DataFrame, DataFrame]:
    """(rows with the field encoded, blob table of path and content)."""
    rows = df.withColumn(field, encode_field(F.col(field), limit))
    blobs = df.filter(F.length(field) > limit).select(blob_path(F.col(field)).alias("path"), F.col(field).alias("content")).dropDuplicates(["path"])
    return rows, blobs


def decode(df: DataFrame, blobs: DataFrame, field: str) -> DataFrame:
    """The rows with references replaced by their content; values that aren't references stay.

    ``blobs`` has one row a path, so that the join falls away where the field isn't selected.
    """
    path = F.when(F.startswith(F.col(field), F.lit(EXTERNAL_PREFIX)), F.split(F.substr(F.col(field), F.lit(len(EXTERNAL_PREFIX) + 1)), " ")[0])
    got = df.withColumn("_path", path).join(blobs.select(F.col("path").alias("_path"), F.col("content").alias("_content")), "_path", "left")
    return got.withColumn(field, F.coalesce("_content", field)).drop("_path", "_content")


def short_id(task_id: Column) -> Column:
    """Ids over 256 characters keep 223 of them and the md5 of the whole."""
    return F.when(F.length(task_id) > 256, F.concat(F.left(task_id, F.lit(223)), F.lit("-"), F.md5(task_id))).otherwise(task_id)


def idempotent_id(name: Column, args: Column, kwargs: Column | None = None) -> Column:
    """``name-md5`` over the compact JSON of the arguments; null arguments stay in it."""
    call = F.named_struct(F.lit("args"), args, F.lit("kwargs"), kwargs if kwargs is not None else F.from_json(F.lit("{}"), "map<string,string>"))
    return short_id(F.concat(name, F.lit("-"), F.md5(F.to_json(call, {"ignoreNullFields": "false"}))))


def command_line(args: Column, kwargs: Column) -> Column:
    """Named arguments (``--name="value"``, one letter ``-n="value"``), then positional ones in quotes."""
    named = F.transform(F.array_sort(F.map_entries(kwargs)), lambda e: F.concat(F.when(F.length(e["key"]) > 1, F.lit("--")).otherwise(F.lit("-")), e["key"], F.lit('="'), e["value"], F.lit('"')))
    placed = F.transform(args, lambda a: F.concat(F.lit('"'), a, F.lit('"')))
    return F.array_join(F.concat(named, placed), " ")


@F.pandas_udf(T.StringType())
def hex_hash(text: pd.Series) -> pd.Series:
    """Adler-32 of the UTF-8 bytes in hex without padding; an empty text gives ``0``.

    A library call on each value of an Arrow batch: the same sums over an array of single bytes, as
    column expressions, take far longer and far more memory on long texts.
    """
    return text.map(lambda s: None if s is None else f"{zlib.adler32(s.encode()) if s else 0:x}")


def json_dump(text: Column, pretty: bool = False, ascii_only: bool = False) -> Column:
    """A JSON text anew, with sorted keys at every level and nulls kept: compact or pretty, other letters escaped if ``ascii_only``.

    Null for what isn't JSON. A variant keeps its members in order of their names.
    """
    out = F.to_json(parsed(text), {"pretty": "true"}) if pretty else F.to_json(parsed(text))
    if not ascii_only:
        return out
    code = lambda c: F.lower(F.hex(F.encode(c, "UTF-16BE")))
    escaped = F.array_join(F.transform(F.split(out, ""), lambda c: F.when(F.octet_length(c) < 2, c).otherwise(F.regexp_replace(code(c), "(.{4})", r"\\u$1"))), "")
    return F.when(F.octet_length(out) == F.length(out), out).otherwise(escaped)


def poll_data(text: Column, schema: str) -> Column:
    """What a task poll would bring, from its base64 JSON; null for anything else."""
    return F.from_json(F.try_to_binary(text, F.lit("base64")).cast("string"), schema)


def without_nulls(value):
    if isinstance(value, dict):
        return {k: without_nulls(v) for k, v in value.items() if v is not None}
    if isinstance(value, list):
        return [without_nulls(v) for v in value if v is not None]
    return value


@F.pandas_udf(T.StringType())
def remove_none(text: pd.Series) -> pd.Series:
    """JSON text without null members or elements at any depth, compact with sorted keys; other text is null."""

    def one(s):
        try:
            return json.dumps(without_nulls(json.loads(s)), sort_keys=True, separators=(",", ":"))
        except (TypeError, ValueError):
            return None

    return text.map(one)


def compact_json(*fields: Column) -> Column:
    """Compact JSON of the given fields with nulls kept; name them in order of their keys."""
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def without_falsy(**fields: Column) -> Column:
    """Compact JSON of the fields that aren't null, empty or zero."""
    return F.to_json(F.struct(*[F.when((c.cast("string") != "") & (c.cast("string") != "0") & (c.cast("string") != "false"), c).alias(k) for k, c in sorted(fields.items())]))
