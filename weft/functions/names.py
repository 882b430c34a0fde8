"""Event names and other scalar normalisations, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from weft.schemas import EVENT_TYPES


def snake(name: Column) -> Column:
    """CamelCase to snake_case: each capital but the first character's takes an underscore."""
    return F.lower(F.regexp_replace(name, r"(?<!^)([A-Z])", "_$1"))


def camel(name: Column) -> Column:
    return F.replace(F.initcap(F.replace(name, F.lit("_"), F.lit(" "))), F.lit(" "), F.lit(""))


def decapitalize(name: Column) -> Column:
    return F.concat(F.lower(F.left(name, F.lit(1))), F.substr(name, F.lit(2)))


def event_type(name: Column) -> Column:
    """The first known type that the name contains; null if there is none."""
    out = None
    for t in EVENT_TYPES:
        out = F.when(F.contains(name, F.lit(t)), F.lit(t)) if out is None else out.when(F.contains(name, F.lit(t)), F.lit(t))
    return out


def event_state(name: Column) -> Column:
    """The name without its type, in snake case."""
    kind = event_type(name)
    at = F.instr(name, kind)
    rest = F.concat(F.substring(name, F.lit(1), at - 1), F.substr(name, at + F.length(kind)))
    return snake(rest)


def micros(ts: Column) -> Column:
    """Epoch microseconds, UTC; of epoch seconds as a float, rounded."""
    return F.unix_micros(ts.cast("timestamp"))


def seconds_between(start: Column, end: Column) -> Column:
    return (micros(end) - micros(start)) / F.lit(1e6)


def iso_millis(ts: Column) -> Column:
    """ISO 8601 in UTC; the fraction, cut to milliseconds, only where it isn't zero."""
    t = ts.cast("timestamp")
    whole = F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss")
    return F.when(F.pmod(F.unix_micros(t), F.lit(1_000_000)) == 0, F.concat(whole, F.lit("Z"))).otherwise(F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))


def days_ago(as_of: Column, days: Column) -> Column:
    """The moment so many days before, in UTC."""
    return F.timestamp_micros(micros(as_of) - days.cast("long") * 86_400_000_000)


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds since 1970, cut."""
    return F.floor(micros(ts) / 1_000_000).cast("long")


def moment(value: Column) -> Column:
    """Seconds since 1970 as a timestamp."""
    return F.timestamp_seconds(value)


def cli_time(text: Column) -> Column:
    """A command line's timestamp: a date with or without a time of day; null for anything else."""
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in ("yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd HH:mm", "yyyy-MM-dd")])


def exponential_delay(attempt: Column, random: Column) -> Column:
    """Seconds before the next attempt: ``random`` (0 to 1) times a power of two, and one."""
    return random * F.pow(F.lit(2.0), attempt) + 1


def constant_delay(seconds: float) -> Column:
    return F.lit(float(seconds))


def without_prefix(key: Column, prefix: Column) -> Column:
    """A key without the path that it is known to lie under."""
    return F.substr(key, F.length(prefix) + 1)


def before_last_dot(text: Column) -> Column:
    """(head, tail) at the last dot; without a dot the head is empty."""
    tail = F.substring_index(text, ".", -1)
    head = F.when(F.contains(text, F.lit(".")), F.left(text, F.length(text) - F.length(tail) - 1)).otherwise(F.lit(""))
    return F.struct(head.alias("head"), tail.alias("tail"))


def first_id(*ids: Column) -> Column:
    """The first id that is neither null nor zero."""
    return F.coalesce(*[F.nullif(i, F.lit(0)) for i in ids])


def under(name: Column, pattern: Column, sep: str = ".") -> Column:
    """Whether a dotted name is the pattern, lies under it, or the pattern is ``*``."""
    return (pattern == "*") | (name == pattern) | F.startswith(name, F.concat(pattern, F.lit(sep)))


def workflow_name(payload: Column, type_name: Column) -> Column:
    """The class that the input names, else the type's name."""
    return F.coalesce(F.get_json_object(payload, "$.__extra.class"), type_name)


def split_tag(tag: Column) -> Column:
    """``key=value`` to a struct of both, trimmed; a tag without ``=`` is a key."""
    parts = F.split(tag, "=", 2)
    return F.struct(F.trim(parts[0]).alias("key"), F.trim(F.get(parts, F.lit(1))).alias("value"))
