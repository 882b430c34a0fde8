"""History inspection: filters, slices, runs of one type, transition checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weft.schemas import TRANSITIONS


def where(df: DataFrame, **equal) -> DataFrame:
    """Rows whose columns equal all the given values; None matches null."""
    return df.filter(reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.lit(v)) for k, v in equal.items()], F.lit(True)))


def latest_n(df: DataFrame, n: int, key: str = "u", order: str = "e") -> DataFrame:
    """The last n events of each execution."""
    w = Window.partitionBy(key).orderBy(F.desc(order))
    return df.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= n).drop("_r")


def pages(df: DataFrame, max_results: int | None = None, page_size: int = 100, reverse: bool = False, key: str = "u", order: str = "e") -> DataFrame:
    """Events with their ``page`` from 1, newest first if ``reverse``; exactly ``max_results`` of an execution at most."""
    w = Window.partitionBy(key).orderBy(F.desc(order) if reverse else F.asc(order))
    rows = df.withColumn("_r", F.row_number().over(w))
    if max_results is not None:
        rows = rows.filter(F.col("_r") <= max_results)
    return rows.withColumn("page", (F.floor((F.col("_r") - 1) / page_size) + 1).cast("long")).drop("_r")


def find_timers(wanted: DataFrame, timers: DataFrame) -> DataFrame:
    """Wanted timers (u, id, cancel) with the state of their timer; a cancellation is found only once it has succeeded or failed."""
    found = timers.select("u", "id", F.col("last_state").alias("state"), (F.col("canceled_id").isNotNull() | F.col("cancel_failed_id").isNotNull()).alias("_over"))
    return wanted.join(found, ["u", "id"], "left").select(*wanted.columns, F.when(~F.col("cancel") | F.col("_over"), F.col("state")).alias("state"))


def between(df: DataFrame, start: int, stop: int | None, key: str = "u", order: str = "e") -> DataFrame:
    """Positions [start, stop) of each execution, counted from 0; negative ones from the end."""
    w = Window.partitionBy(key).orderBy(order)
    pos = F.row_number().over(w) - 1
    size = F.count("*").over(Window.partitionBy(key))
    rows = df.withColumn("_p", pos).withColumn("_n", size)
    lo = F.lit(start) if start >= 0 else F.greatest(F.col("_n") + start, F.lit(0))
    cond = F.col("_p") >= lo
    if stop is not None:
        cond &= F.col("_p") < (F.lit(stop) if stop >= 0 else F.col("_n") + stop)
    return rows.filter(cond).drop("_p", "_n")


def finished(df: DataFrame, all_terminal: bool = False) -> DataFrame:
    """Whether each execution's last event ends it; time-outs and continuations count with ``all_terminal``."""
    ends = ["completed", "failed", "canceled", "terminated"] + (["timed_out", "continued_as_new"] if all_terminal else [])
    last = F.max_by(F.struct("type", "st"), "e")
    return df.groupBy("u").agg(last.alias("l")).select("u", ((F.col("l.type") == "WorkflowExecution") & F.col("l.st").isin(ends)).alias("finished"))


def islands(df: DataFrame, key: str = "u", order: str = "e", kind: str = "type") -> DataFrame:
    """``island``: the number, from 1, of the run of equal ``kind`` that an event is in."""
    w = Window.partitionBy(key).orderBy(order)
    new = F.when(F.lag(kind).over(w).eqNullSafe(F.col(kind)), 0).otherwise(1)
    return df.withColumn("_new", new).withColumn("island", F.sum("_new").over(w).cast("long")).drop("_new")


def distinct_groups(df: DataFrame, workflow: str, key: str = "u", order: str = "e", kind: str = "type") -> DataFrame:
    """Runs of one type, where a single workflow event later on joins the first run: key, island, type, n, first, last."""
    runs = islands(df, key, order, kind).groupBy(key, "island").agg(F.max(kind).alias("type"), F.count("*").alias("n"), F.min(order).alias("first"), F.max(order).alias("last"))
    merged = F.when((F.col("n") == 1) & (F.col("island") > 1) & (F.col("type") == workflow), 1).otherwise(F.col("island"))
    return runs.withColumn("island", merged.cast("long")).groupBy(key, "island").agg(F.min_by("type", "first").alias("type"), F.sum("n").alias("n"), F.min("first").alias("first"), F.max("last").alias("last"))


def transition_table(spark: SparkSession, kind: str | None = None) -> DataFrame:
    rows = [(t, a, b) for t, m in TRANSITIONS.items() if kind in (None, t) for a, to in m.items() for b in to]
    return spark.createDataFrame(rows, "type string, from_state string, to_state string")


def transitions(df: DataFrame, keys: list[str], state: str = "st", order: str = "e") -> DataFrame:
    """Each event with the state before it in its sequence (null for the first)."""
    return df.withColumn("from_state", F.lag(state).over(Window.partitionBy(*keys).orderBy(order)))


def illegal(df: DataFrame, allowed: DataFrame, initial: str, keys: list[str], state: str = "st", order: str = "e") -> DataFrame:
    """Events whose step from the state before isn't allowed, or which start a sequence in another state.

    ``allowed`` (from_state, to_state) is a fixed machine of a few dozen rows, which is broadcast.
    """
    steps = transitions(df, keys, state, order)
    legal = F.broadcast(allowed.select(F.col("from_state").alias("_f"), F.col("to_state").alias("_t")))
    first_ok = F.col("from_state").isNull() & (F.col(state) == initial)
    return steps.filter(~first_ok).join(legal, (F.col("from_state") == F.col("_f")) & (F.col(state) == F.col("_t")), "left_anti")


def signal_before(waits: DataFrame, signals: DataFrame) -> DataFrame:
    """Each wait (u, name, e) with the latest earlier signal of its name, by one ordered pass over both.

    The two are put in one sequence per (u, name): no inequality join, so a busy name costs a sort only.
    """
    both = waits.select("u", "name", "e", F.lit(None).cast("long").alias("s")).unionByName(signals.select("u", "name", "e", F.col("e").alias("s")))
    w = Window.partitionBy("u", "name").orderBy("e", F.col("s").isNotNull()).rowsBetween(Window.unboundedPreceding, -1)
    return both.withColumn("signal_id", F.last("s", ignorenulls=True).over(w)).filter("s is null").drop("s")


def capped(active: Column, cap: int, key: str, order: list[str]) -> Column:
    """Whether fewer than ``cap`` active rows come before a row."""
    w = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(active.cast("int")).over(w), F.lit(0)) < cap
