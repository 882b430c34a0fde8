"""Statistics and reports over folded entities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Columns that hold the time of each state that a task may be in, by kind.
STATE_TIMES = {
    "activity": {s: f"{s}_us" for s in ("scheduled", "schedule_failed", "started", "completed", "failed", "timed_out", "canceled", "cancel_requested")},
    "child_workflow": {"start_initiated": "initiated_us"} | {s: f"{s}_us" for s in ("start_failed", "started", "completed", "failed", "timed_out", "canceled", "terminated")},
}
COLUMNS = ["input", "result", "reason", "details", "retry"]


def tasks(acts: DataFrame, kids: DataFrame | None = None) -> DataFrame:
    """Activities and child workflows as one table: kind, u, name, last_state, scheduled_us (activities only), started_us, state_us, first_event and values."""
    out = None
    for kind, df in (("activity", acts), ("child_workflow", kids)):
        if df is None:
            continue
        state_us = F.coalesce(*[F.when(F.col("last_state") == s, F.col(c)) for s, c in STATE_TIMES[kind].items()])
        scheduled = F.col("scheduled_us") if kind == "activity" else F.lit(None).cast("long")
        got = df.select(F.lit(kind).alias("kind"), "u", F.col("id").cast("string").alias("name"), "last_state", scheduled.alias("scheduled_us"), "started_us", state_us.alias("state_us"), "first_event", *COLUMNS)
        out = got if out is None else out.unionByName(got)
    return out


def timings(rows: DataFrame) -> DataFrame:
    """scheduled, start, end and duration of each task; the end is the time of its last state, null if it never started.

    A rescheduled activity keeps its earlier start, so that a duration may lie before it.
    """
    end = F.when(F.col("started_us").isNotNull(), F.col("state_us"))
    return rows.withColumn("end_us", end).withColumn("duration", (F.col("end_us") - F.col("started_us")) / F.lit(1e6))


def percentages(times: DataFrame, totals: DataFrame) -> DataFrame:
    """Share of the execution's total time; a duration of null or zero leaves only nulls."""
    some = F.col("duration").isNotNull() & (F.col("duration") != 0)
    joined = times.join(totals, "u")
    return joined.withColumn("percentage", F.when(some & (F.col("total_time") != 0), F.col("duration") / F.col("total_time") * 100)).withColumn("duration", F.when(some, F.col("duration")))


def profile(shares: DataFrame, n: int | None = None) -> DataFrame:
    """Tasks that took time, longest first; ties in order of appearance."""
    stamp = lambda c: F.date_format(F.timestamp_micros(F.col(c)), "yyyy-MM-dd HH:mm")
    out = shares.filter("duration is not null").select("kind", "u", "name", "last_state", stamp("scheduled_us").alias("scheduled"), ((F.col("started_us") - F.col("scheduled_us")) / F.lit(1e6)).alias("time_scheduled"), stamp("started_us").alias("start"), F.col("duration").alias("time_running"), stamp("end_us").alias("end"), "percentage", "first_event")
    out = out.orderBy(F.desc_nulls_last("time_running"), "first_event", "u", "kind")
    return out.limit(n) if n else out


def status(rows: DataFrame, n: int | None = None) -> DataFrame:
    """Last state and its time of tasks (kind, u, name, ...), in reverse order of appearance; signals may be among them."""
    rows = rows.select("kind", "u", "name", "last_state", "state_us", "scheduled_us", "first_event")
    if n is None:
        return rows
    w = Window.partitionBy("u").orderBy(F.desc("first_event"), "kind", "name")
    return rows.withColumn("pos", F.row_number().over(w).cast("long")).filter(F.col("pos") <= n)


def info(rows: DataFrame, executions: DataFrame) -> DataFrame:
    """Per execution of the catalogue: names, tags, the time from the first task's last state to the last task's, the first task's input."""
    order = F.struct("first_event", "kind", "name")
    got = rows.groupBy("u").agg(F.min_by(F.struct("state_us", "input"), order).alias("a"), F.max_by(F.struct("state_us"), order).alias("z"), F.count("*").alias("n_tasks"))
    got = got.select("u", ((F.col("z.state_us") - F.col("a.state_us")) / F.lit(1e6)).alias("execution_time"), F.col("a.input").alias("input"), "n_tasks")
    ex = executions.select(F.col("workflow_id").alias("u"), "domain", "type_name", "type_version", "task_list", F.col("run_id"), F.array_join("tags", ",").alias("tag_list"))
    return ex.join(got, "u")


def find_activity(acts: DataFrame, wanted: DataFrame) -> DataFrame:
    """For each wanted (u, scheduled_id, id) the activity that has either; the last one of the execution if two do."""
    w = wanted.select("u", F.col("scheduled_id").alias("_s"), F.col("id").alias("_i"))
    hit = acts.join(w, "u").filter((F.col("scheduled_id") == F.col("_s")) | (F.col("id") == F.col("_i")))
    last = hit.groupBy("u", "_s", "_i").agg(F.max_by(F.struct("id", "scheduled_id", "last_state", "input", "result"), "first_event").alias("f"))
    return last.select("u", F.col("_s").alias("wanted_scheduled_id"), F.col("_i").alias("wanted_id"), "f.*")


def call_of(name: Column, task_id: Column, payload: Column) -> Column:
    """Struct of what a task is run with again: args, kwargs and meta of its input (JSON texts), and its context."""
    part = lambda path, empty: F.coalesce(F.get_json_object(payload, path), F.lit(empty))
    context = F.to_json(F.struct(name.alias("name"), F.lit(None).cast("string").alias("version"), task_id.cast("string").alias("activity_id"), payload.alias("input")), {"ignoreNullFields": "false"})
    return F.struct(part("$.args", "[]").alias("args"), part("$.kwargs", "{}").alias("kwargs"), part("$.meta", "{}").alias("meta"), context.alias("context"))


def dump(sections: dict[str, tuple[DataFrame, Column, list]]) -> DataFrame:
    """The sections of a cooked history as rows: u, section, key, entry (JSON of the given columns, nulls kept)."""
    out = None
    for name, (df, key, cols) in sections.items():
        got = df.select("u", F.lit(name).alias("section"), key.cast("string").alias("key"), F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}).alias("entry"))
        out = got if out is None else out.unionByName(got)
    return out


def mb_rate(n_bytes: Column, seconds: Column) -> Column:
    """MB/s with two digits, half to even; null for no time."""
    return F.when(seconds != 0, F.bround(n_bytes / 1048576 / seconds, 2))


def record_rate(records: Column, seconds: Column) -> Column:
    return F.when(seconds != 0, (records / seconds).cast("long"))


def io_stats(n_bytes: Column, records: Column, seconds: Column, sampled: Column) -> Column:
    """Struct of one direction of a step: bytes, records, their rates (null for none), sampled."""
    rate = F.when(n_bytes != 0, mb_rate(n_bytes, seconds))
    return F.struct(n_bytes.alias("bytes"), records.alias("records"), rate.alias("mb_s"), F.when(records != 0, record_rate(records, seconds)).alias("rec_s"), sampled.alias("sampled"))


def step_stats(steps: DataFrame, keys: list[str]) -> DataFrame:
    """Statistics of steps (keys, name, metadata, start_us, end_us and bytes and records read and written): one row a step."""
    seconds = (F.col("end_us") - F.col("start_us")) / F.lit(1e6)
    side = lambda x: io_stats(F.col(f"{x}_bytes"), F.col(f"{x}_records"), seconds, F.coalesce(F.col(f"{x}_sampled"), F.lit(False)))
    return steps.select(*keys, "name", "metadata", (F.col("start_us") / F.lit(1e6)).alias("time_started"), (F.col("end_us") / F.lit(1e6)).alias("time_finished"), seconds.alias("time_total"), side("read").alias("read"), side("write").alias("write"))


def metrology(entities: DataFrame, steps: DataFrame, keys: list[str]) -> DataFrame:
    """Entities with the statistics of their steps as an array in order of start (null for none)."""
    cols = ["time_started", "name", *[c for c in steps.columns if c not in (*keys, "name", "time_started")]]
    own = steps.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(*cols))).alias("metrology"))
    return entities.join(own, keys, "left")
