"""Event log to entity state.

Every output column holds the value of the latest event among the states that write it, so one
aggregate with ``max_by`` per state gives what a forward pass over a history would. Partial
aggregates work, and a single shuffle on (execution, entity) serves all columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FAILURES = ("failed", "timed_out")


def at_state(value: str, states: str | tuple[str, ...], order: str = "e") -> Column:
    """The value at the latest event in one of the states; a null value there stays null."""
    held = F.col("st").isin(*([states] if isinstance(states, str) else states))
    return F.max_by(F.struct(F.col(value).alias("v")), F.when(held, F.col(order)))["v"]


def retries() -> Column:
    """Failures and time-outs less one; null without any."""
    return (F.nullif(F.sum(F.when(F.col("st").isin(*FAILURES), 1).otherwise(0)), F.lit(0)) - 1).cast("long")


def fold(log: DataFrame, keys: list[str], times: dict[str, str], values: dict[str, tuple], retry: bool = True) -> DataFrame:
    """State per entity: ``last_state``, first event, a time per state, and named values of states.

    ``times``: output column to state; ``values``: output column to (state or states, input column).
    """
    out = [F.max_by("st", "e").alias("last_state"), F.min("e").alias("first_event"), F.max("e").alias("last_event")]
    out += [at_state("us", state).alias(c) for c, state in times.items()]
    out += [at_state(source, state).alias(c) for c, (state, source) in values.items()]
    return log.groupBy(*keys).agg(*out, *([retries().alias("retry")] if retry else []))


#: Columns of the folds: the time of each state, and values at the latest event of one or more states.
ACTIVITY_TIMES = {f"{s}_us": s for s in ("scheduled", "schedule_failed", "started", "completed", "failed", "timed_out", "canceled", "cancel_requested")}
ACTIVITY_VALUES = {"scheduled_id": ("scheduled", "e"), "input": ("scheduled", "props"), "cause": ("schedule_failed", "props"), "started_id": ("started", "e"), "completed_id": ("completed", "e"), "result": ("completed", "props"), "failed_id": ("failed", "e"), "reason": ("failed", "props"), "details": (("failed", "canceled"), "props"), "timed_out_id": ("timed_out", "e"), "timeout_value": ("timed_out", "value"), "cancel_decision_id": ("cancel_requested", "e")}
CHILD_TIMES = {"initiated_us": "start_initiated"} | {f"{s}_us": s for s in ("start_failed", "started", "completed", "failed", "timed_out", "canceled", "terminated")}
CHILD_VALUES = {"initiated_id": ("start_initiated", "e"), "input": ("start_initiated", "props"), "cause": ("start_failed", "props"), "decision_id": (("start_initiated", "start_failed"), "e"), "started_id": ("started", "e"), "result": ("completed", "props"), "reason": ("failed", "props"), "details": (("failed", "canceled"), "props"), "timeout_value": ("timed_out", "value"), "terminated_id": ("terminated", "e")}
WORKFLOW_TIMES = {f"{s}_us": s for s in ("started", "continued_as_new", "completed", "canceled", "failed", "terminated", "timed_out")}
WORKFLOW_VALUES = {"started_id": ("started", "e"), "input": (("started", "continued_as_new"), "props"), "new_execution_run_id": ("continued_as_new", "k"), "result": ("completed", "props"), "reason": ("failed", "props"), "details": (("canceled", "failed", "terminated"), "props"), "cause": ("terminated", "value"), "timeout_type": ("timed_out", "k")}
TIMER_STATES = ("fired", "canceled", "start_failed", "cancel_failed")


def activities(log: DataFrame) -> DataFrame:
    return fold(log, ["u", "id"], ACTIVITY_TIMES, ACTIVITY_VALUES)


def children(log: DataFrame) -> DataFrame:
    return fold(log, ["u", "id"], CHILD_TIMES, CHILD_VALUES)


def workflows(log: DataFrame) -> DataFrame:
    """The execution itself: signals and cancel requests are kept apart (:func:`notices`)."""
    return fold(log.filter(F.col("st").isin(*WORKFLOW_TIMES.values())), ["u"], WORKFLOW_TIMES, WORKFLOW_VALUES, retry=False)


def notices(log: DataFrame) -> DataFrame:
    """The latest cancel request and the latest failure to cancel of each execution."""
    last = lambda s: F.max_by(F.struct("e", "us", "props"), F.when(F.col("st") == s, F.col("e")))
    got = log.filter(F.col("st").isin("cancel_requested", "cancel_failed")).groupBy("u").agg(last("cancel_requested").alias("r"), last("cancel_failed").alias("f"))
    return got.select("u", F.col("r.e").alias("cancel_requested_id"), F.col("r.us").alias("cancel_requested_us"), F.col("r.props").alias("cancel_requested_cause"), F.col("f.e").alias("cancel_failed_id"), F.col("f.us").alias("cancel_failed_us"), F.col("f.props").alias("cancel_failed_cause"))


def timers(log: DataFrame) -> DataFrame:
    """Timers by id; a start forgets what became of the timer before."""
    started = F.max(F.when(F.col("st") == "started", F.col("e")))
    since = lambda state, value: F.when(F.coalesce(F.max(F.when(F.col("st") == state, F.col("e"))) > started, F.lit(True)), at_state(value, state))
    cols = [F.max_by("st", "e").alias("last_state"), F.min("e").alias("first_event"), F.max("e").alias("last_event"), at_state("us", "started").alias("started_us"), at_state("e", "started").alias("started_id"), at_state("props", "started").alias("control")]
    cols += [since(s, "us").alias(f"{s}_us") for s in TIMER_STATES] + [since(s, "e").alias(f"{s}_id") for s in TIMER_STATES] + [since("start_failed", "props").alias("cause")]
    return log.groupBy("u", "id").agg(*cols)


def externals(log: DataFrame, prefix: str = "signal") -> DataFrame:
    """Signals sent outside, or cancel requests, by entity; keyed by what initiated them."""
    states = {"signal": ("signal_execution_initiated", "execution_signaled", "signal_execution_failed"), "cancel": ("request_cancel_execution_initiated", "execution_cancel_requested", "request_cancel_execution_failed")}[prefix]
    keys = ["u", "origin"] if prefix == "signal" else ["u", "id"]
    return fold(log, keys, dict(zip(("initiated_us", "delivered_us", "failed_us"), states, strict=True)), {"control": (states[0], "props"), "cause": (states[2], "props")}, retry=False)


def signals_latest(log: DataFrame) -> DataFrame:
    return log.groupBy("u", F.col("et").alias("name")).agg(F.max_by(F.struct("e", "us", "props"), "e").alias("s")).select("u", "name", F.col("s.e").alias("event_id"), F.col("s.us").alias("us"), F.col("s.props").alias("input"))


def signal_lists(log: DataFrame) -> DataFrame:
    """All signals of a name in order, as one text of event ids and inputs."""
    items = F.transform(F.array_sort(F.collect_list(F.struct("e", "props"))), lambda x: F.concat(x["e"].cast("string"), F.lit("="), x["props"]))
    return log.groupBy("u", F.col("et").alias("name")).agg(F.count("*").alias("n"), F.array_join(items, ";").alias("signals"))


def markers(log: DataFrame, drop_failed: bool = True) -> DataFrame:
    """The last marker of each name; by default a name whose last marker failed is left out."""
    last = log.groupBy("u", "name").agg(F.max_by(F.struct("st", "props", "e"), "e").alias("m"), F.count("*").alias("n"))
    out = last.select("u", "name", "n", F.col("m.st").alias("st"), F.col("m.props").alias("details"), F.col("m.e").alias("event_id"))
    return out.filter("st = 'recorded'") if drop_failed else out


def decision_cursor(log: DataFrame) -> DataFrame:
    latest_of = lambda s: F.max(F.when(F.col("et") == s, F.col("e")))
    return log.groupBy("u").agg(latest_of("view").alias("started_decision_id"), latest_of("purchase").alias("completed_decision_id"), F.max("e").alias("last_event_id"))


def task_order(acts: DataFrame, kids: DataFrame, signals: DataFrame) -> DataFrame:
    """Activities and children at first sight and every signal, numbered in order of appearance."""
    all_ = acts.select("u", F.lit("activity").alias("kind"), F.col("id").cast("string").alias("name"), F.col("first_event").alias("first_at")).unionByName(kids.select("u", F.lit("child_workflow").alias("kind"), F.col("id").cast("string").alias("name"), F.col("first_event").alias("first_at"))).unionByName(signals.select("u", F.lit("signal").alias("kind"), F.col("et").alias("name"), F.col("e").alias("first_at")))
    w = Window.partitionBy("u").orderBy("first_at", "kind", "name")
    return all_.withColumn("pos", F.row_number().over(w).cast("long"))


def decision_before(log: DataFrame, moments: DataFrame) -> DataFrame:
    """Each moment (u, e) with the last completed decision before it, of a log (u, e, done); one ordered pass over both."""
    both = log.filter("done").select("u", "e", F.col("e").alias("d")).unionByName(moments.select("u", "e", F.lit(None).cast("long").alias("d")))
    earlier = Window.partitionBy("u").orderBy("e", F.col("d").isNotNull()).rowsBetween(Window.unboundedPreceding, -1)
    return both.withColumn("decision_id", F.last("d", ignorenulls=True).over(earlier)).filter("d is null").drop("d")


def total_time(log: DataFrame) -> DataFrame:
    """Seconds from the first event's time to the last's, by position."""
    return log.groupBy("u").agg(((F.max_by("us", "e") - F.min_by("us", "e")) / F.lit(1e6)).alias("total_time"))
