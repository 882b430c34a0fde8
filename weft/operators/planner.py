"""Replay and decision planning as joins, rules and running caps."""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weft.functions import codec
from weft.schemas import FUTURES, MAX_DECISIONS, MAX_REQUEST, REQUEST_MARGIN


def future_map(kind: str, state: Column) -> Column:
    """Struct (future, exception) of an entity's state; unknown states of an activity are PENDING."""
    rules = F.create_map(*itertools.chain.from_iterable((F.lit(s), F.struct(F.lit(f).cast("string").alias("future"), F.lit(x).cast("string").alias("exception"))) for s, (f, x) in FUTURES[kind].items()))
    pending = F.struct(F.lit("PENDING").alias("future"), F.lit(None).cast("string").alias("exception"))
    return F.when(F.map_contains_key(rules, F.coalesce(state, F.lit(""))), F.try_element_at(rules, state)).otherwise(pending)


def resume(plan: DataFrame, entities: DataFrame, keys: list[str], kind: str = "activity") -> DataFrame:
    """Planned tasks with the future of their entity; ``schedule`` marks those that the history lacks."""
    found = entities.select(*keys, F.col("last_state").alias("_state"), F.lit(True).alias("_found"))
    joined = plan.join(found, keys, "left").withColumn("_f", future_map(kind, F.col("_state")))
    return joined.select(*plan.columns, F.col("_state").alias("state"), F.col("_f.future").alias("future"), F.col("_f.exception").alias("exception"), (F.col("_found").isNull() | F.col("_f.future").isNull()).alias("schedule"))


def retry_decision(state: Column, retry: Column, max_retry: Column, raises: Column) -> Column:
    """What to do with a failed or timed-out task: none, reschedule, raise or keep."""
    failed = state.isin("failed", "timed_out")
    return F.when(~failed, "none").when(F.coalesce(retry, F.lit(0)) < max_retry, "reschedule").when(raises, "raise").otherwise("keep")


#: What a workflow may decide about a failed task.
FAILURE_DECISIONS = ("none", "abort", "ignore", "retry_now", "retry_later", "cancel", "handled")


def failure_outcome(decision: Column, wait: Column, retry: Column, max_retry: Column, raises: Column, timer_state: Column | None = None) -> Column:
    """Struct (action, future, delay) of a failed task, from the workflow's decision about it.

    ``action``: raise, keep (the future holds the exception), done (it doesn't), schedule (again),
    schedule_saved (with the arguments that the timer kept), start_timer, pending or timer_error. The
    state of a retry timer that was started after the failure comes first; a timer in another state
    is passed over, and so is a missing one. ``retry_later`` without a wait is ``retry_now``.
    """
    give_up = F.when(raises, "raise").otherwise("keep")
    later = (decision == "retry_later") & (F.coalesce(wait, F.lit(0)) != 0)
    default = F.when(F.coalesce(retry, F.lit(0)) >= max_retry, give_up).otherwise("schedule")
    own = F.when(decision == "abort", give_up).when(decision == "ignore", "done").when(decision == "cancel", "cancel").when(later, "start_timer").when(decision.isin("retry_now", "retry_later"), "schedule").when(decision == "handled", "keep").otherwise(default)
    action = own
    if timer_state is not None:
        action = F.when(timer_state == "started", "pending").when(timer_state.isin("fired", "canceled"), "schedule_saved").when(timer_state == "start_failed", "timer_error").otherwise(own)
    future = F.when(action.isin("keep", "done"), "FINISHED").when(action == "cancel", "CANCELLED").when(action.isin("pending", "schedule", "schedule_saved", "start_timer"), "PENDING")
    return F.struct(action.alias("action"), future.alias("future"), F.when(action == "start_timer", wait).alias("delay"))


def retry_timer(tasks: DataFrame, timers: DataFrame, task_decision: Column, timer_decision: Column) -> DataFrame:
    """Tasks (u, id, ...) with ``timer_state``: that of the retry timer of their id, if it was started in a later decision."""
    t = timers.select("u", "id", F.col("last_state").alias("_state"), timer_decision.alias("_d"))
    joined = tasks.join(t, ["u", "id"], "left")
    return joined.withColumn("timer_state", F.when(F.col("_d") > task_decision, F.col("_state"))).drop("_state", "_d")


def handle_once(failures: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Failures of a replay, each event handled the first time it is met only."""
    return suppress_repeats(failures, keys, order)


def find_signals(wanted: DataFrame, signals: DataFrame, delivered: DataFrame) -> DataFrame:
    """Wanted signals (u, name, workflow_id, run_id) with ``event_id``: received under that name, else delivered to the target.

    A signal without a target is a broadcast, which only counts if received. A target without a run
    matches any run of its workflow; the first delivery counts. The disjunction is two equi-joins.
    """
    got = signals.groupBy("u", "name").agg(F.max("event_id").alias("_received"))
    any_run = delivered.groupBy("u", "name", "workflow_id").agg(F.min("event_id").alias("_any"))
    one_run = delivered.groupBy("u", "name", "workflow_id", "run_id").agg(F.min("event_id").alias("_run"))
    out = wanted.join(got, ["u", "name"], "left").join(any_run, ["u", "name", "workflow_id"], "left").join(one_run, ["u", "name", "workflow_id", "run_id"], "left")
    return out.select(*wanted.columns, F.coalesce("_received", F.when(F.col("run_id").isNull(), F.col("_any")).otherwise(F.col("_run"))).alias("event_id"))


def sequence_numbers(df: DataFrame, execution: str, name: str, order: list[str]) -> Column:
    return F.row_number().over(Window.partitionBy(execution, name).orderBy(*order)).cast("long")


def suppress_repeats(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first submission of each idempotent task."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")


def batch_cut(df: DataFrame, execution: str, size: Column, order: list[str], most: int = MAX_DECISIONS, budget: int = MAX_REQUEST - REQUEST_MARGIN) -> DataFrame:
    """Decisions that fit one response (one place is kept for a wake-up timer); ``truncated`` marks executions that need one."""
    w = Window.partitionBy(execution).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    rows = df.withColumn("_n", F.row_number().over(Window.partitionBy(execution).orderBy(*order))).withColumn("_s", F.sum(size).over(w))
    rows = rows.withColumn("_fits", (F.col("_n") <= most - 1) & (F.col("_s") <= budget))
    rows = rows.withColumn("truncated", F.max(~F.col("_fits")).over(Window.partitionBy(execution)))
    return rows.filter("_fits").drop("_n", "_s", "_fits")


def with_wake_up(batch: DataFrame, execution: str, truncated: str = "truncated", kind: str = "decision_type") -> DataFrame:
    """(execution, decision_type, n, wake_up) of a cut batch, and a StartTimer row where the execution has to be woken.

    That is where decisions were left out, or where a marker or a timer's cancellation is among them,
    which bring about no further decision.
    """
    counts = batch.groupBy(execution, kind).agg(F.count("*").alias("n"), F.max(truncated).alias("_t"))
    silent = F.col(kind).isin("RecordMarker", "CancelTimer")
    woken = counts.groupBy(execution).agg(F.max(F.col("_t") | silent).alias("_w")).filter("_w")
    timer = woken.select(execution, F.lit("StartTimer").alias(kind), F.lit(1).cast("long").alias("n"), F.lit(True).alias("wake_up"))
    return counts.select(execution, kind, "n", F.lit(False).alias("wake_up")).unionByName(timer)


#: Decision types and the attributes of each.
DECISIONS = {
    "CompleteWorkflowExecution": ["result"],
    "CancelWorkflowExecution": ["details"],
    "FailWorkflowExecution": ["details", "reason"],
    "TerminateWorkflowExecution": ["details", "reason"],
    "ContinueAsNewWorkflowExecution": ["childPolicy", "executionStartToCloseTimeout", "input", "tagList", "taskList", "taskStartToCloseTimeout", "workflowTypeVersion"],
    "StartChildWorkflowExecution": ["childPolicy", "control", "executionStartToCloseTimeout", "input", "tagList", "taskList", "taskStartToCloseTimeout", "workflowId", "workflowType"],
    "RequestCancelExternalWorkflowExecution": ["runId", "workflowId"],
    "SignalExternalWorkflowExecution": ["control", "input", "runId", "signalName", "workflowId"],
    "ScheduleActivityTask": ["activityId", "activityType", "control", "heartbeatTimeout", "input", "scheduleToCloseTimeout", "scheduleToStartTimeout", "startToCloseTimeout", "taskList", "taskPriority"],
    "RequestCancelActivityTask": ["activityId"],
    "StartTimer": ["control", "startToFireTimeout", "timerId"],
    "CancelTimer": ["timerId"],
    "RecordMarker": ["details", "markerName"],
}


def decision(kind: str, **attributes: Column) -> Column:
    """Struct (decision_type, attrs): the attributes as compact JSON in order of their names, falsy ones left out."""
    if wrong := sorted(set(attributes) - set(DECISIONS[kind])):
        raise TypeError(f"not for {kind}: {', '.join(wrong)}")
    named = {k: F.when(F.get_json_object(F.to_json(F.struct(v.alias("v"))), "$.v.name").isNotNull(), v) if k in ("taskList", "activityType", "workflowType") else v for k, v in attributes.items()}
    return F.struct(F.lit(kind).alias("decision_type"), codec.without_falsy(**named).alias("attrs"))


def replay(plan: DataFrame, entities: DataFrame, executions: DataFrame, most: int = MAX_DECISIONS) -> DataFrame:
    """The decisions of each execution whose workflow submits the tasks of ``plan`` together: u, seq, decision_type, attrs.

    ``plan``: (u, id, pos, name, max_retry, raises); ``entities``: the activity fold; ``executions``:
    (u, cancel, fail_at, fail_reason, error). In this order: an error of the workflow's own code fails
    the execution; a cancel request cancels it; the first task by pos that gives up, and raises, fails
    it; it fails itself when it comes to ``fail_at``, after the decisions so far; it completes with
    the results in order once all tasks are done; else tasks without a future are scheduled, at most
    ``most`` - 1, with a timer that wakes the execution if there are more.
    """
    found = entities.select("u", "id", "last_state", "retry", "result", "reason")
    rows = executions.join(plan, "u", "left").join(found, ["u", "id"], "left")
    # What comes at or after fail_at is never submitted.
    mine = F.col("id").isNotNull() & (F.col("fail_at").isNull() | (F.col("pos") < F.col("fail_at")))
    state, failed = F.col("last_state"), F.coalesce(F.col("last_state").isin("failed", "timed_out"), F.lit(False))
    again = failed & (F.coalesce("retry", F.lit(0)) < F.col("max_retry"))
    outcome = F.when(state.isNull() | (state == "schedule_failed") | again, "schedule").when(failed & F.col("raises"), "error").when(failed | state.isin("completed", "canceled"), "done").otherwise("pending")
    rows = rows.withColumn("outcome", F.when(mine, outcome))
    problem = F.when(state == "failed", F.coalesce("reason", F.lit(""))).otherwise("TimeoutError()")
    text = F.concat(F.lit("Workflow execution error in "), F.col("name"), F.lit(': "'), problem, F.lit('"'))
    # All of an execution is settled in windows over its rows: one shuffle beside the joins.
    whole, so_far = Window.partitionBy("u"), Window.partitionBy("u").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    todo = F.when(F.col("outcome") == "schedule", 1).otherwise(0)
    result = F.struct("pos", F.when(state == "completed", F.col("result")).alias("r"))
    rows = rows.withColumn("raised", F.min_by(text, F.when(F.col("outcome") == "error", F.col("pos"))).over(whole)).withColumn("all_done", F.coalesce(F.bool_and(F.col("outcome") == "done").over(whole), F.lit(True)))
    rows = rows.withColumn("n", F.sum(todo).over(whole)).withColumn("seq", F.sum(todo).over(so_far)).withColumn("first", F.row_number().over(Window.partitionBy("u").orderBy("pos")) == 1)
    rows = rows.withColumn("results", F.array_sort(F.collect_list(F.when(F.col("outcome").isNotNull(), result)).over(whole)))
    # With all reasons to end in order, the first that holds is the only decision, but for its own failure.
    end = F.when(F.col("error").isNotNull(), decision("FailWorkflowExecution", reason=F.concat(F.lit("Cannot replay the workflow: "), F.col("error"))))
    end = end.when(F.col("cancel"), F.struct(F.lit("CancelWorkflowExecution").alias("decision_type"), F.lit("{}").alias("attrs")))
    end = end.when(F.col("raised").isNotNull(), decision("FailWorkflowExecution", reason=F.col("raised")))
    own = decision("FailWorkflowExecution", reason=F.concat(F.lit("Workflow execution failed: "), F.col("fail_reason")))
    end = end.when(F.col("fail_at").isNotNull(), own).when(F.col("all_done"), decision("CompleteWorkflowExecution", result=F.to_json(F.transform("results", lambda x: x["r"]))))
    alone = F.col("error").isNotNull() | F.coalesce("cancel", F.lit(False)) | F.col("raised").isNotNull()
    rows = rows.withColumn("end", end).withColumn("goes_on", ~alone & (F.col("end").isNull() | F.col("fail_at").isNotNull()))
    at = lambda seq, what: F.struct(seq.cast("long").alias("seq"), what["decision_type"].alias("decision_type"), what["attrs"].alias("attrs"))
    start = decision("ScheduleActivityTask", activityId=F.concat("name", F.lit("-"), F.col("id")))
    wake = decision("StartTimer", timerId=F.lit("wake-up"), startToFireTimeout=F.lit("0.0"))
    made = [
        F.when(F.col("goes_on") & (F.col("outcome") == "schedule") & (F.col("seq") < most), at(F.col("seq"), start)),
        F.when(F.col("first") & F.col("end").isNotNull(), at(F.when(F.col("goes_on"), F.least("n", F.lit(most - 1)) + 1).otherwise(1), F.col("end"))),
        F.when(F.col("first") & F.col("goes_on") & F.col("end").isNull() & (F.col("n") >= most - 1), at(F.lit(most), wake)),
    ]
    return rows.select("u", F.explode(F.array_compact(F.array(*made))).alias("d")).select("u", "d.seq", "d.decision_type", "d.attrs")


def run_context(executions: DataFrame) -> Column:
    """Struct of what a workflow may know of its execution; tags are never null."""
    own = [F.col("type_name").alias("name"), F.col("type_version").alias("version"), F.col("domain").alias("domain_name"), "workflow_id", "run_id", F.coalesce("tags", F.array().cast("array<string>")).alias("tag_list"), "continued_execution_run_id", "parent_workflow_id", "parent_run_id"]
    return F.struct(*own)


def activity_context(name: Column, version: Column, workflow_id: Column, run_id: Column, activity_id: Column, payload: Column) -> Column:
    """Struct of what an activity may know of its task."""
    return F.struct(name.alias("name"), version.alias("version"), workflow_id.alias("workflow_id"), run_id.alias("run_id"), activity_id.alias("activity_id"), payload.alias("input"))


def contexts(entries: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Execution contexts from entries (keys, key, kind, value) in order: the last plain value, all of a list, the distinct ones of a set, sorted."""
    items = F.transform(F.array_sort(F.collect_list(F.struct(order, "value"))), lambda x: x["value"])
    got = entries.groupBy(*keys, "key", "kind").agg(items.alias("items"))
    value = F.when(F.col("kind") == "plain", F.slice("items", -1, 1)).when(F.col("kind") == "set", F.array_sort(F.array_distinct("items"))).otherwise(F.col("items"))
    return got.select(*keys, "key", "kind", value.alias("value"))


def task_input(args: Column, kwargs: Column, raw: Column) -> Column:
    """The input that a task is scheduled with: its arguments as JSON, or the raw value if it has one."""
    call = F.concat(F.lit('{"args":'), args, F.lit(',"kwargs":'), kwargs, F.lit("}"))
    return F.coalesce(raw, call)


def priority(submit_set: Column, submit: Column, activity_set: Column, activity: Column, workflow: Column) -> Column:
    """The first that is set wins, even if it is set to null: submission, activity, workflow."""
    return F.when(submit_set, submit).when(activity_set, activity).otherwise(workflow)


def repair(previous: DataFrame, current: DataFrame, keys: list[str], forced: Column) -> DataFrame:
    """What a repaired run does with each task of the previous one: live (is in the current run), reuse (completed before, not forced), run."""
    now = current.select(*keys, F.col("last_state").alias("_now"))
    action = F.when(F.col("_now").isNotNull(), "live").when((F.col("last_state") == "completed") & ~forced, "reuse").otherwise("run")
    return previous.join(now, keys, "left").withColumn("action", action).drop("_now")


def propagate(known: DataFrame, signalled: DataFrame, senders: DataFrame, keys: list[str]) -> DataFrame:
    """Known targets that have neither had the signal nor sent it."""
    return known.join(signalled, keys, "left_anti").join(senders, keys, "left_anti")


def unknown_types(used: DataFrame, registry: DataFrame, keys: list[str]) -> DataFrame:
    """Types that are used and not registered, each once: those to create."""
    return used.select(*keys).distinct().join(registry.select(*keys).distinct(), keys, "left_anti")


def fixed(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    return F.broadcast(spark.createDataFrame(rows, schema))


def future_columns(state: Column, value: Column, failed: Column) -> list[Column]:
    """done, cancel (whether a cancellation takes), after_cancel and result of futures as columns."""
    finished = state == "FINISHED"
    return [state.isin("FINISHED", "CANCELLED").alias("done"), (~finished).alias("cancel"), F.when(finished, state).otherwise("CANCELLED").alias("after_cancel"), F.when(finished & ~failed, value).alias("result")]


def mark_done(steps: DataFrame, name: str, folder: str) -> None:
    """Add steps to the table of those that are done; marking one again changes nothing for readers."""
    steps.select(F.col(name).cast("string").alias("step")).distinct().write.mode("append").parquet(folder)


def steps_done(spark: SparkSession, folder: str, prefix: str = "") -> DataFrame:
    """The steps that are done, under a prefix."""
    return spark.read.parquet(folder).filter(F.startswith("step", F.lit(prefix))).distinct()


def group_verdict(members: DataFrame, key: str, expected: Column | None = None) -> DataFrame:
    """State of each group: finished only if all are, else cancelled, else running if any is, else pending."""
    state = F.col("state")
    want = expected if expected is not None else F.count("*")
    done = (F.count_if(state == "FINISHED") == F.count("*")) & (F.count("*") == want)
    verdict = F.when(done, "FINISHED").when(F.count_if(state == "CANCELLED") > 0, "CANCELLED").when(F.count_if(state == "RUNNING") > 0, "RUNNING").otherwise("PENDING")
    return members.groupBy(key).agg(verdict.alias("verdict"), F.count_if(state == "FINISHED").alias("finished"), F.count_if(state.isin("PENDING", "RUNNING")).alias("active"), F.count("*").alias("n"))


def group_results(members: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Results in order (null unless finished) as JSON text, and whether any member failed."""
    value = F.when(F.col("state") == "FINISHED", F.col("result"))
    items = F.array_sort(F.collect_list(F.struct(*order, value.alias("_v"))))
    return members.groupBy(key).agg(F.to_json(F.transform(items, lambda x: x["_v"])).alias("results"), F.max("failed").alias("any_failed"))


def chain_prefix(steps: DataFrame, key: str, pos: str, stop: Column) -> DataFrame:
    """Steps up to and including the first at which the chain stops."""
    at = F.min(F.when(stop, F.col(pos))).over(Window.partitionBy(key))
    return steps.withColumn("stop_at", at).filter(F.col("stop_at").isNull() | (F.col(pos) <= F.col("stop_at")))


def step_runs(steps: DataFrame, patterns: DataFrame, done: DataFrame, name: str, sep: str = ".") -> DataFrame:
    """Whether each step runs, and why: forced beats skipped beats done.

    ``patterns`` (pattern, action, reason) is matched by level: a step's own name, its dotted
    prefixes and ``*`` are looked up, so no comparison of all pairs is made.
    """
    names = steps.select(name).distinct()
    parts = F.split(F.col(name), "\\Q" + sep + "\\E")
    prefixes = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, 1, i), sep))
    levels = names.select(name, F.explode(F.array_distinct(F.concat(F.array(F.lit("*")), prefixes))).alias("pattern"))
    hits = levels.join(patterns, "pattern").groupBy(name).agg(F.max(F.col("action") == "force").alias("forced"), F.max(F.col("action") == "skip").alias("skipped"), F.array_join(F.array_sort(F.collect_set("reason")), ",").alias("reasons"))
    out = names.join(hits, name, "left").join(done.select(F.col(name), F.lit(True).alias("_done")).distinct(), name, "left")
    runs = F.when(F.coalesce("forced", F.lit(False)), True).when(F.coalesce("skipped", F.lit(False)), False).otherwise(F.col("_done").isNull())
    return out.select(name, F.coalesce("forced", F.lit(False)).alias("forced"), F.coalesce("skipped", F.lit(False)).alias("skipped"), F.col("_done").isNotNull().alias("done"), runs.alias("runs"), F.coalesce("reasons", F.lit("")).alias("reasons"))
