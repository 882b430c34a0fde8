"""Replay and decision planning queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from weft.functions import codec
from weft.operators import fold, planner
from weft.queries import query
from weft.functions import names
from weft.plans.tasks import TIMEOUTS
from weft.queries.history import EXT_FOLD, FOLD, KID_FOLD, MARK, TM_FOLD, WF_LOG, activity_fold, child_workflow_fold, external_signal_fold, marker_log, timers_fold, workflow_notices
from weft.schemas import FUTURES
from weft.sources import adapter as A


def future_sql(kind, col):
    out = f"case {col} " + " ".join(f"when '{s}' then " + (f"'{f}'" if f else "null") for s, (f, _) in FUTURES[kind].items()) + " else 'PENDING' end"
    err = f"case {col} " + " ".join(f"when '{s}' then " + (f"'{x}'" if x else "null") for s, (_, x) in FUTURES[kind].items()) + " end"
    return out, err


KINDS = (("activity", "fold", "cast(id as varchar)", "last_state"), ("child", "kf", "cast(id as varchar)", "last_state"), ("marker", "mk", "name || '@' || e", "st"), ("signal", "(select distinct u, et from ev)", "et", "'signaled'"), ("external", "xf", "cast(origin as varchar)", "last_state"), ("timer", "tf", "cast(id as varchar)", "last_state"))


@query(f"""with {FOLD}, {KID_FOLD}, {EXT_FOLD}, {TM_FOLD}, {MARK[len(A.EV) + 2:]} """ + " union all ".join(f"select '{k}' as kind, u, {key} as name, {st} as last_state, {future_sql(k, st)[0]} as future, {future_sql(k, st)[1]} as exception from {t}" for k, t, key, st in KINDS))
def future_mapping(spark, sf):
    """The future of every entity, of all six kinds."""
    text = lambda c: F.col(c).cast("string").alias("name")
    marks = marker_log(spark, sf).select("u", F.concat("name", F.lit("@"), "e").alias("name"), F.col("st").alias("last_state"))
    signals = A.events(spark, sf).select("u", F.col("et").alias("name")).distinct().withColumn("last_state", F.lit("signaled"))
    tables = {"activity": activity_fold(spark, sf).select("u", text("id"), "last_state"), "child": child_workflow_fold(spark, sf).select("u", text("id"), "last_state"), "marker": marks, "signal": signals, "external": external_signal_fold(spark, sf).select("u", text("origin"), "last_state"), "timer": timers_fold(spark, sf).select("u", text("id"), "last_state")}
    out = None
    for kind, df in tables.items():
        f = planner.future_map(kind, F.col("last_state"))
        got = df.select(F.lit(kind).alias("kind"), "u", "name", "last_state", f["future"].alias("future"), f["exception"].alias("exception"))
        out = got if out is None else out.unionByName(got)
    return out


def plan(spark, sf):
    """Each execution wants activities 0 to 7; the history knows 0 to 4 at most."""
    users = A.events(spark, sf).select("u").distinct()
    return users.select("u", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(7).cast("long"))).alias("id"))


@query(f"""with {FOLD}, p as (select u, unnest(range(0, 8)) as id from (select distinct u from ev))
select p.u, p.id, last_state as state, {future_sql('activity', "coalesce(last_state, '')")[0]} as future, {future_sql('activity', "coalesce(last_state, '')")[1]} as exception, last_state is null or last_state = 'schedule_failed' as schedule
from p left join fold using (u, id)""")
def resume_plan(spark, sf):
    return planner.resume(plan(spark, sf), activity_fold(spark, sf), ["u", "id"])


@query(f"""with {FOLD} select u, id, last_state, retry, case when last_state not in ('failed', 'timed_out') then 'none' when coalesce(retry, 0) < id then 'reschedule' when id % 2 = 0 then 'raise' else 'keep' end as decision from fold""")
def retry_decision(spark, sf):
    return activity_fold(spark, sf).select("u", "id", "last_state", "retry", planner.retry_decision(F.col("last_state"), F.col("retry"), F.col("id"), F.col("id") % 2 == 0).alias("decision"))


#: What the queries' workflow decides about failures: by state, retries and the number in the reason.
RULE = """case when last_state = 'timed_out' and coalesce(retry, 0) < 3 then 'retry_later' when last_state = 'timed_out' then 'abort'
  when mod(coalesce(cast({k} as bigint), 0), 7) = 0 then 'retry_now' when id = 4 then 'cancel' when id = 3 then 'ignore' when id = 2 then 'handled' else 'none' end"""
WAIT = "case when last_state = 'timed_out' and coalesce(retry, 0) < 3 then cast(power(2, coalesce(retry, 0)) as bigint) * (id % 3) end"


def outcome_sql(timer="null"):
    raises, up = "id % 2 = 0", "case when id % 2 = 0 then 'raise' else 'keep' end"
    return f"""case when {timer} = 'started' then 'pending' when {timer} in ('fired', 'canceled') then 'schedule_saved' when {timer} = 'start_failed' then 'timer_error'
    when rule = 'abort' then {up} when rule = 'ignore' then 'done' when rule = 'cancel' then 'cancel' when rule = 'retry_later' and coalesce(wait, 0) <> 0 then 'start_timer'
    when rule in ('retry_now', 'retry_later') then 'schedule' when rule = 'handled' then 'keep' when coalesce(retry, 0) >= id then {up} else 'schedule' end"""


FAILED = f"""{FOLD}, fl as (select *, {RULE.format(k="json_extract_string(reason, '$.k')")} as rule, {WAIT} as wait from fold where last_state in ('failed', 'timed_out'))"""


def failed_tasks(spark, sf):
    rows = activity_fold(spark, sf).filter("last_state in ('failed', 'timed_out')")
    return rows.withColumn("rule", F.expr(RULE.format(k="get_json_object(reason, '$.k')"))).withColumn("wait", F.expr(WAIT))


FUTURE_OF = "case when action in ('keep', 'done') then 'FINISHED' when action = 'cancel' then 'CANCELLED' when action in ('pending', 'schedule', 'schedule_saved', 'start_timer') then 'PENDING' end"


@query(f"with {FAILED}, o as (select *, {outcome_sql()} as action from fl) select u, id, rule, action, {FUTURE_OF} as future, case when action = 'start_timer' then wait end as delay from o")
def failure_rules(spark, sf):
    o = planner.failure_outcome(F.col("rule"), F.col("wait"), F.col("retry"), F.col("id"), F.col("id") % 2 == 0)
    return failed_tasks(spark, sf).select("u", "id", "rule", o.alias("o")).select("u", "id", "rule", "o.*")


@query(f"""with {FAILED}, {TM_FOLD}, j as (select fl.*, case when tf.started_id > fl.scheduled_id then tf.last_state end as timer_state from fl left join tf on fl.u = tf.u and fl.id = tf.id),
o as (select *, {outcome_sql('timer_state')} as action from j) select u, id, timer_state, action, {FUTURE_OF} as future from o""")
def retry_timer_states(spark, sf):
    rows = planner.retry_timer(failed_tasks(spark, sf), timers_fold(spark, sf), F.col("scheduled_id"), F.col("started_id"))
    o = planner.failure_outcome(F.col("rule"), F.col("wait"), F.col("retry"), F.col("id"), F.col("id") % 2 == 0, F.col("timer_state"))
    return rows.select("u", "id", "timer_state", o.alias("o")).select("u", "id", "timer_state", "o.action", "o.future")


@query(f"with {FAILED} select u, id, coalesce(failed_id, timed_out_id) as event_id, 1 as attempt from fl")
def failure_once(spark, sf):
    """A replay may come to a failure several times; it is handled the first time."""
    met = failed_tasks(spark, sf).select("u", "id", names.first_id(F.col("failed_id"), F.col("timed_out_id")).alias("event_id"), F.explode(F.sequence(F.lit(1), F.lit(3))).alias("attempt"))
    return planner.handle_once(met, ["u", "event_id"], ["attempt"])


@query(f"""with {A.EV}, {EXT_FOLD}, w as (select distinct u, 'n' || k % 4 as name, case when k % 3 <> 0 then k % 6 end as workflow_id, case when k % 5 <> 0 then k % 2 end as run_id from ev),
s as (select u, 'n' || k % 4 as name, max(e) as e from ev where et = 'click' and k % 4 = 1 group by all),
d as (select u, 'n' || origin % 4 as name, origin % 6 as workflow_id, origin % 2 as run_id, origin as e from xf where last_state = 'execution_signaled')
select w.u, w.name, w.workflow_id, w.run_id, coalesce(max(s.e), min(d.e)) as event_id from w left join s on w.u = s.u and w.name = s.name
  left join d on w.u = d.u and w.name = d.name and w.workflow_id = d.workflow_id and (w.run_id is null or w.run_id = d.run_id) group by w.u, w.name, w.workflow_id, w.run_id""")
def signal_delivery(spark, sf):
    log, k = A.events(spark, sf), F.col("k")
    name = lambda x: F.concat(F.lit("n"), x % 4)
    wanted = log.select("u", name(k).alias("name"), F.when(k % 3 != 0, k % 6).alias("workflow_id"), F.when(k % 5 != 0, k % 2).alias("run_id")).distinct()
    signals = log.filter("et = 'click' and k % 4 = 1").select("u", name(k).alias("name"), F.col("e").alias("event_id"))
    o = F.col("origin")
    delivered = external_signal_fold(spark, sf).filter("last_state = 'execution_signaled'").select("u", name(o).alias("name"), (o % 6).alias("workflow_id"), (o % 2).alias("run_id"), o.alias("event_id"))
    return planner.find_signals(wanted, signals, delivered)


@query(f"with {A.EV} select u, e, et || '-' || row_number() over (partition by u, et order by e) as task_id from ev")
def task_sequence(spark, sf):
    log = A.events(spark, sf)
    return log.select("u", "e", F.concat("et", F.lit("-"), planner.sequence_numbers(log, "u", "et", ["e"]).cast("string")).alias("task_id"))


@query(f"with {A.EV} select u, et, k, e from (select *, row_number() over (partition by u, et, k order by e) as r from ev) where r = 1")
def idempotent_first(spark, sf):
    return planner.suppress_repeats(A.events(spark, sf), ["u", "et", "k"], ["e"]).select("u", "et", "k", "e")


@query("""with d as (select l_suppkey as x, l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice, length(l_returnflag || l_linestatus) + 700 as size from lineitem),
r as (select *, row_number() over w as n, sum(size) over (w rows unbounded preceding) as s from d window w as (partition by x order by l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice)),
f as (select *, n <= 99 and s <= 60000 as fits from r), t as (select *, bool_or(not fits) over (partition by x) as truncated from f)
select x, l_orderkey, l_linenumber, l_partkey, l_quantity, truncated from t where fits""")
def decision_batch_cut(spark, sf):
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice"]
    rows = A.table(spark, sf, "lineitem").withColumnRenamed("l_suppkey", "x")
    size = F.length(F.concat("l_returnflag", "l_linestatus")) + 700
    return planner.batch_cut(rows, "x", size, order, budget=60000).select("x", *order[:4], "truncated")


KIND_OF = "case when l_linenumber = 7 then 'RecordMarker' when l_linenumber = 6 and l_partkey % 2 = 0 then 'CancelTimer' else 'ScheduleActivityTask' end"


@query(f"""with d as (select l_suppkey as x, l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice, {KIND_OF} as decision_type from lineitem where l_linenumber <> 7 or l_suppkey % 3 = 0),
r as (select *, row_number() over w as n, sum(700) over (w rows unbounded preceding) as s from d window w as (partition by x order by l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice)),
f as (select *, n <= 99 and s <= 60000 as fits from r), t as (select *, bool_or(not fits) over (partition by x) as truncated from f),
c as (select x, decision_type, count(*) as n, bool_or(truncated) as t from t where fits group by x, decision_type)
select x, decision_type, n, false as wake_up from c union all select x, 'StartTimer', 1, true from c group by x having bool_or(t or decision_type in ('RecordMarker', 'CancelTimer'))""")
def wake_up_timer(spark, sf):
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice"]
    rows = A.table(spark, sf, "lineitem").filter("l_linenumber <> 7 or l_suppkey % 3 = 0").withColumnRenamed("l_suppkey", "x").withColumn("decision_type", F.expr(KIND_OF))
    return planner.with_wake_up(planner.batch_cut(rows, "x", F.lit(700), order, budget=60000), "x")


#: Builders of each decision type, as expressions that both engines read; a falsy value is left out.
BUILDERS = [
    ("CompleteWorkflowExecution", {"result": "props"}),
    ("CancelWorkflowExecution", {"details": "et"}),
    ("FailWorkflowExecution", {"details": "props", "reason": "concat('no ', et)"}),
    ("TerminateWorkflowExecution", {"details": "case when k > 50 then et end", "reason": "''"}),
    ("ContinueAsNewWorkflowExecution", {"childPolicy": "'TERMINATE'", "input": "props", "workflowTypeVersion": "concat('', k)"}),
    ("StartChildWorkflowExecution", {"control": "case when k > 50 then et end", "input": "props", "workflowId": "concat('w-', k)"}),
    ("RequestCancelExternalWorkflowExecution", {"runId": "case when k > 50 then concat('r', k) end", "workflowId": "concat('w-', k)"}),
    ("SignalExternalWorkflowExecution", {"control": "''", "input": "props", "signalName": "et", "workflowId": "concat('w-', k)"}),
    ("ScheduleActivityTask", {"activityId": "concat('a-', k)", "heartbeatTimeout": "'300'", "input": "props", "taskPriority": "concat('', k)"}),
    ("RequestCancelActivityTask", {"activityId": "concat('a-', k)"}),
    ("StartTimer", {"control": "case when k > 50 then props end", "startToFireTimeout": "concat('', k)", "timerId": "concat('t-', k)"}),
    ("CancelTimer", {"timerId": "concat('t-', k)"}),
    ("RecordMarker", {"details": "props", "markerName": "et"}),
]


def attrs_sql(fields):
    parts = ", ".join(f"""case when coalesce({v}, '') not in ('', '0') then '"{n}":' || to_json({v}) end""" for n, v in sorted(fields.items()))
    return "'{' || concat_ws(',', " + parts + ") || '}'"


@query(f"with {A.EV} select u, e, ({[k for k, _ in BUILDERS]})[k % 13 + 1] as decision_type, case k % 13 " + " ".join(f"when {i} then {attrs_sql(f)}" for i, (_, f) in enumerate(BUILDERS)) + " end as attrs from ev")
def decision_builders(spark, sf):
    out = None
    for i, (kind, fields) in enumerate(BUILDERS):
        d = planner.decision(kind, **{n: F.expr(v) for n, v in fields.items()})
        out = F.when(F.col("k") % 13 == i, d) if out is None else out.when(F.col("k") % 13 == i, d)
    return A.events(spark, sf).select("u", "e", out.alias("d")).select("u", "e", "d.*")


@query(f"""with {FOLD}, {WF_LOG}, p as (select u, unnest(range(0, 8)) as id from (select distinct u from ev)),
n as (select u, max(e) filter (where st = 'cancel_requested') as cancel_id from wfl where st in ('cancel_requested', 'cancel_failed') group by u),
x as (select u, coalesce(cancel_id, 0) % 3 = 1 as cancel, case when u % 11 = 0 then 3 end as fail_at, case when u % 13 = 0 then 'ValueError(no)' end as error from (select distinct u from ev) left join n using (u)),
r as (select p.u, p.id, last_state, retry, result, reason, x.* exclude (u), case when last_state is null or last_state = 'schedule_failed' or (last_state in ('failed', 'timed_out') and coalesce(retry, 0) < p.id % 3) then 'schedule'
  when last_state in ('failed', 'timed_out') and p.id = 4 and p.u % 5 = 0 then 'error' when last_state in ('failed', 'timed_out', 'completed', 'canceled') then 'done' else 'pending' end as outcome
  from p left join fold using (u, id) join x on p.u = x.u where fail_at is null or p.id < fail_at),
g as (select u, arg_min('Workflow execution error in activity: "' || case when last_state = 'failed' then coalesce(reason, '') else 'TimeoutError()' end || '"', id) filter (where outcome = 'error') as raised,
  bool_and(outcome = 'done') as all_done, count(*) filter (where outcome = 'schedule') as n, '[' || string_agg(case when last_state = 'completed' then to_json(result) else 'null' end, ',' order by id) || ']' as results from r group by u),
e as (select x.*, g.* exclude (u), case when error is not null then 'F' when cancel then 'C' when raised is not null then 'F' when fail_at is not null then 'F' when all_done then 'D' end as how,
  case when error is not null then 'Cannot replay the workflow: ' || error when cancel then null when raised is not null then raised when fail_at is not null then 'Workflow execution failed: explicit' end as why,
  error is null and not cancel and raised is null and (fail_at is not null or not all_done) as goes_on from x left join g using (u)),
s as (select r.u, r.id, row_number() over (partition by r.u order by r.id) as seq from r join e on r.u = e.u and e.goes_on where outcome = 'schedule')
select u, seq, 'ScheduleActivityTask' as decision_type, '{{"activityId":"activity-' || id || '"}}' as attrs from s where seq < 6
union all select u, case when goes_on then least(n, 5) + 1 else 1 end, case how when 'F' then 'FailWorkflowExecution' when 'C' then 'CancelWorkflowExecution' else 'CompleteWorkflowExecution' end,
  case how when 'F' then '{{"reason":' || to_json(why) || '}}' when 'C' then '{{}}' else '{{"result":' || to_json(results) || '}}' end from e where how is not null
union all select u, 6, 'StartTimer', '{{"startToFireTimeout":"0.0","timerId":"wake-up"}}' from e where goes_on and how is null and n >= 5""")
def replay_decisions(spark, sf):
    """From the log to a table of decisions: every execution wants activities 0 to 7."""
    wanted = plan(spark, sf).select("u", "id", F.col("id").alias("pos"), F.lit("activity").alias("name"), (F.col("id") % 3).alias("max_retry"), ((F.col("id") == 4) & (F.col("u") % 5 == 0)).alias("raises"))
    u = F.col("u")
    about = A.events(spark, sf).select("u").distinct().join(workflow_notices(spark, sf), "u", "left")
    about = about.select("u", (F.coalesce("cancel_requested_id", F.lit(0)) % 3 == 1).alias("cancel"), F.when(u % 11 == 0, 3).cast("long").alias("fail_at"), F.lit("explicit").alias("fail_reason"), F.when(u % 13 == 0, "ValueError(no)").alias("error"))
    return planner.replay(wanted, activity_fold(spark, sf), about, 6)


@query(f"""with {A.EXEC} select run_id, '{{"name":"' || type_name || '","version":"1.0","domain_name":"' || domain || '","workflow_id":' || workflow_id || ',"run_id":' || run_id || ',"tag_list":[' || case when run_id % 2 = 0 then '"' || tag || '"' else '' end
  || '],"continued_execution_run_id":null,"parent_workflow_id":' || coalesce(cast(parent_workflow_id as varchar), 'null') || ',"parent_run_id":' || coalesce(cast(parent_run_id as varchar), 'null') || '}}' as context from ex""")
def run_context(spark, sf):
    ex = A.executions(spark, sf).withColumn("tags", F.when(F.col("run_id") % 2 == 0, F.col("tags"))).withColumn("continued_execution_run_id", F.lit(None).cast("long"))
    return ex.select("run_id", F.to_json(planner.run_context(ex), {"ignoreNullFields": "false"}).alias("context"))


@query(f"""with {FOLD} select u, id, '{{"name":"activity","version":"1.0","workflow_id":' || u || ',"run_id":' || coalesce(cast(scheduled_id as varchar), 'null') || ',"activity_id":' || id || ',"input":' || coalesce(to_json(input), 'null') || '}}' as context from fold""")
def activity_context(spark, sf):
    c = planner.activity_context(F.lit("activity"), F.lit("1.0"), F.col("u"), F.col("scheduled_id"), F.col("id"), F.col("input"))
    return activity_fold(spark, sf).select("u", "id", F.to_json(c, {"ignoreNullFields": "false"}).alias("context"))


@query(f"""with {A.EV}, x as (select u, et as key, case et when 'click' then 'set' when 'view' then 'list' else 'plain' end as kind, cast(k as varchar) as v, e from ev)
select u, key, kind, case kind when 'plain' then arg_max(v, e) when 'set' then string_agg(distinct v, ',' order by v) else string_agg(v, ',' order by e) end as value from x group by u, key, kind""")
def context_values(spark, sf):
    kind = F.when(F.col("et") == "click", "set").when(F.col("et") == "view", "list").otherwise("plain")
    rows = A.events(spark, sf).select("u", F.col("et").alias("key"), kind.alias("kind"), F.col("k").cast("string").alias("value"), "e")
    return planner.contexts(rows, ["u"], "e").withColumn("value", F.array_join("value", ","))


@query("""select p_partkey, case when p_size % 3 = 0 then '{"b":[' || p_size || ',null]}' else '{"args":[' || p_size || '],"kwargs":{"t":"' || p_type || '"}}' end as input from part""")
def task_inputs(spark, sf):
    raw = F.when(F.col("p_size") % 3 == 0, F.concat(F.lit('{"b":['), F.col("p_size"), F.lit(",null]}")))
    return A.table(spark, sf, "part").select("p_partkey", planner.task_input(F.to_json(F.array("p_size")), F.to_json(F.struct(F.col("p_type").alias("t"))), raw).alias("input"))


@query("select p_partkey, " + ", ".join(f"coalesce(case when p_size % {i + 2} = 0 then cast(p_size as varchar) end, '{v}') as {k}" for i, (k, v) in enumerate(TIMEOUTS.items())) + " from part")
def task_timeouts(spark, sf):
    from weft.plans.tasks import timeouts

    given = {k: F.when(F.col("p_size") % (i + 2) == 0, F.col("p_size").cast("string")) for i, k in enumerate(TIMEOUTS)}
    return A.table(spark, sf, "part").select("p_partkey", *[c.alias(k) for k, c in timeouts(**given).items()])


@query(f"with {A.EV} select u, e, et from (select *, coalesce(sum(case when et in ('signup', 'view') then 1 else 0 end) over (partition by u order by e rows between unbounded preceding and 1 preceding), 0) as a from ev) where a < 20")
def open_activity_cut(spark, sf):
    from weft.operators.inspect import capped

    log = A.events(spark, sf)
    return log.withColumn("ok", capped(F.col("et").isin("signup", "view"), 20, "u", ["e"])).filter("ok").select("u", "e", "et")


@query("""select l_orderkey, l_linenumber, l_partkey, l_quantity, case when l_linenumber % 3 = 0 then case when l_linenumber % 2 = 0 then null else cast(l_linenumber as varchar) end
  when l_linenumber % 3 = 1 then cast(o_shippriority as varchar) else 'w' end as priority from (select l.*, substr(o_orderpriority, 1, 1) as o_shippriority from lineitem l join orders on l_orderkey = o_orderkey)""")
def priority_resolve(spark, sf):
    li, o = A.table(spark, sf, "lineitem"), A.table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    n = F.col("l_linenumber")
    p = planner.priority(n % 3 == 0, F.when(n % 2 != 0, n.cast("string")), n % 3 == 1, F.left("o_orderpriority", F.lit(1)), F.lit("w"))
    return li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", p.alias("priority"))


SPLIT_US = "epoch_us(timestamp '2024-01-20')"


@query(f"""with {A.ACT}, prev as (select u, id, arg_max(st, e) as last_state from act where us < {SPLIT_US} group by u, id),
cur as (select u, id, arg_max(st, e) as now from act where us >= {SPLIT_US} and id < 3 group by u, id)
select prev.u, prev.id, last_state, case when now is not null then 'live' when last_state = 'completed' and not regexp_matches('activity-' || cast(prev.id as varchar), '4$') then 'reuse' else 'run' end as action
from prev left join cur using (u, id)""")
def repair_plan(spark, sf):
    log = A.activity_log(spark, sf)
    cut = F.unix_micros(F.lit("2024-01-20").cast("timestamp"))
    prev, cur = fold.activities(log.filter(F.col("us") < cut)), fold.activities(log.filter((F.col("us") >= cut) & (F.col("id") < 3)))
    forced = F.concat(F.lit("activity-"), F.col("id")).rlike("4$")
    return planner.repair(prev.select("u", "id", "last_state"), cur, ["u", "id"], forced)


@query(f"""with {A.EV}, w as (select * from ev where us >= {SPLIT_US} and us < epoch_us(timestamp '2024-01-22'))
select u, et as name from (select distinct u, et from ev) k where not exists (select 1 from w where w.u = k.u and w.et = k.et and k.et <> 'error') and not exists (select 1 from w where w.u = k.u and w.et = 'error' and k.et = 'click')""")
def signal_propagation(spark, sf):
    log = A.events(spark, sf)
    day = lambda d: F.unix_micros(F.lit(d).cast("timestamp"))
    recent = log.filter((F.col("us") >= day("2024-01-20")) & (F.col("us") < day("2024-01-22")))
    known = log.select("u", F.col("et").alias("name")).distinct()
    had = recent.filter("et <> 'error'").select("u", F.col("et").alias("name")).distinct()
    sent = recent.filter("et = 'error'").select("u", F.lit("click").alias("name")).distinct()
    return planner.propagate(known, had, sent, ["u", "name"])


@query(f"""with {FOLD} select u, id, case when last_state in ('failed', 'timed_out') then 'ScheduleActivityTask' when last_state = 'completed' then 'CompleteWorkflowExecution' else 'StartTimer' end as decision_type,
  '{{"activityId":"activity-' || id || '"' || case when id <> 0 then ',"taskPriority":"' || id || '"' else '' end || '}}' as attrs from fold""")
def decisions_json(spark, sf):
    s = F.col("last_state")
    kind = F.when(s.isin("failed", "timed_out"), "ScheduleActivityTask").when(s == "completed", "CompleteWorkflowExecution").otherwise("StartTimer")
    attrs = codec.without_falsy(activityId=F.concat(F.lit("activity-"), F.col("id")), taskPriority=F.col("id").cast("string"), taskList=F.lit(""))
    return activity_fold(spark, sf).select("u", "id", kind.alias("decision_type"), attrs.alias("attrs"))


@query(f"""with {A.EV}, c as (select u, max(e) filter (where et = 'view') as started, max(e) filter (where et = 'purchase') as completed, max(e) filter (where et = 'error') as cancel from ev group by u)
select u, cancel is not null and cancel > coalesce(completed, 0) as cancel_now, started is not null and started > coalesce(completed, 0) as open_decision from c""")
def cancel_handling(spark, sf):
    log = A.events(spark, sf)
    cursor = fold.decision_cursor(log).join(log.filter("et = 'error'").groupBy("u").agg(F.max("e").alias("cancel")), "u", "left")
    done = F.coalesce("completed_decision_id", F.lit(0))
    later = lambda c: F.col(c).isNotNull() & (F.col(c) > done)
    return cursor.select("u", later("cancel").alias("cancel_now"), later("started_decision_id").alias("open_decision"))


@query("""select distinct p_type as name from part where p_size > 10 and p_type not in (select p_type from part where p_size <= 10 and p_retailprice > 1000)""")
def auto_create_types(spark, sf):
    p = A.table(spark, sf, "part")
    known = p.filter("p_size <= 10 and p_retailprice > 1000").select(F.col("p_type").alias("name"))
    return planner.unknown_types(p.filter("p_size > 10").select(F.col("p_type").alias("name")), known, ["name"])


@query("""select o_orderkey, coalesce(case when o_orderstatus = 'F' then o_orderpriority end, case when o_totalprice > 100000 then 'large' end, 'default') as task_list,
  coalesce(case when o_orderstatus = 'P' then 600 end, 300) as timeout, string_agg(t, ',') as tags from (select *, unnest(case when o_orderstatus = 'O' then ['inherited'] else ['own', o_orderstatus] end) as t from orders) group by all""")
def task_options(spark, sf):
    s = F.col("o_orderstatus")
    lists = F.coalesce(F.when(s == "F", F.col("o_orderpriority")), F.when(F.col("o_totalprice") > 100000, "large"), F.lit("default"))
    tags = F.array_join(F.when(s == "O", F.array(F.lit("inherited"))).otherwise(F.array(F.lit("own"), s)), ",")
    return A.table(spark, sf, "orders").select("o_orderkey", lists.alias("task_list"), F.coalesce(F.when(s == "P", 600), F.lit(300)).alias("timeout"), tags.alias("tags"))


@query(f"""with {A.EV}, s as (select u, e, et in ('signup', 'view') as waits, lag(et in ('signup', 'view')) over (partition by u order by e) as before from ev)
select u, e, case when waits then 'waiting' when before then '' end as context from s where waits or before""")
def context_clear(spark, sf):
    from pyspark.sql import Window

    waits = F.col("et").isin("signup", "view")
    log = A.events(spark, sf).withColumn("waits", waits).withColumn("before", F.lag("waits").over(Window.partitionBy("u").orderBy("e")))
    return log.filter("waits or before").select("u", "e", F.when(F.col("waits"), "waiting").when(F.col("before"), "").alias("context"))
