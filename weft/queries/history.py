"""Folds and inspection of event logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from weft.functions import names
from weft.operators import fold, inspect
from weft.queries import query
from weft.schemas import EVENT_NAMES, INITIAL
from weft.sources import adapter as A
from weft.sources import history
from weft.sources.folders import work_folder


def state_sql(times, values=None, keys="u, id", log="act", retry=True, extra=""):
    held = lambda s: ", ".join(f"'{x}'" for x in ([s] if isinstance(s, str) else s))
    cols = [f"arg_max(us, e) filter (where st = '{s}') as {c}" for c, s in times.items()]
    cols += [f"arg_max({source}, e) filter (where st in ({held(s)})) as {c}" for c, (s, source) in (values or {}).items()]
    more = ["coalesce(nullif(sum(case when st in ('failed', 'timed_out') then 1 else 0 end), 0) - 1, null)::bigint as retry"] if retry else []
    return f"""select {keys}, arg_max(st, e) as last_state, min(e) as first_event, max(e) as last_event,
  {", ".join([*cols, *more])}{extra} from {log} group by {keys}"""


FOLD = f"{A.ACT}, fold as ({state_sql(fold.ACTIVITY_TIMES, fold.ACTIVITY_VALUES)})"


@query(f"with {FOLD} select * from fold")
def activity_fold(spark, sf):
    return fold.activities(A.activity_log(spark, sf))


KIDS = A.entity_sql("kid", A.CHILD, 3, "start_initiated")
KID_FOLD = f"{KIDS}, kf as ({state_sql(fold.CHILD_TIMES, fold.CHILD_VALUES, log='kid')})"


def child_log(spark, sf):
    return A.entity_log(A.events(spark, sf), A.CHILD, 3, "start_initiated")


@query(f"with {A.EV}, {KID_FOLD} select * from kf")
def child_workflow_fold(spark, sf):
    return fold.children(child_log(spark, sf))


WF_LOG = f"wfl as (select *, {A.states_sql(A.WORKFLOW, 1)} as st from ev)"
WF = f"{WF_LOG}, wf as (select * from wfl where st not in ('signaled', 'cancel_requested', 'cancel_failed'))"
WF_FOLD = f"{WF}, wff as ({state_sql(fold.WORKFLOW_TIMES, fold.WORKFLOW_VALUES, 'u', 'wf', False)})"


def workflow_log(spark, sf):
    log = A.events(spark, sf)
    return log.withColumn("st", A.states(F.col("et"), F.col("k"), A.WORKFLOW, 1))


@query(f"with {A.EV}, {WF_FOLD} select * from wff")
def workflow_fold(spark, sf):
    return fold.workflows(workflow_log(spark, sf))


@query(f"""with {A.EV}, {WF_LOG}, n as (select * from wfl where st in ('cancel_requested', 'cancel_failed'))
select u, """ + ", ".join(f"arg_max({x}, e) filter (where st = '{s}') as {s}_{c}" for s in ("cancel_requested", "cancel_failed") for x, c in (("e", "id"), ("us", "us"), ("props", "cause"))) + " from n group by u")
def workflow_notices(spark, sf):
    return fold.notices(workflow_log(spark, sf))


def since(state, value, name):
    held = f"filter (where st = '{state}')"
    return f"case when coalesce(max(e) {held} > max(e) filter (where st = 'started'), true) then arg_max({value}, e) {held} end as {name}"


TM = A.entity_sql("tm", A.TIMER, 7, "started")
TM_FOLD = f"""{TM}, tf as (select u, id, arg_max(st, e) as last_state, min(e) as first_event, max(e) as last_event, arg_max(us, e) filter (where st = 'started') as started_us,
  max(e) filter (where st = 'started') as started_id, arg_max(props, e) filter (where st = 'started') as control, {", ".join(since(s, v, f"{s}_{c}") for s in fold.TIMER_STATES for v, c in (("us", "us"), ("e", "id")))},
  {since("start_failed", "props", "cause")} from tm group by u, id)"""


@query(f"with {A.EV}, {TM_FOLD} select * from tf")
def timers_fold(spark, sf):
    return fold.timers(A.entity_log(A.events(spark, sf), A.TIMER, 7, "started"))


@query(f"""with {A.EV}, {TM_FOLD}, w as (select u, unnest(range(0, 9)) as id from (select distinct u from ev)), x as (select *, id % 2 = 1 as cancel from w)
select x.u, x.id, x.cancel, case when cancel and canceled_id is null and cancel_failed_id is null then null else last_state end as state from x left join tf using (u, id)""")
def timer_lookup(spark, sf):
    wanted = A.events(spark, sf).select("u").distinct().select("u", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(8).cast("long"))).alias("id")).withColumn("cancel", F.col("id") % 2 == 1)
    return inspect.find_timers(wanted, timers_fold(spark, sf))


def external_sql(states, keys):
    a, b, c = states
    return state_sql({"initiated_us": a, "delivered_us": b, "failed_us": c}, {"control": (a, "props"), "cause": (c, "props")}, keys, "xt", False)


XT = A.entity_sql("xt", A.EXTERNAL, 11, "signal_execution_initiated")
EXT_FOLD = f"{XT}, xf as ({external_sql(('signal_execution_initiated', 'execution_signaled', 'signal_execution_failed'), 'u, origin')})"


@query(f"with {A.EV}, {A.entity_sql('xt', A.EXTERNAL, 11, 'signal_execution_initiated')} " + external_sql(("signal_execution_initiated", "execution_signaled", "signal_execution_failed"), "u, origin"))
def external_signal_fold(spark, sf):
    return fold.externals(A.entity_log(A.events(spark, sf), A.EXTERNAL, 11, "signal_execution_initiated"))


@query(f"with {A.EV}, {A.entity_sql('xt', A.CANCEL, 13, 'request_cancel_execution_initiated')} " + external_sql(("request_cancel_execution_initiated", "execution_cancel_requested", "request_cancel_execution_failed"), "u, id"))
def external_cancel_fold(spark, sf):
    return fold.externals(A.entity_log(A.events(spark, sf), A.CANCEL, 13, "request_cancel_execution_initiated"), "cancel")


@query(f"""with {A.EV}, {A.entity_sql('xt', A.EXTERNAL, 11, 'signal_execution_initiated')}
select u, count(*) as n, string_agg(cast(origin as varchar), ',' order by origin) as delivered
from (select u, origin, arg_max(st, e) as st from xt group by u, origin) where st = 'execution_signaled' group by u""")
def signaled_workflows(spark, sf):
    done = external_signal_fold(spark, sf).filter("last_state = 'execution_signaled'")
    return done.groupBy("u").agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_list("origin")), ",").alias("delivered"))


@query(f"with {A.EV} select u, max(e) filter (where et = 'view') as started_decision_id, max(e) filter (where et = 'purchase') as completed_decision_id, max(e) as last_event_id from ev group by u")
def decision_cursor(spark, sf):
    return fold.decision_cursor(A.events(spark, sf))


@query(f"""with {A.EV}, m as (select u, max(e) as e from ev group by u union select u, e from ev where et = 'click'), d as (select u, e as d from ev where et = 'purchase')
select m.u, m.e, max(d.d) as decision_id from m left join d on m.u = d.u and d.d < m.e group by m.u, m.e""")
def decision_before(spark, sf):
    log = A.events(spark, sf)
    moments = log.groupBy("u").agg(F.max("e").alias("e")).unionByName(log.filter("et = 'click'").select("u", "e")).distinct()
    return fold.decision_before(log.select("u", "e", (F.col("et") == "purchase").alias("done")), moments)


@query(f"with {A.EV} select u, et as name, max(e) as event_id, arg_max(us, e) as us, arg_max(props, e) as input from ev group by u, et")
def signals_latest(spark, sf):
    return fold.signals_latest(A.events(spark, sf))


@query(f"with {A.EV} select u, et as name, count(*) as n, string_agg(cast(e as varchar) || '=' || props, ';' order by e) as signals from ev group by u, et")
def signal_lists(spark, sf):
    return fold.signal_lists(A.events(spark, sf))


@query(f"""with {A.EV}, w as (select u, 'click' as name, e from ev where et = 'purchase'), s as (select u, et as name, e from ev where et = 'click')
select w.u, w.name, w.e, s.e as signal_id from w asof left join s on w.u = s.u and w.name = s.name and w.e > s.e""")
def wait_signal_asof(spark, sf):
    log = A.events(spark, sf)
    waits = log.filter("et = 'purchase'").select("u", F.lit("click").alias("name"), "e")
    return inspect.signal_before(waits, log.filter("et = 'click'").select("u", F.col("et").alias("name"), "e"))


MARK = f"{A.EV}, mk as (select u, e, props, 'm' || cast(k % 6 as varchar) as name, case when et = 'error' then 'record_failed' else 'recorded' end as st from ev)"


def marker_log(spark, sf):
    st = F.when(F.col("et") == "error", "record_failed").otherwise("recorded")
    return A.events(spark, sf).select("u", "e", "props", F.concat(F.lit("m"), F.col("k") % 6).alias("name"), st.alias("st"))


@query(f"with {MARK} select * from (select u, name, count(*) as n, arg_max(st, e) as st, arg_max(props, e) as details, max(e) as event_id from mk group by u, name) where st = 'recorded'")
def markers_last_recorded(spark, sf):
    return fold.markers(marker_log(spark, sf))


@query(f"with {MARK} select u, name, string_agg(st || ':' || cast(e as varchar), ',' order by e) as markers, count(*) as n from mk group by u, name")
def marker_lists(spark, sf):
    items = F.transform(F.array_sort(F.collect_list(F.struct("e", "st"))), lambda x: F.concat(x["st"], F.lit(":"), x["e"].cast("string")))
    return marker_log(spark, sf).groupBy("u", "name").agg(F.array_join(items, ",").alias("markers"), F.count("*").alias("n"))


@query(f"""with {MARK}, wanted as (select distinct u, name, props from mk),
m as (select u, name, props, max(e) as event_id from mk where st = 'recorded' group by u, name, props)
select w.u, w.name, w.props as details, m.event_id from wanted w left join m using (u, name, props)""")
def marker_match(spark, sf):
    log = marker_log(spark, sf)
    wanted = log.select("u", "name", "props").distinct()
    last = log.filter("st = 'recorded'").groupBy("u", "name", "props").agg(F.max("e").alias("event_id"))
    return wanted.join(last, ["u", "name", "props"], "left").withColumnRenamed("props", "details")


@query(f"""with {A.ACT}, t as (select u, k % 5 as id, e as timer_id from ev where et = 'view'),
f as (select u, id, e from act where st = 'failed')
select f.u, f.id, f.e, min(t.timer_id) as timer_id, count(t.timer_id) as n_later from f left join t on f.u = t.u and f.id = t.id and t.timer_id > f.e group by f.u, f.id, f.e""")
def retry_timer_match(spark, sf):
    # Timers later than a failure are counted from one ordered pass; the first of them is the next in order.
    from pyspark.sql import Window

    log = A.activity_log(spark, sf)
    fails = log.filter("st = 'failed'").select("u", "id", "e", F.lit(None).cast("long").alias("t"))
    timers = A.events(spark, sf).filter("et = 'view'").select("u", (F.col("k") % 5).alias("id"), "e", F.col("e").alias("t"))
    later = Window.partitionBy("u", "id").orderBy("e").rowsBetween(1, Window.unboundedFollowing)
    both = fails.unionByName(timers).withColumn("timer_id", F.min("t").over(later)).withColumn("n_later", F.count("t").over(later))
    return both.filter("t is null").select("u", "id", "e", "timer_id", "n_later")


@query(f"""with {A.ACT}, {KIDS}, x as (
  select u, 'activity' as kind, cast(id as varchar) as name, min(e) as first_at from act group by u, id union all
  select u, 'child_workflow', cast(id as varchar), min(e) from kid group by u, id union all select u, 'signal', et, e from ev)
select *, row_number() over (partition by u order by first_at, kind, name) as pos from x""")
def tasks_order(spark, sf):
    log = A.events(spark, sf)
    return fold.task_order(activity_fold(spark, sf), child_workflow_fold(spark, sf), log)


@query(f"with {A.EV} select u, (arg_max(us, e) - arg_min(us, e)) / 1e6 as total_time from ev group by u")
def total_time(spark, sf):
    return fold.total_time(A.events(spark, sf))


@query(f"with {A.EV} select u, e, us, value, props from ev where et = 'error' and k = 7")
def history_filter(spark, sf):
    return inspect.where(A.events(spark, sf), et="error", k=7).select("u", "e", "us", "value", "props")


@query(f"with {A.EV} select u, e, et from (select *, row_number() over (partition by u order by e desc) as r from ev) where r <= 3")
def history_latest_n(spark, sf):
    return inspect.latest_n(A.events(spark, sf), 3).select("u", "e", "et")


@query(f"""with {A.EV}, r as (select *, row_number() over (partition by u order by e desc) as n from ev)
select u, e, et, (n - 1) // 4 + 1 as page from r where n <= 10""")
def history_pages(spark, sf):
    return inspect.pages(A.events(spark, sf), max_results=10, page_size=4, reverse=True).select("u", "e", "et", "page")


@query(f"""with {A.ACT} select u, e, st, id, origin from act where origin is not null and st not in {A.OPENS}""")
def event_resolution(spark, sf):
    """The entity of each event, through the event that it refers to: an equi-join on event ids."""
    log = A.activity_log(spark, sf).filter(F.col("origin").isNotNull() & ~F.col("st").isin(*A.OPENS))
    attrs = F.when(F.col("st") == "scheduled", F.to_json(F.struct(F.col("id").alias("activityId")))).otherwise(F.to_json(F.struct(F.col("origin").alias("scheduledEventId"))))
    events = log.select(F.col("u").alias("execution"), F.col("e").alias("event_id"), F.lit("ActivityTask").alias("type"), F.col("st").alias("state"), attrs.alias("attrs"))
    found = history.resolve(events, "ActivityTask", "scheduled", "scheduledEventId", "activityId")
    return found.select(F.col("execution").alias("u"), F.col("event_id").alias("e"), F.col("state").alias("st"), F.col("id").cast("long").alias("id"), "origin")


@query(f"with {A.EV} select u, e, et from (select *, row_number() over (partition by u order by e) - 1 as p, count(*) over (partition by u) as n from ev) where p >= 2 and p < n - 2")
def history_slice(spark, sf):
    return inspect.between(A.events(spark, sf), 2, -2).select("u", "e", "et")


@query(f"with {A.EV} select u, e, et, row_number() over (partition by u order by e desc) as pos from ev")
def history_reversed(spark, sf):
    from pyspark.sql import Window

    return A.events(spark, sf).select("u", "e", "et", F.row_number().over(Window.partitionBy("u").orderBy(F.desc("e"))).cast("long").alias("pos"))


@query("""select conv_id as u, arg_max(role, turn) in ('assistant', 'user') as finished from conversations group by conv_id""")
def history_finished_all(spark, sf):
    log = A.table(spark, sf, "conversations").select(F.col("conv_id").alias("u"), F.col("turn").alias("e"), F.lit("WorkflowExecution").alias("type"), A.mapped(F.col("role"), {"assistant": "completed", "user": "timed_out", "system": "signaled"}).alias("st"))
    return inspect.finished(log, all_terminal=True)


@query("""select conv_id as u, arg_max(role, turn) = 'assistant' as finished from conversations group by conv_id""")
def history_finished(spark, sf):
    log = A.table(spark, sf, "conversations").select(F.col("conv_id").alias("u"), F.col("turn").alias("e"), F.lit("WorkflowExecution").alias("type"), A.mapped(F.col("role"), {"assistant": "completed", "user": "started", "system": "signaled"}).alias("st"))
    return inspect.finished(log)


ISL = f"""{A.EV}, isl as (select u, e, et as type, sum(new) over (partition by u order by e) as island
  from (select *, case when lag(et) over (partition by u order by e) = et then 0 else 1 end as new from ev))"""


@query(f"with {ISL} select u, cast(island as bigint) as island, max(type) as type, count(*) as n, min(e) as first, max(e) as last from isl group by u, island")
def history_islands(spark, sf):
    runs = inspect.islands(A.events(spark, sf).withColumn("type", F.col("et")))
    return runs.groupBy("u", "island").agg(F.max("type").alias("type"), F.count("*").alias("n"), F.min("e").alias("first"), F.max("e").alias("last"))


@query(f"""with {ISL}, g as (select u, island, max(type) as type, count(*) as n, min(e) as first, max(e) as last from isl group by u, island)
select u, cast(case when n = 1 and island > 1 and type = 'signup' then 1 else island end as bigint) as island,
  arg_min(type, first) as type, cast(sum(n) as bigint) as n, min(first) as first, max(last) as last from g group by 1, 2""")
def history_distinct(spark, sf):
    return inspect.distinct_groups(A.events(spark, sf).withColumn("type", F.col("et")), "signup")


@query("""with s as (select conv_id, turn, role, lag(role) over (partition by conv_id order by turn) as from_state from conversations)
select conv_id, turn, role, from_state from s where not (from_state is null and role = 'user')
  and not (coalesce(from_state, '') = 'user' and role = 'assistant') and not (coalesce(from_state, '') = 'assistant' and role = 'user')""")
def transition_check(spark, sf):
    allowed = spark.createDataFrame([("user", "assistant"), ("assistant", "user")], "from_state string, to_state string")
    return inspect.illegal(A.table(spark, sf, "conversations").select("conv_id", "turn", "role"), allowed, "user", ["conv_id"], "role", "turn")


def machine_sql(kind):
    from weft.schemas import TRANSITIONS

    return "(values " + ", ".join(f"('{a}', '{b}')" for a, to in TRANSITIONS[kind].items() for b in to) + ") as t(f, t)"


@query(f"""with {A.ACT}, s as (select u, id, e, st, lag(st) over (partition by u, id order by e) as from_state from act)
select u, id, e, st, from_state from s where not (from_state is null and st = 'scheduled')
  and not exists (select 1 from {machine_sql('ActivityTask')} where t.f = s.from_state and t.t = s.st)""")
def transition_check_entity(spark, sf):
    log = A.activity_log(spark, sf).select("u", "id", "e", "st")
    return inspect.illegal(log, inspect.transition_table(spark, "ActivityTask"), INITIAL["ActivityTask"], ["u", "id"])


TYPES_SQL = " ".join(f"when contains(name, '{t}') then '{t}'" for t in ("ActivityTask", "DecisionTask", "ChildWorkflowExecution", "Marker", "Timer", "ExternalWorkflow", "WorkflowExecution"))


@query("with n as (select unnest([" + ", ".join(f"'{n}'" for n in EVENT_NAMES) + f"""]) as name), t as (select name, case {TYPES_SQL} end as type from n),
s as (select name, type, substr(name, 1, strpos(name, type) - 1) || substr(name, strpos(name, type) + length(type)) as rest from t)
select name, type, lower(rest[1] || regexp_replace(substr(rest, 2), '([A-Z])', '_\\1', 'g')) as state, lower(name[1]) || substr(name, 2) as decapitalized,
  lower(name[1] || regexp_replace(substr(name, 2), '([A-Z])', '_\\1', 'g')) as snake, name as camel from s""")
def normalize_names(spark, sf):
    n = spark.createDataFrame([(x,) for x in EVENT_NAMES], "name string")
    name = F.col("name")
    return n.select("name", names.event_type(name).alias("type"), names.event_state(name).alias("state"), names.decapitalize(name).alias("decapitalized"), names.snake(name).alias("snake"), names.camel(names.snake(name)).alias("camel"))


@query(f"with {A.EV} select u, e, coalesce(nullif(k, 0), nullif(k % 3, 0), nullif(e, 0)) as first_id from ev")
def event_id_lookup(spark, sf):
    return A.events(spark, sf).select("u", "e", names.first_id(F.col("k"), F.col("k") % 3, F.col("e")).alias("first_id"))


@query(f"with {A.EV} select u, e, coalesce(json_extract_string(props, '$.__extra.class'), et) as name, json_extract_string(props, '$.k') as k, json_extract_string(props, '$.a.b') as missing from ev")
def payload_lookup(spark, sf):
    p = F.col("props")
    return A.events(spark, sf).select("u", "e", names.workflow_name(p, F.col("et")).alias("name"), F.get_json_object(p, "$.k").alias("k"), F.get_json_object(p, "$.a.b").alias("missing"))


N_BLOCK = len(history.BLOCK)


def block_sql(i):
    return f"({[b[i] for b in history.BLOCK]})[(p - 1) % {N_BLOCK} + 1]".replace("None", "null")


@query(f"""with r as (select x.range as execution, p.range as p, (p.range - 1) // {N_BLOCK} as a, (p.range - 1) % {N_BLOCK} as step, x.range % 7 = 6 as asked from range(40) x, range({5 * N_BLOCK + 3}) p),
f as (select *, p between 1 and {5 * N_BLOCK} as inside, p = {5 * N_BLOCK + 2} as last from r where asked or p <> {5 * N_BLOCK + 1}),
g as (select *, case when last and not asked then p else p + 1 end as event_id from f)
select execution, event_id, case when inside then {block_sql(0)} else 'WorkflowExecution' end as type,
  case when inside then coalesce({block_sql(1)}, case when (execution * 7 + a * 3 + step + 1) % 5 = 0 then 'failed' else 'completed' end) when p = 0 then 'started' when last then case when asked then 'canceled' else 'completed' end else 'cancel_requested' end as state,
  case when inside then {block_sql(2)} || '-' || (a + 1) else 'workflow-' || execution end as id, event_id * 1000000 + execution % 1000 as us from g""")
def synthetic_history(spark, sf):
    return history.synthetic(spark, 40, 5, 1)


@query(f"""with {A.ACT} select cast(u as varchar) as execution, e as event_id, 'ActivityTask' as type, st as state, us, case when st = 'scheduled' then '{{"activityId":"a-' || id || '","input":' || to_json(props) || '}}' else '{{"scheduledEventId":' || origin || '}}' end as attrs
from act where st in ('scheduled', 'started', 'completed', 'failed', 'timed_out', 'canceled') and origin is not null""")
def history_files(spark, sf):
    """Histories are written as files of raw events and read again."""
    log = A.activity_log(spark, sf).filter("st in ('scheduled', 'started', 'completed', 'failed', 'timed_out', 'canceled') and origin is not null")
    attrs = F.when(F.col("st") == "scheduled", F.to_json(F.struct(F.concat(F.lit("a-"), "id").alias("activityId"), F.col("props").alias("input")))).otherwise(F.to_json(F.struct(F.col("origin").alias("scheduledEventId"))))
    folder = work_folder(spark)
    history.write_histories(log.select(F.col("u").alias("execution"), F.col("e").alias("event_id"), F.concat(F.lit("ActivityTask"), names.camel(F.col("st"))).alias("name"), "us", attrs.alias("attrs")), folder)
    got = history.normalise(history.read_history_lines(spark, folder))
    return got.select("execution", "event_id", "type", "state", names.micros(F.col("ts")).alias("us"), "attrs")
