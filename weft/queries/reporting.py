"""Timings, profiles and other reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from weft.operators import fold, reports
from weft.queries import query
from weft.queries.history import EXT_FOLD, FOLD, KID_FOLD, MARK, TM_FOLD, WF_FOLD, activity_fold, child_workflow_fold, external_signal_fold, marker_log, signaled_workflows, timers_fold, workflow_fold
from weft.sources import adapter as A
from weft.sources import history


def state_time(kind):
    return "case last_state " + " ".join(f"when '{s}' then {c}" for s, c in reports.STATE_TIMES[kind].items()) + " end"


ENT = f"""{FOLD}, {KID_FOLD}, ent as (
  select 'activity' as kind, u, cast(id as varchar) as name, last_state, scheduled_us, started_us, {state_time('activity')} as state_us, first_event, input, result, reason, details, retry from fold
  union all select 'child_workflow', u, cast(id as varchar), last_state, null, started_us, {state_time('child_workflow')}, first_event, input, result, reason, details, retry from kf)"""
TIM = f"""{ENT}, tim as (select *, case when started_us is not null then state_us end as end_us from ent),
dur as (select *, (end_us - started_us) / 1e6 as duration from tim),
tot as (select u, (arg_max(us, e) - arg_min(us, e)) / 1e6 as total_time from ev group by u),
pct as (select dur.* exclude (duration), total_time, case when duration <> 0 then duration end as duration,
  case when duration <> 0 and total_time <> 0 then duration / total_time * 100 end as percentage from dur join tot using (u))"""


def entities(spark, sf):
    return reports.tasks(activity_fold(spark, sf), child_workflow_fold(spark, sf))


@query(f"with {TIM} select kind, u, name, last_state, scheduled_us, started_us, end_us, round(duration, 6) as duration from dur")
def activity_timings(spark, sf):
    return reports.timings(entities(spark, sf)).select("kind", "u", "name", "last_state", "scheduled_us", "started_us", "end_us", F.round("duration", 6).alias("duration"))


def shares(spark, sf):
    return reports.percentages(reports.timings(entities(spark, sf)), fold.total_time(A.events(spark, sf)))


@query(f"with {TIM} select kind, u, name, last_state, round(duration, 6) as duration, round(percentage, 6) as percentage from pct")
def activity_percentages(spark, sf):
    return shares(spark, sf).select("kind", "u", "name", "last_state", F.round("duration", 6).alias("duration"), F.round("percentage", 6).alias("percentage"))


PROFILE = """kind, u, name, last_state, strftime(make_timestamp(scheduled_us), '%Y-%m-%d %H:%M') as scheduled, round((started_us - scheduled_us) / 1e6, 6) as time_scheduled,
  strftime(make_timestamp(started_us), '%Y-%m-%d %H:%M') as start, round(duration, 6) as time_running, strftime(make_timestamp(end_us), '%Y-%m-%d %H:%M') as "end", round(percentage, 6) as percentage"""


def rounded(df):
    return df.select("kind", "u", "name", "last_state", "scheduled", F.round("time_scheduled", 6).alias("time_scheduled"), "start", F.round("time_running", 6).alias("time_running"), "end", F.round("percentage", 6).alias("percentage"))


@query(f"with {TIM} select {PROFILE} from pct where duration is not null")
def profile(spark, sf):
    return rounded(reports.profile(shares(spark, sf)))


@query(f"with {TIM} select {PROFILE} from pct where duration is not null order by duration desc nulls last, first_event, u, kind limit 20")
def profile_topk(spark, sf):
    return rounded(reports.profile(shares(spark, sf), 20))


@query(f"""with {A.TASKS} select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity,
  round((end_us - scheduled_us) / 1e6 / sum((end_us - scheduled_us) / 1e6) over (partition by l_orderkey) * 100, 6) as percentage from tk""")
def profile_pct(spark, sf):
    from pyspark.sql import Window

    seconds = (F.col("end_us") - F.col("scheduled_us")) / 1e6
    share = seconds / F.sum(seconds).over(Window.partitionBy("l_orderkey")) * 100
    return A.tasks(spark, sf).select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", F.round(share, 6).alias("percentage"))


ALL_TASKS = f"""{ENT}, allt as (select kind, u, name, last_state, state_us, scheduled_us, first_event from ent
  union all select 'signal', u, et, 'signaled', us, null, e from ev)"""


@query(f"""with {ALL_TASKS} select kind, u, name, last_state, state_us, scheduled_us, first_event, pos from
  (select *, row_number() over (partition by u order by first_event desc, kind, name) as pos from allt) where pos <= 3""")
def status_report(spark, sf):
    signals = A.events(spark, sf).select(F.lit("signal").alias("kind"), "u", F.col("et").alias("name"), F.lit("signaled").alias("last_state"), F.col("us").alias("state_us"), F.lit(None).cast("long").alias("scheduled_us"), F.col("e").alias("first_event"))
    rows = entities(spark, sf).select(*signals.columns).unionByName(signals)
    return reports.status(rows, 3)


LATEST = """lx as (select * from (select *, row_number() over (partition by workflow_id order by case when status = 'OPEN' then 0 else 1 end, start_us desc, run_id) as r from ex) where r = 1)"""


@query(f"""with {ENT}, {A.EXEC}, {LATEST}, i as (select u, round((arg_max(state_us, struct_pack(a := first_event, b := kind, c := name)) - arg_min(state_us, struct_pack(a := first_event, b := kind, c := name))) / 1e6, 6) as execution_time,
  arg_min(coalesce(input, chr(0)), struct_pack(a := first_event, b := kind, c := name)) as input, count(*) as n_tasks from ent group by u)
select i.u, domain, type_name, type_version, task_list, run_id, tag as tag_list, execution_time, nullif(i.input, chr(0)) as input, n_tasks from i join lx on lx.workflow_id = i.u""")
def info_report(spark, sf):
    from weft.operators import catalog

    return reports.info(entities(spark, sf), catalog.latest_executions(A.executions(spark, sf))).withColumn("execution_time", F.round("execution_time", 6))


@query(f"with {FOLD} select u, id, scheduled_id, last_state, input, result, reason, details, retry, {state_time('activity')} as state_us from fold")
def task_info(spark, sf):
    state_us = F.coalesce(*[F.when(F.col("last_state") == s, F.col(c)) for s, c in reports.STATE_TIMES["activity"].items()])
    return activity_fold(spark, sf).select("u", "id", "scheduled_id", "last_state", "input", "result", "reason", "details", "retry", state_us.alias("state_us"))


@query(f"""with {FOLD}, w as (select u, min(scheduled_id) as s, cast(3 as bigint) as i from fold group by u),
h as (select w.u, w.s, w.i, fold.* exclude (u) from fold join w on fold.u = w.u and (fold.scheduled_id = w.s or fold.id = w.i))
select u, s as wanted_scheduled_id, i as wanted_id, arg_max(id, first_event) as id, arg_max(coalesce(scheduled_id, -1), first_event) as scheduled_id, arg_max(last_state, first_event) as last_state,
  nullif(arg_max(coalesce(input, ''), first_event), '') as input, nullif(arg_max(coalesce(result, ''), first_event), '') as result from h group by u, s, i""")
def find_activity(spark, sf):
    acts = activity_fold(spark, sf)
    wanted = acts.groupBy("u").agg(F.min("scheduled_id").alias("scheduled_id")).withColumn("id", F.lit(3).cast("long"))
    return reports.find_activity(acts, wanted).withColumn("scheduled_id", F.coalesce("scheduled_id", F.lit(-1).cast("long")))


@query(f"""with {A.EXEC} select run_id, '[' || run_id || ']' as args, '{{"c":' || workflow_id || '}}' as kwargs, '{{}}' as meta,
  '{{"name":"' || type_name || '","version":null,"activity_id":"' || run_id || '","input":' || to_json(input) || '}}' as context from ex""")
def activity_rerun(spark, sf):
    return A.executions(spark, sf).select("run_id", reports.call_of(F.col("type_name"), F.col("run_id"), F.col("input")).alias("c")).select("run_id", "c.*")


@query(f"with {A.EXEC} select workflow_id, type_name, status from ex")
def list_executions(spark, sf):
    return A.executions(spark, sf).select("workflow_id", "type_name", "status")


DETAILS = ["workflow_id", "type_name", "type_version", "run_id", "status", "child_policy", "close_status", "start_us", "close_us", "cancel_requested", "execution_timeout", "input", "tags", "decision_tasks_timeout", "parent_workflow_id", "parent_run_id", "cancel_requested_2"]


@query(f"with {A.EXEC} select {', '.join(DETAILS).replace('tags', 'tag as tags').replace('cancel_requested_2', 'cancel_requested as cancel_requested_2')} from ex")
def list_details(spark, sf):
    """The report's 17 columns; the one that it shows twice has another name the second time."""
    rows = A.executions(spark, sf).withColumn("tags", F.array_join("tags", ",")).withColumn("cancel_requested_2", F.col("cancel_requested"))
    return rows.select(*DETAILS)


@query(f"""with {ENT} select u, kind, name, '[' || to_json(kind || '-' || name) || ',' || to_json(struct_pack(input := input, last_state := last_state, retry := retry, started_us := started_us)) || ']' as entry from ent""")
def history_dump(spark, sf):
    attrs = F.to_json(F.struct("input", "last_state", "retry", "started_us"), {"ignoreNullFields": "false"})
    name = F.concat(F.lit('"'), F.col("kind"), F.lit("-"), F.col("name"), F.lit('"'))
    return entities(spark, sf).select("u", "kind", "name", F.concat(F.lit("["), name, F.lit(","), attrs, F.lit("]")).alias("entry"))


#: Columns of the cooked dump, by section.
COOKED = {
    "workflow": ["last_state", "input", "result", "reason", "details", "started_us", "completed_us", "failed_us"],
    "activities": ["last_state", "scheduled_id", "input", "result", "reason", "details", "cause", "retry", *fold.ACTIVITY_TIMES],
    "child_workflows": ["last_state", "initiated_id", "input", "result", "reason", "details", "cause", "retry", *fold.CHILD_TIMES],
    "markers": ["details", "event_id", "st"],
    "timers": ["last_state", "control", "cause", "started_id", "fired_id", "canceled_id"],
    "signals": ["event_id", "us", "input"],
    "signal_lists": ["n", "signals"],
    "external_workflows_signaling": ["last_state", "control", "cause", "delivered_us"],
    "signaled_workflows": ["n", "delivered"],
}


def cooked_sql(section, table, key):
    return f"select u, '{section}' as section, cast({key} as varchar) as key, cast(to_json(struct_pack({', '.join(f'{c} := {c}' for c in COOKED[section])})) as varchar) as entry from {table}"


@query(f"""with {FOLD}, {KID_FOLD}, {WF_FOLD}, {TM_FOLD}, {EXT_FOLD}, {MARK[len(A.EV) + 2:]},
sg as (select u, et as name, max(e) as event_id, arg_max(us, e) as us, arg_max(props, e) as input, count(*) as n, string_agg(cast(e as varchar) || '=' || props, ';' order by e) as signals from ev group by u, et),
sw as (select u, count(*) as n, string_agg(cast(origin as varchar), ',' order by origin) as delivered from xf where last_state = 'execution_signaled' group by u),
ml as (select u, name || '@' || e as name, props as details, e as event_id, st from mk)
{" union all ".join(cooked_sql(*x) for x in (("workflow", "wff", "u"), ("activities", "fold", "id"), ("child_workflows", "kf", "id"), ("markers", "ml", "name"), ("timers", "tf", "id"), ("signals", "sg", "name"), ("signal_lists", "sg", "name"), ("external_workflows_signaling", "xf", "origin"), ("signaled_workflows", "sw", "'execution_signaled'")))}""")
def history_cooked(spark, sf):
    log = A.events(spark, sf)
    lists, latest = fold.signal_lists(log), fold.signals_latest(log)
    marks = marker_log(spark, sf).select("u", F.concat("name", F.lit("@"), "e").alias("name"), F.col("props").alias("details"), F.col("e").alias("event_id"), "st")
    tables = {"workflow": (workflow_fold(spark, sf), F.col("u")), "activities": (activity_fold(spark, sf), F.col("id")), "child_workflows": (child_workflow_fold(spark, sf), F.col("id")), "markers": (marks, F.col("name")), "timers": (timers_fold(spark, sf), F.col("id")), "signals": (latest, F.col("name")), "signal_lists": (lists, F.col("name")), "external_workflows_signaling": (external_signal_fold(spark, sf), F.col("origin")), "signaled_workflows": (signaled_workflows(spark, sf), F.lit("execution_signaled"))}
    return reports.dump({name: (df, key, COOKED[name]) for name, (df, key) in tables.items()})


def work_steps(spark, sf):
    """Steps of an order's work, one a line; their keys are the order."""
    li, o = A.table(spark, sf, "lineitem"), A.table(spark, sf, "orders")
    start = F.col("l_linenumber") * 1_000_000 + F.col("l_partkey") % 1000
    rows = li.join(o.select("o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey")).filter("l_partkey % 4 <> 0")
    n = lambda x: F.floor(F.col(x))
    return rows.select("l_orderkey", F.concat(F.lit("step-"), F.col("l_linenumber"), F.lit("-"), F.col("l_partkey"), F.lit("-"), F.col("l_suppkey")).alias("name"), F.lit("{}").alias("metadata"), start.cast("long").alias("start_us"), (start + F.col("l_suppkey") * 500_000).cast("long").alias("end_us"), n("l_extendedprice").alias("read_bytes"), n("l_quantity").alias("read_records"), F.lit(False).alias("read_sampled"), (n("l_extendedprice") * (F.col("l_linenumber") - 1)).cast("long").alias("write_bytes"), F.lit(0).cast("long").alias("write_records"), (F.col("l_linenumber") == 1).alias("write_sampled"))


WORK = """wk as (select l_orderkey, 'step-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey as name, l_linenumber * 1000000 + l_partkey % 1000 as start_us, l_suppkey * 0.5 as seconds,
  cast(floor(l_extendedprice) as bigint) as rb, cast(floor(l_quantity) as bigint) as rr, cast(floor(l_extendedprice) as bigint) * (l_linenumber - 1) as wb from lineitem join orders on l_orderkey = o_orderkey where l_partkey % 4 <> 0),
ws as (select *, case when rb <> 0 and seconds <> 0 then round_even(rb / 1048576 / cast(seconds as double), 2) end as read_mb_s, case when rr <> 0 and seconds <> 0 then cast(trunc(rr / cast(seconds as double)) as bigint) end as read_rec_s,
  case when wb <> 0 and seconds <> 0 then round_even(wb / 1048576 / cast(seconds as double), 2) end as write_mb_s from wk)"""


@query(f"with {WORK} select l_orderkey, name, cast(seconds as double) as time_total, rb as read_bytes, read_mb_s, read_rec_s, write_mb_s, cast(null as bigint) as write_rec_s from ws")
def step_stats(spark, sf):
    got = reports.step_stats(work_steps(spark, sf), ["l_orderkey"])
    return got.select("l_orderkey", "name", "time_total", F.col("read.bytes").alias("read_bytes"), F.col("read.mb_s").alias("read_mb_s"), F.col("read.rec_s").alias("read_rec_s"), F.col("write.mb_s").alias("write_mb_s"), F.col("write.rec_s").alias("write_rec_s"))


@query(f"""with {WORK} select o_orderkey, o_orderstatus, count(name) as n_steps, string_agg(name || '=' || coalesce(cast(read_rec_s as varchar), '-'), ',' order by start_us / 1e6, name) as steps
from orders left join ws on o_orderkey = l_orderkey group by o_orderkey, o_orderstatus""")
def metrology_merge(spark, sf):
    tasks = A.table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderstatus")
    got = reports.metrology(tasks, reports.step_stats(work_steps(spark, sf), ["l_orderkey"]), ["l_orderkey"])
    text = F.transform("metrology", lambda x: F.concat(x["name"], F.lit("="), F.coalesce(x["read"]["rec_s"].cast("string"), F.lit("-"))))
    return got.select(F.col("l_orderkey").alias("o_orderkey"), "o_orderstatus", F.coalesce(F.nullif(F.size("metrology"), F.lit(-1)), F.lit(0)).cast("long").alias("n_steps"), F.array_join(text, ",").alias("steps"))


@query("""select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, case when l_tax <> 0 then round_even(l_extendedprice * 1000 / 1048576 / l_tax, 2) end as mb_s,
  case when l_tax <> 0 then cast(trunc(l_quantity / l_tax) as bigint) end as rec_s from lineitem""")
def io_rates(spark, sf):
    return A.table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", reports.mb_rate(F.col("l_extendedprice") * 1000, F.col("l_tax")).alias("mb_s"), reports.record_rate(F.col("l_quantity"), F.col("l_tax")).alias("rec_s"))


@query("""select o_orderkey, trim(split_part(o_orderpriority, '-', 1)) as key, case when contains(o_orderpriority, '-') then trim(substr(o_orderpriority, strpos(o_orderpriority, '-') + 1)) end as value from orders""")
def tag_display(spark, sf):
    from weft.functions.names import split_tag

    tag = split_tag(F.regexp_replace("o_orderpriority", "-", "="))
    return A.table(spark, sf, "orders").select("o_orderkey", tag["key"].alias("key"), tag["value"].alias("value"))


@query("""select u.field, u.value, count(*) as n from nation, lateral (values ('n_nationkey', cast(n_nationkey as varchar)), ('n_name', n_name), ('n_regionkey', cast(n_regionkey as varchar))) as u(field, value) group by u.field, u.value""")
def report_human(spark, sf):
    n = A.table(spark, sf, "nation").select("n_nationkey", "n_name", "n_regionkey")
    return history.human(n).groupBy("field", "value").agg(F.count("*").alias("n"))


@query("""with w as (select greatest(max(length(n_name)), 6) as a, greatest(max(length(cast(n_regionkey as varchar))), 11) as b from nation)
select 1 as kind, rpad(n_name, cast(a as int), ' ') || '  ' || rpad(cast(n_regionkey as varchar), cast(b as int), ' ') as line from nation, w
union all select 0, rpad('n_name', cast(a as int), ' ') || '  ' || rpad('n_regionkey', cast(b as int), ' ') from w
union all select 0, repeat('-', cast(a as int)) || '  ' || repeat('-', cast(b as int)) from w""")
def report_tabular(spark, sf):
    lines = history.tabular(A.table(spark, sf, "nation").select("n_name", "n_regionkey"))
    return lines.select(F.when(F.col("pos") < 2, 0).otherwise(1).alias("kind"), "line")


@query("""select n_nationkey, n_nationkey || ',' || n_name || ',' || n_regionkey as csv, n_nationkey || chr(9) || n_name || chr(9) || n_regionkey as tsv,
  '{"n_nationkey":' || n_nationkey || ',"n_name":"' || n_name || '","n_regionkey":' || n_regionkey || '}' as json, '["' || n_nationkey || '","' || n_name || '","' || n_regionkey || '"]' as json_bare from nation""")
def report_formats(spark, sf):
    n = A.table(spark, sf, "nation").select("n_nationkey", "n_name", "n_regionkey")
    return n.select("n_nationkey", *[history.line_of(n.columns, fmt, header).alias(name) for name, fmt, header in (("csv", "csv", True), ("tsv", "tsv", True), ("json", "json", True), ("json_bare", "json", False))])
