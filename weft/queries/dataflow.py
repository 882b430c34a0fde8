"""Groups, chains, maps and steps as data."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from weft.operators import inspect, planner
from weft.plans import canvas, programs
from weft.plans.expected import CASES
from weft.queries import query
from weft.sources import adapter as A
from weft.sources.folders import work_folder

STATE = "case et when 'purchase' then 'FINISHED' when 'error' then 'FINISHED' when 'view' then 'RUNNING' when 'click' then 'CANCELLED' else 'PENDING' end"
MEMBERS = f"{A.EV}, mem as (select u, k % 50 as g, e, et, props, {STATE} as state from ev)"


def members(spark, sf):
    state = A.mapped(F.col("et"), {"purchase": "FINISHED", "error": "FINISHED", "view": "RUNNING", "click": "CANCELLED", "signup": "PENDING"})
    return A.events(spark, sf).select("u", F.concat_ws(":", "u", F.col("k") % 50).alias("g"), "e", "et", F.col("props").alias("result"), state.alias("state"), (F.col("et") == "error").alias("failed"))


G = f"{A.EV}, mem as (select u || ':' || k % 50 as g, e, et, props as result, {STATE} as state, et = 'error' as failed from ev)"


@query(f"""with {G} select g, case when bool_and(state = 'FINISHED') then 'FINISHED' when bool_or(state = 'CANCELLED') then 'CANCELLED' when bool_or(state = 'RUNNING') then 'RUNNING' else 'PENDING' end as verdict,
  count(*) filter (where state = 'FINISHED') as finished, count(*) filter (where state in ('PENDING', 'RUNNING')) as active, count(*) as n from mem group by g""")
def group_state(spark, sf):
    return planner.group_verdict(members(spark, sf), "g")


@query(f"""with {G} select g, '[' || string_agg(case when state = 'FINISHED' then to_json(result) else 'null' end, ',' order by e) || ']' as results, bool_or(failed) as any_failed from mem group by g""")
def group_results(spark, sf):
    return planner.group_results(members(spark, sf), "g", ["e"])


@query(f"""with {G} select g, e, state from (select *, coalesce(sum(case when state in ('PENDING', 'RUNNING') then 1 else 0 end) over (partition by g order by e rows between unbounded preceding and 1 preceding), 0) as a from mem) where a < 2""")
def group_max_parallel(spark, sf):
    m = members(spark, sf)
    return m.withColumn("ok", inspect.capped(F.col("state").isin("PENDING", "RUNNING"), 2, "g", ["e"])).filter("ok").select("g", "e", "state")


@query(f"""with {G} select g, bool_and(state not in ('PENDING', 'RUNNING')) as ready, case when bool_and(state not in ('PENDING', 'RUNNING')) then string_agg(result, '|' order by e) end as results from mem group by g""")
def wait_futures(spark, sf):
    ready = F.bool_and(~F.col("state").isin("PENDING", "RUNNING"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("e", "result"))), lambda x: x["result"]), "|")
    return members(spark, sf).groupBy("g").agg(ready.alias("ready"), F.when(ready, joined).alias("results"))


@query("""with s as (select conv_id, turn, role, length(text) as n, min(case when role = 'assistant' and length(text) > 300 then turn end) over (partition by conv_id) as stop_at from conversations)
select conv_id, turn, role, stop_at from s where stop_at is null or turn <= stop_at""")
def chain_prefix(spark, sf):
    c = A.table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    return planner.chain_prefix(c, "conv_id", "turn", (F.col("role") == "assistant") & (F.length("text") > 300)).select("conv_id", "turn", "role", "stop_at")


@query("""select conv_id, turn, cast(sum(length(text)) over (partition by conv_id order by turn) as bigint) as received from conversations where text is not null""")
def chain_send_result(spark, sf):
    rows = A.table(spark, sf, "conversations").filter("text is not null").withColumn("n", F.length("text").cast("long"))
    return canvas.send_results(rows, "conv_id", "turn", "n", lambda got, own: got + own, 0)


@query("select p_partkey, p_size * 2 as doubled, p_size + 1 as incremented from part")
def map_activity(spark, sf):
    from weft.plans.tasks import task

    double = task("double")(lambda x: x * 2)
    increment = task("increment")(lambda x: x + 1)
    return A.table(spark, sf, "part").select("p_partkey", double(F.col("p_size")).alias("doubled"), increment(F.col("p_size")).alias("incremented"))


@query("select o_orderkey, o_custkey * 3 + o_orderkey as total from orders")
def starmap_activity(spark, sf):
    from weft.plans.tasks import task

    add = task("weighted")(lambda a, b: a * 3 + b)
    return canvas.starmap(A.table(spark, sf, "orders").select("o_orderkey", F.struct("o_custkey", "o_orderkey").alias("args")), "args", add, "total").select("o_orderkey", "total")


@query("select p_partkey, i as part_no, i * i as result from (select p_partkey, unnest(range(0, p_size % 5)) as i from part)")
def funcgroup_fanout(spark, sf):
    n = F.col("p_size") % 5
    items = F.when(n > 0, F.sequence(F.lit(0).cast("long"), n.cast("long") - 1)).otherwise(F.array().cast("array<bigint>"))
    return canvas.fan_out(A.table(spark, sf, "part").select("p_partkey", "p_size"), items, "part_no").select("p_partkey", "part_no", (F.col("part_no") * F.col("part_no")).alias("result"))


PATTERNS = [("PROMO", "force", "sale"), ("STANDARD", "skip", "usual"), ("STANDARD BRUSHED", "force", "brush"), ("SMALL", "skip", "size")]
STEP = """pat(pattern, action, reason) as (values """ + ", ".join(str(p) for p in PATTERNS) + """),
st as (select p_type, coalesce(bool_or(action = 'force'), false) as forced, coalesce(bool_or(action = 'skip'), false) as skipped, coalesce(string_agg(distinct reason, ',' order by reason), '') as reasons
  from (select distinct p_type from part) left join pat on pattern = '*' or p_type = pattern or starts_with(p_type, pattern || ' ') group by p_type),
dn as (select distinct p_type from part where p_size > 48)"""


def steps(spark, sf):
    part = A.table(spark, sf, "part")
    patterns = planner.fixed(spark, PATTERNS, "pattern string, action string, reason string")
    return planner.step_runs(part, patterns, part.filter("p_size > 48"), "p_type", " ")


@query(f"""with {STEP} select p_type, forced, skipped, dn.p_type is not null as done, case when forced then true when skipped then false else dn.p_type is null end as runs, reasons from st left join dn using (p_type)""".replace("select p_type, forced, skipped, dn.p_type is not null", "select st.p_type, forced, skipped, dn.p_type is not null").replace("left join dn using (p_type)", "left join dn on st.p_type = dn.p_type"))
def step_will_run(spark, sf):
    return steps(spark, sf)


@query(f"with {STEP} select p_type, reasons from st where reasons <> ''")
def step_reasons(spark, sf):
    return steps(spark, sf).filter("reasons <> ''").select("p_type", "reasons")


@query("select distinct p_type || '/' || p_brand as step from part where p_size > 48 and starts_with(p_type, 'E')")
def steps_done(spark, sf):
    """Steps are marked as done in a folder, and those under a prefix listed again."""
    folder = work_folder(spark)
    done = A.table(spark, sf, "part").filter("p_size > 48").select(F.concat_ws("/", "p_type", "p_brand").alias("step")).distinct()
    planner.mark_done(done, "step", folder)
    return planner.steps_done(spark, folder, "E")


@query(f"""with {G} select g, e, state, state in ('FINISHED', 'CANCELLED') as done, state <> 'FINISHED' as cancel, case when state <> 'FINISHED' then 'CANCELLED' else state end as after_cancel,
  case when state = 'FINISHED' and not failed then result end as result from mem""")
def future_algebra(spark, sf):
    return members(spark, sf).select("g", "e", "state", *planner.future_columns(F.col("state"), F.col("result"), F.col("failed")))


def plan_rows():
    """(case, value) of small plans, run in the driver: what each way of composing tasks gives."""
    from weft.plans import cases

    return [(name, json.dumps(value, sort_keys=True)) for name, value in cases.run()]


@query("select * from (values " + ", ".join("('{}', '{}')".format(n, v.replace("'", "''")) for n, v in CASES) + ") as t(name, value)")
def plan_cases(spark, sf):
    return spark.createDataFrame(plan_rows(), "name string, value string")


@query("select n_nationkey, lower(n_name) as lower, n_name || '!' as marked from nation")
def external_program(spark, sf):
    """Names through two external programs, one of which comes along with the tasks."""
    programs.bring(spark, {"to-lower": programs_script()})
    n = A.table(spark, sf, "nation").select("n_nationkey", "n_name")
    n = programs.pipe(n, "n_name", ["to-lower"], "lower", binaries=("to-lower",))
    return programs.pipe(n, "n_name", ["sed", "s/$/!/"], "marked").select("n_nationkey", "lower", "marked")


def programs_script() -> str:
    import os
    import tempfile

    path = os.path.join(tempfile.mkdtemp(prefix="weft-bin-"), "to-lower")
    with open(path, "w") as f:
        f.write("#!/bin/sh\nexec tr A-Z a-z\n")
    return path


@query(f"""with {A.EV} select u, count(*) filter (where et = 'error' and k % 2 = 0) as handled, count(*) filter (where et = 'error' and k % 2 = 1) as unhandled, string_agg(case when et = 'error' and k % 2 = 1 then 'TaskFailed: ' || props end, ';' order by e) as messages from ev group by u""")
def exception_flatten(spark, sf):
    errors = F.array_sort(F.collect_list(F.when(F.col("et") == "error", F.struct("e", "k", "props"))))
    log = A.events(spark, sf).groupBy("u").agg(errors.alias("x"))
    left = F.filter("x", lambda x: x["k"] % 2 == 1)
    text = F.array_join(F.transform(left, lambda x: F.concat(F.lit("TaskFailed: "), x["props"])), ";")
    return log.select("u", F.size(F.filter("x", lambda x: x["k"] % 2 == 0)).cast("long").alias("handled"), F.size(left).cast("long").alias("unhandled"), F.when(F.size(left) > 0, text).alias("messages"))
