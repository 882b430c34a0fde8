"""Queries over the execution catalogue and the registries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from weft.operators import catalog
from weft.queries import query
from weft.sources import adapter as A

#: The day that ages are counted from, in the queries.
AS_OF = dt.datetime(1998, 9, 1)
AS_OF_US = "epoch_us(timestamp '1998-09-01')"
COLS = ["workflow_id", "run_id", "type_name", "status", "close_status", "start_us"]


@query(f"with {A.EXEC} select {', '.join(COLS)} from ex where status = 'OPEN' and start_us >= {AS_OF_US} - 600 * 86400000000 and start_us <= {AS_OF_US} - 10 * 86400000000")
def exec_filter_open(spark, sf):
    return catalog.filter_executions(A.executions(spark, sf), AS_OF, "OPEN", oldest_date=600, latest_date=10).select(*COLS)


@query(f"with {A.EXEC} select {', '.join(COLS)} from ex where status = 'CLOSED' and close_status = 'FAILED' and close_us >= {AS_OF_US} - 2000 * 86400000000 and close_us <= {AS_OF_US}")
def exec_filter_closed(spark, sf):
    return catalog.filter_executions(A.executions(spark, sf), AS_OF, "CLOSED", close_oldest_date=2000, close_latest_date=AS_OF, close_status="FAILED").select(*COLS)


@query(f"with {A.EXEC} select {', '.join(COLS)} from ex where status = 'CLOSED' and start_us >= {AS_OF_US} - 457 * 86400000000")
def exec_default_window(spark, sf):
    return catalog.filter_executions(A.executions(spark, sf), AS_OF, "CLOSED").select(*COLS)


@query(f"with {A.EXEC} select {', '.join(COLS)} from ex where status = 'OPEN' and tag = '1-URGENT' and start_us >= {AS_OF_US} - 5000 * 86400000000")
def exec_by_tag(spark, sf):
    return catalog.filter_executions(A.executions(spark, sf), AS_OF, "OPEN", tag="1-URGENT", oldest_date=5000).select(*COLS)


@query(f"with {A.EXEC} select {', '.join(COLS)} from ex where status = 'OPEN' and type_name = 'BUILDING' and type_version = '1.0' and start_us >= {AS_OF_US} - 5000 * 86400000000")
def exec_by_type(spark, sf):
    return catalog.filter_executions(A.executions(spark, sf), AS_OF, "OPEN", type_name="BUILDING", type_version="1.0", oldest_date=5000).select(*COLS)


@query(f"with {A.EXEC} select {', '.join(COLS)} from ex where status = 'CLOSED' and start_us >= {AS_OF_US} - 1000 * 86400000000")
def exec_all_days(spark, sf):
    listing, _ = catalog.observed(catalog.filter_executions(A.executions(spark, sf), AS_OF, "CLOSED", start_oldest_date=1000), print)
    return listing.select(*COLS)


@query(f"with {A.EXEC} select {', '.join(COLS)} from ex where workflow_id = 7 and run_id = (select min(run_id) from ex where workflow_id = 7)")
def exec_get(spark, sf):
    all_ = A.executions(spark, sf)
    run_id = all_.filter("workflow_id = 7").agg(F.min("run_id")).first()[0]
    return catalog.get_execution(all_, 7, run_id).select(*COLS)


@query(f"""with {A.EXEC} select {', '.join(COLS)} from (select *, row_number() over (partition by workflow_id
  order by case when status = 'OPEN' then 0 else 1 end, start_us desc, run_id) as r from ex) where r = 1""")
def exec_latest(spark, sf):
    return catalog.latest_executions(A.executions(spark, sf)).select(*COLS)


@query("select c_mktsegment as name, '1.0' as version, min(c_custkey) as created_by, count(*) as n from customer group by c_mktsegment")
def type_registry(spark, sf):
    return A.table(spark, sf, "customer").groupBy(F.col("c_mktsegment").alias("name"), F.lit("1.0").alias("version")).agg(F.min("c_custkey").alias("created_by"), F.count("*").alias("n"))


@query("select distinct p_brand as name, p_type as version from part where p_size > 25 and (p_brand, p_type) not in (select p_brand, p_type from part where p_size <= 25)")
def get_or_create_anti(spark, sf):
    part = A.table(spark, sf, "part").select(F.col("p_brand").alias("name"), F.col("p_type").alias("version"), "p_size")
    return catalog.get_or_create(part.filter("p_size > 25").select("name", "version"), part.filter("p_size <= 25").select("name", "version").distinct(), ["name", "version"])[1]


@query("select distinct p_brand as name, p_type as version from part where p_size <= 25 and (p_brand, p_type) in (select p_brand, p_type from part where p_size > 25)")
def get_or_create_found(spark, sf):
    part = A.table(spark, sf, "part").select(F.col("p_brand").alias("name"), F.col("p_type").alias("version"), "p_size")
    return catalog.get_or_create(part.filter("p_size > 25").select("name", "version"), part.filter("p_size <= 25").select("name", "version").distinct(), ["name", "version"])[0]


SHIFT = "select n_nationkey, case when n_nationkey % 4 = 0 then n_name || '!' else n_name end as n_name, case when n_nationkey % 5 = 0 then null else n_regionkey end as n_regionkey from nation"


def shifted(n):
    return n.select("n_nationkey", F.when(F.col("n_nationkey") % 4 == 0, F.concat("n_name", F.lit("!"))).otherwise(F.col("n_name")).alias("n_name"), F.when(F.col("n_nationkey") % 5 == 0, None).otherwise(F.col("n_regionkey")).alias("n_regionkey"))


@query(f"""with up as ({SHIFT}) select n.n_nationkey, 'n_name' as attr, n.n_name as local, up.n_name as upstream from nation n join up using (n_nationkey) where n.n_name is distinct from up.n_name
union all select n.n_nationkey, 'n_regionkey', cast(n.n_regionkey as varchar), cast(up.n_regionkey as varchar) from nation n join up using (n_nationkey) where n.n_regionkey is distinct from up.n_regionkey""")
def model_diff(spark, sf):
    n = A.table(spark, sf, "nation").select("n_nationkey", "n_name", "n_regionkey")
    return catalog.model_diff(n, shifted(n), ["n_nationkey"])


@query(f"with up as ({SHIFT}) select n.n_nationkey, coalesce(up.n_name, n.n_name) as n_name, coalesce(up.n_regionkey, n.n_regionkey) as n_regionkey from nation n left join up using (n_nationkey)")
def model_merge(spark, sf):
    n = A.table(spark, sf, "nation").select("n_nationkey", "n_name", "n_regionkey")
    return catalog.merge(n, shifted(n), ["n_nationkey"])


@query(f"with {A.EXEC} select domain, status, count(*) as executions, count(distinct type_name) as types from ex group by domain, status")
def domain_navigation(spark, sf):
    return A.executions(spark, sf).groupBy("domain", "status").agg(F.count("*").alias("executions"), F.countDistinct("type_name").alias("types"))


@query("""select 'c' || c_custkey as id, 'r' || n_regionkey as root, cast(2 as bigint) as depth from customer join nation on c_nationkey = n_nationkey
union all select 'n' || n_nationkey, 'r' || n_regionkey, 1 from nation union all select 'r' || r_regionkey, 'r' || r_regionkey, 0 from region""")
def parent_child_tree(spark, sf):
    c, n, r = (A.table(spark, sf, x) for x in ("customer", "nation", "region"))
    key = lambda p, x: F.concat(F.lit(p), F.col(x).cast("string"))
    nodes = c.select(key("c", "c_custkey").alias("id"), key("n", "c_nationkey").alias("parent")).unionByName(n.select(key("n", "n_nationkey").alias("id"), key("r", "n_regionkey").alias("parent"))).unionByName(r.select(key("r", "r_regionkey").alias("id"), F.lit(None).cast("string").alias("parent")))
    return catalog.parent_tree(nodes)


@query(f"""with recursive {A.EXEC}, p as (select run_id as id, case when parent_run_id in (select run_id from ex) then parent_run_id end as parent from ex),
t as (select id, id as root, cast(0 as bigint) as depth from p where parent is null union all select p.id, t.root, t.depth + 1 from p join t on p.parent = t.id) select * from t""")
def execution_tree(spark, sf):
    """Executions under the one that started the first of them."""
    ex = A.executions(spark, sf)
    known = ex.select(F.col("run_id").alias("parent_run_id"), F.col("run_id").alias("parent"))
    return catalog.parent_tree(ex.select(F.col("run_id").alias("id"), "parent_run_id").join(known, "parent_run_id", "left").select("id", "parent"))


#: Types of work: one a pair of brand and type, deprecated where most parts are large.
TYPES_SQL = "ty as (select p_type as name, p_brand as version, case when avg(p_size) > 26 then 'DEPRECATED' else 'REGISTERED' end as status, count(*) as n, min(p_partkey) as created_by from part group by p_type, p_brand)"


def types(spark, sf):
    status = F.when(F.avg("p_size") > 26, "DEPRECATED").otherwise("REGISTERED")
    return A.table(spark, sf, "part").groupBy(F.col("p_type").alias("name"), F.col("p_brand").alias("version")).agg(status.alias("status"), F.count("*").alias("n"), F.min("p_partkey").alias("created_by"))


@query(f"with {TYPES_SQL} select * from ty where status = 'REGISTERED' and name = 'PROMO'")
def activity_type_filter(spark, sf):
    return catalog.registry_filter(types(spark, sf), "REGISTERED", "PROMO")


@query(f"with {TYPES_SQL} select * from ty where status = 'DEPRECATED'")
def activity_type_all(spark, sf):
    return catalog.registry_filter(types(spark, sf), "DEPRECATED")


@query(f"with {TYPES_SQL} select * from ty where name = 'PROMO' and version = (select min(version) from ty where name = 'PROMO')")
def activity_type_get(spark, sf):
    known = types(spark, sf)
    return catalog.registry_get(known, name="PROMO", version=known.filter("name = 'PROMO'").agg(F.min("version")).first()[0])


DOMAINS_SQL = "dm as (select r_name as name, case when r_regionkey % 2 = 0 then 'REGISTERED' else 'DEPRECATED' end as status, 'domain ' || r_regionkey as description, cast(30 as bigint) as retention_period from region)"


def domains(spark, sf):
    key = F.col("r_regionkey")
    return A.table(spark, sf, "region").select(F.col("r_name").alias("name"), F.when(key % 2 == 0, "REGISTERED").otherwise("DEPRECATED").alias("status"), F.concat(F.lit("domain "), key).alias("description"), F.lit(30).cast("long").alias("retention_period"))


@query(f"with {DOMAINS_SQL} select 'all' as call, name, status from dm where status = 'REGISTERED' union all select 'get', name, status from dm where name = 'ASIA' union all select 'found', name, status from dm where name in ('ASIA', 'EUROPE') union all select 'created', 'MOON', 'REGISTERED'")
def domain_registry(spark, sf):
    d = domains(spark, sf)
    wanted = spark.createDataFrame([("ASIA",), ("EUROPE",), ("MOON",)], "name string")
    found, new = catalog.get_or_create(wanted, d, ["name"])
    parts = [("all", catalog.registry_filter(d)), ("get", catalog.registry_get(d, name="ASIA")), ("found", found), ("created", new.withColumn("status", F.lit("REGISTERED")))]
    out = None
    for call, df in parts:
        got = df.select(F.lit(call).alias("call"), "name", "status")
        out = got if out is None else out.unionByName(got)
    return out


@query("""with c as (select p_brand as name, p_partkey as seq, case when p_partkey % 3 = 0 then 'deprecate' else 'register' end as op from part),
f as (select *, min(case when op = 'register' then seq end) over w as f from c window w as (partition by name order by seq rows between unbounded preceding and 1 preceding)),
g as (select *, min(case when op = 'deprecate' and seq > f then seq end) over (partition by name order by seq rows between unbounded preceding and 1 preceding) as g from f)
select name, seq, op, case when op = 'register' then case when g is not null then 'deprecated' when f is not null then 'already_exists' end
  when f is null then 'unknown' when g is not null then 'deprecated' end as fault,
  case when g is not null or (op = 'deprecate' and f is not null) then 'DEPRECATED' when op = 'register' or f is not null then 'REGISTERED' end as status from g""")
def registry_writes(spark, sf):
    seq = F.col("p_partkey")
    commands = A.table(spark, sf, "part").select(F.col("p_brand").alias("name"), seq.alias("seq"), F.when(seq % 3 == 0, "deprecate").otherwise("register").alias("op"))
    return catalog.apply_commands(commands, ["name"])


OPS = ["start", "signal", "request_cancel", "terminate", "restart", "pause", "start"]


@query(f"""with {A.EXEC}, c as (select c_custkey as seq, ({OPS})[c_custkey % 7 + 1] as op, case when c_custkey % 7 = 6 then null else c_custkey end as workflow_id, c_mktsegment as type_name, epoch_us(timestamp '2024-01-01') + c_custkey * 1000000 as us, case when c_custkey % 2 = 0 then c_name end as payload from customer),
t as (select *, coalesce(cast(workflow_id as varchar), case when op = 'start' then type_name || '-1.0-' || us // 1000000 end) as target from c),
l as (select cast(workflow_id as varchar) as target, arg_max(run_id, struct_pack(a := start_us, b := run_id)) filter (where status = 'OPEN') as open_run, arg_max(input, struct_pack(a := start_us, b := run_id)) as last_input from ex group by 1),
f as (select t.*, l.open_run, l.last_input, case when op = 'pause' then 'unknown_command' when op = 'start' and open_run is not null then 'already_started' when op in ('signal', 'request_cancel', 'terminate') and open_run is null then 'unknown_execution' end as fault from t left join l using (target))
select seq, target, case when fault is null then case op when 'start' then 'WorkflowExecutionStarted' when 'restart' then 'WorkflowExecutionStarted' when 'signal' then 'WorkflowExecutionSignaled' when 'request_cancel' then 'WorkflowExecutionCancelRequested' else 'WorkflowExecutionTerminated' end end as event,
  open_run, case when op = 'restart' then coalesce(payload, last_input) else payload end as payload, fault from f""")
def execution_commands(spark, sf):
    seq = F.col("c_custkey")
    op = F.get(F.array(*map(F.lit, OPS)), (seq % 7).cast("int"))
    us = F.unix_micros(F.lit("2024-01-01").cast("timestamp")) + seq * 1_000_000
    commands = A.table(spark, sf, "customer").select(seq.alias("seq"), op.alias("op"), F.when(seq % 7 != 6, seq).alias("workflow_id"), F.col("c_mktsegment").alias("type_name"), F.lit("1.0").alias("type_version"), us.alias("us"), F.when(seq % 2 == 0, F.col("c_name")).alias("payload"))
    return catalog.command_events(commands, A.executions(spark, sf))


EXSHIFT = "select run_id, case when run_id % 4 = 0 then 'CLOSED' else status end as status, case when run_id % 5 = 0 then null else child_policy end as child_policy, execution_timeout, o_totalprice + 1 as o_totalprice from ex"


@query(f"""with {A.EXEC}, up as ({EXSHIFT}) select ex.run_id, 'status' as attr, ex.status as local, up.status as upstream from ex join up using (run_id) where ex.status is distinct from up.status
union all select ex.run_id, 'child_policy', ex.child_policy, up.child_policy from ex join up using (run_id) where ex.child_policy is distinct from up.child_policy""")
def model_fields(spark, sf):
    """Executions against a changed copy: only the fields that executions are compared by count."""
    ex = A.executions(spark, sf).select("run_id", "status", "child_policy", "execution_timeout", "o_totalprice")
    key = F.col("run_id")
    up = ex.select("run_id", F.when(key % 4 == 0, "CLOSED").otherwise(F.col("status")).alias("status"), F.when(key % 5 != 0, F.col("child_policy")).alias("child_policy"), "execution_timeout", (F.col("o_totalprice") + 1).alias("o_totalprice"))
    return catalog.model_changes("WorkflowExecution", ex, up, ["run_id"])


@query(f"""with up as (select * from ({SHIFT}) where n_nationkey <> 3), d as (select n.n_nationkey, up.n_nationkey is not null as there,
  case when up.n_nationkey is null then 0 else (n.n_name is distinct from up.n_name)::int + (n.n_regionkey is distinct from up.n_regionkey)::int end as changes from nation n left join up using (n_nationkey))
select n_nationkey, there as exists, cast(changes as bigint) as changes, there and changes = 0 as is_synced from d""")
def model_synced(spark, sf):
    n = A.table(spark, sf, "nation").select("n_nationkey", "n_name", "n_regionkey")
    return catalog.synced(n, shifted(n).filter("n_nationkey <> 3"), ["n_nationkey"])


@query("select cast(n_nationkey as bigint) as id, cast(case when n_nationkey < 20 then 0 end as bigint) as root, cast(case when n_nationkey < 20 then n_nationkey end as bigint) as depth from nation")
def deep_tree(spark, sf):
    """A chain of twenty, and a cycle of the others, which has no root."""
    key = F.col("n_nationkey").cast("long")
    parent = F.when(key.between(1, 19), key - 1).when(key == 20, 24).when(key > 20, key - 1)
    return catalog.parent_tree(A.table(spark, sf, "nation").select(key.alias("id"), parent.cast("long").alias("parent")))


#: Arguments of catalogue queries, and what is wrong with them.
WRONG = [
    ("OPEN", {"close_status": "FAILED"}, "TypeError: not for OPEN executions: close_status"),
    ("OPEN", {"start_oldest_date": 3, "close_latest_date": 1}, "TypeError: not for OPEN executions: close_latest_date, start_oldest_date"),
    ("CLOSED", {"oldest_date": 3}, "TypeError: not for CLOSED executions: oldest_date"),
    ("CLOSED", {"close_status": "DONE"}, "ValueError: unknown close status 'DONE'"),
    ("HALF", {}, "ValueError: unknown status 'HALF'"),
    ("CLOSED", {"close_status": "TIMED_OUT", "start_oldest_date": 3}, "fine"),
]


@query("select * from (values " + ", ".join("({}, '{}')".format(i, e.replace("'", "''")) for i, (*_, e) in enumerate(WRONG)) + ") as t(i, problem)")
def exec_arguments(spark, sf):
    out = []
    for i, (status, dates, _) in enumerate(WRONG):
        try:
            catalog.filter_executions(A.executions(spark, sf), AS_OF, status, **dates)
            out.append((i, "fine"))
        except (TypeError, ValueError) as x:
            out.append((i, f"{type(x).__name__}: {x}"))
    return spark.createDataFrame(out, "i int, problem string")
