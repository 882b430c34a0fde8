"""Driver tables as an event log, an execution catalogue and task tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weft.functions.names import micros


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw log: execution u, event id e, time in microseconds, type, value, payload and its number k."""
    t = table(spark, sf_dir, "events")
    return t.select(F.col("user_id").alias("u"), F.col("event_id").alias("e"), micros(F.col("ts")).alias("us"), F.col("event_type").alias("et"), "value", "props", F.get_json_object("props", "$.k").cast("long").alias("k"))


def mapped(col, states: dict[str, str]):
    out = None
    for k, v in states.items():
        out = F.when(col == k, v) if out is None else out.when(col == k, v)
    return out


def states(et, k, names: dict[str, str | tuple], modulus: int):
    """The state that an event stands for: by its type and, for types of four states, by ``k div modulus`` modulo 4."""
    quarter = F.pmod(F.floor(k / modulus), F.lit(4)).cast("int")
    out = None
    for kind, state in names.items():
        value = F.lit(state) if isinstance(state, str) else F.get(F.array(*map(F.lit, state)), quarter)
        out = F.when(et == kind, value) if out is None else out.when(et == kind, value)
    return out


#: States that stand for the event types, by the kind of entity.
ACTIVITY = {"signup": ("scheduled", "scheduled", "scheduled", "schedule_failed"), "view": ("started", "started", "started", "cancel_requested"), "purchase": "completed", "error": ("failed", "failed", "failed", "canceled"), "click": ("timed_out", "timed_out", "timed_out", "canceled")}
CHILD = {"signup": ("start_initiated", "start_initiated", "start_initiated", "start_failed"), "view": ("started", "started", "started", "terminated"), "purchase": "completed", "error": ("failed", "failed", "timed_out", "timed_out"), "click": "canceled"}
WORKFLOW = {"signup": ("started", "started", "started", "continued_as_new"), "purchase": "completed", "error": ("failed", "failed", "terminated", "cancel_failed"), "click": ("timed_out", "timed_out", "signaled", "signaled"), "view": ("canceled", "canceled", "cancel_requested", "cancel_requested")}
TIMER = {"signup": ("started", "started", "started", "start_failed"), "view": ("fired", "fired", "fired", "cancel_failed"), "click": "canceled"}
EXTERNAL = {"signup": "signal_execution_initiated", "purchase": "execution_signaled", "error": "signal_execution_failed"}
CANCEL = {"signup": "request_cancel_execution_initiated", "purchase": "execution_cancel_requested", "error": "request_cancel_execution_failed"}
#: States that don't refer to an earlier event, beside the first ones.
OPENS = ("schedule_failed", "cancel_requested", "start_failed", "cancel_failed")


def entity_log(log: DataFrame, names: dict, modulus: int, first: str) -> DataFrame:
    """The log of one kind of entity (u, id); events that refer to a ``first`` are dropped where there is none yet.

    ``origin`` is the event id of the latest ``first`` so far, which later events refer to.
    """
    rows = log.withColumn("id", F.col("k") % modulus).withColumn("st", states(F.col("et"), F.col("k"), names, modulus)).filter("st is not null")
    so_far = Window.partitionBy("u", "id").orderBy("e").rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("origin", F.max(F.when(F.col("st") == first, F.col("e"))).over(so_far)).filter(F.col("origin").isNotNull() | F.col("st").isin(*OPENS))


def activity_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entity_log(events(spark, sf_dir), ACTIVITY, 5, "scheduled")


def executions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The execution catalogue, one row an order."""
    o, c, n = (table(spark, sf_dir, x) for x in ("orders", "customer", "nation"))
    status = mapped(F.col("o_orderstatus"), {"O": "OPEN", "F": "CLOSED", "P": "CLOSED"})
    closed = mapped(F.col("o_orderstatus"), {"F": "COMPLETED", "P": "FAILED"})
    joined = o.join(c, o.o_custkey == c.c_custkey).join(F.broadcast(n), F.col("c_nationkey") == F.col("n_nationkey"))
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    policy = F.when(key % 3 == 0, "TERMINATE").when(key % 3 == 1, "REQUEST_CANCEL").otherwise("ABANDON")
    # Every fifth execution was started by another: that of a third of its number.
    child = key % 5 == 4
    more = [policy.alias("child_policy"), (key % 10 == 0).alias("cancel_requested"), F.lit("3600").alias("execution_timeout"), F.lit("300").alias("decision_tasks_timeout"), F.concat(F.lit("list-"), key % 4).alias("task_list"), F.concat(F.lit('{"args":['), key.cast("string"), F.lit('],"kwargs":{"c":'), cust.cast("string"), F.lit("}}")).alias("input"), F.when(child, F.floor(cust / 3)).alias("parent_workflow_id"), F.when(child, F.floor(key / 3)).alias("parent_run_id")]
    return joined.select(cust.alias("workflow_id"), key.alias("run_id"), F.col("c_mktsegment").alias("type_name"), F.lit("1.0").alias("type_version"), status.alias("status"), closed.alias("close_status"), micros(F.col("o_orderdate")).alias("start_us"), F.when(closed.isNotNull(), micros(F.col("o_orderdate")) + F.lit(86_400_000_000)).alias("close_us"), F.array("o_orderpriority").alias("tags"), F.col("n_name").alias("domain"), "o_totalprice", *more)


def tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tasks of executions: line items that ship after their order's date."""
    li, o = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    joined = li.join(o, li.l_orderkey == o.o_orderkey).filter("l_shipdate > o_orderdate")
    return joined.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus", micros(F.col("o_orderdate")).alias("scheduled_us"), micros(F.col("l_shipdate")).alias("end_us"))


#: The same adapters in DuckDB SQL, to stand before a query.
EV = """ev as (select user_id as u, event_id as e, epoch_us(ts) as us, event_type as et, value, props,
  cast(json_extract_string(props, '$.k') as bigint) as k from events)"""


def case_sql(col: str, states: dict[str, str]) -> str:
    return f"case {col} " + " ".join(f"when '{k}' then '{v}'" for k, v in states.items()) + " end"


def states_sql(names: dict, modulus: int) -> str:
    """The state of an event, as in :func:`states`."""
    value = lambda s: f"'{s}'" if isinstance(s, str) else f"(array{list(s)})[(k // {modulus}) % 4 + 1]"
    return "case et " + " ".join(f"when '{k}' then {value(s)}" for k, s in names.items()) + " end"


def entity_sql(name: str, names: dict, modulus: int, first: str) -> str:
    return f"""{name} as (select * from (select *, max(case when st = '{first}' then e end) over (partition by u, id order by e
  rows between unbounded preceding and current row) as origin from (select *, k % {modulus} as id, {states_sql(names, modulus)} as st from ev)
  where st is not null) where origin is not null or st in {OPENS})"""


ACT = f"{EV}, {entity_sql('act', ACTIVITY, 5, 'scheduled')}"
EXEC = """ex as (select o_custkey as workflow_id, o_orderkey as run_id, c_mktsegment as type_name, '1.0' as type_version,
  case o_orderstatus when 'O' then 'OPEN' else 'CLOSED' end as status,
  case o_orderstatus when 'F' then 'COMPLETED' when 'P' then 'FAILED' end as close_status, epoch_us(o_orderdate) as start_us,
  case when o_orderstatus <> 'O' then epoch_us(o_orderdate) + 86400000000 end as close_us, o_orderpriority as tag, n_name as domain, o_totalprice,
  case o_orderkey % 3 when 0 then 'TERMINATE' when 1 then 'REQUEST_CANCEL' else 'ABANDON' end as child_policy, o_orderkey % 10 = 0 as cancel_requested,
  '3600' as execution_timeout, '300' as decision_tasks_timeout, 'list-' || o_orderkey % 4 as task_list,
  '{"args":[' || o_orderkey || '],"kwargs":{"c":' || o_custkey || '}}' as input,
  case when o_orderkey % 5 = 4 then o_custkey // 3 end as parent_workflow_id, case when o_orderkey % 5 = 4 then o_orderkey // 3 end as parent_run_id
  from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey)"""
TASKS = """tk as (select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_returnflag, l_linestatus,
  epoch_us(o_orderdate) as scheduled_us, epoch_us(l_shipdate) as end_us from lineitem join orders on l_orderkey = o_orderkey
  where l_shipdate > o_orderdate)"""
