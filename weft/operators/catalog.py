"""Execution catalogue: validated filters, latest executions, registries, differences."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weft.schemas import LOOK_BACK_DAYS

DAY_US = 86_400_000_000


class DoesNotExistError(LookupError):
    """Nothing matches a point query."""


#: Arguments that only one status takes.
ARGUMENTS = {"OPEN": {"oldest_date", "latest_date"}, "CLOSED": {"start_oldest_date", "start_latest_date", "close_oldest_date", "close_latest_date", "close_status"}}
#: Close statuses.
CLOSE_STATUSES = {"COMPLETED", "FAILED", "CANCELED", "TERMINATED", "CONTINUED_AS_NEW", "TIMED_OUT"}


def _us(value, as_of: dt.datetime) -> int:
    """A date as microseconds; an integer is days before ``as_of``."""
    if isinstance(value, int):
        value = as_of - dt.timedelta(days=value)
    return int((value - dt.datetime(1970, 1, 1)) / dt.timedelta(microseconds=1))


def filter_executions(df: DataFrame, as_of: dt.datetime, status: str = "OPEN", tag: str | None = None, workflow_id=None, type_name: str | None = None, type_version: str | None = None, **dates) -> DataFrame:
    """Executions of a status; every predicate is a plain comparison that reaches the scan.

    Dates are datetimes or days before ``as_of``. The window of starts goes back 457 days by default,
    but isn't applied if a window of closes is given. A type's version counts only with its name.
    """
    if status not in ARGUMENTS:
        raise ValueError(f"unknown status {status!r}")
    if wrong := sorted(set(dates) - ARGUMENTS[status]):
        raise TypeError(f"not for {status} executions: {', '.join(wrong)}")
    if dates.get("close_status") not in {None, *CLOSE_STATUSES}:
        raise ValueError(f"unknown close status {dates['close_status']!r}")
    out = df.filter(F.col("status") == status)
    if tag is not None:
        out = out.filter(F.array_contains("tags", tag))
    if workflow_id is not None:
        out = out.filter(F.col("workflow_id") == workflow_id)
    if type_name is not None:
        out = out.filter(F.col("type_name") == type_name)
        if type_version is not None:
            out = out.filter(F.col("type_version") == type_version)
    closes = {k for k in dates if k.startswith("close_") and k != "close_status"}
    prefix = "" if status == "OPEN" else "start_"
    oldest, latest = dates.get(f"{prefix}oldest_date"), dates.get(f"{prefix}latest_date")
    if oldest is None and not closes:
        oldest = LOOK_BACK_DAYS
    for col, lo, hi in (("start_us", oldest, latest), ("close_us", dates.get("close_oldest_date"), dates.get("close_latest_date"))):
        if lo is not None:
            out = out.filter(F.col(col) >= _us(lo, as_of))
        if hi is not None:
            out = out.filter(F.col(col) <= _us(hi, as_of))
    if dates.get("close_status"):
        out = out.filter(F.col("close_status") == dates["close_status"])
    return out


def get_execution(df: DataFrame, workflow_id, run_id) -> DataFrame:
    out = df.filter((F.col("workflow_id") == workflow_id) & (F.col("run_id") == run_id))
    if out.isEmpty():
        raise DoesNotExistError(f"no execution {workflow_id}/{run_id}")
    return out


def latest_executions(df: DataFrame) -> DataFrame:
    """Per workflow the open execution that started last, else the closed one."""
    w = Window.partitionBy("workflow_id").orderBy(F.when(F.col("status") == "OPEN", 0).otherwise(1), F.desc("start_us"), "run_id")
    return df.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")


def get_or_create(wanted: DataFrame, registry: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """(registered rows that are wanted, wanted rows to create): by keys only."""
    return registry.join(wanted.select(*keys).distinct(), keys, "left_semi"), wanted.dropDuplicates(keys).join(registry, keys, "left_anti")


def model_diff(local: DataFrame, upstream: DataFrame, keys: list[str], ignore: tuple[str, ...] = ()) -> DataFrame:
    """(keys, attr, local, upstream) of attributes that differ; null equals null."""
    cols = [c for c in local.columns if c not in keys and c not in ignore]
    side = lambda df, name: df.select(*keys, F.explode(F.array(*[F.struct(F.lit(c).alias("attr"), F.col(c).cast("string").alias("v")) for c in cols])).alias("a")).select(*keys, "a.attr", F.col("a.v").alias(name))
    return side(local, "local").join(side(upstream, "upstream"), [*keys, "attr"]).filter(~F.col("local").eqNullSafe(F.col("upstream")))


def merge(local: DataFrame, upstream: DataFrame, keys: list[str]) -> DataFrame:
    """Local rows overlaid with the upstream attributes that aren't null."""
    u = upstream.select(*keys, *[F.col(c).alias(f"_{c}") for c in upstream.columns if c not in keys])
    return local.join(u, keys, "left").select(*keys, *[F.coalesce(f"_{c}", c).alias(c) if f"_{c}" in u.columns else F.col(c) for c in local.columns if c not in keys])


#: The attributes that each kind of model is compared by.
MODEL_FIELDS = {
    "Domain": ["name", "status", "description", "retention_period"],
    "WorkflowType": ["name", "version", "status", "creation_date", "deprecation_date", "task_list", "child_policy", "execution_timeout", "decision_tasks_timeout", "description"],
    "WorkflowExecution": ["workflow_id", "run_id", "status", "task_list", "child_policy", "execution_timeout", "tag_list", "decision_tasks_timeout"],
    "ActivityType": ["name", "version", "status", "description", "creation_date", "deprecation_date", "task_list", "task_heartbeat_timeout", "task_schedule_to_close_timeout", "task_schedule_to_start_timeout", "task_start_to_close_timeout"],
}


def model_changes(kind: str, local: DataFrame, upstream: DataFrame, keys: list[str]) -> DataFrame:
    """:func:`model_diff` over the fields that models of a kind are compared by, as far as the tables have them."""
    cols = [c for c in MODEL_FIELDS[kind] if c in local.columns and c in upstream.columns and c not in keys]
    return model_diff(local.select(*keys, *cols), upstream.select(*keys, *cols), keys)


def synced(local: DataFrame, upstream: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, exists, changes, is_synced) of local rows; a model that upstream lacks isn't synced."""
    n = model_diff(local, upstream, keys).groupBy(*keys).agg(F.count("*").alias("_n"))
    there = upstream.select(*keys, F.lit(True).alias("_there"))
    got = local.select(*keys).join(there, keys, "left").join(n, keys, "left")
    changes, exists = F.coalesce("_n", F.lit(0)).cast("long"), F.coalesce("_there", F.lit(False))
    return got.select(*keys, exists.alias("exists"), changes.alias("changes"), (exists & (changes == 0)).alias("is_synced"))


def is_synced(local: DataFrame, upstream: DataFrame, keys: list[str]) -> bool:
    return synced(local, upstream, keys).filter("not is_synced").isEmpty()


#: Statuses of registered things.
REGISTERED, DEPRECATED = "REGISTERED", "DEPRECATED"


def registry_filter(registry: DataFrame, status: str | None = REGISTERED, name: str | None = None) -> DataFrame:
    """Registered types or domains of a status (any if None) and a name; nothing is cut to a page."""
    if status not in (None, REGISTERED, DEPRECATED):
        raise ValueError(f"unknown status {status!r}")
    out = registry if status is None else registry.filter(F.col("status") == status)
    return out if name is None else out.filter(F.col("name") == name)


def registry_get(registry: DataFrame, **key) -> DataFrame:
    """The one row of a key; :class:`DoesNotExistError` if there is none."""
    out = registry
    for c, v in key.items():
        out = out.filter(F.col(c) == F.lit(v))
    if out.isEmpty():
        raise DoesNotExistError(", ".join(f"{c}={v!r}" for c, v in key.items()))
    return out


def apply_commands(commands: DataFrame, keys: list[str], order: str = "seq") -> DataFrame:
    """Registry writes (keys, seq, op: register or deprecate) in order: each with the status after it and its fault, if any.

    What is registered can't be registered again, even when deprecated (already_exists, deprecated);
    what isn't can't be deprecated (unknown), nor twice (deprecated). Faults change nothing.
    """
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    first = F.min(F.when(F.col("op") == "register", F.col(order))).over(w)
    gone = F.min(F.when((F.col("op") == "deprecate") & (F.col(order) > F.col("_first")), F.col(order))).over(w)
    rows = commands.withColumn("_first", first).withColumn("_gone", gone)
    fault = F.when(F.col("op") == "register", F.when(F.col("_gone").isNotNull(), "deprecated").when(F.col("_first").isNotNull(), "already_exists")).otherwise(F.when(F.col("_first").isNull(), "unknown").when(F.col("_gone").isNotNull(), "deprecated"))
    after = F.when(F.col("_gone").isNotNull() | ((F.col("op") == "deprecate") & F.col("_first").isNotNull()), DEPRECATED).when((F.col("op") == "register") | F.col("_first").isNotNull(), REGISTERED)
    return rows.withColumn("fault", fault).withColumn("status", after).drop("_first", "_gone")


#: What may be done to an execution.
EXECUTION_COMMANDS = ("start", "signal", "request_cancel", "terminate", "restart")


def command_events(commands: DataFrame, executions: DataFrame) -> DataFrame:
    """Commands (seq, op, workflow_id, type_name, type_version, us, payload) as event rows to append, or as faults.

    A start without an id takes ``name-version-seconds``; one of an open execution is a fault, as is any
    other command to a workflow without an open execution. A restart takes the input of the execution
    that ran last, if it has none of its own.
    """
    last = executions.groupBy("workflow_id").agg(F.max(F.when(F.col("status") == "OPEN", F.struct("start_us", "run_id"))).alias("o"), F.max_by("input", F.struct("start_us", "run_id")).alias("last_input"))
    own = F.concat_ws("-", "type_name", "type_version", F.floor(F.col("us") / 1_000_000).cast("string"))
    c = commands.withColumn("target", F.coalesce(F.col("workflow_id").cast("string"), F.when(F.col("op") == "start", own)))
    got = c.join(last.select(F.col("workflow_id").cast("string").alias("target"), F.col("o.run_id").alias("open_run"), "last_input"), "target", "left")
    fresh = F.col("op").isin("start")
    fault = F.when(~F.col("op").isin(*EXECUTION_COMMANDS), "unknown_command").when(fresh & F.col("open_run").isNotNull(), "already_started").when(~fresh & (F.col("op") != "restart") & F.col("open_run").isNull(), "unknown_execution")
    name = F.when(F.col("op").isin("start", "restart"), "WorkflowExecutionStarted").when(F.col("op") == "signal", "WorkflowExecutionSignaled").when(F.col("op") == "request_cancel", "WorkflowExecutionCancelRequested").when(F.col("op") == "terminate", "WorkflowExecutionTerminated")
    return got.select("seq", "target", F.when(fault.isNull(), name).alias("event"), "open_run", F.when(F.col("op") == "restart", F.coalesce("payload", "last_input")).otherwise(F.col("payload")).alias("payload"), fault.alias("fault"))


def observed(df: DataFrame, callback, name: str = "listing") -> tuple[DataFrame, object]:
    """A listing, and a function that tells ``callback`` how many rows it read, to be called after an action."""
    from pyspark.sql import Observation

    watch = Observation(name)
    return df.observe(watch, F.count(F.lit(1)).alias("rows")), lambda: callback(watch.get["rows"])


def parent_tree(nodes: DataFrame) -> DataFrame:
    """(id, parent) to (id, root, depth), by doubling: each round joins a node with its ancestor's ancestor.

    Rounds go on until every node has reached a root: their number grows with the logarithm of the
    depth. A parent that isn't a node is a root itself. Nodes of a cycle, or above one, have no root:
    root and depth are null.
    """
    ids = nodes.select("id")
    lost = nodes.filter("parent is not null").select(F.col("parent").alias("id")).distinct().join(ids, "id", "left_anti")
    cur = nodes.select("id", "parent").unionByName(lost.withColumn("parent", F.lit(None).cast(nodes.schema["parent"].dataType)))
    cur = cur.select("id", F.col("parent").alias("up"), F.when(F.col("parent").isNull(), 0).otherwise(1).cast("long").alias("depth"), F.col("id").alias("top"))
    n, hops = None, 1
    while True:
        left = cur.filter("up is not null").count()
        # Beyond as many hops as there are open nodes only cycles are left.
        if left == 0 or n is not None and hops > n:
            break
        n = left if n is None else n
        a, b = cur.alias("a"), cur.select(F.col("id").alias("_id"), F.col("up").alias("_up"), F.col("depth").alias("_d"), F.col("top").alias("_t")).alias("b")
        cur = cut(a.join(b, F.col("a.up") == F.col("b._id"), "left").select(F.col("a.id").alias("id"), F.col("b._up").alias("up"), F.when(F.col("a.up").isNull(), F.col("a.depth")).otherwise(F.col("a.depth") + F.col("b._d")).alias("depth"), F.when(F.col("a.up").isNull(), F.col("a.top")).otherwise(F.col("b._t")).alias("top")))
        hops *= 2
    done = F.col("up").isNull()
    # The top of an open node is only as far as it has come.
    roots = cur.select("id", F.when(done, F.col("top")).alias("root"), F.when(done, F.col("depth")).alias("depth"))
    return roots.join(ids, "id", "left_semi")


def cut(df: DataFrame) -> DataFrame:
    """A checkpoint in the shared folder where there is one, so that plans of loops don't grow; else the plan as it is."""
    return df.checkpoint() if df.sparkSession.sparkContext.getCheckpointDir() else df
