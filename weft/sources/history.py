"""Histories as JSON files: reading raw events, normalising them, synthetic histories, report writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weft.functions.names import decapitalize, event_state, event_type


def read_histories(spark: SparkSession, path: str, execution: str | None = None) -> DataFrame:
    """Raw events of files ``{"events": [...]}``: execution (the file unless given), event_id, name, ts, attrs (JSON text).

    Events keep their whole payload as text; attributes are taken from it by path.
    """
    return raw_events(spark.read.text(path, wholetext=True).select(F.lit(execution).alias("x") if execution else F.input_file_name().alias("x"), F.from_json("value", "events array<string>").alias("h")))


def raw_events(files: DataFrame) -> DataFrame:
    rows = files.select(F.col("x").alias("execution"), F.explode("h.events").alias("raw"))
    name = F.get_json_object("raw", "$.eventType")
    # Seconds as a float: microseconds are rounded, so that binary fractions don't show.
    ts = F.timestamp_micros(F.round(F.get_json_object("raw", "$.eventTimestamp").cast("double") * 1e6).cast("long"))
    return rows.select("execution", F.get_json_object("raw", "$.eventId").cast("long").alias("event_id"), name.alias("name"), ts.alias("ts"), "raw")


def normalise(raw: DataFrame) -> DataFrame:
    """Events with type, state and their attributes as a JSON text ``attrs``."""
    attrs = F.variant_get(F.parse_json("raw"), F.concat(F.lit("$."), decapitalize(F.col("name")), F.lit("EventAttributes")), "variant")
    kind = F.when(event_type(F.col("name")) == "ExternalWorkflow", "ExternalWorkflowExecution").otherwise(event_type(F.col("name")))
    return raw.select("execution", "event_id", "name", kind.alias("type"), event_state(F.col("name")).alias("state"), "ts", F.to_json(attrs).alias("attrs"))


def attr(path: str, kind: str = "string"):
    """An attribute by path (``a.b``); null where any level is missing."""
    return F.get_json_object("attrs", "$." + path).cast(kind)


def resolve(events: DataFrame, kind: str, first: str, refers: str, id_attr: str) -> DataFrame:
    """Events of one kind with the entity's ``id`` and ``origin``, found through the event they refer to.

    An equi-join on (execution, event id): histories may be partial or in any order.
    """
    own = events.filter(F.col("type") == kind)
    starts = own.filter(F.col("state") == first).select("execution", F.col("event_id").alias("origin"), attr(id_attr).alias("id"))
    rows = own.withColumn("origin", F.when(F.col("state") == first, F.col("event_id")).otherwise(attr(refers, "long")))
    return rows.join(starts, ["execution", "origin"])


#: Fixed order of a synthetic history, as (type, state, kind of id): what an activity's block of events holds.
BLOCK = [
    ("DecisionTask", "scheduled", "decision"), ("DecisionTask", "started", "decision"), ("DecisionTask", "completed", "decision"),
    ("ActivityTask", "scheduled", "activity"), ("ActivityTask", "started", "activity"), ("ActivityTask", None, "activity"),
    ("ChildWorkflowExecution", "start_initiated", "child"), ("ChildWorkflowExecution", "started", "child"), ("ChildWorkflowExecution", None, "child"),
    ("Timer", "started", "timer"), ("Timer", "fired", "timer"), ("Marker", "recorded", "marker"), ("WorkflowExecution", "signaled", "signal"),
]


def synthetic(spark: SparkSession, executions: int, activities: int, seed: int = 0) -> DataFrame:
    """Deterministic histories (execution, event_id, type, state, id, us) with every kind of sequence.

    An execution starts, has ``activities`` blocks of a decision, an activity, a child workflow, a
    timer, a marker and a signal, and ends; every seventh is asked to cancel and cancels instead. Ids
    are dense from 1 and times grow. Which activities and children fail follows from their numbers and
    the seed.
    """
    n = len(BLOCK)
    x, a, step = F.col("execution"), F.col("a"), F.col("step")
    rows = spark.range(executions).select(F.col("id").alias("execution"), F.explode(F.sequence(F.lit(0), F.lit(activities * n + 2))).alias("p"))
    rows = rows.withColumn("a", F.floor((F.col("p") - 1) / n)).withColumn("step", ((F.col("p") - 1) % n).cast("int"))
    inside = F.col("p").between(1, activities * n)
    part = lambda i: F.get(F.array(*[F.lit(b[i]).cast("string") for b in BLOCK]), step)
    bad = (x * 7 + a * 3 + step + seed) % 5 == 0
    asked, first, last = x % 7 == 6, F.col("p") == 0, F.col("p") == activities * n + 2
    state = F.when(inside, F.coalesce(part(1), F.when(bad, "failed").otherwise("completed"))).when(first, "started").when(last, F.when(asked, "canceled").otherwise("completed")).otherwise("cancel_requested")
    rows = rows.filter(inside | first | last | asked)
    event_id = F.when(last & ~asked, F.col("p")).otherwise(F.col("p") + 1).cast("long")
    kind = F.when(inside, part(0)).otherwise("WorkflowExecution")
    name = F.when(inside, F.concat(part(2), F.lit("-"), (a + 1).cast("string"))).otherwise(F.concat(F.lit("workflow-"), x.cast("string")))
    return rows.select("execution", event_id.alias("event_id"), kind.alias("type"), state.alias("state"), name.alias("id"), (event_id * 1_000_000 + x % 1000).alias("us"))


def write_histories(events: DataFrame, path: str) -> None:
    """Write events (execution, event_id, name, us, attrs as JSON text) as history files: one JSON object a line, an execution each.

    An execution's history is one value, as in the files that are read; the service that such files
    come from bounds it at 25,000 events.
    """
    key = F.concat(F.lower(F.left("name", F.lit(1))), F.substr("name", F.lit(2)), F.lit("EventAttributes"))
    one = F.concat(F.lit('{"eventId":'), "event_id", F.lit(',"eventTimestamp":'), (F.col("us") / F.lit(1e6)).cast("decimal(20,6)").cast("string"), F.lit(',"eventType":"'), "name", F.lit('","'), key, F.lit('":'), F.coalesce("attrs", F.lit("{}")), F.lit("}"))
    got = events.groupBy("execution").agg(F.array_sort(F.collect_list(F.struct("event_id", one.alias("raw")))).alias("e"))
    text = F.concat(F.lit('{"execution":"'), F.col("execution").cast("string"), F.lit('","events":['), F.array_join(F.transform("e", lambda x: x["raw"]), ","), F.lit("]}"))
    got.select(text.alias("value")).write.text(path)


def read_history_lines(spark: SparkSession, path: str) -> DataFrame:
    """Raw events as :func:`read_histories` gives them, of files with a history a line."""
    return raw_events(spark.read.text(path).select(F.get_json_object("value", "$.execution").alias("x"), F.from_json("value", "events array<string>").alias("h")))


def line_of(columns: list[str], fmt: str, header: bool = True):
    """A row as one line of csv, tsv or json (an object with a header, an array of texts without)."""
    cols = [F.col(f"`{c}`") for c in columns]
    if fmt in ("csv", "tsv"):
        return F.to_csv(F.struct(*cols), {"sep": "," if fmt == "csv" else "\t"})
    return F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}) if header else F.to_json(F.array(*[c.cast("string") for c in cols]))


def write_report(df: DataFrame, path: str, fmt: str = "csv", header: bool = True) -> None:
    """A report as csv, tsv, json (objects with a header, arrays without), tabular or human (field and value of each row)."""
    if fmt in ("csv", "tsv"):
        df.write.csv(path, sep="," if fmt == "csv" else "\t", header=header)
    elif fmt == "json":
        df.select(line_of(df.columns, "json", header).alias("value")).write.text(path)
    elif fmt == "tabular":
        tabular(df, header).orderBy("pos").select("line").write.text(path)
    elif fmt == "human":
        human(df).select(F.concat_ws(": ", "field", F.coalesce("value", F.lit("")))).write.text(path)
    else:
        raise ValueError(f"unknown format {fmt!r}; one of csv, tsv, json, tabular, human")


def tabular(df: DataFrame, header: bool = True) -> DataFrame:
    """(pos, line) of a report with columns as wide as their longest value: names and a rule first (pos 0 and 1), then the rows."""
    text = {c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in df.columns}
    wide = df.agg(*[F.coalesce(F.max(F.length(v)), F.lit(0)).alias(f"w{i}") for i, v in enumerate(text.values())]).first()
    wide = [max(n, len(c)) if header else n for n, c in zip(wide, df.columns, strict=True)]
    rows = df.select(F.lit(2).alias("pos"), F.concat_ws("  ", *[F.rpad(v, n, " ") for v, n in zip(text.values(), wide, strict=True)]).alias("line"))
    if not header:
        return rows
    top = [(0, "  ".join(c.ljust(n) for c, n in zip(df.columns, wide, strict=True))), (1, "  ".join("-" * n for n in wide))]
    return df.sparkSession.createDataFrame(top, "pos int, line string").unionByName(rows)


def human(df: DataFrame) -> DataFrame:
    """(field, value) of every column, a row each."""
    entries = F.array(*[F.struct(F.lit(c).alias("field"), F.col(f"`{c}`").cast("string").alias("value")) for c in df.columns])
    return df.select(F.explode(entries).alias("e")).select("e.field", "e.value")


def list_keys(spark: SparkSession, path: str, prefix: str = "") -> DataFrame:
    """Paths below ``path`` whose remainder starts with ``prefix``; contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length", "modificationTime")
    base = path.rstrip("/").removeprefix("file://")
    key = F.regexp_replace(F.regexp_replace("path", "^file:/+", "/"), f"^{base}/", "")
    return files.withColumn("key", key).filter(F.startswith("key", F.lit(prefix)))
