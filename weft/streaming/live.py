"""Incremental variants of folds on Structured Streaming.

State is kept by entity in RocksDB and checkpointed in the shared folder; micro-batches run until
the source is read, and the final state is returned as a table. Events carry dense ids, so order
comes from ids, not from arrival.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weft.functions.names import micros
from weft.sources import adapter as A
from weft.sources.folders import work_folder

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as a stream; a single file is found in its folder by name, since streams read folders."""
    path = f"{sf_dir}/{name}.parquet"
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(at).isDirectory():
        return reader.parquet(path)
    return reader.option("pathGlobFilter", f"{name}.parquet").option("recursiveFileLookup", "true").parquet(sf_dir)


def event_columns(t: DataFrame) -> DataFrame:
    return t.select(F.col("user_id").alias("u"), F.col("event_id").alias("e"), F.col("ts").cast("timestamp").alias("ts"), micros(F.col("ts")).alias("us"), F.col("event_type").alias("et"), "value", "props", F.get_json_object("props", "$.k").cast("long").alias("k"))


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_columns(table_stream(spark, sf_dir, "events"))


def run(stream: DataFrame, mode: str, keep, folder: str):
    """Run a stream until its source is read, with state in RocksDB; gives the query, which has ended."""
    spark = stream.sparkSession
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    try:
        query = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).foreachBatch(keep).start()
        query.awaitTermination()
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass") if before is None else spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
    return query


def drained(stream: DataFrame, mode: str, keys: list[str] | None = None) -> DataFrame:
    """What a stream has put out once its source is read.

    In append mode that is all rows; in update mode the last state of each key; in complete mode, where
    every micro-batch has the whole result, those of the last one.
    """
    spark = stream.sparkSession
    folder = work_folder(spark)
    spark.createDataFrame([], stream.schema).write.parquet(f"{folder}/out/batch=-1")

    def keep(batch: DataFrame, n: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/out/batch={n}")

    run(stream, mode, keep, folder)
    got = spark.read.parquet(f"{folder}/out")
    if mode == "append":
        return got.drop("batch")
    if mode == "complete":
        return got.join(got.agg(F.max("batch").alias("batch")), "batch").drop("batch")
    cols = [c for c in stream.columns if c not in keys]
    return got.groupBy(*keys).agg(F.max_by(F.struct(*cols), "batch").alias("_s")).select(*keys, *[F.col(f"_s.{c}") for c in cols])


STATES = ("scheduled", "schedule_failed", "started", "completed", "failed", "timed_out", "canceled", "cancel_requested")


def overlay(key, chunks, state):
    """Advance one activity's state by the events of a micro-batch, in order of their ids.

    The state is a fixed few numbers: last state and event, whether it was scheduled, a time for each
    state, failures. Events that refer to a scheduling before there is one, and those not after the
    state's last event, are passed over.
    """
    import pandas as pd

    last, event, known, *times, fails = state.get if state.exists else (None, -1, False, *[None] * len(STATES), 0)
    events = sorted((int(e), st, int(us)) for c in chunks for e, st, us in zip(c["e"], c["st"], c["us"], strict=True))
    for e, st, us in events:
        known = known or st == "scheduled"
        if e <= event or not (known or st in A.OPENS):
            continue
        last, event = st, e
        times[STATES.index(st)] = us
        fails += st in ("failed", "timed_out")
    state.update((last, event, known, *times, fails))
    if last is not None:
        row = dict(zip(["u", "id", "last_state", *[f"{s}_us" for s in STATES], "retry"], [key[0], key[1], last, *times, fails - 1 if fails else None], strict=True))
        yield pd.DataFrame({k: pd.Series([v], dtype="object" if isinstance(v, str) else "Int64") for k, v in row.items()})


def fold_activities(log: DataFrame) -> DataFrame:
    """The activity fold with custom keyed state; its final rows equal the batch fold's."""
    rows = log.withColumn("id", F.col("k") % 5).withColumn("st", A.states(F.col("et"), F.col("k"), A.ACTIVITY, 5)).filter("st is not null").select("u", "id", "e", "st", "us")
    times = ", ".join(f"{s}_us long" for s in STATES)
    out = rows.groupBy("u", "id").applyInPandasWithState(overlay, f"u long, id long, last_state string, {times}, retry long", f"last_state string, event long, known boolean, {times}, fails long", "update", "NoTimeout")
    return drained(out, "update", ["u", "id"])


def sessions(log: DataFrame, batch_log: DataFrame, gap: str, lateness: str = "1 hour") -> DataFrame:
    """Session windows by event time. A watermark of ``lateness`` bounds the state and drops what comes later.

    Closed sessions are put out by the stream; those that are open when the source is read (the
    watermark hasn't passed their end) are taken from the log after each user's last closed session.
    """

    def windows(df):
        got = df.groupBy("u", F.session_window("ts", gap).alias("w")).agg(F.count("*").alias("n"))
        return got.select("u", F.unix_micros("w.start").alias("start_us"), F.unix_micros("w.end").alias("end_us"), "n")

    closed = drained(windows(log.withWatermark("ts", lateness)), "append")
    ends = closed.groupBy("u").agg(F.max("end_us").alias("closed_us"))
    rest = batch_log.join(ends, "u", "left").filter(F.col("closed_us").isNull() | (F.col("us") >= F.col("closed_us")))
    return closed.unionByName(windows(rest))


def signals(log: DataFrame) -> DataFrame:
    """The latest signal of each name and how many there were."""
    return drained(log.groupBy("u", F.col("et").alias("name")).agg(F.max("e").alias("event_id"), F.count("*").alias("n")), "update", ["u", "name"])


def machine(log: DataFrame, keys: list[str], columns: list[str], step, out: str) -> DataFrame:
    """A keyed state machine over a stream: ``step(state, event)`` changes a dict and gives rows, for events in order of their ids.

    The state must have a bound of its own; it is kept as JSON. Events that aren't after the last one
    of their key are passed over, so a repeated file changes nothing.
    """
    kinds = [f"{c} long" for c in keys]
    names = [x.split()[0] for x in out.split(", ")]

    def advance(key, chunks, state):
        import pandas as pd

        own = json.loads(state.get[0]) if state.exists else {"last": -1}
        events = sorted((tuple(None if v != v else v for v in row) for c in chunks for row in zip(*(c[x] for x in ("e", *columns)), strict=True)), key=lambda r: r[0])
        rows = []
        for row in events:
            event = {x: v if v is None or isinstance(v, str) else int(v) for x, v in zip(("e", *columns), row, strict=True)}
            if event["e"] > own["last"]:
                own["last"] = event["e"]
                rows += [(*(int(k) for k in key), *r) for r in step(own, event)]
        state.update((json.dumps(own),))
        if rows:
            yield pd.DataFrame({n: pd.Series(list(v), dtype="object" if any(isinstance(x, str) for x in v) else "Int64") for n, v in zip([*keys, *names], zip(*rows, strict=True), strict=True)})

    rows = log.select(*keys, "e", *columns).groupBy(*keys).applyInPandasWithState(advance, ", ".join([*kinds, out]), "state string", "append", "NoTimeout")
    return drained(rows, "append")


HOUR = 3_600_000_000


def timer_step(state, event):
    """Timers of an execution: a start sets one, to fire at its time; the first event at or after that time fires it, unless it is cancelled before."""
    pending = state.setdefault("pending", {})
    for start, (timer, due) in sorted(pending.items(), key=lambda x: int(x[0])):
        if event["us"] >= due:
            del pending[start]
            yield timer, int(start), "fired", event["e"]
        elif event["et"] == "click" and event["k"] % 7 == timer:
            del pending[start]
            yield timer, int(start), "canceled", event["e"]
    if event["et"] == "signup":
        pending[str(event["e"])] = [event["k"] % 7, event["us"] + event["k"] % 24 * HOUR]
        yield event["k"] % 7, event["e"], "started", event["e"]


def timers(log: DataFrame) -> DataFrame:
    """The last state of each timer: u, id, start_id, state, at_id. The state holds what is pending."""
    got = machine(log, ["u"], ["us", "et", "k"], timer_step, "id long, start_id long, state string, at_id long")
    return got.groupBy("u", "id", "start_id").agg(F.max_by("state", F.struct("at_id", F.col("state") != "started")).alias("state"), F.max("at_id").alias("at_id"))


def beat_step(state, event, limit=12 * HOUR):
    """Heartbeats of an execution's tasks: one that is silent for longer than the limit times out, by the first event after that."""
    beats = state.setdefault("beats", {})
    for task, (beat, us) in sorted(beats.items()):
        if event["us"] > us + limit:
            del beats[task]
            yield int(task), beat, us + limit, event["e"]
    task = str(event["k"] % 5)
    if event["et"] == "view":
        beats[task] = [event["e"], event["us"]]
    elif event["et"] == "purchase":
        beats.pop(task, None)


def heartbeats(log: DataFrame) -> DataFrame:
    """Time-outs: u, id, beat_id, deadline_us, found_id. The state holds a beat a task."""
    return machine(log, ["u"], ["us", "et", "k"], beat_step, "id long, beat_id long, deadline_us long, found_id long")


def retry_step(state, event, most=3):
    """Failures of a task: each waits twice as long as the one before, from two seconds; after ``most`` it is given up; success forgets them."""
    if event["et"] == "purchase":
        state["n"] = 0
    elif event["et"] == "error":
        state["n"] = n = state.get("n", 0) + 1
        yield event["e"], n, event["us"] + 2**n * 1_000_000 if n <= most else None


def retries(log: DataFrame) -> DataFrame:
    """(u, id, e, attempt, retry_us) of every failure; retry_us is null where it is given up."""
    return machine(log.withColumn("id", F.col("k") % 5).filter("et in ('error', 'purchase')"), ["u", "id"], ["us", "et", "k"], retry_step, "e long, attempt long, retry_us long")


def activity_polls(log: DataFrame, task_list: str) -> DataFrame:
    """Scheduled tasks of a list, as polls would bring them: u, id, task_token, input."""
    st = A.states(F.col("et"), F.col("k"), A.ACTIVITY, 5)
    rows = log.filter((st == "scheduled") & (F.concat(F.lit("list-"), F.col("u") % 3) == task_list))
    return drained(rows.select("u", (F.col("k") % 5).alias("id"), F.concat_ws("-", "u", "e").alias("task_token"), F.col("props").alias("input")), "append")


def decision_polls(log: DataFrame) -> DataFrame:
    """Executions that wait for a decision, with how far their history goes: u, previous_decision_id, last_event_id, n_events."""
    seen = log.groupBy("u").agg(F.max(F.when(F.col("et") == "purchase", F.col("e"))).alias("previous_decision_id"), F.max("e").alias("last_event_id"), F.count("*").alias("n_events"))
    return drained(seen, "update", ["u"]).filter("last_event_id > coalesce(previous_decision_id, -1)")


#: The event that a worker's response stands for; a heartbeat leaves none.
RESPONSES = {"complete": "ActivityTaskCompleted", "fail": "ActivityTaskFailed", "cancel": "ActivityTaskCanceled", "decide": "DecisionTaskCompleted"}


def sink(responses: DataFrame) -> DataFrame:
    """Append responses (u, e, op, payload) as event rows: u, scheduled_id, event, attrs.

    A batch that is repeated after a failure replaces itself, so no event is doubled.
    """
    event = None
    for op, name in RESPONSES.items():
        event = F.when(F.col("op") == op, name) if event is None else event.when(F.col("op") == op, name)
    field = F.when(F.col("op") == "complete", "result").when(F.col("op") == "fail", "reason").otherwise("details")
    rows = responses.select("u", F.col("e").alias("scheduled_id"), event.alias("event"), F.to_json(F.create_map(field, F.col("payload"))).alias("attrs")).filter("event is not null")
    return drained(rows, "append")
