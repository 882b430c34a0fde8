import json

import pytest
from pyspark.sql import functions as F

from weft.functions import codec, names
from weft.operators import catalog, fold, inspect, reports
from weft.sources import history

#: Event, time and attributes of a small execution: one activity that fails once, one that is canceled.
EVENTS = [
    (1, 0.0, "WorkflowExecutionStarted", {"input": '{"args": []}'}),
    (2, 1.0, "ActivityTaskScheduled", {"activityId": "a-1", "input": "{}"}),
    (3, 1.055, "ActivityTaskStarted", {"scheduledEventId": 2}),
    (4, 1.325, "ActivityTaskFailed", {"scheduledEventId": 2, "reason": "no"}),
    (5, 2.0, "ActivityTaskScheduled", {"activityId": "a-1", "input": "{}"}),
    (6, 2.5, "ActivityTaskStarted", {"scheduledEventId": 5}),
    (7, 4.5, "ActivityTaskCompleted", {"scheduledEventId": 5, "result": None}),
    (8, 5.0, "ActivityTaskScheduled", {"activityId": "a-2"}),
    (9, 6.0, "ActivityTaskCanceled", {"scheduledEventId": 8}),
    (10, 8.0, "WorkflowExecutionCompleted", {"result": "4"}),
]


@pytest.fixture(scope="module")
def events(spark, tmp_path_factory):
    raw = [{"eventId": i, "eventTimestamp": 1440000000 + t, "eventType": n, n[0].lower() + n[1:] + "EventAttributes": a} for i, t, n, a in EVENTS]
    path = tmp_path_factory.mktemp("h") / "one.json"
    path.write_text(json.dumps({"events": raw}, indent=1))
    return history.normalise(history.read_histories(spark, str(path), "x")).cache()


def test_normalise(events):
    got = {r.event_id: r for r in events.collect()}
    assert len(got) == 10 and got[9].type == "ActivityTask" and got[9].state == "canceled"
    assert got[10].type == "WorkflowExecution" and json.loads(got[2].attrs)["activityId"] == "a-1"
    assert str(got[3].ts).endswith(":01.055000")


def test_fold_and_profile(events):
    log = history.resolve(events, "ActivityTask", "scheduled", "scheduledEventId", "activityId")
    log = log.select(F.col("execution").alias("u"), "id", F.col("event_id").alias("e"), F.col("state").alias("st"), names.micros(F.col("ts")).alias("us"), F.col("attrs").alias("props"), F.lit(0.0).alias("value"))
    acts = fold.activities(log)
    got = {r.id: r for r in acts.collect()}
    # Columns of earlier states stay; the latest scheduling counts.
    assert got["a-1"].failed_us is not None and got["a-1"].scheduled_id == 5
    assert got["a-2"].last_state == "canceled" and got["a-2"].canceled_us is not None
    times = {r.name: r for r in reports.timings(reports.tasks(acts)).collect()}
    assert times["a-1"].last_state == "completed" and times["a-1"].retry == 0 and times["a-1"].duration == 2.0
    assert times["a-2"].retry is None and times["a-2"].duration is None and times["a-2"].state_us == got["a-2"].canceled_us
    whole = events.select(F.col("execution").alias("u"), F.col("event_id").alias("e"), names.micros(F.col("ts")).alias("us"))
    shares = reports.percentages(reports.timings(reports.tasks(acts)), fold.total_time(whole))
    assert [round(r.percentage, 4) for r in reports.profile(shares).collect() if r.percentage] == [25.0]


def sequential(rows):
    """The fold as one pass over a dictionary."""
    state, fails = {}, 0
    for e, st, us in sorted(rows):
        state["last_state"] = st
        state[f"{st}_us"] = us
        fails += st in ("failed", "timed_out")
    return state | {"retry": fails - 1 if fails else None}


def test_overlay_law(spark):
    import random

    rng = random.Random(3)
    rows = [(u, i, e, rng.choice(sorted(reports.STATE_TIMES["activity"])) if e % 20 else "scheduled", e * 10, "p", 1.0) for u in range(3) for i in range(2) for e in range(u * 1000 + i * 100, u * 1000 + i * 100 + 15)]
    df = spark.createDataFrame(rows, "u long, id long, e long, st string, us long, props string, value double")
    for r in fold.activities(df).collect():
        want = sequential([(e, st, us) for u, i, e, st, us, *_ in rows if (u, i) == (r.u, r.id)])
        assert all(r[f"{s}_us"] == want.get(f"{s}_us") for s in reports.STATE_TIMES["activity"])
        assert (r.last_state, r.retry) == (want["last_state"], want["retry"])


def test_finished_and_latest(spark):
    df = spark.createDataFrame([(1, 1, "WorkflowExecution", "started"), (1, 2, "WorkflowExecution", "timed_out"), (2, 1, "WorkflowExecution", "completed")], "u long, e long, type string, st string")
    assert dict(inspect.finished(df).collect()) == {1: False, 2: True}
    assert dict(inspect.finished(df, all_terminal=True).collect()) == {1: True, 2: True}
    assert sorted((r.u, r.e) for r in inspect.latest_n(df, 1).collect()) == [(1, 2), (2, 1)]
    assert inspect.where(df, u=1, st=None).count() == 0


def test_catalogue_arguments(spark):
    import datetime as dt

    df = spark.createDataFrame([(1, 1, "t", "1", "OPEN", None, 0, None, ["a"])], "workflow_id long, run_id long, type_name string, type_version string, status string, close_status string, start_us long, close_us long, tags array<string>")
    with pytest.raises(TypeError, match="close_status"):
        catalog.filter_executions(df, dt.datetime(1970, 1, 2), "OPEN", close_status="FAILED")
    with pytest.raises(ValueError, match="status"):
        catalog.filter_executions(df, dt.datetime(1970, 1, 2), "HALF")
    with pytest.raises(catalog.DoesNotExistError):
        catalog.get_execution(df, 1, 9)
    assert catalog.filter_executions(df, dt.datetime(1970, 1, 2), "OPEN", tag="a").count() == 1


def test_codec(spark):
    df = spark.createDataFrame([("x" * 300,), ("é" * 10,), ("",), (None,)], "t string")
    assert [r[0] for r in df.select(codec.truncate(F.col("t"))).collect()][0] == "x" * 252 + " ..."
    assert [r[0] for r in df.select(codec.hex_hash(F.col("t"))).collect()][2:] == ["0", None]
    rows, blobs = codec.externalise(df, "t", "t", 100)
    assert blobs.count() == 1 and sorted(r[0] or "" for r in codec.decode(rows, blobs, "t").collect()) == sorted(["x" * 300, "é" * 10, "", ""])
    js = spark.createDataFrame([('{"a": [1, null]}',), ("no",), ("",), ('"k": 1',)], "t string").select(codec.json_or_raw(F.col("t")).alias("j")).select("j.*").collect()
    assert [tuple(r) for r in js] == [('{"a":[1,null]}', '{"a": [1, null]}'), (None, "no"), (None, None), (None, '"k": 1')]
    clean = spark.createDataFrame([('{"b": null, "a": [null, {"c": null}]}',)], "t string").select(codec.remove_none(F.col("t"))).first()[0]
    assert clean == '{"a":[{}]}'


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, "b")], "a long, b string").coalesce(1)
    for fmt in ("csv", "tsv", "json", "tabular", "human"):
        history.write_report(df, str(tmp_path / fmt), fmt)
    assert sorted(r[0] for r in spark.read.text(str(tmp_path / "json")).collect()) == ['{"a":1,"b":null}', '{"a":2,"b":"b"}']
    assert [r[0] for r in history.tabular(df).orderBy("pos", "line").collect()] == [0, 1, 2, 2]
    assert [r[1] for r in history.tabular(df, header=False).orderBy("line").collect()] == ["1   ", "2  b"]
    assert history.list_keys(spark, str(tmp_path), "json/part").count() == 1
    with pytest.raises(ValueError, match="format"):
        history.write_report(df, str(tmp_path / "x"), "xml")


def test_synthetic(spark):
    s = history.synthetic(spark, 3, 4)
    assert s.groupBy("execution").agg(F.max("event_id").alias("m"), F.count("*").alias("n")).filter("m <> n").isEmpty()
    assert {r[0] for r in s.select("type").distinct().collect()} == {"WorkflowExecution", "DecisionTask", "ActivityTask", "ChildWorkflowExecution", "Marker", "Timer"}


def test_timers_forget(spark):
    """A timer that is started again has nothing of the one before."""
    rows = [(1, 1, e, st, e * 10, "p") for e, st in enumerate(["started", "fired", "started", "canceled", "cancel_failed"])]
    r = fold.timers(spark.createDataFrame(rows, "u long, id long, e long, st string, us long, props string")).first()
    assert (r.last_state, r.started_id, r.fired_us, r.canceled_us, r.cancel_failed_id) == ("cancel_failed", 2, None, 30, 4)


def test_parent_tree(spark):
    """Chains of any depth, unknown parents, and cycles, which have no root."""
    rows = [(i, i - 1 if i else None) for i in range(200)] + [(500, 999), (600, 601), (601, 600), (602, 600)]
    got = {r.id: (r.root, r.depth) for r in catalog.parent_tree(spark.createDataFrame(rows, "id long, parent long")).collect()}
    assert all(got[i] == (0, i) for i in range(200)) and got[500] == (999, 1)
    assert got[600] == got[601] == got[602] == (None, None) and len(got) == 204


def test_storage(spark, tmp_path):
    from weft.sources import storage

    folder = str(tmp_path / "b")
    storage.push(spark.createDataFrame([("a-1", "x\ny"), ("b-1", "z")], "k string, v string"), folder, "k", "v")
    storage.push(spark.createDataFrame([("a-2", "")], "k string, v string"), folder, "k", "v")
    assert {tuple(r) for r in storage.pull(spark, folder, "a").collect()} >= {("a-1", "x\ny")}
    assert storage.bucket_and_host("b") == ("b", storage.HOST) and storage.bucket_and_host("b", {"b": "eu"}) == ("b", "eu")
    assert storage.bucket_and_host("x.amazonaws.com/b") == ("b", "x.amazonaws.com")
    for wrong in ("x.org/b", "x.amazonaws.com/a/b"):
        with pytest.raises(ValueError):
            storage.bucket_and_host(wrong)


def test_command_line(spark):
    from weft import cli

    sf = "/root/testdata/sf0.001"
    assert cli.run(spark, ["--data", sf, "workflow.profile", "3", "--nb-tasks", "2"]).count() <= 2
    assert cli.run(spark, ["--data", sf, "workflow.filter", "--status", "CLOSED", "--days", "300"]).count() > 0
    assert cli.run(spark, ["--data", sf, "workflow.start", "--type-name", "t"]).first().event == "WorkflowExecutionStarted"
    assert cli.run(spark, ["--data", sf, "workflow.terminate", "no such"]).first().fault == "unknown_execution"
    assert cli.run(spark, ["--data", sf, "info"]).count() > 5


def test_entry_without_training_subpackage(tmp_path):
    """A copy of the repository without the subpackage, its tests and the pipeline still imports."""
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    repo = Path(__file__).resolve().parent.parent
    shutil.copytree(repo, tmp_path / "copy", ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    code = "import __spark_entry__ as e, weft.cli; assert e.queries() and e.oracle_sql() and not any(k.startswith('op1') for k in e.queries()) and 'pipeline' not in e.queries()"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=tmp_path / "copy")
