import pytest

from weft.plans.canvas import Chain, FuncGroup, Group, Local, Step, run
from weft.plans.futures import AggregateException, Blocked, Future, wait
from weft.plans.tasks import TaskFailed, find, task


@task("sum")
def add(*xs):
    return sum(sum(x) if isinstance(x, list) else x for x in xs)


@task("fail")
def fail(*_):
    raise ZeroDivisionError("no")


@task("double")
def double(x, *_):
    return x * 2


class Running(Local):
    """Tasks named ``sleep`` stay running."""

    def start(self, call, args):
        return Future("RUNNING") if call.task.name == "sleep" else super().start(call, args)


@task("sleep")
def sleep(*_):
    return None


def test_send_result():
    assert run(Chain((add, 1, 2), (add, 2, 3), (add, 4, 5))) == [3, 5, 9]
    assert run(Chain((add, 1, 2), (add, 2, 3), (add, 4, 5), send_result=True)) == [3, 8, 17]


def test_func_group():
    tree = Chain((add, 1, 2), FuncGroup(lambda n: Group(*[(double, i) for i in range(n)])), (add,), send_result=True)
    assert run(tree) == [3, [0, 2, 4], 6]
    with pytest.raises(TypeError):
        run(Group(FuncGroup(lambda: 7)))
    assert run(Group(FuncGroup(lambda: None, allow_none=True))) == [[]]


def test_max_parallel():
    f = Running().submit(Group((add, 1), (sleep,), (sleep,), (sleep,), max_parallel=2))
    assert [x.state for x in f.futures] == ["FINISHED", "RUNNING", "RUNNING"] and f.state == "RUNNING"


def test_failures():
    f = Local().submit(Group((fail,), (fail,)))
    assert f.state == "FINISHED" and len(f.exception.flatten().exceptions) == 2
    with pytest.raises(AggregateException):
        run(Group((fail,), (fail,)))
    f = Local().submit(Chain((add, 1), (fail,), (add, 2)))
    assert f.state == "FINISHED" and [type(x) for x in f.exception.exceptions] == [type(None), TaskFailed]
    quiet = lambda *m: Chain(*m, break_on_failure=False, raises_on_failure=False)
    assert run(quiet((fail,), (add, 2), (add, 6))) == [None, 2, 6]
    assert run(quiet(quiet((fail,)), (add, 2), (add, 6))) == [[None], 2, 6]
    assert run(Chain(quiet(quiet((fail,))), (add, 6))) == [[[None]], 6]
    with pytest.raises(TaskFailed):
        run(Group((fail,), raises_on_failure=True))
    with pytest.raises(ValueError):
        Chain(send_result=True, break_on_failure=False)


def test_handle():
    e = AggregateException([None, ValueError("a"), AggregateException([KeyError("b")])])
    e.handle(lambda x: True)
    with pytest.raises(AggregateException) as left:
        e.handle(lambda x: isinstance(x, ValueError))
    assert [type(x) for x in left.value.exceptions] == [KeyError]


def test_futures():
    assert run(Group()) == []
    with pytest.raises(Blocked):
        wait(Future().finish(1), Future())
    assert wait(Future().finish(1), Future().finish(2)) == [1, 2]
    assert not Future().finish(1).cancel() and Future().cancel()
    assert find("double") is double
    with pytest.raises(LookupError):
        find("nothing")


@pytest.mark.parametrize(("forced", "runs"), [("*", True), ("a", True), ("a.b", True), ("a.b.c", True), ("a.c", False), ("a.b.cd", False)])
def test_step(forced, runs):
    local = Local(forced={forced}, done={"a.b.c"})
    local.submit(Step("a.b.c", (add, 1)))
    assert (local.markers[0] == ("a.b.c", "scheduled")) == runs
    assert Local(skipped={"a"}).will_run(Step("a.b", (add, 1))) is False
    assert Local(skipped={"a"}).will_run(Step("a.b", (add, 1), force=True)) is True


def test_task_columns(spark):
    from pyspark.sql import functions as F

    assert [r[0] for r in spark.range(3).select(double(F.col("id")).alias("x")).collect()] == [0, 2, 4]
    triple = task("triple")(lambda x: x * 3)
    triple.register(spark, "long")
    assert [r[0] for r in spark.sql("select triple(id) from range(3)").collect()] == [0, 3, 6]


def test_decision_attributes():
    from weft.operators import planner

    with pytest.raises(TypeError, match="timerId"):
        planner.decision("CancelWorkflowExecution", timerId=None)
    assert len(planner.DECISIONS) == 13


def test_pipe(spark):
    from weft.plans import programs

    df = spark.createDataFrame([(1, "b\na"), (2, None), (3, "x y")], "id long, t string").coalesce(1)
    assert [r.out for r in programs.pipe(df, "t", ["tr", "a-z", "A-Z"], "out").orderBy("id").collect()] == ["B A", "", "X Y"]
    with pytest.raises(Exception, match="lines for"):
        programs.pipe(df, "t", ["head", "-n", "1"], "out").collect()


def test_time_limits():
    from weft.plans.tasks import TIMEOUTS, timeouts

    assert sorted(timeouts()) == sorted(TIMEOUTS)
    with pytest.raises(TypeError, match="start"):
        timeouts(start=None)


def test_settings(tmp_path, monkeypatch):
    from weft import settings

    (tmp_path / "own_settings.py").write_text("STEP_BUCKET = 'module'\nMETROLOGY_BUCKET = 'module'\n")
    monkeypatch.syspath_prepend(tmp_path)
    got = settings.load("own_settings", {"STEP_BUCKET": "env"})
    assert (got["STEP_BUCKET"], got["METROLOGY_BUCKET"], got["ACTIVITY_DEFAULT_VERSION"]) == ("env", "module", "default")
    assert list(got) == sorted(got)


def test_send_results_any_function(spark):
    from weft.plans.canvas import send_results

    df = spark.createDataFrame([(k, p, f"{k}{p}") for k in (1, 2) for p in range(5)], "k long, p long, x string").repartition(3)
    got = {(r.k, r.p): r.received for r in send_results(df, "k", "p", "x", lambda before, own: f"{before}>{own}", "").collect()}
    assert got[1, 4] == ">10>11>12>13>14" and got[2, 0] == ">20" and len(got) == 10
