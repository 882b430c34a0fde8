"""Tasks: functions with scheduling options, registered by name, usable on values and on columns."""

from __future__ import annotations

import importlib
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

#: Default time limits in seconds, as text.
TIMEOUTS = {"schedule_to_start": "300", "start_to_close": "300", "schedule_to_close": "600", "heartbeat": "300"}


def timeouts(**given: Column) -> dict[str, Column]:
    """The time limits of a task as columns: the given ones, and the defaults where they are null or absent."""
    if wrong := sorted(set(given) - set(TIMEOUTS)):
        raise TypeError(f"no time limits: {', '.join(wrong)}")
    return {k: F.coalesce(given[k], F.lit(v)) if k in given else F.lit(v) for k, v in TIMEOUTS.items()}


NOT_SET = object()
REGISTRY: dict[tuple[str | None, str], Task] = {}


class TaskFailed(Exception):
    """A task's failure: the task's name and the reason."""

    def __init__(self, name: str, reason: str):
        super().__init__(f"{name}: {reason}")
        self.name, self.reason = name, reason


@dataclass
class Task:
    """A function and its options; called with columns it builds a column expression, else it runs.

    The function is applied to columns as it is, so arithmetic and ``pyspark.sql.functions`` stay in
    the JVM; ``register`` makes a named SQL function (a Pandas UDF) of anything else. ``before`` and
    ``after`` are functions, or import paths of some; ``add_context`` hands the context to the
    function as a keyword.
    """

    name: str
    run: Callable
    version: str = "1.0"
    task_list: str | None = None
    priority: Any = NOT_SET
    retry: int = 0
    raises_on_failure: bool = False
    idempotent: bool = False
    timeouts: dict[str, str] = field(default_factory=lambda: dict(TIMEOUTS))
    meta: dict = field(default_factory=dict)
    before: tuple[Callable | str, ...] = ()
    after: tuple[Callable | str, ...] = ()
    add_context: bool = False

    def __call__(self, *args, **kwargs):
        if any(isinstance(a, Column) for a in (*args, *kwargs.values())):
            return self.run(*args, **kwargs)
        return Call(self, args, kwargs)

    def execute(self, *args, context: dict | None = None, **kwargs):
        """Run once, with the middlewares around; a class is instantiated and its ``execute`` called."""
        if self.add_context:
            kwargs["context"] = context or {}
        for f in self.before:
            imported(f)(self, args, kwargs)
        if isinstance(self.run, type):
            own = self.run(*args, **kwargs)
            own.context = context or {}
            out = own.execute()
            if hasattr(own, "post_execute"):
                own.post_execute()
        else:
            out = self.run(*args, **kwargs)
        for f in self.after:
            out = imported(f)(self, out)
        return out

    def register(self, spark: SparkSession, return_type: str):
        """A SQL function of this task's name, run over Arrow batches."""
        import pandas as pd
        from pyspark.sql.functions import pandas_udf

        run = self.run

        def batch(*cols: pd.Series) -> pd.Series:
            return pd.Series(list(map(run, *cols)))

        batch.__annotations__ = {"cols": pd.Series, "return": pd.Series}
        return spark.udf.register(self.name.replace(".", "_"), pandas_udf(batch, return_type))


@dataclass
class Call:
    """A task with its arguments."""

    task: Task
    args: tuple = ()
    kwargs: dict = field(default_factory=dict)
    raises_on_failure: bool | None = None


def task(name: str | None = None, label: str | None = None, **options):
    """Decorator: make a task of a function or class and register it by (label, name)."""

    def make(f):
        t = Task(name or f.__qualname__, f, **options)
        REGISTRY[label, t.name] = t
        return t

    return make


class DispatchError(LookupError):
    """A name that leads to no task."""


def imported(path):
    """The object at an import path (``package.module.name``); anything but a text as it is."""
    if not isinstance(path, str):
        return path
    module, _, name = path.rpartition(".")
    try:
        return getattr(importlib.import_module(module), name)
    except (ImportError, AttributeError, ValueError) as x:
        raise DispatchError(f"unable to import {path!r}: {x}") from None


def dispatch(path: str) -> Task:
    """The task at an import path; a plain function is made one."""
    found = imported(path)
    return found if isinstance(found, Task) else Task(path.rpartition(".")[2], found)


def dispatch_in(module, name: str, mapping: dict[str, str] | None = None):
    """``part.function`` below a module or namespace; ``mapping`` renames the parts, and then only has those."""
    part, _, function = name.rpartition(".")
    if mapping is not None:
        if part not in mapping:
            raise DispatchError(f"cannot dispatch {name!r}")
        part = mapping[part]
    return getattr(getattr(module, part), function)


def find(name: str, label: str | None = None) -> Task:
    try:
        return REGISTRY[label, name]
    except KeyError:
        raise LookupError(f"no task {name!r}" + (f" under {label!r}" if label else "")) from None
