"""Tasks outside of the process: other interpreters, external programs, and binaries that come along."""

from __future__ import annotations

import inspect
import json
import os
import subprocess
import sys
import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

#: Arguments longer than this go by way of a file: a command line has a limit.
LONG = 65_536
CHILD = """
import importlib, json, sys
call = json.loads(open(sys.argv[2]).read() if sys.argv[1] == "file" else sys.argv[2])
out = {}
try:
    module, _, name = call["path"].rpartition(".")
    out["result"] = getattr(importlib.import_module(module), name)(*call["args"], **call["kwargs"])
except BaseException as x:
    out["error"] = [type(x).__name__, str(x)]
print("\\n" + json.dumps(out))
"""


class ProgramError(Exception):
    """A program that ended badly: its exit status, or its own exception, and what it said."""


def in_interpreter(path: str, *args, interpreter: str = sys.executable, timeout: float | None = None, env: dict[str, str] | None = None, **kwargs):
    """Run the function at an import path in another interpreter; arguments and result are JSON.

    With a time limit the child, and what it started, is killed at its end.
    """
    call = json.dumps({"path": path, "args": args, "kwargs": kwargs})
    with tempfile.NamedTemporaryFile("w", suffix=".json") as f:
        if len(call) > LONG:
            f.write(call)
            f.flush()
            how = ["file", f.name]
        else:
            how = ["text", call]
        run = subprocess.Popen([interpreter, "-c", CHILD, *how], stdout=subprocess.PIPE, stderr=subprocess.PIPE, text=True, start_new_session=True, env=os.environ | (env or {}))
        try:
            out, err = run.communicate(timeout=timeout)
        except subprocess.TimeoutExpired:
            os.killpg(run.pid, 9)
            run.wait()
            raise ProgramError(f"no result after {timeout} s") from None
    try:
        got = json.loads("{" + out.rpartition("\n{")[2]) if out else {}
    except ValueError:
        got = {}
    if run.returncode or not got:
        raise ProgramError(f"status {run.returncode}: {err.strip()[-500:]}")
    if "error" in got:
        raise ProgramError(": ".join(got["error"]))
    return got["result"]


def program(path: str | None = None, argument_format: Callable[[str, object], list[str]] | None = None):
    """Decorator: calls run an external program (by default of the function's name).

    Arguments are checked against the function's signature first; named ones stand before the others,
    as ``--name=value``. The result is what the program prints, without the last line break.
    """

    def make(f):
        signature = inspect.signature(f)
        named = argument_format or (lambda k, v: [f"--{k}={v}"])

        def call(*args, **kwargs):
            signature.bind(*args, **kwargs)
            argv = [path or f.__name__, *[x for k, v in kwargs.items() for x in named(k, v)], *map(str, args)]
            run = subprocess.run(argv, capture_output=True, text=True, check=False)
            if run.returncode:
                raise ProgramError(f"status {run.returncode}: {run.stderr.strip()[-500:]}")
            return run.stdout.removesuffix("\n")

        call.__name__, call.__doc__ = f.__name__, f.__doc__
        return call

    return make


def pipe(df: DataFrame, column: str, argv: list[str], out: str, binaries: tuple[str, ...] = ()) -> DataFrame:
    """``out``: each value of a text column as a filter program rewrites it, line by line; one process a partition.

    Values are one line each (line breaks become spaces, null an empty line) and the program must give
    a line for a line. ``binaries`` are names added by :func:`bring`; their folder is first in PATH.
    """
    at = df.columns.index(column)
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.StringType())])

    def run(batches):
        import pyarrow as pa

        env = dict(os.environ)
        if binaries:
            env["PATH"] = os.pathsep.join([*{os.path.dirname(binary(b)) for b in binaries}, env.get("PATH", "")])
        for b in batches:
            lines = [" ".join((x or "").splitlines()) for x in b.column(at).to_pylist()]
            done = subprocess.run(argv, input="".join(f"{x}\n" for x in lines), capture_output=True, text=True, env=env, check=False)
            got = done.stdout.split("\n")[:-1]
            if done.returncode or len(got) != len(lines):
                raise ProgramError(f"{argv[0]}: status {done.returncode}, {len(got)} lines for {len(lines)}: {done.stderr.strip()[-300:]}")
            yield b.append_column(out, pa.array(got, pa.string()))

    return df.mapInArrow(run, schema)


def bring(spark: SparkSession, paths: dict[str, str]) -> None:
    """Send programs along with the session's tasks, under their names."""
    folder = tempfile.mkdtemp(prefix="weft-bin-")  # the driver's copy; Spark hands the files to executors
    for name, path in paths.items():
        own = os.path.join(folder, name)
        with open(path, "rb") as src, open(own, "wb") as dst:
            dst.write(src.read())
        spark.sparkContext.addFile(own)


def binary(name: str) -> str:
    """Where a program that was sent along is on this machine; it is made executable."""
    from pyspark import SparkFiles

    path = SparkFiles.get(name)
    mode = os.stat(path).st_mode
    if not mode & 0o100:
        os.chmod(path, mode | 0o755)
    return path
