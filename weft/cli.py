"""Command line over the queries: reports, filters and commands, in any output format.

python -m weft.cli --data FOLDER [--format csv|tsv|json|tabular] [--header] COMMAND [arguments]
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weft import queries, settings
from weft.operators import catalog
from weft.sources import adapter, history

#: Commands that are a query, with the column that names the execution, if there is one.
REPORTS = {
    "workflow.info": ("info_report", "u"),
    "workflow.profile": ("profile", "u"),
    "workflow.tasks": ("status_report", "u"),
    "workflow.history": ("history_cooked", "u"),
    "workflow.list": ("list_executions", "workflow_id"),
    "task.info": ("task_info", "u"),
    "activity.rerun": ("activity_rerun", "run_id"),
    "decider.start": ("stream_decision_polls", "u"),
    "worker.start": ("stream_activity_polls", "u"),
}
#: Commands that write: they are checked against the catalogue and appended to the log.
WRITES = {"workflow.start": "start", "workflow.terminate": "terminate", "workflow.restart": "restart", "workflow.signal": "signal", "workflow.cancel": "request_cancel"}


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="weft", description=__doc__)
    p.add_argument("--data", required=True)
    p.add_argument("--format", default="tabular", choices=("csv", "tsv", "json", "tabular"))
    p.add_argument("--header", action="store_true")
    sub = p.add_subparsers(dest="command", required=True)
    for name in REPORTS:
        c = sub.add_parser(name)
        c.add_argument("id", nargs="?", type=int)
        c.add_argument("--nb-tasks", type=int, default=None)
    c = sub.add_parser("workflow.filter")
    c.add_argument("--status", default="OPEN")
    c.add_argument("--tag")
    c.add_argument("--type-name")
    c.add_argument("--days", type=int, default=None)
    c.add_argument("--close-status")
    for name in WRITES:
        c = sub.add_parser(name)
        c.add_argument("id", nargs="?")
        c.add_argument("--type-name", default="workflow")
        c.add_argument("--type-version", default="1.0")
        c.add_argument("--input")
        c.add_argument("--log", help="folder of the event log that the command is appended to")
    sub.add_parser("info")
    return p


def run(spark: SparkSession, argv: list[str]) -> DataFrame:
    """The result of a command as a table."""
    a = parser().parse_args(argv)
    if a.command == "info":
        return spark.createDataFrame([(k, str(v)) for k, v in settings.load().items()], "name string, value string")
    if a.command in REPORTS:
        name, key = REPORTS[a.command]
        df = queries.QUERIES[name](spark, a.data)
        df = df if a.id is None else df.filter(F.col(key) == a.id)
        return df.limit(a.nb_tasks) if a.nb_tasks else df
    executions = adapter.executions(spark, a.data)
    if a.command == "workflow.filter":
        as_of = executions.agg(F.timestamp_micros(F.max("start_us"))).first()[0]
        dates = {} if a.days is None else {"oldest_date" if a.status == "OPEN" else "start_oldest_date": a.days}
        dates |= {"close_status": a.close_status} if a.close_status else {}
        return catalog.filter_executions(executions, as_of.replace(tzinfo=None), a.status, a.tag, None, a.type_name, **dates)
    now = F.unix_micros(F.current_timestamp())
    row = spark.createDataFrame([(0, WRITES[a.command], a.id, a.type_name, a.type_version, a.input)], "seq long, op string, workflow_id string, type_name string, type_version string, payload string")
    out = catalog.command_events(row.withColumn("us", now), executions)
    if a.log:
        out.filter("fault is null").write.mode("append").parquet(a.log)
    return out


def main(argv: list[str]) -> int:
    spark = SparkSession.builder.getOrCreate()
    a = parser().parse_args(argv)
    df = run(spark, argv)
    lines = history.tabular(df, a.header).orderBy("pos").select("line") if a.format == "tabular" else df.select(history.line_of(df.columns, a.format, a.header).alias("line"))
    if a.header and a.format in ("csv", "tsv"):
        print(("," if a.format == "csv" else "\t").join(df.columns))
    for (line,) in lines.toLocalIterator():
        print(line)
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
