"""Running a batch table by table, with an audit row for each."""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltwork.sources.warehouse import Warehouse

ALL_TABLES = "(all tables)"
AUDIT_SCHEMA = (
    "batch_id int, layer string, table_name string, started timestamp_ntz, ended timestamp_ntz, "
    "seconds bigint, rows bigint, rejects bigint, status string, error string, "
    "error_condition string, sql_state string"
)


class LoadFailed(RuntimeError):
    """A table could not be loaded; later tables were skipped."""


@dataclass(frozen=True)
class Loaded:
    """A table's batch, written and counted but not published."""

    rows: int
    rejects: int
    path: str
    ddl: str | None = None


def now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def batch_tag(batch_id: int) -> str:
    """Names the files of one run, so that a repeated batch never overwrites any."""
    return f"{batch_id}_{time.time_ns()}"


def run_batch(
    warehouse: Warehouse,
    layer: str,
    batch_id: int,
    loads: Mapping[str, Callable[[], Loaded]],
    on_error: str = "raise",
    at_once: int = 1,
    whole: bool = False,
) -> DataFrame:
    """Run ``loads``, publish their batches in order and return the batch's audit rows.

    Up to ``at_once`` tables are loaded at the same time. A load only writes, so tables
    are published in their order and as if loaded one after the other: after a failure
    the remaining ones are skipped, what they have written stays unpublished, and tables
    before keep their new batch. With ``whole`` no table is published until all are
    loaded, and then all in one step; a failure withholds those loaded before, too.
    ``on_error="raise"`` then raises once the audit is written, ``"record"`` returns
    normally.
    """
    if on_error not in ("raise", "record"):
        raise ValueError("on_error is 'raise' or 'record'")
    if at_once < 1:
        raise ValueError("at_once is 1 or more")
    audit, failure, waiting = [], None, {}

    def record(table: str, status: str, **details) -> None:
        audit.append(
            {"batch_id": batch_id, "layer": layer, "table_name": table, "status": status, **details}
        )

    batch_started = now()
    tables = list(loads)
    # Jobs keep the caller's local properties, its scheduler pool and description among them.
    inherited = inheritable_thread_target(warehouse.spark)
    with ThreadPoolExecutor(at_once) as pool:
        running = {}
        for i, table in enumerate(tables):
            if failure is not None:
                record(table, "SKIPPED")
                continue
            for t in tables[i : i + at_once]:
                if t not in running:
                    running[t] = pool.submit(inherited(_timed), loads[t])
            started, ended, loaded, error = running[table].result()
            if error is None:
                try:
                    if whole:
                        waiting[table] = (loaded.path, loaded.ddl)
                    else:
                        warehouse.publish(layer, table, loaded.path, loaded.ddl)
                except Exception as unpublished:  # noqa: BLE001 - recorded, raised again below
                    error = unpublished
            if error is not None:
                failure = error
                record(table, "FAILED", started=started, ended=ended, **_describe(error))
                continue
            counts = {"rows": loaded.rows, "rejects": loaded.rejects}
            record(table, "SUCCEEDED", started=started, ended=ended, **counts)
    if whole and failure is None:
        try:
            warehouse.publish_together(layer, waiting)
        except Exception as error:  # noqa: BLE001 - raised again below
            failure = error
    if whole and failure is not None:
        for row in audit:
            if row["status"] == "SUCCEEDED":
                row["status"] = "WITHHELD"
    status = "SUCCEEDED" if failure is None else "FAILED"
    record(ALL_TABLES, status, started=batch_started, ended=now())
    rows = _with_seconds(warehouse.spark.createDataFrame(audit, AUDIT_SCHEMA))
    rows.coalesce(1).write.mode("append").parquet(audit_path(warehouse))
    if failure is not None and on_error == "raise":
        raise LoadFailed(f"{layer} batch {batch_id}: {failure}") from failure
    return rows


def _timed(load: Callable[[], Loaded]):
    """When a load began and ended, what it loaded, or why it failed."""
    started = now()
    try:
        loaded = load()
        return started, now(), loaded, None
    except Exception as error:  # noqa: BLE001 - recorded by the caller, and raised again
        return started, now(), None, error


def audit_path(warehouse: Warehouse) -> str:
    return f"{warehouse.root}/{warehouse.prefix}load_audit"


def read_audit(warehouse: Warehouse) -> DataFrame:
    """Audit rows of all batches."""
    return warehouse.spark.read.schema(AUDIT_SCHEMA).parquet(audit_path(warehouse))


def _with_seconds(audit: DataFrame) -> DataFrame:
    """Duration as second boundaries crossed between start and end."""

    def epoch(name: str):
        whole = F.date_trunc("second", F.col(name))
        return F.unix_seconds(whole.cast("timestamp"))

    return audit.withColumn("seconds", epoch("ended") - epoch("started"))


def _describe(error: Exception) -> dict[str, str | None]:
    if isinstance(error, PySparkException):
        condition, state = error.getCondition(), error.getSqlState()
    else:
        condition, state = type(error).__name__, None
    return {"error": str(error), "error_condition": condition, "sql_state": state}
