"""Full refresh of the bronze layer from delimited extracts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from siltwork.plans.load_job import Loaded, batch_tag, run_batch
from siltwork.schemas import SPECS, TABLES
from siltwork.sources.delimited import RejectLimitExceeded, stage_delimited
from siltwork.sources.warehouse import Warehouse

MAX_REJECTS = 10


def load_bronze(
    warehouse: Warehouse,
    extracts: Mapping[str, str | list[str]],
    batch_id: int,
    max_rejects: int = MAX_REJECTS,
    on_error: str = "raise",
    check_header: bool = False,
    at_once: int = 1,
    whole: bool = False,
) -> DataFrame:
    """Replace each bronze table by its extract, CRM tables first, then ERP.

    ``extracts`` gives the path, or paths, of the files for each table to load.
    A table is only replaced once its whole extract is written and no more than
    ``max_rejects`` lines were bad. Columns bind by position; ``check_header`` demands
    that each file's header names them. ``at_once`` and ``whole`` as in ``run_batch``.
    """
    unknown = set(extracts) - set(TABLES)
    if unknown:
        raise ValueError(f"unknown tables: {sorted(unknown)}")
    warehouse.create_layers()
    tag = batch_tag(batch_id)

    def load(table: str) -> Loaded:
        staged = stage_delimited(
            warehouse.spark,
            extracts[table],
            SPECS[table].declared("bronze"),
            warehouse.batch_path("bronze", table, tag),
            check_header=check_header,
        )
        if staged.rejected > max_rejects:
            raise RejectLimitExceeded(
                f"{table}: {staged.rejected} bad lines, limit {max_rejects}"
            )
        return Loaded(staged.rows, staged.rejected, staged.good_path)

    loads = {t: (lambda t=t: load(t)) for t in TABLES if t in extracts}
    return run_batch(warehouse, "bronze", batch_id, loads, on_error, at_once, whole)
