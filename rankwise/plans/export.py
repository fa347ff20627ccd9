"""K3: compute and store every result table of the contract."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, Row

from rankwise.functions.contracts import RESULT_SOURCES, check_contract
from rankwise.functions.materialize import workspace
from rankwise.functions.shared import sharing
from rankwise.plans.domain import Views, write_views
from rankwise.plans.registry import ANALYSES

Sink = Callable[[DataFrame, str], None]
ReadBack = Callable[[str], DataFrame]


def export_all(views, sink: Sink, tables: list[str] | None = None,
               stage_dir: str | None = None, read_back: ReadBack | None = None) -> dict[str, Row | None]:
    """Write each result table with ``sink(df, table)``; returns, by name, the
    contract report of the stored table (``check_contract`` of what
    ``read_back(table)`` reads; None without ``read_back``).

    Every result is one Spark job; no scalar passes through the driver
    between jobs (the reference ran 48 actions for 24 tables).  Views derived
    from the star-schema sources are first written once (``write_views``), so
    the 24 results read the ranked tables instead of 24 derivations: to
    ``stage_dir``, which stays, or to the job's workspace, which like all
    other intermediate tables is removed at the end.  Counts of a list by an
    item that several results need are taken once (``sharing``).
    """
    spark = views.artists.sparkSession
    done: dict[str, Row | None] = {}
    with workspace(spark) as work, sharing():
        if isinstance(views, Views):
            views = write_views(views, stage_dir or os.path.join(work, "views"))
        for table in tables or list(RESULT_SOURCES):
            sink(ANALYSES[RESULT_SOURCES[table]](views), table)
            done[table] = check_contract(read_back(table), table).first() if read_back else None
    return done
