"""Bronze: the raw rows of the requested snapshots with a typed snapshot date."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanstrata.operators.normalize import normal_name
from loanstrata.schemas import SNAPSHOT


def dated(raw: DataFrame) -> DataFrame:
    """Raw rows with blank cells as NULL and ``snapshot_date`` as a date, NULL where unreadable."""
    columns = []
    for name, dtype in raw.dtypes:
        cell = F.col(f"`{name}`")
        if dtype == "string":
            cell = F.nullif(cell, F.lit(""))
        if normal_name(name) == SNAPSHOT:
            columns.append((F.trim(cell) if dtype == "string" else cell).try_cast("date").alias(SNAPSHOT))
        else:
            columns.append(cell.alias(name))
    return raw.select(*columns)


def bronze_rows(raw: DataFrame, snapshots: Sequence[date] | None = None) -> DataFrame:
    """Rows of the given snapshots, or of every readable one."""
    rows = dated(raw)
    if snapshots is None:
        return rows.where(F.col(SNAPSHOT).isNotNull())
    return rows.where(F.col(SNAPSHOT).isin(list(snapshots)))
