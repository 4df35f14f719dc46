"""Column-name and text normalisation of a whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanstrata.functions.text import normalize_text


def normal_name(name: str) -> str:
    """Column name in lower case, trimmed, with spaces and hyphens as underscores (a fixed rule)."""
    return name.strip().lower().replace(" ", "_").replace("-", "_")


def quoted(names: list[str]) -> list[str]:
    """Column names in backticks, so that a point in a name is part of it."""
    return [f"`{name}`" for name in names]


def normalize_names(df: DataFrame) -> DataFrame:
    """Give all columns their normal names; names that collide are an error."""
    names = [normal_name(c) for c in df.columns]
    if len(set(names)) != len(names):
        raise ValueError(f"column names collide after normalisation: {sorted(names)}")
    return df.toDF(*names)


def normalize_strings(df: DataFrame) -> DataFrame:
    """Trim and lower-case every string column in one projection."""
    return df.select(
        *[
            normalize_text(F.col(f"`{name}`")).alias(name) if dtype == "string" else F.col(f"`{name}`")
            for name, dtype in df.dtypes
        ]
    )
