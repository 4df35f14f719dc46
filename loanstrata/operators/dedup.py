"""One row per key, chosen by a total order so that retries and reruns agree.

``min``/``max`` over a struct is an ordinary aggregate: it combines on the map side, so a key that
holds a large part of the table leaves each map task as a single row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanstrata.operators.normalize import quoted

# The end of a packed cell, the mark of a NULL one, and that of any other.
END, _NULL, _VALUE = "\0", "\1", "\2"


def pack(columns: list[Column]) -> Column:
    """Text columns as one text that sorts as they do one after the other, NULL first.

    A cell has neither the end nor the mark of NULL inside: both are written as two characters, in order.
    One long text takes half the bytes of a row of many short ones, to sort, to spill and to shuffle. The
    filter leaves out no cell: its lambda keeps the projection out of whole-stage code, whose one method
    over many columns is too large for the JIT; Spark then splits it into small ones. It has only the first
    cell, for what is below a lambda isn't compiled at all.
    """

    def cell(c: Column) -> Column:
        plain = F.replace(F.replace(c, F.lit("\1"), F.lit("\1\2")), F.lit("\0"), F.lit("\1\1"))
        return F.coalesce(F.concat(F.lit(_VALUE), plain), F.lit(_NULL))

    first, *others = [cell(c) for c in columns]
    return F.concat_ws(END, F.filter(F.array(first), lambda c: c.isNotNull()), *others)


def unpack(cell: Column) -> Column:
    """The value of one of the cells that a text of `pack` has between its ends."""
    plain = F.replace(F.replace(F.substring(cell, 2, 2**31 - 1), F.lit("\1\1"), F.lit("\0")), F.lit("\1\2"), F.lit("\1"))
    return F.when(cell != _NULL, plain)


def keep_one(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keep the smallest row of each key, compared column by column with NULL first."""
    rest = [(c, dtype) for c, dtype in df.dtypes if c not in keys]
    if not rest:
        return df.distinct()
    runs: list[list[str]] = []
    for i, (name, dtype) in enumerate(rest):
        if dtype == "string" and i and rest[i - 1][1] == "string":
            runs[-1].append(name)
        else:
            runs.append([name])
    names = [f"run_{i}" for i in range(len(runs))]
    fields = [
        (pack([F.col(c) for c in quoted(run)]) if len(run) > 1 else F.col(*quoted(run))).alias(name)
        for run, name in zip(runs, names)
    ]
    # packed in a projection of their own, so that already the sort before the aggregate has short rows
    packed = df.select(*quoted(keys), *fields).groupBy(*quoted(keys))
    if len(runs) == 1:
        kept = packed.agg(F.min(names[0]).alias(names[0]))
    else:
        kept = packed.agg(F.min(F.struct(*names)).alias("kept")).select(*quoted(keys), "kept.*")
    split = {n: F.split(n, END, -1).alias(n) for run, n in zip(runs, names) if len(run) > 1}
    cells = kept.select(*quoted(keys), *[split.get(n, F.col(n)) for n in names])
    columns = {
        c: unpack(F.col(name)[j]) if len(run) > 1 else F.col(name)
        for run, name in zip(runs, names)
        for j, c in enumerate(run)
    }
    return cells.select(*[columns[c].alias(c) if c in columns else F.col(*quoted([c])) for c in df.columns])


def latest(df: DataFrame, keys: list[str], *by: str) -> DataFrame:
    """Keep the row of each key with the greatest ``by``; ties go to the greatest remaining row."""
    rest = [c for c in df.columns if c not in keys and c not in by]
    kept = df.groupBy(*keys).agg(F.max(F.struct(*by, *quoted(rest))).alias("kept"))
    return kept.select(*keys, "kept.*").select(quoted(df.columns))
