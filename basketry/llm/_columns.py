"""Helper columns beside a caller's table, whatever its columns are called."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def free(name: str, taken: Iterable[str]) -> str:
    """``name``, with as many underscores behind it as it takes to differ from ``taken`` (case aside)."""
    known = {t.lower() for t in taken}
    while name.lower() in known:
        name += "_"
    return name


def packed(df: DataFrame, **columns: Column) -> DataFrame:
    """``row``, a struct of all columns of ``df``, and ``columns``: no name of the caller's meets one of ours."""
    names = [F.col(f"`{name.replace('`', '``')}`") for name in df.columns]
    return df.select(F.struct(*names).alias("row"), *[c.alias(name) for name, c in columns.items()])
