"""Frame helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parsed_once(df: DataFrame, keep: list[str], columns: dict[str, Column]) -> DataFrame:
    """Select ``keep`` and ``columns``, computing the latter exactly once per row.

    A filter on a plain computed column is pushed below it and evaluates the
    column again; a one-element ``inline`` stops that, which pays for parsing.
    """
    row = F.struct(*[value.alias(name) for name, value in columns.items()])
    return df.select(*[F.col(f"`{c}`") for c in keep], F.inline(F.array(row)))
