"""Carrying a caller's columns through an operator without their names meeting its own."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logbraid.functions.names import quoted

# ASCII white space, and the letters whose case is folded.
WHITE_SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def row_of(df: DataFrame, columns: Sequence[str]) -> Column:
    """These columns of `df` as one struct `row`."""
    fields = [df[quoted(c)] for c in columns] or [F.lit(0).alias("nothing")]
    return F.struct(*fields).alias("row")


def packed(df: DataFrame, **own: Column) -> DataFrame:
    """The row of `df` as one struct `row`, beside columns of the operator's own."""
    return df.select(row_of(df, df.columns), *(c.alias(name) for name, c in own.items()))


def unpacked(df: DataFrame, columns: Sequence[str], results: Sequence[str]) -> DataFrame:
    """The caller's `columns` out of `row`, then `results`, which replace equal names."""
    taken = {r.lower() for r in results}
    kept = [F.col("row")[c].alias(c) for c in columns if c.lower() not in taken]
    return df.select(*kept, *results)


def words_in(text: Column) -> Column:
    """How many runs of anything but ASCII white space there are; NULL has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")
