"""Output in order of time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logbraid.functions.lineage import materialize

# Fixed value: `monotonically_increasing_id` keeps a row's place in its partition in the low 33 bits.
_PLACE_BITS = 33


def in_order(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """`df` range-partitioned and sorted, so that its files follow each other in order.

    A session of any size spreads over several files.
    """
    return df.repartitionByRange(*columns).sortWithinPartitions(*columns)


def with_rank(df: DataFrame, columns: Sequence[str], into: str = "rank") -> DataFrame:
    """`df` with the 1-based place of each row in the whole order by `columns`.

    Places are counted within the partitions of a distributed sort; only one count per
    partition meets in one task.
    """
    placed = materialize(
        df.orderBy(*columns).withColumn("__at", F.monotonically_increasing_id()), "ordered"
    )
    part = F.shiftright("__at", _PLACE_BITS)
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(part.alias("__part"))
        .count()
        .select("__part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__offset"))
    )
    # One row per partition of the sort, so the side is as small as the partition count.
    place = F.col("__at").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    return (
        placed.withColumn("__part", part)
        .join(F.broadcast(offsets), "__part")
        .withColumn(into, F.col("__offset") + place + 1)
        .drop("__at", "__part", "__offset")
    )
