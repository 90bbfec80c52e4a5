"""Which logs have rows for a session, how many, and which of them is the spine."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logbraid.operators.normalize import of_sessions
from logbraid.sources.registry import KEY


def source_counts(
    sources: Mapping[str, DataFrame], sessions: Iterable[str] | None = None, key: str = KEY
) -> DataFrame:
    """(key, source, n) for every session and log with rows: one job for all of them.

    Counts are summed per scan task first, so a large session is no large group.
    """
    wanted = None if sessions is None else list(sessions)
    tagged = [
        of_sessions(df, wanted, key).select(key, F.lit(name).alias("source"))
        for name, df in sources.items()
    ]
    return (
        reduce(DataFrame.unionByName, tagged)
        .groupBy(key, "source")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def choose_main(
    counts: DataFrame, declared: Sequence[str] | Sequence[int], key: str = KEY
) -> DataFrame:
    """(key, main): the log with the fewest rows; on a tie the one declared first."""
    position = F.array_position(F.array(*map(F.lit, declared)), F.col("source"))
    return counts.groupBy(key).agg(
        F.min_by("source", F.struct(F.col("n"), position)).alias("main")
    )
