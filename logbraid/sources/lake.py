"""Tables partitioned by session: landed logs, keyed targets, and rows kept by session."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logbraid.functions.lineage import materialize
from logbraid.operators.normalize import of_sessions
from logbraid.operators.order import in_order
from logbraid.operators.target import collapse
from logbraid.sources.generations import Generations
from logbraid.sources.registry import EVENT_TS, KEY, SEQUENCE, TargetSpec


# The sequence numbers of a block, which is a partition and a file of its own, and its column.
ROWS_PER_BLOCK = 1 << 20
BLOCK = "sequence_block"


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    sessions: Iterable[str] | None = None,
) -> DataFrame:
    """The table at `path`. Named sessions read only their own partitions.

    The schema is declared: nothing is inferred, and a session named 007 stays text.
    """
    df = spark.read.schema(schema).parquet(path).select(*schema.names)
    return df if sessions is None else of_sessions(df, sessions)


def land_log(
    df: DataFrame, path: str, mode: str = "append", numbers: int = ROWS_PER_BLOCK
) -> None:
    """Write a source log, partitioned by session and, within it, by block of `numbers` sequence
    numbers.

    A block goes to one task and into one file, in order, so that a session of any size is written
    by many tasks, and no file or row group of it overlaps another in sequence. Blocks are known
    without sampling, so that `df` is computed once.
    """
    blocked = df.withColumn(BLOCK, F.floor(F.col(SEQUENCE) / numbers))
    placed = blocked.repartition(KEY, BLOCK).sortWithinPartitions(KEY, BLOCK, SEQUENCE)
    placed.write.mode(mode).partitionBy(KEY, BLOCK).parquet(path)


def upsert_by_key(existing: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """`existing` with rows of equal keys replaced by, and other rows added from, `updates`.

    `updates` holds each key once, as from `valid_updates`. Doing it twice changes nothing more.
    """
    kept = existing.join(updates.select(*keys), list(keys), "left_anti")
    return kept.select(*updates.columns).unionByName(updates)


def valid_updates(updates: DataFrame, target: TargetSpec) -> tuple[DataFrame, DataFrame]:
    """(updates that the target can hold, those without a whole key). Of updates with one key
    the first holds one, chosen as `collapse` does."""
    whole = reduce(and_, (F.col(k).isNotNull() for k in target.keys))
    valid = updates.where(whole)
    others = [c for c in target.columns if c not in target.keys]
    sequence = SEQUENCE if SEQUENCE in others else others[0]
    return collapse(valid, target.keys, sequence), updates.where(~whole)


def touched_partitions(
    existing: DataFrame, updates: DataFrame, sessions: Iterable[str] | None = None
) -> DataFrame:
    """`existing` in those sessions alone that are named, or that `updates` hold; only their
    partitions are read."""
    if sessions is not None:
        existing = of_sessions(existing, sessions)
    touched = materialize(updates.select(KEY).distinct(), "touched")
    # Spark prunes partitions by a join if the side with the sessions is small and has a filter.
    return existing.join(touched.where(F.col(KEY) >= ""), KEY, "left_semi")


def read_target(
    spark: SparkSession, path: str, target: TargetSpec, sessions: Iterable[str] | None = None
) -> DataFrame:
    """The keyed target at `path`, as the last write that took effect left it. Named sessions read
    only their own partitions; a target never written is empty."""
    return Generations(spark, path, target.schema).read(sessions)


def upsert_table(
    spark: SparkSession,
    path: str,
    updates: DataFrame,
    target: TargetSpec,
    sessions: Iterable[str] | None = None,
    is_table: bool = False,
) -> DataFrame:
    """Upsert into the target at `path`, in order of event time within each session, and return
    the updates refused: those without a whole key.

    The write takes effect all at once or, if it stops before its end, not at all. Only partitions
    of sessions in `updates` are read and written anew; `sessions` may name them, or more, so that
    they are known before anything is read. `updates` are computed once; those that are read from
    a table (`is_table`) aren't written once more for that. Raises OtherWrite if another write
    took effect meanwhile.
    """
    updates = updates.select(*target.columns)
    updates = updates if is_table else materialize(updates, "updates")
    table = Generations(spark, path, target.schema)
    version = table.version()
    new, refused = valid_updates(updates, target)
    touched = materialize(new.select(KEY).distinct(), "touched")
    merged = new
    if version:
        existing = touched_partitions(table.read(version=version), touched, sessions)
        merged = upsert_by_key(existing, new, target.keys)
    table.replace(merged, [KEY, EVENT_TS], touched, version)
    return refused


def replace_sessions(
    spark: SparkSession,
    path: str,
    rows: DataFrame,
    sessions: Iterable[str] | None = None,
    order: Sequence[str] = (KEY, SEQUENCE),
) -> None:
    """Put `rows`, read from a table, in the place of all that the table at `path` has of the
    named sessions, or of all it has, at once. A session without rows has none then."""
    named = None
    if sessions is not None:
        named = spark.createDataFrame([(s,) for s in sessions], f"`{KEY}` string")
    Generations(spark, path, rows.schema).replace(rows, list(order), named)


def read_kept(
    spark: SparkSession, path: str, schema: T.StructType, sessions: Iterable[str] | None = None
) -> DataFrame:
    """What `replace_sessions` has put at `path`."""
    return Generations(spark, path, schema).read(sessions)
