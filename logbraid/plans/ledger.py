"""Integrating session by session, so that a run that stops doesn't repeat what is done.

Each step integrates some sessions, writes their rows and rejects, and then enters them in the
ledger with a fingerprint of the files that their logs were read from. A run begins by comparing:
sessions whose files are as entered are done, others, and those whose files changed since, are not.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logbraid.functions.lineage import materialize, scratch
from logbraid.operators.normalize import of_sessions
from logbraid.plans.integrate import Integration, integrate
from logbraid.sources.generations import Generations
from logbraid.sources.lake import read_table, replace_sessions, upsert_table
from logbraid.sources.registry import KEY, TargetSpec

log = logging.getLogger(__name__)

ENTRIES = T.StructType(
    [
        T.StructField(KEY, T.StringType()),
        T.StructField("files", T.LongType()),
        T.StructField("fingerprint", T.LongType()),
    ]
)
SESSIONS_PER_STEP = 100


def fingerprints(
    spark: SparkSession,
    tables: str,
    target: TargetSpec,
    sessions: Iterable[str] | None = None,
) -> DataFrame:
    """(session, files, fingerprint): of the files under `tables` that hold rows of a session, in
    any log of the target, how many there are, and a number made of their logs, names, sizes and
    times. No column is read but the session, which is in the files' paths."""
    sessions = None if sessions is None else list(sessions)
    named = []
    for source in target.sources:
        rows = spark.read.schema(source.schema).parquet(f"{tables}/{source.name}")
        named.append(
            of_sessions(rows, sessions)
            .select(
                KEY,
                F.lit(source.name).alias("log"),
                F.col("_metadata.file_path").alias("file"),
                F.col("_metadata.file_size").alias("size"),
                F.col("_metadata.file_modification_time").alias("written"),
            )
            .distinct()
        )
    one = F.xxhash64("log", "file", "size", "written")
    return (
        reduce(DataFrame.unionByName, named)
        .groupBy(KEY)
        .agg(F.count(F.lit(1)).alias("files"), F.bit_xor(one).alias("fingerprint"))
    )


def to_do(found: DataFrame, entered: DataFrame) -> DataFrame:
    """Those of `found` that aren't entered as they are now."""
    return found.join(entered, found.columns, "left_anti")


def integrate_in_steps(
    spark: SparkSession,
    target: TargetSpec,
    tables: str,
    into: str,
    sessions: Sequence[str] | None = None,
    per_step: int = SESSIONS_PER_STEP,
    job: Callable[..., Integration] = integrate,
) -> list[str]:
    """Integrate the landed logs under `tables` into the targets under `into`, some sessions at a
    time, and return the sessions that were integrated now.

    `<target>`, `<target>_rejected` and `<target>_ledger` are written, each all at once. A step
    that stops before its entry is done again on the next run, which replaces what it had written.
    One name per session is held by the driver, as in the tables' own lists of partitions.
    """
    ledger = Generations(spark, f"{into}/{target.name}_ledger", ENTRIES)
    done: list[str] = []
    with scratch(spark):
        found = materialize(fingerprints(spark, tables, target, sessions), "fingerprints")
        left = sorted(r[0] for r in to_do(found, ledger.read()).select(KEY).collect())
    log.info("%s: %d sessions to integrate", target.name, len(left))
    for first in range(0, len(left), per_step):
        step = left[first : first + per_step]
        with scratch(spark):
            # As they are before their rows are read: files that come meanwhile are seen next time.
            entry = materialize(fingerprints(spark, tables, target, step), "entry")
            read = lambda name: read_table(spark, f"{tables}/{name}", _layout(target, name), step)
            result = job(target, read, step)
            rows = materialize(result.rows, "rows")
            rejected = materialize(result.rejected, "rejected")
            upsert_table(spark, f"{into}/{target.name}", rows, target, step, is_table=True)
            replace_sessions(spark, f"{into}/{target.name}_rejected", rejected, step)
            ledger.replace(entry, [KEY], entry.select(KEY))
        done += step
    return done


def _layout(target: TargetSpec, name: str) -> T.StructType:
    return next(s.schema for s in target.sources if s.name == name)
