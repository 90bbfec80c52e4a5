"""Fusing logs into one record per moment of the spine.

`fuse` keeps every combination of matches. `fuse_latest` gives directly the one record per
moment that a target keyed by session and event time can hold, without forming the
combinations first, and for all sessions and spines at once. It chooses partners on narrow rows
first, sessions, logs and times alone; only rows chosen then meet, with all their columns.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logbraid.functions.names import field, first_value, quoted
from logbraid.functions.times import bucket, in_micros, micros
from logbraid.operators.bandjoin import star_band_join

# A bucket of the fusing shuffle is this many band widths long; its last band is copied into
# the next bucket, so 1/8 of the rows travel twice.
BANDS_PER_BUCKET = 8


def fuse(
    main: DataFrame,
    others: Mapping[str, DataFrame],
    keys: Sequence[str],
    ts: str,
    tolerance: timedelta,
    most_rows: int | None = None,
) -> DataFrame:
    """The band star with same-named columns coalesced: main first, then `others` in order.

    An empty string counts as a value. A column only one log has passes through. The result
    holds the product of each row's matches in all logs; no job uses it. `most_rows` refuses a
    larger one, as in `star_band_join`.
    """
    star = star_band_join(main, others, keys, ts, tolerance, most_rows)
    holders: dict[str, list[str]] = {
        c: [quoted(c)] for c in main.columns if c not in (*keys, ts)
    }
    for name, other in others.items():
        for c in other.columns:
            if c not in (*keys, ts):
                holders.setdefault(c, []).append(quoted(f"{name}__{c}"))
    return star.selectExpr(
        *map(quoted, (*keys, ts)), *(first_value(held, c) for c, held in holders.items())
    )


def pack(name: str, columns: Sequence[str]) -> str:
    """SQL for a row of the log `name` as one struct that orders as its columns do,
    ascending with NULLs last.

    Wide rows travel packed: moved column by column through sorts and windows, dozens of
    columns make generated code too long for the JVM to compile.
    """
    pairs = (f"isnull({quoted(c)}) AS {quoted('no ' + c)}, {quoted(c)}" for c in columns)
    return f"struct({', '.join(pairs)}) AS {quoted('log_' + name)}"


def unpack(columns: Mapping[str, Sequence[str]], spine: Mapping[str, str] | None = None) -> list[str]:
    """SQL for each column of any log: the first value in declared order; that of the log whose
    SQL condition in `spine` holds before all others."""
    holders: dict[str, list[str]] = {}
    for name, cols in columns.items():
        for c in cols:
            holders.setdefault(c, []).append(name)

    def values(c: str, names: list[str]) -> list[str]:
        held = [field(f"log_{n}", c) for n in names]
        if spine is None or len(names) == 1:
            return held
        cases = " ".join(f"WHEN {spine[n]} THEN {value}" for n, value in zip(names, held))
        return [f"CASE {cases} END", *held]

    return [first_value(values(c, names), c) for c, names in holders.items()]


def latest_partners(
    instants: DataFrame,
    names: Sequence[str],
    keys: Sequence[str],
    ts: str,
    source: str,
    is_main: str,
    tolerance: timedelta,
    latest_by: Sequence[str] = (),
) -> DataFrame:
    """Which row serves which moment of the spine: (keys, `moment`, `main`, then the row's own
    columns).

    `instants` are narrow: keys, `ts`, `source`, `is_main` and what else tells a row, one per
    keys, log and instant, or several of which the highest by `latest_by` counts. A moment has its
    own row of the log `main`, and of every other log the latest within its band.

    All logs meet in one shuffle on (bucket of time, keys). Within a bucket, ordered by time,
    the latest instant of each log so far is carried along; a spine row stands at the end of its
    band, ts + tolerance, and takes what has been carried there unless it is older than
    ts - tolerance. `ts` is a TIMESTAMP_NTZ or the microseconds of one. With one row per log and instant a bucket's size is bounded by the clock's
    resolution, the number of logs and the tolerance, and not by the data.
    """
    reach = in_micros(tolerance)
    band = max(2 * reach, 1)
    width = BANDS_PER_BUCKET * band
    counted = instants.schema[ts].dataType == T.LongType()
    at, main = F.col(ts) if counted else micros(F.col(ts)), F.col(is_main)
    earliest = F.col(ts) - F.lit(reach if counted else tolerance)
    own_columns = [c for c in instants.columns if c not in (*keys, source, is_main)]

    placed = instants.withColumn("__position", F.when(main, at + F.lit(reach)).otherwise(at))
    own = bucket(F.col("__position"), width)
    in_last_band = F.pmod(F.col("__position"), F.lit(width)) >= F.lit(width - band)
    buckets = F.when(~main & in_last_band, F.array(own, own + F.lit(width))).otherwise(F.array(own))
    ordered = Window.partitionBy("__bucket", *keys).orderBy("__position", is_main, *latest_by)
    in_time = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    stands = F.struct("__position", is_main)
    not_last = F.coalesce(F.lead(stands).over(ordered) == stands, F.lit(False))

    def latest(name: str) -> Column:
        of_log = F.when((F.col(source) == name) & ~main, F.struct(*own_columns))
        return F.last(of_log, ignorenulls=True).over(in_time).alias(f"__last_{name}")

    def as_partner(name: str, row: Column) -> Column:
        return F.struct(F.lit(name).alias(source), *(row[c].alias(c) for c in own_columns))

    # The shuffle is asked for here, as the window's own would come after the structs it carries.
    dealt = placed.withColumn("__bucket", F.explode(buckets)).repartition("__bucket", *keys)
    carried = dealt.select(
        *instants.columns, *map(latest, names), not_last.alias("__not_last")
    )
    itself = F.struct(source, *own_columns)
    near = [
        F.when(
            F.col(f"__last_{n}")[ts] >= earliest,
            as_partner(n, F.col(f"__last_{n}")),
        )
        for n in names
    ]
    moments = carried.where(main & ~F.col("__not_last")).select(
        *keys,
        F.col(ts).alias("moment"),
        F.col(source).alias("main"),
        F.explode(F.array_compact(F.array(itself, *near))).alias("__partner"),
    )
    return moments.select(*keys, "moment", "main", "__partner.*")


def fuse_chosen(
    rows: DataFrame,
    partners: DataFrame,
    columns: Mapping[str, Sequence[str]],
    keys: Sequence[str],
    same_row: Sequence[tuple[str, str]],
    ts: str,
    source: str,
    sources: Sequence[str | int] | None = None,
) -> DataFrame:
    """One record per moment out of the `rows` that `partners` choose.

    `rows` have keys, `source` and `log_<name>`, the columns of each log packed; `same_row`
    pairs their columns that, with keys and source, tell a row with those of `partners`. Of
    several rows told alike the least is taken, once per task before they travel. Values are
    coalesced from the spine, then in declared order, and `source` names the spine. `sources` are
    what `source` has for each log of `columns`, by default their names.
    """
    renamed = partners.withColumnsRenamed({c: f"__{c}" for c in partners.columns})
    alike = [F.col(k) == F.col(f"__{k}") for k in (*keys, source)]
    alike += [F.col(a).eqNullSafe(F.col(f"__{b}")) for a, b in same_row]
    chosen = rows.join(renamed, alike)
    # A log is either the spine of a moment or near to it, so one struct per log is enough.
    # Flags that order NULLs have done their work then, and stay behind.
    best = [F.min(f"log_{n}").alias(f"log_{n}") for n in columns]
    is_spine = {
        n: f"{quoted(source)} = {value!r}" for n, value in zip(columns, sources or columns)
    }
    fused = chosen.groupBy(
        *(F.col(f"__{k}").alias(k) for k in keys),
        F.col("__moment").alias(ts),
        F.col("__main").alias(source),
    ).agg(*best)
    return fused.selectExpr(
        *map(quoted, (*keys, ts)), *unpack(columns, is_spine), quoted(source)
    )


def fuse_latest(
    rows: DataFrame,
    columns: Mapping[str, Sequence[str]],
    keys: Sequence[str],
    ts: str,
    source: str,
    is_main: str,
    tolerance: timedelta,
) -> DataFrame:
    """One record per spine row, fused with the latest row in its band of every other log.

    `rows` are those of all logs, at most one per keys, `ts` and `source`, all with `ts`.
    Those of their session's spine have `is_main` true. `columns` has, per log in declared
    order, its columns, which are packed in `log_<name>`; other logs' structs are NULL.
    """
    partners = latest_partners(
        rows.select(*keys, ts, source, is_main), list(columns), keys, ts, source, is_main, tolerance
    )
    return fuse_chosen(rows, partners, columns, keys, [(ts, ts)], ts, source)
