"""Left join on keys and on times at most a tolerance apart, keeping every match."""

from __future__ import annotations

import logging
import re
from collections.abc import Mapping, Sequence
from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logbraid.functions.times import bucket, in_micros, micros

log = logging.getLogger(__name__)

# Stands for a missing time in the microseconds that bands are compared by; no time is as early.
NO_TIME = -(1 << 63)

# Rows of one log that are put together in a star, and the combinations of such rows of all other
# logs that a moment may meet at once. They bound memory, and decide nothing else.
MOST_IN_CHUNK = 128
MOST_COMBINATIONS = MOST_IN_CHUNK**2

# What rows of a star must share: the bucket, which sorts fast, and the keys as one value that may
# hold NULLs and still equals another.
GROUP = ("__bucket", "__keys")


def band_left_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    ts: str,
    tolerance: timedelta,
    right_ts: str | None = None,
    instants: DataFrame | None = None,
) -> DataFrame:
    """Rows of `left` with every row of `right` of equal keys whose `right_ts` lies within
    [ts - tolerance, ts + tolerance]; rows without a match once, with NULLs.

    The keys and `right_ts` of `right` are not in the result; its other columns must not
    clash with those of `left`. `instants` may name a cheaper frame with the same distinct
    keys and `ts` as `left`.

    Time is cut into buckets of twice the tolerance. A left row is in one bucket; a right row
    goes to the two its band touches, so each match is met once and the join is an equi-join.
    It is an inner join, as AQE can split a hot bucket on either side of that and only on the
    left of an outer one: the right side first gets an empty partner for each left instant
    that has none. Both ends of a band are numbers by then, so that a pair of rows costs two
    comparisons; an empty partner's band is its own instant, which no other of its bucket shares.
    """
    right_ts = right_ts or ts
    reach = in_micros(tolerance)
    width = max(2 * reach, 1)
    step = F.lit(width)
    payload = [c for c in right.columns if c not in (*keys, right_ts)]

    partners = right.where(F.col(right_ts).isNotNull())
    for k in keys:
        partners = partners.where(F.col(k).isNotNull())
    at = micros(F.col(right_ts))
    first, last = at - F.lit(reach), at + F.lit(reach)
    partners = partners.select(
        *(F.col(k).alias(f"__{k}") for k in keys),
        first.alias("__from"),
        last.alias("__to"),
        *payload,
        F.explode(F.sequence(bucket(first, width), bucket(last, width), step)).alias(
            "__right_bucket"
        ),
    )

    def placed(df: DataFrame) -> DataFrame:
        us = micros(F.col(ts))
        return df.withColumns(
            {"__us": F.coalesce(us, F.lit(NO_TIME)), "__bucket": bucket(us, width)}
        )

    same_group = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    same_bucket = F.col("__bucket").eqNullSafe(F.col("__right_bucket"))
    in_band = F.col("__us").between(F.col("__from"), F.col("__to"))

    asked = (left if instants is None else instants).select(*keys, ts).distinct()
    known = partners.select(
        *(f"__{k}" for k in keys), "__from", "__to", "__right_bucket"
    ).distinct()
    lonely = placed(asked).join(known, [*same_group, same_bucket, in_band], "left_anti").select(
        *(F.col(k).alias(f"__{k}") for k in keys),
        F.col("__us").alias("__from"),
        F.col("__us").alias("__to"),
        F.col("__bucket").alias("__right_bucket"),
    )
    sides = partners.unionByName(lonely, allowMissingColumns=True)
    return placed(left).join(sides, [*same_group, same_bucket, in_band], "inner").select(
        *left.columns, *payload
    )


class StarTooLarge(ValueError):
    """A star of band joins would have more rows than allowed."""


def star_sizes(
    main: DataFrame,
    others: Mapping[str, DataFrame],
    keys: Sequence[str],
    ts: str,
    tolerance: timedelta,
) -> DataFrame:
    """(keys, rows): how many rows `star_band_join` would have per group, without forming them.

    Rows are counted per instant first; a moment's matches in each log are then summed from the
    counts of that log's instants, and multiplied. So the work grows with pairs of instants, never
    with the product over the logs. Exact up to 2 to the power 53.
    """
    moments = main.groupBy(*keys, ts).agg(F.count(F.lit(1)).cast("double").alias("__matches"))
    factors = [moments]
    for other in others.values():
        counts = other.groupBy(*keys, ts).agg(F.count(F.lit(1)).alias("__n"))
        met = band_left_join(moments.select(*keys, ts), counts, keys, ts, tolerance)
        matches = F.coalesce(F.sum("__n"), F.lit(1)).cast("double")
        factors.append(met.groupBy(*keys, ts).agg(matches.alias("__matches")))
    of_moment = reduce(DataFrame.unionByName, factors).groupBy(*keys, ts)
    products = of_moment.agg(F.product("__matches").alias("__rows"))
    return products.groupBy(*keys).agg(F.sum("__rows").alias("rows"))


def refuse_large_star(sizes: DataFrame, most_rows: int) -> float:
    """The rows of all groups of `star_sizes`, logged; raises StarTooLarge if they are more than
    `most_rows`, and names the largest group."""
    total, largest = sizes.agg(
        F.coalesce(F.sum("rows"), F.lit(0.0)),
        F.max_by(F.struct(*(c for c in sizes.columns)), "rows"),
    ).collect()[0]
    log.info("The star of band joins has %.0f rows, at most %d allowed", total, most_rows)
    if total > most_rows:
        raise StarTooLarge(f"{total:.0f} rows, most of them of {largest.asDict()}")
    return total


def _sortable(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """The `columns` but those whose type has no order."""
    unordered = re.compile(r"map<|variant|interval(?! [a-z])")
    return [c for c in columns if not unordered.search(df.schema[c].dataType.simpleString())]


def _sides(
    moments: DataFrame, right: DataFrame, keys: Sequence[str], ts: str, reach: int, width: int
) -> DataFrame:
    """Rows of `right` per bucket their band touches, with both ends of it, and an empty partner,
    whose band is its own instant, once for each of the `moments` that has none.

    One shuffle by `GROUP` and one order tell that: a moment has a partner if the latest end of
    a band begun so far is not before it.
    """
    payload = [c for c in right.columns if c not in (*keys, ts)]
    partners = right.where(F.col(ts).isNotNull())
    for k in keys:
        partners = partners.where(F.col(k).isNotNull())
    at = micros(F.col(ts))
    first, last = at - F.lit(reach), at + F.lit(reach)
    touched = F.sequence(bucket(first, width), bucket(last, width), F.lit(width))
    partners = partners.select(
        F.explode(touched).alias("__bucket"),
        F.struct(*keys).alias("__keys"),
        first.alias("__from"),
        last.alias("__to"),
        F.lit(False).alias("__asked"),
        *payload,
    )
    asked = moments.select(
        *GROUP,
        F.col("__us").alias("__from"),
        F.col("__us").alias("__to"),
        F.lit(True).alias("__asked"),
    )
    in_order = Window.partitionBy(*GROUP).orderBy(
        "__from", "__asked", *_sortable(right, payload)
    )
    so_far = in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    instant = F.struct("__from", "__asked")
    reached = F.max(F.when(~F.col("__asked"), F.col("__to"))).over(so_far)
    both = partners.unionByName(asked, allowMissingColumns=True).withColumns(
        {
            "__met": F.coalesce(reached >= F.col("__from"), F.lit(False)),
            "__again": F.coalesce(F.lag(instant).over(in_order) == instant, F.lit(False)),
        }
    )
    lonely = ~F.col("__met") & ~F.col("__again")
    return both.where(~F.col("__asked") | lonely).drop("__met", "__again")


def _in_chunks(
    rows: DataFrame, order: Sequence[str], size: int, first: str, last: str, row: Column
) -> DataFrame:
    """(group, chunk, first, last, rows): at most `size` rows of a group in one array, in order of
    time; the least of `first` and the latest of `last` among them.

    `order` names all columns that can be sorted by, so that a task run again forms the same chunks.
    """
    in_order = Window.partitionBy(*GROUP).orderBy(*order)
    chunk = F.floor((F.row_number().over(in_order) - 1) / F.lit(size))
    return rows.withColumn("__chunk", chunk).groupBy(*GROUP, "__chunk").agg(
        F.min(first).alias("__first"), F.max(last).alias("__last"), F.collect_list(row).alias("__rows")
    )


def star_band_join(
    main: DataFrame,
    others: Mapping[str, DataFrame],
    keys: Sequence[str],
    ts: str,
    tolerance: timedelta,
    most_rows: int | None = None,
) -> DataFrame:
    """`main` band-joined to each of `others` in turn, always on main's own time.

    Columns of an other log come out as `<log>__<column>`. A row of `main` appears once per
    combination of matches, so the result holds the product of its matches in all logs. It is
    for those who want them all; no job uses it. With `most_rows` the product is counted first,
    and a larger one raises StarTooLarge.

    As in `band_left_join` time is cut into buckets, and instants without a match get an empty
    partner, but no join of rows is formed. Rows of a bucket are put into chunks, each log's
    chunks meet the others' where their times do, and these tuples of chunks are dealt out over
    all tasks, so that a hot bucket is spread too. Only then a moment takes its matches out of
    each chunk and is combined with them: what is shuffled grows with the chunks that meet, not
    with the rows. A task holds a tuple and one moment's combinations within it.
    """
    if most_rows is not None:
        refuse_large_star(star_sizes(main, others, keys, ts, tolerance), most_rows)
    if not others:
        return main
    reach = in_micros(tolerance)
    width = max(2 * reach, 1)
    size = max(min(MOST_IN_CHUNK, int(MOST_COMBINATIONS ** (1 / len(others)))), 1)
    us = micros(F.col(ts))
    moments = main.withColumns(
        {
            "__us": F.coalesce(us, F.lit(NO_TIME)),
            "__bucket": F.coalesce(bucket(us, width), F.lit(NO_TIME)),
            "__keys": F.struct(*keys),
        }
    )
    row = F.struct("__us", *main.columns)
    order = ["__us", *_sortable(main, main.columns)]
    tuples = _in_chunks(moments, order, size, "__us", "__us", row).withColumnsRenamed(
        {"__first": "__us_first", "__last": "__us_last", "__rows": "__moments"}
    )
    payloads = []
    for i, (name, other) in enumerate(others.items()):
        prefixed = other.withColumnsRenamed(
            {c: f"{name}__{c}" for c in other.columns if c not in (*keys, ts)}
        )
        payloads.append([c for c in prefixed.columns if c not in (*keys, ts)])
        sides = _sides(moments, prefixed, keys, ts, reach, width)
        row = F.struct("__from", "__to", *payloads[i])
        order = ["__from", "__asked", *_sortable(prefixed, payloads[i])]
        chunks = _in_chunks(sides, order, size, "__from", "__to", row)
        chunks = chunks.withColumnsRenamed({c: f"{c}_{i}" for c in chunks.columns})
        meet = [
            *(F.col(c) == F.col(f"{c}_{i}") for c in GROUP),
            F.col("__us_first") <= F.col(f"__last_{i}"),
            F.col("__us_last") >= F.col(f"__first_{i}"),
        ]
        tuples = tuples.join(chunks, meet).withColumns(
            {
                "__us_first": F.greatest("__us_first", f"__first_{i}"),
                "__us_last": F.least("__us_last", f"__last_{i}"),
            }
        ).drop(*(f"{c}_{i}" for c in (*GROUP, "__first", "__last")))
    # Asked for by number, as tasks would be put together by the bytes they read otherwise.
    tasks = int(main.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    numbers = [f"__chunk_{i}" for i in range(len(payloads))]
    dealt = tuples.repartition(tasks, *GROUP, "__chunk", *numbers)
    logs = [f"__rows_{i}" for i in range(len(payloads))]
    star = dealt.select(F.inline("__moments"), *logs)
    at = F.col("__us")
    near = [F.filter(c, lambda p: at.between(p["__from"], p["__to"])).alias(c) for c in logs]
    star = star.select(*main.columns, *near)
    columns = list(main.columns)
    for i, c in enumerate(logs):
        star = star.select(*columns, *logs[i + 1 :], F.inline(c))
        columns += payloads[i]
    return star.select(*columns)
