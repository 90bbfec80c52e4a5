"""Mixing sources to target weights, by fitting a budget of words.

Documents are counted by source and exact length. A source takes its whole copies, then a
budget of words is left for it: each length first gives the same share of its documents, and
what remains is filled by a bounded-knapsack dynamic program over lengths and counts. The
outcome is a number of documents per source and length, and that many are picked in a seeded
order.

Only the histogram, whose size depends on lengths and not on documents, is handled per source.
Where some documents of a length are picked, the last one picked is found by counting slices of
the seeded order, so that a length with a third of all documents is never ordered in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logbraid.functions.lineage import materialize
from logbraid.llm.rows import packed, unpacked, words_in

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_COPIES = 2
# Sums up to this many words are searched exactly; above it lengths are taken one document each.
KNAPSACK_WORDS = 1 << 17
# Documents per slice of the seeded order, and the most slices of one length.
SLICE, MOST_SLICES = 1024, 1 << 20
RESULTS = ("size", "source_size", "target", "copies", "taken")


def with_sizes(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with `size`, the number of words."""
    return docs.withColumn("size", words_in(F.col(text)))


def fit_budget(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each length to take, at most `counts`, to sum to `budget` or as
    little below it as can be found."""
    lengths, counts = lengths.astype(np.int64), counts.astype(np.int64)
    whole = int((lengths * counts).sum())
    if budget >= whole:
        return counts.copy()
    share = counts * (budget / whole)
    taken = np.minimum(np.floor(share).astype(np.int64), counts)
    rest = budget - int((lengths * taken).sum())
    by_fraction = np.argsort(-(share - taken), kind="stable")
    changed = True
    while rest > KNAPSACK_WORDS and changed:
        changed = False
        for j in by_fraction:
            if rest > KNAPSACK_WORDS and taken[j] < counts[j] and 0 < lengths[j] <= rest:
                taken[j] += 1
                rest -= int(lengths[j])
                changed = True
    return taken + _knapsack(lengths, counts - taken, min(rest, KNAPSACK_WORDS))


def _knapsack(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """Bounded knapsack with value equal to length: the largest sum up to `budget`."""
    taken = np.zeros(len(lengths), dtype=np.int64)
    if budget <= 0:
        return taken
    # Sets of reachable sums are the bits of one integer. Counts are split into powers of two.
    mask, reached = (1 << (budget + 1)) - 1, 1
    first = np.full(budget + 1, -1, dtype=np.int32)
    parcels: list[tuple[int, int]] = []
    for j in np.argsort(-lengths, kind="stable"):
        length = int(lengths[j])
        left = min(int(counts[j]), budget // length) if length else 0
        parcel = 1
        while left > 0 and not reached >> budget & 1:
            parcel = min(parcel, left)
            new = (reached << (length * parcel)) & mask & ~reached
            if new:
                bits = np.frombuffer(new.to_bytes(budget // 8 + 1, "little"), dtype=np.uint8)
                first[np.flatnonzero(np.unpackbits(bits, bitorder="little"))] = len(parcels)
                reached |= new
            parcels.append((int(j), parcel))
            left -= parcel
            parcel *= 2
    at = reached.bit_length() - 1
    while at > 0:
        j, parcel = parcels[first[at]]
        taken[j] += parcel
        at -= int(lengths[j]) * parcel
    return taken


def source_targets(
    histogram: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE
) -> DataFrame:
    """(source, source_size, target): the words each source should give.

    Sources in code point order, NULL last, weigh `weights` in turn. A target stops at
    `MOST_COPIES` times its source; what it cannot take is shared among the others by weight.
    With sources in the order in which they fill up, each one's level follows from sums over
    those before and after it. There is one row per source.
    """
    sums = histogram.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), F.pmod(place, F.lit(len(weights))) + 1)
    everything = Window.partitionBy()
    weighed = sums.select(
        "*",
        weight.alias("weight"),
        (F.sum("source_size").over(everything) * share).alias("budget"),
        (F.col("source_size") * MOST_COPIES).cast("double").alias("most"),
    )
    filling = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    full = F.coalesce(F.sum("most").over(filling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    still = F.sum("weight").over(filling.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    levelled = weighed.withColumn("level", (F.col("budget") - full) / still)
    fits = F.col("level") * F.col("weight") < F.col("most")
    # The first source that does not fill up has the level of all that do not.
    level = F.min(F.when(fits, F.struct(F.col("most") / F.col("weight"), "level"))).over(everything)
    return levelled.select(
        "source",
        "source_size",
        F.when(fits, F.col("weight") * level["level"]).otherwise(F.col("most")).alias("target"),
    )


def _fitted(group: pd.DataFrame) -> pd.DataFrame:
    source_size, target = int(group.source_size.iloc[0]), float(group.target.iloc[0])
    whole = min(MOST_COPIES, int(target // source_size)) if source_size else 0
    budget = round(target) - whole * source_size
    lengths, counts = group["size"].to_numpy(), group["n"].to_numpy()
    extra = np.where(lengths > 0, fit_budget(lengths, counts, budget), 0) if budget > 0 else 0
    return group.assign(whole=whole, extra=extra)


def plan_mix(sized: DataFrame, seed: int) -> DataFrame:
    """Per source and size: whole copies of all, and the last document in seeded order that is
    taken once more. `sized` has id, source and size."""
    histogram = materialize(
        sized.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "sizes"
    )
    targets = source_targets(histogram).withColumnRenamed("source", "its_source")
    fitted = materialize(
        histogram.join(targets, F.col("source").eqNullSafe(F.col("its_source")))
        .drop("its_source")
        .groupBy("source")
        .applyInPandas(
            _fitted,
            "source string, size long, n long, source_size long, target double,"
            " whole long, extra long",
        ),
        "fitted",
    )
    partly = fitted.where("extra > 0 AND extra < n").select(
        F.col("source").alias("s"), F.col("size").alias("z"), "n", "extra"
    )
    same = F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z"))
    slices = F.least(F.floor(F.col("n") / SLICE) + 1, F.lit(MOST_SLICES))
    # The draw has 63 bits; its upper 43 times at most 2**20 slices stay within a long.
    slice_of = F.expr("shiftright(shiftright(draw, 20) * slices, 43)")
    drawn = (
        sized.join(partly, same)
        .withColumn("slices", slices)
        .withColumn("draw", seeded_draw(F.col("id"), seed))
        .select("s", "z", "extra", "id", "draw", slice_of.alias("slice"))
    )
    drawn = materialize(drawn, "drawn")
    so_far = Window.partitionBy("s", "z").orderBy("slice")
    last_slices = (
        drawn.groupBy("s", "z", "slice", "extra")
        .count()
        .withColumn("through", F.sum("count").over(so_far))
        .where("through >= extra AND through - count < extra")
        .select(
            F.col("s").alias("s2"),
            F.col("z").alias("z2"),
            F.col("slice").alias("slice2"),
            (F.col("extra") - F.col("through") + F.col("count")).alias("wanted"),
        )
    )
    in_slice = (
        (F.col("z") == F.col("z2"))
        & (F.col("slice") == F.col("slice2"))
        & F.col("s").eqNullSafe(F.col("s2"))
    )
    by_draw = Window.partitionBy("s", "z", "slice").orderBy("draw", "id")
    cuts = (
        drawn.join(last_slices, in_slice)
        .withColumn("place", F.row_number().over(by_draw))
        .where("place = wanted")
        .select(
            F.col("s").alias("cut_source"),
            F.col("z").alias("cut_size"),
            F.struct("draw", "id").alias("cut"),
        )
    )
    cut_here = F.col("source").eqNullSafe(F.col("cut_source")) & (F.col("size") == F.col("cut_size"))
    return fitted.join(cuts, cut_here, "left").drop("cut_source", "cut_size")


def seeded_draw(identity, seed: int):
    """A document's place in the seeded order: 63 bits of a hash."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), identity), 1)


def mix(
    docs: DataFrame,
    seed: int = 42,
    doc_id: str = "doc_id",
    source: str = "source",
    size: str = "size",
) -> DataFrame:
    """`docs` with how often the mix takes each.

    `docs` has `size`, as from `with_sizes`. Adds `source_size` and `target`, the words its
    source has and should give, `copies` (0 to 2) and `taken`, the words of all copies.

    A NULL size is none, and documents without words are taken as often as all of their source.
    A NULL source is a source, and a NULL id an id. Rows that share an id, a source and a size
    have one place in the seeded order, so that they are taken once more together. A long text is
    one document of its size. What a budget has left over the share of each length is fitted
    exactly, after single documents of the lengths whose share was cut most, where it is over
    `KNAPSACK_WORDS` words. An empty table gives an empty result. Columns named as the results are replaced.
    """
    rows = packed(
        docs,
        id=F.col(doc_id),
        source=F.col(source).cast("string"),
        size=F.coalesce(F.col(size).cast("bigint"), F.lit(0)),
    )
    plan = plan_mix(materialize(rows.select("id", "source", "size"), "sized"), seed)
    plan = materialize(plan, "mix").withColumnsRenamed({"source": "s", "size": "z"})
    same = F.col("source").eqNullSafe(F.col("s")) & (F.col("size") == F.col("z"))
    here = F.struct(seeded_draw(F.col("id"), seed).alias("draw"), F.col("id"))
    once_more = (F.col("extra") == F.col("n")) | (
        F.col("cut").isNotNull() & (here <= F.col("cut"))
    )
    copies = F.col("whole") + F.when((F.col("extra") > 0) & once_more, 1).otherwise(0)
    joined = rows.join(plan, same).withColumn("copies", copies)
    return unpacked(
        joined.withColumn("taken", F.col("copies") * F.col("size")), docs.columns, RESULTS
    )
