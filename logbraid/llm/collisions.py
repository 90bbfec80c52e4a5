"""Nearest neighbours by inner product, by counting collisions on single projections.

Rows are dealt into blocks by a hash of their id, queries likewise, and every block of queries
meets every block of rows. In a block, vectors are made equally long by one more coordinate, so
that the largest inner product is the smallest distance, and projected on `PROJECTIONS` random
lines; each line has its rows sorted, and each row its rank there. A query opens a window around
its own place on every line, as wide as the distance asks for at which a sample of the block has
as many rows as are looked for. A window is a range of ranks, so a row's collisions are counted by
comparing its ranks, many at a time. A row in enough windows is verified by its inner product. A
query is done when its k-th best row is no farther than the radius the windows stand for, by which
time any row within that radius has been verified with the probability below; all windows widen by
a factor (virtual rehashing) until then, however many rows they take in.

The best k of each block meet per query.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logbraid.functions.lineage import materialize
from logbraid.llm.vectors import lengths, stacked, usable

PROJECTIONS = 128
# Half the width of a window for radius 1: a row at that distance is in it with probability 0.5.
HALF_WIDTH = 0.6745
# Windows a row must be in: a row at the radius is in as many with probability 0.91, at 0.9 times
# the radius with 0.98.
THRESHOLD = 57
WIDEN = 1.1
ROWS_PER_BLOCK, QUERIES_PER_BLOCK = 8_192, 16_384
# Rows that tell the first radius; how far a wrong guess costs time, never rows.
SAMPLED = 2_048
# Queries whose windows are looked up at once, and rows whose ranks are compared at once.
QUERIES_AT_ONCE, ROWS_AT_ONCE = 256, 2_048
RESULTS = "query_id long, vec_id long, score double"


class Index:
    """A block's rows on `PROJECTIONS` sorted lines."""

    def __init__(self, vectors: np.ndarray, seed: int = 42) -> None:
        self.vectors = vectors
        self.longest = float(lengths(vectors).max())
        unit = vectors / self.longest
        rest = np.sqrt(np.maximum(0.0, 1.0 - (unit * unit).sum(axis=1)))
        self.points = np.column_stack([unit, rest]).astype(np.float32)
        random = np.random.default_rng(seed)
        self.lines = random.standard_normal((self.points.shape[1], PROJECTIONS), dtype=np.float32)
        places = self.points @ self.lines
        order = np.argsort(places, axis=0, kind="stable").T
        self.sorted = np.take_along_axis(places.T, order, axis=1)
        kind = np.uint16 if len(vectors) < 1 << 16 else np.uint32
        # By slice of the rows, the rank of each row on each line.
        ranks = np.empty((PROJECTIONS, len(vectors)), dtype=kind)
        np.put_along_axis(ranks, order, np.arange(len(vectors), dtype=kind)[None, :], axis=1)
        cuts = range(0, len(vectors), ROWS_AT_ONCE)
        self.ranks = [np.ascontiguousarray(ranks[:, c : c + ROWS_AT_ONCE]) for c in cuts]
        step = -(-len(vectors) // SAMPLED)
        self.sample = self.points[::step]

    def search(self, queries: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per query (rows, inner products) of the best `k` found, and of all that tie with them
        in single precision."""
        unit = queries / lengths(queries)[:, None]
        points = np.column_stack([unit, np.zeros(len(unit))]).astype(np.float32)
        out = []
        for first in range(0, len(points), QUERIES_AT_ONCE):
            some = slice(first, first + QUERIES_AT_ONCE)
            near = self._near(points[some], k)
            out += [self._exact(*n, query, k) for n, query in zip(near, queries[some])]
        return out

    def _first_radii(self, points: np.ndarray, k: int) -> np.ndarray:
        """By the sample, within which radius some more than k rows are."""
        expected = k * len(self.sample) / len(self.vectors)
        nth = min(int(expected + 2 * np.sqrt(expected)) + 1, len(self.sample)) - 1
        products = np.partition(-(points @ self.sample.T), nth, axis=1)[:, nth]
        # Of two points of length 1.
        return np.sqrt(np.maximum(2.0 + 2.0 * products, 0.0)) + 1e-3

    def _near(self, points: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per query the rows verified and their inner products."""
        n, out = len(self.vectors), [None] * len(points)
        places, radii = points @ self.lines, self._first_radii(points, k)
        still = np.arange(len(points))
        while len(still):
            # The windows of all queries that are open, line by line.
            reach = (radii[still] * HALF_WIDTH).astype(np.float32)
            lows, highs = (
                np.stack([np.searchsorted(line, asked, side) for line, asked in zip(self.sorted, at.T)])
                for at, side in (
                    (places[still] - reach[:, None], "left"),
                    (places[still] + reach[:, None], "right"),
                )
            )
            unfinished = []
            for i, q in enumerate(still):
                found = np.flatnonzero(self._collisions(lows[:, i], highs[:, i]) >= THRESHOLD)
                near = self.points[found] @ points[q]
                close = np.count_nonzero(2.0 - 2.0 * near <= radii[q] * radii[q])
                whole = (lows[:, i] == 0).all() and (highs[:, i] == n).all()
                if close >= k or whole:
                    out[q] = (found, near)
                else:
                    unfinished.append(q)
            still = np.array(unfinished, dtype=np.int64)
            radii[still] *= WIDEN
        return out

    def _collisions(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """How many windows each row is in; a window holds the ranks from low to below high."""
        kind = self.ranks[0].dtype
        first, size = low.astype(kind)[:, None], (high - low).astype(kind)[:, None]
        # Ranks below the window wrap around to large ones.
        return np.concatenate(
            [np.add.reduce((ranks - first) < size, axis=0, dtype=np.uint8) for ranks in self.ranks]
        )

    def _exact(
        self, found: np.ndarray, near: np.ndarray, query: np.ndarray, k: int
    ) -> tuple[np.ndarray, np.ndarray]:
        if len(found) > k:
            kth = np.partition(near, len(found) - k)[len(found) - k]
            found = found[near >= kth - 1e-5]
        return found, (self.vectors[found] * query).sum(axis=1)


def _search(k: int):
    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if rows.num_rows and queries.num_rows:
            ids, query_ids = rows["id"].to_numpy(), queries["q_id"].to_numpy()
            found = Index(stacked(rows["vector"])).search(stacked(queries["q_vector"]), k + 1)
            for query_id, (places, scores) in zip(query_ids, found):
                others = ids[places] != query_id
                mine, scores = ids[places][others], scores[others]
                best = np.lexsort((mine, -scores))
                out.append((np.full(len(mine), query_id), mine[best], scores[best]))
        columns = map(np.concatenate, zip(*out)) if out else ((), (), ())
        kinds = (pa.int64(), pa.int64(), pa.float64())
        return pa.Table.from_arrays(
            [pa.array(c, kind) for c, kind in zip(columns, kinds)],
            ["query_id", "vec_id", "score"],
        )

    return run


def nearest_by_inner_product(
    table: DataFrame, is_query: Column, k: int, vec_id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score): for every row where `is_query` holds its `k` nearest
    rows by inner product, fewer if there are fewer; ties go to the smaller id.

    Scores are in double precision, on the vectors as they are. Vectors that are NULL, empty or
    zero, or have a NULL or non-finite component, and rows without an id, take no part; vectors
    meet only those of their length. Rows with a query's id are its own. Repeated rows are rows
    each, with a rank each. An id with several vectors asks with the least of them. Columns that
    `is_query` doesn't name are not read, so they may have any name. An empty table gives an empty
    result.
    """
    rows = (
        table.select(
            F.col(vec_id).alias("id"),
            F.col(vector).cast("array<double>").alias("vector"),
            is_query.alias("asks"),
        )
        .where(F.col("id").isNotNull() & usable(F.col("vector")))
        .groupBy("id", "vector")
        .agg(F.count(F.lit(1)).alias("copies"), F.max("asks").alias("asks"))
        .withColumn("dim", F.size("vector"))
    )
    rows = materialize(rows, "vectors")
    queries = rows.where("asks").groupBy("id").agg(F.min("vector").alias("vector"))
    queries = queries.withColumn("dim", F.size("vector"))
    sizes = rows.groupBy(F.col("dim").alias("d")).agg(
        F.ceil(F.count(F.lit(1)) / ROWS_PER_BLOCK).cast("int").alias("blocks"),
        F.ceil(F.count_if("asks") / QUERIES_PER_BLOCK).cast("int").alias("query_blocks"),
    )
    # One row per length that vectors have.
    sizes = materialize(sizes.where("query_blocks > 0"), "block_counts")

    def dealt(df: DataFrame, own: str, met: str) -> DataFrame:
        """Each row in a block of its kind, once for every block of the other kind."""
        side = df.join(sizes, F.col("dim") == F.col("d"))
        mine = F.pmod(F.xxhash64("id"), F.col(f"{own}s")).cast("int")
        return side.select(
            "dim", "id", "vector", mine.alias(own),
            F.explode(F.sequence(F.lit(0), F.col(f"{met}s") - 1)).alias(met),
        )

    keys = ["dim", "block", "query_block"]
    asked = dealt(queries, "query_block", "block").select(
        *(F.col(c).alias(f"q_{c}") for c in (*keys, "id", "vector"))
    )
    met = (
        dealt(rows, "block", "query_block")
        .groupBy(*keys)
        .cogroup(asked.groupBy(*(f"q_{c}" for c in keys)))
        .applyInArrow(_search(k), RESULTS)
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    first = met.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    # Repeated rows come back as rows; one distinct vector fills at most all ranks.
    copies = rows.where("copies > 1").select(
        F.col("id").alias("copied"), F.col("vector").alias("copied_vector"), "copies"
    )
    copies = copies.groupBy("copied").agg(F.sum("copies").alias("copies"))
    counted = first.join(copies, F.col("vec_id") == F.col("copied"), "left").withColumn(
        "copy", F.explode(F.sequence(F.lit(1), F.least(F.coalesce("copies", F.lit(1)), F.lit(k))))
    )
    ranked = counted.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
