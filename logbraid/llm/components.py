"""Connected components of a graph that no task and no driver holds whole."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logbraid.functions.lineage import materialize


class Forest:
    """Union-find whose roots are the smallest members."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        parent = self.parent
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = x = parent[up]
        return x

    def join(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)


# Nodes a task joins up before it hands its stars on.
_HELD = 1 << 19


def _stars(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges of this task as stars around the smallest node of each of its components."""

    def flush(forest: Forest) -> pa.RecordBatch:
        pairs = [(x, forest.root(x)) for x in list(forest.parent)]
        pairs = [p for p in pairs if p[0] != p[1]]
        columns = list(zip(*pairs)) or [(), ()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in columns], ["node", "root"]
        )

    forest = Forest()
    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            forest.join(a, b)
        if len(forest.parent) > _HELD:
            yield flush(forest)
            forest = Forest()
    yield flush(forest)


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of `edges` (two long columns), root being the smallest node of
    its component; a node that is its own root is left out.

    Rounds of large star and small star: every node hands its larger neighbours to its smallest
    one, then its smaller neighbours to the smallest. Each round ends in a table in shared
    storage. The number of rounds grows with the logarithm of the number of nodes. A task joins
    what it holds into stars first, so that a node with many edges sends few.
    """
    a, b = edges.columns
    pairs = edges.select(F.col(a).alias("node"), F.col(b).alias("root")).where("node <> root")
    stars = _stars_of(pairs)
    before, now = None, _summary(stars)
    while now != before:
        stars = _smaller_star(_larger_star(stars))
        before, now = now, _summary(stars)
    return stars


def _larger_star(stars: DataFrame) -> DataFrame:
    """Every node's larger neighbours, and itself, with the smallest of its neighbourhood."""
    both = stars.unionByName(stars.select(F.col("root").alias("node"), F.col("node").alias("root")))
    least = both.groupBy(F.col("node").alias("hub")).agg(F.min("root").alias("least"))
    # Tables of their own can be split in the join where a node has many neighbours.
    least = materialize(least.withColumn("least", F.least("hub", "least")), "least")
    handed = both.join(least, F.col("node") == F.col("hub")).where("root > hub")
    own = least.where("least < hub").select(F.col("hub").alias("node"), F.col("least").alias("root"))
    return handed.select(F.col("root").alias("node"), F.col("least").alias("root")).unionByName(own)


def _smaller_star(pairs: DataFrame) -> DataFrame:
    """Every node, and its smaller neighbours, with the smallest of them."""
    pairs = materialize(pairs.distinct(), "handed")
    least = pairs.groupBy(F.col("node").alias("hub")).agg(F.min("root").alias("least"))
    least = materialize(least, "least")
    met = pairs.join(least, F.col("node") == F.col("hub")).where("root > least")
    return _stars_of(
        met.select(F.col("root").alias("node"), F.col("least").alias("root")).unionByName(
            least.select(F.col("hub").alias("node"), F.col("least").alias("root"))
        )
    )


def _stars_of(pairs: DataFrame) -> DataFrame:
    stars = pairs.mapInArrow(_stars, "node long, root long").distinct()
    return materialize(stars, "stars")


def _summary(stars: DataFrame) -> tuple:
    """Alike for equal sets of edges."""
    hashed = F.xxhash64("node", "root").cast("decimal(38,0)")
    return tuple(stars.agg(F.count(F.lit(1)), F.sum(hashed)).first())
