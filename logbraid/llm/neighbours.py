"""Near-duplicate embeddings by NN-descent on a neighbour graph.

Equal vectors are one node. A graph is begun from neighbours in the order of random sign codes:
nodes sorted by code are cut into short runs, and all in a run are compared. In each round every
node's neighbours, and some of the nodes that name it, are compared with each other, and lists
keep the nearest. A list whose entries all reach the threshold is saturated and may grow. The
recall of links is audited against every row for a bounded sample of nodes, and missing recall
brings further starts and rounds; where those no longer help, the search fails.

Links are then exact: nodes that near edges connect are compared in blocks, so that saturated
lists grow to the whole of their neighbourhood. As a list may be full of its own part, blocks of
parts of more than a list are compared across parts too. A block's ball tells whether all or none of two
blocks' pairs link; only what it cannot tell is multiplied out. Nothing but counts and one edge
per node and component leaves a pair of blocks.
"""

from __future__ import annotations

import logging
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logbraid.functions.lineage import materialize
from logbraid.llm.components import Forest, connected_components
from logbraid.llm.vectors import lengths, stacked, usable

log = logging.getLogger(__name__)

NEIGHBOURS = 8
# Longest list of a saturated node, and nodes that name a node that are looked at in a round.
SATURATED, NAMED_BY = 32, 8
STARTS, RUN, CODE_BITS = 4, 48, 60
ROUNDS, SETTLED = 4, 0.01
AUDITED, AUDIT_RECALL, ATTEMPTS = 512, 0.98, 3
# Nodes compared with each other at once.
BLOCK = 2048
# How far a similarity of half-precision vectors may be off.
_SLACK = 0.005
# How far an angle between balls may be off.
REACH_SLACK = 1e-6


def _units(vectors: np.ndarray) -> np.ndarray:
    return vectors / lengths(vectors)[:, None]


def _half(raw: pa.ChunkedArray | pa.Array, n: int) -> np.ndarray:
    return np.frombuffer(b"".join(raw.to_pylist()), dtype=np.float16).reshape(n, -1)


def _runs(keys: np.ndarray) -> Iterator[tuple[int, int]]:
    cuts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1], True]) if len(keys) else []
    return zip(cuts, cuts[1:])


def _edges(node, near, sim) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(node, pa.int64()), pa.array(near, pa.int64()), pa.array(sim, pa.float32())],
        ["node", "near", "sim"],
    )


EDGES = "node long, near long, sim float"


def starts_for(n: int, threshold: float) -> int:
    """So many starts that of two nodes at the threshold, among `n` whose codes are spread evenly,
    `AUDIT_RECALL` of such pairs share a run in one. A sign agrees by the angle between them."""
    agree = 1 - float(np.arccos(np.clip(threshold, -1.0, 1.0))) / np.pi
    together = agree ** np.log2(max(2 * n / RUN, 1.0))
    if together >= AUDIT_RECALL:
        return STARTS
    return max(STARTS, int(np.ceil(np.log1p(-AUDIT_RECALL) / np.log1p(-together))))


def _code(attempt: int, starts: range):
    """Batches of nodes with a sign code for each start."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                units = _half(part.column("unit"), part.num_rows).astype(np.float32)
                for start in starts:
                    random = np.random.default_rng((attempt, start, int(dim)))
                    planes = random.standard_normal((int(dim), CODE_BITS), dtype=np.float32)
                    signs = (units @ planes > 0).astype(np.int64)
                    code = signs @ (1 << np.arange(CODE_BITS - 1, -1, -1, dtype=np.int64))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(part.num_rows, start, dtype=np.int32)),
                            part.column("dim"),
                            pa.array(code),
                            part.column("node"),
                            part.column("unit"),
                        ],
                        ["start", "dim", "code", "node", "unit"],
                    )

    return run


def _compare_runs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of nodes sorted by code the nearest within each run of `RUN`."""
    for batch in batches:
        keys = batch.column("start").to_numpy() * 1_000_003 + batch.column("dim").to_numpy()
        nodes, units = batch.column("node").to_numpy(), batch.column("unit")
        out = []
        for first, last in _runs(keys):
            for a in range(first, last, RUN):
                b = min(a + RUN, last)
                if b - a < 2:
                    continue
                x = _half(units.slice(a, b - a), b - a).astype(np.float32)
                sims = x @ x.T
                np.fill_diagonal(sims, -np.inf)
                k = min(NEIGHBOURS, b - a - 1)
                best = np.argpartition(-sims, k - 1, axis=1)[:, :k]
                mine = nodes[a:b]
                out.append((
                    np.repeat(mine, k), mine[best].ravel(),
                    np.take_along_axis(sims, best, axis=1).ravel(),
                ))
        yield _edges(*(map(np.concatenate, zip(*out)) if out else ((), (), ())))


def _compare_lists(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per node, the pairs among those around it that would enter one's list."""
    for batch in batches:
        out = []
        lists = batch.column("around")
        for i in range(batch.num_rows):
            members = lists[i].values
            n = len(members)
            if n < 2:
                continue
            x = _half(members.field("unit"), n).astype(np.float32)
            ids, floors = members.field("id").to_numpy(), members.field("floor").to_numpy()
            sims = x @ x.T
            np.fill_diagonal(sims, -np.inf)
            a, b = np.nonzero(sims > floors[:, None])
            if len(a):
                out.append((ids[a], ids[b], sims[a, b]))
        yield _edges(*(map(np.concatenate, zip(*out)) if out else ((), (), ())))


def _nearest(edges: DataFrame, threshold: float) -> DataFrame:
    """The lists: every node's nearest, and more of those over the threshold."""
    best = Window.partitionBy("node").orderBy(F.desc("sim"), "near")
    once = edges.groupBy("node", "near").agg(F.max("sim").alias("sim"))
    ranked = once.withColumn("place", F.row_number().over(best)).where(F.col("place") <= SATURATED)
    kept = (F.col("place") <= NEIGHBOURS) | (F.col("sim") >= threshold - _SLACK)
    return ranked.where(kept).select("node", "near", "sim")


def _around(graph: DataFrame, nodes: DataFrame, round_number: int) -> DataFrame:
    """(node, around): itself, its list, and up to `NAMED_BY` nodes that name it."""
    by_chance = Window.partitionBy("node").orderBy(
        F.xxhash64(F.lit(round_number), "node", "member"), "member"
    )
    named_by = (
        graph.select(F.col("near").alias("node"), F.col("node").alias("member"))
        .withColumn("place", F.row_number().over(by_chance))
        .where(F.col("place") <= NAMED_BY)
        .select("node", "member")
    )
    own = graph.select("node", F.col("near").alias("member"))
    itself = nodes.select("node", F.col("node").alias("member"))
    members = own.unionByName(named_by).unionByName(itself).distinct()
    floors = (
        graph.groupBy(F.col("node").alias("listed"))
        .agg(F.min("sim").alias("least"), F.count(F.lit(1)).alias("n"))
        .select("listed", F.when(F.col("n") >= NEIGHBOURS, F.col("least")).alias("floor"))
    )
    described = nodes.join(floors, F.col("node") == F.col("listed"), "left").select(
        F.col("node").alias("id"),
        "unit",
        F.coalesce(F.col("floor"), F.lit(-2.0)).cast("float").alias("floor"),
    )
    return (
        members.join(described, F.col("member") == F.col("id"))
        .groupBy("node")
        .agg(F.collect_list(F.struct("id", "floor", "unit")).alias("around"))
    )


def neighbour_graph(nodes: DataFrame, threshold: float, attempt: int = 0) -> DataFrame:
    """(node, near, sim) of approximate nearest neighbours. `nodes` has node, dim and `unit`,
    the vector at length 1 in half precision."""
    n, graph = nodes.count(), None
    starts = starts_for(n, threshold)
    # A few at a time, as each start has a copy of every vector.
    for first in range(0, starts, STARTS):
        coded = nodes.mapInArrow(
            _code(attempt, range(first, min(first + STARTS, starts))),
            "start int, dim int, code long, node long, unit binary",
        )
        runs = coded.repartitionByRange("start", "dim", "code", "node").sortWithinPartitions(
            "start", "dim", "code", "node"
        )
        met = runs.mapInArrow(_compare_runs, EDGES)
        met = met if graph is None else graph.unionByName(met)
        graph = materialize(_nearest(met, threshold), "graph")
    for round_number in range(ROUNDS):
        around = _around(graph, nodes, round_number).select("around")
        met = around.mapInArrow(_compare_lists, EDGES)
        better = materialize(_nearest(graph.unionByName(met), threshold), "graph")
        old = graph.select(F.col("node").alias("a"), F.col("near").alias("b"))
        new = better.join(
            old, (F.col("node") == F.col("a")) & (F.col("near") == F.col("b")), "left_anti"
        ).count()
        graph = better
        if new < SETTLED * NEIGHBOURS * max(n, 1):
            break
    return graph


AUDIT = "node long, near long, n long, found long"


def _links_of_sample(sample: dict[int, tuple], threshold: float):
    """Per node of the sample how many links have both ends in its part, and one link to each
    other part with their number."""
    by_dim = {dim: (ids, parts, _units(v)) for dim, (ids, parts, v) in sample.items()}

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, out = batch.column("dim").to_numpy(), []
            for dim in np.unique(dims):
                if int(dim) not in by_dim:
                    continue
                batch_part = batch.filter(pa.array(dims == dim))
                mine, my_parts, units = by_dim[int(dim)]
                nodes = batch_part.column("node").to_numpy()
                parts = batch_part.column("part").to_numpy()
                sims = _units(stacked(batch_part.column("vector"))) @ units.T
                a, b = np.nonzero(sims >= threshold)
                other = nodes[a] != mine[b]
                a, b = a[other], b[other]
                same = parts[a] == my_parts[b]
                found = np.bincount(b[same], minlength=len(mine))
                has = np.flatnonzero(found)
                out.append((mine[has], mine[has], found[has], found[has]))
                a, b = a[~same], b[~same]
                keys, first, counts = np.unique(
                    np.stack([b, parts[a]]), axis=1, return_index=True, return_counts=True
                )
                out.append((mine[b[first]], nodes[a[first]], counts, np.zeros_like(counts)))
            columns = map(np.concatenate, zip(*out)) if out else [()] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], ["node", "near", "n", "found"]
            )

    return run


def audit(
    nodes: DataFrame, parts: DataFrame, threshold: float, attempt: int = 0
) -> tuple[float, DataFrame]:
    """(share of a node's links that stay in its part, (node, near) of links that do not).

    `AUDITED` nodes of parts larger than a list, and as many others, are compared with every
    node. Each node's share counts alike, and the lesser mean of the two samples is given, so that
    the many links of a large part hide no missing pairs. Every attempt has another sample.
    """
    sizes = parts.groupBy(F.col("part").alias("sized")).agg(F.count(F.lit(1)).alias("size"))
    large = materialize(sizes.where(F.col("size") > SATURATED).select("sized"), "large_parts")
    labels = materialize(
        nodes.select("node").join(parts, F.col("node") == F.col("of"), "left").select(
            F.col("node").alias("of"), F.coalesce("part", "node").alias("part")
        ),
        "labels",
    )
    marked = labels.join(large, F.col("part") == F.col("sized"), "left")
    by_chance = F.xxhash64(F.lit(attempt), "of")
    inside, outside = (
        marked.where(which).orderBy(by_chance, "of").limit(AUDITED).select("of", "part", "sized")
        for which in ("sized IS NOT NULL", "sized IS NULL")
    )
    picked = materialize(inside.unionByName(outside), "audited")
    rows = nodes.join(F.broadcast(picked), F.col("node") == F.col("of")).collect()
    sample = {}
    for dim in {r.dim for r in rows}:
        mine = [r for r in rows if r.dim == dim]
        ids, in_parts = (np.array([r[c] for r in mine], dtype=np.int64) for c in ("node", "part"))
        sample[dim] = ids, in_parts, np.array([r.vector for r in mine], dtype=np.float64)
    links = materialize(
        nodes.select("node", "dim", "vector")
        .join(labels, F.col("node") == F.col("of"))
        .select("node", "part", "dim", "vector")
        .mapInArrow(_links_of_sample(sample, threshold), AUDIT),
        "audit",
    )
    # At most a row per node of the sample.
    shares = links.groupBy("node").agg((F.sum("found") / F.sum("n")).alias("share")).collect()
    is_large = {r.node: r.sized is not None for r in rows}
    means = [
        float(np.mean(group))
        for kind in (True, False)
        if (group := [r.share for r in shares if is_large[r.node] == kind])
    ]
    return min(means, default=1.0), links.where("near <> node").select("node", "near")


def _balls(rows: pa.Table) -> pa.Table:
    """A block's centre, the largest angle from it, and the number of its nodes."""
    units = _units(stacked(rows["vector"]))
    centre = units.sum(axis=0)
    size = float(np.sqrt(centre @ centre))
    centre = centre / size if size > 1e-9 else units[0]
    angle = float(np.arccos(np.clip(units @ centre, -1.0, 1.0)).max())
    return pa.table(
        {
            "part": rows["part"].slice(0, 1),
            "block": rows["block"].slice(0, 1),
            "dim": rows["dim"].slice(0, 1),
            "blocks": rows["blocks"].slice(0, 1),
            "centre": pa.array([centre.tolist()], pa.list_(pa.float64())),
            "angle": pa.array([angle], pa.float64()),
            "weight": pa.array([int(rows["copies"].to_numpy().sum())], pa.int64()),
            "least": pa.array([int(rows["node"].to_numpy().min())], pa.int64()),
        }
    )


def _compare_blocks(threshold: float):
    """For two blocks of one part: each node's links in the other block, and one of them for
    every component that those make."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        nodes, links, roots = [], [], []
        parts, right_parts = left["part"].to_numpy(), right["r_part"].to_numpy()
        a_all, b_all = left["node"].to_numpy(), right["r_node"].to_numpy()
        a_units = _units(stacked(left["vector"])) if len(a_all) else None
        b_units = _units(stacked(right["r_vector"])) if len(b_all) else None
        copies = right["r_copies"].to_numpy()
        order, right_order = np.argsort(parts, kind="stable"), np.argsort(right_parts, kind="stable")
        sorted_right = right_parts[right_order]
        for first, last in _runs(parts[order]):
            mine = order[first:last]
            part = parts[mine[0]]
            theirs = right_order[
                np.searchsorted(sorted_right, part) : np.searchsorted(sorted_right, part, "right")
            ]
            if not len(theirs):
                continue
            sims = a_units[mine] @ b_units[theirs].T
            linked = (sims >= threshold) & (a_all[mine][:, None] != b_all[theirs][None, :])
            near = np.abs(sims - threshold) < 1e-12
            if near.any():
                # Sums in one order, so that a pair is judged alike from both sides.
                for i, j in zip(*np.nonzero(near)):
                    x, y = a_units[mine[i]], b_units[theirs[j]]
                    linked[i, j] = a_all[mine[i]] != b_all[theirs[j]] and (x * y).sum() >= threshold
            forest = Forest()
            for i in np.flatnonzero(linked.any(axis=1)):
                node, found = int(a_all[mine[i]]), b_all[theirs[linked[i]]].tolist()
                for other in found:
                    forest.join(node, other)
            for i, node in enumerate(a_all[mine].tolist()):
                count = int(copies[theirs[linked[i]]].sum())
                if count:
                    nodes.append(node)
                    links.append(count)
                    roots.append(forest.root(node))
        return pa.Table.from_arrays(
            [pa.array(c, pa.int64()) for c in (nodes, links, roots)], ["node", "links", "root"]
        )

    return run


def _within_reach(limit: float):
    """Pairs of blocks of different parts whose balls may hold a link, and whether all link."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        columns: list[list] = [[] for _ in range(7)]
        if left.num_rows and right.num_rows:
            sides = [{n.removeprefix("r_"): t[n] for n in t.column_names} for t in (left, right)]
            a, b = sides
            cosines = np.clip(stacked(a["centre"]) @ stacked(b["centre"]).T, -1.0, 1.0)
            apart = np.arccos(cosines)
            angles = a["angle"].to_numpy()[:, None] + b["angle"].to_numpy()[None, :]
            other = a["part"].to_numpy()[:, None] != b["part"].to_numpy()[None, :]
            i, j = np.nonzero(other & (apart - angles <= limit + REACH_SLACK))
            columns = [
                a["part"].to_numpy()[i], b["part"].to_numpy()[j],
                a["block"].to_numpy()[i], b["block"].to_numpy()[j],
                b["weight"].to_numpy()[j],
                np.minimum(a["least"].to_numpy()[i], b["least"].to_numpy()[j]),
                (apart + angles < limit - REACH_SLACK)[i, j],
            ]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.bool_()]
        names = ["p", "q", "a", "b", "w", "least", "all_link"]
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return run


def _across_parts(balls: DataFrame, limit: float) -> DataFrame:
    """Every two blocks of different parts that may hold a link. Each group of balls meets each."""
    groups = balls.count() // BLOCK + 1
    own = balls.withColumn("own", F.pmod(F.xxhash64("part", "block"), F.lit(groups)).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))
    left = own.withColumn("other", every).withColumn("mine", F.col("own"))
    right = own.withColumn("mine", every).withColumn("other", F.col("own"))
    right = right.select(*(F.col(c).alias("r_" + c) for c in right.columns))
    return (
        left.groupBy("dim", "mine", "other")
        .cogroup(right.groupBy("r_dim", "r_mine", "r_other"))
        .applyInArrow(
            _within_reach(limit),
            "p long, q long, a int, b int, w long, least long, all_link boolean",
        )
    )


def exact_links(members: DataFrame, threshold: float) -> DataFrame:
    """(node, links, root): the number of rows each node links with in other nodes of its part,
    or of other parts of more than a list, in one row per pair of blocks, and the smallest node
    that those links reach there.

    `members` has node, part, dim, vector and copies. Parts of up to a block are put together; larger
    ones are cut into blocks, every one of which meets every other of its part unless their
    balls are too far apart, or so near that all their nodes link. Lists of nodes in a part of more
    than `NEIGHBOURS` may be full of their part, so blocks of such parts meet those of others too.
    """
    sizes = materialize(
        members.groupBy(F.col("part").alias("p")).agg(
            F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"),
            (F.count(F.lit(1)) > NEIGHBOURS).alias("crowded"),
        ),
        "part_sizes",
    )
    placed = members.join(sizes, F.col("part") == F.col("p")).select(
        "node", "part", "dim", "vector", "copies", "blocks", "crowded",
        F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block"),
    )
    placed = materialize(placed, "placed")
    # Small parts: a few blocks' worth of nodes in a group.
    bins = placed.count() // (2 * BLOCK) + 1
    small = placed.where("blocks = 1").select(
        "node", "part", "dim", "vector", "copies",
        F.lit(0).alias("block"), F.lit(0).alias("other"),
        F.pmod(F.xxhash64("part"), F.lit(bins)).cast("long").alias("bin"),
    )
    crowded = placed.where("blocks > 1 OR crowded")
    balls = materialize(
        crowded.groupBy("part", "block").applyInArrow(
            _balls,
            "part long, block int, dim int, blocks int, centre array<double>, angle double,"
            " weight long, least long",
        ),
        "balls",
    )
    large = balls.where("blocks > 1")
    mine = large.select(
        F.col("part").alias("p"), F.col("block").alias("a"), F.col("centre").alias("ca"),
        F.col("angle").alias("aa"), F.col("least").alias("la"),
    )
    theirs = large.select(
        F.col("part").alias("q"), F.col("block").alias("b"), F.col("centre").alias("cb"),
        F.col("angle").alias("ab"), F.col("weight").alias("w"), F.col("least").alias("lb"),
    )
    cosine = F.aggregate(
        F.zip_with("ca", "cb", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x
    )
    apart = F.acos(F.least(F.greatest(cosine, F.lit(-1.0)), F.lit(1.0)))
    limit, slack = float(np.arccos(threshold)), REACH_SLACK
    within = (
        mine.join(theirs, F.col("p") == F.col("q"))
        .withColumn("apart", apart)
        .where(F.col("apart") - F.col("aa") - F.col("ab") <= limit + slack)
        .select(
            "p", "q", "a", "b", "w", F.least("la", "lb").alias("least"),
            (
                (F.col("a") != F.col("b"))
                & (F.col("apart") + F.col("aa") + F.col("ab") < limit - slack)
            ).alias("all_link"),
        )
    )
    judged = within.unionByName(_across_parts(balls, limit))
    judged = materialize(judged.withColumn("pair", F.xxhash64("p", "q")), "block_pairs")
    in_block = (F.col("part") == F.col("p")) & (F.col("block") == F.col("a"))
    whole = crowded.join(judged.where("all_link"), in_block).select(
        "node", F.col("w").alias("links"), F.col("least").alias("root")
    )
    unsure = judged.where("NOT all_link").select("p", "q", "a", "b", "pair")
    left = crowded.join(unsure, in_block).select(
        "node", F.col("pair").alias("part"), "dim", "vector", "copies", "block",
        F.col("b").alias("other"), F.lit(-1).cast("long").alias("bin"),
    )
    right_block = (F.col("part") == F.col("q")) & (F.col("block") == F.col("b"))
    right = crowded.join(unsure, right_block).select(
        "node", F.col("pair").alias("part"), "dim", "vector", "copies", F.col("a").alias("block"),
        F.col("b").alias("other"), F.lit(-1).cast("long").alias("bin"),
    )

    def grouped(df: DataFrame, prefix: str):
        # Parts of one block share groups by bin, pairs of larger ones' blocks have their own.
        group = F.when(F.col("bin") < 0, F.xxhash64("part")).otherwise(F.col("bin"))
        named = df.withColumn("group", group).drop("bin")
        named = named.select(*(F.col(c).alias(prefix + c) for c in named.columns))
        return named.groupBy(*(prefix + c for c in ("group", "dim", "block", "other")))

    compared = (
        grouped(left.unionByName(small.select(*left.columns)), "")
        .cogroup(grouped(right.unionByName(small.select(*right.columns)), "r_"))
        .applyInArrow(_compare_blocks(threshold), "node long, links long, root long")
    )
    return compared.unionByName(whole)


def link_near_duplicates(
    table: DataFrame, threshold: float = 0.95, vec_id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row: how many other rows it links with at
    a cosine of `threshold` or more, the smallest id that links reach, and whether it is that.

    Vectors that are NULL, empty or zero, or have a NULL or non-finite component, link with
    nothing; vectors link only with those of their length. Repeated rows are rows each and link
    with each other. A row without an id links, and its id counts as larger than all others. Other
    columns are not read, so they may have any name. An empty table gives an empty result.
    """
    rows = table.select(F.col(vec_id).alias("id"), F.col(vector).alias("given"))
    whole = F.col("given").cast("array<double>")
    nodes = (
        rows.where(usable(F.col("given")))
        .groupBy("given")
        .agg(F.min("id").alias("least_id"), F.count(F.lit(1)).alias("copies"))
        .select("given", whole.alias("vector"), F.size("given").alias("dim"), "least_id", "copies")
    )
    nodes = materialize(nodes.withColumn("node", F.monotonically_increasing_id()), "distinct_vectors")
    units = materialize(nodes.select("node", "dim", "vector").mapInArrow(_to_units, UNITS), "units")

    edges, attempt, best = None, 0, -1.0
    while True:
        graph = neighbour_graph(units, threshold, attempt)
        found = graph.where(F.col("sim") >= threshold - _SLACK).select("node", "near")
        edges = found if edges is None else edges.unionByName(found).distinct()
        parts = _parts(edges)
        recall, links = audit(nodes, parts, threshold, attempt)
        log.info("links found of an audited node: %.4f", recall)
        edges = materialize(edges.unionByName(links), "near_edges")
        if recall >= AUDIT_RECALL:
            break
        attempt += 1
        if attempt >= ATTEMPTS and recall <= best:
            raise RuntimeError(f"only {recall:.4f} of an audited node's links found in {attempt} attempts")
        best = max(best, recall)
    members = (
        nodes.select("node", "dim", "vector", "copies")
        .join(_parts(edges), F.col("node") == F.col("of"))
        .select("node", "part", "dim", "vector", "copies")
    )
    links = materialize(exact_links(members, threshold), "links")
    counted = links.groupBy(F.col("node").alias("linked")).agg(F.sum("links").alias("links"))
    roots = connected_components(links.select("node", "root")).withColumnsRenamed(
        {"node": "rooted", "root": "its_root"}
    )
    described = materialize(
        nodes.join(roots, F.col("node") == F.col("rooted"), "left")
        .join(counted, F.col("node") == F.col("linked"), "left")
        .select(
            "given",
            "least_id",
            F.coalesce("its_root", "node").alias("root"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        ),
        "described",
    )
    least = described.groupBy(F.col("root").alias("r")).agg(F.min("least_id").alias("component_id"))
    least = materialize(least, "component_ids")
    described = materialize(
        described.join(least, F.col("root") == F.col("r")).select(
            F.col("given").alias("g"), "n_links", "component_id"
        ),
        "classes",
    )
    usable_rows = rows.where(usable(F.col("given"))).join(described, F.col("given") == F.col("g"))
    other_rows = rows.where(~usable(F.col("given")))
    both = usable_rows.select("id", "n_links", "component_id").unionByName(
        other_rows.select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    )
    return both.select(
        F.col("id").alias("vec_id"),
        "n_links",
        "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
    )


UNITS = "node long, dim int, unit binary"


def _to_units(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        dims = batch.column("dim").to_numpy()
        for dim in np.unique(dims):
            part = batch.filter(pa.array(dims == dim))
            halves = _units(stacked(part.column("vector"))).astype(np.float16)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("node"),
                    part.column("dim"),
                    pa.array([x.tobytes() for x in halves], pa.binary()),
                ],
                ["node", "dim", "unit"],
            )


def _parts(edges: DataFrame) -> DataFrame:
    """(of, part): the component of every node that has an edge."""
    stars = connected_components(edges.select("node", "near"))
    own = stars.select(F.col("root").alias("of"), F.col("root").alias("part")).distinct()
    every = stars.select(F.col("node").alias("of"), F.col("root").alias("part")).unionByName(own)
    return materialize(every, "parts")
