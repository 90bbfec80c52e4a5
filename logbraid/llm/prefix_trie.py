"""The trie of all conversations' prefixes, through tables of nodes without collisions.

A prefix is told by a digest: the sum of its turns' keys, each times a power of a base by its
place. Sums of parts of a conversation can be put together, so a conversation may lie in many
tasks. Conversations are dealt into shards by blocks of near ids. A shard's distinct digests get a
minimal perfect hash, so that each node is a slot of flat arrays; a digest looked up is compared
with the one that the slot holds, as the hash answers for strangers too. Counts are scattered into
the arrays, and sums over subtrees run through the array of parents' slots, deepest first.

A node that many shards have is put together by Spark from one row per shard. What a node adds to
the sums of its ancestors is counted in one shard alone, that of its smallest member, which has
all ancestors. Very deep tries are cut into bands of depth, so that one conversation's part of a
shard is bounded; the sums at the top of a band go on to the band above.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logbraid.functions.lineage import materialize
from logbraid.llm.rows import words_in

# Odd, and three more than a multiple of eight, so that their powers run through many values.
BASES = (np.uint64(0x9E3779B97F4A7C13), np.uint64(0xC2B2AE3D27D4EB4B))

# Turns in a shard, near ids that stay together, and depths of a band.
SHARD_TURNS = 1 << 14
NEAR_BITS = 5
BAND = 1 << 16
# Ids written as one text before they are hashed.
IDS_IN_TEXT = 8192

_DIGEST = ("a", "b")
_PARENT = ("pa", "pb")


class MinimalPerfectHash:
    """Numbers distinct digests 0, 1, 2 and so on, from bits alone.

    Digests that are alone in their cell of a level get the number of that cell among the taken
    ones; the others go to the next level. For a digest that isn't among them any number or -1
    comes out, so compare.
    """

    CELLS = 2.0  # per digest

    def __init__(self, digests: np.ndarray) -> None:
        self._levels: list[tuple[np.ndarray, int]] = []
        numbered, rest = 0, digests
        while len(rest):
            cell = self._cells(rest, len(self._levels), int(self.CELLS * len(rest)) + 1)
            taken = np.bincount(cell, minlength=int(self.CELLS * len(rest)) + 1) == 1
            number = np.where(taken, numbered + np.cumsum(taken) - 1, -1)
            self._levels.append((number, len(taken)))
            numbered += int(taken.sum())
            rest = rest[~taken[cell]]

    @staticmethod
    def _cells(digests: np.ndarray, level: int, cells: int) -> np.ndarray:
        x = digests[:, 0] + np.uint64(level + 1) * digests[:, 1]
        x ^= x >> np.uint64(29)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(32)
        return (x % np.uint64(cells)).astype(np.int64)

    def __call__(self, digests: np.ndarray) -> np.ndarray:
        out = np.full(len(digests), -1, dtype=np.int64)
        open_ = np.arange(len(digests))
        for level, (number, cells) in enumerate(self._levels):
            out[open_] = number[self._cells(digests[open_], level, cells)]
            open_ = open_[out[open_] < 0]
        return out


class NodeTable:
    """The nodes of a shard's band as slots of flat arrays."""

    def __init__(self, digests: np.ndarray, parents: np.ndarray, depth: np.ndarray) -> None:
        order = np.lexsort((digests[:, 1], digests[:, 0]))
        new = np.ones(len(order), dtype=bool)
        new[1:] = (digests[order[1:]] != digests[order[:-1]]).any(axis=1)
        one = order[new]  # a row of each distinct digest
        self._hash = MinimalPerfectHash(digests[one])
        slot = self._hash(digests[one])
        self.size = len(one)
        self.row = np.empty(self.size, dtype=np.int64)
        self.row[slot] = one
        self.digests, self.depth = digests[self.row], depth[self.row]
        self.parent = np.where(self.depth > 0, self.slots(parents[self.row]), -1)

    def slots(self, digests: np.ndarray) -> np.ndarray:
        """The slots of these digests; -1 for those that are no nodes here."""
        found = self._hash(digests)
        known = found >= 0
        known[known] = (self.digests[found[known]] == digests[known]).all(axis=1)
        return np.where(known, found, -1)

    def add_to_ancestors(self, *sums: np.ndarray) -> None:
        """Add each slot's sum to its parent's, deepest first."""
        deepest = np.argsort(-self.depth, kind="stable")
        cuts = np.flatnonzero(np.diff(self.depth[deepest])) + 1
        for level in np.split(deepest, cuts):
            level = level[self.parent[level] >= 0]
            for each in sums:
                np.add.at(each, self.parent[level], each[level])


def _long(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64) if values.dtype == np.uint64 else values, pa.int64())


def _column(table: pa.Table | pa.RecordBatch, name: str) -> np.ndarray:
    column = table.column(name)
    chunked = isinstance(column, pa.ChunkedArray)
    return (column.combine_chunks() if chunked else column).to_numpy(zero_copy_only=False)


def _digests(table: pa.Table, names: tuple[str, str]) -> np.ndarray:
    pair = [_column(table, n).astype(np.int64).view(np.uint64) for n in names]
    return np.column_stack(pair) if len(pair[0]) else np.zeros((0, 2), dtype=np.uint64)


def turns_of(
    conversations: DataFrame,
    id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """(conv, place, key, words): each conversation's turns in order, from 1 without a gap, told
    by a key of role and text.

    Order is by turn, NULL first, and of equal turns by role, then key, so that any order of rows
    gives the same. NULL roles and texts are empty. Rows without an id are no turns.
    """
    said_by = F.coalesce(F.col(role).cast("string"), F.lit(""))
    said = F.coalesce(F.col(text).cast("string"), F.lit(""))
    key = F.unhex(F.md5(F.concat_ws(":", F.length(said_by).cast("string"), said_by, said)))
    rows = conversations.where(F.col(id).isNotNull()).select(
        F.col(id).cast("bigint").alias("conv"),
        F.col(turn).alias("turn"),
        said_by.alias("role"),
        key.alias("key"),
        words_in(said).alias("words"),
    )
    # Ranges are sampled, so texts would be read twice.
    rows = materialize(rows, "turns")
    return _scanned(rows, ["turn", "role", "key"]).select("conv", "place", "key", "words")


def _scanned(turns: DataFrame, order: list[str]) -> DataFrame:
    """`turns` (conv, key, words) with `place`, digest (a, b) and parent's digest (pa, pb).

    A conversation may lie in many tasks: each scans its range of rows on its own, and what lies
    before it in its first conversation is told by one row per task.
    """
    ranged = turns.repartitionByRange("conv", *order).sortWithinPartitions("conv", *order)
    plain = "conv long, place long, key binary, words long, a long, b long"
    local = materialize(
        ranged.select("conv", "key", "words").mapInArrow(_scan, f"part long, {plain}"), "scanned"
    )
    parts = local.groupBy("part").agg(
        F.min("conv").alias("first"),
        F.max(F.struct("conv", "place", "a", "b")).alias("last"),
    )
    before: dict[int, tuple[int, ...]] = {}
    conv, state = None, (0, 0, 0)
    for part, first, last in sorted(parts.collect()):
        if conv != first:
            state = (0, 0, 0)
        before[part] = (first, *state)
        state = _joined(state if first == last[0] else (0, 0, 0), last[1:])
        conv = last[0]

    def finish(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _finished(batch, before)

    return local.mapInArrow(finish, f"{plain}, pa long, pb long")


def _signed(value: np.uint64) -> int:
    return int(np.array([value], dtype=np.uint64).view(np.int64)[0])


def _joined(first: tuple[int, int, int], then: tuple[int, int, int]) -> tuple[int, int, int]:
    """(turns, digest) of one part of a conversation and the next."""
    shift = np.array([first[0]], dtype=np.uint64)
    digest = (
        np.array([x], dtype=np.int64).view(np.uint64)
        + np.power(base, shift) * np.array([y], dtype=np.int64).view(np.uint64)
        for x, y, base in zip(first[1:], then[1:], BASES)
    )
    return (first[0] + then[0], *(_signed(d[0]) for d in digest))


def _keys(batch: pa.RecordBatch) -> np.ndarray:
    keys = batch.column("key").cast(pa.binary(16))
    raw = np.frombuffer(keys.buffers()[1], dtype="<u8")
    return raw[2 * keys.offset : 2 * (keys.offset + len(keys))].reshape(-1, 2)


def _terms(keys: np.ndarray, place: np.ndarray) -> list[np.ndarray]:
    at = place.astype(np.uint64)
    return [keys[:, k] * np.power(base, at) for k, base in enumerate(BASES)]


def _scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId()
    held = (None, 0, np.uint64(0), np.uint64(0))
    for batch in batches:
        if not batch.num_rows:
            continue
        conv, at = _column(batch, "conv"), np.arange(batch.num_rows)
        first = np.maximum.accumulate(np.where(np.r_[True, conv[1:] != conv[:-1]], at, 0))
        goes_on = (first == 0) & (conv == held[0]) if held[0] is not None else first < 0
        place = at - first + 1 + np.where(goes_on, held[1], 0)
        digest = []
        for k, term in enumerate(_terms(_keys(batch), place)):
            total = np.cumsum(term)
            total = total - (total[first] - term[first])
            digest.append(total + np.where(goes_on, held[2 + k], np.uint64(0)))
        held = (conv[-1], place[-1], digest[0][-1], digest[1][-1])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(conv), part), pa.int64()),
                batch.column("conv"),
                pa.array(place, pa.int64()),
                batch.column("key"),
                batch.column("words"),
                *map(_long, digest),
            ],
            ["part", "conv", "place", "key", "words", *_DIGEST],
        )


def _finished(batch: pa.RecordBatch, before: dict[int, tuple[int, ...]]) -> pa.RecordBatch:
    part, conv, place = (_column(batch, n) for n in ("part", "conv", "place"))
    known = np.array([(p, *before[p]) for p in np.unique(part).tolist()], dtype=np.int64)
    known = known.reshape(-1, 5)
    row = np.searchsorted(known[:, 0], part)
    held = np.where((known[row, 1] == conv)[:, None], known[row, 2:], 0)
    shift = held[:, 0].astype(np.uint64)
    digest, parent = [], []
    for k, (base, term) in enumerate(zip(BASES, _terms(_keys(batch), place))):
        own, first = _column(batch, _DIGEST[k]).view(np.uint64), held[:, 1 + k].view(np.uint64)
        digest.append(first + np.power(base, shift) * own)
        parent.append(first + np.power(base, shift) * (own - term))
    return pa.RecordBatch.from_arrays(
        [
            batch.column("conv"),
            pa.array(place + held[:, 0], pa.int64()),
            batch.column("key"),
            batch.column("words"),
            *map(_long, (*digest, *parent)),
        ],
        ["conv", "place", "key", "words", *_DIGEST, *_PARENT],
    )


def with_borrowed_starts(turns: DataFrame, every: int = 20, at_most: int = 4) -> DataFrame:
    """`turns` (conv, place, key, words) of conversations rebuilt: the first h turns are those of
    the conversation conv - conv % every, as many as it has, and what follows are the own ones
    after the first h. h is the CRC-32 of the id's digits modulo `at_most`.

    Places keep their order but may have gaps.
    """
    borrowed = F.crc32(F.col("conv").cast("string").cast("binary")) % at_most
    own = turns.where(F.col("place") > borrowed)
    lenders = turns.where((F.col("conv") % every == 0) & (F.col("place") < at_most))
    lent = turns.where("place = 1").select(
        "conv", (F.col("conv") - F.col("conv") % every).alias("lender")
    )
    lent = lent.join(lenders.withColumnRenamed("conv", "lender"), "lender")
    return own.unionByName(lent.where(F.col("place") <= borrowed).drop("lender"))


def _nodes_of_shard(rows: pa.Table) -> pa.Table:
    """One row per node of a shard's band: how many of its conversations have it, and the least."""
    digests, conv, depth = _digests(rows, _DIGEST), _column(rows, "conv"), _column(rows, "depth")
    table = NodeTable(digests, _digests(rows, _PARENT), depth)
    slot = table.slots(digests)
    least = np.full(table.size, np.iinfo(np.int64).max)
    np.minimum.at(least, slot, conv)
    kept = rows.select([*_DIGEST, *_PARENT, "depth", "band", "words", "shard"]).take(pa.array(table.row))
    return kept.append_column("n", _long(np.bincount(slot, minlength=table.size))).append_column(
        "conv", _long(least)
    )


def _sums_of_shard(rows: pa.Table, values: pa.Table) -> pa.Table:
    """Of each node of a shard's band the sums over its subtree of what is counted here."""
    table = NodeTable(_digests(rows, _DIGEST), _digests(rows, _PARENT), _column(rows, "depth"))
    slot = table.slots(_digests(values, _DIGEST))
    sums = []
    for name in _SUMS:
        own = np.zeros(table.size, dtype=np.int64)
        np.add.at(own, slot, _column(values, name))
        sums.append(own)
    table.add_to_ancestors(*sums)
    counted = np.flatnonzero(np.any(sums, axis=0))
    return pa.table(
        [_long(np.ascontiguousarray(table.digests[counted, k])) for k in (0, 1)]
        + [_long(each[counted]) for each in sums],
        names=[*_DIGEST, *_SUMS],
    )


_SUMS = ("n_leaves", "saved_tokens")


def _texts_of_ids(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (a, b, conv) as (a, b, first, ids), the ids of a run of one node in a text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        a, b, conv = (_column(batch, n) for n in (*_DIGEST, "conv"))
        new = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])]
        at = np.arange(len(a))
        run = at - np.maximum.accumulate(np.where(new, at, 0))
        cuts = np.flatnonzero(run % IDS_IN_TEXT == 0)
        texts = [",".join(map(str, ids.tolist())) for ids in np.split(conv, cuts[1:])]
        yield pa.RecordBatch.from_arrays(
            [_long(a[cuts]), _long(b[cuts]), _long(conv[cuts]), pa.array(texts, pa.string())],
            [*_DIGEST, "first", "ids"],
        )


def _hashed_ids(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (a, b, first, ids) as (a, b, ends_sha256), hashing a node's texts as they come."""
    node, digest = None, None
    for batch in batches:
        done = []
        for a, b, ids in zip(*(batch.column(n).to_pylist() for n in (*_DIGEST, "ids"))):
            if (a, b) == node:
                digest.update(f",{ids}".encode())
                continue
            if node is not None:
                done.append((*node, digest.hexdigest()))
            node, digest = (a, b), hashlib.sha256(ids.encode())
        yield _ended(done)
    if node is not None:
        yield _ended([(*node, digest.hexdigest())])


def _ended(rows: list[tuple[int, int, str]]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.string())
    columns = zip(*rows) if rows else ([], [], [])
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), kind) for c, kind in zip(columns, kinds)], [*_DIGEST, "ends_sha256"]
    )


def _hashed_ends(ends: DataFrame) -> DataFrame:
    """(a, b, ends_sha256) of the ids of each node in order. The ids of one node may be many: they
    are sorted in many tasks, and one task hashes their texts, of which it holds one at a time."""
    by_id = ends.repartitionByRange(*_DIGEST, "conv").sortWithinPartitions(*_DIGEST, "conv")
    texts = by_id.mapInArrow(_texts_of_ids, "a long, b long, first long, ids string")
    by_node = texts.repartition(*_DIGEST).sortWithinPartitions(*_DIGEST, "first")
    return by_node.mapInArrow(_hashed_ids, "a long, b long, ends_sha256 string")


def prefix_trie(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row per distinct sequence of first turns of the `conversations` (conv), the root's
    empty one included.

    `turns` are (conv, place, key, words), of whose conversations some may have none; equal keys
    are equal turns. A node's row has conv_id, its smallest member; depth; parent_conv_id, its
    parent's conv_id, NULL for the root; n_convs, its members; n_children; n_leaves, the nodes
    without children in its subtree; saved_tokens, the words of the last turns of its subtree's
    nodes times their members but one; ends_sha256, the SHA-256 of the ids of members that end
    there, ascending, joined by commas.

    Without conversations there is no node. A conversation of any length is cut into bands, each
    of which costs a pass. Turns in `turns` of no conversation must not be there.
    """
    paths = _scanned(turns, ["place"]).withColumnRenamed("place", "depth").drop("key")
    none = [F.lit(0).cast("bigint").alias(c) for c in ("depth", "words", *_DIGEST, *_PARENT)]
    paths = paths.unionByName(conversations.select("conv", *none))
    paths = paths.withColumn("band", F.expr(f"depth div {BAND}"))
    paths = materialize(paths, "paths")
    shards = paths.count() // SHARD_TURNS + 1
    near = F.xxhash64(F.shiftright("conv", NEAR_BITS))
    paths = paths.withColumn("shard", F.pmod(near, F.lit(shards)))

    own = "a long, b long, pa long, pb long, depth long, band long, words long, shard long"
    found = paths.groupBy("band", "shard").applyInArrow(_nodes_of_shard, f"{own}, n long, conv long")
    nodes = found.groupBy(*_DIGEST).agg(
        *(F.first(c).alias(c) for c in (*_PARENT, "depth", "band", "words")),
        F.sum("n").alias("n_convs"),
        F.min(F.struct("conv", "shard")).alias("least"),
    )
    nodes = materialize(nodes.select("*", "least.*").drop("least"), "nodes")
    children = (
        nodes.where("depth > 0")
        .groupBy(*(F.col(p).alias(d) for p, d in zip(_PARENT, _DIGEST)))
        .agg(F.count("*").alias("n_children"))
    )
    nodes = nodes.join(children, [*_DIGEST], "left").fillna(0, ["n_children"])
    nodes = materialize(nodes, "nodes_with_children")

    sums = _subtree_sums(paths, nodes)
    last = F.max(F.struct("depth", *_DIGEST)).alias("last")
    ends = paths.groupBy("conv").agg(last).select("conv", "last.a", "last.b")
    parents = nodes.select(
        *(F.col(d).alias(p) for p, d in zip(_PARENT, _DIGEST)),
        F.col("conv").alias("parent_conv_id"),
        (F.col("depth") + 1).alias("depth"),
    )
    whole = (
        nodes.join(sums, [*_DIGEST], "left")
        .join(_hashed_ends(ends), [*_DIGEST], "left")
        .join(parents, [*_PARENT, "depth"], "left")
    )
    return whole.select(
        F.col("conv").alias("conv_id"),
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        *(F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in _SUMS),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )


def _subtree_sums(paths: DataFrame, nodes: DataFrame) -> DataFrame:
    """(a, b, n_leaves, saved_tokens), band by band from the deepest."""
    own = nodes.select(
        "band",
        "shard",
        *_DIGEST,
        (F.col("n_children") == 0).cast("bigint").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens"),
    )
    deepest = nodes.agg(F.max("band")).collect()[0][0] or 0
    done, carried = None, None
    for band in range(deepest, -1, -1):
        values = own.where(F.col("band") == band).drop("band")
        if carried is not None:
            values = values.unionByName(carried)
        sums = (
            paths.where(F.col("band") == band)
            .groupBy("shard")
            .cogroup(values.groupBy("shard"))
            .applyInArrow(_sums_of_shard, "a long, b long, n_leaves long, saved_tokens long")
            .groupBy(*_DIGEST)
            .agg(*(F.sum(c).alias(c) for c in _SUMS))
        )
        if deepest:
            sums = materialize(sums, "sums_of_band")
        if band:
            tops = nodes.where(F.col("depth") == band * BAND).select(*_DIGEST, *_PARENT)
            up = sums.join(tops, [*_DIGEST]).groupBy(
                *(F.col(p).alias(d) for p, d in zip(_PARENT, _DIGEST))
            )
            carried = up.agg(*(F.sum(c).alias(c) for c in _SUMS)).join(
                nodes.where(F.col("depth") == band * BAND - 1).select(*_DIGEST, "shard"), [*_DIGEST]
            )
        done = sums if done is None else done.unionByName(sums)
    return done
