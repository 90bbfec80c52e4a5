"""SimHash near-duplicates, searched in BK-trees.

A document's fingerprint has a bit set where over half of its shingles' hashes have it. Equal
fingerprints are one. Fingerprints that differ in at most r bits agree in one of r + 1 blocks
of bits, so each is put into a shard per block, by the block's value; a shard of many is dealt
into several trees of bounded size, which every member visits. In a tree children hang by their
Hamming distance to the parent, and a search follows only edges that the radius can reach.

A tree keeps its members' components as it grows and hands on one edge per member and component,
not one per pair. Components over all trees are found in rounds over stars.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logbraid.functions.lineage import materialize
from logbraid.llm.arrow import in_parts, texts_of
from logbraid.llm.components import Forest, connected_components
from logbraid.llm.rows import packed, row_of, unpacked

# The seed of the shingles' hashes and the width of a fingerprint.
SEED, WIDTH = 42, 64
TREE_SIZE = 4096
# Texts that are surely not among those asked for stay out of a shuffle. Which may be is told by
# slots of their hashes, whose broadcast is bounded: two million rows of eight bytes.
SLOTS = 1 << 21
RESULTS = ("fingerprint", "component_id")
_HASHES_AT_ONCE = 1 << 14


def shingle_hashes(text: str, words: int) -> np.ndarray:
    """XXH64 of every run of `words` words, A-Z in lower case, joined by spaces; of all words if
    they are fewer. Flat arrays hold the places and hashes, as a text may have millions of words."""
    found = text.encode("utf-8", "replace").lower().split()
    # `lower` and `split` on bytes know ASCII only, as asked for.
    joined, n, digest = b" ".join(found), len(found), xxhash.xxh64_intdigest
    if n <= words:
        return np.array([digest(joined, SEED)] if found else [], dtype=np.uint64)
    starts = np.zeros(n + 1, dtype=np.int64)
    np.cumsum(np.fromiter(map(len, found), np.int64, n) + 1, out=starts[1:])
    del found
    runs = zip(map(int, starts), map(int, starts[words:] - 1))
    return np.fromiter((digest(joined[a:b], SEED) for a, b in runs), np.uint64, n - words + 1)


def majority_bits(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Per run of `counts` hashes the bits set in over half of them; none of none."""
    sums = np.zeros((len(counts), WIDTH), dtype=np.int64)
    owner = np.repeat(np.arange(len(counts)), counts)
    for first in range(0, len(hashes), _HASHES_AT_ONCE):
        part = hashes[first : first + _HASHES_AT_ONCE]
        bits = np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        mine = owner[first : first + _HASHES_AT_ONCE]
        starts = np.flatnonzero(np.r_[True, mine[1:] != mine[:-1]])
        sums[mine[starts]] += np.add.reduceat(bits, starts, axis=0, dtype=np.int64)
    set_bits = (2 * sums > counts[:, None]).astype(np.uint8)
    return np.packbits(set_bits, axis=1, bitorder="little").view("<u8").reshape(-1)


def with_fingerprint(docs: DataFrame, text: str = "text", words: int = 3) -> DataFrame:
    """`docs` with `fingerprint` as a long. Without words it is zero."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in in_parts(batch, "text"):
                hashes = [shingle_hashes(t, words) for t in texts_of(part, "text")]
                counts = np.array([len(h) for h in hashes], dtype=np.int64)
                flat = np.concatenate([np.zeros(0, dtype=np.uint64), *hashes])
                prints = majority_bits(flat, counts).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), pa.array(prints, pa.int64())], ["row", "fingerprint"]
                )

    without = [c for c in docs.columns if c.lower() != text.lower()]
    row = row_of(docs, without)
    rows = docs.select(row, F.col(text).cast("string").alias("text"))
    schema = T.StructType([rows.schema["row"]]).add("fingerprint", T.LongType())
    return unpacked(rows.mapInArrow(run, schema), without, ["fingerprint"])


class BKTree:
    """Fingerprints whose children hang by their Hamming distance to the parent."""

    def __init__(self, radius: int) -> None:
        self.radius = radius
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def near(self, value: int) -> list[int]:
        """Places, in order of adding, of members at most the radius away."""
        if not self.values:
            return []
        radius, values, children, found, stack = self.radius, self.values, self.children, [], [0]
        while stack:
            node = stack.pop()
            away = (values[node] ^ value).bit_count()
            if away <= radius:
                found.append(node)
            for edge, child in children[node].items():
                if -radius <= edge - away <= radius:
                    stack.append(child)
        return found

    def add(self, value: int) -> None:
        self.values.append(value)
        self.children.append({})
        node, new = 0, len(self.values) - 1
        while node != new:
            away = (self.values[node] ^ value).bit_count()
            node = self.children[node].setdefault(away, new)


def _blocks(value: Column, radius: int) -> Column:
    """A struct per block of bits: which it is and its value there."""
    cuts = [WIDTH * i // (radius + 1) for i in range(radius + 2)]
    return F.array(
        *(
            F.struct(
                F.lit(i).alias("block"),
                F.shiftrightunsigned(value, low)
                .bitwiseAND(F.lit((1 << (high - low)) - 1))
                .alias("bits"),
            )
            for i, (low, high) in enumerate(zip(cuts, cuts[1:]))
        )
    )


def _search_trees(radius: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, tree, forest = None, BKTree(radius), Forest()
        for batch in batches:
            edges = []
            names = ("block", "bits", "tree", "member", "value")
            columns = (batch.column(n).to_pylist() for n in names)
            for block, bits, number, member, value in zip(*columns):
                if (block, bits, number) != shard:
                    shard, tree, forest = (block, bits, number), BKTree(radius), Forest()
                found = [tree.values[x] for x in tree.near(value & (1 << WIDTH) - 1)]
                # One edge for each component that the tree has so far.
                edges += [(value, root) for root in {forest.root(_signed(x)) for x in found}]
                if member:
                    tree.add(value & (1 << WIDTH) - 1)
                    for x in found:
                        forest.join(value, _signed(x))
            columns = list(zip(*edges)) or [(), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b"])

    return run


def _signed(value: int) -> int:
    return value - (1 << WIDTH) if value >> WIDTH - 1 else value


def near_links(values: DataFrame, radius: int, tree_size: int = TREE_SIZE) -> DataFrame:
    """Edges (a, b) between fingerprints that connect exactly those that links of at most
    `radius` differing bits connect. `values` has each fingerprint once, as `value`."""
    keyed = values.select("value", F.inline(_blocks(F.col("value"), radius)))
    keyed = materialize(keyed, "blocks")
    shards = materialize(
        keyed.groupBy(F.col("block").alias("b"), F.col("bits").alias("v"))
        .agg(F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .select("b", "v", F.ceil(F.col("n") / tree_size).cast("int").alias("trees")),
        "shards",
    )
    own = F.pmod(F.xxhash64("value"), F.col("trees")).cast("int")
    visits = (
        keyed.join(shards, (F.col("block") == F.col("b")) & (F.col("bits") == F.col("v")))
        .withColumn("own", own)
        # Of two trees' members, those of the earlier tree visit the later one.
        .select("value", "block", "bits", "own", F.explode(F.sequence("own", F.col("trees") - 1)).alias("tree"))
        .select("block", "bits", "tree", (F.col("tree") == F.col("own")).alias("member"), "value")
    )
    return (
        visits.repartition("block", "bits", "tree")
        .sortWithinPartitions("block", "bits", "tree", F.desc("member"))
        .mapInArrow(_search_trees(radius), "a long, b long")
    )


def _slots(keys: DataFrame, column: str) -> DataFrame:
    """The slots that `keys` fall into: at most `SLOTS` rows, however many keys there are."""
    return materialize(keys.select(_slot(column).alias("slot")).distinct(), "slots")


def _slot(column: str) -> Column:
    return F.pmod(column, F.lit(SLOTS))


def text_key(text: Column) -> tuple[Column, Column]:
    """Two hashes of the whole text."""
    return F.xxhash64(text).alias("v1"), F.xxhash64(F.lit("second"), text).alias("v2")


def near_copy_groups(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    words: int = 3,
    radius: int = 2,
) -> DataFrame:
    """(v1, v2, root, component_id): each distinct text of `docs`, by two hashes, that shares its
    group with another row; the group, and its smallest id. Groups are `near_duplicates`'
    components; its rules for NULLs, empty, short and long texts hold. Columns beside id and text
    are not read, so they may have any name.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    texts = docs.select(F.col(doc_id).alias("id"), *text_key(whole), whole.alias("text"))
    printed = materialize(with_fingerprint(texts, words=words), "fingerprints")
    distinct = materialize(
        printed.groupBy("v1", "v2", "fingerprint").agg(F.count(F.lit(1)).alias("n")), "texts"
    )
    members = members_of(printed, radius)
    joined = distinct.join(members, F.col("fingerprint") == F.col("value"))
    sizes = joined.groupBy(F.col("root").alias("r")).agg(F.sum("n").alias("n_rows"))
    larger = materialize(sizes.where("n_rows > 1").select("r"), "larger_groups")
    return joined.join(larger, F.col("root") == F.col("r")).select(
        "v1", "v2", "root", "component_id"
    )


def keep_one_of_each(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    words: int = 3,
    radius: int = 2,
) -> DataFrame:
    """One row of each of `near_duplicates`' components of `docs`: the one with the smallest id,
    and of rows that share it the least by the hashes of their text, then of the whole row.

    NULL and empty texts are one group, with all whose fingerprint is near zero. A NULL id stays
    only where its group has no other. Texts are read whole, however long. An empty table gives an empty result, and columns beside
    id and text may have any name.
    """
    groups = materialize(near_copy_groups(docs, doc_id, text, words, radius), "groups").select(
        F.col("v1").alias("k1"), F.col("v2").alias("k2"), "root", F.col("component_id").alias("kept_id")
    )
    v1, v2 = text_key(F.coalesce(F.col(text), F.lit("")))
    rows = packed(docs, id=F.col(doc_id), v1=v1, v2=v2)
    # Most texts are in no group, nor in a slot with one that is, and stay where they are.
    slots, in_slot = F.broadcast(_slots(groups, "k1")), _slot("v1") == F.col("slot")
    alone, unsure = rows.join(slots, in_slot, "left_anti"), rows.join(slots, in_slot, "left_semi")
    same_text = (F.col("v1") == F.col("k1")) & (F.col("v2") == F.col("k2"))
    grouped = unsure.join(groups, same_text, "left").where("kept_id <=> id OR k1 IS NULL")
    # A text in no group is its only row, so that it is a group by its own hashes.
    own = [F.when(F.col("k1").isNull(), F.col(v)).alias(f"own_{v}") for v in ("v1", "v2")]
    order = F.struct("v1", "v2", F.xxhash64("row"))
    once = grouped.groupBy("root", *own).agg(F.min_by("row", order).alias("row"))
    return unpacked(alone.select("row").unionByName(once.select("row")), docs.columns, [])


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    words: int = 3,
    radius: int = 2,
) -> DataFrame:
    """`docs` without the text, with `fingerprint` in 16 hex digits and `component_id`, the
    smallest id reachable over links of at most `radius` differing bits.

    A NULL or empty text has fingerprint zero, which links as any other. Fewer words than a
    shingle has are one shingle. Rows with one id each have their own fingerprint and component.
    A NULL id is never a component's smallest unless it has no other. Texts are read whole; a task
    holds one long text at a time, and some bytes a word beside it. An empty table gives an empty
    result, and columns named as the results are replaced.
    """
    without = [c for c in docs.columns if c.lower() != text.lower()]
    row = row_of(docs, without)
    own = docs.select(row, F.col(doc_id).alias("id"), F.col(text).alias("text"))
    printed = materialize(with_fingerprint(own, words=words), "fingerprints")
    members = members_of(printed, radius)
    joined = printed.join(members, printed["fingerprint"] == members["value"])
    return unpacked(
        joined.select(
            "row",
            F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"),
            "component_id",
        ),
        without,
        RESULTS,
    )


def members_of(printed: DataFrame, radius: int) -> DataFrame:
    """(value, root, component_id) of every fingerprint of `printed`, which has id and fingerprint.
    One component has one root."""
    values = materialize(
        printed.groupBy(F.col("fingerprint").alias("value")).agg(F.min("id").alias("least_id")),
        "values",
    )
    roots = connected_components(near_links(values.select("value"), radius))
    rooted = values.join(roots, values["value"] == roots["node"], "left").select(
        "value", "least_id", F.coalesce("root", "value").alias("root")
    )
    rooted = materialize(rooted, "rooted")
    least = rooted.groupBy(F.col("root").alias("r")).agg(F.min("least_id").alias("component_id"))
    least = materialize(least, "component_ids")
    members = rooted.join(least, F.col("root") == F.col("r")).select(
        "value", "root", "component_id"
    )
    return materialize(members, "members")
