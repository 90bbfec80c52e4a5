"""Byte-level BPE encoding through a table of distinct words, and decoding through one of pieces.

Spark splits the texts into words, which no piece crosses. A block of documents has a sorted list
of its distinct words. Those lists are dealt out by a hash of the word, so that all blocks' copies
of a word meet in one part; each distinct word is encoded there, once. The ids go back to the
blocks that have the word, whose words are then held as places in the list, and are joined by place.

Lists and places travel as packets, one row for many words: a row for each word would be several
times as large. For the same reason places aren't written but made anew from the texts when the
ids are there; a block is named by its list, so that it finds its ids whatever task makes it.
The vocabulary is read on the driver; its tables, of fixed size, go to the tasks.
"""

from __future__ import annotations

import heapq
import json
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logbraid.functions.lineage import materialize
from logbraid.llm.flat import gather, offsets, opened, packet
from logbraid.llm.rows import row_of, unpacked

# The vocabulary's family splits off these endings, and runs of one class.
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
LETTER, NUMBER, SPACE = r"\p{L}", r"\p{N}", r"\p{IsWhite_Space}"

# Words of a block, whose text is never cut, and distinct words of a part.
BLOCK_WORDS = 2_000_000
PART_WORDS = 200_000
# Documents given out at once.
GIVEN_OUT = 500
RESULTS = ("ids", "n_tokens", "decoded")


@lru_cache
def letters_and_numbers() -> tuple[str, str]:
    """All characters that the tokenizers library takes for letters, and for numbers."""
    from tokenizers.pre_tokenizers import ByteLevel

    split = ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str
    surrogates = range(0xD800, 0xE000)
    every = "".join(chr(c) for c in range(0x110000) if c not in surrogates)
    found = {"a": [], "1": []}
    for _, (first, last) in split(every):
        run = every[first:last].lstrip(" ")
        for example in found:
            if run and len(split(example + run[0])) == 1:
                found[example].append(run)
    return "".join(found["a"]), "".join(found["1"])


def _among(characters: str) -> str:
    """As a nested character class, which tests first whether it is past the least of them."""
    if not characters:
        return ""
    points = np.array(sorted(map(ord, characters)), dtype=np.int64)
    runs = np.split(points, np.flatnonzero(np.diff(points) > 1) + 1)
    ranges = "".join(rf"\x{{{r[0]:x}}}-\x{{{r[-1]:x}}}" for r in runs)
    return rf"[\x{{{points[0]:x}}}-\x{{10ffff}}&&[{ranges}]]"


def word_pattern(spark: SparkSession) -> str:
    """The pattern of a word for this session's JVM, whose Unicode may be older than the
    library's: characters that only the library takes for letters or numbers are named."""
    letters, numbers = letters_and_numbers()
    known = spark.createDataFrame([(letters, numbers)], "l string, n string")
    newer = known.select(F.regexp_replace("l", LETTER, ""), F.regexp_replace("n", NUMBER, ""))
    letter, number = (c + _among(new) for c, new in zip((LETTER, NUMBER), newer.collect()[0]))
    return (
        f"{CONTRACTIONS}| ?[{letter}]+| ?[{number}]+| ?[^{SPACE}{letter}{number}]+"
        f"|{SPACE}+(?![^{SPACE}])|{SPACE}+"
    )


def words_of(text: Column, pattern: str, special: Iterable[str] = ()) -> Column:
    """The words of a text in order, as an array. A special token is a word of its own, and what
    lies between two of them is split as if it were all of a text."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    for token in special:
        literal = "".join(rf"\x{{{ord(c):x}}}" for c in token)
        between = F.transform(
            F.split(text, literal, -1),
            lambda part, i: F.concat(
                F.when(i > 0, F.array(F.lit(token))).otherwise(F.array().cast("array<string>")),
                F.regexp_extract_all(part, F.lit(pattern), F.lit(0)),
            ),
        )
        found = F.when(F.contains(text, F.lit(token)), F.flatten(between)).otherwise(found)
    return found


def byte_characters() -> list[str]:
    """By byte, the character that stands for it in the vocabulary: itself if it prints, else one
    of those from 256 on."""
    prints = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b if b in prints else next(others)) for b in range(256)]


@dataclass(frozen=True)
class BytePairs:
    """A vocabulary: by id the bytes of its piece, the merges in order, and the special tokens."""

    surfaces: tuple[bytes, ...]
    merges: tuple[tuple[int, int, int], ...]  # left, right, merged
    special: dict[str, int]
    byte_ids: tuple[int, ...]

    @classmethod
    def load(cls, path: str) -> BytePairs:
        """Read a vocabulary file. Raises ValueError for those this encoder does not cover."""
        with open(path, encoding="utf-8") as file:
            read = json.load(file)
        model, split = read["model"], read["pre_tokenizer"] or {}
        plain = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix")
        if (
            model["type"] != "BPE"
            or any(model.get(k) for k in (*plain, "fuse_unk", "byte_fallback", "ignore_merges"))
            or read["normalizer"]
            or split.get("type") != "ByteLevel"
            or split.get("add_prefix_space")
            or not split.get("use_regex")
            or read["decoder"]["type"] != "ByteLevel"
        ):
            raise ValueError("only plain byte-level BPE vocabularies are covered")
        added = read["added_tokens"]
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added) or len(added) > 1:
            raise ValueError("more than one added token, or one that takes space, is not covered")
        ids, byte_of = model["vocab"], {c: b for b, c in enumerate(byte_characters())}
        special = {t["content"]: t["id"] for t in added}
        surfaces = [b""] * (1 + max([*ids.values(), *special.values()]))
        for piece, i in ids.items():
            surfaces[i] = bytes(byte_of[c] for c in piece)
        for token, i in special.items():
            surfaces[i] = token.encode()
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        merges = tuple((ids[a], ids[b], ids[a + b]) for a, b in pairs)
        return cls(tuple(surfaces), merges, special, tuple(ids[c] for c in byte_characters()))

    @cached_property
    def merged(self) -> dict[tuple[int, int], tuple[int, int]]:
        """(left, right) to (order, merged)."""
        return {(a, b): (n, into) for n, (a, b, into) in enumerate(self.merges)}

    @cached_property
    def pieces(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(bytes of all pieces, where each begins, its length)."""
        lengths = np.array([len(s) for s in self.surfaces], dtype=np.int64)
        return np.frombuffer(b"".join(self.surfaces), np.uint8), offsets(lengths)[:-1], lengths

    def encode_word(self, word: str) -> list[int]:
        """Merge the pair that comes first in the merges' order, the leftmost of equal ones,
        until none is left. Takes n log n steps for n bytes."""
        if word in self.special:
            return [self.special[word]]
        symbols: list[int] = [self.byte_ids[b] for b in word.encode()]
        merged, size = self.merged, len(symbols)
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        heap = [
            (*merged[pair], at, pair)
            for at, pair in enumerate(zip(symbols, symbols[1:]))
            if pair in merged
        ]
        heap = [(order, at, pair, into) for order, into, at, pair in heap]
        heapq.heapify(heap)
        while heap:
            _, at, pair, into = heapq.heappop(heap)
            right = after[at]
            # Either side may have been merged since.
            if symbols[at] != pair[0] or right >= size or symbols[right] != pair[1]:
                continue
            symbols[at], symbols[right] = into, -1
            after[at] = end = after[right]
            if end < size:
                before[end] = at
            for left, other in ((before[at], at), (at, end)):
                if left >= 0 and other < size:
                    made = (symbols[left], symbols[other])
                    if made in merged:
                        order, result = merged[made]
                        heapq.heappush(heap, (order, left, made, result))
        return [s for s in symbols if s >= 0]

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """The texts of runs of `counts` ids; bytes that are no UTF-8 become U+FFFD."""
        flat, starts, lengths = self.pieces
        sizes = lengths[ids]
        raw = gather(flat, starts[ids], sizes).tobytes()
        ends = offsets(sizes)[offsets(counts)]
        return [raw[a:b].decode(errors="replace") for a, b in zip(ends, ends[1:])]


def _blocks(counts: np.ndarray, most: int) -> Iterator[slice]:
    """Documents in order, cut where a block would hold more words than `most`."""
    first = held = 0
    for i, count in enumerate(counts):
        if held and held + count > most:
            yield slice(first, i)
            first, held = i, 0
        held += int(count)
    if len(counts) > first:
        yield slice(first, len(counts))


def _planes(numbers: np.ndarray) -> bytes:
    """The numbers' low bytes, then their next ones and so on, which compresses better."""
    planes = numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return pa.compress(np.ascontiguousarray(planes).tobytes(), codec="zstd", asbytes=True)


def _from_planes(data: bytes, count: int) -> np.ndarray:
    raw = pa.decompress(data, decompressed_size=4 * count, codec="zstd", asbytes=True)
    planes = np.frombuffer(raw, dtype=np.uint8).reshape(4, count)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


@dataclass(frozen=True)
class Block:
    """Documents in order: the number of words of each, the sorted list of their `distinct`
    words, and of each word the place there, as the place among the most `frequent`."""

    rows: pa.Array
    counts: np.ndarray
    distinct: pa.Array
    frequent: np.ndarray
    places: np.ndarray

    @property
    def name(self) -> str:
        digest = xxhash.xxh3_128(pc.binary_length(self.distinct).to_numpy().tobytes())
        digest.update("".join(self.distinct.to_pylist()).encode())
        return digest.hexdigest()


def _blocks_of(batches: Iterable[pa.RecordBatch], block_words: int) -> Iterator[Block]:
    for batch in batches:
        lists = batch.column("words")
        counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        for part in _blocks(counts, block_words):
            words = lists.slice(part.start, part.stop - part.start).flatten()
            encoded = words.cast(pa.large_string()).dictionary_encode()
            code = encoded.indices.to_numpy()
            order = pc.sort_indices(encoded.dictionary).to_numpy()
            often = np.argsort(-np.bincount(code, minlength=len(order)), kind="stable")
            rank, sorted_at = np.empty_like(often), np.empty_like(order)
            rank[often], sorted_at[order] = np.arange(len(often)), np.arange(len(order))
            yield Block(
                batch.column("row").slice(part.start, part.stop - part.start),
                counts[part].astype("<i8"),
                encoded.dictionary.take(pa.array(order)),
                sorted_at[often],
                rank[code],
            )


def _listed(block_words: int):
    """One row per block: its list of distinct words."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks_of(batches, block_words):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([block.name], pa.string()),
                    pa.array([len(block.distinct)], pa.int64()),
                    pa.array([packet(word=block.distinct)], pa.binary()),
                ],
                ["block", "n_distinct", "distinct"],
            )

    return run


def _coded(block_words: int):
    """One row per block: its documents and the places of their words."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks_of(batches, block_words):
            whole = pa.array([0, len(block.rows)], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([block.name], pa.string()),
                    pa.ListArray.from_arrays(whole, block.rows),
                    pa.array([block.counts.tobytes()], pa.binary()),
                    pa.array([len(block.places)], pa.int64()),
                    pa.array([_planes(block.places)], pa.binary()),
                    pa.array([len(block.distinct)], pa.int64()),
                    pa.array([_planes(block.frequent)], pa.binary()),
                ],
                ["block", "rows", "counts", "n_words", "places", "n_distinct", "frequent"],
            )

    return run


def _dealt(parts: int):
    """Each block's distinct words to the parts that their hashes name."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, data in zip(batch.column("block").to_pylist(), batch.column("distinct")):
                words = opened(data.as_py()).column("word")
                part = np.array(
                    [zlib.crc32(w.encode()) % parts for w in words.to_pylist()], dtype=np.int64
                )
                order = np.argsort(part, kind="stable")
                named, starts = np.unique(part[order], return_index=True)
                rows = [
                    packet(step=_steps(at), word=words.take(pa.array(at)))
                    for at in np.split(order, starts[1:])
                    if len(at)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(named, pa.int64()),
                        pa.array([block] * len(named), pa.string()),
                        pa.array(rows, pa.binary()),
                    ],
                    ["part", "block", "words"],
                )

    return run


def _steps(places: np.ndarray) -> np.ndarray:
    return np.diff(places, prepend=0).astype(np.int32)


def _encoded(vocabulary):
    """A part's distinct words, each encoded once, and their ids back to every block."""

    def run(part: pa.Table) -> pa.Table:
        packets = [opened(data.as_py()) for data in part.column("words")]
        words = pa.chunked_array([p.column("word") for p in packets], pa.large_string())
        encoded = words.combine_chunks().dictionary_encode()
        ids = [vocabulary.value.encode_word(w) for w in encoded.dictionary.to_pylist()]
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter((i for word in ids for i in word), np.uint32, int(lengths.sum()))
        starts, index = offsets(lengths)[:-1], encoded.indices.to_numpy()
        names = ["block", "places", "n_ids", "ids"]
        out: dict[str, list] = {n: [] for n in names}
        first = 0
        for block, p in zip(part.column("block").to_pylist(), packets):
            at = index[first : first + p.num_rows]
            first += p.num_rows
            own = gather(flat, starts[at], lengths[at])
            known = packet(step=p.column("step"), length=lengths[at].astype(np.int32))
            for name, value in zip(names, (block, known, len(own), _planes(own))):
                out[name].append(value)
        kinds = (pa.string(), pa.binary(), pa.int64(), pa.binary())
        return pa.table([pa.array(out[n], kind) for n, kind in zip(names, kinds)], names=names)

    return run


def _assembled(vocabulary):
    """Each block's documents with the ids of their words in order, decoded again."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield from _block(vocabulary.value, batch, i)

    return run


def _block(vocabulary: BytePairs, batch: pa.RecordBatch, i: int) -> Iterator[pa.RecordBatch]:
    def value(name):
        return batch.column(name)[i].as_py()

    lengths = np.zeros(value("n_distinct"), dtype=np.int64)
    starts, flat, held = np.zeros_like(lengths), [], 0
    for known in value("known") or ():
        steps = opened(known["places"])
        at, own = np.cumsum(steps.column("step").to_numpy()), steps.column("length").to_numpy()
        lengths[at], starts[at] = own, held + offsets(own)[:-1]
        flat.append(_from_planes(known["ids"], known["n_ids"]))
        held += known["n_ids"]
    if not lengths.all():
        raise RuntimeError("texts came out otherwise when read again; encode a written table")
    table = np.concatenate(flat) if flat else np.zeros(0, dtype=np.uint32)
    frequent = _from_planes(value("frequent"), len(lengths))
    places = frequent[_from_planes(value("places"), value("n_words"))]
    counts = np.frombuffer(value("counts"), dtype="<i8")
    rows, begins = batch.column("rows")[i].values, offsets(counts)
    for first in range(0, len(counts), GIVEN_OUT):
        part = slice(first, min(first + GIVEN_OUT, len(counts)))
        at = places[begins[part.start] : begins[part.stop]]
        ids = gather(table, starts[at], lengths[at]).astype(np.int32)
        ends = offsets(lengths[at])[begins[part.start : part.stop + 1] - begins[part.start]]
        sizes = np.diff(ends)
        yield pa.RecordBatch.from_arrays(
            [
                rows.slice(part.start, part.stop - part.start),
                pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids)),
                pa.array(sizes, pa.int64()),
                pa.array(vocabulary.decode(ids, sizes), pa.string()),
            ],
            ["row", *RESULTS],
        )


def encode_through_words(
    docs: DataFrame, vocabulary: str, text: str = "text", block_words: int = BLOCK_WORDS
) -> DataFrame:
    """`docs` with its `ids` as integers, their number `n_tokens`, and the text `decoded` from them.

    `vocabulary` is the path of a file on the driver; no token is added to a text, and the string
    of a special token is that token. Texts are encoded whole, of any length; a very long one is
    a block of its own. The texts are read twice and must come out alike, as from a table; else the
    job fails. A NULL or empty text has no ids. Repeated rows come out alike, an empty
    table gives an empty result, and columns named as the results are replaced.
    """
    spark = docs.sparkSession
    loaded = BytePairs.load(vocabulary)
    shared = spark.sparkContext.broadcast(loaded)
    without = [c for c in docs.columns if c.lower() != text.lower()]
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    words = words_of(whole, word_pattern(spark), loaded.special)
    rows = docs.select(row_of(docs, without), words.alias("words"))
    listed = materialize(
        rows.mapInArrow(_listed(block_words), "block string, n_distinct long, distinct binary"),
        "distinct_words",
    )
    total = listed.agg(F.sum("n_distinct")).collect()[0][0] or 0
    dealt = listed.select("block", "distinct").mapInArrow(
        _dealt(-(-total // PART_WORDS) or 1), "part long, block string, words binary"
    )
    encoded = dealt.groupBy("part").applyInArrow(
        _encoded(shared), "block string, places binary, n_ids long, ids binary"
    )
    packets = F.collect_list(F.struct("places", "n_ids", "ids"))
    known = encoded.groupBy("block").agg(packets.alias("known"))
    coded = rows.mapInArrow(
        _coded(block_words),
        T.StructType()
        .add("block", T.StringType())
        .add("rows", T.ArrayType(rows.schema["row"].dataType))
        .add("counts", T.BinaryType())
        .add("n_words", T.LongType())
        .add("places", T.BinaryType())
        .add("n_distinct", T.LongType())
        .add("frequent", T.BinaryType()),
    )
    assembled = coded.join(known, "block", "left").mapInArrow(
        _assembled(shared),
        T.StructType()
        .add("row", rows.schema["row"].dataType)
        .add("ids", T.ArrayType(T.IntegerType()))
        .add("n_tokens", T.LongType())
        .add("decoded", T.StringType()),
    )
    return unpacked(assembled, without, RESULTS)
