"""Phrases of words that stand together more often than their parts would tell, by partitioning.

Documents are dealt into shards. A phrase found often enough in all of them is found in at least
one shard at least as often as that shard's share of the words tells. So every shard is mined
completely at its lowered support: its words, then phrases of two words that are both frequent in
the shard, then those of three whose parts of two are, and so on. What is frequent in a shard is
remembered in a table of bits of fixed size, by hashes. Hashes that collide make a phrase a
candidate in vain, and none is lost. Last the candidates of all shards are counted exactly, in all
documents, by their words.

A shard isn't a task: its phrases are counted by Spark, in as many tasks as it likes, and counted
in each task before they are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logbraid.functions.lineage import materialize
from logbraid.llm.flat import strings

# Bytes that end a piece, and those that only end a word.
PIECE_ENDS, BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
UNNAMED = "und"

# Below a phrase's count in all documents a shard's share must ask for more than one, or it is
# no sieve; so few shards serve low supports.
SHARDS = 3
# Hashes remembered: bits, of which a page holds so many.
BITS, PAGE = 1 << 27, 1 << 15
RANKED = 2000
# Bytes of text handled at once; one text is never cut.
PART_BYTES = 1 << 22


def _byte_classes() -> tuple[np.ndarray, np.ndarray]:
    """By byte: 0 in a word, 1 between words, 2 at the end of a piece; and its lower case."""
    kind, lower = np.zeros(256, dtype=np.uint8), np.arange(256, dtype=np.uint8)
    kind[list(BLANKS)], kind[list(PIECE_ENDS)] = 1, 2
    lower[ord("A") : ord("Z") + 1] += ord("a") - ord("A")
    return kind, lower


_KIND, _LOWER = _byte_classes()


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of two hashes in order."""
    x = a * np.uint64(0x9E3779B97F4A7C15) + b
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _hashes(texts: list[str]) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(t) for t in texts), np.uint64, len(texts))


class Words:
    """The words of a batch's texts, in order: `code` in the list of `distinct` ones, the `piece`
    each is in, and the number of the `group` of its text."""

    def __init__(self, texts: pa.Array, group: np.ndarray) -> None:
        texts = texts.cast(pa.large_string()).fill_null("")
        bounds = np.frombuffer(texts.buffers()[1], dtype=np.int64)
        bounds = bounds[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)
        data = data[bounds[0] : bounds[-1]]
        bounds = bounds - bounds[0]
        kind = _KIND[data]
        inside = kind == 0
        breaks = np.zeros(len(data) + 1, dtype=bool)  # a text begins
        breaks[bounds] = True
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1] | breaks[1:-1]
        last[:-1] &= ~inside[1:] | breaks[1:-1]
        starts = np.flatnonzero(first)
        # A piece ends at its mark or with its text.
        text = np.searchsorted(bounds, starts, side="right") - 1
        self.piece = (np.cumsum(kind == 2, dtype=np.int32)[starts] + text).astype(np.int32)
        self.group = group[text].astype(np.int32)
        lengths = np.flatnonzero(last) + 1 - starts
        encoded = strings(_LOWER[data[inside]], lengths).dictionary_encode()
        self.distinct, self.code = encoded.dictionary, encoded.indices.to_numpy()
        self.hashes = _hashes(self.distinct.to_pylist())

    def phrases(self, size: int) -> np.ndarray:
        """Where phrases of this many words begin."""
        last = len(self.code) - size + 1
        if last <= 0:
            return np.zeros(0, dtype=np.int64)
        return np.flatnonzero(self.piece[:last] == self.piece[size - 1 :])

    def at(self, places: np.ndarray, size: int) -> Phrases:
        codes = [self.code[places + k] for k in range(size)]
        return Phrases(self, self.group[places], codes)


class Phrases:
    """Phrases of one size by the group they are in and the codes of their words."""

    def __init__(self, words: Words, group: np.ndarray, codes: list[np.ndarray]) -> None:
        self.words, self.group, self.codes = words, group, codes

    def hashes(self) -> np.ndarray:
        out = self.words.hashes[self.codes[0]]
        for code in self.codes[1:]:
            out = _mixed(out, self.words.hashes[code])
        return out

    def counted(self) -> tuple[Phrases, np.ndarray]:
        """(the distinct phrases of the groups, how many there are of each)."""
        columns = [self.group, *self.codes]
        radix = len(self.words.distinct)
        if not len(self.group):
            return self, np.zeros(0, dtype=np.int64)
        if (int(self.group.max()) + 1) * radix ** len(self.codes) < 1 << 63:
            key = self.group.astype(np.int64)
            for code in self.codes:
                key = key * radix + code
            key.sort()
            new = np.r_[True, key[1:] != key[:-1]]
            number = np.diff(np.r_[np.flatnonzero(new), len(key)])
            key, found = key[new], []
            for _ in self.codes:
                key, code = np.divmod(key, radix)
                found.append(code)
            return Phrases(self.words, key, found[::-1]), number
        found, number = np.unique(np.column_stack(columns), axis=0, return_counts=True)
        return Phrases(self.words, found[:, 0], [found[:, k + 1] for k in range(len(self.codes))]), number

    def joined(self) -> pa.Array:
        """The phrases' words with a space between."""
        words = [self.words.distinct.take(pa.array(code)) for code in self.codes]
        return pc.binary_join_element_wise(*words, pa.scalar(" ", pa.large_string())).cast(pa.string())


class Marked:
    """Hashes of what is frequent, as bits: knows all that were put in, and some more."""

    def __init__(self, shared: Broadcast) -> None:
        self._bits = np.frombuffer(shared.value, dtype=np.uint8)

    def of(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes % np.uint64(BITS)
        return (self._bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _mark(hashes: DataFrame) -> Broadcast:
    """The column `hash` of all rows as bits. The driver gets at most `BITS`, whatever the rows."""
    at = F.pmod(F.col("hash"), F.lit(BITS)) + 1
    pages = hashes.groupBy(F.bitmap_bucket_number(at).alias("page")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits")
    )
    bits = np.zeros(BITS // 8, dtype=np.uint8)
    for page, held in pages.collect():
        first = (page - 1) * PAGE // 8
        bits[first : first + len(held)] = np.frombuffer(held, dtype=np.uint8)
    return hashes.sparkSession.sparkContext.broadcast(bits.tobytes())


def _signed(hashes: np.ndarray) -> pa.Array:
    return pa.array(hashes.view(np.int64))


def _groups(batch: pa.RecordBatch, *columns: str) -> tuple[np.ndarray, list[tuple]]:
    """(number of each row's group, what the columns hold in each group)."""
    rows = list(zip(*(batch.column(c).to_pylist() for c in columns)))
    named = list(dict.fromkeys(rows))
    number = {row: i for i, row in enumerate(named)}
    return np.array([number[r] for r in rows], dtype=np.int64), named


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """`batch` in slices that hold some `PART_BYTES` of text."""
    sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes, dtype=np.int64) // PART_BYTES
    bounds = np.r_[0, np.flatnonzero(np.diff(part)) + 1, len(part)]
    for first, last in zip(bounds, bounds[1:]):
        if last > first:
            yield batch.slice(first, last - first)


def _walk(columns: tuple[str, ...], emit):
    """Runs `emit(words, groups)` over parts of bounded size of every batch."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _parts(batch):
                group, named = _groups(part, *columns)
                words = Words(part.column("text"), group)
                if len(words.code):
                    yield emit(words, named)

    return run


def _named(named: list[tuple], column: int, group: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.array([g[column] for g in named], kind).take(pa.array(group))


def _word_counts(docs: DataFrame) -> DataFrame:
    """(lang, shard, word, n)."""

    def emit(words: Words, named: list[tuple]) -> pa.RecordBatch:
        found, number = words.at(words.phrases(1), 1).counted()
        return pa.RecordBatch.from_arrays(
            [
                _named(named, 0, found.group, pa.string()),
                _named(named, 1, found.group, pa.int64()),
                found.joined(),
                pa.array(number, pa.int64()),
            ],
            ["lang", "shard", "word", "n"],
        )

    found = docs.mapInArrow(
        _walk(("lang", "shard"), emit), "lang string, shard long, word string, n long"
    )
    return found.groupBy("lang", "shard", "word").agg(F.sum("n").alias("n"))


def _group_hashes(named: list[tuple]) -> np.ndarray:
    """Of a language and a shard, or of a language alone."""
    return _hashes(["\0".join(map(str, g)) for g in named])


def _in_group(phrases: Phrases, named: list[tuple]) -> np.ndarray:
    return _mixed(phrases.hashes(), _group_hashes(named)[phrases.group])


def _in_language(phrases: Phrases, named: list[tuple]) -> np.ndarray:
    return _mixed(phrases.hashes(), _group_hashes([g[:1] for g in named])[phrases.group])


def _mined(docs: DataFrame, size: int, parts: Broadcast) -> DataFrame:
    """(hash, whole, group, n) of phrases of this size in each shard, both of whose parts of one
    word less are marked. `hash` is of the phrase and its `group`, a language and shard, `whole`
    of the phrase and its language. Only numbers are counted, which is cheap."""

    def emit(words: Words, named: list[tuple]) -> pa.RecordBatch:
        marked, places = Marked(parts), words.phrases(size)
        for k in (0, 1):
            part = words.at(places + k, size - 1)
            places = places[marked.of(_in_group(part, named))]
        found, number = words.at(places, size).counted()
        return pa.RecordBatch.from_arrays(
            [
                _signed(_in_group(found, named)),
                _signed(_in_language(found, named)),
                _signed(_group_hashes(named)[found.group]),
                pa.array(number, pa.int64()),
            ],
            ["hash", "whole", "group", "n"],
        )

    found = docs.mapInArrow(
        _walk(("lang", "shard"), emit), "hash long, whole long, group long, n long"
    )
    return found.groupBy("hash", "whole", "group").agg(F.sum("n").alias("n"))


def _counted(docs: DataFrame, longest: int, candidates: Broadcast, support: int) -> DataFrame:
    """(lang, phrase, size, a) of all phrases found at least `support` times."""

    def emit(words: Words, named: list[tuple]) -> pa.RecordBatch:
        marked, parts = Marked(candidates), []
        for size in range(2, longest + 1):
            places = words.phrases(size)
            places = places[marked.of(_in_language(words.at(places, size), named))]
            found, number = words.at(places, size).counted()
            parts.append(
                pa.RecordBatch.from_arrays(
                    [
                        _named(named, 0, found.group, pa.string()),
                        found.joined(),
                        pa.array([size] * len(number), pa.int32()),
                        pa.array(number, pa.int64()),
                    ],
                    ["lang", "phrase", "size", "a"],
                )
            )
        return pa.concat_batches(parts)

    found = docs.mapInArrow(_walk(("lang",), emit), "lang string, phrase string, size int, a long")
    counts = found.groupBy("lang", "phrase", "size").agg(F.sum("a").alias("a"))
    return counts.where(F.col("a") >= support)


def _locally_frequent(counts: DataFrame, shares: DataFrame, on: list[str]) -> DataFrame:
    """Those counted in a shard as often as its share of its language's words asks for."""
    return counts.join(shares.select(*on, "asked"), on).where("n >= asked")


def _scored(phrases: DataFrame, words: DataFrame, longest: int) -> DataFrame:
    """`phrases` with l, r and score of the cut that scores lowest."""
    known = phrases.select("lang", "phrase", "a").unionByName(
        words.select("lang", F.col("word").alias("phrase"), F.col("n").alias("a"))
    )
    cuts = reduce(
        DataFrame.unionByName,
        (
            phrases.where(F.col("size") > k).select(
                "*",
                F.lit(k).alias("k"),
                F.substring_index("phrase", " ", k).alias("left"),
                F.expr(f"substring_index(phrase, ' ', {k} - size)").alias("right"),
            )
            for k in range(1, longest)
        ),
    )
    for side, count in (("left", "l"), ("right", "r")):
        part = known.select("lang", F.col("phrase").alias(side), F.col("a").alias(count))
        cuts = cuts.join(part, ["lang", side])
    exact = "cast({} as decimal(38,0))".format
    score = F.expr(f"({exact('1000000')} * a * a) div ({exact('l')} * r)")
    cuts = cuts.withColumn("score", score)
    least = F.min(F.struct("score", "k", "l", "r")).alias("least")
    return cuts.groupBy("lang", "phrase", "size", "a").agg(least).select(
        "lang", "phrase", "size", "a", "least.l", "least.r", "least.score"
    )


def _not_within_longer(phrases: DataFrame, longest: int, percent: int) -> DataFrame:
    """`phrases` without those that a longer one holds which is found `percent` as often."""
    inner = F.expr(
        "flatten(transform(sequence(2, size - 1), n -> transform(sequence(1, size - n + 1), "
        "i -> array_join(slice(split(phrase, ' '), i, n), ' '))))"
    )
    longer = phrases.where(F.col("size") > 2).select(
        "lang", F.explode(F.array_distinct(inner)).alias("phrase"), F.col("a").alias("held")
    )
    held = longer.groupBy("lang", "phrase").agg(F.max("held").alias("held"))
    kept = phrases.join(held, ["lang", "phrase"], "left")
    return kept.where(
        F.col("held").isNull() | (100 * F.col("held") < percent * F.col("a"))
    ).drop("held")


def mine_collocations(
    docs: DataFrame,
    longest: int = 3,
    support: int = 10,
    percent: int = 50,
    ranked: int = RANKED,
    shards: int = SHARDS,
    id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
) -> DataFrame:
    """The best `ranked` phrases of two to `longest` words of each language, as (lang, rank,
    phrase, a, l, r, n, score).

    A to Z count as lower case. Words are what white space within a line separates, and a phrase
    reaches over no punctuation mark or line end. `a` is how often a phrase is found, overlaps
    included, at least `support` times; `n` how many words its language has; `l` and `r` how often
    its two parts are, at the cut whose score a * a / (l * r), in millionths and rounded down, is
    lowest, the first of equal ones. Phrases held by a longer one that is found `percent` as often
    are left out. Order is by score, then a, both falling, then by the phrase's bytes.

    Whole texts are read, of any length. NULL texts are empty, and a NULL language is `und`.
    Repeated rows count each time; an id names the shard alone, so NULL or repeated ids do no
    harm. An empty table gives an empty result; columns not named here take no part.
    """
    rows = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit(UNNAMED)).alias("lang"),
        F.pmod(F.xxhash64(F.col(id)), F.lit(shards)).alias("shard"),
        F.col(text).cast("string").alias("text"),
    )
    words = materialize(_word_counts(rows), "words_of_shards")
    of_shard = words.groupBy("lang", "shard").agg(F.sum("n").alias("of_shard"))
    of_all = of_shard.groupBy("lang").agg(F.sum("of_shard").alias("of_all"))
    exact = "cast({} as decimal(38,0))".format
    asked = F.expr(f"({exact(support)} * of_shard + of_all - 1) div {exact('of_all')}")
    shares = of_shard.join(of_all, "lang").withColumn("asked", asked)
    named_shares = "lang string, shard long, of_all long, asked long, group long"
    shares = materialize(
        shares.select("lang", "shard", "of_all", "asked").mapInArrow(_with_hash, named_shares), "shares"
    )

    frequent = _locally_frequent(words, shares, ["lang", "shard"]).select("lang", "shard", "word")
    marked = _mark(frequent.mapInArrow(_hashed_words, "hash long"))
    unions = []
    for size in range(2, longest + 1):
        mined = _locally_frequent(_mined(rows, size, marked), shares, ["group"])
        mined = materialize(mined.select("hash", "whole"), f"frequent_{size}")
        unions.append(mined.select(F.col("whole").alias("hash")))
        if size < longest:
            marked = _mark(mined.select("hash"))
    candidates = _mark(reduce(DataFrame.unionByName, unions))

    phrases = materialize(_counted(rows, longest, candidates, support), "phrases")
    in_all = words.groupBy("lang", "word").agg(F.sum("n").alias("n"))
    scored = _not_within_longer(_scored(phrases, in_all, longest), longest, percent)
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    scored = scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= ranked)
    totals = shares.groupBy("lang").agg(F.max("of_all").alias("n"))
    return scored.join(totals, "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )


def _hashed_words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        group, named = _groups(batch, "lang", "shard")
        hashes = _hashes(batch.column("word").to_pylist())
        yield pa.RecordBatch.from_arrays(
            [_signed(_mixed(hashes, _group_hashes(named)[group]))], ["hash"]
        )


def _with_hash(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, shard, ...) with the hash of the two as `group`."""
    for batch in batches:
        number, named = _groups(batch, "lang", "shard")
        hashes = _signed(_group_hashes(named)[number]) if len(named) else pa.array([], pa.int64())
        yield batch.append_column("group", hashes)
