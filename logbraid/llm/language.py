"""Language identification by rank-order profiles of character n-grams.

A text's letters are folded to lower case and everything else to one gap between words; its 1-,
2- and 3-grams are counted, gaps included. A language's profile is its `PROFILE` most frequent
n-grams by rank, counted over all learning documents. A document's own most frequent n-grams are
compared with each profile by the sum of how far each is out of place.

Counting and ranking run on numpy arrays in the tasks. Learning sends one row per n-gram,
language and task through a shuffle; the profiles, of fixed size per language, go to all tasks.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logbraid.llm.arrow import in_parts, texts_of
from logbraid.llm.rows import packed, unpacked

PROFILE = 300
UNDETERMINED = "und"
RESULTS = ("lang_pred", "score")
_BITS, _GAP = 21, 1  # of a code point; no letter has code point 1
# N-grams a learning task holds before it hands its counts on.
_HELD = 1 << 18


@cache
def _folded() -> np.ndarray:
    """Code point to that of its lower-case letter, 0 for what is no letter."""
    out = np.zeros(0x110000, dtype=np.int64)
    for point in range(0x110000):
        letter = chr(point)
        if letter.isalpha():
            out[point] = ord(letter.lower()[0])
    return out


def ngrams(text: str) -> np.ndarray:
    """Codes of all 1- to 3-grams of the text, in no order; empty if it has no letter."""
    points = np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32)
    letters = np.zeros(len(points) + 2, dtype=np.int64)
    letters[1:-1] = _folded()[points]
    is_letter = letters != 0
    if not is_letter.any():
        return np.zeros(0, dtype=np.int64)
    # One gap before, between and after words.
    letters = letters[is_letter | np.r_[False, is_letter[:-1]] | np.r_[is_letter[1:], False]]
    letters = letters[np.r_[True, (letters[1:] != 0) | (letters[:-1] != 0)]]
    one = letters[letters != 0]
    # A gap has a code too, or a word's first letter and the letter alone would be one n-gram.
    marked = np.where(letters == 0, _GAP, letters)
    two = marked[:-1] << _BITS | marked[1:]
    three = two[:-1] << _BITS | marked[2:]
    return np.concatenate([one, two, three[letters[1:-1] != 0]])


def _counted(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    codes = np.sort(codes)
    starts = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]]) if len(codes) else codes
    return codes[starts], np.diff(np.r_[starts, len(codes)])


def most_frequent(text: str) -> np.ndarray:
    """The text's most frequent n-grams by rank; of equally frequent ones the smaller code."""
    codes, counts = _counted(ngrams(text))
    if len(codes) > PROFILE:
        least = np.partition(counts, len(counts) - PROFILE)[len(counts) - PROFILE]
        codes, counts = codes[counts >= least], counts[counts >= least]
    return codes[np.argsort(-counts, kind="stable")[:PROFILE]]


def _count_ngrams(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

    def merged(lang: str) -> tuple[np.ndarray, np.ndarray]:
        parts = held[lang]
        if len(parts) > 1:
            codes, place = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            counts = np.bincount(place, np.concatenate([p[1] for p in parts])).astype(np.int64)
            parts[:] = [(codes, counts)]
        return parts[0]

    def flush() -> Iterator[pa.RecordBatch]:
        for lang in held:
            codes, counts = merged(lang)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(codes), pa.string()), pa.array(codes), pa.array(counts)],
                ["lang", "gram", "n"],
            )
        held.clear()

    for batch in batches:
        for part in in_parts(batch, "text"):
            of_lang: dict[str, list[str]] = {}
            for lang, text in zip(part.column("lang").to_pylist(), texts_of(part, "text")):
                of_lang.setdefault(lang, []).append(text)
            for lang, texts in of_lang.items():
                held.setdefault(lang, []).append(_counted(np.concatenate(list(map(ngrams, texts)))))
                merged(lang)
            if sum(len(p[0][0]) for p in held.values()) > _HELD:
                yield from flush()
    yield from flush()


def learn_profiles(docs: DataFrame, lang: str = "lang", text: str = "text") -> dict[str, list[int]]:
    """By language, its most frequent n-grams by rank, from all documents with text and language.

    The result has `PROFILE` numbers per language, however large the corpus.
    """
    labelled = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    counts = (
        labelled.where("lang IS NOT NULL AND text IS NOT NULL")
        .mapInArrow(_count_ngrams, "lang string, gram long, n long")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
    )
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    top = counts.withColumn("rank", rank).where(F.col("rank") <= PROFILE).collect()
    profiles: dict[str, list[int]] = {}
    for row in sorted(top, key=lambda r: (r.lang, r.rank)):
        profiles.setdefault(row.lang, []).append(row.gram)
    return profiles


class _Judge:
    def __init__(self, profiles: Mapping[str, list[int]]) -> None:
        self.langs = sorted(profiles)
        self.grams = np.unique(np.array([g for p in profiles.values() for g in p], dtype=np.int64))
        # Ranks by language and n-gram; the last column is for those in no profile.
        self.ranks = np.full((len(self.langs), len(self.grams) + 1), -1, dtype=np.int64)
        for n, lang in enumerate(self.langs):
            places = np.searchsorted(self.grams, profiles[lang])
            self.ranks[n, places] = np.arange(len(places))

    def __call__(self, text: str) -> tuple[str, float]:
        own = most_frequent(text)
        if not len(own) or not self.langs:
            return UNDETERMINED, 0.0
        at = np.searchsorted(self.grams, own)
        at[at == len(self.grams)] = 0
        at = np.where(self.grams[at] == own, at, len(self.grams))
        ranks = self.ranks[:, at]
        away = np.where(ranks < 0, PROFILE, np.abs(ranks - np.arange(len(own))))
        distance = away.sum(axis=1)
        best = int(distance.argmin())
        return self.langs[best], 1.0 - float(distance[best]) / (PROFILE * len(own))


def predict_language(
    docs: DataFrame, profiles: Mapping[str, list[int]], text: str = "text"
) -> DataFrame:
    """`docs` with `lang_pred`, the language of the nearest profile (of equally near ones the
    first by name), and `score`, one minus the distance as a share of the largest possible.

    Whole texts are read. A NULL text, one without a letter, and any text if no profile was
    learned, is `und` with score 0. Repeated rows come out alike, an empty table gives an empty
    result, and columns named as the results are replaced.
    """
    learned = dict(profiles)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = _Judge(learned)
        for batch in batches:
            for part in in_parts(batch, "text"):
                judged = [judge(t) for t in texts_of(part, "text")]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("row"),
                        pa.array([j[0] for j in judged], pa.string()),
                        pa.array([j[1] for j in judged], pa.float64()),
                    ],
                    ["row", *RESULTS],
                )

    rows = packed(docs, text=F.col(text))
    schema = (
        T.StructType([rows.schema["row"]])
        .add("lang_pred", T.StringType())
        .add("score", T.DoubleType())
    )
    return unpacked(rows.mapInArrow(run, schema), docs.columns, RESULTS)


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning: a third, by a checksum of its id as text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 3 == 1
