"""SentencePiece BPE encoding and decoding, with the merges done for whole arrays of words.

A batch's texts are cut into words at white space, which no piece crosses. The distinct words
lie behind each other in one flat array of symbols. A round looks up the rank of every pair of
neighbours, takes the smallest rank in each segment of a word, merges the leftmost pairs of that
rank in all segments at once and compacts the array; segments without a pair leave it. Words are
remembered between batches up to a bound.

The model is read on the driver and its table of pieces, of fixed size, goes to the tasks.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logbraid.llm.arrow import in_parts, texts_of
from logbraid.llm.rows import row_of, unpacked

# How the model writes a space, and the text of an unknown piece.
SPACE = "▁"
UNKNOWN_TEXT = " ⁇ "

CACHED_WORDS = 100_000
_NONE = np.iinfo(np.int32).max
RESULTS = ("ids", "n_tokens", "decoded")


def _offsets(lengths: np.ndarray) -> np.ndarray:
    out = np.zeros(len(lengths) + 1, dtype=np.int64)
    np.cumsum(lengths, out=out[1:])
    return out


def _gather(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The runs flat[start : start + length] one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    places = np.repeat(starts - (ends - lengths), lengths) + np.arange(total)
    return flat[places]


@dataclass(frozen=True)
class Pieces:
    """A model's pieces by id: text, score, and whether they are bytes, controls or unknown."""

    texts: tuple[str, ...]
    scores: tuple[float, ...]
    kinds: tuple[str, ...]  # "piece", "byte", "control" or "unknown"
    begin: int
    end: int

    @classmethod
    def load(cls, path: str) -> Pieces:
        """Read a model file. Raises ValueError for models this encoder does not cover."""
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        with open(path, "rb") as file:
            data = file.read()
        model = sentencepiece_model_pb2.ModelProto.FromString(data)
        normalizer = model.normalizer_spec
        if (
            model.trainer_spec.model_type != model.trainer_spec.BPE
            or not model.trainer_spec.byte_fallback
            or model.trainer_spec.treat_whitespace_as_suffix
            or normalizer.precompiled_charsmap
            or normalizer.remove_extra_whitespaces
            or not (normalizer.add_dummy_prefix and normalizer.escape_whitespaces)
        ):
            raise ValueError("only plain BPE models with byte fallback are covered")
        p = SentencePieceProcessor(model_proto=data)
        kinds = [
            "byte" if p.is_byte(i)
            else "control" if p.is_control(i)
            else "unknown" if p.is_unknown(i)
            else "piece"
            for i in range(p.vocab_size())
        ]
        texts = [p.id_to_piece(i) for i in range(p.vocab_size())]
        plain = [t for t, kind in zip(texts, kinds) if kind == "piece"]
        if any(SPACE in t.lstrip(SPACE) for t in plain) or any(p.is_unused(i) for i in range(len(texts))):
            raise ValueError("pieces that cross words, and unused pieces, are not covered")
        if not {c for t in plain for c in t} <= set(plain):
            raise ValueError("a piece holds a character that is no piece")
        scores = [p.get_score(i) for i in range(p.vocab_size())]
        return cls(tuple(texts), tuple(scores), tuple(kinds), p.bos_id(), p.eos_id())

    @cached_property
    def ranks(self) -> dict[str, int]:
        """By text, the order in which pieces are merged; equal scores share a rank."""
        plain = {
            t: s for t, s, kind in zip(self.texts, self.scores, self.kinds) if kind == "piece"
        }
        order = {s: n for n, s in enumerate(sorted(set(plain.values()), reverse=True))}
        return {t: order[s] for t, s in plain.items()}

    @cached_property
    def ids(self) -> dict[str, int]:
        return {t: i for i, t in enumerate(self.texts) if self.kinds[i] == "piece"}

    @cached_property
    def of_character(self) -> np.ndarray:
        """Code point to piece, or minus one less than the code point if it is none."""
        out = -1 - np.arange(0x110000, dtype=np.int32)
        for text, i in self.ids.items():
            if len(text) == 1:
                out[ord(text)] = i
        return out

    @cached_property
    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(left * size + right in order, rank, piece, reach, reach without spaces) of all pairs of
        pieces that stand beside each other in some piece. Rank and piece are those of a pair that
        merges; the reach is the least rank of a piece that the pair is in, of all pieces and of
        those without a space."""
        size, ids, ranks = len(self.texts), self.ids, self.ranks
        reach: dict[int, int] = {}
        inner: dict[int, int] = {}
        for text in sorted(ids, key=ranks.__getitem__):
            rank, n = ranks[text], len(text)
            parts = [[ids.get(text[a:b]) for b in range(n + 1)] for a in range(n)]
            for first in range(n - 1):
                for cut in range(first + 1, n):
                    if (left := parts[first][cut]) is None:
                        continue
                    for right in parts[cut][cut + 1 :]:
                        if right is not None:
                            reach.setdefault(left * size + right, rank)
                            if SPACE not in text:
                                inner.setdefault(left * size + right, rank)
        keys = np.array(sorted(reach), dtype=np.int64)
        merged = [ids.get(self.texts[k // size] + self.texts[k % size]) for k in keys.tolist()]
        return (
            keys,
            np.array([_NONE if i is None else ranks[self.texts[i]] for i in merged], np.int32),
            np.array([i or 0 for i in merged], np.int32),
            np.array([reach[k] for k in keys.tolist()], np.int32),
            np.array([inner.get(k, _NONE) for k in keys.tolist()], np.int32),
        )

    @cached_property
    def word(self) -> re.Pattern[str]:
        """What no merge crosses: spaces and what follows them, less whole longest pieces of spaces.

        Pieces of spaces are merged last and all by one rank, so from the left. If that makes the
        longest piece out of as many spaces, longer runs begin with it whatever follows.
        """
        spaces = [t for t in self.ids if t.startswith(SPACE * 2)]
        longest = max(map(len, spaces), default=0)
        alike = {self.ranks[t] for t in spaces} == {max(self.ranks.values())}
        if alike and not any(t.strip(SPACE) for t in spaces):
            if len(merge_words(self, [SPACE * longest])[0]) == 1:
                return re.compile(f"{SPACE}{{{longest}}}(?={SPACE})|{SPACE}+[^{SPACE}]*")
        return re.compile(f"{SPACE}+[^{SPACE}]*")

    @cached_property
    def byte_ids(self) -> np.ndarray:
        out = np.zeros(256, dtype=np.int32)
        for i, text in enumerate(self.texts):
            if self.kinds[i] == "byte":
                out[int(text[3:5], 16)] = i
        return out

    @cached_property
    def surfaces(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(bytes of all pieces' texts, start, length)."""
        raw = [self._surface(i) for i in range(len(self.texts))]
        lengths = np.array([len(x) for x in raw], dtype=np.int64)
        return np.frombuffer(b"".join(raw), dtype=np.uint8), _offsets(lengths)[:-1], lengths

    def _surface(self, i: int) -> bytes:
        kind = self.kinds[i]
        if kind == "control":
            return b""
        if kind == "unknown":
            return UNKNOWN_TEXT.encode()
        if kind == "byte":
            return bytes([int(self.texts[i][3:5], 16)])
        return self.texts[i].replace(SPACE, " ").encode()


def merge_words(pieces: Pieces, words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all words one after the other, number of ids of each word).

    A word falls into segments where no piece holds the two symbols beside each other, as no merge
    will ever cross there; each has its own least rank, so that long words take few rounds.
    """
    size = len(pieces.texts)
    keys, ranks, results, reach, reach_inside = pieces.pairs
    longest = max(map(len, pieces.ids))
    points = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)
    symbols = pieces.of_character[points]
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    word = np.repeat(np.arange(len(words), dtype=np.int32), lengths)
    place = np.arange(len(symbols))
    # Pieces with a space reach no further than their length from one.
    since_space = place - np.maximum.accumulate(np.where(points == ord(SPACE), place, -longest))
    opens = np.r_[True, word[1:] != word[:-1]][: len(symbols)]  # a segment begins here
    rank = np.full(len(symbols), _NONE, dtype=np.int32)
    into = np.zeros(len(symbols), dtype=np.int32)

    def find(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = left.astype(np.int64) * size + right
        at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        return at, (keys[at] == key) & (left >= 0) & (right >= 0)

    def look_up(places: np.ndarray) -> None:
        """Rank the pairs that begin at `places`, and end segments at those in no piece."""
        at, found = find(symbols[places], symbols[places + 1])
        found &= ~opens[places + 1]
        rank[places] = np.where(found, ranks[at], _NONE)
        into[places] = results[at]
        opens[places + 1] |= ~found

    look_up(np.arange(len(symbols) - 1))
    done_symbols, done_places = [], []
    while len(symbols):
        starts = np.flatnonzero(opens)
        least = np.minimum.reduceat(rank, starts)
        of_segment = np.repeat(least, np.diff(np.r_[starts, len(symbols)]))
        kept = of_segment != _NONE
        if not kept.all():
            done_symbols.append(symbols[~kept])
            done_places.append(place[~kept])
        chosen = np.flatnonzero(kept & (rank == of_segment))
        if not len(chosen):
            break
        # Of pairs that overlap, every second one from the left.
        begins = np.r_[True, chosen[1:] != chosen[:-1] + 1]
        run = np.maximum.accumulate(np.where(begins, chosen, 0))
        chosen = chosen[(chosen - run) % 2 == 0]
        # A pair waits if one before it in its segment may first become a piece of no larger rank
        # that reaches beyond its end.
        segment = np.searchsorted(starts, chosen, side="right")
        followed = np.flatnonzero(segment[1:] == segment[:-1])
        at, found = find(into[chosen[followed]], symbols[chosen[followed] + 2])
        holds_up = np.zeros(len(chosen), dtype=np.int64)
        spaceless = since_space[place[chosen[followed]]] >= longest
        first_rank = np.where(spaceless, reach_inside[at], reach[at])
        holds_up[followed] = found & (first_rank <= rank[chosen[followed]])
        before = np.cumsum(holds_up) - holds_up
        first = np.r_[True, segment[1:] != segment[:-1]]
        merged = chosen[before == np.maximum.accumulate(np.where(first, before, 0))]
        symbols[merged] = into[merged]
        kept[merged + 1] = False
        symbols, place, rank = symbols[kept], place[kept], rank[kept]
        into, opens = into[kept], opens[kept]
        # Only the pairs on either side of a merged symbol are new.
        at = np.cumsum(kept)[merged] - 1
        touched = np.zeros(len(symbols), dtype=bool)
        touched[at] = True
        touched[np.maximum(at - 1, 0)] = True
        rank[-1:] = _NONE
        look_up(np.flatnonzero(touched[:-1]))

    symbols = np.concatenate(done_symbols) if done_symbols else np.zeros(0, dtype=np.int32)
    place = np.concatenate(done_places) if done_places else np.zeros(0, dtype=np.int64)
    order = np.argsort(place)
    return _bytes_for_unknown(pieces, symbols[order], word[place[order]], len(words))


def _bytes_for_unknown(
    pieces: Pieces, symbols: np.ndarray, word: np.ndarray, words: int
) -> tuple[np.ndarray, np.ndarray]:
    """Characters that are no piece, as the ids of their UTF-8 bytes."""
    unknown = np.flatnonzero(symbols < 0)
    if len(unknown):
        points = (-1 - symbols[unknown]).astype(np.uint32)
        raw = np.frombuffer(points.tobytes().decode("utf-32-le").encode(), dtype=np.uint8)
        lengths = np.ones(len(symbols), dtype=np.int64)
        lengths[unknown] = 1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000)
        is_byte = np.repeat(symbols < 0, lengths)
        symbols, word = np.repeat(symbols, lengths), np.repeat(word, lengths)
        symbols[is_byte] = pieces.byte_ids[raw]
    return symbols, np.bincount(word, minlength=words)


class _Places(dict):
    """Numbers its keys in the order in which they are first asked for."""

    def __missing__(self, key: str) -> int:
        self[key] = number = len(self)
        return number


class Encoder:
    """Encodes lists of texts, remembering the ids of words up to a bound."""

    def __init__(self, pieces: Pieces, cached_words: int = CACHED_WORDS) -> None:
        self.pieces, self.cached_words = pieces, cached_words
        self._forget()

    def _forget(self) -> None:
        self._places = _Places()
        self._flat = np.zeros(0, dtype=np.int32)
        self._lengths = np.zeros(0, dtype=np.int64)

    def encode(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, each with its begin and end; their numbers)."""
        if len(self._places) > self.cached_words:
            self._forget()
        places, known = self._places, len(self._places)
        sequence: list[int] = []
        per_text = np.zeros(len(texts), dtype=np.int64)
        for n, text in enumerate(texts):
            if text:
                words = self.pieces.word.findall(SPACE + text.replace(" ", SPACE))
                sequence += [places[w] for w in words]
                per_text[n] = len(words)
        if len(places) > known:
            flat, lengths = merge_words(self.pieces, list(places)[known:])
            self._flat = np.concatenate([self._flat, flat])
            self._lengths = np.concatenate([self._lengths, lengths])
        index = np.array(sequence, dtype=np.int64)
        lengths = self._lengths[index]
        inner = _gather(self._flat, _offsets(self._lengths)[index], lengths)
        inner_ends = _offsets(lengths)[np.cumsum(per_text)]
        counts = np.diff(np.r_[0, inner_ends]) + 2
        ends = np.cumsum(counts)
        out = np.empty(int(ends[-1]) if len(ends) else 0, dtype="<u4")
        is_inner = np.ones(len(out), dtype=bool)
        for at, mark in ((ends - counts, self.pieces.begin), (ends - 1, self.pieces.end)):
            out[at] = mark
            is_inner[at] = False
        out[is_inner] = inner
        return out, counts


def decode(pieces: Pieces, ids: np.ndarray, counts: np.ndarray) -> list[str]:
    """The texts of runs of `counts` ids, without the space that encoding puts in front.

    Bytes that are no UTF-8 become U+FFFD, one for each.
    """
    flat, starts, lengths = pieces.surfaces
    raw = _gather(flat, starts[ids], lengths[ids]).tobytes()
    ends = _offsets(lengths[ids])
    is_control = np.array([k == "control" for k in pieces.kinds])
    out, first = [], 0
    for last in np.cumsum(counts):
        shown = first + np.flatnonzero(~is_control[ids[first:last]])
        # Controls end a run of bytes; all but the outer ones are rare.
        cuts = np.flatnonzero(np.diff(shown) > 1) + 1
        runs = np.split(shown, cuts) if len(shown) else []
        text = "".join(_as_text(raw[ends[r[0]] : ends[r[-1] + 1]]) for r in runs)
        spaced = len(shown) and pieces.texts[ids[shown[0]]].startswith(SPACE)
        out.append(text[1:] if spaced else text)
        first = last
    return out


def _as_text(raw: bytes) -> str:
    try:
        return raw.decode()
    except UnicodeDecodeError:
        out, at = [], 0
        while at < len(raw):
            try:
                out.append(raw[at:].decode())
                break
            except UnicodeDecodeError as error:
                out.append(raw[at : at + error.start].decode() + "�")
                at += error.start + 1
        return "".join(out)


def encode_texts(docs: DataFrame, model: str, text: str = "text") -> DataFrame:
    """`docs` with `ids`, `n_tokens` and the text `decoded` from the ids again.

    `model` is the path of a model file on the driver. `ids` are unsigned 32-bit integers, least
    byte first, with the begin and end ids. Texts are encoded whole. A NULL or empty text has
    only the begin and end ids. Repeated rows come out alike, an empty table gives an empty
    result, and columns named as the results are replaced.
    """
    pieces = Pieces.load(model)
    # Tables that depend on the model alone are made once, here.
    pieces.pairs, pieces.word, pieces.of_character, pieces.surfaces, pieces.byte_ids
    shared = docs.sparkSession.sparkContext.broadcast(pieces)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        for batch in batches:
            for part in in_parts(batch, "text"):
                ids, counts = encoder.encode(texts_of(part, "text"))
                decoded = decode(encoder.pieces, ids, counts)
                raw, ends = ids.tobytes(), 4 * np.r_[0, np.cumsum(counts)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("row"),
                        pa.array([raw[a:b] for a, b in zip(ends, ends[1:])], pa.binary()),
                        pa.array(counts, pa.int64()),
                        pa.array(decoded, pa.string()),
                    ],
                    ["row", *RESULTS],
                )

    # The text itself need not travel to Python and back.
    without = [c for c in docs.columns if c.lower() != text.lower()]
    row = row_of(docs, without)
    rows = docs.select(row, F.col(text).cast("string").alias("text"))
    schema = (
        T.StructType([rows.schema["row"]])
        .add("ids", T.BinaryType())
        .add("n_tokens", T.LongType())
        .add("decoded", T.StringType())
    )
    return unpacked(rows.mapInArrow(run, schema), without, RESULTS)
