"""Prefix tries, collocations and byte-pair encoding, against plain forms and the library."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from logbraid.llm import byte_pairs, collocations, prefix_trie

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(VOCABULARY)


# Prefix tries.

TURNS = "conv_id long, turn long, role string, text string"


def plain_trie(sequences: dict[int, list[tuple[str, str]]]) -> list[tuple]:
    nodes = defaultdict(list)
    for conv, turns in sequences.items():
        for depth in range(len(turns) + 1):
            nodes[tuple(turns[:depth])].append(conv)

    def words(node):
        return len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0

    out = []
    for node, members in nodes.items():
        below = [m for m in nodes if m[: len(node)] == node]
        children = [m for m in below if len(m) == len(node) + 1]
        leaves = [m for m in below if not any(x != m and x[: len(m)] == m for x in below)]
        ends = sorted(c for c in members if len(sequences[c]) == len(node))
        out.append((
            min(members), len(node), min(nodes[node[:-1]]) if node else None, len(members),
            len(children), len(leaves), sum((len(nodes[m]) - 1) * words(m) for m in below),
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def plain_rebuilt(rows) -> dict[int, list[tuple[str, str]]]:
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            key = hashlib.md5(f"{len(role)}:{role}:{text}".encode()).digest()
            own[conv].append((turn is not None, turn or 0, role, key, text))
    own = {c: [(t[2], t[4]) for t in sorted(turns)] for c, turns in own.items()}
    out = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 4
        out[conv] = own.get(conv - conv % 20, [])[:h] + turns[h:]
    return out


def trie(spark, rows, rebuilt=True):
    turns = prefix_trie.turns_of(spark.createDataFrame(rows, TURNS)).cache()
    convs = turns.where("place = 1").select("conv")
    chosen = prefix_trie.with_borrowed_starts(turns) if rebuilt else turns
    return sorted(map(tuple, prefix_trie.prefix_trie(chosen, convs).collect()), key=str)


def conversations(count: int, pick: random.Random) -> list[tuple]:
    said = [(r, t) for r in ("user", None) for t in ("a b", "c", "", None, "d\te  f")]
    return [
        (conv, turn if turn else None, *pick.choice(said[: 3 + turn]))
        for conv in pick.sample(range(3 * count), count)
        for turn in range(pick.choice([1, 1, 2, 3, 5, 9]))
    ]


@pytest.mark.parametrize("band", [1 << 16, 3, 1])
def test_trie_of_rebuilt_conversations(spark, monkeypatch, band):
    monkeypatch.setattr(prefix_trie, "BAND", band)
    monkeypatch.setattr(prefix_trie, "SHARD_TURNS", 40)
    rows = conversations(60, random.Random(band))
    rows += rows[:5] + [(None, 0, "user", "x"), (5000, 3, "user", "x"), (5000, 3, "user", "y")]
    random.Random(1).shuffle(rows)
    assert trie(spark, rows) == plain_trie(plain_rebuilt(rows))


def test_one_long_conversation_lies_in_many_tasks(spark):
    rows = [(7, turn, "user", f"w{turn % 3}") for turn in range(300)]
    rows += [(8, turn, "user", f"w{turn % 3}") for turn in range(200)] + [(3, 0, "user", "w0")]
    conf = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = trie(spark, rows, rebuilt=False)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", conf)
    sequences = {
        c: [(r, t) for conv, _, r, t in rows if conv == c] for c in (3, 7, 8)
    }
    assert got == plain_trie(sequences)


def test_no_conversations_no_nodes(spark):
    assert trie(spark, []) == []
    assert trie(spark, [(None, 1, "user", "x")]) == []


def test_trie_ignores_clashing_columns(spark):
    rows = conversations(10, random.Random(2))
    df = spark.createDataFrame(rows, TURNS)
    for name in ("conv", "place", "key", "a", "part", "words"):
        df = df.selectExpr("*", f"'x' AS `{name}`")
    turns = prefix_trie.turns_of(df)
    assert turns.columns == ["conv", "place", "key", "words"] and turns.count() == len(rows)


def test_many_ids_are_hashed_in_texts(monkeypatch):
    monkeypatch.setattr(prefix_trie, "IDS_IN_TEXT", 2)
    rows = [(a, b, conv) for a in (0, 1) for b in (0, 5) for conv in range(-3, 4 + a)]
    columns = dict(zip(("a", "b", "conv"), map(list, zip(*rows))))
    batches = pa.Table.from_pydict(columns).to_batches(max_chunksize=5)
    texts = list(prefix_trie._texts_of_ids(iter(batches)))
    assert sum(t.num_rows for t in texts) > 12
    got = [tuple(r.values()) for out in prefix_trie._hashed_ids(iter(texts)) for r in out.to_pylist()]
    want = {
        (a, b): hashlib.sha256(",".join(str(c) for x, y, c in rows if (x, y) == (a, b)).encode())
        for a, b, _ in rows
    }
    assert got == [(*node, digest.hexdigest()) for node, digest in want.items()]


def test_slots_are_minimal_and_strangers_are_told():
    digests = np.random.default_rng(4).integers(0, 1 << 63, (5000, 2)).astype(np.uint64)
    hashed = prefix_trie.MinimalPerfectHash(digests)
    assert sorted(hashed(digests).tolist()) == list(range(5000))
    table = prefix_trie.NodeTable(digests, digests[::-1], np.zeros(5000, dtype=np.int64))
    assert (table.slots(digests + np.uint64(1)) == -1).all()
    assert (table.digests[table.slots(digests)] == digests).all()


# Collocations.


def plain_collocations(rows, longest=3, support=10, percent=50, ranked=2000):
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for size in range(1, longest + 1):
                counts[lang].update(
                    tuple(words[i : i + size]) for i in range(len(words) - size + 1)
                )
    out = []
    for lang, f in counts.items():
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= support}
        scored = []
        for p, a in found.items():
            inside = [
                held for longer, held in found.items()
                if len(longer) > len(p)
                and any(longer[i : i + len(p)] == p for i in range(len(longer) - len(p) + 1))
            ]
            if any(100 * held >= percent * a for held in inside):
                continue
            score, k = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:ranked], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def phrase_rows(pick: random.Random, count: int) -> list[tuple]:
    words = ["the", "The", "new", "york", "times", "é", "日本", "a b", "x", "y", "z"]
    marks = [" ", "  ", "\t", ". ", "\n", "\x0b", "! "]
    return [
        (
            i if i % 7 else None,
            "".join(pick.choice(words) + pick.choice(marks[:3] * 3 + marks) for _ in range(pick.randint(0, 60)))
            if i % 11 else None,
            pick.choice(["en", "en", "fr", None]),
        )
        for i in range(count)
    ]


@pytest.mark.parametrize("shards,longest", [(3, 3), (1, 2), (5, 4)])
def test_collocations_equal_a_plain_count(spark, shards, longest):
    rows = phrase_rows(random.Random(shards), 200)
    rows += rows[:20] + [(900, "new york " * 3000 + "q" * 5000, "de")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    for name in ("shard", "word", "n", "hash", "phrase", "rank"):
        df = df.selectExpr("*", f"'x' AS `{name}`")
    got = collocations.mine_collocations(df, longest=longest, ranked=30, shards=shards)
    want = plain_collocations([(lang, text) for _, text, lang in rows], longest, ranked=30)
    assert sorted(map(tuple, got.collect())) == want


def test_parts_of_a_batch_hold_all_its_texts(monkeypatch):
    monkeypatch.setattr(collocations, "PART_BYTES", 100)
    texts = [t for _, t, _ in phrase_rows(random.Random(8), 80)]
    parts = list(collocations._parts(pa.record_batch({"text": pa.array(texts)})))
    assert [t for part in parts for t in part.column("text").to_pylist()] == texts
    assert len(parts) > 20
    # Words of a slice are its own.
    words = collocations.Words(parts[3].column("text"), np.zeros(parts[3].num_rows, dtype=np.int64))
    plain = re.findall(r"[^\x20\x09.!\n\x0b]+", "\n".join(t or "" for t in parts[3].column("text").to_pylist()))
    assert words.distinct.take(pa.array(words.code)).to_pylist() == [w.replace("T", "t") for w in plain]


def test_counting_by_rows_equals_counting_by_keys():
    pick = np.random.default_rng(2)
    texts = pa.array([" ".join(pick.choice(["a", "b", "c", "d"], 40)) for _ in range(20)])
    words = collocations.Words(texts, np.arange(20) % 3)
    phrases = words.at(words.phrases(3), 3)
    found, number = phrases.counted()
    words.distinct = type("Many", (), {"__len__": lambda self: 1 << 40})()
    slow, slow_number = phrases.counted()
    assert number.tolist() == slow_number.tolist() and number.sum() == 20 * 38
    assert found.group.tolist() == slow.group.tolist()
    assert [c.tolist() for c in found.codes] == [c.tolist() for c in slow.codes]


def test_no_texts_no_collocations(spark):
    schema = "doc_id long, text string, lang string"
    for rows in ([], [(1, None, None), (2, "", "en"), (3, " . ", "en")]):
        assert collocations.mine_collocations(spark.createDataFrame(rows, schema)).count() == 0


# Byte pairs.


def encoded(spark, texts, **sizes):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = byte_pairs.encode_through_words(df, VOCABULARY, **sizes).collect()
    return {r.doc_id: (r.ids, r.n_tokens, r.decoded) for r in rows}


def by_library(library, texts):
    out = {}
    for i, text in enumerate(texts):
        ids = library.encode(text or "", add_special_tokens=False).ids
        out[i] = (ids, len(ids), library.decode(ids, skip_special_tokens=False))
    return out


def test_ids_and_texts_equal_the_library(spark, library):
    pick = random.Random(3)
    some = [*"ab c'sdtrelmv1² \n\t  é日本\U0001f642.,-\x00ࡰ\U00010d40", "<|endoftext|>"]
    texts = [
        "", None, " ", "\n", "a<|endoftext|>  <|endoftext|> b", "  <|endoftext|>", "<|endoftext|",
        "it's   we're I'LL \n\n x\r\n\t  y", "x" * 50_000, " " * 20_000 + "a", "ab" * 20_000,
        "word " * 100_000, "".join(chr(c) for c in range(0x3000) if c < 0xD800),
    ]
    texts += ["".join(pick.choices(some, k=pick.randint(1, 80))) for _ in range(600)]
    assert encoded(spark, texts) == by_library(library, texts)


def test_every_character_is_split_as_in_the_library(spark, library):
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"{chr(c)}a1 " for c in points[i : i + 16384]) for i in range(0, len(points), 16384)]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    pattern = byte_pairs.word_pattern(spark)
    split = library.pre_tokenizer.pre_tokenize_str
    for row in df.select("text", byte_pairs.words_of(df.text, pattern).alias("words")).collect():
        assert row.words == [row.text[a:b] for _, (a, b) in split(row.text)]


def test_blocks_and_parts_do_not_show(spark, library, monkeypatch):
    monkeypatch.setattr(byte_pairs, "PART_WORDS", 20)
    pick = random.Random(9)
    texts = [" ".join(pick.choices("the cat sat on a mat Été".split(), k=pick.randint(0, 30))) for _ in range(80)]
    assert encoded(spark, texts, block_words=50) == by_library(library, texts)


def test_each_distinct_word_of_a_part_is_encoded_once():
    asked = []

    class Counting:
        value = type("V", (), {"encode_word": staticmethod(lambda w: asked.append(w) or [len(w)])})

    words = pa.array(["a", " b", " cd"], pa.large_string())
    packets = [
        {"block": f"b{b}", "words": byte_pairs.packet(step=np.array([0, 1, 1], dtype=np.int32), word=words)}
        for b in range(4)
    ]
    out = byte_pairs._encoded(Counting)(pa.Table.from_pylist(packets))
    assert sorted(asked) == [" b", " cd", "a"]
    assert out.column("block").to_pylist() == ["b0", "b1", "b2", "b3"]
    for row in out.to_pylist():
        assert byte_pairs.opened(row["places"]).column("length").to_pylist() == [1, 1, 1]
        assert byte_pairs._from_planes(row["ids"], row["n_ids"]).tolist() == [1, 2, 3]


def test_odd_documents_keep_their_other_columns(spark, odd_documents, no_documents, library):
    got = byte_pairs.encode_through_words(odd_documents, VOCABULARY)
    rows, want = got.collect(), odd_documents.collect()
    assert len(rows) == len(want)
    plain = Counter((r.doc_id, r.lang, r.kept, tuple(library.encode(r.text or "").ids)) for r in want)
    assert Counter((r.doc_id, r.lang, r.kept, tuple(r.ids)) for r in rows) == plain
    assert byte_pairs.encode_through_words(no_documents, VOCABULARY).count() == 0
