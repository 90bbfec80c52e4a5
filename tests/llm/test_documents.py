"""Every operator on documents, on odd rows and against a plain form of itself."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import xxhash
from pyspark.sql import functions as F

from logbraid.llm import language, line_dedup, mixing, pieces, sharding, simhash

MODEL = public_tokenizers.path("piece_bpe_32k.model")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rows_of(df):
    return [r.asDict() for r in df.collect()]


def extras_kept(df, given, *replaced):
    want = [c for c in given.columns if c not in replaced]
    return [c for c in df.columns if c in want] == want


# Line dedup


def plain_line_dedup(rows, min_length=10):
    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})

    holders = defaultdict(set)
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            holders[key(line)].add(doc_id)
    out = Counter()
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [
            line
            for line in lines
            if len(key(line)) < min_length
            or len(holders[key(line)]) < 2
            or doc_id == min(holders[key(line)], key=lambda x: (x is None, x or 0))
        ]
        out[doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)] += 1
    return out


def test_line_dedup_on_odd_rows(odd_documents):
    out = line_dedup.drop_repeated_lines(odd_documents)
    got = Counter((r["doc_id"], r["n_lines"], r["n_dropped"], r["kept"]) for r in rows_of(out))
    given = [(r["doc_id"], r["text"]) for r in rows_of(odd_documents)]
    assert got == plain_line_dedup(given)
    assert extras_kept(out, odd_documents, "kept")


def test_line_dedup_keeps_order_of_many_lines_and_one_id_with_two_texts(documents):
    pick = random.Random(1)
    rows = []
    for i in range(60):
        lines = [f"a common line number {pick.randint(0, 30)}" for _ in range(pick.randint(0, 40))]
        rows.append((i // 2, "\n".join(lines + ["short"] * pick.randint(0, 3)), "en", "s", 0))
    df = documents(rows)
    got = Counter(
        (r["doc_id"], r["n_lines"], r["n_dropped"], r["kept"])
        for r in rows_of(line_dedup.drop_repeated_lines(df))
    )
    assert got == plain_line_dedup([(r[0], r[1]) for r in rows])


def test_line_dedup_threshold(documents):
    line = "the very same line"
    df = documents([(i, f"{line}\n{i}", "en", "s", 0) for i in range(3)])
    dropped = {m: sum(r["n_dropped"] for r in rows_of(line_dedup.drop_repeated_lines(df, min_docs=m)))
               for m in (2, 3, 4)}
    assert dropped == {2: 2, 3: 2, 4: 0}


# Sharding


def check_shards(out, n, shards):
    by_shard = defaultdict(list)
    for r in out:
        by_shard[r["shard"]].append(r["slot"])
    counts = [len(by_shard[s]) for s in range(shards)]
    assert sum(counts) == n and max(counts) - min(counts) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in by_shard.values())


@pytest.mark.parametrize("bucket_bytes", [1 << 23, 500])
def test_shards_have_equal_rows_and_gapless_slots(odd_documents, bucket_bytes):
    out = sharding.shuffle_into_shards(odd_documents, bucket_bytes=bucket_bytes)
    got = rows_of(out)
    check_shards(got, odd_documents.count(), 16)
    want = Counter(
        (r["doc_id"], len((r["text"] or "").encode()) + 1) for r in rows_of(odd_documents)
    )
    assert Counter((r["doc_id"], r["size"]) for r in got) == want
    assert extras_kept(out, odd_documents, "size", "shard")


def test_shards_of_one_id_with_all_rows(documents):
    df = documents([(1, "same text", "en", "s", 0)] * 500)
    got = rows_of(sharding.shuffle_into_shards(df, bucket_bytes=200))
    check_shards(got, 500, 16)


def test_shuffle_depends_on_the_seed_only(documents):
    df = documents([(i, f"text {i}", "en", "s", 0) for i in range(400)]).repartition(3)
    def order(seed):
        out = rows_of(sharding.shuffle_into_shards(df, seed=seed, bucket_bytes=1000))
        return [r["doc_id"] for r in sorted(out, key=lambda r: (r["shard"], r["slot"]))]
    first = order(1)
    assert first == order(1) and first != order(2) and first != sorted(first)
    # No trace of the order given: neighbours are as far apart as by chance.
    assert 100 < np.abs(np.diff(first)).mean() < 167


def test_many_buckets_in_few_parts(documents, monkeypatch):
    """Buckets are those of the first pass, one after the other, each in a new order, and how the
    input lies changes nothing."""
    monkeypatch.setattr(sharding, "_RUN", 64)
    df = documents([(i, f"text {i} é", "en", "s", 0) for i in range(3000)])
    size = sum(len(f"text {i} é".encode()) + 1 for i in range(3000)) // 1000
    buckets, orders = 0, []
    for given in (df.repartition(3), df.repartition(7)):
        out = sharding.shuffle_into_shards(given, seed=5, bucket_bytes=size, most_parts=8)
        assert out.rdd.getNumPartitions() == 8
        got = rows_of(out)
        check_shards(got, 3000, 16)
        assert all(r["text_crc32"] == zlib.crc32(r["text"].encode()) for r in got)
        buckets = -(-sum(r["size"] for r in got) // size)
        orders.append([r["doc_id"] for r in sorted(got, key=lambda r: (r["shard"], r["slot"]))])
    assert orders[0] == orders[1] and buckets >= 1000
    scattered = df.select(
        "doc_id",
        F.pmod(F.xxhash64(F.lit(5), "doc_id", F.lit(0)), F.lit(buckets)).alias("bucket"),
        F.xxhash64(F.lit(6), "doc_id", F.crc32("text")).alias("place"),
    )
    members = defaultdict(list)
    for r in sorted(scattered.collect(), key=lambda r: (r.bucket, r.place)):
        members[r.bucket].append(r.doc_id)
    at = moved = 0
    for bucket in sorted(members):
        part = orders[0][at : at + len(members[bucket])]
        assert sorted(part) == sorted(members[bucket])
        moved += part != members[bucket]
        at += len(part)
    assert moved > len(members) / 2


def test_shards_are_written_as_folders(documents, tmp_path, spark):
    df = documents([(i, f"text {i}", "en", "s", 0) for i in range(40)])
    sharding.write_shards(sharding.shuffle_into_shards(df, shards=4), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).groupBy("shard").count().count() == 4


# Mixing


def plain_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    target, open_sources, left = {}, set(order), 1.5 * sum(sizes.values())
    while open_sources:
        whole = sum(weight[s] for s in open_sources)
        full = {s for s in open_sources if left * weight[s] / whole >= 2 * sizes[s]}
        if not full:
            return target | {s: left * weight[s] / whole for s in open_sources}
        for s in full:
            target[s] = 2.0 * sizes[s]
        left -= sum(target[s] for s in full)
        open_sources -= full
    return target


def check_mix(df, near):
    got = rows_of(mixing.mix(mixing.with_sizes(df)))
    sizes = Counter()
    for r in got:
        assert r["size"] == len(WORD.findall(r["text"] or ""))
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 2
        sizes[r["source"]] += r["size"]
    want, taken = plain_targets(sizes), Counter()
    for r in got:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]])
        taken[r["source"]] += r["taken"]
    for source, words in want.items():
        assert abs(taken[source] - words) <= near
    return got


def test_mix_on_odd_rows(odd_documents):
    got = mixing.mix(mixing.with_sizes(odd_documents.drop("size")))
    assert extras_kept(got, odd_documents, "size", "target", "copies", "taken")
    assert got.count() == odd_documents.count()
    # Few, coarse documents: the nearest sum may be off by a document.
    check_mix(odd_documents.drop("size"), near=40_100)


def test_mix_meets_targets_to_the_word_and_agrees_with_itself(documents):
    pick = random.Random(3)
    rows = [
        (i, " ".join(["w"] * pick.choice([1, 2, 3, 5, 8, 13, 200])), "en", pick.choice("abcde"), 0)
        for i in range(3000)
    ]
    df = documents(rows)
    first = check_mix(df, near=1)
    again = check_mix(df.repartition(7), near=1)
    assert Counter((r["doc_id"], r["taken"]) for r in first) == Counter(
        (r["doc_id"], r["taken"]) for r in again
    )


def test_mix_orders_a_hot_length_by_slices(documents, monkeypatch):
    monkeypatch.setattr(mixing, "SLICE", 10)
    check_mix(documents([(i, "w w w", "en", "ab"[i % 5 == 0], 0) for i in range(4000)]), near=3)


def test_knapsack_finds_the_best_sum():
    pick = random.Random(2)
    for _ in range(200):
        lengths = np.array(sorted({pick.randint(1, 30) for _ in range(pick.randint(1, 6))}))
        counts = np.array([pick.randint(0, 4) for _ in lengths])
        budget = pick.randint(0, 150)
        sums = {0}
        for n, c in zip(lengths.tolist(), counts.tolist()):
            sums = {s + n * k for s in sums for k in range(c + 1)}
        taken = mixing._knapsack(lengths, counts, budget)
        assert (taken <= counts).all() and (taken >= 0).all()
        assert int((taken * lengths).sum()) == max(s for s in sums if s <= budget)


def test_budgets_beyond_the_knapsack_are_still_met():
    lengths, counts = np.arange(1, 3000), np.full(2999, 5)
    for budget in (10**6, 12_345_678, 22_000_001):
        assert int((mixing.fit_budget(lengths, counts, budget) * lengths).sum()) == budget


# Language


def test_language_on_odd_rows(odd_documents):
    profiles = language.learn_profiles(odd_documents)
    out = language.predict_language(odd_documents, profiles)
    for r in rows_of(out):
        if not any(c.isalpha() for c in r["text"] or ""):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        else:
            assert r["lang_pred"] in profiles and 0 <= r["score"] <= 1
    assert extras_kept(out, odd_documents, "score")


def plain_profile(texts):
    counts = Counter()
    for text in texts:
        letters = "".join(c.lower()[0] if c.isalpha() else " " for c in text)
        padded = " " + " ".join(letters.split()) + " "
        for n in (1, 2, 3):
            for i in range(len(padded) - n + 1):
                gram = padded[i : i + n]
                if gram != " " and not (n == 3 and gram[1] == " "):
                    counts[gram] += 1
    code = lambda g: sum(
        (1 if c == " " else ord(c)) << 21 * (len(g) - 1 - i) for i, c in enumerate(g)
    )
    return [code(g) for g, _ in sorted(counts.items(), key=lambda x: (-x[1], code(x[0])))][:300]


def test_profiles_and_distances_equal_a_plain_form(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("length(text) < 3000")
    rows = rows_of(docs)
    profiles = language.learn_profiles(docs)
    want = {
        lang: plain_profile([r["text"] for r in rows if r["lang"] == lang])
        for lang in {r["lang"] for r in rows}
    }
    assert profiles == want
    for r in rows_of(language.predict_language(docs, profiles))[:60]:
        own = plain_profile([r["text"]])
        away = {
            lang: sum(abs(p.index(g) - i) if g in p else 300 for i, g in enumerate(own))
            for lang, p in profiles.items()
        }
        best = min(sorted(away), key=away.get)
        assert r["lang_pred"] == best
        assert r["score"] == pytest.approx(1 - away[best] / (300 * len(own)))


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    docs = docs.withColumn("held_out", language.held_out(F.col("doc_id")))
    profiles = language.learn_profiles(docs.where("NOT held_out"))
    judged = language.predict_language(docs.where("held_out"), profiles)
    assert judged.agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("int"))).first()[0] > 0.98


# SimHash


def plain_fingerprint(text, words):
    found = [w.translate({c: c + 32 for c in range(65, 91)}) for w in WORD.findall(text or "")]
    if not found:
        return 0
    runs = [" ".join(found[i : i + words]) for i in range(max(1, len(found) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_of_texts_of_megabytes():
    pick = random.Random(3)
    texts = [" ".join(pick.choices(["Lorem", "é", "DOLOR", "sit\u00a0amet"], k=120_000)) + "\n" * 900_000]
    texts += [" " * 1_000_000, "x" * 1_000_000, "One two", "One two three", "a b c d", ""]
    for text in texts:
        hashes = simhash.shingle_hashes(text, 3)
        bits = simhash.majority_bits(hashes, np.array([len(hashes)]))
        assert int(bits[0]) == plain_fingerprint(text, 3)


def components(n, linked):
    root = list(range(n))
    for i in range(n):
        for j in range(i):
            if linked(i, j) and root[i] != root[j]:
                a, b = sorted((root[i], root[j]))
                root = [a if r == b else r for r in root]
    return root


def test_simhash_on_odd_rows(odd_documents):
    out = simhash.near_duplicates(odd_documents)
    got = rows_of(out)
    assert extras_kept(out, odd_documents, "text", "fingerprint")
    given = rows_of(odd_documents)
    prints = [plain_fingerprint(r["text"], 3) for r in given]
    assert Counter((r["doc_id"], r["fingerprint"]) for r in got) == Counter(
        (r["doc_id"], f"{p:016x}") for r, p in zip(given, prints)
    )
    roots = components(len(given), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 2)
    members = defaultdict(list)
    for r, root in zip(given, roots):
        members[root].append(r["doc_id"])
    least = {k: min((x for x in v if x is not None), default=None) for k, v in members.items()}
    assert Counter((r["doc_id"], r["component_id"]) for r in got) == Counter(
        (r["doc_id"], least[root]) for r, root in zip(given, roots)
    )


@pytest.mark.parametrize("tree_size", [4096, 4])
def test_trees_link_what_all_pairs_link(spark, tree_size):
    pick = random.Random(7)
    values = {pick.getrandbits(64) for _ in range(60)}
    for v in list(values)[:30]:
        for _ in range(6):
            values.add(v ^ (1 << pick.randrange(64)) ^ (1 << pick.randrange(64)))
            values.add(v ^ (1 << pick.randrange(64)) ^ (1 << pick.randrange(20)) ^ (1 << 63))
    signed = sorted(simhash._signed(v) for v in values)
    df = spark.createDataFrame([(v,) for v in signed], "value long")
    edges = simhash.near_links(df, 2, tree_size).collect()
    bits = lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count()
    at = {v: i for i, v in enumerate(signed)}
    joined = {(max(at[e.a], at[e.b]), min(at[e.a], at[e.b])) for e in edges}
    want = components(len(signed), lambda i, j: bits(signed[i], signed[j]) <= 2)
    assert components(len(signed), lambda i, j: (i, j) in joined) == want


def near_copies_to_keep(rows):
    """The smallest id of each component of fingerprints at most two bits apart."""
    prints = [plain_fingerprint(text, 3) for _, text in rows]
    roots = components(len(rows), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 2)
    ids = defaultdict(list)
    for (doc_id, _), root in zip(rows, roots):
        ids[root].append(doc_id)
    order = lambda x: (x is None, x or 0)
    return sorted((min(v, key=order) for v in ids.values()), key=order)


def test_kept_of_near_copies_equal_all_pairs(documents):
    pick = random.Random(9)
    rows = []
    for _ in range(40):
        base = [f"w{pick.randint(0, 5000)}" for _ in range(pick.choice([1, 3, 5, 12, 150, 600]))]
        for _ in range(pick.randint(1, 5)):
            copy = list(base)
            for _ in range(pick.randint(0, 2)):
                copy[pick.randrange(len(copy))] = f"e{pick.randint(0, 5000)}"
            rows.append((len(rows), " ".join(copy), "en", "s", 0))
    n = len(rows)
    rows += [(n, "", "en", "s", 0), (n + 1, None, "en", "s", 0), (n + 2, "two words", "en", "s", 0)]
    rows += [(n + 3, "two  Words", "en", "s", 0), (None, "two words", "en", "s", 0), rows[0], rows[0]]
    # One id with texts of one group, and of two groups.
    rows += [(0, rows[0][1] + " ", "fr", "s", 0), (0, "another group's text altogether", "en", "s", 0)]
    kept = rows_of(simhash.keep_one_of_each(documents(rows).repartition(5)))
    want = near_copies_to_keep([r[:2] for r in rows])
    assert sorted(r["doc_id"] for r in kept) == want
    again = rows_of(simhash.keep_one_of_each(documents(rows[::-1]).repartition(3)))
    assert Counter(map(str, kept)) == Counter(map(str, again))


def test_kept_of_near_copies_on_odd_rows(odd_documents):
    out = simhash.keep_one_of_each(odd_documents)
    assert out.columns == odd_documents.columns
    kept, given = rows_of(out), rows_of(odd_documents)
    want = near_copies_to_keep([(r["doc_id"], r["text"]) for r in given])
    assert sorted((r["doc_id"] for r in kept), key=lambda x: (x is None, x or 0)) == want
    assert not Counter(map(str, kept)) - Counter(map(str, given))


# SentencePiece


def awkward_texts():
    pick = random.Random(4)
    alphabet = "aab ▁<>s0xé日\U0001f642\n\t\x00　́ABthe  "
    texts = ["".join(pick.choices(alphabet, k=pick.randint(0, 60))) for _ in range(800)]
    return texts + ["a" * 2000, "ab" * 700, " " * 300, "aAbB9" * 300, "the" * 500, "", "▁", "﻿"]


def test_ids_and_texts_equal_the_library(spark, documents):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = awkward_texts()
    df = documents([(i, t, "en", "s", 0) for i, t in enumerate(texts)])
    for r in rows_of(pieces.encode_texts(df, MODEL)):
        want = library.encode(texts[r["doc_id"]], add_bos=True, add_eos=True)
        assert np.frombuffer(r["ids"], "<u4").tolist() == want
        assert r["n_tokens"] == len(want)
        assert r["decoded"] == library.decode(want)


def test_decoding_any_ids_equals_the_library():
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    table, pick = pieces.Pieces.load(MODEL), np.random.default_rng(0)
    for _ in range(1500):
        ids = pick.integers(0, pick.choice([300, 32000]), pick.integers(0, 9))
        assert pieces.decode(table, ids, [len(ids)]) == [library.decode(ids.tolist())]


def test_long_words_and_runs_equal_the_library_in_few_rounds(monkeypatch):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    table, pick = pieces.Pieces.load(MODEL), random.Random(7)
    letters = "abcdefghijklmnopqrstuvwxyz"
    texts = [
        " " * 100_000, " " * 99_999 + "the" + " " * 77, "#" * 100_001, "la" * 50_000, "-" * 100_003,
        "".join(pick.choices(letters, k=1_000_000)), "".join(pick.choices("acgt", k=200_000)),
        "".join(pick.choices("日本語の文章é́", k=100_000)), "thequickbrownfox" * 20_000,
    ]
    texts += [" " * n + tail for n in range(1, 50) for tail in ("", "the", "x", "日")]
    rounds = []
    table.pairs, table.word
    for text in texts:
        rounds.clear()
        with monkeypatch.context() as patch:
            patch.setattr(pieces.np, "minimum", Minimum(np.minimum, rounds))
            ids, counts = pieces.Encoder(table).encode([text])
        want = library.encode(text, add_bos=True, add_eos=True)
        assert ids.tolist() == want
        assert pieces.decode(table, ids, counts) == [library.decode(want)]
        assert len(rounds) <= 100


class Minimum:
    """`np.minimum` that notes each round of merges."""

    def __init__(self, minimum, rounds):
        self.minimum, self.rounds = minimum, rounds

    def __call__(self, *args):
        return self.minimum(*args)

    def reduceat(self, *args):
        self.rounds.append(1)
        return self.minimum.reduceat(*args)


def test_words_put_together_from_pieces_equal_the_library():
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    table, pick = pieces.Pieces.load(MODEL), random.Random(8)
    for _ in range(1500):
        some = [table.texts[pick.randrange(300, 32000)] for _ in range(pick.randint(1, 30))]
        text = "".join(t.replace("▁", pick.choice(["", " ", "  "])) for t in some)
        ids, _ = pieces.Encoder(table).encode([text])
        assert ids.tolist() == library.encode(text, add_bos=True, add_eos=True)


def test_forgetting_words_changes_nothing():
    table = pieces.Pieces.load(MODEL)
    texts = awkward_texts()[:200]
    ids, counts = pieces.Encoder(table).encode(texts)
    forgetful = pieces.Encoder(table, cached_words=5)
    parts = [forgetful.encode(texts[i : i + 7]) for i in range(0, len(texts), 7)]
    assert np.array_equal(np.concatenate([p[0] for p in parts]), ids)
    assert np.array_equal(np.concatenate([p[1] for p in parts]), counts)


def test_pieces_on_odd_rows(odd_documents):
    out = pieces.encode_texts(odd_documents, MODEL)
    assert extras_kept(out, odd_documents, "text", "ids")
    want = Counter((r["doc_id"], r["text"] or "") for r in rows_of(odd_documents))
    assert Counter((r["doc_id"], r["decoded"]) for r in rows_of(out)) == want


# Empty tables


def test_empty_tables_give_empty_results(no_documents):
    results = [
        line_dedup.drop_repeated_lines(no_documents),
        sharding.shuffle_into_shards(no_documents),
        mixing.mix(mixing.with_sizes(no_documents)),
        language.predict_language(no_documents, language.learn_profiles(no_documents)),
        simhash.near_duplicates(no_documents),
        simhash.keep_one_of_each(no_documents),
        pieces.encode_texts(no_documents, MODEL),
    ]
    assert [df.count() for df in results] == [0] * len(results)


def test_digests_of_the_line_query(spark, sf_dir):
    from logbraid.llm.queries import line_dedup as query

    rows = {r["doc_id"]: r for r in rows_of(spark.read.parquet(f"{sf_dir}/documents.parquet"))}
    want = plain_line_dedup([(k, r["text"]) for k, r in rows.items()])
    digest = Counter()
    for (doc_id, n, dropped, kept), c in want.items():
        digest[doc_id, n, dropped, hashlib.sha256(kept.encode()).hexdigest()] += c
    got = rows_of(query(spark, sf_dir))
    assert Counter((r["doc_id"], r["n_lines"], r["n_dropped"], r["kept_sha256"]) for r in got) == digest
