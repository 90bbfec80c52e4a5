"""Every stage of the pipeline against a plain form of itself, on the input it gets."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest
import sentencepiece

import corpus_pipeline
from logbraid.functions.lineage import materialize
from tests.llm.test_documents import (
    MODEL,
    WORD,
    near_copies_to_keep,
    plain_line_dedup,
    plain_targets,
    rows_of,
)

COLUMNS = list(corpus_pipeline.COLUMNS)


def check_language(given, got):
    want = [r for r in given if any(c.isalpha() for c in r["text"] or "")]
    assert Counter(map(str, got)) == Counter(map(str, want))


def check_lines(given, got):
    want = plain_line_dedup([(r["doc_id"], r["text"]) for r in given])
    kept = Counter()
    for (doc_id, _, _, text), n in want.items():
        kept[doc_id, text] += n
    assert Counter((r["doc_id"], r["text"]) for r in got) == kept
    assert all(r["n_chars"] == len(r["text"]) for r in got)


def check_near_copies(given, got):
    ids = sorted((r["doc_id"] for r in got), key=lambda x: (x is None, x or 0))
    assert ids == near_copies_to_keep([(r["doc_id"], r["text"]) for r in given])
    assert {str(r) for r in got} <= {str(r) for r in given}


def check_mix(given, got):
    sizes, taken = Counter(), Counter()
    for r in given:
        sizes[r["source"]] += len(WORD.findall(r["text"] or ""))
    for r in got:
        taken[r["source"]] += len(WORD.findall(r["text"] or ""))
    # Rows that share an id are taken together.
    longest = max((len(WORD.findall(r["text"] or "")) for r in given), default=0)
    longest *= max(Counter(r["doc_id"] for r in given).values(), default=0)
    targets = plain_targets(sizes)
    assert all(abs(taken[s] - t) <= longest for s, t in targets.items())
    copies, there = Counter(map(str, got)), Counter(map(str, given))
    assert all(there[row] and n <= 2 * there[row] for row, n in copies.items())


def check_encode(given, got):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    want = Counter()
    for r in given:
        ids = library.encode(r["text"] or "", add_bos=True, add_eos=True)
        want[r["doc_id"], np.array(ids, dtype="<u4").tobytes()] += 1
    assert Counter((r["doc_id"], bytes(r["ids"])) for r in got) == want


CHECKS = {
    "language": check_language,
    "lines": check_lines,
    "near_copies": check_near_copies,
    "mix": check_mix,
    "encode": check_encode,
}


def run_stages(spark, docs, sf_dir):
    assert [name for name, _ in corpus_pipeline.STAGES] == list(CHECKS)
    given = rows_of(docs.select(*COLUMNS))
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
        got = rows_of(docs)
        if name != "encode":
            assert docs.columns == COLUMNS
        CHECKS[name](given, got)
        given = got
    return given


def test_stages_on_odd_rows(spark, odd_documents):
    assert run_stages(spark, odd_documents, "")


def test_stages_on_given_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert run_stages(spark, docs, sf_dir)


def test_stages_on_no_documents(spark, no_documents):
    assert run_stages(spark, no_documents, "") == []


@pytest.mark.parametrize("column", COLUMNS)
def test_a_column_of_nulls(spark, documents, column):
    rows = [(i, f"Some words of text number {i}", "en", "s", 30) for i in range(6)]
    place = COLUMNS.index(column)
    nulled = [tuple(None if n == place else x for n, x in enumerate(r)) for r in rows]
    run_stages(spark, documents(nulled), "")


def test_run_gives_the_last_stages_rows(spark, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir)
    assert out.count() > 100 and "ids" in out.columns
