"""The registered queries: their columns, a row for every row, and those that SQL can check."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry
from logbraid.llm.queries import ORACLES, QUERIES
from tests.compare import oracle, oracle_rows, spark_rows

COLUMNS = {
    "op1": ("pages", "page_id url text n_chars"),
    "op2": ("documents", "doc_id size source_size target taken"),
    "op3": ("documents", "doc_id size text_crc32 law shard slot grown_shard"),
    "op4": ("embeddings", "vec_id n_links component_id kept"),
    "op5": ("documents", "doc_id n_lines n_dropped kept_sha256"),
    "op6": (None, "query_id rank vec_id score"),
    "op7": ("pages", "page_id host path rule verdict"),
    "op8": ("documents", "doc_id held_out lang_pred score"),
    "op9": ("documents", "doc_id fingerprint component_id"),
    "op10": ("documents", "doc_id n_tokens ids_sha256 decoded_sha256"),
    "op11": ([], "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256"),
    "op12": ([], "lang rank phrase a l r n score"),
    "op13": ("documents", "doc_id n_tokens ids_sha256 decoded_sha256"),
}


def test_every_operator_has_one_query():
    numbers = [re.match(r"op(\d+)_", name)[1] for name in QUERIES]
    assert sorted(map(int, numbers)) == list(range(1, 14))
    assert ORACLES.keys() <= QUERIES.keys()
    assert {*QUERIES, "pipeline"} <= entry.queries().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_a_row_for_every_row(spark, sf_dir, name):
    table, columns = COLUMNS[name.split("_")[0]]
    result = QUERIES[name](spark, sf_dir)
    assert result.columns == columns.split()
    if table == []:  # its rows are not those of a table; its SQL tells how many
        return
    read = spark.read.parquet(f"{sf_dir}/{table or 'embeddings'}.parquet")
    want = read.count() if table else 20 * read.where("vec_id % 20 = 0").count()
    assert result.count() == want


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_its_sql(spark, sf_dir, name):
    got = spark_rows(QUERIES[name](spark, sf_dir))
    assert got == oracle_rows(oracle(sf_dir), ORACLES[name])


def test_the_sharding_plan_runs_no_python_and_moves_texts_once(spark, sf_dir):
    from logbraid.llm.sharding import shuffle_into_shards

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plan = shuffle_into_shards(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Join" not in plan
    with_texts = [x for x in plan.splitlines() if re.search(r"Exchange (?!Single)", x)]
    assert sum("bucket" in x for x in with_texts) <= 2
