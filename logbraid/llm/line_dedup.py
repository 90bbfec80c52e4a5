"""Dropping lines that other documents have too.

Every text is exploded into lines; a line's key is its text without white space at the ends and
with A-Z in lower case. Per 128-bit hash of a key the distinct documents are counted, lines over
the threshold go, and the text is put together again by position.

Only hashes, positions and ids go through the counting shuffles. A line that a third of all
documents share is counted after one row per hash and document, then per task, and the join that
tells its documents is an inner join, which adaptive execution splits. The texts themselves are
shuffled once, to meet the positions they lose.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logbraid.functions.lineage import materialize
from logbraid.llm.rows import LOWER, UPPER, WHITE_SPACE, packed, unpacked

RESULTS = ("n_lines", "n_dropped", "kept")


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(WHITE_SPACE)), UPPER, LOWER)


def line_hashes(docs: DataFrame, doc_id: str, text: str, min_length: int) -> DataFrame:
    """(id, version, position, h1, h2) of every line whose key is long enough.

    `version` is a hash of the whole text, so that rows that share an id keep their own lines.
    """
    lines = docs.select(
        F.col(doc_id).alias("id"),
        F.xxhash64(text).alias("version"),
        F.posexplode(_lines(F.col(text))).alias("position", "line"),
    )
    keyed = lines.withColumn("key", line_key(F.col("line"))).where(F.length("key") >= min_length)
    return keyed.select(
        "id",
        "version",
        "position",
        F.xxhash64("key").alias("h1"),
        F.xxhash64(F.lit("second"), "key").alias("h2"),
    )


def repeated_keys(hashes: DataFrame, min_docs: int) -> DataFrame:
    """(h1, h2, owner): keys in at least `min_docs` documents, and the smallest id holding each."""
    in_document = hashes.select("h1", "h2", "id").distinct()
    # NULL ids count as one document, which comes last.
    owner = F.min(F.struct(F.col("id").isNull().alias("unnamed"), F.col("id")))
    counted = in_document.groupBy("h1", "h2").agg(
        F.count(F.lit(1)).alias("n"), owner.alias("owner")
    )
    return counted.where(F.col("n") >= min_docs).select("h1", "h2", F.col("owner.id").alias("owner"))


def drop_repeated_lines(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    min_docs: int = 2,
    min_length: int = 10,
) -> DataFrame:
    """`docs` with `n_lines` before dropping, `n_dropped` and the text `kept`.

    A key of at least `min_length` code points that at least `min_docs` documents hold loses all
    its lines except those in the document with the smallest id, which keeps all of them.

    A NULL or empty text is one empty line and stays one; NULL becomes empty. Rows with one id are
    one document, and a NULL id is a document that comes last; each row loses its own lines, so
    repeated rows come out alike. Texts are split whole in one row each, so a text and its lines
    must fit into a task; its hashed lines travel one by one. An empty table gives an empty result. Columns of `docs` named
    as the results are replaced, others pass through.
    """
    hashes = materialize(line_hashes(docs, doc_id, text, min_length), "line_hashes")
    # As a table of its own, so that a hot key's rows can be split on the other side of the join.
    repeated = materialize(repeated_keys(hashes, min_docs), "repeated_lines")
    lost = (
        hashes.join(repeated, ["h1", "h2"])
        .where(~F.col("id").eqNullSafe(F.col("owner")))
        .groupBy(F.col("id").alias("lost_id"), F.col("version").alias("lost_version"))
        .agg(F.collect_set("position").alias("lost"))
    )
    rows = packed(docs, id=F.col(doc_id), version=F.xxhash64(text), text=F.col(text))
    joined = rows.join(
        lost,
        F.col("id").eqNullSafe(F.col("lost_id")) & (F.col("version") == F.col("lost_version")),
        "left",
    )
    lines = _lines(F.col("text"))
    # The lines are bound to a variable once; looked up by place, each costs the same.
    kept_of = F.transform(
        F.array(lines),
        lambda whole: F.array_join(
            F.transform(
                F.array_except(F.sequence(F.lit(0), F.size(whole) - 1), F.col("lost")),
                lambda place: whole[place],
            ),
            "\n",
        ),
    )[0]
    n_lines = F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit("\n")) + 1
    return unpacked(
        joined.select(
            "row",
            n_lines.cast("bigint").alias("n_lines"),
            F.coalesce(F.size("lost"), F.lit(0)).cast("bigint").alias("n_dropped"),
            F.when(F.col("lost").isNull(), F.coalesce(F.col("text"), F.lit("")))
            .otherwise(kept_of)
            .alias("kept"),
        ),
        docs.columns,
        RESULTS,
    )
