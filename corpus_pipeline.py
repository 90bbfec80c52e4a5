"""From raw documents to token ids: five stages, each an operator of `logbraid.llm`.

`run` applies them to the `documents` of a folder. Every stage works on all rows its predecessor
kept and returns the columns of documents; the last returns token ids.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logbraid.functions.lineage import materialize
from logbraid.llm.language import UNDETERMINED, held_out, learn_profiles, predict_language
from logbraid.llm.line_dedup import drop_repeated_lines
from logbraid.llm.mixing import mix, with_sizes
from logbraid.llm.pieces import encode_texts
from logbraid.llm.simhash import keep_one_of_each

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; those without a letter go. Profiles are learned from the
    labelled documents that are not held out. `lang` stays as it was given. Without any labelled
    document no language is known, and every document with a letter stays."""
    profiles = learn_profiles(docs.where(~held_out(F.col("doc_id"))))
    if not profiles:
        return docs.select(*COLUMNS).where(F.col("text").rlike(r"\p{L}"))
    judged = predict_language(docs.select(*COLUMNS), profiles)
    return judged.where(F.col("lang_pred") != UNDETERMINED).select(*COLUMNS)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines of ten and more characters that another one before them has."""
    kept = drop_repeated_lines(docs.select(*COLUMNS)).withColumn("text", F.col("kept"))
    return _counted(kept)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links of at most two differing bits between fingerprints
    of three-word shingles connect: the one of the smallest id."""
    return keep_one_of_each(docs.select(*COLUMNS), words=3, radius=2)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it: not at all, once or twice."""
    mixed = mix(with_sizes(docs.select(*COLUMNS))).where("copies > 0")
    copies = F.sequence(F.lit(1), F.col("copies").cast("int"))
    return mixed.withColumn("copy", F.explode(copies)).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and digests of them and of the text they decode to."""
    encoded = encode_texts(docs.select(*COLUMNS), public_tokenizers.path("piece_bpe_32k.model"))
    return encoded.select(
        "doc_id",
        "lang",
        "source",
        "n_tokens",
        "ids",
        F.sha2(F.col("ids"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


def _counted(docs: DataFrame) -> DataFrame:
    n_chars = F.length("text").cast(docs.schema["n_chars"].dataType)
    return docs.withColumn("n_chars", n_chars).select(*COLUMNS)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("language", identify_language),
    ("lines", drop_lines),
    ("near_copies", drop_near_copies),
    ("mix", mix_sources),
    ("encode", encode),
]

# Merges of pieces, and a budget fitted by dynamic programming, are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. Each stage's result is a table that the next one reads."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
