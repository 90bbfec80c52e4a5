"""A two-pass external shuffle into shards, in DataFrame operations only.

Pass one scatters rows uniformly into buckets that fit in a task's memory, by a seeded hash of
their id. Pass two takes each bucket as one array, Fisher-Yates shuffles it (Spark's `shuffle`
does that) and hands it on in its new order. Buckets follow each other, so a row's rank in the
shuffled whole is the number of rows in earlier buckets plus its place in its own; shards are
equal cuts of the ranks. The texts cross one shuffle, in which a task takes many buckets, so that
tasks are as many as the bytes ask for up to a bound, and holds at most some of them at a time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logbraid.functions.lineage import materialize
from logbraid.llm.rows import packed, unpacked

# A bucket is held as one array, twice while it is shuffled, by each task of an executor, beside
# those whose rows it still collects: Spark holds 128, and sorts by bucket what is more.
BUCKET_BYTES = 1 << 20
# Buckets that a task takes, until there are MOST_PARTS tasks, which then take more.
BUCKETS_A_PART, MOST_PARTS = 8, 20_000
# Buckets whose rows are added up before the sum over all, which one task forms.
_RUN = 1 << 12
RESULTS = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")


def _scattered(
    docs: DataFrame, doc_id: str, text: str, seed: int, bucket_bytes: int
) -> tuple[DataFrame, int, int]:
    """(rows with their `bucket`, the number of buckets, the number of rows)."""
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + 1
    per_id = docs.groupBy(F.col(doc_id).alias("id")).agg(
        F.sum(size).alias("bytes"), F.count(F.lit(1)).alias("n")
    )
    total = per_id.agg(
        F.sum("bytes").alias("bytes"), F.sum("n").alias("n"), F.max("bytes").alias("heaviest")
    ).first()
    buckets = max(1, -(-(total.bytes or 0) // bucket_bytes))

    rows = packed(docs, id=F.col(doc_id), size=size, crc=F.crc32(F.coalesce(text, F.lit(""))))
    salt: Column = F.lit(0)
    if (total.heaviest or 0) > bucket_bytes:
        # An id with more than a bucket's bytes: its rows are spread one by one. Such ids are no
        # more than buckets; how they are joined is left to Spark, which knows their table's size.
        heavy = materialize(
            per_id.where(F.col("bytes") > bucket_bytes).select(F.col("id").alias("heavy_id")),
            "heavy_ids",
        ).withColumn("heavy", F.lit(True))
        rows = rows.withColumn("place", F.monotonically_increasing_id())
        rows = rows.join(heavy, F.col("id").eqNullSafe(F.col("heavy_id")), "left")
        salt = F.when(F.col("heavy"), F.col("place") + 1).otherwise(0)
    bucket = F.pmod(F.xxhash64(F.lit(seed), "id", salt), F.lit(buckets))
    return (
        rows.select(bucket.cast("int").alias("bucket"), "id", "size", "crc", "row"),
        buckets,
        total.n or 0,
    )


def _starts(counts: DataFrame) -> DataFrame:
    """(bucket, start): how many rows earlier buckets have, `counts` having each bucket's."""

    def earlier(n: str, window: Window) -> Column:
        rows = F.sum(n).over(window.rowsBetween(Window.unboundedPreceding, -1))
        return F.coalesce(rows, F.lit(0))

    counts = counts.withColumn("run", F.expr(f"bucket div {_RUN}"))
    runs = counts.groupBy(F.col("run").alias("r")).agg(F.sum("count").alias("rows"))
    runs = runs.select("r", earlier("rows", Window.orderBy("r")).alias("first"))
    within = earlier("count", Window.partitionBy("run").orderBy("bucket"))
    placed = counts.withColumn("within", within).join(runs, F.col("run") == F.col("r"))
    return placed.select("bucket", (F.col("first") + F.col("within")).alias("start"))


def shuffle_into_shards(
    docs: DataFrame,
    shards: int = 16,
    seed: int = 42,
    doc_id: str = "doc_id",
    text: str = "text",
    bucket_bytes: int = BUCKET_BYTES,
    most_parts: int = MOST_PARTS,
) -> DataFrame:
    """`docs` in a seeded random order, cut into `shards` whose row counts differ by one at most.

    Adds `size` (UTF-8 bytes plus one), `text_crc32`, the `law` kept (`rows`), the `shard`, the
    row's `slot` in it, gapless from 0, and `grown_shard`, NULL as the law is not `key`.

    A NULL text counts as empty. Rows may share an id or be equal in full: they are rows all the
    same, and ids that hold more than a bucket's bytes are spread over all buckets by their place
    in the scan, so that order depends on the scan's splits too. Equal texts are not kept
    together. A text longer than a bucket is whole in one, which a task holds twice. An empty table
    gives an empty result. Columns named as the results are replaced. At most `most_parts` tasks
    shuffle buckets.
    """
    scattered, buckets, n = _scattered(docs, doc_id, text, seed, bucket_bytes)
    starts = _starts(materialize(scattered.groupBy("bucket").count(), "bucket_counts"))
    parts = min(-(-buckets // BUCKETS_A_PART), most_parts)
    # A bucket's start travels with its rows, so that no join moves the texts again.
    member = F.struct(F.xxhash64(F.lit(seed + 1), "id", "crc"), "id", "crc", "size", "row")
    both = scattered.select("bucket", member.alias("member"), F.lit(None).alias("start"))
    both = both.unionByName(starts.select("bucket", "start"), allowMissingColumns=True)
    arrays = (
        both.repartitionById(parts, F.col("bucket"))  # the remainder by `parts`
        .groupBy("bucket")
        .agg(F.collect_list("member").alias("members"), F.max("start").alias("start"))
    )
    # `shuffle` draws one row after the other, so a task's buckets must come in one order.
    shuffled = arrays.sortWithinPartitions("bucket").select(
        "start", F.posexplode(F.shuffle(F.array_sort("members"), seed)).alias("at", "member")
    )
    rank = F.col("start") + F.col("at")
    placed = shuffled.select("member.*", rank.alias("rank")).withColumn(
        "shard", F.expr(f"rank * {shards} div {max(n, 1)}")
    )
    return unpacked(
        placed.select(
            "row",
            "size",
            F.col("crc").alias("text_crc32"),
            F.lit("rows").alias("law"),
            F.col("shard").cast("int").alias("shard"),
            (F.col("rank") - F.expr(f"(shard * {n} + {shards - 1}) div {shards}")).alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        ),
        docs.columns,
        RESULTS,
    )


def write_shards(placed: DataFrame, path: str) -> None:
    """Write shuffled rows as one folder per shard; files of a shard hold runs of its slots."""
    placed.write.partitionBy("shard").parquet(path)
