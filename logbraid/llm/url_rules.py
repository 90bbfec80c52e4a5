"""Judging urls by host and path rules, as a sort-merge range join.

A key is a host's labels in reverse, each ended by a dot, then a slash-free mark and the path. In
that form a rule is a prefix, so that it covers an interval of keys, and intervals nest or are
apart. As a rule holds for subdomains too, a url has one key per number of labels that rules
have; each ends in the whole path.

Distinct keys and rules are cut into parts by sampled bounds; a rule goes to every part that its
interval touches. A part is sorted and swept once with a stack of the rules that are open, so
that memory is the depth of nesting. The longest rule over a url's keys wins. Verdicts are found
once per distinct host and path and joined to the rows, so a url with a third of all rows is one
key; the join back is an inner join, whose hot keys adaptive execution splits.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logbraid.functions.lineage import materialize
from logbraid.llm.rows import LOWER, UPPER, packed, unpacked

# Ends the host in a key; sorts before all that a path may begin with.
_MARK = "\x01"
_LAST = "\U0010ffff"
# The bounds between parts go through the driver: so many samples for each of so many parts.
SAMPLES_PER_PART, MOST_PARTS = 20, 10_000
RESULTS = ("host", "path", "rule", "verdict")


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path): what follows the first `://`; both empty without it."""
    scheme = F.instr(url, "://")
    rest = F.when(scheme > 0, F.substring(url, scheme + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def _reversed(labels: Column) -> Column:
    return F.concat(F.array_join(F.reverse(labels), "."), F.lit("."))


def _key(levels: Column, labels: Column, path: Column) -> Column:
    """With the number of labels in front, so that none can be taken for a mark."""
    return F.concat(levels.cast("string"), F.lit(":"), labels, F.lit(_MARK), path)


def _labels(host: Column) -> Column:
    return F.split(host, r"\.")


def rule_keys(rules: DataFrame) -> DataFrame:
    """(key, levels, length, rule, verdict) of rules with host, path and verdict, one per key.

    A rule without a host has no labels and holds for any. Of rules with equal host and path
    one that blocks wins.
    """
    host = F.translate(F.coalesce("host", F.lit("")), UPPER, LOWER)
    path = F.coalesce("path", F.lit(""))
    labels = _labels(host)
    some = F.length(host) > 0
    levels = F.when(some, F.size(labels)).otherwise(0)
    return (
        rules.select(
            _key(levels, F.when(some, _reversed(labels)).otherwise(""), path).alias("key"),
            levels.alias("levels"),
            F.concat(host, path).alias("rule"),
            F.length(host).alias("host_length"),
            "verdict",
        )
        .groupBy("key", "levels", "rule", "host_length")
        .agg(F.max("verdict").alias("verdict"))
    )


def _sweep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by part and key, rules first: the innermost open rule of every url's key."""
    part, stack = None, []
    names = ("part", "key", "host", "path", "rule", "host_length", "verdict")
    for batch in batches:
        out = []
        for number, key, host, path, *rule in zip(*(batch.column(n).to_pylist() for n in names)):
            if number != part:
                part, stack = number, []
            while stack and not key.startswith(stack[-1][0]):
                stack.pop()
            if rule[0] is not None:
                stack.append((key, rule))
            elif stack:
                out.append((host, path, *stack[-1][1]))
        text = pa.string()
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(c, kind)
                for c, kind in zip(
                    list(zip(*out)) or [()] * 5, (text, text, text, pa.int32(), text)
                )
            ],
            ["host", "path", "rule", "host_length", "verdict"],
        )


def longest_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, rule, verdict) of those distinct (host, path) that a rule fits."""
    keyed_rules = materialize(rule_keys(rules), "rules")
    # At most as many numbers as a host has labels.
    levels = sorted(r.levels for r in keyed_rules.select("levels").distinct().collect())
    labels = _labels(F.col("host"))
    keys = [
        F.when(
            (F.size("labels") >= n) & (F.length("host") > 0) if n else F.lit(True),
            _key(
                F.lit(n),
                _reversed(F.slice("labels", F.size("labels") - (n - 1), n)) if n else F.lit(""),
                F.col("path"),
            ),
        )
        for n in levels
    ]
    if not keys:
        none = F.lit("")
        return urls.select("host", "path", none.alias("rule"), none.alias("verdict")).limit(0)
    url_keys = (
        urls.withColumn("labels", labels)
        .select("host", "path", F.explode(F.array(*keys)).alias("key"))
        .where("key IS NOT NULL")
    )
    url_keys = materialize(url_keys, "url_keys")

    parts = min(MOST_PARTS, int(urls.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    bounds = _bounds(url_keys, parts)
    # Bounds are at most `MOST_PARTS` strings.
    shared = urls.sparkSession.sparkContext.broadcast(bounds)

    @F.pandas_udf("int")
    def part_of(keys):
        return keys.map(lambda key: bisect_right(shared.value, key)).astype("int32")

    @F.pandas_udf("int")
    def part_below(keys):
        return keys.map(lambda key: bisect_left(shared.value, key)).astype("int32")

    touched = F.sequence(part_of("key"), part_below(F.concat("key", F.lit(_LAST))))
    placed = url_keys.withColumn("part", part_of("key")).unionByName(
        keyed_rules.drop("levels").withColumn("part", F.explode(touched)),
        allowMissingColumns=True,
    )
    swept = (
        placed.repartition(parts, "part")
        .sortWithinPartitions("part", "key", F.asc_nulls_last("rule"))
        .mapInArrow(
            _sweep, "host string, path string, rule string, host_length int, verdict string"
        )
    )
    # Of rules of one length the one with the longer host.
    best = F.max(F.struct(F.length("rule"), "host_length", "rule", "verdict"))
    return (
        swept.groupBy("host", "path")
        .agg(best.alias("best"))
        .select("host", "path", "best.rule", "best.verdict")
    )


def _bounds(keys: DataFrame, parts: int) -> list[str]:
    """Up to `parts` - 1 keys that cut the keys into like shares. They only place the cuts."""
    n = keys.count()
    wanted = parts * SAMPLES_PER_PART
    one_in = max(1, n // wanted)
    picked = keys.select("key", F.xxhash64("key").alias("h")).where(
        F.pmod("h", F.lit(one_in)) == 0
    )
    sample = sorted({r.key for r in picked.orderBy("h").limit(2 * wanted).select("key").collect()})
    return sorted({sample[len(sample) * i // parts] for i in range(1, parts)}) if sample else []


def judge_urls(
    rows: DataFrame,
    rules: DataFrame | Sequence[Rule],
    url: str = "url",
    otherwise: str = "allow",
) -> DataFrame:
    """`rows` with `host`, `path`, the longest fitting `rule` (host and path, else NULL) and its
    `verdict`, or `otherwise` if none fits.

    A rule fits its host and all subdomains, where the path starts with the rule's path. Rules
    may be a table with host, path and verdict. A NULL url, or one without `://`, has an empty
    host and path, which only a rule without a host fits. Repeated rows come out alike, empty
    tables of rows or rules are no error, and columns named as the results are replaced.
    """
    if not isinstance(rules, DataFrame):
        rules = rows.sparkSession.createDataFrame(
            list(rules), "host string, path string, verdict string"
        )
    host, path = split_url(F.col(url))
    split = packed(rows, host=host, path=path)
    urls = materialize(split.select("host", "path").distinct(), "urls")
    found = longest_rules(urls, rules).withColumnsRenamed({"host": "h", "path": "p"})
    every = urls.join(found, (F.col("host") == F.col("h")) & (F.col("path") == F.col("p")), "left")
    every = materialize(
        every.select(
            F.col("host").alias("h"),
            F.col("path").alias("p"),
            "rule",
            F.coalesce("verdict", F.lit(otherwise)).alias("verdict"),
        ),
        "verdicts",
    )
    joined = split.join(every, (F.col("host") == F.col("h")) & (F.col("path") == F.col("p")))
    return unpacked(joined, rows.columns, RESULTS)
