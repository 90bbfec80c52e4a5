"""Keyed tables whose writes take effect all at once.

A write puts the sessions it touches, whole, into a generation of its own, and then names that
generation in a new version, which one rename puts in place:

    data/generation=<id>/<session>/*.parquet
    versions/<n>/*.parquet        (session, generation, live)

Readers follow the highest version. A write that stops halfway leaves files that no version names
and the table as it was; of two writes that began from one version only the first takes effect, the
other fails and can be run again. Nothing is replaced in place, so those who read go on reading
what they began with, until `drop_old` removes what is no longer live.

The rename must be atomic and refuse a name that is taken, as HDFS and local disks have it.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logbraid.operators.normalize import of_sessions
from logbraid.operators.order import in_order
from logbraid.sources.registry import KEY

GENERATION = "generation"


class OtherWrite(RuntimeError):
    """Another write took effect since this one began."""


@dataclass(frozen=True)
class Generations:
    """The table at `path`, partitioned by session."""

    spark: SparkSession
    path: str
    schema: T.StructType

    @property
    def _data(self) -> str:
        return f"{self.path}/data"

    def _version_path(self, version: int) -> str:
        return f"{self.path}/versions/{version}"

    def _hadoop(self, path: str):
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        found = jvm.org.apache.hadoop.fs.Path(path)
        return found, found.getFileSystem(conf)

    def _names(self, path: str) -> list[str]:
        folder, files = self._hadoop(path)
        if not files.exists(folder):
            return []
        return [status.getPath().getName() for status in files.listStatus(folder)]

    def version(self) -> int:
        """The version in force; 0 before the first write."""
        names = self._names(f"{self.path}/versions")
        return max((int(n) for n in names if n.isdigit()), default=0)

    def _entries(self, version: int) -> DataFrame:
        schema = f"`{KEY}` string, {GENERATION} string, live boolean"
        if not version:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self._version_path(version))

    def read(self, sessions: Iterable[str] | None = None, version: int | None = None) -> DataFrame:
        """The rows of a version, by default of the one in force. Named sessions read only their
        own partitions, and no generation is listed in vain but those of writes that stopped.

        What later generations replaced is left out by a join with the list of replaced sessions,
        which is as long as sessions were written again since `drop_old`.
        """
        version = self.version() if version is None else version
        entries = self._entries(version)
        # One name per write that still has live rows or has rows not yet dropped.
        named = [row[0] for row in entries.select(GENERATION).distinct().collect()]
        if not named:
            return self.spark.createDataFrame([], self.schema)
        parted = T.StructType([*self.schema.fields]).add(GENERATION, T.StringType())
        rows = self.spark.read.schema(parted).parquet(self._data)
        rows = rows.where(F.col(GENERATION).isin(*named))
        if sessions is not None:
            rows = of_sessions(rows, sessions)
        replaced = entries.where("NOT live").select(
            F.col(KEY).alias("__key"), F.col(GENERATION).alias("__generation")
        )
        if len(replaced.take(1)):
            same = (F.col(KEY).eqNullSafe(F.col("__key"))) & (
                F.col(GENERATION) == F.col("__generation")
            )
            rows = rows.join(replaced, same, "left_anti")
        return rows.select(*self.schema.names)

    def replace(
        self,
        rows: DataFrame,
        order: list[str],
        sessions: DataFrame | None,
        version: int | None = None,
    ) -> int:
        """Put `rows` in the place of all rows of `sessions`, a frame of one column, or of the
        whole table, and return the new version. Sessions without rows are empty then. `rows` of
        other sessions than those must not be there.

        `version` is the one that `rows` were made from. Raises OtherWrite if it isn't in force.
        """
        version = self.version() if version is None else version
        generation = uuid.uuid4().hex
        into = f"{self._data}/{GENERATION}={generation}"
        in_order(rows.select(*self.schema.names), order).write.partitionBy(KEY).parquet(into)
        old = self._entries(version)
        if sessions is None:
            sessions = rows.select(KEY).unionByName(old.select(KEY))
        touched = sessions.toDF("__key").distinct()
        seen = F.col("__seen").isNotNull()
        replaced = old.join(
            touched.withColumn("__seen", F.lit(True)),
            F.col(KEY).eqNullSafe(F.col("__key")),
            "left",
        ).select(KEY, GENERATION, (F.col("live") & ~seen).alias("live"))
        new = touched.select(
            F.col("__key").alias(KEY), F.lit(generation).alias(GENERATION), F.lit(True).alias("live")
        )
        staged = f"{self.path}/staged-{generation}"
        replaced.unionByName(new).coalesce(1).write.parquet(staged)
        self._put_in_force(staged, version + 1)
        return version + 1

    def _put_in_force(self, staged: str, version: int) -> None:
        """One rename, which fails where the name is taken."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        source, files = self._hadoop(staged)
        target, _ = self._hadoop(self._version_path(version))
        files.mkdirs(target.getParent())
        options = self.spark.sparkContext._gateway.new_array(
            jvm.org.apache.hadoop.fs.Options.Rename, 0
        )
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), conf)
        try:
            context.rename(source, target, options)
        except Py4JJavaError as error:
            if files.exists(target):
                files.delete(source, True)
                raise OtherWrite(f"version {version} of {self.path} is there already") from error
            raise

    def drop_old(self) -> None:
        """Remove what no longer counts: replaced partitions, generations of writes that stopped,
        older versions. Not while others read or write; a write follows as any other."""
        version = self.version()
        if not version:
            return
        entries = self._entries(version)
        counts = entries.groupBy(GENERATION).agg(F.max("live").alias("live"))
        live = {row[0] for row in counts.where("live").select(GENERATION).collect()}
        # The list without what is removed comes first, so that no reader looks for it.
        kept = entries.where(F.col(GENERATION).isin(*live)) if live else entries.limit(0)
        staged = f"{self.path}/staged-{uuid.uuid4().hex}"
        kept.coalesce(1).write.parquet(staged)
        self._put_in_force(staged, version + 1)
        for name in self._names(self._data):
            if name.removeprefix(f"{GENERATION}=") not in live:
                self._delete(f"{self._data}/{name}")
        for name in self._names(f"{self.path}/versions"):
            if name.isdigit() and int(name) <= version:
                self._delete(self._version_path(int(name)))
        for name in self._names(self.path):
            if name.startswith("staged-"):
                self._delete(f"{self.path}/{name}")

    def _delete(self, path: str) -> None:
        folder, files = self._hadoop(path)
        files.delete(folder, True)
