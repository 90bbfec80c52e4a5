"""Database tables as sources and sinks, through Spark's own JDBC format.

The driver's jar must be on the session's class path.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logbraid.functions.lineage import materialize
from logbraid.operators.normalize import of_sessions
from logbraid.sources.registry import KEY, SEQUENCE, TIMES_OF_DAY, TargetSpec

# The columns that staged rows have beside the target's, and those of the table of
# runs whose rows are all there.
RUN, PART = "run_id", "part_id"
FINISHED = "finished_at"
# Rows that one task of a scan should read.
ROWS_PER_TASK = 1_000_000


@dataclass(frozen=True)
class Connection:
    """Where a database is. Nothing here is a default: deployments bring their own."""

    url: str
    driver: str
    user: str
    password: str = field(repr=False)
    timeout_seconds: int = 0

    def options(self) -> dict[str, str]:
        return {
            "url": self.url,
            "driver": self.driver,
            "user": self.user,
            "password": self.password,
            "queryTimeout": str(self.timeout_seconds),
        }


@dataclass(frozen=True)
class Split:
    """How a scan is cut into tasks: `parts` ranges of `column` from `lower` to `upper`.

    The bounds only place the cuts; rows outside them are read all the same.
    """

    lower: int
    upper: int
    parts: int
    column: str = SEQUENCE

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": str(self.lower),
            "upperBound": str(self.upper),
            "numPartitions": str(self.parts),
        }


@dataclass(frozen=True)
class Sink:
    """Batched writing. Fixed value: the batch size. Failed tasks are retried by Spark
    (`spark.task.maxFailures`), so rows arrive at least once."""

    batch_size: int = 1000

    def options(self) -> dict[str, str]:
        return {"batchsize": str(self.batch_size), "isolationLevel": "READ_COMMITTED"}


def read_options(connection: Connection, table: str, split: Split) -> dict[str, str]:
    return {**connection.options(), "dbtable": table, **split.options()}


def write_options(connection: Connection, table: str, sink: Sink = Sink()) -> dict[str, str]:
    return {**connection.options(), "dbtable": table, **sink.options()}


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


@dataclass(frozen=True)
class Extent:
    """What a table holds of a session: its number of rows, the least and the highest sequence
    number, both None where no row has one."""

    session: str
    rows: int
    least: int | None = None
    highest: int | None = None


def extents_query(table: str, sessions: Iterable[str] | None = None) -> str:
    """The statement by which the database tells the extent of each session."""
    named = None if sessions is None else list(dict.fromkeys(sessions))
    where = f"{KEY} IS NOT NULL" if named is None else f"{KEY} IN ({', '.join(map(_text, named))})"
    return (
        f"SELECT {KEY}, COUNT(*) AS n, MIN({SEQUENCE}) AS least, MAX({SEQUENCE}) AS highest "
        f"FROM {table} WHERE {where} GROUP BY {KEY}"
    )


def extents(
    spark: SparkSession,
    connection: Connection,
    table: str,
    sessions: Iterable[str] | None = None,
) -> list[Extent]:
    """One row per session, as many as the scan's least number of conditions."""
    if sessions is not None and not (sessions := list(sessions)):
        return []
    options = {**connection.options(), "query": extents_query(table, sessions)}
    rows = spark.read.format("jdbc").options(**options).load().collect()
    return [Extent(r[0], int(r[1]), *(None if x is None else int(x) for x in r[2:])) for r in rows]


def scan_predicates(held: Sequence[Extent], rows_per_task: int = ROWS_PER_TASK) -> list[str]:
    """SQL conditions, each read by one task, that every row of the sessions meets exactly one of.

    A large session is cut into ranges of its sequence numbers, as many as its rows ask for, which
    hold alike where numbers are dense; rows without a number are in its first range. Small
    sessions are put together. So no task reads much more than `rows_per_task`, unless many rows
    share a range, and a session's size alone decides in how many tasks it is read.
    """
    out: list[str] = []
    together: list[str] = []
    size = 0

    def close() -> None:
        nonlocal size
        if together:
            names = ", ".join(map(_text, together))
            out.append(f"{KEY} = {names}" if len(together) == 1 else f"{KEY} IN ({names})")
        together.clear()
        size = 0

    for extent in sorted(held, key=lambda e: (e.rows, e.session)):
        cuts = _cuts(extent, rows_per_task)
        if not cuts:
            if size + extent.rows > rows_per_task:
                close()
            together.append(extent.session)
            size += extent.rows
            continue
        mine = f"{KEY} = {_text(extent.session)}"
        out.append(f"{mine} AND ({SEQUENCE} < {cuts[0]} OR {SEQUENCE} IS NULL)")
        out += [
            f"{mine} AND {SEQUENCE} >= {low} AND {SEQUENCE} < {high}"
            for low, high in zip(cuts, cuts[1:])
        ]
        out.append(f"{mine} AND {SEQUENCE} >= {cuts[-1]}")
    close()
    return out


def _cuts(extent: Extent, rows_per_task: int) -> list[int]:
    """Sequence numbers at which ranges of like width begin, but for the first range."""
    parts = -(-extent.rows // rows_per_task)
    if parts < 2 or extent.least is None:
        return []
    width = extent.highest - extent.least + 1
    cuts = (extent.least + width * k // parts for k in range(1, parts))
    return [c for c in dict.fromkeys(cuts) if c > extent.least]


def read_table(
    spark: SparkSession,
    connection: Connection,
    table: str,
    sessions: Iterable[str] | None = None,
    split: Split | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """A database table, cut into tasks by `split`, or else by what the database says it holds of
    the named sessions, or of all.

    The session filter and the column choice run in the database. Rows that come in between the
    question and the scan are read where they meet its conditions; sessions that do are not.
    """
    sessions = None if sessions is None else list(sessions)
    if split is not None:
        df = spark.read.format("jdbc").options(**read_options(connection, table, split)).load()
        return clocks_as_text(df if sessions is None else of_sessions(df, sessions))
    predicates = scan_predicates(extents(spark, connection, table, sessions), rows_per_task)
    properties = {k: v for k, v in connection.options().items() if k != "url"}
    # Without a condition Spark would read the whole table; no session, no row.
    df = spark.read.jdbc(
        connection.url, table, predicates=predicates or ["1 = 0"], properties=properties
    )
    return clocks_as_text(df)


def clocks_as_text(df: DataFrame) -> DataFrame:
    """Times of day in the text form; the format hands them over as timestamps on some day."""
    stamped = (T.TimestampType, T.TimestampNTZType)
    return df.withColumns(
        {
            f.name: F.date_format(f.name, "HH:mm:ss.SSS")
            for f in df.schema
            if f.name in TIMES_OF_DAY and isinstance(f.dataType, stamped)
        }
    )


def write_table(df: DataFrame, connection: Connection, table: str, sink: Sink = Sink()) -> None:
    """Append to a database table. A second run meets the table's key; see `write_staged`."""
    df.write.format("jdbc").options(**write_options(connection, table, sink)).mode("append").save()


def staged(df: DataFrame, run: str) -> DataFrame:
    """`df` with the run it is of and the part that wrote each row. A task that is run again, or
    twice at a time, writes rows alike in all columns, as `df` is read from a table."""
    return df.withColumn(RUN, F.lit(run)).withColumn(PART, F.spark_partition_id())


def newest_whole_run(runs: str) -> str:
    """The id of the last run whose rows are all in staging; NULL if there is none."""
    return f"SELECT {RUN} FROM {runs} ORDER BY {FINISHED} DESC, {RUN} DESC LIMIT 1"


def staged_rows(columns: Sequence[str], keys: Sequence[str], staging: str, runs: str) -> str:
    """The rows of the newest whole run, each key once, however often tasks were run."""
    named, order = ", ".join(columns), ", ".join([PART, *(c for c in columns if c not in keys)])
    return (
        f"SELECT {named} FROM (SELECT {named}, ROW_NUMBER() OVER "
        f"(PARTITION BY {', '.join(keys)} ORDER BY {order}) AS copy "
        f"FROM {staging} WHERE {RUN} = ({newest_whole_run(runs)})) AS staged WHERE copy = 1"
    )


def merge_statement(target: TargetSpec, table: str, staging: str, runs: str) -> str:
    """Puts the newest whole run into the keyed `table`, in the wording of the reference's kind of
    database. Run twice, or after a run that stopped, it changes nothing more."""
    others = [c for c in target.columns if c not in target.keys]
    rows = staged_rows(target.columns, target.keys, staging, runs)
    return (
        f"INSERT INTO {table} ({', '.join(target.columns)}) {rows} "
        f"ON DUPLICATE KEY UPDATE {', '.join(f'{c} = VALUES({c})' for c in others)}"
    )


def finish_statement(runs: str, run: str) -> str:
    return f"INSERT INTO {runs} ({RUN}, {FINISHED}) VALUES ({_text(run)}, CURRENT_TIMESTAMP)"


def clear_statement(staging: str, runs: str) -> str:
    """Takes out of staging all but the newest whole run."""
    return f"DELETE FROM {staging} WHERE {RUN} <> ({newest_whole_run(runs)})"


def write_staged(
    df: DataFrame,
    connection: Connection,
    staging: str,
    merge: str,
    sink: Sink = Sink(),
    run: str | None = None,
) -> str:
    """Add `df` to the table `staging` as a run of its own, say in `<staging>_runs` that it is
    whole, and run the statement `merge`, as from `merge_statement`. Returns the run's id.

    Rows may arrive in staging more than once, as tasks are run again, and runs that stopped leave
    some of theirs. Neither gets into the target: only a run whose tasks have all ended is named
    as whole, and the merge takes each key of the newest of those once.

    Tasks write the rows; the driver only has the database run the statements. One writer at a
    time: the last statement clears other runs' rows out of staging.
    """
    run = run or uuid.uuid4().hex
    rows = staged(materialize(df, "staged"), run)
    rows.write.format("jdbc").options(**write_options(connection, staging, sink)).mode("append").save()
    runs = f"{staging}_runs"
    _execute(
        df.sparkSession,
        connection,
        [finish_statement(runs, run), merge, clear_statement(staging, runs)],
    )
    return run


def _execute(spark: SparkSession, connection: Connection, statements: Sequence[str]) -> None:
    jvm = spark._jvm
    jvm.java.lang.Class.forName(connection.driver)
    database = jvm.java.sql.DriverManager.getConnection(
        connection.url, connection.user, connection.password
    )
    try:
        statement = database.createStatement()
        statement.setQueryTimeout(connection.timeout_seconds)
        for text in statements:
            statement.executeUpdate(text)
    finally:
        database.close()
