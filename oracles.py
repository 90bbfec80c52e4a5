"""DuckDB SQL for every query, written the plain way: whole-group windows, all-pairs joins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from event_logs import (
    CLOCK,
    EVENT_COLUMNS,
    EVENTS,
    SESSION,
    UNNAMED_EVERY,
    USER_SESSION,
    clock_with_gaps,
    event_type_of,
    log_columns,
)
from logbraid.sources.registry import (
    EVENT_TS,
    KEY,
    MISSILE,
    NORMALIZED,
    PLANE_STATES,
    SEQUENCE,
    SOURCE_TABLE,
    SOURCES,
    SourceSpec,
    TargetSpec,
)

FIVE_MINUTES = "INTERVAL 5 MINUTE"
ONE_SECOND = "INTERVAL 1 SECOND"


def _list(columns, prefix: str = "") -> str:
    return ", ".join(prefix + c for c in columns)


def _clock(milliseconds: int) -> str:
    later = f"ts + INTERVAL {milliseconds} MILLISECOND" if milliseconds else "ts"
    return f"strftime({later}, '%H:%M:%S.%g')"


def _event_rows(session: str = SESSION) -> str:
    columns = {KEY: session, CLOCK: clock_with_gaps(_clock(0)), **EVENT_COLUMNS}
    return (
        "SELECT event_type AS source, ts, "
        + ", ".join(f"{sql} AS {name}" for name, sql in columns.items())
        + " FROM events"
    )


def _valid(clock: str) -> str:
    return f"CASE WHEN {clock} < '24' THEN {clock} END"


def _log(spec: SourceSpec, some_unnamed: bool = False) -> str:
    """A declared layout, normalized, and its clock as it was."""
    columns = log_columns(spec, _clock)
    if some_unnamed:
        columns[KEY] = f"CASE WHEN event_id % {UNNAMED_EVERY} <> 0 THEN {columns[KEY]} END"
    columns["rejected_clock"] = columns[spec.clock]
    columns[spec.clock] = _valid(f"({columns[spec.clock]})")
    return (
        "SELECT "
        + ", ".join(f"{sql} AS {spec.renames.get(c, c)}" for c, sql in columns.items())
        + f" FROM events WHERE event_type = '{event_type_of(spec)}'"
    )


def _day(clock: str, group: str) -> str:
    """`rows` -> with `previous` and `day`."""
    return f"""
        SELECT *, CAST(sum(CASE WHEN {clock} < previous THEN 1 ELSE 0 END) OVER (
            PARTITION BY {group} ORDER BY {SEQUENCE}, {clock} NULLS FIRST
            ROWS UNBOUNDED PRECEDING) AS BIGINT) AS day
        FROM (SELECT *, lag({clock}) OVER (
            PARTITION BY {group} ORDER BY {SEQUENCE}, {clock} NULLS FIRST) AS previous
            FROM rows)"""


def _unwrapped(rows: str, clock: str, group: str = KEY) -> str:
    return f"""
        SELECT * EXCLUDE (previous, day),
            CAST('1970-01-01 ' || {clock} AS TIMESTAMP) + to_days(CAST(day AS INTEGER)) AS {EVENT_TS}
        FROM (WITH rows AS ({rows}) {_day(clock, group)})"""


def _processed(spec: SourceSpec, *more: str, some_unnamed: bool = False) -> str:
    columns = [*spec.normalized_columns, *more, EVENT_TS]
    return (
        f"SELECT {_list(columns)}, '{spec.name}' AS {SOURCE_TABLE} "
        f"FROM ({_unwrapped(_log(spec, some_unnamed), spec.clock)})"
    )


def _collapsed(rows: str, columns: Sequence[str], keys: Sequence[str]) -> str:
    rest = [f"{c} ASC NULLS LAST" for c in columns if c not in (*keys, SEQUENCE)]
    return f"""
        SELECT {_list(columns)} FROM ({rows})
        QUALIFY row_number() OVER (PARTITION BY {_list(keys)}
            ORDER BY {", ".join([SEQUENCE + " DESC NULLS LAST", *rest])}) = 1"""


def _integrated(
    target: TargetSpec, processed: Mapping[str, str], tolerance: str, rejected: bool = False
) -> str:
    """The whole job over `processed` logs: spine per session, then per log the latest row in
    the band of each spine moment."""
    names = [s.name for s in target.sources]
    merged = {
        s.name: [c for c in target.columns if c in s.merge_columns] for s in target.sources
    }
    ctes = [f"p_{n} AS MATERIALIZED ({processed[n]})" for n in names]
    ctes += [
        f"c_{n} AS MATERIALIZED ("
        + _collapsed(
            f"SELECT * FROM p_{n} WHERE {EVENT_TS} IS NOT NULL", merged[n], [KEY, EVENT_TS]
        )
        + ")"
        for n in names
    ]
    counts = " UNION ALL ".join(
        f"SELECT {KEY}, '{n}' AS main, {i} AS place, count(*) AS n FROM p_{n} GROUP BY {KEY}"
        for i, n in enumerate(names)
    )
    ctes.append(
        f"mains AS (SELECT {KEY}, main FROM ({counts}) "
        f"QUALIFY row_number() OVER (PARTITION BY {KEY} ORDER BY n, place) = 1)"
    )

    def held(n: str) -> list[str]:
        return [c for c in merged[n] if not (rejected and c == EVENT_TS)]

    def as_target(n: str, prefix: str) -> str:
        types = {f.name: "BIGINT" if f.dataType.simpleString() == "bigint" else "VARCHAR" for f in target.schema}
        types[EVENT_TS] = "TIMESTAMP"
        types |= {f.name: "DOUBLE" for f in target.schema if f.dataType.simpleString() == "double"}
        return ", ".join(
            (f"{prefix}{c}" if c in held(n) else f"CAST(NULL AS {types[c]})") + f" AS {c}"
            for c in target.columns
            if c != SOURCE_TABLE
        )

    if rejected:
        clocks = {s.name: s.clock for s in target.sources}
        parts = [
            f"""SELECT {as_target(n, 'r.')}, '{n}' AS {SOURCE_TABLE}, r.rejected_clock,
            CASE WHEN r.{KEY} IS NULL THEN 'no session' WHEN r.rejected_clock IS NULL THEN 'no clock'
              WHEN r.{clocks[n]} IS NULL THEN 'malformed clock' ELSE 'day out of range' END AS reason
            FROM p_{n} r LEFT JOIN mains m ON m.{KEY} = r.{KEY}
            WHERE r.{KEY} IS NULL OR m.main = '{n}' AND r.{EVENT_TS} IS NULL"""
            for n in names
        ]
        return f"WITH {', '.join(ctes)} " + " UNION ALL ".join(parts)

    spine = " UNION ALL ".join(
        f"SELECT {as_target(n, 'c.')}, '{n}' AS {SOURCE_TABLE} FROM c_{n} c "
        f"JOIN mains m ON m.{KEY} = c.{KEY} AND m.main = '{n}'"
        for n in names
    )
    ctes.append(f"spine AS MATERIALIZED ({spine})")
    for n in names:
        ctes.append(
            f"""near_{n} AS (
            SELECT s.{KEY} AS k, s.{EVENT_TS} AS t, o.* FROM spine s JOIN c_{n} o
              ON o.{KEY} = s.{KEY} AND s.{SOURCE_TABLE} <> '{n}'
             AND o.{EVENT_TS} BETWEEN s.{EVENT_TS} - {tolerance} AND s.{EVENT_TS} + {tolerance}
            QUALIFY row_number() OVER (
                PARTITION BY s.{KEY}, s.{EVENT_TS} ORDER BY o.{EVENT_TS} DESC) = 1)"""
        )
    values = []
    for c in target.columns:
        if c in (KEY, EVENT_TS, SOURCE_TABLE):
            values.append(f"s.{c}")
        else:
            holders = [f"near_{n}.{c}" for n in names if c in merged[n]]
            values.append(f"coalesce({_list(['s.' + c, *holders])}) AS {c}")
    joins = " ".join(
        f"LEFT JOIN near_{n} ON near_{n}.k = s.{KEY} AND near_{n}.t = s.{EVENT_TS}" for n in names
    )
    return f"WITH {', '.join(ctes)} SELECT {', '.join(values)} FROM spine s {joins}"


def _events_processed(session: str = SESSION) -> dict[str, str]:
    rows = f"SELECT * REPLACE ({_valid(CLOCK)} AS {CLOCK}) FROM ({_event_rows(session)})"
    return {
        s.name: _unwrapped(
            f"SELECT {_list(s.columns)} FROM ({rows}) WHERE source = '{s.name}'", CLOCK
        )
        for s in EVENTS.sources
    }


def _logs_processed(target: TargetSpec, *more: str, some_unnamed: bool = False) -> dict[str, str]:
    return {s.name: _processed(s, *more, some_unnamed=some_unnamed) for s in target.sources}


_ROWS = f"SELECT * REPLACE ({_valid(CLOCK)} AS {CLOCK}) FROM ({_event_rows()})"
_COUNTS = f"SELECT {KEY}, source, count(*) AS n FROM ({_event_rows()}) GROUP BY ALL"
_PLACES = ", ".join(f"'{s.name}'" for s in EVENTS.sources)


def _band(source: str, columns: str) -> str:
    return f"(SELECT {KEY}, ts, {columns} FROM ({_event_rows()}) WHERE source = '{source}')"


def _in_band(left: str, right: str) -> str:
    return (
        f"{right}.{KEY} = {left}.{KEY} AND {right}.ts BETWEEN "
        f"{left}.ts - {FIVE_MINUTES} AND {left}.ts + {FIVE_MINUTES}"
    )


def _star(columns: str) -> str:
    return f"""
        SELECT {columns}
        FROM {_band("purchase", f"{SEQUENCE}, user_id, props, value")} p
        LEFT JOIN {_band("view", f"{SEQUENCE}, value")} v ON {_in_band("p", "v")}
        LEFT JOIN {_band("click", f"{SEQUENCE}, user_id, props")} c ON {_in_band("p", "c")}"""


def _upserted() -> str:
    """Old rows are the first three sessions' errors, new ones the last three's clicks."""
    def rows(source: str, first: str, last: str) -> str:
        return f"""
            SELECT {KEY}, date_trunc('hour', ts) AS {EVENT_TS}, max({SEQUENCE}) AS {SEQUENCE},
                   max({CLOCK}) AS {CLOCK}, max(user_id) AS user_id, max(value) AS value,
                   max(props) AS props, source AS {SOURCE_TABLE}
            FROM ({_event_rows()}) WHERE source = '{source}' AND {KEY} BETWEEN '{first}' AND '{last}'
            GROUP BY ALL"""

    return f"""
        WITH old AS ({rows("error", "S0", "S2")}), new AS ({rows("click", "S1", "S3")})
        SELECT * FROM new UNION ALL
        SELECT o.* FROM old o ANTI JOIN new n ON n.{KEY} = o.{KEY} AND n.{EVENT_TS} = o.{EVENT_TS}"""


def _ordered() -> str:
    return f"""
        SELECT {KEY}, {EVENT_TS}, {SEQUENCE}, {SOURCE_TABLE},
               row_number() OVER (ORDER BY {EVENT_TS}, {KEY}) AS rank
        FROM ({_integrated(EVENTS, _events_processed(), FIVE_MINUTES)})"""


def oracle_sql() -> dict[str, str]:
    ir_msl = SOURCES["ir_msl"]
    missing = [c for c in MISSILE.columns if c not in (*ir_msl.merge_columns, SOURCE_TABLE)]
    by_day = "source, event_date"
    return {
        "q_scan_filter_project": (
            "SELECT event_id, user_id, value FROM events WHERE event_type = 'purchase'"
        ),
        "q_rename": (
            "SELECT "
            + ", ".join(
                f"{sql} AS {SOURCES['ag_rtsn'].renames.get(c, c)}"
                for c, sql in log_columns(SOURCES["ag_rtsn"], _clock).items()
            )
            + f" FROM events WHERE event_type = '{event_type_of(SOURCES['ag_rtsn'])}'"
        ),
        "q_lag_clock": f"""
            WITH rows AS ({_ROWS})
            SELECT source, {KEY}, {SEQUENCE}, {CLOCK}, previous
            FROM ({_day(CLOCK, f"source, {KEY}")})""",
        "q_running_day_count": f"""
            WITH rows AS ({_ROWS})
            SELECT source, {KEY}, {SEQUENCE},
                   CAST(CASE WHEN {CLOCK} < previous THEN 1 ELSE 0 END AS INTEGER) AS wrapped, day
            FROM ({_day(CLOCK, f"source, {KEY}")})""",
        "q_clock_unwrap": f"""
            SELECT source AS {SOURCE_TABLE}, {KEY}, {SEQUENCE}, {CLOCK}, {EVENT_TS}
            FROM ({_unwrapped(_ROWS, CLOCK, f"source, {KEY}")})""",
        "q_count_nonempty": _COUNTS,
        "q_main_table": f"""
            SELECT {KEY}, source AS main FROM ({_COUNTS})
            QUALIFY row_number() OVER (
                PARTITION BY {KEY} ORDER BY n, list_position([{_PLACES}], source)) = 1""",
        "q_band_left_join": f"""
            SELECT p.{KEY}, p.ts, p.{SEQUENCE} AS purchase_id, v.{SEQUENCE} AS view_id
            FROM {_band("purchase", SEQUENCE)} p
            LEFT JOIN {_band("view", SEQUENCE)} v ON {_in_band("p", "v")}""",
        "q_star_band_join": _star(
            f"p.{KEY}, p.ts, p.{SEQUENCE} AS {SEQUENCE}, "
            f"v.{SEQUENCE} AS view__{SEQUENCE}, c.{SEQUENCE} AS click__{SEQUENCE}"
        ),
        "q_star_rows": f"SELECT {KEY}, count(*) AS rows FROM ({_star(f'p.{KEY}')}) GROUP BY {KEY}",
        "q_coalesce_merge": _star(
            f"p.{KEY}, p.ts, coalesce(p.{SEQUENCE}, v.{SEQUENCE}, c.{SEQUENCE}) AS {SEQUENCE}, "
            "coalesce(p.user_id, c.user_id) AS user_id, coalesce(p.props, c.props) AS props, "
            "coalesce(p.value, v.value) AS value"
        ),
        "q_fill_to_target": f"""
            SELECT {_list(ir_msl.merge_columns)}, '{ir_msl.name}' AS {SOURCE_TABLE},
                   {", ".join(f"CAST(NULL AS VARCHAR) AS {c}" for c in missing)}
            FROM ({_processed(ir_msl)})""",
        "q_collapse_to_key": f"""
            SELECT source, event_date, user_id, {KEY}, {CLOCK}, value, props
            FROM (SELECT *, CAST(ts AS DATE) AS event_date FROM ({_event_rows()}))
            QUALIFY row_number() OVER (PARTITION BY {by_day}
                ORDER BY user_id DESC NULLS LAST, {KEY} ASC NULLS LAST, {CLOCK} ASC NULLS LAST,
                value ASC NULLS LAST, props ASC NULLS LAST) = 1""",
        "q_split_valid": f"""
            SELECT source, {KEY}, {SEQUENCE}, {EVENT_TS}, {EVENT_TS} IS NOT NULL AS valid
            FROM ({_unwrapped(_ROWS, CLOCK, f"source, {KEY}")})""",
        "q_integrate_events": _integrated(EVENTS, _events_processed(), FIVE_MINUTES),
        "q_integrate_multi_sortie": _integrated(
            EVENTS, _events_processed(USER_SESSION), "INTERVAL 1 HOUR"
        ),
        "q_missile_integration": _integrated(MISSILE, _logs_processed(MISSILE), FIVE_MINUTES),
        "q_missile_one_second": _integrated(MISSILE, _logs_processed(MISSILE), ONE_SECOND),
        "q_missile_rejected": _integrated(
            MISSILE, _logs_processed(MISSILE, "rejected_clock"), FIVE_MINUTES, rejected=True
        ),
        "q_rejects_kept": _integrated(
            MISSILE,
            _logs_processed(MISSILE, "rejected_clock", some_unnamed=True),
            FIVE_MINUTES,
            rejected=True,
        ),
        "q_plane_state_integration": _integrated(
            PLANE_STATES, _logs_processed(PLANE_STATES), FIVE_MINUTES
        ),
        "q_integrate_in_steps": _integrated(
            PLANE_STATES, _logs_processed(PLANE_STATES), ONE_SECOND
        ),
        "q_upsert": _upserted(),
        "q_ordered_output": _ordered(),
        "q_unwrap_in_two_runs": _processed(SOURCES["aa_traj"]),
        "q_partitioned_landing": f"SELECT * EXCLUDE (rejected_clock) FROM ({_log(SOURCES['aa_traj'])})",
        **{f"q_processed_{s.name}": _processed(s) for s in NORMALIZED},
    }
