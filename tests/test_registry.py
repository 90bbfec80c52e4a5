from __future__ import annotations

import pytest

from logbraid.sources.registry import (
    EVENT_TS,
    KEY,
    MISSILE,
    NORMALIZED,
    PLANE_STATES,
    SEQUENCE,
    SOURCE_TABLE,
    SOURCES,
    TARGETS,
)

MERGED = {
    "aa_traj": 24, "ag_rtsn": 32, "ag_traj": 28, "ir_msl": 11, "pl17_rtkn": 21,
    "pl17_rtsn": 15, "pl17_traj": 27, "rtsn": 15, "rtkn": 29, "sa_traj": 23,
    "cd_drone_plane_state": 16, "cd_drone_tspi": 22, "command": 11, "plane_state": 18,
    "tspi": 21,
}


def test_sizes():
    assert len(SOURCES) == 33
    assert {t.name: len(t.columns) for t in TARGETS.values()} == {
        "missile_integration": 77,
        "plane_state_integration": 38,
    }
    assert len(SOURCES["tgt"].columns) == 47


@pytest.mark.parametrize("name,size", MERGED.items())
def test_merge_lists(name, size):
    spec = SOURCES[name]
    assert len(spec.merge_columns) == size
    assert set(spec.merge_columns) <= {*spec.normalized_columns, EVENT_TS}


@pytest.mark.parametrize("spec", SOURCES.values(), ids=lambda s: s.name)
def test_columns_are_distinct(spec):
    assert len(set(spec.normalized_columns)) == len(spec.columns)


@pytest.mark.parametrize("target", [MISSILE, PLANE_STATES], ids=lambda t: t.name)
def test_every_target_column_has_a_source(target):
    supplied = {c for s in target.sources for c in s.merge_columns}
    assert set(target.columns) - {SOURCE_TABLE} <= supplied
    assert target.columns[0] == KEY and target.columns[-1] == SOURCE_TABLE


def test_dropped_on_the_way_to_the_target():
    dropped = {c for s in MISSILE.sources for c in s.merge_columns} - set(MISSILE.columns)
    assert dropped == {f"ground_defense_equipment_{k}{n}" for k in ("type", "id") for n in (1, 2, 3)}


def test_types_and_clocks():
    schema = SOURCES["command"].schema
    assert schema["response_sequence_number"].dataType.simpleString() == "bigint"
    assert schema["message_time"].dataType.simpleString() == "string"
    assert MISSILE.schema[EVENT_TS].dataType.simpleString() == "timestamp_ntz"
    assert SOURCES["hj_plane_data"].clock == "message_time"
    assert all(s.clock in s.columns and SEQUENCE in s.columns for s in NORMALIZED)
