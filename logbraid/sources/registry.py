"""The table layouts: 33 source logs and 2 integrated targets.

Scans, renames, merge lists and target projections all derive from the values below.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from types import MappingProxyType

from pyspark.sql import types as T

KEY = "sortie_number"
SEQUENCE = "message_sequence_number"
EVENT_TS = "event_ts"
SOURCE_TABLE = "source_table"

# Which columns are not plain text. Times of day are text of one width.
TIMES_OF_DAY = ("message_time", "satellite_guidance_time", "local_time", "end_time")
COUNTERS = (SEQUENCE, "response_sequence_number", "response_message_sequence_number")


def column_type(name: str) -> T.DataType:
    if name in COUNTERS:
        return T.LongType()
    if name == EVENT_TS:
        return T.TimestampNTZType()
    return T.StringType()


def _schema(columns, types) -> T.StructType:
    return T.StructType([T.StructField(c, types.get(c, column_type(c))) for c in columns])


_NOTHING = MappingProxyType({})


@dataclass(frozen=True)
class SourceSpec:
    """One source log. `unmerged` columns are normalized but never reach a target; `types`
    holds column types other than by name."""

    name: str
    columns: tuple[str, ...]
    clock: str | None = None
    renames: Mapping[str, str] = field(default=_NOTHING, hash=False)
    unmerged: frozenset[str] = frozenset()
    types: Mapping[str, T.DataType] = field(default=_NOTHING, hash=False)

    @property
    def schema(self) -> T.StructType:
        return _schema(self.columns, self.types)

    @property
    def normalized_columns(self) -> tuple[str, ...]:
        return tuple(self.renames.get(c, c) for c in self.columns)

    @property
    def merge_columns(self) -> tuple[str, ...]:
        kept = (c for c in self.normalized_columns if c not in self.unmerged)
        return (*kept, EVENT_TS)


@dataclass(frozen=True)
class TargetSpec:
    """One integrated table, keyed by session and event time.

    The order of `sources` decides ties for the spine and which value wins after the spine's.
    """

    name: str
    columns: tuple[str, ...]
    sources: tuple[SourceSpec, ...]
    keys: tuple[str, ...] = (KEY, EVENT_TS)
    types: Mapping[str, T.DataType] = field(default=_NOTHING, hash=False)

    @property
    def schema(self) -> T.StructType:
        return _schema(self.columns, self.types)


# ---------------------------------------------------------------------------------------
# The table layouts, in declared column order.

_ENVELOPE = """
    message_time satellite_guidance_time local_time message_sequence_number
"""


def _log(name, body, sender="aircraft_id", clock="satellite_guidance_time", **more) -> SourceSpec:
    """A log whose rows start with the session, the sender and the four-column envelope."""
    columns = f"{KEY} {sender} {_ENVELOPE} {body}".split()
    return SourceSpec(name, tuple(columns), clock, **more)


def _table(name, columns, clock=None) -> SourceSpec:
    return SourceSpec(name, tuple(columns.split()), clock)


_AIR_TRAJECTORY = """
    weapon_id pylon_id weapon_type target_id longitude latitude altitude
    missile_target_distance missile_speed interception_status non_interception_reason
    seeker_azimuth seeker_elevation target_tspi_status command_machine_status
    ground_angle_satisfaction_flag zero_crossing_flag
"""

_ROUND_START = """
    target_id intercepted_weapon_id target_real_or_virtual weapon_id pylon_id weapon_type
    trajectory_type missile_attack_mode
"""

_ATTITUDE = """
    longitude latitude pressure_altitude roll pitch heading satellite_altitude
    training_status chaff afterburner north_velocity vertical_velocity east_velocity
"""

_FLIGHT_STATE = """
    true_angle_of_attack mach_number normal_load_factor indicated_airspeed field_elevation
    radio_altitude remaining_fuel
"""

AA_TRAJ = _log("aa_traj", _AIR_TRAJECTORY)

AG_RTSN = _log(
    "ag_rtsn",
    """
    weapon_id weapon_pylon_id weapon_type number_of_missiles_released aircraft_ground_speed
    aircraft_longitude aircraft_latitude aircraft_altitude aircraft_heading aircraft_pitch
    aircraft_roll aircraft_angle_of_attack aircraft_north_speed aircraft_vertical_speed
    aircraft_east_speed north_wind_speed vertical_wind_speed east_wind_speed
    target_longitude target_latitude target_altitude target_distance seeker_head_number
    target_coordinate_validity target_azimuth_elevation_validity target_elevation_angle
    target_azimuth_angle impact_angle_validity entry_angle impact_angle direction_validity
    """,
    renames=MappingProxyType(
        {
            "weapon_pylon_id": "pylon_id",
            "aircraft_longitude": "longitude",
            "aircraft_latitude": "latitude",
            "aircraft_altitude": "altitude",
            "aircraft_heading": "heading",
            "aircraft_pitch": "pitch",
            "aircraft_roll": "roll",
        }
    ),
    # The carrier's position is not the weapon's.
    unmerged=frozenset(
        """
        pylon_id longitude latitude altitude number_of_missiles_released
        target_azimuth_elevation_validity
        """.split()
    ),
)

AG_TRAJ = _log(
    "ag_traj",
    """
    weapon_id weapon_type longitude latitude altitude heading pitch north_speed sky_speed
    east_speed seeker_id interception_flag termination_flag intercepting_member_id
    intercepting_equipment_id intercepting_equipment_type launcher_id seeker_azimuth_center
    seeker_pitch_center target_id missile_target_distance
    """,
)

IR_MSL = _log("ir_msl", "seeker_azimuth seeker_elevation weapon_type interception_flag")

PL17_RTKN = _log(
    "pl17_rtkn",
    """
    weapon_id weapon_type target_id target_real_or_virtual hit_result miss_reason
    miss_distance matching_failure_reason jamming_effective jamming afterburner head_on
    heading pitch
    """,
)

PL17_RTSN = _log("pl17_rtsn", _ROUND_START)

PL17_TRAJ = _log(
    "pl17_traj",
    _AIR_TRAJECTORY
    + "distance_interception_flag speed_interception_flag angle_interception_flag",
)

RTSN = _log("rtsn", _ROUND_START)

RTKN = _log(
    "rtkn",
    """
    weapon_id weapon_type target_id intercepted_weapon_id hit_result miss_reason
    miss_distance matching_failure_reason
    ground_defense_equipment_type ground_defense_equipment_id
    ground_defense_equipment_type1 ground_defense_equipment_id1
    ground_defense_equipment_type2 ground_defense_equipment_id2
    ground_defense_equipment_type3 ground_defense_equipment_id3
    jamming_effective jamming afterburner head_on heading pitch
    """,
)

SA_TRAJ = _log(
    "sa_traj",
    """
    weapon_id pylon_id weapon_type target_id intercepted_weapon_id longitude latitude
    altitude missile_target_distance missile_speed interception_status
    non_interception_reason seeker_azimuth seeker_elevation target_tspi_status
    command_machine_status
    """,
)

CD_DRONE_PLANE_STATE = _log(
    "cd_drone_plane_state", _FLIGHT_STATE + "manual_respawn parameter_setting_status"
)

CD_DRONE_TSPI = _log(
    "cd_drone_tspi", _ATTITUDE + "delay_status", sender="aircraft_id aircraft_type"
)

COMMAND = _log("command", "command_type command_id command_content response_sequence_number")

PLANE_STATE = _log(
    "plane_state",
    _FLIGHT_STATE + "scenario manual_respawn parameter_setting_status encryption_status",
)

TSPI = _log("tspi", _ATTITUDE, sender="aircraft_id aircraft_type")

HJ_PLANE_DATA = _table(
    "hj_plane_data",
    """
    sortie_number batch_number device_number flight_control_number local_time message_time
    message_sequence_number longitude latitude altitude ground_speed vertical_speed heading
    """,
    clock="message_time",
)

MISSILE = TargetSpec(
    "missile_integration",
    tuple(
        """
        sortie_number event_ts aircraft_id message_time satellite_guidance_time local_time
        message_sequence_number weapon_id weapon_type target_id pylon_id longitude latitude
        altitude heading pitch roll missile_speed aircraft_ground_speed north_speed
        sky_speed east_speed north_wind_speed vertical_wind_speed east_wind_speed
        aircraft_north_speed aircraft_vertical_speed aircraft_east_speed
        missile_target_distance target_distance target_longitude target_latitude
        target_altitude target_elevation_angle target_azimuth_angle target_tspi_status
        target_real_or_virtual target_coordinate_validity intercepted_weapon_id
        seeker_azimuth seeker_elevation seeker_id seeker_head_number seeker_azimuth_center
        seeker_pitch_center interception_status interception_flag non_interception_reason
        hit_result miss_reason miss_distance matching_failure_reason termination_flag
        distance_interception_flag speed_interception_flag angle_interception_flag
        command_machine_status ground_angle_satisfaction_flag zero_crossing_flag
        aircraft_angle_of_attack impact_angle_validity entry_angle impact_angle
        direction_validity missile_attack_mode trajectory_type jamming_effective jamming
        afterburner head_on intercepting_member_id intercepting_equipment_id
        intercepting_equipment_type launcher_id ground_defense_equipment_type
        ground_defense_equipment_id source_table
        """.split()
    ),
    (
        AA_TRAJ,
        AG_RTSN,
        AG_TRAJ,
        IR_MSL,
        PL17_RTKN,
        PL17_RTSN,
        PL17_TRAJ,
        RTSN,
        RTKN,
        SA_TRAJ,
    ),
)

PLANE_STATES = TargetSpec(
    "plane_state_integration",
    tuple(
        """
        sortie_number event_ts aircraft_id aircraft_type message_time
        satellite_guidance_time local_time message_sequence_number longitude latitude
        pressure_altitude satellite_altitude roll pitch heading north_velocity
        vertical_velocity east_velocity indicated_airspeed true_angle_of_attack mach_number
        normal_load_factor field_elevation radio_altitude remaining_fuel training_status
        scenario manual_respawn parameter_setting_status encryption_status chaff
        afterburner command_type command_id command_content response_sequence_number
        delay_status source_table
        """.split()
    ),
    (CD_DRONE_PLANE_STATE, CD_DRONE_TSPI, COMMAND, PLANE_STATE, TSPI),
)

_ROSTER = """
    sortie_number aircraft_id aircraft_callsign aircraft_code_name red_blue_affiliation
    flight_batch
"""

# Tables no integration reads; they have a layout and nothing else.
SCHEMA_ONLY = (
    _log(
        "cmb_power",
        """
        available_missile_count available_target_channel_count training_mode
        allow_missile_reset auto_respawn
        """,
        sender="ground_defense_id",
    ),
    _log("eo_state", "working_mode power_status standby_status"),
    _table(
        "error_data",
        """
        sortie_number sender_id message_time local_time message_sequence_number message_id
        message_length error_message
        """,
    ),
    _log(
        "ews",
        """
        left_front_jamming right_front_jamming left_rear_jamming right_rear_jamming
        pod_forward_jamming pod_rearward_jamming
        """,
    ),
    _log(
        "ews_y8g",
        """
        x_band_jamming_elevation c_band_jamming_elevation c_band_jamming_azimuth
        s_band_jamming_elevation s_band_jamming_azimuth l_band_jamming_elevation
        l_band_jamming_azimuth u_band_jamming_azimuth jamming_status
        x_band_jamming_azimuth_angle
        """,
    ),
    _log(
        "ews_y9t",
        """
        jamming_azimuth jamming_frequency_count jamming_type jamming_band jamming_direction
        jamming_status jamming_elevation jamming_start_frequency jamming_end_frequency
        """,
    ),
    _log(
        "ews_yz8",
        """
        working_status omnidirectional_detection_q1 omnidirectional_detection_q2
        precise_direction_finding_j1 precise_direction_finding_j2
        precise_direction_finding_j3 high_gain_g1 high_gain_g2
        """,
    ),
    _log(
        "g_tspi",
        """
        camp_type equipment_type equipment_id status north_angle longitude latitude altitude
        decoy_position_id
        """,
        sender="ground_defense_id",
    ),
    _log(
        "ews_kj500",
        """
        azimuth_start_angle sector_reference sector_type sector_number action_code
        azimuth_end_angle
        """,
    ),
    _log("g_tspi_back", "response_message_sequence_number", sender="ground_defense_id"),
    _table(
        "hit_result",
        """
        sortie_number launcher_id target_id weapon_type weapon_id launch_time end_time
        hit_result
        """,
    ),
    _table("plane_pro", _ROSTER),
    _log("rdr_state", "working_mode air_sea_scan_ratio power_status emission_status"),
    _log(
        "sa_tgt",
        """
        equipment_type equipment_number target_azimuth target_elevation target_slant_range
        channel_number target_batch_number
        """,
        sender="ground_defense_id",
    ),
    _table("send_to_3d_data", _ROSTER),
    _log(
        "srd_state",
        """
        camp_type equipment_type equipment_number power_on emitter_frequency_band
        decoy_blink_period antenna_pointing
        """,
        sender="ground_defense_id",
    ),
    _log(
        "tgt",
        "target_count "
        + " ".join(
            f"identifier{n} sensor{n} pitch{n} azimuth{n} slant_range{n}" for n in range(1, 9)
        ),
    ),
)
# ---------------------------------------------------------------------------------------

# Sources with a clock to unwrap; HJ_PLANE_DATA feeds no target.
NORMALIZED = (*MISSILE.sources, *PLANE_STATES.sources, HJ_PLANE_DATA)

SOURCES = MappingProxyType({s.name: s for s in (*NORMALIZED, *SCHEMA_ONLY)})
TARGETS = MappingProxyType({t.name: t for t in (MISSILE, PLANE_STATES)})
