"""Keys, column lists and table schemas of the session data model."""

from __future__ import annotations

from pyspark.sql import types as T

SESSION_KEYS = ["year", "round_number", "session_type"]
DRIVER_KEYS = [*SESSION_KEYS, "DriverNumber"]
RACE_SESSION = "R"
CIRCUIT = "Meeting.Circuit.ShortName"
TARGET = "RacePosition"

# ---- fixed values: must equal the published data model -------------------
SESSION_TYPES = ["FP1", "FP2", "FP3", "Q", "SQ", "S", "R"]

TEAM_RENAMES = {
    "Scuderia AlphaTauri": "Racing Bulls",
    "AlphaTauri": "Racing Bulls",
    "RB": "Racing Bulls",
    "Alfa Romeo": "Kick Sauber",
    "Sauber": "Kick Sauber",
    "Racing Point": "Aston Martin",
    "Force India": "Aston Martin",
    "Renault": "Alpine",
}

STREET_CIRCUITS = [
    "Baku",
    "Jeddah",
    "Las Vegas",
    "Miami",
    "Monte Carlo",
    "Singapore",
    "Melbourne",
]

FINAL_FEATURES = [
    "GridPosition",
    "round_number",
    "TeamName",
    "Meeting.Circuit.ShortName",
    "DriverFinish_lag1",
    "DriverFinish_ewm",
    "TeamFinish_ewm",
    "DriverFinish_roll3_inseason",
    "TeamFinish_roll3_inseason",
    "LapStd_lag1",
]
CATEGORICAL_FEATURES = ["TeamName", "Meeting.Circuit.ShortName"]
NUMERIC_SCALE_FEATURES = [
    "GridPosition",
    "round_number",
    "DriverFinish_lag1",
    "DriverFinish_ewm",
    "TeamFinish_ewm",
    "DriverFinish_roll3_inseason",
    "TeamFinish_roll3_inseason",
    "LapStd_lag1",
]

# column, source table, known before the race, disposition
LEAKAGE_REGISTRY = [
    ("GridPosition", "session_results", "yes", "keep"),
    ("RacePosition", "session_results", "no", "target"),
    ("RaceTime", "session_results", "no", "drop"),
    ("ClassifiedPosition", "session_results", "no", "drop"),
    ("Points", "session_results", "no", "drop"),
    ("Laps", "session_results", "no", "drop"),
    ("Status", "session_results", "no", "drop"),
    ("LapTime_mean", "laps", "no", "drop_use_lag"),
    ("LapTime_std", "laps", "no", "drop_use_lag"),
    ("PitCount", "laps", "no", "drop"),
    ("RainRisk", "weather", "caveat", "keep_with_caveat"),
    ("TrackTemp", "weather", "caveat", "keep_with_caveat"),
    ("Humidity", "weather", "caveat", "keep_with_caveat"),
    ("Pressure", "weather", "caveat", "keep_with_caveat"),
    ("AirTemp", "weather", "caveat", "keep_with_caveat"),
    ("WindSpeed", "weather", "caveat", "keep_with_caveat"),
    ("TeamName", "driver_info", "yes", "keep"),
    ("Meeting.Circuit.ShortName", "session_info", "yes", "keep"),
    ("round_number", "calendar", "yes", "keep"),
    ("DriverFinish_lag1", "engineered", "lagged", "keep"),
    ("DriverFinish_ewm", "engineered", "lagged", "keep"),
    ("DriverFinish_roll3_inseason", "engineered", "lagged", "keep"),
    ("TeamFinish_ewm", "engineered", "lagged", "keep"),
    ("TeamFinish_roll3_inseason", "engineered", "lagged", "keep"),
    ("LapStd_lag1", "engineered", "lagged", "keep"),
]
# ---------------------------------------------------------------------------

ID_COLUMNS = ["year", "round_number", "DriverId", "DriverNumber"]
FEATURE_COLUMNS = list(dict.fromkeys([*ID_COLUMNS, *FINAL_FEATURES, TARGET]))

_TYPES = {
    "tiny": T.ByteType(),
    "short": T.ShortType(),
    "int": T.IntegerType(),
    "float": T.FloatType(),
    "seconds": T.DoubleType(),
    "time": T.TimestampNTZType(),
    "text": T.StringType(),
    "flag": T.BooleanType(),
}

# Column -> (kind, required) for each clean table, in output order.  A missing
# required column fails its table; a missing optional one becomes a typed null.
TABLE_COLUMNS: dict[str, dict[str, tuple[str, bool]]] = {
    "session_info": {
        "Meeting.Name": ("text", False),
        "Meeting.Country.Name": ("text", False),
        "Meeting.Circuit.ShortName": ("text", False),
        "Type": ("text", False),
        "StartDate": ("time", True),
        "EndDate": ("time", True),
        "GmtOffset": ("text", False),
    },
    "driver_info": {
        "DriverNumber": ("tiny", True),
        "BroadcastName": ("text", False),
        "FullName": ("text", False),
        "Abbreviation": ("text", False),
        "DriverId": ("text", False),
        "TeamName": ("text", False),
        "TeamColour": ("text", False),
        "FirstName": ("text", False),
        "LastName": ("text", False),
        "CountryCode": ("text", False),
    },
    "session_results": {
        "DriverNumber": ("tiny", True),
        "Abbreviation": ("text", False),
        "FullName": ("text", False),
        "TeamName": ("text", False),
        "GridPosition": ("float", True),
        "Position": ("float", True),
        "ClassifiedPosition": ("text", False),
        "Q1": ("seconds", False),
        "Q2": ("seconds", False),
        "Q3": ("seconds", False),
        "Time": ("seconds", False),
        "Status": ("text", False),
        "Points": ("float", True),
        "Laps": ("float", True),
    },
    "laps": {
        "Driver": ("text", False),
        "DriverNumber": ("tiny", True),
        "LapNumber": ("short", True),
        "Stint": ("tiny", True),
        "LapTime": ("seconds", False),
        "Sector1Time": ("seconds", False),
        "Sector2Time": ("seconds", False),
        "Sector3Time": ("seconds", False),
        "SpeedI1": ("float", False),
        "SpeedI2": ("float", False),
        "SpeedFL": ("float", False),
        "SpeedST": ("float", False),
        "PitOutTime": ("seconds", False),
        "PitInTime": ("seconds", False),
        "Compound": ("text", False),
        "TyreLife": ("short", True),
        "FreshTyre": ("flag", False),
        "Team": ("text", False),
        "LapStartDate": ("time", False),
        "TrackStatus": ("text", False),
        "Position": ("float", True),
        "IsAccurate": ("flag", False),
        "Deleted": ("flag", False),
    },
    "weather": {
        "Time": ("seconds", False),
        "AirTemp": ("float", False),
        "Humidity": ("float", False),
        "Pressure": ("float", False),
        "Rainfall": ("flag", False),
        "TrackTemp": ("float", False),
        "WindDirection": ("short", False),
        "WindSpeed": ("float", False),
    },
}

CORE_TABLES = ["session_info", "driver_info", "session_results", "laps"]
ALL_TABLES = [*CORE_TABLES, "weather"]

KEY_FIELDS = [
    T.StructField("year", T.IntegerType()),
    T.StructField("round_number", T.ByteType()),
    T.StructField("session_type", T.StringType()),
]
PARTITION_FIELDS = [
    T.StructField("round", T.IntegerType()),
    T.StructField("session", T.StringType()),
]


def spark_type(kind: str) -> T.DataType:
    return _TYPES[kind]


def table_schema(table: str, partitions: bool = False) -> T.StructType:
    """Schema of a clean table, with the path-only columns if ``partitions``."""
    body = [T.StructField(c, _TYPES[k]) for c, (k, _) in TABLE_COLUMNS[table].items()]
    return T.StructType([*body, *KEY_FIELDS, *(PARTITION_FIELDS if partitions else [])])


def quoted(name: str) -> str:
    """Backtick a column name; several contain dots."""
    return f"`{name}`"
