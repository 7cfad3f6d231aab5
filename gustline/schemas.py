"""Relations, names and thresholds shared by the batch and the streaming side."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values: field names, signal keys, thresholds and labels of the data model -------------

TIME_FIELD = "Date/Time"

# raw field -> key of the same signal inside a reading's map
SIGNAL_OF_FIELD = {
    "LV ActivePower (kW)": "ActivePower_kW",
    "Wind Speed (m/s)": "WindSpeed_m_s",
    "Theoretical_Power_Curve (KWh)": "PowerCurve_kWh",
    "Wind Direction (°)": "WindDirection_deg",
}

# names the hourly averages of typed (row-level) signals get
TYPED_AVERAGES = {
    "LV ActivePower (kW)": "avg_active_power",
    "Wind Speed (m/s)": "avg_wind_speed",
    "Theoretical_Power_Curve (KWh)": "avg_theo_power",
    "Wind Direction (°)": "avg_wind_direction",
}

# renaming of the hourly frame
HOURLY_MAPPING = (
    ("avg_ActivePower_kW", "active_power_average"),
    ("avg_WindSpeed_m_s", "wind_speed_average"),
    ("avg_PowerCurve_kWh", "theo_power_curve_average"),
    ("avg_WindDirection_deg", "wind_direction_average"),
    ("generation_indicator", "generation_status"),
)

# renaming of the row-level frame
ROW_MAPPING = (
    ("LV ActivePower (kW)", "active_power_average"),
    ("Wind Speed (m/s)", "wind_speed_average"),
    ("Theoretical_Power_Curve (KWh)", "theo_power_curve_average"),
    ("Wind Direction (°)", "wind_direction_average"),
)

# (exclusive upper bound, label), ascending; everything else is BAND_REST
BANDS = ((200.0, "Low"), (600.0, "Medium"), (1000.0, "High"))
BAND_REST = "Exceptional"

LABEL = "active_power_average"
STATUS = "generation_status"
STATUS_INDEX = "generation_status_index"
FEATURES = (
    "wind_speed_average",
    "theo_power_curve_average",
    "wind_direction_average",
    STATUS_INDEX,
)

# --- Derived from the names above ----------------------------------------------------------------

SIGNAL_KEYS = tuple(SIGNAL_OF_FIELD.values())
POWER_KEY = SIGNAL_OF_FIELD["LV ActivePower (kW)"]


def _flat(fields: dict[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


CSV_SCHEMA = _flat({TIME_FIELD: T.StringType()} | dict.fromkeys(SIGNAL_OF_FIELD, T.DoubleType()))

# a message is read back as text only, so a number keeps the digits it was sent with
MESSAGE_SCHEMA = _flat(dict.fromkeys((TIME_FIELD, *SIGNAL_OF_FIELD), T.StringType()))

READING_SCHEMA = _flat(
    {
        "signal_date": T.DateType(),
        "signal_ts": T.TimestampType(),
        "create_date": T.DateType(),
        "create_ts": T.TimestampType(),
        "signals": T.MapType(T.StringType(), T.StringType()),
    }
)

MAPPING_SCHEMA = _flat({"sig_name": T.StringType(), "sig_mapping_name": T.StringType()})

REPORT_SCHEMA = _flat(
    {"position": T.IntegerType(), "name": T.StringType(), "type": T.StringType(), "nullable": T.BooleanType()}
)

LINE_SCHEMA = _flat({"slope": T.DoubleType(), "intercept": T.DoubleType()})

TOPIC_SCHEMA = _flat({"value": T.StringType()})

TOTALS_SCHEMA = _flat({"batch": T.LongType(), "rows": T.LongType()})

HOURLY_SCHEMA = _flat(
    {"signal_date": T.DateType(), "hour": T.IntegerType()}
    | {new: T.DoubleType() for old, new in HOURLY_MAPPING if old.startswith("avg_")}
    | {STATUS: T.StringType()}
)
