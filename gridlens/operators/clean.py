"""Projections, filters, masks and bounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridlens.operators.faults import with_active_events

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def cols_of_kind(df: DataFrame, kind: str) -> list[str]:
    """'numeric' (booleans excluded), 'categorical' (string/bool), 'datetime'."""
    out = []
    for f in df.schema.fields:
        t = f.dataType
        if kind == "numeric" and isinstance(t, NUMERIC):
            out.append(f.name)
        elif kind == "categorical" and isinstance(t, (T.StringType, T.BooleanType)):
            out.append(f.name)
        elif kind == "datetime" and isinstance(t, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            out.append(f.name)
    return out


def kind_of(t: T.DataType) -> str:
    if isinstance(t, T.BooleanType):
        return "bool"
    if isinstance(t, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "int"
    if isinstance(t, (T.FloatType, T.DoubleType, T.DecimalType)):
        return "float"
    if isinstance(t, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return "datetime"
    if isinstance(t, T.StringType):
        return "string"
    return t.simpleString()


def stringify(df: DataFrame, fmt: str = "yyyy-MM-dd HH:mm:ss") -> DataFrame:
    """every column as string; timestamps in a fixed format."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            cols.append(F.date_format(F.col(f.name), fmt).alias(f.name))
        else:
            cols.append(F.col(f.name).cast("string").alias(f.name))
    return df.select(*cols)


def filter_in(df: DataFrame, col: str, values: list) -> DataFrame:
    """value-set filter (pushed to the Parquet reader as an In filter)."""
    return df.where(F.col(col).isin(list(values)))


def mask_when(df: DataFrame, cond, cols: list[str], value: float = 0.0) -> DataFrame:
    """F8: set ``cols`` to ``value`` where ``cond`` holds."""
    return df.withColumns({c: F.when(cond, F.lit(value)).otherwise(F.col(c)) for c in cols})


#: Doubles from here on have no decimals to round.
WHOLE = float(1 << 52)


def half_up(x, decimals: int):
    """Half-up rounding that stays a double: nulls, NaN, infinities and large values are kept."""
    scale = float(10 ** decimals)
    return F.when(F.abs(x) * scale < WHOLE, F.floor(x * scale + 0.5).cast("double") / scale).otherwise(x)


def apply_bounds(df: DataFrame, bounds: dict) -> DataFrame:
    """clip each column to [lo, hi] (None = open), 'mod360' wraps angles,
    then keep ``decimals`` with half-up rounding.  bounds: col -> (lo, hi, decimals).
    A missing reading stays missing: null gives null and NaN gives NaN."""
    out = {}
    for c, (lo, hi, dec) in bounds.items():
        raw = x = F.col(c).cast("double")
        if lo == "mod360":
            x = F.pmod(x, F.lit(360.0))
        else:
            if lo is not None:
                x = F.greatest(F.lit(float(lo)), x)
            if hi is not None:
                x = F.least(F.lit(float(hi)), x)
        if dec is not None:
            x = half_up(x, dec)
        out[c] = F.when(raw.isNull() | F.isnan(raw), raw).otherwise(x)
    return df.withColumns(out)


def bounds_report(df: DataFrame, bounds: dict) -> DataFrame:
    """rows below / above the bounds per column, one pass, long form."""
    aggs = []
    for c, (lo, hi, _dec) in bounds.items():
        if lo == "mod360":
            below = (F.col(c) < 0)
            above = (F.col(c) >= 360)
        else:
            below = (F.col(c) < lo) if lo is not None else F.lit(False)
            above = (F.col(c) > hi) if hi is not None else F.lit(False)
        aggs += [F.count_if(below).alias(f"{c}__below"), F.count_if(above).alias(f"{c}__above"),
                 F.count(F.col(c)).alias(f"{c}__n")]
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{c}', `{c}__below`, `{c}__above`, `{c}__n`" for c in bounds)
    return wide.selectExpr(f"stack({len(bounds)}, {stack}) AS (column_name, n_below, n_above, n_rows)")


def apply_outages(tel: DataFrame, events: DataFrame, cols: list[str], device: str = "device",
                  time: str = "time", key: str | None = None, **join_kw) -> DataFrame:
    """zero ``cols`` on rows inside a 'downtime' window; adds ``in_outage``.

    Each row meets the outage windows of its device once (broadcast when the
    size check passes): one scan, no duplicates when outages overlap.
    """
    out = events.where(F.col("event_type") == "downtime")
    j = with_active_events(tel, out, device, time, need="any", **join_kw).withColumn("in_outage", (F.size("_active") > 0).cast("int"))
    return mask_when(j.drop("_active"), F.col("in_outage") == 1, cols)


# --- bounds tables ------------------------------------------------------------------
# Fixed values that must equal the reference: per column (low, high, decimals);
# None = open side, "mod360" = wrap the angle into [0, 360).
SOLAR_BOUNDS = {
    "active_power": (0.0, 4400.0, 2), "irradiance": (0.0, 1250.0, 2), "clear_sky_irradiance": (0.0, 1250.0, 2),
    "ambient_temp": (-20.0, 55.0, 2), "module_temp": (-20.0, 95.0, 2), "inverter_temp": (-20.0, 100.0, 2),
    "dc_voltage": (0.0, 950.0, 2), "dc_current": (0.0, 12.0, 3), "ac_voltage": (0.0, 460.0, 2),
    "ac_current": (0.0, 8.0, 3), "performance_ratio": (0.0, 1.05, 4), "cloud_cover": (0.0, 1.0, 3),
    "sun_elevation": (-90.0, 90.0, 2), "sun_azimuth": ("mod360", None, 2), "day_length_hours": (0.0, 24.0, 2),
}
# Solar night mask: these columns are 0 when sun elevation <= 0.5 deg or irradiance <= 0.5.
SOLAR_NIGHT_COLS = ["active_power", "irradiance", "dc_voltage", "dc_current", "ac_voltage", "ac_current",
                    "performance_ratio"]
WIND_BOUNDS = {
    "active_power": (0.0, None, 2), "wind_speed": (0.0, 30.0, 2), "air_density": (1.10, 1.35, 4),
    "wind_direction": ("mod360", None, 2), "nacelle_direction": ("mod360", None, 2),
    "nacelle_position": ("mod360", None, 2), "ambient_temp": (None, None, 2), "rotor_speed": (0.0, 22.0, 2),
    "generator_speed": (0.0, 2200.0, 2), "gearbox_oil_temp": (-20.0, 120.0, 2), "generator_temp": (-20.0, 140.0, 2),
    "bearing_temp": (-20.0, 120.0, 2), "converter_temp": (-20.0, 120.0, 2), "pitch_blade_angle_1": (0.0, 90.0, 2),
    "pitch_blade_angle_2": (0.0, 90.0, 2), "pitch_blade_angle_3": (0.0, 90.0, 2),
}
PUMP_BOUNDS = {
    "speed_rpm": (0.0, 1800.0, 1), "flow_m3h": (0.0, 240.0, 2), "differential_head_m": (0.0, 80.0, 2),
    "suction_abs_pressure_bar": (0.8, 3.0, 3), "discharge_pressure_bar": (0.8, 10.0, 3),
    "ambient_temp_c": (0.0, 50.0, 2), "fluid_temp_c": (0.0, 80.0, 2), "fluid_density_kgm3": (960.0, 1001.0, 2),
    "efficiency": (0.30, 0.90, 4), "hydraulic_power_kw": (0.0, 40.0, 3), "shaft_power_kw": (0.0, 55.0, 3),
    "motor_power_kw": (0.0, 60.0, 3), "motor_current_a": (0.0, 120.0, 3), "vibration_mm_s": (0.0, 20.0, 3),
    "bearing_temp_c": (0.0, 120.0, 2), "npsha_m": (-10.0, 30.0, 3), "npshr_m": (0.0, 15.0, 3),
    "cavitation_margin_m": (-15.0, 25.0, 3),
}


def bound_sql(col: str, lo, hi, dec) -> str:
    """Oracle twin of :func:`apply_bounds` for one column."""
    raw = x = f"CAST({col} AS DOUBLE)"
    if lo == "mod360":   # Spark's pmod: r = x % n; r < 0 -> (r + n) % n
        x = f"(CASE WHEN ({x} % 360.0) < 0 THEN (({x} % 360.0) + 360.0) % 360.0 ELSE {x} % 360.0 END)"
    else:
        if lo is not None:
            x = f"greatest({lo!r}, {x})"
        if hi is not None:
            x = f"least({hi!r}, {x})"
    if dec is not None:
        s = f"{float(10 ** dec):.1f}"
        x = f"CASE WHEN abs({x}) * {s} < {WHOLE!r} THEN CAST(floor({x} * {s} + 0.5) / {s} AS DOUBLE) ELSE {x} END"
    return f"CASE WHEN {raw} IS NULL OR isnan({raw}) THEN {raw} ELSE {x} END"


def finish_table(df: DataFrame, bounds: dict, night_cols: list[str] | None = None) -> DataFrame:
    """F8 + F6 as the last step of a telemetry table: optional night mask,
    then clip and round every column that has a bound."""
    if night_cols:
        night = (F.col("sun_elevation") <= 0.5) | (F.col("irradiance") <= 0.5)
        df = mask_when(df, night, [c for c in night_cols if c in df.columns])
    return apply_bounds(df, {c: b for c, b in bounds.items() if c in df.columns})
