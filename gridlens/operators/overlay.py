"""Fault overlays on existing telemetry / sample tables.

An overlay takes a healthy table plus per-row fault severities (one column
``sev_<type>`` per fault type, from the interval join of a fault-event
table, or from a per-row assignment) and rewrites the affected signals.
Effects are ordered assignment lists in SQL text, applied in event order;
later effects read what earlier ones changed (quirk Q10).

``outside_window``: ``'none'`` (default) changes a row only where that
fault's severity is > 0, so effects and labels agree; ``'reference'``
applies the effect to every row of the table, reproducing the reference's
whole-table base losses (quirk Q21).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlens.functions import physics as PH
from gridlens.operators.faults import active_severities, with_active_events
from gridlens.operators.scoring import with_exprs, chain_sql

# Each effect: list of (column, SQL expression); ``{s}`` is the severity
# column, ``{P}`` the power-curve expression of the table.  Columns whose
# name starts with '_' are temporaries and always computed.  The numbers are
# fixed values that must equal the reference's fault effects.
SOLAR_EFFECTS = {
    "soiling": [
        ("_sun", "least(greatest(irradiance / 9e2, 0e0), 1e0)"),
        ("_f", "1e0 - (3e-2 + 1.4e-1 * {s}) * _sun"),
        ("irradiance", "irradiance * _f"),
        ("active_power", "{P}"),
        ("module_temp", "module_temp + 1.2e0 * {s} * _sun"),
        ("performance_ratio", "performance_ratio * least(greatest(_f, 0e0), 1e0)"),
    ],
    "inverter_overheat": [
        ("active_power", "CASE WHEN {s} >= 7e-1 THEN 0e0 ELSE active_power * (1e0 - 2.2e-1 * {s}) END"),
        ("dc_current", "CASE WHEN {s} >= 7e-1 THEN 0e0 ELSE dc_current END"),
        ("ac_current", "CASE WHEN {s} >= 7e-1 THEN 0e0 ELSE ac_current END"),
        ("ac_voltage", "CASE WHEN {s} >= 7e-1 THEN 0e0 ELSE ac_voltage END"),
        ("performance_ratio", "CASE WHEN {s} >= 7e-1 THEN 0e0 ELSE performance_ratio END"),
        ("inverter_temp", "inverter_temp + 1e1 * {s}"),
    ],
    "tracker_stuck": [
        ("_sh", "least(greatest(abs(hour_f - 1.2e1) / 5e0, 0e0), 1e0)"),
        ("_sun", "least(greatest(sun_elevation / 4.5e1, 0e0), 1e0)"),
        ("_f", "least(greatest(1e0 - (5e-2 + 3.2e-1 * {s} * _sh * (1.15e0 - 3.5e-1 * _sun)), 5.5e-1), 1e0)"),
        ("irradiance", "irradiance * _f"),
        ("active_power", "{P}"),
        ("module_temp", "module_temp + 6e-1 * {s} * _sh"),
        ("performance_ratio", "performance_ratio * _f"),
    ],
    "dc_string_outage": [
        ("_f", "1e0 - (1e-1 + 2.2e-1 * {s})"),
        ("active_power", "active_power * _f"),
        ("dc_current", "dc_current * _f"),
        ("performance_ratio", "performance_ratio * _f"),
        ("dc_voltage", "dc_voltage * (1e0 - 3e-2 * {s})"),
        ("inverter_temp", "inverter_temp + {s}"),
    ],
    "downtime": [(c, "0e0") for c in ("active_power", "dc_current", "ac_current", "ac_voltage", "performance_ratio")],
}

_RECOMPUTE_WIND = "least(active_power, raw_power * density_factor * {ye} * {pe})"
WIND_EFFECTS = {
    "temperature": [
        ("gearbox_oil_temp", "gearbox_oil_temp + 1e1 * {s}"),
        ("generator_temp", "generator_temp + 1.6e1 * {s}"),
        ("bearing_temp", "bearing_temp + 8e0 * {s}"),
        ("converter_temp", "converter_temp + 6e0 * {s}"),
        ("active_power", "active_power * (1e0 - 5e-2 * greatest({s} - 7e-1, 0e0))"),
    ],
    "pitch_misalignment": [
        ("pitch_blade_angle_2", "least(greatest(pitch_blade_angle_2 + {s}, 0e0), 9e1)"),
        ("pitch_blade_angle_3", "least(greatest(pitch_blade_angle_3 - 4e-1 * {s}, 0e0), 9e1)"),
        ("_spread", PH.pitch_spread("pitch_blade_angle_1", "pitch_blade_angle_2", "pitch_blade_angle_3")),
        ("active_power", _RECOMPUTE_WIND.format(ye=PH.yaw_efficiency("yaw_error"), pe=PH.pitch_efficiency("_spread"))),
        ("bearing_temp", "bearing_temp + 1.2e-1 * _spread"),
        ("gearbox_oil_temp", "gearbox_oil_temp + 5e-2 * _spread"),
    ],
    "yaw_misalignment": [
        ("nacelle_direction", "(((nacelle_direction + {s}) % 360e0) + 360e0) % 360e0"),
        ("nacelle_position", "(((nacelle_position + {s}) % 360e0) + 360e0) % 360e0"),
        ("yaw_error", "abs((((wind_direction - nacelle_direction + 180e0) % 360e0) + 360e0) % 360e0 - 180e0)"),
        ("_spread", PH.pitch_spread("pitch_blade_angle_1", "pitch_blade_angle_2", "pitch_blade_angle_3")),
        ("active_power", _RECOMPUTE_WIND.format(ye=PH.yaw_efficiency("yaw_error"), pe=PH.pitch_efficiency("_spread"))),
        ("bearing_temp", "bearing_temp + 1.5e-2 * pow(yaw_error, 1.7e0)"),
    ],
    "downtime": [("active_power", "0e0")],
}

_PUMP_RECOMPUTE = [
    ("hydraulic_power_kw", PH.hydraulic_kw("fluid_density", "flow_m3h", "differential_head_m")),
    ("shaft_power_kw", "hydraulic_power_kw / greatest(efficiency, 3.5e-1)"),
    ("motor_power_kw", "shaft_power_kw / motor_efficiency"),
    ("motor_current_a", PH.motor_current_a("motor_power_kw", "line_voltage", "power_factor")),
    ("discharge_pressure_bar", f"suction_abs_pressure_bar + fluid_density * {PH.GRAVITY!r} * differential_head_m / 1e5"),
]
PUMP_EFFECTS = {
    "cavitation": [
        ("npsha_m", "npsha_m - (1e0 + 4e0 * {s})"),
        ("cavitation_margin_m", "npsha_m - npshr_m"),
        ("_k", "{s} * least(greatest((1.8e0 - cavitation_margin_m) / 2.2e0, 2.5e-1), 1e0)"),
        ("flow_m3h", "flow_m3h * (1e0 - 4e-2 * _k)"),
        ("differential_head_m", "differential_head_m * (1e0 - 1e-1 * _k)"),
        ("efficiency", "efficiency * (1e0 - 1.2e-1 * _k)"),
        *_PUMP_RECOMPUTE,
        ("vibration_mm_s", "vibration_mm_s + 1.3e0 + 3.2e0 * _k"),
        ("bearing_temp_c", "bearing_temp_c + 1.5e0 + 4e0 * _k"),
    ],
    "impeller_wear": [
        ("flow_m3h", "flow_m3h * (1e0 - 3e-2 * {s})"),
        ("differential_head_m", "differential_head_m * (1e0 - 1.2e-1 * {s})"),
        ("efficiency", "efficiency * (1e0 - 8e-2 * {s})"),
        *_PUMP_RECOMPUTE,
        ("vibration_mm_s", "vibration_mm_s + 4e-1 + 9e-1 * {s}"),
        ("bearing_temp_c", "bearing_temp_c + 6e-1 + 1.6e0 * {s}"),
    ],
    "bearing_friction": [
        ("shaft_power_kw", "shaft_power_kw * (1.06e0 + 1.4e-1 * {s})"),
        ("motor_power_kw", "shaft_power_kw / motor_efficiency"),
        ("motor_current_a", PH.motor_current_a("motor_power_kw", "line_voltage", "power_factor")),
        ("vibration_mm_s", "vibration_mm_s + 7e-1 + 1.8e0 * {s}"),
        ("bearing_temp_c", "bearing_temp_c + 5e0 + 1.1e1 * {s}"),
    ],
}

REGISTRY = {"solar": SOLAR_EFFECTS, "wind": WIND_EFFECTS, "pump": PUMP_EFFECTS}


def check_types(events: DataFrame, kind: str, type_col: str = "event_type") -> None:
    """Every fault type in the event table must have an effect; one
    aggregate counts the rows of other types and names a few."""
    other = events.where(~F.col(type_col).isin(*REGISTRY[kind]) | F.col(type_col).isNull())
    got = other.agg(F.count(F.lit(1)).alias("n"), F.min(type_col).alias("a"), F.max(type_col).alias("z")).first()
    if got["n"]:
        raise ValueError(f"unknown {kind} fault type(s) in {got['n']} rows: {sorted({str(got['a']), str(got['z'])})}")


def steps(kind: str, order: list[str], power_sql: str | None = None, outside_window: str = "none") -> list[tuple[str, str]]:
    """Ordered (column, SQL) assignments for the fault types in ``order``."""
    eff = REGISTRY[kind]
    unknown = [t for t in order if t not in eff]
    if unknown:
        raise ValueError(f"unknown {kind} fault type(s): {unknown}")
    out = []
    for t in order:
        s = f"sev_{t}"
        for col, e in eff[t]:
            e = e.replace("{s}", s).replace("{P}", power_sql or "active_power")
            if outside_window == "none" and not col.startswith("_"):
                e = f"CASE WHEN {s} > 0 THEN {e} ELSE {col} END"
            out.append((col, e))
    return out


def severity_wide(tel: DataFrame, events: DataFrame, types: list[str], device: str = "device", time: str = "time",
                  keep: list[str] | None = None, row_key: str | None = None, **join_kw) -> DataFrame:
    """Telemetry + one ``sev_<type>`` column per type (max over that type's
    active faults, 0 when none): one scan, one row out per row in.

    With ``row_key`` all columns of ``tel`` are kept, otherwise (device, time, keep)."""
    src = tel if row_key else tel.select(device, time, *(keep or []))
    j = with_active_events(src, events, device, time, need="labels", **join_kw).withColumn("_sev", active_severities())
    return j.select(*src.columns, *[
        F.expr(f"coalesce(array_max(transform(filter(_sev, s -> s.event_type = '{t}'), s -> s.severity)), 0.0D)").alias(f"sev_{t}")
        for t in types])


def overlay(df: DataFrame, kind: str, order: list[str], power_sql: str | None = None,
            outside_window: str = "none") -> DataFrame:
    """Apply the effects of the fault types in ``order`` to a table that has
    the signal columns and ``sev_<type>`` columns."""
    return with_exprs(df, steps(kind, order, power_sql, outside_window))


def overlay_sql(base_sql: str, base_cols: list[str], kind: str, order: list[str], power_sql: str | None = None,
                outside_window: str = "none", prefix: str = "ov") -> tuple[str, str]:
    """Oracle twin of :func:`overlay`: (CTE chain, last CTE name)."""
    return chain_sql(base_sql, steps(kind, order, power_sql, outside_window), prefix, base_cols)
