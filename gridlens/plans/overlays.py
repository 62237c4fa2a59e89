"""Fault-overlay queries (J12-J14) on test-mapped healthy tables.

Solar and wind telemetry are derived from ``events`` (irradiance or wind
speed from ``value``); fault windows come from the events' own ``error``
rows (see :mod:`gridlens.plans.faults`).  Pump samples are scaled
``lineitem`` columns with a per-row fault assignment.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from gridlens.functions import physics as PH
from gridlens.functions.draws import keyed_uniform, keyed_uniform_sql as KU
from gridlens.functions.exprs import r6, r6_sql as R
from gridlens.operators import overlay as OV
from gridlens.operators.clean import (SOLAR_BOUNDS, WIND_BOUNDS, PUMP_BOUNDS, SOLAR_NIGHT_COLS, bound_sql,
                                      finish_table)
from gridlens.operators.scoring import with_exprs, chain_sql, interp_curve, curve_sql
from gridlens.plans.faults import FAULT_TYPES, fault_events, fe_sql
from gridlens.plans.registry import register, table

SEED = 42
SOLAR_ORDER = ["soiling", "inverter_overheat", "tracker_stuck", "dc_string_outage", "downtime"]
WIND_TYPES = [
    (0, "temperature", "linear", 1.0, 21600.0, 7200.0),
    (1, "pitch_misalignment", "linear", 10.0, 21600.0, 0.0),
    (2, "yaw_misalignment", "linear", 18.0, 21600.0, 0.0),
    (3, "temperature", "abrupt", 1.0, None, 0.0),
    (4, "downtime", "abrupt", 1.0, None, 0.0),
]
WIND_ORDER = ["temperature", "pitch_misalignment", "yaw_misalignment", "downtime"]

TEL_BASE_SQL = ("SELECT event_id, user_id AS device, ts AS time, CAST(value AS DOUBLE) AS value, CAST(event_id AS DOUBLE) AS eid, "
                "CAST(dayofyear(ts) AS DOUBLE) AS doy, CAST(hour(ts) AS DOUBLE) + CAST(minute(ts) AS DOUBLE) / 6e1 AS hour_f FROM events")
TEL_BASE_COLS = ["event_id", "device", "time", "value", "eid", "doy", "hour_f"]


def tel_base(spark, sf):
    return table(spark, sf, "events", spread=True).select(
        "event_id", F.col("user_id").alias("device"), F.col("ts").alias("time"), F.col("value").cast("double").alias("value"),
        F.col("event_id").cast("double").alias("eid"), F.dayofyear("ts").cast("double").alias("doy"),
        (F.hour("ts").cast("double") + F.minute("ts").cast("double") / F.lit(60.0)).alias("hour_f"))


def _finish_sql(last: str, out: list[str], bounds: dict, night: list[str] | None = None) -> tuple[str, str]:
    """Oracle twin of finish_table + output projection: (extra CTE, select list)."""
    cte = ""
    src = last
    if night:
        cond = "(sun_elevation <= 0.5 OR irradiance <= 0.5)"
        rep = ", ".join(f"CASE WHEN {cond} THEN 0.0 ELSE {c} END AS {c}" for c in night)
        cte = f",\nfin AS (SELECT * REPLACE ({rep}) FROM {last})"
        src = "fin"
    cols = ", ".join(f"{bound_sql(c, *bounds[c])} AS {c}" if c in bounds else f"{R(c)} AS {c}" for c in out)
    return cte, cols, src


def _finish(df, out, bounds, night=None):
    f = finish_table(df, bounds, night)
    return [F.col(c) if c in bounds else r6(c).alias(c) for c in out], f


def _sev_sql(types, order, src="s"):
    cols = ", ".join(f"max(CASE WHEN event_type = '{t}' THEN severity ELSE 0.0 END) AS sev_{t}" for t in order)
    return f"sev AS (SELECT event_id, {cols} FROM {src} GROUP BY event_id)"


def _with_sev(spark, sf, base, types, order):
    """Healthy table + per-type severities, in one scan."""
    return OV.severity_wide(base, fault_events(spark, sf, types), order, row_key="event_id")


# --- J12 solar -------------------------------------------------------------------------
SOLAR_BASE = [
    ("irradiance", "least(value * 4e0, 1.25e3)"),
    ("sun_elevation", PH.sun_elevation_deg("doy", "hour_f", 40.0)),
    ("active_power", "CASE WHEN sun_elevation > 0e0 THEN solar_curve(irradiance) ELSE 0e0 END"),
    ("module_temp", "2e1 + 2.8e-2 * irradiance"),
    ("inverter_temp", "2.5e1 + 1.05e-2 * active_power"),
    ("dc_voltage", "8.2e2"),
    ("dc_current", "active_power * 1.03e0 / 8.2e2"),
    ("ac_voltage", "4e2"),
    ("ac_current", "active_power / (sqrt(3e0) * 4e2)"),
    ("performance_ratio", "9e-1"),
]
SOLAR_POWER = "solar_curve(irradiance)"
SOLAR_OUT = ["irradiance", "active_power", "module_temp", "inverter_temp", "dc_voltage", "dc_current", "ac_voltage",
             "ac_current", "performance_ratio"]


def _solar_sql():
    base_cte, base_last = chain_sql(TEL_BASE_SQL, SOLAR_BASE, "sb")
    cols = TEL_BASE_COLS + [c for c, _ in SOLAR_BASE] + [f"sev_{t}" for t in SOLAR_ORDER]
    ov_cte, ov_last = OV.overlay_sql(f"SELECT b.*, {', '.join(f'sev.sev_{t}' for t in SOLAR_ORDER)} FROM {base_last} b JOIN sev USING (event_id)",
                                     cols, "solar", SOLAR_ORDER, SOLAR_POWER)
    fin_cte, cols, src = _finish_sql(ov_last, SOLAR_OUT, SOLAR_BOUNDS, SOLAR_NIGHT_COLS)
    return (f"WITH {fe_sql(FAULT_TYPES)},\n{_sev_sql(FAULT_TYPES, SOLAR_ORDER)},\n{base_cte},\n{ov_cte}{fin_cte}\n"
            f"SELECT event_id, device, time, {cols} FROM {src}")


@register("overlay_solar", _solar_sql())
def q_overlay_solar(spark, sf):
    """Soiling, inverter overheat, tracker stuck, string outage and downtime applied in event order."""
    base = with_exprs(tel_base(spark, sf), SOLAR_BASE)
    w = _with_sev(spark, sf, base, FAULT_TYPES, SOLAR_ORDER)
    o = OV.overlay(w, "solar", SOLAR_ORDER, SOLAR_POWER)
    cols, f = _finish(o, SOLAR_OUT, SOLAR_BOUNDS, SOLAR_NIGHT_COLS)   # night mask, clip, round (F8 + F6)
    return f.select("event_id", "device", "time", *cols)


# --- J13 wind ---------------------------------------------------------------------------
WIND_BASE_A = [
    ("ws", "least(value / 1e1, 3e1)"),
]
WIND_BASE_B = [
    ("rho", "1.1e0 + ((eid % 26e0) / 1e2)"),
    ("density_factor", PH.density_factor("rho")),
    ("wind_direction", "(((11e0 * eid) % 360e0) + 360e0) % 360e0"),
    ("nacelle_direction", "(((wind_direction + ((eid % 7e0) - 3e0)) % 360e0) + 360e0) % 360e0"),
    ("nacelle_position", "nacelle_direction"),
    ("yaw_error", "abs((((wind_direction - nacelle_direction + 180e0) % 360e0) + 360e0) % 360e0 - 180e0)"),
    ("pitch_blade_angle_1", PH.commanded_pitch("ws")),
    ("pitch_blade_angle_2", PH.commanded_pitch("ws")),
    ("pitch_blade_angle_3", PH.commanded_pitch("ws")),
    ("active_power", f"raw_power * density_factor * {PH.yaw_efficiency('yaw_error')}"),
    ("gearbox_oil_temp", "4e1 + 1e-2 * active_power"),
    ("generator_temp", "5e1 + 1.4e-2 * active_power"),
    ("bearing_temp", "3.5e1 + 7e-3 * active_power"),
    ("converter_temp", "3.8e1 + 1.1e-2 * active_power"),
]
WIND_OUT = ["active_power", "nacelle_direction", "yaw_error", "pitch_blade_angle_2", "pitch_blade_angle_3",
            "gearbox_oil_temp", "generator_temp", "bearing_temp", "converter_temp"]


def _wind_sql():
    a_cte, a_last = chain_sql(TEL_BASE_SQL, WIND_BASE_A, "wa")
    c_cte, c_join, c_val = curve_sql("ws", PH.WIND_CURVE, "wseg")
    b_cte, b_last = chain_sql(f"SELECT d.*, {c_val} AS raw_power FROM {a_last} d {c_join}", WIND_BASE_B, "wb")
    cols = TEL_BASE_COLS + ["ws", "raw_power"] + [c for c, _ in WIND_BASE_B] + [f"sev_{t}" for t in WIND_ORDER]
    ov_cte, ov_last = OV.overlay_sql(f"SELECT b.*, {', '.join(f'sev.sev_{t}' for t in WIND_ORDER)} FROM {b_last} b JOIN sev USING (event_id)",
                                     cols, "wind", WIND_ORDER, prefix="wo")
    fin_cte, cols, src = _finish_sql(ov_last, WIND_OUT, WIND_BOUNDS)
    return (f"WITH {fe_sql(WIND_TYPES)},\n{_sev_sql(WIND_TYPES, WIND_ORDER)},\n{a_cte},\n{c_cte},\n{b_cte},\n{ov_cte}{fin_cte}\n"
            f"SELECT event_id, device, time, {cols} FROM {src}")


@register("overlay_wind", _wind_sql())
def q_overlay_wind(spark, sf):
    """Temperature, pitch and yaw faults (same type twice merged by max) and downtime."""
    a = with_exprs(tel_base(spark, sf), WIND_BASE_A)
    base = with_exprs(interp_curve(a, "ws", PH.WIND_CURVE, "raw_power"), WIND_BASE_B)
    w = _with_sev(spark, sf, base, WIND_TYPES, WIND_ORDER)
    o = OV.overlay(w, "wind", WIND_ORDER)
    cols, f = _finish(o, WIND_OUT, WIND_BOUNDS)
    return f.select("event_id", "device", "time", *cols)


# --- J14 pump -----------------------------------------------------------------------------
PUMP_ORDER = ["cavitation", "impeller_wear", "bearing_friction"]
PUMP_BASE_SQL = ("SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus, CAST(l_quantity AS DOUBLE) AS q, "
                 "CAST(l_extendedprice AS DOUBLE) AS p, CAST(l_discount AS DOUBLE) AS d, CAST(l_tax AS DOUBLE) AS t, "
                 f"{KU(SEED, 'pump_severity', 'l_orderkey', 'l_linenumber')} AS u FROM lineitem")
PUMP_BASE_COLS = ["l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", "q", "p", "d", "t", "u"]
PUMP_BASE = [
    ("fluid_t", "2e1 + t * 5e2"),
    ("fluid_density", PH.water_density("fluid_t")),
    ("flow_m3h", "p / 1e3"),
    ("differential_head_m", "3e1 + q / 2e0"),
    ("efficiency", "5e-1 + d * 3e0"),
    ("suction_abs_pressure_bar", "8e-1 + d * 2e1"),
    ("npsha_m", f"(suction_abs_pressure_bar * 1e5 - {PH.vapour_pressure_pa('fluid_t')}) / (fluid_density * {PH.GRAVITY!r}) + 2e0 - 1.5e3 * pow(flow_m3h / 3.6e3, 2)"),
    ("npshr_m", "3e0 * pow(least(greatest(flow_m3h / 9e1, 5.5e-1), 1.35e0), 1.8e0)"),
    ("cavitation_margin_m", "npsha_m - npshr_m"),
    ("motor_efficiency", "9.3e-1"),
    ("line_voltage", "4e2"),
    ("power_factor", "8.6e-1"),
    *OV._PUMP_RECOMPUTE,
    ("vibration_mm_s", "9e-1 + 2.2e0 * pow(abs(flow_m3h / 9e1 - 1e0), 1.5e0) + 1.5e-2 * shaft_power_kw"),
    ("bearing_temp_c", "4e1 + 5.5e-1 * shaft_power_kw"),
    ("active_fault", "CASE WHEN l_returnflag = 'A' THEN 'cavitation' WHEN l_returnflag = 'R' THEN 'impeller_wear' "
                     "WHEN l_linestatus = 'O' THEN 'bearing_friction' ELSE 'none' END"),
    ("severity", "CASE WHEN active_fault = 'none' THEN 0e0 ELSE 1.5e-1 + 8.5e-1 * u END"),
    *[(f"sev_{t}", f"CASE WHEN active_fault = '{t}' THEN severity ELSE 0e0 END") for t in PUMP_ORDER],
]
PUMP_OUT = ["severity", "flow_m3h", "differential_head_m", "efficiency", "shaft_power_kw", "motor_power_kw",
            "motor_current_a", "vibration_mm_s", "bearing_temp_c", "cavitation_margin_m", "discharge_pressure_bar"]


def _pump_sql():
    b_cte, b_last = chain_sql(PUMP_BASE_SQL, PUMP_BASE, "pb", PUMP_BASE_COLS)
    cols = PUMP_BASE_COLS + [c for c, _ in PUMP_BASE]
    ov_cte, ov_last = OV.overlay_sql(f"SELECT * FROM {b_last}", cols, "pump", PUMP_ORDER, prefix="po")
    fin_cte, cols, src = _finish_sql(ov_last, PUMP_OUT, PUMP_BOUNDS)
    return f"WITH {b_cte},\n{ov_cte}{fin_cte}\nSELECT l_orderkey, l_linenumber, active_fault, {cols} FROM {src}"


@register("overlay_pump", _pump_sql())
def q_overlay_pump(spark, sf):
    """Cavitation, impeller wear and bearing friction by a per-row assignment, power chain recomputed."""
    li = table(spark, sf, "lineitem", spread=True).select(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", F.col("l_quantity").cast("double").alias("q"),
        F.col("l_extendedprice").cast("double").alias("p"), F.col("l_discount").cast("double").alias("d"),
        F.col("l_tax").cast("double").alias("t"), keyed_uniform(SEED, "pump_severity", "l_orderkey", "l_linenumber").alias("u"))
    o = OV.overlay(with_exprs(li, PUMP_BASE), "pump", PUMP_ORDER)
    cols, f = _finish(o, PUMP_OUT, PUMP_BOUNDS)
    return f.select("l_orderkey", "l_linenumber", "active_fault", *cols)


_PUMP_REPORT_COLS = [c for c in PUMP_BOUNDS if c in {n for n, _ in PUMP_BASE}]


def _pump_report_sql():
    b_cte, b_last = chain_sql(PUMP_BASE_SQL, PUMP_BASE, "pb", PUMP_BASE_COLS)
    parts = []
    for c in _PUMP_REPORT_COLS:
        lo, hi, _d = PUMP_BOUNDS[c]
        parts.append(f"SELECT '{c}' AS column_name, CAST(count_if({c} < {lo!r}) AS BIGINT) AS n_below, "
                     f"CAST(count_if({c} > {hi!r}) AS BIGINT) AS n_above, count({c}) AS n_rows FROM {b_last}")
    return f"WITH {b_cte}\n" + "\nUNION ALL\n".join(parts)


@register("bounds_report_pump", _pump_report_sql())
def q_bounds_report_pump(spark, sf):
    """F7 with the reference's pump bounds: readings outside the physical range per column, before clipping."""
    from gridlens.operators.clean import bounds_report
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", F.col("l_quantity").cast("double").alias("q"),
        F.col("l_extendedprice").cast("double").alias("p"), F.col("l_discount").cast("double").alias("d"),
        F.col("l_tax").cast("double").alias("t"), keyed_uniform(SEED, "pump_severity", "l_orderkey", "l_linenumber").alias("u"))
    base = with_exprs(li, PUMP_BASE)
    return bounds_report(base, {c: PUMP_BOUNDS[c] for c in _PUMP_REPORT_COLS})
