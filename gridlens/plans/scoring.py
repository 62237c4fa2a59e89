"""Scoring-job queries.

Every derived column is one SQL expression from
:mod:`gridlens.functions.physics`, added in Spark with ``with_exprs`` and in
the oracle with the matching CTE chain, then aggregated per group.

Test mappings (documented per query): wind speed = least(value/10, 30),
irradiance = least(value*4, 1250) on ``events``; pump samples and electrical
readings are scaled ``lineitem`` columns with device parameters from ``part``.
Integer inputs are cast to double first and float literals that enter a
division are written as doubles (``6e1``), so neither engine does decimal
arithmetic.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from gridlens.functions import physics as PH
from gridlens.functions.exprs import r6, r6_sql as R, rk, rk_sql
from gridlens.operators import scoring as SC
from gridlens.plans.registry import register, table

LAT = 40.0

EV_BASE_SQL = ("SELECT event_id, user_id AS device, ts AS time, CAST(ts AS DATE) AS day, CAST(value AS DOUBLE) AS value, "
               "CAST(event_id AS DOUBLE) AS eid FROM events")


def ev_base(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", F.col("user_id").alias("device"), F.col("ts").alias("time"), F.col("ts").cast("date").alias("day"),
        F.col("value").cast("double").alias("value"), F.col("event_id").cast("double").alias("eid"))




def _summary_sql(src, keys, expected, actual, under=None):
    res = f"({actual} - {expected})"
    extra = f", CAST(count_if({actual} < {under!r} * {expected}) AS BIGINT) AS n_under" if under is not None else ""
    return (f"SELECT {keys}, count(*) AS n, {R(f'avg({expected})')} AS mean_expected, {R(f'avg({actual})')} AS mean_actual, "
            f"{R(f'avg({res})')} AS mean_residual, {R(f'stddev_samp({res})')} AS std_residual{extra} FROM {src} GROUP BY {keys}")


def _summary(df, keys, expected, actual, under=None):
    s = SC.residual_summary(df, keys, expected, actual, under)
    cols = [*keys, "n", r6("mean_expected").alias("mean_expected"), r6("mean_actual").alias("mean_actual"),
            r6("mean_residual").alias("mean_residual"), r6("std_residual").alias("std_residual")]
    if under is not None:
        cols.append("n_under")
    return s.select(*cols)


# --- D1 -------------------------------------------------------------------------------
D1_EXPRS = {"ws": "least(value / 1e1, 3e1)", "actual": "least(value * 4e0, 1.79e3)"}
_D1_CTE, _D1_LAST = SC.chain_sql(EV_BASE_SQL, D1_EXPRS)
_CURVE_CTE, _CURVE_JOIN, _CURVE_VAL = SC.curve_sql("ws", PH.WIND_CURVE)


@register("power_residual", f"""WITH {_D1_CTE}, {_CURVE_CTE},
x AS (SELECT d.*, {_CURVE_VAL} AS expected FROM {_D1_LAST} d {_CURVE_JOIN})
{_summary_sql('x', 'device, day', 'expected', 'actual', 0.9)}""")
def q_power_residual(spark, sf):
    """Expected power from the wind curve vs a measured signal, per device and day."""
    d = SC.with_exprs(ev_base(spark, sf), D1_EXPRS)
    x = SC.interp_curve(d, "ws", PH.WIND_CURVE, "expected")
    return _summary(x, ["device", "day"], "expected", "actual", 0.9)


D1_SOLAR_EXPRS = {"irr": "least(value * 4e0, 1.25e3)", "actual": "least(value * 13e0, 4.4e3)"}
_D1S_CTE, _D1S_LAST = SC.chain_sql(EV_BASE_SQL, D1_SOLAR_EXPRS)
_SCURVE_CTE, _SCURVE_JOIN, _SCURVE_VAL = SC.curve_sql("irr", PH.SOLAR_CURVE)


@register("power_residual_solar", f"""WITH {_D1S_CTE}, {_SCURVE_CTE},
x AS (SELECT d.*, {_SCURVE_VAL} AS expected FROM {_D1S_LAST} d {_SCURVE_JOIN})
{_summary_sql('x', 'device, day', 'expected', 'actual', 0.9)}""")
def q_power_residual_solar(spark, sf):
    """Expected power from the solar curve vs a measured signal, per device and day."""
    d = SC.with_exprs(ev_base(spark, sf), D1_SOLAR_EXPRS)
    x = SC.interp_curve(d, "irr", PH.SOLAR_CURVE, "expected")
    return _summary(x, ["device", "day"], "expected", "actual", 0.9)


# --- D2 / D3 / D4 --------------------------------------------------------------------
SOLAR_EXPRS = {
    "doy": "CAST(dayofyear(time) AS DOUBLE)",
    "hr": "CAST(hour(time) AS DOUBLE) + CAST(minute(time) AS DOUBLE) / 6e1",
    "elev": PH.sun_elevation_deg("doy", "hr", LAT),
    "azim": PH.sun_azimuth_deg("doy", "hr", LAT),
    "day_len": PH.day_length_h("doy", LAT),
    "clear": PH.clear_sky_irradiance("doy", "elev"),
    "irr_raw": "least(value * 4e0, 1.25e3)",
    "irr": "CASE WHEN elev > 5e-1 THEN irr_raw ELSE 0e0 END",
    "power": "CASE WHEN elev > 0e0 THEN solar_curve(irr) ELSE 0e0 END",
    "clear_power": "solar_curve(clear)",
    "pr": "CASE WHEN clear_power > 1e0 THEN least(greatest(power / clear_power, 0e0), 1.02e0) ELSE 0e0 END",
    "cloud": "least(greatest(value / 5e2, 2e-2), 9.8e-1)",
    "expected_irr": f"clear * {PH.transmittance('cloud')}",
}
_SOL_CTE, _SOL_LAST = SC.chain_sql(EV_BASE_SQL, SOLAR_EXPRS, "s")


def _solar(spark, sf):
    return SC.with_exprs(ev_base(spark, sf), SOLAR_EXPRS)


@register("performance_ratio", f"""WITH {_SOL_CTE}
SELECT device, day, count(*) AS n, {R('avg(pr)')} AS mean_pr,
  {R('CASE WHEN sum(clear_power) > 0 THEN sum(power) / sum(clear_power) END')} AS weighted_pr
FROM {_SOL_LAST} GROUP BY device, day""")
def q_performance_ratio(spark, sf):
    """Performance ratio (0 when clear-sky power <= 1, clipped 1.02) and its energy-weighted daily mean."""
    s = _solar(spark, sf)
    return s.groupBy("device", "day").agg(
        F.count(F.lit(1)).alias("n"), r6(F.avg("pr")).alias("mean_pr"),
        r6(F.when(F.sum("clear_power") > 0, F.sum("power") / F.sum("clear_power"))).alias("weighted_pr"))


@register("daylight_audit", f"""WITH {_SOL_CTE}
SELECT day, count(*) AS n, CAST(count_if(elev <= 5e-1) AS BIGINT) AS n_night,
  CAST(count_if(elev <= 5e-1 AND irr_raw > 5e-1) AS BIGINT) AS n_irr_at_night,
  {R('avg(day_len)')} AS day_length_h, {R('max(elev)')} AS max_elevation, {R('avg(azim)')} AS mean_azimuth
FROM {_SOL_LAST} GROUP BY day""")
def q_daylight_audit(spark, sf):
    """D3: solar geometry per row; rows with irradiance while the sun is down, per day."""
    s = _solar(spark, sf)
    return s.groupBy("day").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("elev") <= 0.5).alias("n_night"),
        F.count_if((F.col("elev") <= 0.5) & (F.col("irr_raw") > 0.5)).alias("n_irr_at_night"),
        r6(F.avg("day_len")).alias("day_length_h"), r6(F.max("elev")).alias("max_elevation"),
        r6(F.avg("azim")).alias("mean_azimuth"))


@register("transmittance_residual", f"""WITH {_SOL_CTE}
{_summary_sql(f'(SELECT * FROM {_SOL_LAST} WHERE clear > 0)', 'device', 'expected_irr', 'irr')}""")
def q_transmittance_residual(spark, sf):
    """Irradiance vs clear-sky x (1 - 0.72 cloud^1.35), daylight rows, per device."""
    s = _solar(spark, sf).where(F.col("clear") > 0)
    return _summary(s, ["device"], "expected_irr", "irr")


# --- D5 ---------------------------------------------------------------------------------
@register("fleet_residual", f"""WITH b AS ({EV_BASE_SQL}),
t AS (SELECT *, time_bucket(INTERVAL 1 HOUR, time) AS hr_start FROM b),
m AS (SELECT hr_start, quantile_cont(value, 0.5) AS fleet_median FROM t GROUP BY hr_start)
SELECT device, count(*) AS n, {R('avg(value - fleet_median)')} AS mean_drift, {R('stddev_samp(value - fleet_median)')} AS std_drift
FROM t JOIN m USING (hr_start) GROUP BY device""")
def q_fleet_residual(spark, sf):
    """Reading minus the fleet median of the same hour (thermal drift vs fleet)."""
    from gridlens.operators.profile import quantile_columns
    b = ev_base(spark, sf).withColumn("hr_start", F.window("time", "1 hour").start)
    med = quantile_columns(b, "value", [0.5], ["fleet_median"], ["hr_start"])   # exact; hot hours refined
    j = b.join(med, "hr_start").withColumn("_d", F.col("value") - F.col("fleet_median"))
    return j.groupBy("device").agg(F.count(F.lit(1)).alias("n"), r6(F.avg("_d")).alias("mean_drift"),
                                   r6(F.stddev_samp("_d")).alias("std_drift"))


# --- D6 -------------------------------------------------------------------------------------
LI_BASE_SQL = ("SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag, l_linestatus, CAST(l_quantity AS DOUBLE) AS q, "
               "CAST(l_extendedprice AS DOUBLE) AS p, CAST(l_discount AS DOUBLE) AS d, CAST(l_tax AS DOUBLE) AS t FROM lineitem")


def li_base(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", "l_linestatus",
        F.col("l_quantity").cast("double").alias("q"), F.col("l_extendedprice").cast("double").alias("p"),
        F.col("l_discount").cast("double").alias("d"), F.col("l_tax").cast("double").alias("t"))


D6_EXPRS = {
    "p_kw": "p / 1e2",
    "v_ac": "3.8e2 + q",
    "i_meas": "d * 1e3",
    "i_exp": PH.motor_current_a("p_kw", "v_ac", "1e0"),
    "i_diff": "abs(i_meas - i_exp)",
}
_D6_CTE, _D6_LAST = SC.chain_sql(LI_BASE_SQL, D6_EXPRS)


@register("electrical_audit", f"""WITH {_D6_CTE}
SELECT l_returnflag, count(*) AS n, {R('avg(i_exp)')} AS mean_expected_a, {R('avg(i_diff)')} AS mean_abs_diff_a,
  CAST(count_if(i_diff > 5e0) AS BIGINT) AS n_inconsistent FROM {_D6_LAST} GROUP BY l_returnflag""")
def q_electrical_audit(spark, sf):
    """AC current vs P / (sqrt(3) V): mean deviation and count beyond 5 A."""
    x = SC.with_exprs(li_base(spark, sf), D6_EXPRS)
    return x.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), r6(F.avg("i_exp")).alias("mean_expected_a"),
                                         r6(F.avg("i_diff")).alias("mean_abs_diff_a"),
                                         F.count_if(F.col("i_diff") > 5.0).alias("n_inconsistent"))


# --- D8 / D10 / D11 ------------------------------------------------------------------------------
WIND_EXPRS = {
    "ws": "least(value / 1e1, 3e1)",
    "yaw_err": "abs(" + "((((((11e0 * eid) % 360e0) + 360e0) % 360e0) - ((((7.3e0 * value) % 360e0) + 360e0) % 360e0) + 180e0) % 360e0 + 360e0) % 360e0 - 180e0" + ")",
    "rho": "1.1e0 + ((eid % 26e0) / 1e2)",
    "spread": "(((eid * 7e0) % 13e0) / 2e0)",
    "df": PH.density_factor("rho"),
    "ye": PH.yaw_efficiency("yaw_err"),
    "pe": PH.pitch_efficiency("spread"),
}
_W_CTE, _W_LAST = SC.chain_sql(EV_BASE_SQL, WIND_EXPRS, "w")
LOSS_EXPRS = {
    "p_density": "raw * df",
    "yaw_loss": "raw * df * (1e0 - ye)",
    "pitch_loss": "raw * df * ye * (1e0 - pe)",
    "expected": "raw * df * ye * pe",
}


@register("loss_breakdown", f"""WITH {_W_CTE}, {SC.curve_sql('ws', PH.WIND_CURVE)[0]},
x AS (SELECT d.*, {SC.curve_sql('ws', PH.WIND_CURVE)[2]} AS raw FROM {_W_LAST} d {SC.curve_sql('ws', PH.WIND_CURVE)[1]}),
{SC.chain_sql('SELECT * FROM x', LOSS_EXPRS, 'l')[0]}
SELECT device, count(*) AS n, {rk_sql('sum(raw)', 4)} AS raw_kw, {rk_sql('sum(p_density)', 4)} AS density_adjusted_kw,
  {rk_sql('sum(yaw_loss)', 4)} AS yaw_loss_kw, {rk_sql('sum(pitch_loss)', 4)} AS pitch_loss_kw, {rk_sql('sum(expected)', 4)} AS expected_kw
FROM {SC.chain_sql('SELECT * FROM x', LOSS_EXPRS, 'l')[1]} GROUP BY device""")
def q_loss_breakdown(spark, sf):
    """Curve power x density factor x cos^3(yaw error) x pitch efficiency; losses by cause per device."""
    w = SC.with_exprs(ev_base(spark, sf), WIND_EXPRS)
    x = SC.with_exprs(SC.interp_curve(w, "ws", PH.WIND_CURVE, "raw"), LOSS_EXPRS)
    return x.groupBy("device").agg(
        F.count(F.lit(1)).alias("n"), rk(F.sum("raw"), 4).alias("raw_kw"), rk(F.sum("p_density"), 4).alias("density_adjusted_kw"),
        rk(F.sum("yaw_loss"), 4).alias("yaw_loss_kw"), rk(F.sum("pitch_loss"), 4).alias("pitch_loss_kw"),
        rk(F.sum("expected"), 4).alias("expected_kw"))


DENS_EXPRS = {
    "pressure_hpa": "1.01325e3 + (value - 5e1) / 1e1",
    "temp_c": "(eid % 40e0) - 5e0",
    "rho_model": PH.air_density("pressure_hpa", "temp_c"),
    "rho_sensor": "1.1e0 + ((eid % 26e0) / 1e2)",
}
_DN_CTE, _DN_LAST = SC.chain_sql(EV_BASE_SQL, DENS_EXPRS, "n")


@register("density_audit", f"""WITH {_DN_CTE}
{_summary_sql(_DN_LAST, 'device', 'rho_model', 'rho_sensor')}""")
def q_density_audit(spark, sf):
    """Air density from pressure and temperature vs the density sensor, per device."""
    x = SC.with_exprs(ev_base(spark, sf), DENS_EXPRS)
    return _summary(x, ["device"], "rho_model", "rho_sensor")


DRIVE_EXPRS = {
    "ws": "least(value / 1e1, 3e1)",
    "rotor": PH.rotor_speed_band("ws"),
    "generator": "least(value * 2.2e1, 2.2e3)",
    "ratio": "CASE WHEN rotor > 0 THEN generator / rotor END",
}
_DR_CTE, _DR_LAST = SC.chain_sql(EV_BASE_SQL, DRIVE_EXPRS, "r")


@register("drivetrain_audit", f"""WITH {_DR_CTE}
SELECT device, count(*) AS n, {R('avg(rotor)')} AS mean_rotor_rpm, {R('avg(ratio)')} AS mean_gear_ratio,
  {R('stddev_samp(ratio)')} AS std_gear_ratio FROM {_DR_LAST} GROUP BY device""")
def q_drivetrain_audit(spark, sf):
    """Rotor speed by wind band and generator/rotor ratio consistency per device."""
    x = SC.with_exprs(ev_base(spark, sf), DRIVE_EXPRS)
    return x.groupBy("device").agg(F.count(F.lit(1)).alias("n"), r6(F.avg("rotor")).alias("mean_rotor_rpm"),
                                   r6(F.avg("ratio")).alias("mean_gear_ratio"), r6(F.stddev_samp("ratio")).alias("std_gear_ratio"))


# --- D9 -------------------------------------------------------------------------------------------
PITCH_EXPRS = {
    "a1": "d * 1e2", "a2": "t * 1e2", "a3": "q / 5e0",
    "spread": PH.pitch_spread("a1", "a2", "a3"),
    "ws": "p / 4e3",
    "commanded": PH.commanded_pitch("ws"),
}
_PI_CTE, _PI_LAST = SC.chain_sql(LI_BASE_SQL, PITCH_EXPRS, "p")


@register("pitch_audit", f"""WITH {_PI_CTE}
SELECT l_returnflag, count(*) AS n, {R('avg(spread)')} AS mean_spread, {R('avg(commanded)')} AS mean_commanded,
  {R('avg(CASE WHEN spread > 3e0 THEN 1e0 ELSE 0e0 END)')} AS misalign_rate FROM {_PI_LAST} GROUP BY l_returnflag""")
def q_pitch_audit(spark, sf):
    """Spread across three blade angles, commanded pitch by wind band, misalignment rate."""
    x = SC.with_exprs(li_base(spark, sf), PITCH_EXPRS)
    return x.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), r6(F.avg("spread")).alias("mean_spread"), r6(F.avg("commanded")).alias("mean_commanded"),
        r6(F.avg(F.when(F.col("spread") > 3.0, 1.0).otherwise(0.0))).alias("misalign_rate"))


# --- D12-D15: pumps ---------------------------------------------------------------------------
PUMP_DEV_SQL = ("SELECT p_partkey, p_type, 7.8e1 + CAST(((p_partkey % 23) + 23) % 23 AS DOUBLE) AS q_bep_m3h, "
                "4e1 + CAST(p_size AS DOUBLE) / 5e0 AS h_bep, 7.6e-1 + CAST(((p_partkey % 11) + 11) % 11 AS DOUBLE) / 1e2 AS eta_peak "
                "FROM part")


def pump_devices(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey", "p_type",
        (F.lit(78.0) + F.pmod(F.col("p_partkey"), F.lit(23)).cast("double")).alias("q_bep_m3h"),
        (F.lit(40.0) + F.col("p_size").cast("double") / F.lit(5.0)).alias("h_bep"),
        (F.lit(0.76) + F.pmod(F.col("p_partkey"), F.lit(11)).cast("double") / F.lit(100.0)).alias("eta_peak"))


PUMP_EXPRS = {
    "h0": "1.24e0 * h_bep",
    "k_pump": PH.pump_curve_k("h0", "h_bep", "q_bep_m3h"),
    "speed_ratio": "7e-1 + d * 3e0",
    "static_head": "1e1 + t * 2e2",
    "k_sys": "2e4 + q * 2e3",
    "flow_m3s": PH.pump_flow_m3s("h0", "speed_ratio", "static_head", "k_pump", "k_sys"),
    "expected_flow": "flow_m3s * 3.6e3",
    "measured_flow": "p / 1e3",
    "expected_eff": PH.pump_efficiency("flow_m3s", "q_bep_m3h", "speed_ratio", "eta_peak"),
}
_PU_BASE = f"SELECT l.*, dv.p_type, dv.q_bep_m3h, dv.h_bep, dv.eta_peak FROM ({LI_BASE_SQL}) l JOIN ({PUMP_DEV_SQL}) dv ON l.l_partkey = dv.p_partkey"
_PU_CTE, _PU_LAST = SC.chain_sql(_PU_BASE, PUMP_EXPRS, "u")


def _pump(spark, sf):
    from gridlens.operators.joins import join_dim
    j = join_dim(li_base(spark, sf), pump_devices(spark, sf), F.col("l_partkey") == F.col("p_partkey"))
    return SC.with_exprs(j, PUMP_EXPRS)


@register("pump_residual", f"""WITH {_PU_CTE}
SELECT p_type, l_returnflag, count(*) AS n, {R('avg(expected_flow)')} AS mean_expected, {R('avg(measured_flow)')} AS mean_actual,
  {R('avg(measured_flow - expected_flow)')} AS mean_residual, {R('avg(expected_eff)')} AS mean_expected_eff
FROM {_PU_LAST} GROUP BY p_type, l_returnflag""")
def q_pump_residual(spark, sf):
    """Affinity-scaled pump curve meets the system curve (closed form); flow residual per device type and fault class."""
    x = _pump(spark, sf)
    return x.groupBy("p_type", "l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), r6(F.avg("expected_flow")).alias("mean_expected"),
        r6(F.avg("measured_flow")).alias("mean_actual"),
        r6(F.avg(F.col("measured_flow") - F.col("expected_flow"))).alias("mean_residual"),
        r6(F.avg("expected_eff")).alias("mean_expected_eff"))


POWER_EXPRS = {
    "fluid_t": "2e1 + t * 5e2",
    "rho": PH.water_density("fluid_t"),
    "flow_m3h": "p / 1e3",
    "head": "3e1 + q / 2e0",
    "eff": "5e-1 + d * 3e0",
    "hydraulic": PH.hydraulic_kw("rho", "flow_m3h", "head"),
    "shaft": "hydraulic / greatest(eff, 3.5e-1)",
    "motor": "shaft / 9.3e-1",
    "current": PH.motor_current_a("motor", "4e2", "8.6e-1"),
    "discharge_bar": f"(1e0 + d) + rho * {PH.GRAVITY!r} * head / 1e5",
    "motor_measured": "p / 4e3",
}
_PW_CTE, _PW_LAST = SC.chain_sql(LI_BASE_SQL, POWER_EXPRS, "w")


@register("pump_power_audit", f"""WITH {_PW_CTE}
SELECT l_linestatus, count(*) AS n, {R('avg(hydraulic)')} AS mean_hydraulic_kw, {R('avg(shaft)')} AS mean_shaft_kw,
  {R('avg(motor)')} AS mean_motor_kw, {R('avg(current)')} AS mean_current_a, {R('avg(discharge_bar)')} AS mean_discharge_bar,
  CAST(count_if(abs(motor_measured - motor) > 2e-1 * motor) AS BIGINT) AS n_inconsistent
FROM {_PW_LAST} GROUP BY l_linestatus""")
def q_pump_power_audit(spark, sf):
    """Hydraulic -> shaft -> motor power -> current chain and discharge pressure; readings off by > 20 %."""
    x = SC.with_exprs(li_base(spark, sf), POWER_EXPRS)
    return x.groupBy("l_linestatus").agg(
        F.count(F.lit(1)).alias("n"), r6(F.avg("hydraulic")).alias("mean_hydraulic_kw"), r6(F.avg("shaft")).alias("mean_shaft_kw"),
        r6(F.avg("motor")).alias("mean_motor_kw"), r6(F.avg("current")).alias("mean_current_a"),
        r6(F.avg("discharge_bar")).alias("mean_discharge_bar"),
        F.count_if(F.abs(F.col("motor_measured") - F.col("motor")) > 0.2 * F.col("motor")).alias("n_inconsistent"))


CAV_EXPRS = {
    "fluid_t": "2e1 + t * 5e2",
    "rho": PH.water_density("fluid_t"),
    "pv": PH.vapour_pressure_pa("fluid_t"),
    "suction_bar": "8e-1 + d * 2e1",
    "flow_m3s": "p / 1e3 / 3.6e3",
    "npsha": f"(suction_bar * 1e5 - pv) / (rho * {PH.GRAVITY!r}) + 2e0 - 1.5e3 * pow(flow_m3s, 2)",
    "npshr": "3e0 * pow(least(greatest((flow_m3s * 3.6e3) / 9e1, 5.5e-1), 1.35e0), 1.8e0)",
    "margin": "npsha - npshr",
}
_CV_CTE, _CV_LAST = SC.chain_sql(LI_BASE_SQL, CAV_EXPRS, "v")


@register("cavitation_risk", f"""WITH {_CV_CTE}
SELECT l_returnflag, count(*) AS n, {R('avg(margin)')} AS mean_margin, {R('min(margin)')} AS min_margin,
  CAST(count_if(margin < 1e1) AS BIGINT) AS n_below, {R('avg(CASE WHEN margin < 1e1 THEN 1e0 ELSE 0e0 END)')} AS rate_below
FROM {_CV_LAST} GROUP BY l_returnflag""")
def q_cavitation_risk(spark, sf):
    """Water density and vapour pressure from temperature, NPSHa - NPSHr; samples under a margin."""
    x = SC.with_exprs(li_base(spark, sf), CAV_EXPRS)
    return x.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), r6(F.avg("margin")).alias("mean_margin"), r6(F.min("margin")).alias("min_margin"),
        F.count_if(F.col("margin") < 10.0).alias("n_below"),
        r6(F.avg(F.when(F.col("margin") < 10.0, 1.0).otherwise(0.0))).alias("rate_below"))


VIB_EXPRS = {
    "flow_ratio": "(p / 1e3) / 9e1",
    "shaft": "q",
    "vib_model": "9e-1 + 2.2e0 * pow(abs(flow_ratio - 1e0), 1.5e0) + 1.5e-2 * shaft",
    "vib_meas": "d * 1e2",
    "resid": "vib_meas - vib_model",
}
_VB_CTE, _VB_LAST = SC.chain_sql(LI_BASE_SQL, VIB_EXPRS, "b")


@register("vibration_residual", f"""WITH {_VB_CTE}
SELECT l_returnflag, count(*) AS n, {R('avg(resid)')} AS mean, {R('stddev_samp(resid)')} AS std, {R('min(resid)')} AS min,
  {R('quantile_cont(resid, 0.5)')} AS p50, {R('max(resid)')} AS max FROM {_VB_LAST} GROUP BY l_returnflag""")
def q_vibration_residual(spark, sf):
    """Vibration vs the off-BEP model; residual described per group."""
    from gridlens.operators.profile import quantile_columns, _join_keys
    x = SC.with_exprs(li_base(spark, sf), VIB_EXPRS)
    m = x.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.avg("resid").alias("mean"), F.stddev_samp("resid").alias("std"),
        F.min("resid").alias("min"), F.max("resid").alias("max"))
    j = _join_keys(m, quantile_columns(x, "resid", [0.5], ["p50"], ["l_returnflag"]), ["l_returnflag"])
    return j.select("l_returnflag", "n", *[r6(c).alias(c) for c in ["mean", "std", "min", "p50", "max"]])


# --- D17 -------------------------------------------------------------------------------------------
# Fixed values that must equal the reference's overheat rule: 34 C and over,
# 780 W/m2 and over, 11:00-16:30; excess over 10 C and 350 W/m2; 0.45/0.55 mix;
# sine of steps/2.3 above 0.15; trip at 0.70, derate 0.22 x severity.
def overheat_exprs(seconds: str, start_s: float, step_s: float = 600.0, temp_min: float = 34.0, irr_min: float = 780.0,
                   from_hour: float = 11.0, to_hour: float = 16.5, trigger: float = 0.15, trip: float = 0.70) -> dict:
    """D17 as ordered (column, SQL); ``seconds`` is the row's epoch time, steps count from ``start_s``."""
    share = f"least(greatest((temp - {temp_min!r}) / 1e1, 0e0), 1e0) + least(greatest((irr - {irr_min!r}) / 3.5e2, 0e0), 1e0)"
    return {
        "temp": "2e1 + value / 1e1",
        "irr": "least(value * 4e0, 1.25e3)",
        "hr": "CAST(hour(time) AS DOUBLE) + CAST(minute(time) AS DOUBLE) / 6e1",
        "step": f"floor(({seconds} - {start_s!r}) / {step_s!r})",
        "hot": f"hr >= {from_hour!r} AND hr <= {to_hour!r} AND temp >= {temp_min!r} AND irr >= {irr_min!r}",
        "base": share,
        "severity": f"CASE WHEN hot THEN least(greatest(4.5e-1 * base + 5.5e-1 * (CASE WHEN sin(step / 2.3e0) > {trigger!r} THEN 1e0 ELSE 0e0 END), 0e0), 1e0) ELSE 0e0 END",
        "action": f"CASE WHEN severity >= {trip!r} THEN 'trip' WHEN severity > 0 THEN 'derate' ELSE 'none' END",
        "power_factor": f"CASE WHEN severity >= {trip!r} THEN 0e0 ELSE 1e0 - 2.2e-1 * severity END",
    }


#: The event table begins on 2024-01-01.
OVERHEAT_START_S = 1704067200.0
OVERHEAT_EXPRS = overheat_exprs("(epoch_us(time) / 1e6)", OVERHEAT_START_S)


def _overheat_exprs_spark():
    return overheat_exprs("(timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', time) / 1e6)", OVERHEAT_START_S)


_OH_CTE, _OH_LAST = SC.chain_sql(EV_BASE_SQL, OVERHEAT_EXPRS, "o")


@register("overheat_rule", f"""WITH {_OH_CTE}
SELECT event_id, device, time, {R('severity')} AS severity, action, {R('power_factor')} AS power_factor
FROM {_OH_LAST} WHERE hot""")
def q_overheat_rule(spark, sf):
    """Inverter overheat on hot, sunny mid-day rows: severity, derate vs trip."""
    x = SC.with_exprs(ev_base(spark, sf), _overheat_exprs_spark())
    return x.where("hot").select("event_id", "device", "time", r6("severity").alias("severity"), "action",
                                 r6("power_factor").alias("power_factor"))


# --- D18 / D19: sales ---------------------------------------------------------------------------
@register("sales_cube", f"""SELECT CAST(year(o_orderdate) AS INTEGER) AS yr, CAST(month(o_orderdate) AS INTEGER) AS mon, l_returnflag, count(*) AS n_lines,
  {rk_sql('sum(l_extendedprice * (1 - l_discount))', 2)} AS revenue, CAST(sum(l_quantity) AS DOUBLE) AS units
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ROLLUP (year(o_orderdate), month(o_orderdate), l_returnflag)""")
def q_sales_cube(spark, sf):
    """revenue = qty x price net of discount, rolled up by year > month > flag."""
    j = table(spark, sf, "lineitem").join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    g = j.rollup(F.year("o_orderdate").alias("yr"), F.month("o_orderdate").alias("mon"), "l_returnflag").agg(
        F.count(F.lit(1)).alias("n_lines"), rk(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"),
        F.sum("l_quantity").cast("double").alias("units"))
    return g


SALES_ADDR = ", ([A-Za-z ]+), ([A-Z]{2}) ([0-9]{5})$"


@register("parse_sales", f"""WITH s AS (
  SELECT o_orderkey, strftime(o_orderdate + INTERVAL 24 YEAR, '%m/%d/%y %H:%M') AS order_date,
    CASE WHEN o_orderstatus = 'P' THEN concat(CAST(o_custkey AS VARCHAR), ' Oak St ', r_name)
         ELSE concat(CAST(o_custkey AS VARCHAR), ' Oak St, ', r_name, ', CA ', lpad(CAST(o_custkey % 100000 AS VARCHAR), 5, '0')) END AS address
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
SELECT o_orderkey, strptime(order_date, '%m/%d/%y %H:%M') AS order_time,
  nullif(regexp_extract(address, '^([^,]+),', 1), '') AS street, nullif(regexp_extract(address, '{SALES_ADDR}', 1), '') AS city,
  nullif(regexp_extract(address, '{SALES_ADDR}', 2), '') AS state, nullif(regexp_extract(address, '{SALES_ADDR}', 3), '') AS zip
FROM s""")
def q_parse_sales(spark, sf):
    """Order-line clean-up: parse 'MM/dd/yy HH:mm' dates and split addresses; bad addresses give NULLs."""
    o = (table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
         .join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
         .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")))
    addr = F.when(F.col("o_orderstatus") == "P",
                  F.concat(F.col("o_custkey").cast("string"), F.lit(" Oak St "), F.col("r_name"))).otherwise(
        F.concat(F.col("o_custkey").cast("string"), F.lit(" Oak St, "), F.col("r_name"), F.lit(", CA "),
                 F.lpad(F.pmod(F.col("o_custkey"), F.lit(100000)).cast("string"), 5, "0")))
    s = o.select("o_orderkey", F.date_format(F.col("o_orderdate") + F.expr("INTERVAL 24 YEARS"), "MM/dd/yy HH:mm").alias("order_date"),
                 addr.alias("address"))
    from gridlens.operators.sales import parse_sales
    return parse_sales(s, "order_date", "address", key="o_orderkey")


@register("overheat_episodes", f"""WITH {_OH_CTE},
f AS (SELECT device, time, CAST(severity >= 7e-1 AS INTEGER) AS flag,
        row_number() OVER (PARTITION BY device ORDER BY time, event_id) AS rn, event_id FROM {_OH_LAST}),
g AS (SELECT device, time, rn - row_number() OVER (PARTITION BY device ORDER BY time, rn) AS island FROM f WHERE flag = 1)
SELECT device, min(time) AS start_time, max(time) AS end_time, count(*) AS n_rows FROM g GROUP BY device, island""")
def q_overheat_episodes(spark, sf):
    """D17 + W2: runs of consecutive trip-level overheat readings per device."""
    from gridlens.operators.faults import episodes
    x = SC.with_exprs(ev_base(spark, sf), _overheat_exprs_spark())
    t = x.select("device", "time", "event_id", (F.col("severity") >= 0.7).cast("int").alias("flag"))
    return episodes(t, "flag", tiebreak=["event_id"])
