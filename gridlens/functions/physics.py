"""Physical relations as SQL expression text over column names.

Each builder returns a SQL expression string; Spark evaluates it through
``F.expr`` and the DuckDB oracle embeds the very same text, so both run the
same arithmetic.  Only functions both dialects share are used (sin, cos,
tan, asin, acos, atan2, radians, degrees, pi, pow, sqrt, ln, exp, least,
greatest, abs).
"""

from __future__ import annotations

import re

# --- fixed values that must equal the reference --------------------------------
# Solar power curve, (irradiance W/m2, power kW), linear between knots, clamped
# at both ends.
SOLAR_CURVE = [
    (0.0, 4.491939776), (10.0, 50.3), (20.0, 92.425), (30.0, 136.525), (40.0, 183.075),
    (50.0, 227.775), (60.0, 270.95), (70.0, 316.84), (80.0, 361.025), (90.0, 407.675),
    (100.0, 451.425), (110.0, 494.175), (120.0, 536.575), (130.0, 575.675), (140.0, 616.6),
    (150.0, 658.925), (160.0, 700.375), (170.0, 741.425), (180.0, 782.66), (190.0, 825.625),
    (200.0, 869.505), (210.0, 910.325), (220.0, 953.05), (230.0, 997.69), (240.0, 1040.575),
    (250.0, 1080.95), (260.0, 1122.225), (270.0, 1164.075), (280.0, 1205.5), (290.0, 1247.45),
    (300.0, 1288.25), (310.0, 1329.715), (320.0, 1372.76), (330.0, 1417.265), (340.0, 1459.125),
    (350.0, 1500.935), (360.0, 1543.2), (370.0, 1582.975), (380.0, 1621.5), (390.0, 1663.0),
    (400.0, 1704.075), (410.0, 1744.75), (420.0, 1783.55), (430.0, 1824.76), (440.0, 1867.475),
    (450.0, 1908.075), (460.0, 1950.25), (470.0, 1991.78), (480.0, 2031.95), (490.0, 2073.0),
    (500.0, 2113.375), (510.0, 2155.16), (520.0, 2197.5), (530.0, 2237.0), (540.0, 2276.815),
    (550.0, 2318.0), (560.0, 2359.45), (570.0, 2402.225), (580.0, 2445.75), (590.0, 2488.55),
    (600.0, 2529.0), (610.0, 2572.0), (620.0, 2612.725), (630.0, 2656.25), (640.0, 2698.2),
    (650.0, 2742.55), (660.0, 2784.55), (670.0, 2825.33), (680.0, 2867.325), (690.0, 2905.89),
    (700.0, 2945.05), (710.0, 2984.575), (720.0, 3023.0), (730.0, 3062.03), (740.0, 3101.84),
    (750.0, 3139.8), (760.0, 3177.5), (770.0, 3214.875), (780.0, 3250.975), (790.0, 3286.54675),
    (800.0, 3322.25), (810.0, 3358.125), (820.0, 3394.05), (830.0, 3431.825), (840.0, 3471.65),
    (850.0, 3512.475), (860.0, 3551.125), (870.0, 3591.155), (880.0, 3629.935), (890.0, 3669.375),
    (900.0, 3707.5), (910.0, 3745.9), (920.0, 3786.625), (930.0, 3826.53), (940.0, 3867.3),
    (950.0, 3904.8), (960.0, 3942.05), (970.0, 3979.0), (980.0, 4015.0), (990.0, 4052.4),
    (1000.0, 4087.0), (1010.0, 4124.5), (1020.0, 4164.85), (1030.0, 4200.0), (1040.0, 4234.0),
    (1050.0, 4265.78), (1060.0, 4294.325), (1070.0, 4319.375), (1080.0, 4343.0), (1090.0, 4363.125),
    (1100.0, 4378.5), (1110.0, 4390.0), (1120.0, 4395.5), (1130.0, 4400.0), (1140.0, 4400.0),
    (1150.0, 4400.0), (1160.0, 4400.0), (1170.0, 4400.0), (1180.0, 4400.0), (1200.0, 4400.0),
    (1210.0, 4400.0), (1220.0, 4400.0), (1230.0, 4400.0), (1240.0, 4400.0), (1250.0, 4400.0),
]

# Wind turbine power curve, (wind speed m/s, power kW), linear between knots,
# clamped at both ends; cut-out between 22.5 and 23 m/s.
WIND_CURVE = [
    (0.0, 0.0), (1.0, 0.0), (2.0, 0.0), (3.0, 0.0),
    (3.5, 8.0), (4.0, 35.0), (4.5, 77.0), (5.0, 137.0), (5.5, 217.0),
    (6.0, 321.0), (6.5, 450.0), (7.0, 607.0), (7.5, 793.0), (8.0, 1008.0),
    (8.5, 1250.0), (9.0, 1515.0), (9.5, 1685.0), (10.0, 1790.0),
    (10.5, 1790.0), (11.0, 1790.0), (11.5, 1790.0), (12.0, 1790.0),
    (12.5, 1790.0), (13.0, 1790.0), (13.5, 1790.0), (14.0, 1790.0),
    (14.5, 1790.0), (15.0, 1790.0), (15.5, 1790.0), (16.0, 1790.0),
    (16.5, 1790.0), (17.0, 1790.0), (17.5, 1790.0), (18.0, 1790.0),
    (18.5, 1790.0), (19.0, 1790.0), (19.5, 1790.0), (20.0, 1790.0),
    (20.5, 1790.0), (21.0, 1790.0), (21.5, 1790.0), (22.0, 1790.0),
    (22.5, 1790.0), (23.0, 0.0), (23.5, 0.0), (24.0, 0.0), (24.5, 0.0),
    (25.0, 0.0), (25.5, 0.0), (26.0, 0.0), (26.5, 0.0), (27.0, 0.0),
    (27.5, 0.0), (28.0, 0.0), (28.5, 0.0), (29.0, 0.0), (29.5, 0.0), (30.0, 0.0),
]
AIR_DENSITY_REF = 1.225          # kg/m3
SOLAR_CONSTANT = 1361.0          # W/m2
GRAVITY = 9.81                   # m/s2


def clip(x: str, lo: float, hi: float) -> str:
    return f"least(greatest({x}, {lo!r}), {hi!r})"


# --- solar geometry (Spencer series; day of year and clock hour) ----------------

def solar_gamma(doy: str) -> str:
    return f"(2.0 * pi() * ({doy} - 1) / 365.0)"


def declination(doy: str) -> str:
    g = solar_gamma(doy)
    return (f"(0.006918 - 0.399912 * cos({g}) + 0.070257 * sin({g}) - 0.006758 * cos(2.0 * {g}) "
            f"+ 0.000907 * sin(2.0 * {g}) - 0.002697 * cos(3.0 * {g}) + 0.00148 * sin(3.0 * {g}))")


def equation_of_time_min(doy: str) -> str:
    g = solar_gamma(doy)
    return (f"(229.18 * (0.000075 + 0.001868 * cos({g}) - 0.032077 * sin({g}) - 0.014615 * cos(2.0 * {g}) "
            f"- 0.040849 * sin(2.0 * {g})))")


def hour_angle(doy: str, hour: str) -> str:
    return f"radians(15.0 * (({hour}) + {equation_of_time_min(doy)} / 60.0 - 12.0))"


def sun_elevation_deg(doy: str, hour: str, lat: float) -> str:
    la = f"radians({lat!r})"
    d = declination(doy)
    s = f"(sin({la}) * sin({d}) + cos({la}) * cos({d}) * cos({hour_angle(doy, hour)}))"
    return f"degrees(asin({clip(s, -1.0, 1.0)}))"


def sun_azimuth_deg(doy: str, hour: str, lat: float) -> str:
    la = f"radians({lat!r})"
    d = declination(doy)
    h = hour_angle(doy, hour)
    a = f"degrees(atan2(sin({h}), cos({h}) * sin({la}) - tan({d}) * cos({la})))"
    return f"(((({a} + 180.0) % 360.0) + 360.0) % 360.0)"


def day_length_h(doy: str, lat: float) -> str:
    c = f"(-tan(radians({lat!r})) * tan({declination(doy)}))"
    return f"(2.0 * degrees(acos({clip(c, -1.0, 1.0)})) / 15.0)"


def clear_sky_irradiance(doy: str, elev_deg: str) -> str:
    ext = f"({SOLAR_CONSTANT!r} * (1.0 + 0.033 * cos(2.0 * pi() * {doy} / 365.0)))"
    e = f"radians(greatest({elev_deg}, 0.0))"
    return clip(f"{ext} * pow(sin({e}), 1.12) * 0.94", 0.0, 1250.0)


def transmittance(cloud: str) -> str:
    return f"(1.0 - 0.72 * pow({cloud}, 1.35))"


# --- wind ----------------------------------------------------------------------------

def density_factor(rho: str) -> str:
    return clip(f"{rho} / {AIR_DENSITY_REF!r}", 0.90, 1.10)


def yaw_efficiency(err_deg: str) -> str:
    return f"pow({clip(f'cos(radians({err_deg}))', 0.0, 1.0)}, 3)"


def pitch_efficiency(spread: str) -> str:
    return clip(f"1.0 - 0.012 * pow({spread}, 1.15)", 0.75, 1.0)


def pitch_spread(a: str, b: str, c: str) -> str:
    return f"greatest(abs({a} - {b}), abs({a} - {c}), abs({b} - {c}))"


def commanded_pitch(ws: str) -> str:
    return (f"CASE WHEN {ws} < 3.0 THEN 89.0 WHEN {ws} < 10.0 THEN 0.5 + 0.35 * ({ws} - 3.0) "
            f"WHEN {ws} < 15.0 THEN 3.0 + 1.6 * ({ws} - 10.0) WHEN {ws} < 20.0 THEN 11.0 + 2.6 * ({ws} - 15.0) "
            f"WHEN {ws} < 23.0 THEN 24.0 + 20.0 * ({ws} - 20.0) ELSE 89.0 END")


def rotor_speed_band(ws: str) -> str:
    return (f"CASE WHEN {ws} < 3.0 THEN 0.3 + 0.7 * {ws} WHEN {ws} < 10.0 THEN 4.0 + 1.7 * ({ws} - 3.0) "
            f"ELSE 15.8 + 0.08 * ({ws} - 10.0) END")


def air_density(pressure_hpa: str, temp_c: str) -> str:
    """Ideal gas, dry air: rho = p / (R_d * T)."""
    return f"(({pressure_hpa}) * 100.0 / (287.05 * (({temp_c}) + 273.15)))"


# --- pumps ---------------------------------------------------------------------------

def water_density(t: str) -> str:
    return f"(1000.0 * (1.0 - ((({t}) + 288.9414) / (508929.2 * (({t}) + 68.12963))) * pow(({t}) - 3.9863, 2)))"


def vapour_pressure_pa(t: str) -> str:
    return f"(pow(10.0, 8.07131 - 1730.63 / (233.426 + ({t}))) * 133.322368)"


def pump_curve_k(h0: str, h_bep: str, q_bep_m3h: str) -> str:
    return f"(({h0}) - ({h_bep})) / greatest(pow(({q_bep_m3h}) / 3600.0, 2), 1e-9)"


def pump_flow_m3s(h0: str, speed_ratio: str, static_head: str, k_pump: str, k_sys: str) -> str:
    return (f"sqrt(greatest(({h0}) * pow({speed_ratio}, 2) - ({static_head}), 0.0) / "
            f"greatest(({k_pump}) + ({k_sys}), 1e-9))")


def pump_efficiency(flow_m3s: str, q_bep_m3h: str, speed_ratio: str, eta_peak: str) -> str:
    q_bep = f"((({q_bep_m3h}) / 3600.0) * ({speed_ratio}))"
    ratio = f"(({flow_m3s}) / greatest({q_bep}, 1e-9))"
    eta = f"(({eta_peak}) * (1.0 - 0.26 * pow({ratio} - 1.0, 2)))"
    return f"least(greatest({eta}, 0.35), {eta_peak})"


def hydraulic_kw(rho: str, flow_m3h: str, head: str) -> str:
    return f"(({rho}) * {GRAVITY!r} * (({flow_m3h}) / 3600.0) * ({head}) / 1000.0)"


def motor_current_a(p_kw: str, volts: str, pf: str) -> str:
    return f"((({p_kw}) * 1000.0) / (sqrt(3.0) * ({volts}) * ({pf})))"


# --- curves as expressions -------------------------------------------------------
_CURVE_CALL = re.compile(r"solar_curve\((\w+)\)")


def _every(knots, step: float):
    """(value, rise per unit) of the curve at each multiple of ``step``."""
    xs, ys = zip(*knots)
    at = []
    for i in range(round(xs[-1] / step) + 1):
        x = i * step
        k = max(j for j in range(len(xs)) if xs[j] <= x)
        rise = (ys[k + 1] - ys[k]) / (xs[k + 1] - xs[k]) if k + 1 < len(xs) else 0.0
        at.append((ys[k] + rise * (x - xs[k]), rise))
    return at


_SOLAR_STEP = 10.0
_SOLAR_AT = _every(SOLAR_CURVE, _SOLAR_STEP)


def _solar_text(x: str, pick) -> str:
    clamped = f"least(greatest({x}, 0e0), {SOLAR_CURVE[-1][0]!r}e0)"
    place = f"CAST(floor({clamped} / {_SOLAR_STEP!r}e0) AS INT)"
    value = pick([v for v, _ in _SOLAR_AT], f"{place} + 1")
    rise = pick([r for _, r in _SOLAR_AT], f"{place} + 1")
    return f"({value} + {rise} * ({clamped} - {place} * {_SOLAR_STEP!r}e0))"


def for_spark(sql: str) -> str:
    """``solar_curve(column)`` as a lookup in a constant array."""
    def pick(values, i):
        return f"element_at(array({', '.join(f'{v!r}D' for v in values)}), {i})"
    return _CURVE_CALL.sub(lambda m: _solar_text(m[1], pick), sql)


def for_oracle(sql: str) -> str:
    """The same lookup in a DuckDB list."""
    def pick(values, i):
        return f"list_extract([{', '.join(f'CAST({v!r} AS DOUBLE)' for v in values)}], {i})"
    return _CURVE_CALL.sub(lambda m: _solar_text(m[1], pick), sql)
