"""Overlay registry and window modes."""

import pytest
from pyspark.sql import functions as F

from gridlens.operators import overlay as OV


def test_unknown_type_is_an_error(spark):
    ev = spark.createDataFrame([("soiling",), ("meteor",)], "event_type string")
    with pytest.raises(ValueError, match="meteor"):
        OV.check_types(ev, "solar")
    OV.check_types(spark.createDataFrame([("soiling",)], "event_type string"), "solar")


def test_outside_window_modes(spark):
    df = spark.createDataFrame([(900.0, 3000.0, 40.0, 0.9, 0.0), (900.0, 3000.0, 40.0, 0.9, 1.0)],
                               "irradiance double, active_power double, module_temp double, performance_ratio double, sev_soiling double")
    power = "irradiance * 3.52e0"
    none = OV.overlay(df, "solar", ["soiling"], power).collect()
    ref = OV.overlay(df, "solar", ["soiling"], power, outside_window="reference").collect()
    assert none[0]["irradiance"] == 900.0                       # healthy row untouched
    assert ref[0]["irradiance"] == pytest.approx(900.0 * 0.97)  # whole-table 3 % base loss
    assert none[1]["irradiance"] == pytest.approx(900.0 * (1 - 0.17))
    assert none[1]["active_power"] == pytest.approx(900.0 * 0.83 * 3.52)


def test_pump_effects_recompute_chain(spark):
    df = spark.createDataFrame([(1000.0, 90.0, 45.0, 0.8, 0.93, 400.0, 0.86, 1.0, 3.0, 2.0, 2.0, 50.0, 0.0, 0.0, 0.5)],
                               "fluid_density double, flow_m3h double, differential_head_m double, efficiency double, "
                               "motor_efficiency double, line_voltage double, power_factor double, suction_abs_pressure_bar double, "
                               "npsha_m double, npshr_m double, vibration_mm_s double, bearing_temp_c double, "
                               "sev_cavitation double, sev_impeller_wear double, sev_bearing_friction double")
    df = df.withColumn("shaft_power_kw", F.lit(10.0)).withColumn("motor_power_kw", F.lit(11.0)).withColumn(
        "motor_current_a", F.lit(20.0)).withColumn("cavitation_margin_m", F.lit(1.0)).withColumn(
        "hydraulic_power_kw", F.lit(8.0)).withColumn("discharge_pressure_bar", F.lit(5.0))
    r = OV.overlay(df, "pump", ["cavitation", "impeller_wear", "bearing_friction"]).first()
    assert r["shaft_power_kw"] == pytest.approx(10.0 * (1.06 + 0.14 * 0.5))
    assert r["motor_power_kw"] == pytest.approx(r["shaft_power_kw"] / 0.93)
    assert r["bearing_temp_c"] == pytest.approx(50.0 + 5 + 11 * 0.5)


def test_finish_table_night_mask_and_bounds(spark):
    from gridlens.operators.clean import finish_table, SOLAR_BOUNDS, SOLAR_NIGHT_COLS, WIND_BOUNDS
    df = spark.createDataFrame([(0.2, 500.0, 5000.0, 1.23456, 370.5), (30.0, 0.3, 10.0, 0.5, -10.0),
                                (30.0, 800.0, 5000.0, 1.23456, 370.5)],
                               "sun_elevation double, irradiance double, active_power double, performance_ratio double, sun_azimuth double")
    r = finish_table(df, SOLAR_BOUNDS, SOLAR_NIGHT_COLS).collect()
    assert r[0]["active_power"] == 0.0 and r[0]["irradiance"] == 0.0          # sun below 0.5 deg
    assert r[1]["active_power"] == 0.0                                          # irradiance below 0.5
    assert r[2]["active_power"] == 4400.0 and r[2]["performance_ratio"] == 1.05 and r[2]["sun_azimuth"] == 10.5
    w = spark.createDataFrame([(-5.0, 725.0)], "nacelle_direction double, active_power double")
    assert finish_table(w, WIND_BOUNDS).first()["nacelle_direction"] == 355.0
