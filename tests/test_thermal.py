"""Thermal expectations by hand, and the cumulative sum against a plain loop."""

import datetime as dt
import random

import pytest

from conftest import ts
from gridlens.operators import thermal as TH


def test_expected_temperatures_by_hand(spark):
    tel = spark.createDataFrame([("t", 10.0, 1000.0, 12.0, 1200.0, -8.0, 60.0, 60.0, 50.0, None)],
                                "device string, amb double, kw double, rotor double, gen double, yaw double, "
                                "gearbox_oil_temp double, generator_temp double, bearing_temp double, converter_temp double")
    got = {r["part"]: r for r in TH.residual_report(tel, TH.wind_thermal_expected("amb", "kw", "rotor", "gen", "yaw"), ["device"]).collect()}
    assert got["gearbox_oil_temp"]["mean_residual"] == pytest.approx(60 - (10 + 17 + 10 + 1.2))
    assert got["generator_temp"]["mean_residual"] == pytest.approx(60 - (10 + 20 + 14 + 0.96))
    assert got["bearing_temp"]["max_residual"] == pytest.approx(50 - (10 + 12 + 7 + 0.72 + 0.015 * 8 ** 1.7))
    assert got["gearbox_oil_temp"]["share_over"] == 1.0
    assert got["converter_temp"]["n"] == 0 and got["converter_temp"]["mean_residual"] is None
    pump = spark.createDataFrame([(20.0, 10.0, 1.2, 45.0)], "amb double, kw double, ratio double, seen double")
    r = TH.residual_report(pump, {"seen": TH.pump_bearing_expected("amb", "kw", "ratio")}, []).first()
    assert r["mean_residual"] == pytest.approx(45 - (20 + 16 + 5.5 + 5 * 0.2 ** 1.6))


def plain_cusum(rows):
    out, state = {}, {}
    for key, t, i, v in sorted(rows, key=lambda r: (str(r[0]), r[1], r[2])):
        total, low, since = state.get(key, (0, None, None))
        if low is None or total < low or (total == low and t < since):
            low, since = total, t
        total += v or 0
        state[key] = (total, low, since)
        out[i] = (max(total - low, 0), since)
    return out


@pytest.mark.parametrize("bucket", [None, 3600, 86400])
def test_cusum_equals_a_plain_loop(spark, bucket):
    rng = random.Random(4)
    rows = [(rng.choice(["a", "b", None]), ts("2024-01-01") + dt.timedelta(seconds=rng.randrange(0, 6 * 86400, 60)), i, rng.choice([None, -3, -2, -1, 1, 2, 3])) for i in range(500)]
    df = spark.createDataFrame(rows, "device string, time timestamp_ntz, id long, x long")
    got = {r["id"]: (r["cusum"], r["since"]) for r in TH.cusum(df, ["device"], "time", "x", ["id"], bucket).collect()}
    assert got == plain_cusum(rows)
    first = {r["device"]: r for r in TH.fleet_drift(df, ["device"], "time", "x", 12, ["id"], bucket).collect()}
    for k in first:
        hits = [(t, i) for key, t, i, _ in rows if key == k and got[i][0] > 12]
        assert (first[k]["alarm_time"], first[k]["drift_start"], first[k]["cusum"]) == (min(hits)[0], got[min(hits)[1]][1], got[min(hits)[1]][0])
