import numpy as np
import pytest
from cubes import COLS, ENSEMBLE, ENSEMBLE_AXES, HALF, MEMBERS, ROWS, WEATHER, WEATHER_AXES, cells_of, ensemble_arrays, weather_arrays

from gridloom.catalog import Variable
from gridloom.operators import axes, ensemble
from gridloom.operators.checks import validate


def weather_report(spark, change=None, axes_=WEATHER_AXES, **kw):
    arrays = weather_arrays()
    if change:
        change(arrays)
    used = {v.name: v.axis for v in WEATHER}
    cells = cells_of(spark, arrays, used, {**WEATHER_AXES, **{k: h if len(h) == len(WEATHER_AXES[k]) else WEATHER_AXES[k] for k, h in axes_.items()}})
    return validate(cells, WEATHER, axes_, ROWS, COLS, **kw)


def test_good_run_passes_in_order(spark):
    report = weather_report(spark, expected_axes=WEATHER_AXES)
    assert report.ok, report.summary()
    assert report.passed[:4] == ["axis_monotonic[hourly]", "axis_monotonic[h3]", "axis_complete[hourly]", "axis_complete[h3]"]
    assert report.passed[4:7] == ["step_coverage[wind_u_kt]", "physical_range[wind_u_kt]", "missing_fraction[wind_u_kt]"]
    assert report.passed[-1] == "gust_ge_wind[gust_kt]"


def wild(a):
    a["wind_u_kt"][1, 1, 1] = 500


def calm(a):
    a["gust_kt"] -= 10


def blind(a):
    a["visibility_m"][:, :2] = np.nan


def gone(a):
    del a["visibility_m"]


def short(a):
    a["wind_v_kt"] = a["wind_v_kt"][:2]


@pytest.mark.parametrize(("change", "name"), [(wild, "physical_range[wind_u_kt]"), (calm, "gust_ge_wind[gust_kt]"), (blind, "missing_fraction[visibility_m]"), (gone, "present[visibility_m]"), (short, "step_coverage[wind_v_kt]")])
def test_bad_runs_fail_by_name(spark, change, name):
    report = weather_report(spark, change)
    assert any(f.startswith(name) for f in report.failures), report.failures
    assert not any(name in p for p in report.passed)


def test_axes_are_checked(spark):
    assert any(f.startswith("axis_monotonic[hourly]") for f in weather_report(spark, axes_={"hourly": [0, 2, 1, 4], "h3": [0, 3, 6]}).failures)
    assert [f.split(":")[0] for f in weather_report(spark, expected_axes={"h3": [0, 3, 6, 9]}).failures] == ["axis_complete[h3]"]


def ensemble_report(spark, members=MEMBERS, change=None):
    arrays, variables = ensemble_arrays(), list(ENSEMBLE)
    if change:
        variables += change(arrays)
    return validate(cells_of(spark, arrays, {v.name: "steps" for v in variables}, ENSEMBLE_AXES), variables, ENSEMBLE_AXES, ROWS, HALF, members)


def test_members_are_counted(spark):
    assert "member_count" in ensemble_report(spark).passed
    assert {f.split(":")[0] for f in ensemble_report(spark, 31).failures} == {"step_coverage[wind_kt_anom]", "member_count"}


def test_gust_means_and_anomalies(spark):
    def low_gusts(a):
        a["gust_kt_mean"] = a["wind_kt_mean"] - 5
        return [Variable("gust_kt_mean", "steps", "i16", 0.01)]

    def wide(a):
        a["wind_kt_anom"][0, 0, 0, 0] = 30
        return []

    assert [f.split(":")[0] for f in ensemble_report(spark, change=low_gusts).failures] == ["gust_ge_wind[gust_kt_mean]"]
    assert [f.split(":")[0] for f in ensemble_report(spark, change=wide).failures] == ["physical_range[wind_kt_anom]"]


def test_mean_needs_every_member(spark):
    rows = [(0, 0, m, v) for m, v in enumerate([10.0, 20.0, 30.0])] + [(0, 1, 0, 5.0), (0, 1, 1, None), (0, 2, 0, 0.0), (0, 2, 1, 100.0)]
    found = ensemble.mean_and_anomaly(spark.createDataFrame(rows, "step_h int, i int, member int, value float"), ["step_h", "i"])
    by = {(r["i"], r["member"]): (r["mean"], r["anom"]) for r in found.collect()}
    assert by[0, 0] == (20.0, -10.0) and by[1, 0] == (None, None) and by[2, 1] == (50.0, 25.0)
    assert ensemble.reconstruct(found).where("i = 0 and abs(speed - value) > 1e-3").count() == 0
    assert {r["i"]: r["complete"] for r in ensemble.ensemble_mean(found, ["step_h", "i"]).collect()} == {0: True, 1: False, 2: True}


def test_axis_rows(spark):
    rows = spark.createDataFrame([("a", [0, 1, 2]), ("b", [0, 2, 1])], "axis string, offsets_h array<int>")
    assert {r["axis"]: r["monotonic"] for r in axes.monotonic(axes.exploded(rows)).collect()} == {"a": True, "b": False}
    wanted = spark.createDataFrame([("a", [0, 1, 2]), ("c", [0])], "axis string, offsets_h array<int>")
    assert {r["axis"]: r["complete"] for r in axes.complete(rows, wanted).collect()} == {"a": True, "c": False}
    assert [r[0] for r in axes.union_of(rows).collect()] == [0, 1, 2]
    segments = spark.createDataFrame([("a", 0, 0, 10), ("a", 1, 10, 20), ("a", 2, 21, 30)], "axis string, seg int, first int, last int")
    assert [r["seg"] for r in axes.overlaps(segments).collect()] == [1]
