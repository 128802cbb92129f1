from datetime import UTC, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom import catalog
from gridloom.operators import scaffold
from gridloom.sources import clients, grib, http, index_files, layers, providers
from gridloom.sources.providers import CycleNotAvailable

NOW = datetime(2026, 7, 13, 14, 30, tzinfo=UTC)
INDEX = ["1:0:d=2026071306:UGRD:10 m above ground:3 hour fcst:", "2:120000:d=2026071306:VGRD:10 m above ground:3 hour fcst:", "3:240000:d=2026071306:GUST:surface:3 hour fcst:", "", "4:361234:d=2026071306:GUST:surface:3 hour fcst:"]


def test_index_ranges(spark):
    lines = spark.createDataFrame([("f", k, x) for k, x in enumerate(INDEX)], "file string, line_no int, value string")
    index = index_files.parse_index(lines)
    assert [tuple(r) for r in index.orderBy("line_no").select("var", "start", "end").collect()] == [("UGRD", 0, 120000), ("VGRD", 120000, 240000), ("GUST", 240000, 361234), ("GUST", 361234, None)]
    wanted = spark.createDataFrame([("GUST", "surface", False), ("APCP", "surface", True)], "var string, level string, optional boolean")
    found = {r["var"]: (r["start"], r["end"]) for r in index_files.wanted_ranges(index, wanted).collect()}
    assert found == {"GUST": (240000, 361234), "APCP": (None, None)}


def test_cycles_are_complete_or_older():
    there = {providers.url("weather", datetime(2026, 7, 13, 6, tzinfo=UTC), 240) + ".idx"}
    assert providers.resolve("weather", probe=there.__contains__, now=NOW) == datetime(2026, 7, 13, 6, tzinfo=UTC)
    with pytest.raises(CycleNotAvailable):
        providers.resolve("weather", probe=lambda u: False, now=NOW)
    with pytest.raises(CycleNotAvailable):
        providers.resolve("weather", datetime(2026, 7, 13, 12, tzinfo=UTC), probe=there.__contains__)
    assert providers.resolve("currents", now=NOW) == datetime(2026, 7, 13, tzinfo=UTC)
    day = providers.url("rtofs", datetime(2026, 7, 12, tzinfo=UTC), 240)
    assert providers.resolve_rtofs(probe=day.__eq__, now=NOW) == datetime(2026, 7, 12, tzinfo=UTC)
    with pytest.raises(CycleNotAvailable):
        providers.resolve_open_data(NOW, NOW + timedelta(hours=6))
    assert providers.floor_to_cycle(NOW).hour == 12 and providers.parse_cycle("20260713T06") == datetime(2026, 7, 13, 6, tzinfo=UTC)


def test_urls(spark):
    cycle = datetime(2026, 7, 13, 6, tzinfo=UTC)
    text = providers.url("waves", cycle, 9)
    assert text.endswith("/gfs.20260713/06/wave/gridded/gfswave.t06z.global.0p25.f009.grib2")
    column = providers.url_column("waves", F.lit("2026-07-13 06:00:00").cast("timestamp"), F.lit(9))
    assert spark.range(1).select(column).first()[0] == text
    assert len(providers.MEMBERS) == 31 and providers.MEMBERS[-1] == "gep30"


def test_members_and_gusts():
    cycle = datetime(2026, 7, 13, 6, tzinfo=UTC)
    assert providers.available_members(cycle, lambda u: "gep07" not in u) == [m for m in providers.MEMBERS if m != "gep07"]
    assert providers.gust_available(cycle, lambda u: "\n".join(INDEX))
    assert not providers.gust_available(cycle, lambda u: "1:0:d=x:UGRD:surface::")
    assert providers.probe_gust_param(lambda p: p != "10fg") == "10fg3" and providers.probe_gust_param(lambda p: False) is None


def test_retries():
    waits, calls = [], []

    class Answer:
        status = 200

        def __enter__(self):
            return self

        def __exit__(self, *a):
            return False

        def read(self):
            return b"ok"

    def flaky(request):
        calls.append(request)
        if len(calls) < 3:
            raise OSError("down")
        return Answer()

    assert http.fetch_range("http://h/x", 5, 9, opener=flaky, sleep=waits.append) == b"ok"
    assert waits == [2, 4] and calls[0].headers["Range"] == "bytes=5-8"
    assert http.exists("http://h", opener=lambda r: Answer()) and not http.exists("http://h", opener=lambda r: 1 / 0)
    slept, tries = [], iter([ValueError("auth"), ValueError("auth"), None])

    def opened():
        e = next(tries)
        if e:
            raise e
        return "data"

    assert providers.with_auth_retries(opened, lambda e: "auth" in str(e), slept.append) == "data" and slept == [300, 900]
    with pytest.raises(KeyError):
        providers.with_auth_retries(lambda: {}["x"], lambda e: False, slept.append)


KEYS = {"Ni": 4, "Nj": 3, "latitudeOfFirstGridPointInDegrees": 90.0, "latitudeOfLastGridPointInDegrees": 88.0, "longitudeOfFirstGridPointInDegrees": 0.0, "iDirectionIncrementInDegrees": 90.0, "jDirectionIncrementInDegrees": 1.0, "jScansPositively": 0}


def test_fields_are_turned_and_rolled(spark):
    values = np.arange(12.0)
    values[0] = 1e20
    field, lat, lon = grib.normalised(KEYS, values)
    assert lat.tolist() == [88, 89, 90] and lon.tolist() == [-180, -90, 0, 90]
    assert field[0].tolist() == [10, 11, 8, 9] and np.isnan(field[2, 2])
    messages = spark.createDataFrame([("UGRD", "10 m above ground", 3, None, bytearray(b"m"))], "var string, level string, step_h int, member int, message binary")
    cells = grib.decode_messages(messages, lambda data: (KEYS, values))
    assert cells.where("value is null").count() == 1 and cells.count() == 12
    named = layers.named_cells(cells, "weather")
    assert abs(named.where("i = 0 and j = 1").first()["value"] - 11 * 1.943844) < 1e-4


def test_messages_are_split():
    message = lambda n: b"GRIB" + bytes(4) + n.to_bytes(8, "big") + bytes(n - 16)
    assert [len(m) for m in grib.split_messages(b"xx" + message(20) + message(33))] == [20, 33]


def test_download_plan_and_ranges(spark):
    cycle = datetime(2026, 7, 13, 6, tzinfo=UTC)
    plan = layers.download_plan(spark, "weather", cycle)
    assert plan.count() == 161 * 3 + 81 * 5
    wind = plan.where("step_h = 3 and var in ('UGRD', 'VGRD', 'APCP')")
    found = layers.download(wind, get=lambda u: "\n".join(INDEX).encode(), get_range=lambda u, a, b: f"{a}-{b}".encode())
    assert {r["var"]: bytes(r["message"]) for r in found.collect()} == {"UGRD": b"0-120000", "VGRD": b"120000-240000"}
    with pytest.raises(Exception, match="has no VIS"):
        layers.download(plan.where("step_h = 3 and var = 'VIS'"), get=lambda u: "\n".join(INDEX).encode(), get_range=lambda u, a, b: b"").collect()


def test_scaffold(spark):
    dense = scaffold.scaffold(spark.createDataFrame([(0,), (3,)], "step_h int"), spark.createDataFrame([("u",), ("v",)], "var string"))
    found = spark.createDataFrame([(0, "u", 1.0), (3, "u", 2.0), (0, "v", 3.0)], "step_h int, var string, x double")
    assert scaffold.filled(dense, found, ["step_h", "var"]).where("x is null").count() == 1
    with pytest.raises(LookupError, match="steps"):
        scaffold.require_nothing(scaffold.missing(dense, found, ["step_h", "var"]), "steps")


def fields(spark, steps, gust_from=3):
    rows = [(n, f"{max(0, s - 3)}-{s}" if n == "10fg3" else str(s), 0, 0, 40.0, -10.0, 5.0) for s in steps for n in ("10u", "10v", "10fg3") if n != "10fg3" or s >= gust_from]
    return spark.createDataFrame(rows, "short_name string, step_range string, i int, j int, lat double, lon double, value float")


def test_open_data_gates(spark):
    steps = catalog.axes("weather-ecmwf")["steps"]
    assert layers.open_data_cells(fields(spark, steps)).where("variable = 'gust_kt'").count() == len(steps)
    assert layers.open_data_cells(fields(spark, steps, gust_from=6)).where("variable = 'gust_kt'").count() == 0
    with pytest.raises(CycleNotAvailable):
        layers.open_data_cells(fields(spark, steps[:-1]))


def test_ensemble_from_members(spark):
    rows = [(v, "10 m above ground", s, m, 0, 0, 40.0, -10.0, float(3 + m if v == "UGRD" else 4)) for v in ("UGRD", "VGRD") for s in (0, 3) for m in range(3)]
    f = spark.createDataFrame(rows, "var string, level string, step_h int, member int, i int, j int, lat double, lon double, value float")
    cells = layers.ensemble_cells(f, 3, allow_drift=True)
    assert cells.where("variable = 'wind_kt_mean'").count() == 2 and cells.where("variable = 'wind_kt_anom'").count() == 6
    with pytest.raises(CycleNotAvailable):
        layers.ensemble_cells(f, 3)


def test_surface_currents(spark):
    cycle = datetime(2026, 7, 13, tzinfo=UTC)
    rows = [(cycle + timedelta(hours=s), k, 0, 0, -80.0, -180.0, 1.0, float("nan")) for s in catalog.axes("currents")["steps"] for k in (0, 1)]
    schema = "time timestamp, depth_idx int, i int, j int, lat double, lon double, uo float, vo float"
    cells = layers.surface_currents(spark.createDataFrame(rows, schema), cycle)
    assert cells.count() == 82 and cells.where("variable = 'cur_v_kt' and value is null").count() == 41
    with pytest.raises(LookupError):
        layers.surface_currents(spark.createDataFrame(rows[4:], schema), cycle)
    with pytest.raises(NotImplementedError):
        layers.rtofs_cells()


def fake_ocean():
    class FakeOcean(dict):
        """A dataset of two rows and columns with the methods that are used."""

        def __init__(self, times):
            axis = lambda x: type("A", (), {"values": np.array(x)})
            super().__init__(time=axis(times), latitude=axis([-80.0, -79.0]), longitude=axis([0.0, 1.0]), uo=axis([[1.0, 2.0], [3.0, np.nan]]), vo=axis([[0.0, 0.0], [0.0, 1.0]]))

        def sel(self, time):
            return self

        def isel(self, depth):
            return self

    return FakeOcean


def test_ocean_toolbox(spark):
    cycle = datetime(2026, 7, 13, tzinfo=UTC)
    times = [np.datetime64("2026-07-13T00", "ns") + np.timedelta64(s, "h") for s in catalog.axes("currents")["steps"]]
    tries, FakeOcean = [], fake_ocean()

    def opened(t=times):
        tries.append(1)
        if len(tries) == 1:
            raise ConnectionError("authentication service is down")
        return FakeOcean(t)

    cells = layers.surface_currents(clients.currents_grid(spark, cycle, opened, lambda s: None), cycle)
    assert cells.count() == 41 * 8 and cells.where("value is null").count() == 41
    with pytest.raises(LookupError):
        layers.surface_currents(clients.currents_grid(spark, cycle, lambda: FakeOcean(times[:-1])), cycle)
    assert not clients.is_auth_failure(ValueError("shape"))


def test_open_data_service(spark):
    steps = catalog.axes("weather-ecmwf")["steps"]

    class Client:
        def latest(self, **kw):
            return datetime(2026, 7, 13, 0)

        def retrieve(self, step, param, target, **kw):
            if "10fg" in param:
                raise OSError("no such parameter")
            with open(target, "wb") as f:
                for p in param:
                    for s in step:
                        body = f"{p}|{s}".encode()
                        f.write(b"GRIB" + bytes(4) + (16 + len(body)).to_bytes(8, "big") + body)

    def message(data):
        name, s = data[16:].decode().split("|")
        return name, s, KEYS, np.arange(12.0)

    cycle = clients.latest_open_data(Client())
    cells = layers.open_data_cells(clients.open_data_fields(spark, cycle, Client(), message))
    assert cells.where("variable = 'gust_kt'").count() == len(steps) * 12 and cells.where("variable = 'gust_kt' and value is null").count() == 12
    with pytest.raises(CycleNotAvailable):
        clients.latest_open_data(object())
