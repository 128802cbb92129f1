"""Where the layers' files are, and which cycle of a layer is complete. Probes are arguments, so this runs without a network."""

from __future__ import annotations

from collections.abc import Callable
from datetime import UTC, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridloom import catalog
from gridloom.sources.http import exists

#: Stores of the providers and the names of their files.
GFS = "https://noaa-gfs-bdp-pds.s3.amazonaws.com"
GEFS = "https://noaa-gefs-pds.s3.amazonaws.com"
RTOFS = "https://noaa-nws-rtofs-pds.s3.amazonaws.com"
TEMPLATES = {
    "weather": GFS + "/gfs.{date}/{hh}/atmos/gfs.t{hh}z.pgrb2.0p25.f{step:03d}",
    "waves": GFS + "/gfs.{date}/{hh}/wave/gridded/gfswave.t{hh}z.global.0p25.f{step:03d}.grib2",
    "ensemble": GEFS + "/gefs.{date}/{hh}/atmos/pgrb2ap5/{member}.t{hh}z.pgrb2a.0p50.f{step:03d}",
    "ensemble-gust": GEFS + "/gefs.{date}/{hh}/atmos/pgrb2bp5/{member}.t{hh}z.pgrb2b.0p50.f{step:03d}",
    "rtofs": RTOFS + "/rtofs.{date}/rtofs_glo_2ds_f{step:03d}_prog.nc",
}
#: Ensemble members, the names under which gusts come, the longest look-back in cycles.
MEMBERS = ["gec00", *(f"gep{m:02d}" for m in range(1, 31))]
GUST_PARAMS = ("10fg", "10fg3", "10fg6")
GUST_NAMES = ("10fg", "fg10", "10fg3", "10fg6", "gust", "i10fg", "p10fg")
LOOK_BACK, RTOFS_LOOK_BACK = 8, 3
AUTH_WAITS_S = (300, 900)
#: What a run says of where it comes from.
SOURCES = {
    "weather": {"source": "NOAA GFS 0.25deg (noaa-gfs-bdp-pds)"},
    "waves": {"source": "NOAA GFS-Wave 0.25deg (noaa-gfs-bdp-pds)"},
    "ensemble": {"source": "NOAA GEFS 0.5deg (noaa-gefs-pds), pgrb2ap5 wind"},
    "currents": {
        "source": "Copernicus Marine GLOBAL_ANALYSISFORECAST_PHY_001_024",
        "attribution": "E.U. Copernicus Marine Service Information; doi:10.48670/moi-00016",
        "tidal_caveat": "instantaneous model currents, not tidal stream predictions",
    },
    "weather-ecmwf": {"source": "ECMWF open data IFS 0.25deg (CC BY 4.0)"},
}


class CycleNotAvailable(RuntimeError):
    pass


def url(kind: str, cycle: datetime, step: int, member: str = "") -> str:
    return TEMPLATES[kind].format(date=f"{cycle:%Y%m%d}", hh=f"{cycle:%H}", step=step, member=member)


def url_column(kind: str, cycle: Column, step: Column, member: Column | None = None) -> Column:
    """The same as a column, for plans of (cycle, step, member) rows."""
    out, rest = [], TEMPLATES[kind]
    parts = {"{date}": F.date_format(cycle, "yyyyMMdd"), "{hh}": F.date_format(cycle, "HH"), "{step:03d}": F.format_string("%03d", step), "{member}": member}
    while rest:
        at, key = min(((rest.find(k), k) for k in parts if k in rest), default=(-1, ""))
        if at < 0:
            out.append(F.lit(rest))
            break
        out += [F.lit(rest[:at]), parts[key]]
        rest = rest[at + len(key) :]
    return F.concat(*out)


def urls_digest(url: Column) -> Column:
    """An aggregate over a run's URLs, which are few: the first 16 hex digits of SHA-256 over them, sorted, each once and with a line feed behind it."""
    lines = F.concat(F.array_join(F.array_sort(F.collect_set(url)), "\n"), F.lit("\n"))
    return F.substring(F.sha2(lines, 256), 1, 16)


def floor_to_cycle(at: datetime, cadence_h: int = 6) -> datetime:
    return at.replace(hour=at.hour // cadence_h * cadence_h, minute=0, second=0, microsecond=0)


def parse_cycle(text: str) -> datetime:
    return datetime.strptime(text, "%Y%m%dT%H").replace(tzinfo=UTC)


def _last_index(layer: str) -> Callable[[datetime], str]:
    step = max(h[-1] for h in catalog.axes(layer).values())
    member = MEMBERS[-1] if layer == "ensemble" else ""
    return lambda cycle: url(layer, cycle, step, member) + ".idx"


def resolve(layer: str, requested: datetime | None = None, probe: Callable[[str], bool] = exists, now: datetime | None = None) -> datetime:
    """The cycle asked for, if its last step is there; else the newest complete one of the last few. Never a partial one."""
    now = now or datetime.now(UTC)
    if layer == "currents":
        return requested or now.replace(hour=0, minute=0, second=0, microsecond=0)
    last = _last_index(layer)
    cycles = [requested] if requested else [floor_to_cycle(now) - timedelta(hours=6 * k) for k in range(LOOK_BACK)]
    for cycle in cycles:
        if probe(last(cycle)):
            return cycle
    raise CycleNotAvailable(f"{layer}: no complete cycle among {cycles[0]:%Y%m%dT%H}Z..{cycles[-1]:%Y%m%dT%H}Z")


def resolve_rtofs(requested: datetime | None = None, probe: Callable[[str], bool] = exists, now: datetime | None = None) -> datetime:
    """As resolve, by days; the regridding of this source's curvilinear grid is not supported."""
    today = (now or datetime.now(UTC)).replace(hour=0, minute=0, second=0, microsecond=0)
    step = catalog.axes("currents")["steps"][-1]
    for cycle in [requested] if requested else [today - timedelta(days=k) for k in range(RTOFS_LOOK_BACK)]:
        if probe(url("rtofs", cycle, step)):
            return cycle
    raise CycleNotAvailable("rtofs: no complete cycle")


def resolve_open_data(latest: datetime, requested: datetime | None = None) -> datetime:
    """weather-ecmwf: the newest cycle that its client reports with the last step, or an older one asked for."""
    latest = latest if latest.tzinfo else latest.replace(tzinfo=UTC)
    if requested and requested > latest:
        raise CycleNotAvailable(f"{requested:%Y%m%dT%H}Z is not there yet; the latest is {latest:%Y%m%dT%H}Z")
    return requested or latest


def available_members(cycle: datetime, probe: Callable[[str], bool] = exists) -> list[str]:
    """Members whose last step is there, in their order."""
    step = catalog.axes("ensemble")["steps"][-1]
    return [m for m in MEMBERS if probe(url("ensemble", cycle, step, m) + ".idx")]


def gust_available(cycle: datetime, read_index: Callable[[str], str]) -> bool:
    """Whether the control member's second and last steps list surface gusts; any failure is a no."""
    steps = catalog.axes("ensemble")["steps"]
    try:
        return all(":GUST:surface:" in read_index(url("ensemble-gust", cycle, s, MEMBERS[0]) + ".idx") for s in (steps[1], steps[-1]))
    except Exception:
        return False


def probe_gust_param(retrievable: Callable[[str], bool]) -> str | None:
    """The first of the gust parameters that can be had."""
    return next((p for p in GUST_PARAMS if retrievable(p)), None)


def kind_of(short_name: Column) -> Column:
    """u, v, gust or the name itself."""
    return F.when(short_name == "10u", "u").when(short_name == "10v", "v").when(F.lower(short_name).isin(*GUST_NAMES), "gust").otherwise(short_name)


def step_of_range(step_range: Column) -> Column:
    """The end of "a-b", or the step itself."""
    return F.element_at(F.split(step_range, "-"), -1).cast("int")


def with_auth_retries(opened: Callable[[], object], is_auth: Callable[[Exception], bool], sleep: Callable[[float], None]):
    """What opened() gives; failures to authenticate are tried again after 300 and 900 seconds, others raise at once."""
    for wait in (*AUTH_WAITS_S, None):
        try:
            return opened()
        except Exception as e:
            if wait is None or not is_auth(e):
                raise
            sleep(wait)
    raise AssertionError("no try")
