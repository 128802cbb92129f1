"""``python -m gridloom.cli LAYER [--cycle YYYYMMDDTHH] [--dry-run DIR] [--allow-member-drift]``: build, check and publish a run."""

from __future__ import annotations

import argparse
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from gridloom import catalog
from gridloom.operators.checks import validate
from gridloom.operators.codec import build_tiles, run_header
from gridloom.operators.publishing import PublishError, Run, now_iso, publish
from gridloom.session import local_session, ship
from gridloom.sources import clients, grib, http, layers, providers, stores
from gridloom.sources.providers import CycleNotAvailable


@dataclass
class Built:
    run: Run
    cells: DataFrame
    lat0: float
    lon0: float
    dlat: float
    dlon: float
    nlat: int
    nlon: int
    kept: list[DataFrame] = field(default_factory=list)  # what was downloaded, to be given up when the run is done


@dataclass(frozen=True)
class Web:
    """How files and messages are reached."""

    probe: Callable[[str], bool] = http.exists
    get: Callable[[str], bytes] = http.fetch
    get_range: Callable[[str, int, int | None], bytes] = http.fetch_range
    message: Callable = grib.eccodes_message


def _grid(cells: DataFrame) -> dict:
    from pyspark.sql import functions as F

    g = cells.agg(F.min("lat").alias("lat0"), F.min("lon").alias("lon0"), F.max("i").alias("i"), F.max("j").alias("j"), F.max("lat").alias("lat1"), F.max("lon").alias("lon1")).first()
    return {"lat0": g["lat0"], "lon0": g["lon0"], "dlat": (g["lat1"] - g["lat0"]) / max(1, g["i"]), "dlon": (g["lon1"] - g["lon0"]) / max(1, g["j"]), "nlat": g["i"] + 1, "nlon": g["j"] + 1}


def build(layer: str, cycle: datetime | None, allow_drift: bool = False, web: Web = Web()) -> Built:  # noqa: B008
    """A layer from its provider; needs the network and the provider's client or decoder.

    What is downloaded stays on the executors' disks until the run is done, so that each message is
    fetched once however often it is read; what a lost executor held is fetched again.
    """
    spark = ship(local_session())
    model, degrees, _, _, _ = catalog.LAYERS[layer]
    provenance = dict(providers.SOURCES[layer])
    members: list[str] | None = None
    kept: list[DataFrame] = []

    def keep(fetched: DataFrame) -> DataFrame:
        kept.append(fetched.persist(StorageLevel.DISK_ONLY))
        return kept[-1]

    if layer == "currents":
        cycle = providers.resolve(layer, cycle)
        try:
            cells = layers.surface_currents(keep(clients.currents_grid(spark, cycle)), cycle)
            provenance["dataset_id"] = clients.CURRENTS_DATASET
        except Exception as e:  # whatever keeps the first source away, the second is tried
            print(f"{layer}: {type(e).__name__}: {e}; trying the fallback")
            provenance["fallback"] = f"CMEMS unavailable: {type(e).__name__}: {e}"
            providers.resolve_rtofs(cycle)
            cells = layers.rtofs_cells()
    elif layer == "weather-ecmwf":
        client = clients.open_data_client()
        cycle = providers.resolve_open_data(clients.latest_open_data(client), cycle)
        fields = keep(clients.open_data_fields(spark, cycle, client))
        cells = layers.open_data_cells(fields)
        gust = fields.where(providers.kind_of(fields["short_name"]) == "gust").select("short_name").first()
        provenance["gust"] = gust["short_name"] if gust else "unavailable — wind-only run"
    else:
        cycle = providers.resolve(layer, cycle, web.probe)
        members = providers.available_members(cycle, web.probe) if layer == "ensemble" else None
        gusts = members is not None and providers.gust_available(cycle, lambda url: web.get(url).decode())
        plan = layers.download_plan(spark, layer, cycle, members, gusts)
        fields = grib.decode_messages(keep(layers.download(plan, web.get, web.get_range)), web.message)
        if members is None:
            cells = layers.backfilled(layers.named_cells(fields, layer), layer)
        else:
            cells = layers.ensemble_cells(fields, len(members), allow_drift, fields.where("var = 'GUST'") if gusts else None)
            provenance["source"] += " + pgrb2bp5 gust" if gusts else ""
            provenance |= {"members": members, "gust": "included" if gusts else "unavailable in pgrb2b .idx — wind-only run"}
        provenance["source_urls_digest"] = layers.plan_digest(plan)
    have = {r[0] for r in cells.select("variable").distinct().collect()}
    provenance["fetched_at"] = now_iso()
    variables = [v for v in catalog.VARIABLES[layer] if v.name in have or not v.optional]
    run = Run(layer, model, cycle, degrees, catalog.axes(layer), variables, len(members) if members else 1, provenance)
    return Built(run, cells, **_grid(cells), kept=kept)


def main(argv: list[str] | None = None, build: Callable[..., Built] = build) -> int:
    """0: published, or weather-ecmwf is not there yet; 1: no cycle, failed checks or a failed publication."""
    parser = argparse.ArgumentParser(prog="gridloom", description=__doc__)
    parser.add_argument("layer", choices=list(catalog.LAYERS))
    parser.add_argument("--cycle", type=providers.parse_cycle)
    parser.add_argument("--dry-run", metavar="DIR", help="a folder instead of the bucket")
    parser.add_argument("--allow-member-drift", action="store_true")
    args = parser.parse_args(argv)
    try:
        built = build(args.layer, args.cycle, args.allow_member_drift)
    except CycleNotAvailable as e:
        print(f"{args.layer}: {e}")
        return 0 if args.layer == "weather-ecmwf" else 1
    run = built.run
    cells = built.cells.cache()  # the checks and the tiles read it
    try:
        report = validate(cells, run.variables, run.axes, built.nlat, built.nlon, run.members, catalog.LAYERS[args.layer][3])
        print(report.summary())
        if not report.ok:
            return 1
        header = run_header(run.layer, run.model, run.run_id, run.cycle_iso, built.dlat, built.dlon, run.axes, run.variables, run.members, now_iso(), run.provenance)
        tiles = build_tiles(cells, run.variables, header).select("tile_id", "gz").cache()
        store = stores.FolderStore(args.dry_run) if args.dry_run else stores.store_from_env()
        done = publish(store, run, tiles, report, stores.max_bytes_from_env())
    except PublishError as e:
        print(f"{args.layer}: not published: {e}")
        return 1
    finally:
        for x in (cells, *built.kept):
            x.unpersist()
    print(f"{args.layer}: {done}")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
