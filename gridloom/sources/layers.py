"""Layers from decoded fields: scaffold, units, ensemble statistics, gates. Downloading is a plan of ranges, run where the rows are."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import datetime
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom import catalog
from gridloom.functions import speed_kt, transform_units
from gridloom.operators.checks import by_point
from gridloom.operators.ensemble import mean_and_anomaly
from gridloom.operators.scaffold import missing, require_nothing
from gridloom.sources import http, providers
from gridloom.sources.providers import CycleNotAvailable

PLAN = "layer string, url string, step_h int, member int, var string, level string, optional boolean"


def download_plan(spark: SparkSession, layer: str, cycle: datetime, members: list[str] | None = None, gusts: bool = False) -> DataFrame:
    """One row for each message wanted: variables by the steps of their axis, members by steps for the ensemble, whose gusts have files of their own."""
    if layer == "ensemble":
        wanted = [(layer, "UGRD", "10 m above ground"), (layer, "VGRD", "10 m above ground")] + ([("ensemble-gust", "GUST", "surface")] if gusts else [])
        rows = [(layer, providers.url(kind, cycle, s, m), s, k, v, level, False) for k, m in enumerate(members or providers.MEMBERS) for s in catalog.axes(layer)["steps"] for kind, v, level in wanted]
    else:
        steps = sorted({s for hours in catalog.axes(layer).values() for s in hours})
        rows = [(layer, providers.url(layer, cycle, s), s, None, *v.grib, v.optional) for s in steps for v in catalog.variables_for_step(layer, s)]
    return spark.createDataFrame(rows, PLAN)


def _download(batches: Iterator[pa.RecordBatch], get: Callable[[str], bytes], get_range: Callable[[str, int, int | None], bytes]) -> Iterator[pa.RecordBatch]:
    """Files come grouped, so each index is read once; the first line of a (variable, level) counts."""
    url, lines = None, []
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if row["url"] != url:
                url, lines = row["url"], [x.split(":") for x in get(row["url"] + ".idx").decode().splitlines() if x.strip()]
            at = next((k for k, x in enumerate(lines) if (x[3], x[4]) == (row["var"], row["level"])), None)
            if at is None and not row["optional"]:
                raise KeyError(f"{url} has no {row['var']}:{row['level']}")
            if at is not None:
                end = int(lines[at + 1][1]) if at + 1 < len(lines) else None
                out.append({k: row[k] for k in ("var", "level", "step_h", "member")} | {"message": get_range(url, int(lines[at][1]), end)})
        yield pa.RecordBatch.from_pylist(out, pa.schema([("var", pa.string()), ("level", pa.string()), ("step_h", pa.int32()), ("member", pa.int32()), ("message", pa.binary())]))


def plan_digest(plan: DataFrame) -> str:
    """The digest of a plan's URLs as provenance has it: of the ensemble, the wind files of the first and the last step."""
    shown = plan.select("url")
    if plan.where("member is not null").limit(1).count():
        steps = catalog.axes("ensemble")["steps"]
        shown = plan.where((F.col("var") == "UGRD") & F.col("step_h").isin(steps[0], steps[-1])).select("url")
    return shown.agg(providers.urls_digest(F.col("url"))).first()[0]


def download(plan: DataFrame, get: Callable = http.fetch, get_range: Callable = http.fetch_range) -> DataFrame:
    """plan to messages; a file's rows go to one task, files to all."""
    files = plan.repartition("url").sortWithinPartitions("url", "step_h")
    return files.mapInArrow(partial(_download, get=get, get_range=get_range), "var string, level string, step_h int, member int, message binary")


def named_cells(fields: DataFrame, layer: str) -> DataFrame:
    """Decoded fields (var, level, ...) as the layer's variables in its units; steps without an optional variable stay null."""
    spark = fields.sparkSession
    rows = [(v.name, *v.grib, v.to_kt, v.k_to_c) for v in catalog.VARIABLES[layer] if v.grib]
    names = F.broadcast(spark.createDataFrame(rows, "variable string, var string, level string, to_kt boolean, k_to_c boolean"))
    value = F.when(F.col("to_kt"), transform_units(F.col("value"), to_kt=True)).when(F.col("k_to_c"), transform_units(F.col("value"), k_to_c=True)).otherwise(F.col("value"))
    return fields.join(names, ["var", "level"]).select("variable", "member", "step_h", "i", "j", "lat", "lon", value.alias("value"))


def backfilled(cells: DataFrame, layer: str) -> DataFrame:
    """Null cells for steps that an optional variable lacks; another variable that lacks one raises."""
    spark = cells.sparkSession
    axes = catalog.axes(layer)
    wanted = F.broadcast(spark.createDataFrame([(v.name, s, v.optional) for v in catalog.VARIABLES[layer] for s in axes[v.axis]], "variable string, step_h int, optional boolean"))
    gone = missing(wanted, cells, ["variable", "step_h"])
    require_nothing(gone.where("not optional"), f"{layer}: steps without a field")
    grid = cells.select("i", "j", "lat", "lon").distinct()
    empty = gone.select("variable", "step_h").crossJoin(grid).select("variable", F.lit(None).cast("int").alias("member"), "step_h", "i", "j", "lat", "lon", F.lit(None).cast("float").alias("value"))
    return cells.unionByName(empty)


def ensemble_cells(fields: DataFrame, members: int, allow_drift: bool = False, gusts: DataFrame | None = None) -> DataFrame:
    """Member fields of u and v (m/s), and gusts where there are any, to means and members' anomalies in knots."""
    if members != 31 and not allow_drift:
        raise CycleNotAvailable(f"{members} of 31 members")
    point = ["step_h", "i", "j", "lat", "lon"]
    wind = by_point(fields.withColumn("variable", F.col("var")), ["UGRD", "VGRD"], ["member", *point]).select("member", *point, speed_kt(F.col("UGRD"), F.col("VGRD")).alias("value"))
    parts = [("wind_kt", wind)] + ([("gust_kt", gusts.select("member", *point, transform_units(F.col("value"), to_kt=True).alias("value")))] if gusts is not None else [])
    out = None
    for name, speeds in parts:
        both = mean_and_anomaly(speeds, ["step_h", "i", "j"])
        mean = both.groupBy(*point).agg(F.first("mean").alias("value")).select(F.lit(f"{name}_mean").alias("variable"), F.lit(None).cast("int").alias("member"), *point, "value")
        anomaly = both.select(F.lit(f"{name}_anom").alias("variable"), "member", *point, F.col("anom").alias("value"))
        out = mean.union(anomaly) if out is None else out.union(mean).union(anomaly)
    return out


def open_data_cells(fields: DataFrame) -> DataFrame:
    """weather-ecmwf from fields (short_name, step_range, ...): wind at all steps or no cycle; gusts at all steps from the second or none."""
    steps = catalog.axes("weather-ecmwf")["steps"]
    spark = fields.sparkSession
    known = fields.select(providers.kind_of(F.col("short_name")).alias("kind"), providers.step_of_range(F.col("step_range")).alias("step_h"), "i", "j", "lat", "lon", "value")
    have = known.select("kind", "step_h").distinct()
    wanted = spark.createDataFrame([(k, s) for k in ("u", "v", "gust") for s in steps], "kind string, step_h int")
    gone = missing(wanted, have, ["kind", "step_h"])
    if lost := gone.where("kind in ('u', 'v')").select("step_h").distinct().orderBy("step_h").limit(5).collect():
        raise CycleNotAvailable(f"no wind at steps {[r[0] for r in lost]}")
    gusts = not gone.where(f"kind = 'gust' and step_h > {steps[0]}").limit(1).collect()
    kept = known.where("kind in ('u', 'v')" + (f" or (kind = 'gust' and step_h > {steps[0]})" if gusts else ""))
    name = F.when(F.col("kind") == "u", "wind_u_kt").when(F.col("kind") == "v", "wind_v_kt").otherwise("gust_kt")
    cells = kept.select(name.alias("variable"), F.lit(None).cast("int").alias("member"), "step_h", "i", "j", "lat", "lon", transform_units(F.col("value"), to_kt=True).alias("value"))
    if not gusts:
        return cells
    first = known.where(f"kind = 'u' and step_h = {steps[0]}").select(F.lit("gust_kt").alias("variable"), F.lit(None).cast("int").alias("member"), "step_h", "i", "j", "lat", "lon", F.lit(None).cast("float").alias("value"))
    return cells.union(first)


def surface_currents(grid: DataFrame, cycle: datetime) -> DataFrame:
    """currents from a gridded table (time, depth_idx, i, j, lat, lon, uo, vo): the surface at exactly the cycle's instants, all of them."""
    spark = grid.sparkSession
    steps = catalog.axes("currents")["steps"]
    south = grid.agg(F.min_by("lat", "i").alias("first"), F.max_by("lat", "i").alias("last")).first()
    if south["first"] is not None and south["first"] > south["last"]:
        raise ValueError("latitudes must ascend")
    base = int(cycle.timestamp())
    instants = F.broadcast(spark.createDataFrame([(s, base + s * 3600) for s in steps], "step_h int, unix long").select("step_h", F.timestamp_seconds("unix").alias("time")))
    surface = grid.where("depth_idx = 0").join(instants, "time")
    require_nothing(missing(instants.select("step_h"), surface, ["step_h"]), "instants without data")
    pairs = F.explode(F.array(F.struct(F.lit("cur_u_kt").alias("variable"), F.col("uo").alias("v")), F.struct(F.lit("cur_v_kt").alias("variable"), F.col("vo").alias("v"))))
    rows = surface.withColumn("p", pairs)
    return rows.select("p.variable", F.lit(None).cast("int").alias("member"), "step_h", "i", "j", "lat", "lon", transform_units(F.nanvl(F.col("p.v").cast("float"), F.lit(None).cast("float")), to_kt=True).alias("value"))


def rtofs_cells(*_, **__):
    """Not supported: its grid is curvilinear and would have to be brought onto a regular one first."""
    raise NotImplementedError("the fallback source's curvilinear grid is not supported")
