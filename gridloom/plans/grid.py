"""Queries on values, tiles, grids, axes and cycles."""

from __future__ import annotations


from pyspark.sql import functions as F

from gridloom import catalog
from gridloom.functions import (cycle_compact, cycle_iso, dequantize, finite, floor_to_cycle, forecast_times, longitude, parse_cycle, quantize, quantize_field, run_id, speed_kt, tile_id, tile_origin_lat, tile_origin_lon, transform_units, z_res)
from gridloom.operators import axes, scaffold, tiling
from gridloom.plans.derived import POINTS, SQL_KT, points, query, sql_origin, sql_quantize, sql_tile
from gridloom.session import table

# ruff: noqa: E501


def rows_of(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


@query("quantize_i16", f"WITH {POINTS} SELECT l_orderkey, l_partkey, l_linenumber, {sql_quantize(f'u * {SQL_KT}', 'i16', '0.01')} AS raw FROM points")
def quantize_i16(spark, d):
    return points(spark, d).select("l_orderkey", "l_partkey", "l_linenumber", quantize_field(F.col("u"), "i16", 0.01, to_kt=True).alias("raw"))


@query("quantize_i8", f"SELECT vec_id, CAST(p - 1 AS INTEGER) AS pos, {sql_quantize('e', 'i8', '0.01')} AS raw FROM (SELECT vec_id, unnest(embedding) AS e, unnest(range(1, len(embedding) + 1)) AS p FROM embeddings)")
def quantize_i8(spark, d):
    return table(spark, d, "embeddings").select("vec_id", F.posexplode("embedding").alias("pos", "e")).select("vec_id", "pos", quantize(F.col("e"), "i8", 0.01).alias("raw"))


@query("dequantize", f"WITH {POINTS}, q AS (SELECT l_orderkey, l_partkey, l_linenumber, {sql_quantize(f'u * {SQL_KT}', 'i16', '0.01')} AS raw FROM points) SELECT l_orderkey, l_partkey, l_linenumber, CASE WHEN raw <> -32768 THEN CAST(CAST(raw AS FLOAT) * CAST(0.01 AS FLOAT) AS DOUBLE) END AS decoded FROM q")
def dequantize_(spark, d):
    return quantize_i16(spark, d).select("l_orderkey", "l_partkey", "l_linenumber", dequantize(F.col("raw"), "i16", 0.01).cast("double").alias("decoded"))


@query("roundtrip_error", f"WITH {POINTS}, q AS (SELECT CAST(u * {SQL_KT} AS DOUBLE) AS x, {sql_quantize(f'u * {SQL_KT}', 'i16', '0.01')} AS raw FROM points) SELECT count(*) AS n, max(abs(CAST(CAST(raw AS FLOAT) * CAST(0.01 AS FLOAT) AS DOUBLE) - x)) <= 0.005001 AS within FROM q WHERE raw <> -32768")
def roundtrip_error(spark, d):
    x = transform_units(F.col("u"), to_kt=True)
    q = points(spark, d).select(x.cast("double").alias("x"), quantize(x, "i16", 0.01).alias("raw")).where("raw <> -32768")
    return q.agg(F.count("*").alias("n"), (F.max(F.abs(dequantize(F.col("raw"), "i16", 0.01).cast("double") - F.col("x"))) <= 0.005001).alias("within"))


@query("transform_units", f"SELECT l_orderkey, l_partkey, l_linenumber, CAST(CAST(l_quantity AS FLOAT) * {SQL_KT} AS DOUBLE) AS kt, CAST(CAST(l_extendedprice AS FLOAT) - CAST(273.15 AS FLOAT) AS DOUBLE) AS c, CAST(CAST(l_quantity AS FLOAT) * {SQL_KT} - CAST(273.15 AS FLOAT) AS DOUBLE) AS kt_then_c FROM lineitem")
def transform_units_(spark, d):
    q, t = F.col("l_quantity"), F.col("l_extendedprice")
    return table(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", transform_units(q, to_kt=True).cast("double").alias("kt"), transform_units(t, k_to_c=True).cast("double").alias("c"), transform_units(q, True, True).cast("double").alias("kt_then_c"))


@query("missing_mask", "SELECT l_returnflag, count(*) AS n, count(x) AS present FROM (SELECT l_returnflag, CASE WHEN m < 9.0e19 AND NOT isnan(m) THEN m END AS x FROM (SELECT l_returnflag, CASE WHEN l_linenumber = 7 THEN 1e20::DOUBLE WHEN l_linenumber = 6 THEN 'nan'::DOUBLE ELSE l_quantity END AS m FROM lineitem)) GROUP BY l_returnflag")
def missing_mask(spark, d):
    m = F.when(F.col("l_linenumber") == 7, F.lit(1e20)).when(F.col("l_linenumber") == 6, F.lit(float("nan"))).otherwise(F.col("l_quantity"))
    return table(spark, d, "lineitem").select("l_returnflag", finite(m).alias("x")).groupBy("l_returnflag").agg(F.count("*").alias("n"), F.count("x").alias("present"))


@query("wind_speed", f"WITH {POINTS} SELECT l_orderkey, l_partkey, l_linenumber, {sql_quantize(f'CAST(sqrt(CAST(u * u + v * v AS DOUBLE)) AS FLOAT) * {SQL_KT}', 'i16', '0.01')} AS raw FROM points")
def wind_speed(spark, d):
    return points(spark, d).select("l_orderkey", "l_partkey", "l_linenumber", quantize(speed_kt(F.col("u"), F.col("v")), "i16", 0.01).alias("raw"))


_TILED = f"{POINTS}, tiled AS (SELECT *, {sql_origin('lat')} AS t_lat, {sql_origin('lon')} AS t_lon FROM points WHERE lat < 90)"
_TILE = sql_tile("t_lat", "t_lon")


@query("tile_assign", f"WITH {_TILED} SELECT {_TILE} AS tile_id, count(*) AS n, count(u) AS present, CAST(min({sql_quantize(f'u * {SQL_KT}', 'i16', '0.01')}) AS INTEGER) AS raw_min, CAST(max({sql_quantize(f'u * {SQL_KT}', 'i16', '0.01')}) AS INTEGER) AS raw_max FROM tiled GROUP BY 1")
def tile_assign(spark, d):
    cells = tiling.with_tile(points(spark, d)).withColumn("raw", quantize_field(F.col("u"), "i16", 0.01, to_kt=True))
    return cells.groupBy("tile_id").agg(F.count("*").alias("n"), F.count("u").alias("present"), F.min("raw").cast("int").alias("raw_min"), F.max("raw").cast("int").alias("raw_max"))


@query("tile_enumerate", f"SELECT CAST(lat0 AS INTEGER) AS lat0, CAST(lon0 AS INTEGER) AS lon0, {sql_tile('lat0', 'lon0')} AS tile_id FROM (SELECT unnest(range(-90, 90, 10)) AS lat0) CROSS JOIN (SELECT unnest(range(-180, 180, 10)) AS lon0)")
def tile_enumerate(spark, d):
    return tiling.tiles_between(spark)


@query("tiles_for_box", f"SELECT CAST(lat0 AS INTEGER) AS lat0, CAST(lon0 AS INTEGER) AS lon0, {sql_tile('lat0', 'lon0')} AS tile_id FROM (SELECT unnest(range(30, 60, 10)) AS lat0) CROSS JOIN (SELECT unnest(range(-20, 30, 10)) AS lon0)")
def tiles_for_box(spark, d):
    return tiling.tiles_between(spark, 35.5, 52.0, -12.25, 20.0)


@query("tile_origin", "SELECT DISTINCT lat, lon, CAST(floor(lat / 10) * 10 AS INTEGER) AS lat0, CAST(floor(CASE WHEN lon >= 180 THEN lon - 360 ELSE lon END / 10) * 10 AS INTEGER) AS lon0 FROM (SELECT CAST(l_partkey % 721 AS DOUBLE) * CAST(0.25 AS DOUBLE) - 90 AS lat, CAST(l_orderkey % 1440 AS DOUBLE) * CAST(0.25 AS DOUBLE) AS lon FROM lineitem)")
def tile_origin(spark, d):
    rows = table(spark, d, "lineitem").select(((F.col("l_partkey") % 721).cast("double") * 0.25 - 90).alias("lat"), ((F.col("l_orderkey") % 1440).cast("double") * 0.25).alias("lon")).distinct()
    return rows.select("lat", "lon", tile_origin_lat(F.col("lat")).alias("lat0"), tile_origin_lon(F.col("lon")).alias("lon0"))


@query("tile_members", f"WITH g AS (SELECT CAST(i AS INTEGER) AS i, -90 + i * CAST(0.0833333 AS DOUBLE) AS lat FROM (SELECT unnest(range(0, 2041)) AS i)), t AS (SELECT unnest(range(-90, 90, 10)) AS lat0) SELECT CAST(lat0 AS INTEGER) AS lat0, count(*) AS nlat, min(lat) AS first_lat FROM g JOIN t ON lat >= lat0 AND lat < lat0 + 10 GROUP BY lat0")
def tile_members(spark, d):
    """Rows of a grid whose step is inexact: tiles by computed coordinates, as an interval test has them."""
    rows = spark.range(2041).select((F.lit(-90.0) + F.col("id") * F.lit(0.0833333)).alias("lat")).where("lat < 90")
    return rows.groupBy(tile_origin_lat(F.col("lat")).alias("lat0")).agg(F.count("*").alias("nlat"), F.min("lat").alias("first_lat"))


@query("tile_has_data", f"WITH {_TILED} SELECT {_TILE} AS tile_id FROM tiled GROUP BY 1 HAVING bool_or(member >= 5 AND u IS NOT NULL)")
def tile_has_data(spark, d):
    cells = points(spark, d).withColumn("value", F.when(F.col("member") >= 5, F.col("u")))
    return tiling.tile_extents(cells).where("has_data").select("tile_id")


@query("tile_header_extent", f"WITH {_TILED} SELECT {_TILE} AS tile_id, min(lat) AS lat0, min(lon) AS lon0, count(DISTINCT lat) AS nlat, count(DISTINCT lon) AS nlon, bool_or(u IS NOT NULL) AS has_data FROM tiled GROUP BY 1")
def tile_header_extent(spark, d):
    return tiling.tile_extents(points(spark, d).withColumn("value", F.col("u")))


@query("grid_coordinates", "SELECT CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j, 40 + i * CAST(2.5 AS DOUBLE) AS lat, -10 + j * CAST(2.5 AS DOUBLE) AS lon FROM (SELECT unnest(range(0, 4)) AS i) CROSS JOIN (SELECT unnest(range(0, 8)) AS j)")
def grid_coordinates(spark, d):
    return tiling.grid_points(spark, 40.0, -10.0, 2.5, 2.5, 4, 8)


@query("lon_wrap_roll", "WITH g AS (SELECT CAST(j AS INTEGER) AS j, ((j * CAST(0.25 AS DOUBLE) + 180) % 360) - 180 AS lon FROM (SELECT unnest(range(0, 1440)) AS j)) SELECT j, lon, CAST(row_number() OVER (ORDER BY lon) - 1 AS INTEGER) AS j_rolled FROM g")
def lon_wrap_roll(spark, d):
    columns = spark.range(1440).select(F.lit("gfs").alias("grid"), F.col("id").cast("int").alias("j"), longitude(F.col("id") * 0.25).alias("lon"))
    return scaffold.rolled(columns, ["grid"]).select("j", "lon", F.col("j_rolled").cast("int").alias("j_rolled"))


@query("lon_first_column", "SELECT arg_min(j, lon) AS j_first, min(lon) AS lon_first FROM (SELECT CAST(j AS INTEGER) AS j, ((j * CAST(0.25 AS DOUBLE) + 180) % 360) - 180 AS lon FROM (SELECT unnest(range(0, 1440)) AS j))")
def lon_first_column(spark, d):
    return spark.range(1440).select(F.col("id").cast("int").alias("j"), longitude(F.col("id") * 0.25).alias("lon")).agg(F.min_by("j", "lon").alias("j_first"), F.min("lon").alias("lon_first"))


@query("lat_flip", "SELECT CAST(i AS INTEGER) AS i, CAST(720 - i AS INTEGER) AS i_up, 90 - CAST(0.25 AS DOUBLE) * 720 + (720 - i) * CAST(0.25 AS DOUBLE) AS lat_up FROM (SELECT unnest(range(0, 721)) AS i)")
def lat_flip(spark, d):
    rows = spark.range(721).select(F.col("id").cast("int").alias("i"))
    return scaffold.flipped(rows, 721, 90.0, 0.25).select("i", F.col("i_up").cast("int").alias("i_up"), "lat_up")


_SEG = " UNION ALL ".join(f"SELECT '{layer}' AS layer, '{name}' AS axis, {k} AS seg, {a} AS first, {b} AS last, {s} AS step" for layer, x in catalog.SEGMENTS.items() for name, parts in x.items() for k, (a, b, s) in enumerate(parts))
_AXES = f"segs AS ({_SEG}), offs AS (SELECT layer, axis, CAST(unnest(range(first, last + 1, step)) AS INTEGER) AS offset_h FROM segs)"


@query("axis_offsets", f"WITH {_AXES} SELECT layer, axis, offset_h FROM offs")
def axis_offsets(spark, d):
    return catalog.axes_table(spark).select("layer", "axis", F.explode("offsets_h").alias("offset_h"))


@query("axis_lengths", f"WITH {_AXES} SELECT layer, axis, count(*) AS steps, max(offset_h) AS last FROM offs GROUP BY layer, axis")
def axis_lengths(spark, d):
    return catalog.axes_table(spark).select("layer", "axis", F.size("offsets_h").cast("long").alias("steps"), F.array_max("offsets_h").alias("last"))


@query("layer_horizon", f"WITH {_AXES} SELECT layer, max(offset_h) AS horizon_h FROM offs GROUP BY layer")
def layer_horizon(spark, d):
    return catalog.axes_table(spark).groupBy("layer").agg(F.max(F.element_at("offsets_h", -1)).alias("horizon_h"))


@query("axis_union", f"WITH {_AXES} SELECT DISTINCT offset_h FROM offs WHERE layer = 'weather'")
def axis_union(spark, d):
    return axes.union_of(catalog.axes_table(spark).where("layer = 'weather'"))


@query("axis_subset", f"WITH {_AXES} SELECT layer, (SELECT count(*) FROM (SELECT offset_h FROM offs o WHERE o.layer = l.layer AND axis = 'h3' EXCEPT SELECT offset_h FROM offs o WHERE o.layer = l.layer AND axis = 'hourly')) = 0 AS inside FROM (SELECT 'weather' AS layer) l")
def axis_subset(spark, d):
    rows = catalog.axes_table(spark).where("layer = 'weather'").groupBy("layer").agg(F.first(F.when(F.col("axis") == "h3", F.col("offsets_h")), True).alias("a"), F.first(F.when(F.col("axis") == "hourly", F.col("offsets_h")), True).alias("b"))
    return rows.select("layer", (F.size(F.array_except("a", "b")) == 0).alias("inside"))


@query("axis_difference", f"WITH {_AXES} SELECT offset_h FROM offs WHERE layer = 'weather' AND axis = 'hourly' EXCEPT SELECT offset_h FROM offs WHERE layer = 'weather' AND axis = 'h3'")
def axis_difference(spark, d):
    rows = axes.exploded(catalog.axes_table(spark).where("layer = 'weather'"))
    return rows.where("axis = 'hourly'").select("offset_h").subtract(rows.where("axis = 'h3'").select("offset_h"))


@query("axis_monotonic", "WITH o AS (SELECT l_returnflag AS axis, l_orderkey % 7 AS pos, CAST(max(l_orderkey % 81 * 3) - l_orderkey % 7 * (CASE WHEN l_returnflag = 'A' THEN 1 ELSE -300 END) AS BIGINT) AS offset_h FROM lineitem GROUP BY l_returnflag, l_orderkey % 7), r AS (SELECT axis, coalesce(offset_h > lag(offset_h) OVER (PARTITION BY axis ORDER BY pos), true) AS rising FROM o) SELECT axis, bool_and(rising) AS monotonic, count(*) AS steps FROM r GROUP BY axis")
def axis_monotonic(spark, d):
    pos = F.col("l_orderkey") % 7
    rows = table(spark, d, "lineitem").groupBy(F.col("l_returnflag").alias("axis"), pos.alias("pos")).agg(F.max(F.col("l_orderkey") % 81 * 3).alias("m"))
    return axes.monotonic(rows.select("axis", "pos", (F.col("m") - F.col("pos") * F.when(F.col("axis") == "A", 1).otherwise(-300)).alias("offset_h")))


@query("axis_complete", f"WITH {_AXES}, found AS (SELECT layer, axis, list(offset_h ORDER BY offset_h) AS h FROM offs WHERE NOT (layer = 'waves' AND offset_h = 384) AND layer <> 'currents' GROUP BY layer, axis), wanted AS (SELECT layer, axis, list(offset_h ORDER BY offset_h) AS h FROM offs GROUP BY layer, axis) SELECT w.layer, w.axis, coalesce(f.h = w.h, false) AS complete FROM wanted w LEFT JOIN found f ON f.layer = w.layer AND f.axis = w.axis")
def axis_complete(spark, d):
    wanted = catalog.axes_table(spark)
    found = wanted.where("layer <> 'currents'").withColumn("offsets_h", F.when(F.col("layer") == "waves", F.filter("offsets_h", lambda x: x != 384)).otherwise(F.col("offsets_h")))
    return axes.complete(found, wanted, ("layer", "axis"))


@query("axis_overlap", "WITH s AS (SELECT o_orderstatus AS axis, o_custkey % 50 AS seg, min(o_orderkey % 1000) AS first, max(o_orderkey % 1000) AS last FROM orders GROUP BY ALL), w AS (SELECT axis, seg, first, last, lag(last) OVER (PARTITION BY axis ORDER BY seg) AS before FROM s) SELECT axis, seg, first, last, before FROM w WHERE first <= before")
def axis_overlap(spark, d):
    k = F.col("o_orderkey") % 1000
    rows = table(spark, d, "orders").groupBy(F.col("o_orderstatus").alias("axis"), (F.col("o_custkey") % 50).alias("seg")).agg(F.min(k).alias("first"), F.max(k).alias("last"))
    return axes.overlaps(rows).select("axis", "seg", "first", "last", "before")


@query("axis_gate", f"WITH {_AXES} SELECT s.step, o.axis FROM (SELECT DISTINCT CAST(l_orderkey % 81 * 3 AS INTEGER) AS step FROM lineitem) s JOIN offs o ON o.layer = 'weather' AND o.offset_h = s.step")
def axis_gate(spark, d):
    steps = points(spark, d).select(F.col("step_h").alias("step")).distinct()
    gate = catalog.axes_table(spark).where("layer = 'weather'")
    return steps.crossJoin(F.broadcast(gate)).where(F.array_contains("offsets_h", F.col("step"))).select("step", "axis")


_VARS = " UNION ALL ".join(f"SELECT '{layer}' AS layer, '{v.name}' AS variable, {i} AS ord, '{v.axis}' AS axis" for layer, vs in catalog.VARIABLES.items() for i, v in enumerate(vs))


@query("vars_for_step", f"WITH {_AXES}, vars AS ({_VARS}) SELECT o.offset_h AS step, v.variable, CAST(v.ord AS INTEGER) AS ord FROM offs o JOIN vars v ON v.layer = o.layer AND v.axis = o.axis WHERE o.layer = 'weather'")
def vars_for_step(spark, d):
    offs = catalog.axes_table(spark).where("layer = 'weather'").select("axis", F.explode("offsets_h").alias("step"))
    return offs.join(F.broadcast(catalog.variables_table(spark).where("layer = 'weather'")), "axis").select("step", "variable", "ord")


@query("cycle_floor", "SELECT time_bucket(INTERVAL 6 HOUR, ts) AS cycle, count(*) AS n, avg(CASE WHEN value > 50 THEN 1.0::DOUBLE ELSE 0.0 END) AS share FROM events GROUP BY 1")
def cycle_floor(spark, d):
    return table(spark, d, "events").groupBy(floor_to_cycle(F.col("ts")).alias("cycle")).agg(F.count("*").alias("n"), F.avg((F.col("value") > 50).cast("double")).alias("share"))


@query("cycle_window", "SELECT time_bucket(INTERVAL 6 HOUR, ts) AS cycle, count(*) AS n FROM events GROUP BY 1")
def cycle_window(spark, d):
    from gridloom.streaming.cycles import by_cycle

    return by_cycle(table(spark, d, "events"))


_CYCLES = "c AS (SELECT DISTINCT time_bucket(INTERVAL 6 HOUR, ts) AS cycle FROM events)"


@query("cycle_labels", f"WITH {_CYCLES} SELECT strftime(cycle, '%Y%m%dT%HZ') AS compact, strftime(cycle, '%Y-%m-%dT%H:%MZ') AS iso, 'weather-' || strftime(cycle, '%Y%m%dT%HZ') AS run_id FROM c")
def cycle_labels(spark, d):
    c = table(spark, d, "events").select(floor_to_cycle(F.col("ts")).alias("cycle")).distinct()
    return c.select(cycle_compact(F.col("cycle")).alias("compact"), cycle_iso(F.col("cycle")).alias("iso"), run_id(F.lit("weather"), F.col("cycle")).alias("run_id"))


@query("cycle_parse", f"WITH {_CYCLES} SELECT strftime(cycle, '%Y%m%dT%H') AS arg, strptime(strftime(cycle, '%Y%m%dT%H'), '%Y%m%dT%H') AS cycle FROM c")
def cycle_parse(spark, d):
    c = table(spark, d, "events").select(F.date_format(floor_to_cycle(F.col("ts")), "yyyyMMdd'T'HH").alias("arg")).distinct()
    return c.select("arg", parse_cycle(F.col("arg")).alias("cycle"))


@query("cycle_latest", "WITH c AS (SELECT time_bucket(INTERVAL 6 HOUR, ts) AS cycle, count(*) AS n FROM events GROUP BY 1), cand AS (SELECT (SELECT max(cycle) FROM c) - k * INTERVAL 6 HOUR AS cycle FROM (SELECT unnest(range(0, 8)) AS k)) SELECT max(cand.cycle) AS latest FROM cand JOIN c ON c.cycle = cand.cycle WHERE c.n >= (SELECT avg(n) FROM c)")
def cycle_latest(spark, d):
    """The newest of eight candidate cycles that has at least the mean number of files; candidates are eight rows."""
    have = table(spark, d, "events").groupBy(floor_to_cycle(F.col("ts")).alias("cycle")).agg(F.count("*").alias("n"))
    bounds = have.agg(F.max("cycle").alias("top"), F.avg("n").alias("enough"))
    candidates = bounds.select("enough", F.explode(F.sequence(F.lit(0), F.lit(7))).alias("k"), "top").select("enough", F.timestamp_seconds(F.unix_timestamp("top") - F.col("k") * 21600).alias("cycle"))
    return have.join(F.broadcast(candidates), "cycle").where("n >= enough").agg(F.max("cycle").alias("latest"))


@query("forecast_times", f"WITH {_CYCLES} SELECT cycle, CAST(h AS INTEGER) AS offset_h, cycle + h * INTERVAL 1 HOUR AS valid FROM c CROSS JOIN (SELECT unnest(range(0, 13, 3)) AS h)")
def forecast_times_(spark, d):
    c = table(spark, d, "events").select(floor_to_cycle(F.col("ts")).alias("cycle")).distinct()
    hours = F.sequence(F.lit(0), F.lit(12), F.lit(3))
    both = F.arrays_zip(hours.alias("offset_h"), forecast_times(F.col("cycle"), hours).alias("valid"))
    return c.select("cycle", F.explode(both).alias("p")).select("cycle", "p.offset_h", "p.valid")


@query("z_res", "SELECT step, printf('z%03d', CAST(round_even(step * 100, 0) AS INTEGER)) AS z FROM (SELECT unnest([0.25::DOUBLE, 0.5, 1.0 / 12, 2.5, 0.125]) AS step)")
def z_res_(spark, d):
    return rows_of(spark, [(0.25,), (0.5,), (1 / 12,), (2.5,), (0.125,)], "step double").select("step", z_res(F.col("step")).alias("z"))


@query("tile_names", f"SELECT CAST(lat0 AS INTEGER) AS lat0, CAST(lon0 AS INTEGER) AS lon0, {sql_tile('lat0', 'lon0')} AS tile_id, 'weather/z025/' || {sql_tile('lat0', 'lon0')} || '.bin.gz' AS path FROM (SELECT DISTINCT l_suppkey % 18 * 10 - 90 AS lat0, l_orderkey % 36 * 10 - 180 AS lon0 FROM lineitem)")
def tile_names(spark, d):
    rows = table(spark, d, "lineitem").select((F.col("l_suppkey") % 18 * 10 - 90).cast("int").alias("lat0"), (F.col("l_orderkey") % 36 * 10 - 180).cast("int").alias("lon0")).distinct()
    rows = rows.withColumn("tile_id", tile_id(F.col("lat0"), F.col("lon0")))
    return rows.select("lat0", "lon0", "tile_id", F.format_string("weather/%s/%s.bin.gz", z_res(F.lit(0.25)), F.col("tile_id")).alias("path"))


@query("analytic_field", "SELECT CAST(t AS INTEGER) AS t, CAST(i AS INTEGER) AS i, CAST(j AS INTEGER) AS j, CASE WHEN t + i + j > 0 THEN CAST(CAST(-12 + CAST(0.7 AS DOUBLE) * t + CAST(1.3 AS DOUBLE) * i + CAST(0.11 AS DOUBLE) * j AS FLOAT) AS DOUBLE) END AS value FROM (SELECT unnest(range(0, 4)) AS t) CROSS JOIN (SELECT unnest(range(0, 8)) AS i) CROSS JOIN (SELECT unnest(range(0, 8)) AS j)")
def analytic_field(spark, d):
    n = spark.range(4 * 64)
    rows = n.select(F.floor(F.col("id") / 64).cast("int").alias("t"), (F.floor(F.col("id") / 8) % 8).cast("int").alias("i"), (F.col("id") % 8).cast("int").alias("j"))
    value = (F.lit(-12.0) + F.lit(0.7) * F.col("t") + F.lit(1.3) * F.col("i") + F.lit(0.11) * F.col("j")).cast("float").cast("double")
    return rows.withColumn("value", F.when(F.col("t") + F.col("i") + F.col("j") > 0, value))


