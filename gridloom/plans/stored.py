"""Queries on byte layouts, hashes, tiles as stored, runs, retention and sizes."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from gridloom.catalog import Variable
from gridloom.functions import fnv64, le_payload, padded_length, quantize, run_id
from gridloom.operators import codec, publishing, sizing
from gridloom.operators.tiling import with_tile
from gridloom.plans.derived import RUNS, points, query, runs, sql_quantize, sql_tile
from gridloom.plans.grid import _TILE, _TILED
from gridloom.session import table

# ruff: noqa: E501

_PATCH = Variable("patch", "steps", "i8", 0.01)
_RAW = "raws AS (SELECT vec_id, p - 1 AS pos, " + sql_quantize("e", "i8", "0.01") + " AS raw FROM (SELECT vec_id, unnest(embedding) AS e, unnest(range(1, len(embedding) + 1)) AS p FROM embeddings))"


@query("patch_build", f"WITH {_RAW} SELECT vec_id, array_to_string(list(CAST(raw AS VARCHAR) ORDER BY pos), ',') AS patch, count(*) AS n FROM raws GROUP BY vec_id")
def patch_build(spark, d):
    raw = F.transform("embedding", lambda e: quantize(e, "i8", 0.01))
    return table(spark, d, "embeddings").select("vec_id", F.array_join(raw.cast("array<string>"), ",").alias("patch"), F.size("embedding").cast("long").alias("n"))


@query("patch_cells", f"WITH {_RAW} SELECT vec_id, CAST(pos // 8 AS INTEGER) AS i, CAST(pos % 8 AS INTEGER) AS j, raw FROM raws")
def patch_cells(spark, d):
    rows = table(spark, d, "embeddings").select("vec_id", F.posexplode("embedding").alias("pos", "e"))
    return rows.select("vec_id", F.floor(F.col("pos") / 8).cast("int").alias("i"), (F.col("pos") % 8).alias("j"), quantize(F.col("e"), "i8", 0.01).alias("raw"))


@query("le_payload", f"WITH {_RAW} SELECT vec_id, string_agg(printf('%02x%02x', CAST((CAST(raw AS INTEGER) * 100 + 65536) % 256 AS INTEGER), CAST((CAST(raw AS INTEGER) * 100 + 65536) // 256 % 256 AS INTEGER)), '' ORDER BY pos) AS payload FROM raws GROUP BY vec_id")
def le_payload_(spark, d):
    raw = F.transform("embedding", lambda e: quantize(e, "i8", 0.01).cast("int") * 100)
    return table(spark, d, "embeddings").select("vec_id", F.lower(F.hex(le_payload(raw, 2))).alias("payload"))


@query("payload_offsets", "WITH v AS (SELECT l_suppkey AS tile, l_linenumber AS ord, CAST(sum(l_quantity) AS BIGINT) AS n FROM lineitem GROUP BY ALL) SELECT tile, ord, n, CAST(coalesce(sum(n + (4 - n % 4) % 4) OVER (PARTITION BY tile ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS byte_offset FROM v")
def payload_offsets(spark, d):
    rows = table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("tile"), F.col("l_linenumber").alias("ord")).agg(F.sum("l_quantity").cast("long").alias("n"))
    before = Window.partitionBy("tile").orderBy("ord").rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("byte_offset", F.coalesce(F.sum(padded_length(F.col("n"))).over(before), F.lit(0)).cast("long"))


@query("expected_shape", "SELECT per_member, steps, CASE WHEN per_member THEN 31 ELSE 1 END * steps * 8 * 8 AS cells FROM (SELECT l_linenumber = 1 AS per_member, count(DISTINCT l_orderkey % 81) AS steps FROM lineitem GROUP BY 1)")
def expected_shape(spark, d):
    rows = table(spark, d, "lineitem").groupBy((F.col("l_linenumber") == 1).alias("per_member")).agg(F.count_distinct(F.col("l_orderkey") % 81).alias("steps"))
    return rows.withColumn("cells", F.when(F.col("per_member"), 31).otherwise(1) * F.col("steps") * 64)


@query("fnv64_native", "WITH k AS (SELECT c_custkey, encode(c_name || c_mktsegment) AS b FROM customer) SELECT c_custkey, CAST(octet_length(b) AS BIGINT) AS n, printf('%08x', CAST(s // 4294967296 AS BIGINT)) || printf('%08x', CAST(s % 4294967296 AS BIGINT)) AS fnv64 FROM (SELECT c_custkey, b, list_reduce(list_prepend(CAST(14695981039346656037 AS UHUGEINT), list_transform(range(0, length(hex(b)) // 2), lambda i: CAST('0x' || substr(hex(b), i * 2 + 1, 2) AS UHUGEINT))), lambda s, x: (((s // 256 * 256) + CAST(xor(CAST(s % 256 AS UTINYINT), CAST(x AS UTINYINT)) AS UHUGEINT)) * CAST(1099511628211 AS UHUGEINT)) % CAST(18446744073709551616 AS UHUGEINT)) AS s FROM k)")
def fnv64_native(spark, d):
    data = F.concat("c_name", "c_mktsegment").cast("binary")
    return table(spark, d, "customer").select("c_custkey", F.octet_length(data).cast("long").alias("n"), fnv64(data).alias("fnv64"))


@query("json_props", "SELECT event_id, CAST(props->>'$.k' AS BIGINT) AS k, '{\"k\":' || (props->>'$.k') || '}' AS compact FROM events")
def json_props(spark, d):
    parsed = F.from_json("props", "k long")
    return table(spark, d, "events").select("event_id", parsed["k"].alias("k"), F.to_json(parsed).alias("compact"))


@query("header_axes", "SELECT o_orderstatus AS axis, '{\"base\":\"' || strftime(min(o_orderdate), '%Y-%m-%dT%H:%MZ') || '\",\"offsets_h\":[' || string_agg(DISTINCT CAST(o_orderkey % 5 * 3 AS VARCHAR), ',' ORDER BY CAST(o_orderkey % 5 * 3 AS VARCHAR)) || ']}' AS header FROM orders GROUP BY o_orderstatus")
def header_axes(spark, d):
    offsets = F.array_sort(F.collect_set((F.col("o_orderkey") % 5 * 3).cast("string")))
    rows = table(spark, d, "orders").groupBy(F.col("o_orderstatus").alias("axis")).agg(F.date_format(F.min("o_orderdate"), "yyyy-MM-dd'T'HH:mm'Z'").alias("base"), offsets.cast("array<int>").alias("offsets_h"))
    return rows.select("axis", F.to_json(F.struct("base", "offsets_h")).alias("header"))


# --- manifests

_SIZES = f"{_TILED}, sizes AS (SELECT {_TILE} AS tile_id, count(*) * 2 AS bytes FROM tiled GROUP BY 1)"


def tile_sizes(spark, d):
    return with_tile(points(spark, d)).groupBy("tile_id").agg((F.count("*") * 2).alias("bytes"))


@query("manifest_totals", f"WITH {_SIZES} SELECT count(*) AS tile_count, CAST(sum(bytes) AS BIGINT) AS bytes FROM sizes")
def manifest_totals(spark, d):
    return tile_sizes(spark, d).agg(F.count("*").alias("tile_count"), F.sum("bytes").alias("bytes"))


@query("manifest_tiles", f"WITH {_SIZES} SELECT substr(tile_id, 1, 3) AS band, '{{' || string_agg('\"' || tile_id || '\":{{\"bytes\":' || bytes || '}}', ',' ORDER BY tile_id) || '}}' AS tiles FROM sizes GROUP BY 1".replace("{{", "{").replace("}}", "}"))
def manifest_tiles(spark, d):
    entries = F.map_from_entries(F.array_sort(F.collect_list(F.struct("tile_id", F.struct("bytes")))))
    return tile_sizes(spark, d).groupBy(F.substring("tile_id", 1, 3).alias("band")).agg(F.to_json(entries).alias("tiles"))


@query("verify_entries", f"WITH {_SIZES}, stored AS (SELECT tile_id, CASE WHEN bytes % 10 = 0 THEN bytes + 1 ELSE bytes END AS bytes FROM sizes WHERE bytes % 14 <> 0) SELECT s.tile_id FROM sizes s LEFT JOIN stored t ON t.tile_id = s.tile_id WHERE t.bytes IS DISTINCT FROM s.bytes")
def verify_entries(spark, d):
    sizes = tile_sizes(spark, d).withColumn("fnv64", F.lit("0"))
    stored = sizes.where("bytes % 14 <> 0").withColumn("bytes", F.when(F.col("bytes") % 10 == 0, F.col("bytes") + 1).otherwise(F.col("bytes")))
    return publishing.mismatches(sizes, stored)


@query("sample_verify")
def sample_verify(spark, d):
    """A random draw: no SQL gives the same rows."""
    return tile_sizes(spark, d).orderBy(F.rand(7)).limit(publishing.CHECKED_TILES)


# --- runs

_CUT = "TIMESTAMP '1995-06-01'"
_LATEST = f"{RUNS}, ranked AS (SELECT layer, run_id, cycle, row_number() OVER (PARTITION BY layer ORDER BY cycle DESC) AS nth FROM named WHERE cycle < {_CUT}), latest AS (SELECT layer, max(CASE WHEN nth = 1 THEN run_id END) AS run_id, max(CASE WHEN nth = 2 THEN run_id END) AS previous_run_id FROM ranked GROUP BY layer)"


def latest(spark, d):
    two = publishing.newest(runs(spark, d).where("cycle < timestamp'1995-06-01'"))
    return two.groupBy("layer").agg(F.max(F.when(F.col("nth") == 1, F.col("run_id"))).alias("run_id"), F.max(F.when(F.col("nth") == 2, F.col("run_id"))).alias("previous_run_id"))


@query("layer_run_ids", f"WITH {RUNS}, keys AS (SELECT 'forecast-runs/' || run_id || '/manifest.json' AS key FROM named) SELECT DISTINCT regexp_extract(key, '^forecast-runs/(weather-[0-9]{{8}}T[0-9]{{2}}Z)/', 1) AS run_id FROM keys WHERE regexp_matches(key, '^forecast-runs/weather-[0-9]{{8}}T[0-9]{{2}}Z/')".replace("{{", "{").replace("}}", "}"))
def layer_run_ids(spark, d):
    keys = runs(spark, d).select(F.concat(F.lit("forecast-runs/"), F.col("run_id"), F.lit("/manifest.json")).alias("key"))
    return publishing.run_ids(keys, "weather")


@query("key_prefix", f"WITH {RUNS} SELECT 'forecast-runs/' || run_id || '/manifest.json' AS key FROM named WHERE starts_with('forecast-runs/' || run_id, 'forecast-runs/waves-199')")
def key_prefix(spark, d):
    keys = runs(spark, d).select(F.concat(F.lit("forecast-runs/"), F.col("run_id"), F.lit("/manifest.json")).alias("key"))
    return keys.where(F.col("key").startswith("forecast-runs/waves-199"))


@query("latest_upsert", f"WITH {_LATEST}, fresh AS (SELECT 'weather' AS layer, 'weather-19950601T00Z' AS run_id UNION ALL SELECT layer, run_id FROM latest WHERE layer = 'weather-ecmwf' UNION ALL SELECT 'ensemble', 'ensemble-19950601T00Z') SELECT coalesce(f.layer, l.layer) AS layer, coalesce(f.run_id, l.run_id) AS run_id, CASE WHEN f.run_id IS NULL OR f.run_id = l.run_id THEN l.previous_run_id ELSE l.run_id END AS previous_run_id FROM latest l FULL JOIN fresh f ON f.layer = l.layer")
def latest_upsert(spark, d):
    old = latest(spark, d)
    fresh = spark.createDataFrame([("weather", "weather-19950601T00Z"), ("ensemble", "ensemble-19950601T00Z")], "layer string, run_id string")
    return publishing.merged_latest(old, fresh.union(old.where("layer = 'weather-ecmwf'").select("layer", "run_id")))


@query("storage_guard", f"WITH {_LATEST}, kept AS (SELECT run_id FROM latest UNION SELECT previous_run_id FROM latest WHERE layer <> 'weather') SELECT n.run_id, CAST(n.bytes AS BIGINT) AS bytes, sum(n.bytes) OVER () + 1000000 > 8000000 AS over_limit FROM named n WHERE n.run_id IN (SELECT run_id FROM kept WHERE run_id IS NOT NULL)")
def storage_guard(spark, d):
    kept = publishing.retained_bytes(latest(spark, d), runs(spark, d), "weather")
    total = F.sum("bytes").over(Window.partitionBy())  # of two runs for each layer at most
    return kept.withColumn("over_limit", total + 1_000_000 > 8_000_000)


@query("retention_delete", f"WITH {_LATEST} SELECT n.layer, n.run_id FROM named n WHERE NOT EXISTS (SELECT 1 FROM latest l WHERE l.layer = n.layer AND (l.run_id = n.run_id OR l.previous_run_id = n.run_id))")
def retention_delete(spark, d):
    return publishing.runs_to_delete(runs(spark, d).select("layer", "run_id"), latest(spark, d))


@query("newest_two", f"WITH {RUNS}, r AS (SELECT layer, run_id, cycle, row_number() OVER (PARTITION BY layer ORDER BY cycle DESC) AS nth FROM named) SELECT layer, run_id FROM r WHERE nth <= 2")
def newest_two(spark, d):
    return publishing.newest(runs(spark, d)).select("layer", "run_id")


@query("previous_run", f"WITH {RUNS} SELECT layer, run_id, coalesce(lag(run_id) OVER (PARTITION BY layer ORDER BY cycle), '-') AS previous FROM named")
def previous_run(spark, d):
    return runs(spark, d).select("layer", "run_id", F.coalesce(F.lag("run_id").over(Window.partitionBy("layer").orderBy("cycle")), F.lit("-")).alias("previous"))


# --- tiles as stored


def patch_tiles(spark, d):
    """Every embedding as the cells of a tile of its own, eight to a row, encoded; the world has 648 tiles, and each further 648 vectors are the run of a further cycle."""
    k = F.col("vec_id")
    cycle = F.timestamp_seconds(F.lit(1704067200) + F.floor(k / 648) * 21600)  # from 2024-01-01, six hours apart
    rows = table(spark, d, "embeddings").select(
        (k % 18 * 10 - 90).cast("int").alias("lat0"), (F.floor(k / 18) % 36 * 10 - 180).cast("int").alias("lon0"), cycle.alias("at"), F.posexplode("embedding").alias("pos", "e")
    )
    i, j = F.floor(F.col("pos") / 8).cast("int"), (F.col("pos") % 8).cast("int")
    cells = rows.select(
        run_id(F.lit("weather"), F.col("at")).alias("run_id"), F.date_format("at", "yyyy-MM-dd'T'HH:mm'Z'").alias("cycle"), F.lit("patch").alias("variable"), F.lit(None).cast("int").alias("member"), F.lit(0).alias("step_h"),
        i.alias("i"), j.alias("j"), (F.col("lat0") + i).cast("double").alias("lat"), (F.col("lon0") + j).cast("double").alias("lon"), F.col("e").cast("float").alias("value"),
    )
    header = codec.run_header("weather", "derived", "", "", 1.0, 1.0, {"steps": [0]}, [_PATCH])
    return codec.build_tiles(cells, [_PATCH], header)


_CORNERS = f"""WITH {_RAW}, c AS (
  SELECT *, CAST(vec_id % 18 * 10 - 90 AS INTEGER) AS lat0, CAST(vec_id // 18 % 36 * 10 - 180 AS INTEGER) AS lon0,
         'weather-' || strftime(TIMESTAMP '2024-01-01' + to_hours(CAST(vec_id // 648 * 6 AS INTEGER)), '%Y%m%dT%HZ') AS run_id
  FROM raws)"""


@query("codec_roundtrip", f"{_CORNERS} SELECT run_id, {sql_tile('lat0', 'lon0')} AS tile_id, CAST(pos // 8 AS INTEGER) AS i, CAST(pos % 8 AS INTEGER) AS j, CAST(lat0 + pos // 8 AS DOUBLE) AS lat, CAST(lon0 + pos % 8 AS DOUBLE) AS lon, CAST(CAST(raw AS FLOAT) * CAST(0.01 AS FLOAT) AS DOUBLE) AS value FROM c")
def codec_roundtrip(spark, d):
    return codec.read_tiles(patch_tiles(spark, d)).select("run_id", "tile_id", "i", "j", "lat", "lon", F.col("value").cast("double").alias("value"))


@query("tiles_gz")
def tiles_gz(spark, d):
    """Compressed bytes: no SQL makes them."""
    return publishing.manifest_entries(patch_tiles(spark, d), fnv64(F.col("gz")), "run_id", F.octet_length("payload").cast("long").alias("raw_bytes"))


@query("tile_payload_bytes", f"{_CORNERS} SELECT run_id, {sql_tile('lat0', 'lon0')} AS tile_id, string_agg(printf('%02x', (CAST(raw AS INTEGER) + 256) % 256), '' ORDER BY pos) AS payload FROM c GROUP BY 1, 2")
def tile_payload_bytes(spark, d):
    return patch_tiles(spark, d).select("run_id", "tile_id", F.lower(F.right(F.hex("payload"), F.lit(128))).alias("payload"))


@query("tile_header", f"{_CORNERS} SELECT DISTINCT run_id, {sql_tile('lat0', 'lon0')} AS tile_id, CAST(lat0 AS DOUBLE) AS lat0, CAST(lon0 AS DOUBLE) AS lon0, 8 AS nlat, 8 AS nlon, CAST(64 AS BIGINT) AS byte_length FROM c")
def tile_header(spark, d):
    head = F.from_json("header", "run_id string, tile_id string, lat0 double, lon0 double, nlat int, nlon int, variables array<struct<byte_length: long>>")
    rows = patch_tiles(spark, d).select(head.alias("h"))
    return rows.select("h.run_id", "h.tile_id", "h.lat0", "h.lon0", "h.nlat", "h.nlon", F.col("h.variables")[0]["byte_length"].alias("byte_length"))


# --- sizes

_SAMPLES = "samples AS (SELECT o_orderstatus AS layer, o_orderpriority AS stretch, sum(floor(o_totalprice)) AS gz_bytes, sum(floor(o_totalprice)) * 4 AS raw_bytes, count(DISTINCT o_orderkey % 8) AS sampled_steps, 64 AS full_steps FROM orders GROUP BY ALL)"


def samples(spark, d):
    price = F.floor("o_totalprice").cast("double")
    rows = table(spark, d, "orders").groupBy(F.col("o_orderstatus").alias("layer"), F.col("o_orderpriority").alias("stretch"))
    return rows.agg(F.sum(price).alias("gz_bytes"), (F.sum(price) * 4).alias("raw_bytes"), F.count_distinct(F.col("o_orderkey") % 8).alias("sampled_steps")).withColumn("full_steps", F.lit(64))


@query("size_extrapolate", f"WITH {_SAMPLES} SELECT layer, sum(gz_bytes / sampled_steps * full_steps) AS full_bytes FROM samples GROUP BY layer")
def size_extrapolate(spark, d):
    return sizing.extrapolated(samples(spark, d), ["layer"])


@query("compression_ratio", f"WITH {_SAMPLES} SELECT layer, sum(gz_bytes) AS gz_bytes, sum(raw_bytes) AS raw_bytes, sum(gz_bytes) / sum(raw_bytes) AS ratio FROM samples GROUP BY layer")
def compression_ratio(spark, d):
    return sizing.compression(samples(spark, d), ["layer"])


@query("size_verdict", f"WITH {_SAMPLES}, f AS (SELECT layer, sum(gz_bytes / sampled_steps * full_steps) AS b FROM samples GROUP BY layer) SELECT sum(b) AS total_bytes, CAST(0 AS BIGINT) AS failed, CASE WHEN sum(b) <= 4000000000 THEN 'GO' ELSE 'NO-GO' END AS verdict FROM f")
def size_verdict(spark, d):
    return sizing.verdict(sizing.extrapolated(samples(spark, d), ["layer"]).withColumn("failed", F.lit(False)))

