"""Queries on ensembles, checks, indexes, scaffolds and source rules."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from gridloom import catalog
from gridloom.functions import quantize, speed_kt
from gridloom.operators import checks, ensemble, scaffold
from gridloom.plans.derived import POINTS, SQL_KT, points, query, sql_quantize
from gridloom.session import table
from gridloom.sources import index_files, providers

# ruff: noqa: E501

#: speeds: unique cells (step_h, i, member), single-precision speed in knots rounded to 1/64, so that sums are exact in any order.
SPEEDS = f"""{POINTS}, speeds AS (
  SELECT step_h, CAST(l_partkey % 40 AS INTEGER) AS i, member,
         CASE WHEN count(u) = count(*) THEN CAST(round_even(max(CAST(sqrt(CAST(u * u + v * v AS DOUBLE)) AS FLOAT) * {SQL_KT}) * CAST(64 AS DOUBLE), 0) / 64 AS FLOAT) END AS value
  FROM points GROUP BY ALL)"""


def speeds(spark, d):
    rows = points(spark, d).select("step_h", (F.col("l_partkey") % 40).cast("int").alias("i"), "member", speed_kt(F.col("u"), F.col("v")).alias("s"))
    whole = F.count("s") == F.count(F.lit(1))
    return rows.groupBy("step_h", "i", "member").agg(F.when(whole, (F.rint(F.max("s").cast("double") * 64) / 64).cast("float")).alias("value"))


_MEAN = "CASE WHEN count(value) OVER p = count(*) OVER p THEN CAST(avg(CAST(value AS DOUBLE)) OVER p AS FLOAT) END"
_STATS = f"{SPEEDS}, stats AS (SELECT step_h, i, member, value, {_MEAN} AS mean FROM speeds WINDOW p AS (PARTITION BY step_h, i)), anoms AS (SELECT step_h, i, member, value, mean, CASE WHEN value - mean IS NOT NULL THEN CAST(greatest(least(CAST(value - mean AS DOUBLE), 25), -25) AS FLOAT) END AS anom FROM stats)"


@query("ensemble_mean", f"WITH {SPEEDS} SELECT step_h, i, {sql_quantize('CASE WHEN count(value) = count(*) THEN CAST(avg(CAST(value AS DOUBLE)) AS FLOAT) END', 'i16', '0.01')} AS mean_raw, count(*) AS members, count(value) = count(*) AS complete FROM speeds GROUP BY step_h, i")
def ensemble_mean(spark, d):
    return ensemble.ensemble_mean(speeds(spark, d), ["step_h", "i"]).select("step_h", "i", quantize(F.col("mean"), "i16", 0.01).alias("mean_raw"), "members", "complete")


@query("ensemble_anomaly", f"WITH {_STATS} SELECT step_h, i, member, {sql_quantize('mean', 'i16', '0.01')} AS mean_raw, {sql_quantize('anom', 'i8', '0.2')} AS anom_raw FROM anoms")
def ensemble_anomaly(spark, d):
    found = ensemble.mean_and_anomaly(speeds(spark, d), ["step_h", "i"])
    return found.select("step_h", "i", "member", quantize(F.col("mean"), "i16", 0.01).alias("mean_raw"), quantize(F.col("anom"), "i8", 0.2).alias("anom_raw"))


@query("ensemble_reconstruct", f"WITH {_STATS} SELECT count(*) AS n, count(mean) AS whole, max(abs(CAST(mean + anom AS DOUBLE) - value)) < 0.001 AS exact FROM anoms WHERE mean IS NULL OR abs(value - mean) < 25")
def ensemble_reconstruct(spark, d):
    found = ensemble.reconstruct(ensemble.mean_and_anomaly(speeds(spark, d), ["step_h", "i"])).where("mean is null or abs(value - mean) < 25")
    return found.agg(F.count("*").alias("n"), F.count("mean").alias("whole"), (F.max(F.abs(F.col("speed").cast("double") - F.col("value"))) < 0.001).alias("exact"))


@query("member_completeness", f"WITH {SPEEDS} SELECT step_h, count(DISTINCT member) AS members, count(DISTINCT member) = 7 AS whole FROM speeds GROUP BY step_h")
def member_completeness(spark, d):
    return speeds(spark, d).groupBy("step_h").agg(F.count_distinct("member").alias("members")).withColumn("whole", F.col("members") == 7)


@query("speed_stack", f"WITH {POINTS} SELECT member, step_h, count(*) AS n, {sql_quantize(f'max(CAST(sqrt(CAST(u * u + v * v AS DOUBLE)) AS FLOAT) * {SQL_KT})', 'i16', '0.01')} AS top_raw FROM points GROUP BY member, step_h")
def speed_stack(spark, d):
    rows = points(spark, d).select("member", "step_h", speed_kt(F.col("u"), F.col("v")).alias("s"))
    return rows.groupBy("member", "step_h").agg(F.count("*").alias("n"), F.max("s").alias("s")).select("member", "step_h", "n", quantize(F.col("s"), "i16", 0.01).alias("top_raw"))


@query("members_by_steps", "WITH s AS (SELECT DISTINCT CAST(l_orderkey % 81 * 3 AS INTEGER) AS step_h FROM lineitem), m AS (SELECT 'gec00' AS member UNION ALL SELECT printf('gep%02d', CAST(k AS INTEGER)) FROM (SELECT unnest(range(1, 31)) AS k)) SELECT step_h, member FROM s CROSS JOIN m")
def members_by_steps(spark, d):
    steps = points(spark, d).select("step_h").distinct()
    return scaffold.scaffold(steps, spark.createDataFrame([(m,) for m in providers.MEMBERS], "member string"))


# --- checks

_LONG = f"""{POINTS}, long AS (
  SELECT 'wind_u_kt' AS variable, member, step_h, i, j, u * {SQL_KT} AS value FROM points UNION ALL
  SELECT 'wind_v_kt', member, step_h, i, j, v * {SQL_KT} FROM points UNION ALL
  SELECT 'gust_kt', member, step_h, i, j, gust * {SQL_KT} * CASE WHEN i % 50 = 0 THEN CAST(5 AS FLOAT) ELSE CAST(1 AS FLOAT) END FROM points UNION ALL
  SELECT 'salinity', member, step_h, i, j, CAST(NULL AS FLOAT) FROM points),
cells AS (SELECT variable, member, step_h, i, j, max(value) AS value FROM long GROUP BY ALL)"""


_POINT = ["member", "step_h", "i", "j"]


def wide_cells(spark, d):
    """One row for each point with a column for each variable: one exchange of whole rows."""
    kt = lambda c: c * F.lit(1.943844).cast("float")
    gust = kt(F.col("gust")) * F.when(F.col("i") % 50 == 0, F.lit(5.0).cast("float")).otherwise(F.lit(1.0).cast("float"))
    values = {"wind_u_kt": kt(F.col("u")), "wind_v_kt": kt(F.col("v")), "gust_kt": gust}
    return points(spark, d).groupBy(*_POINT).agg(*[F.max(v.cast("float")).alias(n) for n, v in values.items()])


def cells(spark, d):
    """The same points with a row for each variable, turned after the exchange; salinity is always missing."""
    wide = wide_cells(spark, d).withColumn("salinity", F.lit(None).cast("float"))
    return wide.unpivot(_POINT, ["wind_u_kt", "wind_v_kt", "gust_kt", "salinity"], "variable", "value")


_RANGES = "ranges AS (" + " UNION ALL ".join(f"SELECT '{k}' AS variable, CAST({a} AS DOUBLE) AS low, CAST({b} AS DOUBLE) AS high" for k, (a, b) in catalog.RANGES.items()) + ")"


@query("range_check", f"WITH {_LONG}, {_RANGES}, s AS (SELECT variable, min(value) AS least, max(value) AS most FROM cells GROUP BY variable) SELECT s.variable, least IS NULL OR (least >= CAST(coalesce(low, '-inf'::DOUBLE) - CAST(0.1 AS DOUBLE) AS FLOAT) AND most <= CAST(coalesce(high, 'inf'::DOUBLE) + CAST(0.1 AS DOUBLE) AS FLOAT)) AS ok FROM s LEFT JOIN ranges r ON r.variable = s.variable")
def range_check(spark, d):
    return checks.range_check(checks.variable_statistics(cells(spark, d)).withColumn("scale", F.lit(0.1)), catalog.ranges_table(spark))


@query("missing_fraction", f"WITH {_LONG} SELECT variable, avg(CASE WHEN value IS NULL THEN 1.0::DOUBLE ELSE 0 END) AS missing FROM cells GROUP BY variable")
def missing_fraction(spark, d):
    return checks.missing_fractions(cells(spark, d))


@query("layer_limits", "SELECT layer, lim AS max_missing, CAST(n AS BIGINT) AS n FROM (" + " UNION ALL ".join(f"SELECT '{k}' AS layer, CAST({v[3]} AS DOUBLE) AS lim, 1 AS n" for k, v in catalog.LAYERS.items()) + ")")
def layer_limits(spark, d):
    return spark.createDataFrame([(k, v[3]) for k, v in catalog.LAYERS.items()], "layer string, max_missing double").groupBy("layer", "max_missing").agg(F.count("*").alias("n"))


@query("gust_consistency", f"WITH {_LONG}, w AS (SELECT member, step_h, i, j, max(CASE WHEN variable = 'wind_u_kt' THEN value END) AS u, max(CASE WHEN variable = 'wind_v_kt' THEN value END) AS v, max(CASE WHEN variable = 'gust_kt' THEN value END) AS g FROM cells GROUP BY ALL), b AS (SELECT member, CAST(sqrt(CAST(u * u + v * v AS DOUBLE)) AS FLOAT) AS s, g FROM w WHERE u IS NOT NULL AND v IS NOT NULL AND g IS NOT NULL) SELECT member, avg(CASE WHEN s <= g + CAST(2 AS FLOAT) THEN 1.0::DOUBLE ELSE 0 END) AS share, count(*) AS points FROM b GROUP BY member")
def gust_consistency(spark, d):
    return checks.gust_share(wide_cells(spark, d), speed_kt(F.col("wind_u_kt"), F.col("wind_v_kt"), to_kt=False), F.col("gust_kt"), ("member",))


@query("gust_mean_consistency", f"WITH {SPEEDS}, m AS (SELECT step_h, i, CASE WHEN count(value) = count(*) THEN CAST(avg(CAST(value AS DOUBLE)) AS FLOAT) END AS w FROM speeds GROUP BY step_h, i), g AS (SELECT step_h, i, w, w - CAST(i % 5 AS FLOAT) AS gm FROM m) SELECT i, avg(CASE WHEN w <= gm + CAST(2 AS FLOAT) THEN 1.0::DOUBLE ELSE 0 END) AS share, count(*) AS points FROM g WHERE w IS NOT NULL AND gm IS NOT NULL GROUP BY i")
def gust_mean_consistency(spark, d):
    m = ensemble.ensemble_mean(speeds(spark, d), ["step_h", "i"]).withColumn("gust_mean", F.col("mean") - (F.col("i") % 5).cast("float"))
    return checks.gust_share(m, F.col("mean"), F.col("gust_mean"), ("i",))


@query("step_coverage", f"WITH {_LONG} SELECT variable, count(*) AS n, count(DISTINCT step_h) AS steps, count(DISTINCT member) AS members, max(i) AS i_last, max(j) AS j_last, count(DISTINCT step_h) = 81 AS whole FROM cells GROUP BY variable")
def step_coverage(spark, d):
    return checks.variable_statistics(cells(spark, d)).select("variable", "n", "steps", "members", "i_last", "j_last", (F.col("steps") == 81).alias("whole"))


@query("presence_check", f"WITH {_LONG}, w AS (SELECT unnest(['wind_u_kt', 'wind_v_kt', 'gust_kt', 'visibility_m']) AS variable) SELECT variable, EXISTS (SELECT 1 FROM cells c WHERE c.variable = w.variable) AS present FROM w")
def presence_check(spark, d):
    wanted = spark.createDataFrame([(v,) for v in ("wind_u_kt", "wind_v_kt", "gust_kt", "visibility_m")], "variable string")
    have = cells(spark, d).select("variable").distinct().withColumn("have", F.lit(True))
    return wanted.join(have, "variable", "left").select("variable", F.col("have").isNotNull().alias("present"))


@query("member_count_check", f"WITH {SPEEDS} SELECT i, count(DISTINCT member) AS members, count(DISTINCT member) = 31 AS ok FROM speeds GROUP BY i")
def member_count_check(spark, d):
    return speeds(spark, d).groupBy("i").agg(F.count_distinct("member").alias("members")).withColumn("ok", F.col("members") == 31)


@query("validation_report", f"WITH {_LONG}, s AS (SELECT variable, avg(CASE WHEN value IS NULL THEN 1.0::DOUBLE ELSE 0 END) AS m, count(DISTINCT step_h) AS steps FROM cells WHERE variable <> 'salinity' GROUP BY variable), c AS (SELECT 'step_coverage[' || variable || ']' AS name, steps = 81 AS passed FROM s UNION ALL SELECT 'missing_fraction[' || variable || ']', m <= 0.05 FROM s) SELECT name, passed, CAST(count_if(passed) OVER () AS BIGINT) AS n_passed, CAST(count_if(NOT passed) OVER () AS BIGINT) AS n_failed FROM c")
def validation_report(spark, d):
    found = checks.variable_statistics(cells(spark, d).where("variable <> 'salinity'"))
    name = lambda kind: F.concat(F.lit(kind + "["), F.col("variable"), F.lit("]"))
    entries = F.explode(F.array(F.struct(name("step_coverage").alias("name"), (F.col("steps") == 81).alias("passed")), F.struct(name("missing_fraction").alias("name"), ((1 - F.col("present") / F.col("n")) <= 0.05).alias("passed"))))
    rows = found.select(entries.alias("c")).select("c.*")
    total = rows.agg(F.count_if("passed").alias("n_passed"), F.count_if(~F.col("passed")).alias("n_failed"))  # one row
    return rows.crossJoin(F.broadcast(total))


# --- indexes and scaffolds

_IDX = "idx AS (SELECT l_suppkey AS file, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice) AS line_no, l_returnflag AS var, l_linenumber || ' m' AS level, l_orderkey AS start FROM lineitem)"


def index_rows(spark, d):
    order = Window.partitionBy("l_suppkey").orderBy("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    return table(spark, d, "lineitem").select(F.col("l_suppkey").alias("file"), F.row_number().over(order).cast("long").alias("line_no"), F.col("l_returnflag").alias("var"), F.concat(F.col("l_linenumber").cast("string"), F.lit(" m")).alias("level"), F.col("l_orderkey").alias("start"))


@query("idx_parse", f"WITH {_IDX} SELECT file, line_no, var, level, start, coalesce(lead(start) OVER (PARTITION BY file ORDER BY line_no), -1) AS end_or_open FROM idx")
def idx_parse(spark, d):
    rows = index_rows(spark, d)
    line = F.format_string("%d:%d:d=2026071306:%s:%s:3 hour fcst:", "line_no", "start", "var", "level")
    found = index_files.parse_index(rows.select("file", "line_no", line.alias("value")))
    return found.select("file", "line_no", "var", "level", "start", F.coalesce("end", F.lit(-1)).alias("end_or_open"))


@query("idx_first_match", f"WITH {_IDX} SELECT file, var, level, min(line_no) AS line_no, arg_min(start, line_no) AS start FROM idx GROUP BY file, var, level")
def idx_first_match(spark, d):
    return scaffold.first_match(index_rows(spark, d), ["file", "var", "level"], "line_no").select("file", "var", "level", "line_no", "start")


@query("idx_wanted_ranges", f"WITH {_IDX}, r AS (SELECT *, lead(start) OVER (PARTITION BY file ORDER BY line_no) AS e FROM idx), w AS (SELECT 'R' AS var, '1 m' AS level, false AS optional UNION ALL SELECT 'X', '9 m', true), f AS (SELECT file, var, level, arg_min(start, line_no) AS start, arg_min(e, line_no) AS \"end\" FROM r WHERE (var, level) IN (SELECT (var, level) FROM w) GROUP BY ALL) SELECT x.file, w.var, w.level, w.optional, coalesce(f.start, -1) AS start_or_none, coalesce(f.\"end\", -1) AS end_or_open FROM (SELECT DISTINCT file FROM idx) x CROSS JOIN w LEFT JOIN f ON f.file = x.file AND f.var = w.var AND f.level = w.level")
def idx_wanted_ranges(spark, d):
    wanted = spark.createDataFrame([("R", "1 m", False), ("X", "9 m", True)], "var string, level string, optional boolean")
    found = index_files.wanted_ranges(scaffold.next_start(index_rows(spark, d), ["file"], "line_no"), wanted)
    return found.select("file", "var", "level", "optional", F.coalesce("start", F.lit(-1)).alias("start_or_none"), F.coalesce("end", F.lit(-1)).alias("end_or_open"))


@query("wanted_filter", "SELECT l_returnflag, l_linenumber, count(*) AS n FROM lineitem WHERE (l_returnflag = 'R' AND l_linenumber = 1) OR (l_returnflag = 'A' AND l_linenumber = 3) GROUP BY ALL")
def wanted_filter(spark, d):
    wanted = F.broadcast(spark.createDataFrame([("R", 1), ("A", 3)], "l_returnflag string, l_linenumber int"))
    return table(spark, d, "lineitem").join(wanted, ["l_returnflag", "l_linenumber"], "left_semi").groupBy("l_returnflag", "l_linenumber").agg(F.count("*").alias("n"))


@query("depth_filter", "SELECT l_shipdate, sum(l_quantity) AS q FROM lineitem WHERE l_linenumber = 1 GROUP BY l_shipdate")
def depth_filter(spark, d):
    return table(spark, d, "lineitem").where("l_linenumber = 1").groupBy("l_shipdate").agg(F.sum("l_quantity").alias("q"))




@query("instant_select", f"WITH w AS (SELECT CAST(TIMESTAMP '1995-01-01' + k * INTERVAL 6 DAY AS TIMESTAMP) AS instant FROM (SELECT unnest(range(0, 41)) AS k)) SELECT w.instant, count(*) AS n FROM w JOIN lineitem ON CAST(l_shipdate AS TIMESTAMP) = w.instant GROUP BY w.instant")
def instant_select(spark, d):
    w = F.broadcast(_instants(spark))
    return table(spark, d, "lineitem").join(w, F.col("l_shipdate") == F.col("instant")).groupBy("instant").agg(F.count("*").alias("n"))


def _instants(spark):
    return spark.range(41).select((F.lit("1995-01-01").cast("timestamp") + F.make_dt_interval(F.col("id").cast("int") * 6)).alias("instant"))


@query("missing_instants", "WITH w AS (SELECT CAST(TIMESTAMP '1995-01-01' + k * INTERVAL 6 DAY AS TIMESTAMP) AS instant FROM (SELECT unnest(range(0, 41)) AS k)) SELECT instant FROM w WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_linenumber = 7 AND l_returnflag = 'R' AND l_shipdate = w.instant)")
def missing_instants(spark, d):
    have = table(spark, d, "lineitem").where("l_linenumber = 7 and l_returnflag = 'R'").select(F.col("l_shipdate").alias("instant"))
    return scaffold.missing(_instants(spark), have, ["instant"])


_STEPS = "steps AS (SELECT unnest(range(0, 241, 3)) AS step_h), vars AS (SELECT unnest(['A', 'N', 'R']) AS var)"


def _dense(spark, d):
    """A station is a supplier: there are more steps by variables by stations than most tables have rows for, hence gaps."""
    stations = table(spark, d, "supplier").select(F.col("s_suppkey").alias("station"))
    fields = scaffold.scaffold(spark.range(0, 241, 3).select(F.col("id").cast("int").alias("step_h")), spark.createDataFrame([("A",), ("N",), ("R",)], "var string"))
    return scaffold.scaffold(stations, fields)


def _found(spark, d):
    return table(spark, d, "lineitem").select(F.col("l_suppkey").alias("station"), (F.col("l_orderkey") % 81 * 3).cast("int").alias("step_h"), F.col("l_returnflag").alias("var"), "l_quantity")


_DENSE = "SELECT s_suppkey AS station, CAST(step_h AS INTEGER) AS step_h, var FROM supplier CROSS JOIN steps CROSS JOIN vars"


@query("scaffold_fill", f"WITH {_STEPS}, dense AS ({_DENSE}), f AS (SELECT l_suppkey AS station, l_orderkey % 81 * 3 AS step_h, l_returnflag AS var, count(*) AS n, max(l_quantity) AS top FROM lineitem GROUP BY ALL) SELECT s.station, s.step_h, s.var, coalesce(n, 0) AS n, coalesce(CAST(top AS SMALLINT), -32768) AS raw FROM dense s LEFT JOIN f ON f.station = s.station AND f.step_h = s.step_h AND f.var = s.var")
def scaffold_fill(spark, d):
    found = _found(spark, d).groupBy("station", "step_h", "var").agg(F.count("*").alias("n"), F.max("l_quantity").alias("top"))
    return scaffold.filled(_dense(spark, d), found, ["station", "step_h", "var"]).select("station", "step_h", "var", F.coalesce("n", F.lit(0)).alias("n"), quantize(F.col("top"), "i16", 1.0).alias("raw"))


@query("missing_steps", f"WITH {_STEPS}, dense AS ({_DENSE}) SELECT s.station, s.step_h, s.var FROM dense s ANTI JOIN lineitem ON l_suppkey = s.station AND l_orderkey % 81 * 3 = s.step_h AND l_returnflag = s.var")
def missing_steps(spark, d):
    return scaffold.missing(_dense(spark, d), _found(spark, d), ["station", "step_h", "var"])


_KINDS = "CASE l_linenumber WHEN 1 THEN '10u' WHEN 2 THEN '10v' WHEN 3 THEN '10FG3' WHEN 4 THEN 'i10fg' ELSE 'msl' END"
_KIND = "CASE WHEN n = '10u' THEN 'u' WHEN n = '10v' THEN 'v' WHEN lower(n) IN ('10fg', 'fg10', '10fg3', '10fg6', 'gust', 'i10fg', 'p10fg') THEN 'gust' ELSE n END"


def open_fields(spark, d):
    k = F.col("l_linenumber")
    name = F.when(k == 1, "10u").when(k == 2, "10v").when(k == 3, "10FG3").when(k == 4, "i10fg").otherwise("msl")
    step = (F.col("l_orderkey") % 81 * 3).cast("int")
    span = F.when(F.col("l_partkey") % 2 == 0, F.concat_ws("-", (step - 3).cast("string"), step.cast("string"))).otherwise(step.cast("string"))
    return table(spark, d, "lineitem").select(providers.kind_of(name).alias("kind"), providers.step_of_range(span).alias("step_h"), (F.col("l_orderkey") % 97).alias("k"))


_OPEN = f"raw AS (SELECT {_KINDS} AS n, CAST(l_orderkey % 81 * 3 AS INTEGER) AS step_h, l_orderkey % 97 AS k FROM lineitem), fields AS (SELECT {_KIND} AS kind, step_h, k FROM raw)"


@query("field_kinds", f"WITH {_OPEN} SELECT kind, step_h, count(*) AS n FROM fields GROUP BY ALL")
def field_kinds(spark, d):
    return open_fields(spark, d).groupBy("kind", "step_h").agg(F.count("*").alias("n"))


@query("wind_steps_missing", f"WITH {_OPEN} SELECT k, step_h FROM fields GROUP BY k, step_h HAVING count(DISTINCT CASE WHEN kind IN ('u', 'v') THEN kind END) < 2")
def wind_steps_missing(spark, d):
    rows = open_fields(spark, d).groupBy("k", "step_h").agg(F.count_distinct(F.when(F.col("kind").isin("u", "v"), F.col("kind"))).alias("kinds"))
    return rows.where("kinds < 2").select("k", "step_h")


@query("gust_all_or_nothing", f"WITH {_OPEN}, s AS (SELECT DISTINCT step_h FROM fields WHERE step_h > 0) SELECT k, count(DISTINCT CASE WHEN kind = 'gust' AND step_h > 0 THEN step_h END) AS gust_steps, count(DISTINCT CASE WHEN kind = 'gust' AND step_h > 0 THEN step_h END) = (SELECT count(*) FROM s) AS gusts FROM fields GROUP BY k")
def gust_all_or_nothing(spark, d):
    rows = open_fields(spark, d)
    total = rows.where("step_h > 0").agg(F.count_distinct("step_h").alias("total"))  # one row
    found = rows.groupBy("k").agg(F.count_distinct(F.when((F.col("kind") == "gust") & (F.col("step_h") > 0), F.col("step_h"))).alias("gust_steps"))
    return found.crossJoin(F.broadcast(total)).select("k", "gust_steps", (F.col("gust_steps") == F.col("total")).alias("gusts"))


@query("available_members", "WITH m AS (SELECT k AS ord, CASE WHEN k = 0 THEN 'gec00' ELSE printf('gep%02d', CAST(k AS INTEGER)) END AS member FROM (SELECT unnest(range(0, 31)) AS k)) SELECT CAST(ord AS INTEGER) AS ord, member FROM m WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_suppkey % 31 = ord AND l_orderkey % 81 = 80)")
def available_members(spark, d):
    members = spark.createDataFrame(list(enumerate(providers.MEMBERS)), "ord int, member string")
    have = table(spark, d, "lineitem").where("l_orderkey % 81 = 80").select((F.col("l_suppkey") % 31).cast("int").alias("ord"))
    return members.join(have, "ord", "left_semi")


@query("gust_available", "SELECT l_suppkey AS member, count(DISTINCT CASE WHEN l_orderkey % 81 IN (1, 80) AND l_returnflag = 'R' THEN l_orderkey % 81 END) = 2 AS gusts FROM lineitem GROUP BY l_suppkey")
def gust_available(spark, d):
    step = F.col("l_orderkey") % 81
    return table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("member")).agg((F.count_distinct(F.when(step.isin(1, 80) & (F.col("l_returnflag") == "R"), step)) == 2).alias("gusts"))


@query("gust_param", "SELECT l_shipdate, arg_min(p, ord) AS param FROM (SELECT l_shipdate, l_linenumber % 3 AS ord, CASE l_linenumber % 3 WHEN 0 THEN '10fg' WHEN 1 THEN '10fg3' ELSE '10fg6' END AS p FROM lineitem) GROUP BY l_shipdate")
def gust_param(spark, d):
    k = (F.col("l_linenumber") % 3).cast("int")
    p = F.element_at(F.array(*map(F.lit, providers.GUST_PARAMS)), k + 1)
    return table(spark, d, "lineitem").groupBy("l_shipdate").agg(F.min_by(p, k).alias("param"))


@query("step_urls", "SELECT DISTINCT CAST(l_orderkey % 81 * 3 AS INTEGER) AS step, 'https://noaa-gfs-bdp-pds.s3.amazonaws.com/gfs.' || strftime(l_shipdate, '%Y%m%d') || '/' || strftime(l_shipdate, '%H') || '/atmos/gfs.t' || strftime(l_shipdate, '%H') || 'z.pgrb2.0p25.f' || printf('%03d', CAST(l_orderkey % 81 * 3 AS INTEGER)) AS weather, 'https://noaa-gefs-pds.s3.amazonaws.com/gefs.' || strftime(l_shipdate, '%Y%m%d') || '/' || strftime(l_shipdate, '%H') || '/atmos/pgrb2ap5/gep01.t' || strftime(l_shipdate, '%H') || 'z.pgrb2a.0p50.f' || printf('%03d', CAST(l_orderkey % 81 * 3 AS INTEGER)) AS ensemble FROM lineitem")
def step_urls(spark, d):
    rows = table(spark, d, "lineitem").select((F.col("l_orderkey") % 81 * 3).cast("int").alias("step"), F.col("l_shipdate").alias("cycle"))
    return rows.select("step", providers.url_column("weather", F.col("cycle"), F.col("step")).alias("weather"), providers.url_column("ensemble", F.col("cycle"), F.col("step"), F.lit("gep01")).alias("ensemble")).distinct()


@query("urls_digest", "SELECT l_shipdate, substr(sha256(string_agg(u || chr(10), '' ORDER BY u)), 1, 16) AS digest FROM (SELECT DISTINCT l_shipdate, 'https://h/gep' || printf('%02d', CAST(l_linenumber AS INTEGER)) || '/f' || printf('%03d', CAST(l_orderkey % 81 * 3 AS INTEGER)) AS u FROM lineitem) GROUP BY l_shipdate")
def urls_digest(spark, d):
    """A day is a run of seven members and 81 steps, so a group has at most 567 URLs however many rows there are."""
    u = F.concat(F.lit("https://h/gep"), F.format_string("%02d", F.col("l_linenumber").cast("int")), F.lit("/f"), F.format_string("%03d", (F.col("l_orderkey") % 81 * 3).cast("int")))
    return table(spark, d, "lineitem").groupBy("l_shipdate").agg(providers.urls_digest(u).alias("digest"))


@query("first_grid", f"WITH {POINTS} SELECT step_h, arg_min(lat, l_orderkey * 1000000 + l_partkey * 10 + l_linenumber) AS lat FROM points WHERE u IS NOT NULL GROUP BY step_h")
def first_grid(spark, d):
    order = F.col("l_orderkey") * 1000000 + F.col("l_partkey") * 10 + F.col("l_linenumber")
    return points(spark, d).where("u is not null").groupBy("step_h").agg(F.min_by("lat", order).alias("lat"))
