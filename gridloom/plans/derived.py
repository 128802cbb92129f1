"""The derived cube: forecast cells from lineitem, the same expressions for Spark and SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions import longitude
from gridloom.session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers a plan under a name, and its SQL over the same tables."""

    def register(plan):
        QUERIES[name] = plan
        if sql:
            ORACLE_SQL[name] = sql
        return plan

    return register


#: points: one row for each line of an order; p: its place, u, v, gust in metres a second, null at every fifth place of member 6.
POINTS = """points AS (
  SELECT l_orderkey, l_partkey, l_linenumber, CAST(l_partkey % 721 AS INTEGER) AS i, CAST(l_orderkey % 1440 AS INTEGER) AS j,
         CAST(l_partkey % 721 AS DOUBLE) * CAST(0.25 AS DOUBLE) - 90 AS lat,
         (((CAST(l_orderkey % 1440 AS DOUBLE) * CAST(0.25 AS DOUBLE) + 180) % 360 + 360) % 360) - 180 AS lon,
         CAST(l_orderkey % 81 * 3 AS INTEGER) AS step_h, CAST(l_linenumber - 1 AS INTEGER) AS member,
         CASE WHEN l_linenumber <> 7 OR l_partkey % 5 <> 0 THEN CAST(l_quantity - 25.5 AS FLOAT) END AS u,
         CASE WHEN l_linenumber <> 7 OR l_partkey % 5 <> 0 THEN CAST(l_discount * 200 - 10 AS FLOAT) END AS v,
         CASE WHEN l_linenumber <> 7 OR l_partkey % 5 <> 0 THEN CAST(sqrt((l_quantity - 25.5) * (l_quantity - 25.5) + (l_discount * 200 - 10) * (l_discount * 200 - 10)) + l_tax * 10 AS FLOAT) END AS gust
  FROM lineitem)"""


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem")
    u, v = F.col("l_quantity") - 25.5, F.col("l_discount") * 200 - 10
    there = (F.col("l_linenumber") != 7) | (F.col("l_partkey") % 5 != 0)
    return rows.select(
        "l_orderkey", "l_partkey", "l_linenumber", (F.col("l_partkey") % 721).cast("int").alias("i"), (F.col("l_orderkey") % 1440).cast("int").alias("j"),
        ((F.col("l_partkey") % 721).cast("double") * 0.25 - 90).alias("lat"), longitude((F.col("l_orderkey") % 1440).cast("double") * 0.25).alias("lon"),
        (F.col("l_orderkey") % 81 * 3).cast("int").alias("step_h"), (F.col("l_linenumber") - 1).cast("int").alias("member"),
        F.when(there, u.cast("float")).alias("u"), F.when(there, v.cast("float")).alias("v"), F.when(there, (F.sqrt(u * u + v * v) + F.col("l_tax") * 10).cast("float")).alias("gust"),
    )


def sql_quantize(value: str, dtype: str, scale: str) -> str:
    low, high, kind = {"i16": (-32768, 32767, "SMALLINT"), "i8": (-128, 127, "TINYINT")}[dtype]
    x = f"CAST({value} AS DOUBLE)"
    return f"CAST(CASE WHEN {x} IS NULL OR isnan({x}) THEN {low} ELSE greatest(least(round_even({x} / CAST({scale} AS DOUBLE), 0), {high}), {low + 1}) END AS {kind})"


def sql_tile(lat0: str, lon0: str) -> str:
    return f"printf('%s%02d%s%03d', CASE WHEN {lat0} >= 0 THEN 'N' ELSE 'S' END, CAST(abs({lat0}) AS INTEGER), CASE WHEN {lon0} >= 0 THEN 'E' ELSE 'W' END, CAST(abs({lon0}) AS INTEGER))"


def sql_origin(x: str) -> str:
    return f"CAST(floor({x} / 10) * 10 AS INTEGER)"


SQL_KT = "CAST(1.943844 AS FLOAT)"
#: Runs from orders: the status is the layer, the date the cycle.
RUNS = """runs AS (
  SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'weather' WHEN 'O' THEN 'weather-ecmwf' ELSE 'waves' END AS layer,
         date_trunc('day', o_orderdate) AS cycle, CAST(floor(o_totalprice) AS BIGINT) AS bytes FROM orders),
named AS (SELECT layer, cycle, layer || '-' || strftime(cycle, '%Y%m%dT%HZ') AS run_id, sum(bytes) AS bytes FROM runs GROUP BY ALL)"""


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gridloom.functions import run_id

    rows = table(spark, sf_dir, "orders")
    layer = F.when(F.col("o_orderstatus") == "F", "weather").when(F.col("o_orderstatus") == "O", "weather-ecmwf").otherwise("waves")
    rows = rows.select(layer.alias("layer"), F.date_trunc("day", "o_orderdate").alias("cycle"), F.floor("o_totalprice").cast("long").alias("bytes"))
    return rows.groupBy("layer", "cycle").agg(F.sum("bytes").alias("bytes")).select("layer", "cycle", run_id(F.col("layer"), F.col("cycle")).alias("run_id"), "bytes")
