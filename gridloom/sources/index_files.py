"""Index sidecars of multi-message files: one line ``n:start:date:variable:level:forecast:`` for each message."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.operators.scaffold import first_match, next_start


def parse_index(lines: DataFrame) -> DataFrame:
    """lines (file, line_no, value) to file, line_no, var, level, start, end (null: to the end of the file); blank lines fall out."""
    part = F.split("value", ":")
    rows = lines.where(F.trim("value") != "").select("file", "line_no", part[3].alias("var"), part[4].alias("level"), part[1].cast("long").alias("start"))
    return next_start(rows, ["file"], "line_no")


def wanted_ranges(index: DataFrame, wanted: DataFrame) -> DataFrame:
    """The first message of each wanted (var, level, optional) in each file, null where an optional one lacks; raises if another lacks."""
    wanted = F.broadcast(wanted)  # catalogue-sized
    found = first_match(index.join(wanted.select("var", "level"), ["var", "level"], "left_semi"), ["file", "var", "level"], "line_no")
    dense = index.select("file").distinct().crossJoin(wanted)
    return dense.join(found, ["file", "var", "level"], "left").select("file", "var", "level", "optional", "start", "end")
