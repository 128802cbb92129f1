"""Validation of a run before anything is published: one pass of aggregates by variable and one by point."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.catalog import GUST_SHARE, GUST_SLACK_KT, RANGES, Variable
from gridloom.functions.quant import f32


@dataclass
class Report:
    passed: list[str] = field(default_factory=list)
    failures: list[str] = field(default_factory=list)

    def check(self, name: str, ok: bool, detail: str = "") -> None:
        (self.passed if ok else self.failures).append(name if ok else f"{name}: {detail}")

    @property
    def ok(self) -> bool:
        return not self.failures

    def summary(self) -> str:
        return "\n".join([f"validation: {len(self.passed)} checks passed, {len(self.failures)} failed", *(f"  FAIL {x}" for x in self.failures)])


def variable_statistics(cells: DataFrame, keys: tuple[str, ...] = ("variable",)) -> DataFrame:
    """All that the checks of single variables need, in one aggregation with map-side combining.

    Steps and members are small sets; distinct counts of both would copy every cell three times.
    """
    return cells.groupBy(*keys).agg(
        F.count("*").alias("n"), F.count("value").alias("present"), F.min("value").alias("least"), F.max("value").alias("most"),
        F.size(F.collect_set("step_h")).cast("long").alias("steps"), F.size(F.collect_set("member")).cast("long").alias("members"), F.max("i").alias("i_last"), F.max("j").alias("j_last"),
    )


def range_check(statistics: DataFrame, ranges: DataFrame, scale: str = "scale") -> DataFrame:
    """variable, ok: extremes within one step of the range, compared in single precision; no data passes, no range has no bound."""
    low = F.coalesce(F.col("low"), F.lit(float("-inf")))
    high = F.coalesce(F.col("high"), F.lit(float("inf")))
    ok = F.col("least").isNull() | ((F.col("least") >= (low - F.col(scale)).cast("float")) & (F.col("most") <= (high + F.col(scale)).cast("float")))
    return statistics.join(F.broadcast(ranges), "variable", "left").select("variable", ok.alias("ok"))


def missing_fractions(cells: DataFrame, keys: tuple[str, ...] = ("variable",)) -> DataFrame:
    return cells.groupBy(*keys).agg(F.avg(F.col("value").isNull().cast("double")).alias("missing"))


def gust_share(points: DataFrame, speed, gust, keys: tuple[str, ...] = ()) -> DataFrame:
    """keys, share, points: where both are there, how often the speed is at most the gust and two knots."""
    both = points.where(speed.isNotNull() & gust.isNotNull())
    return both.groupBy(*keys).agg(F.avg((speed <= gust + f32(GUST_SLACK_KT)).cast("double")).alias("share"), F.count("*").alias("points"))


def by_point(cells: DataFrame, names: list[str], keys: list[str]) -> DataFrame:
    """One row for each point with a column for each variable, by one shuffle."""
    picked = [F.max(F.when(F.col("variable") == n, F.col("value"))).alias(n) for n in names]
    return cells.where(F.col("variable").isin(names)).groupBy(*keys).agg(*picked)


def validate(cells: DataFrame, variables: list[Variable], axes: dict[str, list[int]], nlat: int, nlon: int, members: int = 1, max_missing: float = 0.05, expected_axes: dict[str, list[int]] | None = None) -> Report:
    """The report on cells (variable, member, step_h, i, j, value), in the order of the checks.

    The names of the checks are an output that manifests and statuses carry. Only one row for each
    variable and one for each gust rule reach the driver.
    """
    report = Report()
    for name, hours in axes.items():
        report.check(f"axis_monotonic[{name}]", bool(hours) and all(a < b for a, b in zip(hours, hours[1:], strict=False)), f"offsets {hours[:5]} are not strictly increasing")
    for name, hours in (expected_axes or {}).items():
        report.check(f"axis_complete[{name}]", axes.get(name) == hours, f"{len(axes.get(name) or [])} of {len(hours)} offsets")
    found = {r["variable"]: r for r in variable_statistics(cells.where(F.col("variable").isin([v.name for v in variables]))).collect()}
    usable = set()
    for v in variables:
        r = found.get(v.name)
        if r is None:
            report.check(f"present[{v.name}]", False, "no cells")
            continue
        steps, wanted = len(axes[v.axis]), members if v.per_member else 1
        shape = (max(1, r["members"]), r["steps"], r["i_last"] + 1, r["j_last"] + 1)
        whole = r["n"] == wanted * steps * nlat * nlon and shape == (wanted, steps, nlat, nlon)
        report.check(f"step_coverage[{v.name}]", whole, f"shape {shape}, expected {(wanted, steps, nlat, nlon)}")
        if not whole:
            continue
        usable.add(v.name)
        low, high = RANGES.get(v.name, (float("-inf"), float("inf")))
        inside = r["least"] is None or (r["least"] >= low - v.scale and r["most"] <= high + v.scale)
        report.check(f"physical_range[{v.name}]", inside, f"{r['least']}..{r['most']} is not in {low}..{high}")
        share = 1 - r["present"] / r["n"]
        report.check(f"missing_fraction[{v.name}]", share <= max_missing, f"{share:.3f} over {max_missing}")
    point = ["step_h", "i", "j"]
    rules = [("gust_kt", ["wind_u_kt", "wind_v_kt", "gust_kt"], F.sqrt(F.col("wind_u_kt") ** 2 + F.col("wind_v_kt") ** 2).cast("float")), ("gust_kt_mean", ["wind_kt_mean", "gust_kt_mean"], F.col("wind_kt_mean"))]
    for gust, names, speed in rules:
        if usable.issuperset(names):
            r = gust_share(by_point(cells, names, point), speed, F.col(gust)).first()
            share = r["share"] if r and r["points"] else None
            report.check(f"gust_ge_wind[{gust}]", share is not None and share >= GUST_SHARE, "no point has both" if share is None else f"holds at {share:.4f} of points")
    if per_member := [v.name for v in variables if v.per_member]:
        counts = {n: found[n]["members"] if n in found else 0 for n in per_member}
        report.check("member_count", all(c == members for c in counts.values()), f"{counts}, expected {members}")
    return report
