"""Which weather stations explain a zone's demand best: every subset, scored.

The regression of each subset needs only moments per (hour, weekday), so the observations
are reduced to at most 168 rows per (zone, subset), these to one matrix, and that is solved in place.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zoneflow.functions.calendar import degree_hours_f
from zoneflow.functions.clock import plus_hours
from zoneflow.functions.display import c_to_f

#: Stations of a zone at most; the observations are multiplied by all subsets of them.
MOST_STATIONS = 10
SUBSET = ["zone", "mask"]
MOMENTS = ["y", "c", "h"]
#: In the order in which they are taken out: weekdays, degree hours; demand last.
VARIABLES = [*[f"day{d}" for d in range(7)], "c", "h", "y"]
#: Share of a variable's own squares below which what is left of it is rounding.
NOTHING = 1e-12


def station_subsets(candidates: DataFrame) -> DataFrame:
    """Every non-empty subset of a zone's stations as a bit mask. `candidates` is the station
    list (zone, city), a handful per zone."""
    zones = candidates.groupBy("zone").agg(F.sort_array(F.collect_set("city")).alias("cities"))
    too_many = F.concat(F.lit("zone "), "zone", F.lit(f" has over {MOST_STATIONS} stations: their subsets double with each"))
    checked = F.when(F.size("cities") > MOST_STATIONS, F.raise_error(too_many)).otherwise(F.col("cities"))
    zones = zones.withColumn("cities", checked)
    masks = F.expr("sequence(1, shiftleft(1, size(cities)) - 1)")
    subset = F.filter("cities", lambda c, i: F.getbit(F.col("mask"), i) == 1)
    return (
        zones.select("zone", "cities", F.explode(masks).alias("mask"))
        .withColumn("subset", subset)
        .select("zone", "mask", "subset", F.size("subset").alias("n"), F.array_join("subset", " + ").alias("stations"))
    )


def station_pivot(temps: DataFrame, candidates: DataFrame) -> DataFrame:
    """One column per station of the station list, mean where a station reports twice."""
    cities = sorted(r.city for r in candidates.select("city").distinct().collect())
    return temps.groupBy("zone", "time").pivot("city", cities).agg(F.avg("temperature"))


def subset_observations(temps: DataFrame, load: DataFrame, candidates: DataFrame) -> DataFrame:
    """One row per (zone, hour, subset): demand with the subset's degree hours.

    `temps` is (time = hour beginning, zone, city, temperature), `load` is (time, zone,
    demand_mw). Stations missing in an hour are left out of its mean. Load is joined before
    the rows are multiplied by the subsets. A reading meets the subsets of its own station, so the
    join is on zone and station and adaptive execution can split it; the mean is computed once for
    each subset and hour. Pass `candidates` as a file or a written table, so that Spark knows how
    small it is and can broadcast it.
    """
    subsets = station_subsets(candidates)
    per_city = temps.groupBy("zone", "time", "city").agg(F.avg("temperature").alias("t"))
    joined = per_city.withColumn("time", plus_hours("time", 1)).join(load, ["zone", "time"])
    member = subsets.select("zone", "mask", "n", "stations", F.explode("subset").alias("city"))
    rows = joined.join(member, ["zone", "city"]).groupBy("zone", "time", "mask", "n", "stations", "demand_mw").agg(F.avg("t").alias("mean_c"))
    rows = rows.withColumn("temp_f", c_to_f(F.col("mean_c"))).transform(degree_hours_f)
    return rows.select(
        "zone", "mask", "n", "stations", "time",
        F.col("demand_mw").alias("y"), F.col("cdh").alias("c"), F.col("hdh").alias("h"),
    ).na.drop("any")


def _cells(observations: DataFrame) -> DataFrame:
    """Count, means and within-cell covariances per (zone, subset, hour, weekday), UTC."""
    pairs = [(a, b) for i, a in enumerate(MOMENTS) for b in MOMENTS[i:]]
    return observations.groupBy(
        "zone", "mask", "n", "stations", F.hour("time").alias("hour"), F.weekday("time").alias("dow")
    ).agg(
        F.count("*").alias("w"),
        *[F.avg(m).alias(m) for m in MOMENTS],
        *[(F.covar_pop(a, b) * F.count("*")).alias(f"s_{a}{b}") for a, b in pairs],
    )


def _moments(cells: DataFrame) -> DataFrame:
    """Per (zone, subset) the moments of VARIABLES given the hour, as a matrix, and each one's own scale.

    Values are centred first, so that sums of squares keep their digits. What scatters inside a cell is
    added to what scatters between cells.
    """
    group = Window.partitionBy(*SUBSET)
    centred = cells.withColumns({f"d_{m}": F.col(m) - F.sum(F.col("w") * F.col(m)).over(group) / F.sum("w").over(group) for m in MOMENTS})
    value = {f"day{d}": (F.col("dow") == d).cast("double") for d in range(7)} | {m: F.col(f"d_{m}") for m in MOMENTS}
    pairs = [(a, b) for i, a in enumerate(VARIABLES) for b in VARIABLES[i:]]
    inside = {(a, b): F.sum(f"s_{a}{b}" if f"s_{a}{b}" in cells.columns else f"s_{b}{a}") for a, b in pairs if a in MOMENTS}
    by_hour = centred.groupBy("zone", "mask", "n", "stations", "hour").agg(
        F.sum("w").alias("w"),
        *[F.sum(F.col("w") * value[v]).alias(f"m_{v}") for v in VARIABLES],
        *[(F.sum(F.col("w") * value[a] * value[b]) + inside.get((a, b), F.lit(0.0))).alias(f"q_{a}_{b}") for a, b in pairs],
        *[F.sum(F.col("w") * (value[v] if v not in MOMENTS else F.col(v)) ** 2).alias(f"scale_{v}") for v in VARIABLES],
    )
    given = by_hour.groupBy("zone", "mask", "n", "stations").agg(
        *[F.sum(F.col(f"q_{a}_{b}") - F.col(f"m_{a}") * F.col(f"m_{b}") / F.col("w")).alias(f"q_{a}_{b}") for a, b in pairs],
        *[F.sum(f"scale_{v}").alias(f"scale_{v}") for v in VARIABLES],
    )
    entry = {(a, b): F.col(f"q_{a}_{b}") for a, b in pairs}
    matrix = F.array(*[F.array(*[entry[a, b] if (a, b) in entry else entry[b, a] for b in VARIABLES]) for a in VARIABLES])
    return given.select("zone", "mask", "n", "stations", matrix.alias("moments"), F.array(*[f"scale_{v}" for v in VARIABLES]).alias("scales"))


def _swept(moments: Column, scales: Column, first: int, last: int) -> Column:
    """Moments given the variables `first` to `last` too. One that the others explain wholly is left out."""

    def out(m: Column, k: Column) -> Column:
        pivot = m[k][k]
        swept = F.transform(m, lambda row: F.transform(row, lambda v, j: v - row[k] * m[k][j] / pivot))
        return F.when(pivot > NOTHING * scales[k], swept).otherwise(m)

    return F.aggregate(F.sequence(F.lit(first), F.lit(last)), moments, out)


def score_subsets(temps: DataFrame, load: DataFrame, candidates: DataFrame) -> DataFrame:
    """Partial R2 of degree hours over hour and weekday, per zone and station subset.

    The share of demand's scatter, given hour and weekday, that the degree hours explain; null where hour
    and weekday leave none. The regressions are sweeps of a 10 x 10 matrix of moments for each subset.
    """
    moments = _moments(_cells(subset_observations(temps, load, candidates)))
    c, y = VARIABLES.index("c"), VARIABLES.index("y")
    marks = moments.withColumn("moments", _swept(F.col("moments"), F.col("scales"), 0, c - 1))
    both = marks.withColumn("rest", _swept(F.col("moments"), F.col("scales"), c, c + 1)[y][y])
    total = F.col("moments")[y][y]
    return both.select(*SUBSET, "n", "stations", F.when(total > NOTHING * F.col("scales")[y], 1 - F.col("rest") / total).alias("partial_r2"))


def best_subsets(scores: DataFrame) -> DataFrame:
    """Best single station and best composite per zone, by gain. Scores that agree to nine digits go to the lower mask."""
    rank = F.struct(F.round("partial_r2", 9), -F.col("mask"))
    single, multi = F.col("n") == 1, F.col("n") > 1
    best = scores.groupBy("zone").agg(
        F.max_by(F.when(single, F.col("stations")), F.when(single, rank)).alias("best_single"),
        F.max(F.when(single, F.col("partial_r2"))).alias("single_r2"),
        F.max_by(F.when(multi, F.col("stations")), F.when(multi, rank)).alias("best_composite"),
        F.max(F.when(multi, F.col("partial_r2"))).alias("composite_r2"),
    )
    gain = F.col("composite_r2") - F.col("single_r2")
    return best.withColumn("gain", gain).orderBy(F.desc_nulls_last("gain"), "zone")
