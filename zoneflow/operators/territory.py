"""Zone territories on a grid of cells: rasterise, fold, resolve, clip, look up.

A territory is a set of cells whose centres lie inside its rings (even-odd rule), so answers
are exact for the grid and approximate for the map; `cell` is the resolution. Everything
after rasterising is an equi-join or a grouped aggregate on cells.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zoneflow.operators.merge import fill_from
from zoneflow.session import materialize

CELL = ["cell_x", "cell_y"]
# What counts as a small enclave, how far one may lie from its zone, and the
# entity that is never folded.
MINOR_AREA_KM2 = 1_000.0
NEAREST_KM = 3.0
NEVER_FOLDED = "OHIO VALLEY ELECTRIC CORP"
KM_PER_DEGREE = 111.32


def _first_center_at_or_after(v: Column, cell: float) -> Column:
    return F.ceil(v / F.lit(cell) - 0.5)


def edges(rings: DataFrame, ring_col: str = "ring") -> DataFrame:
    """(entity, x1, y1, x2, y2) per side of each ring; the last point joins the first."""
    ring = F.col(ring_col)
    nxt = F.concat(F.slice(ring, 2, F.size(ring)), F.slice(ring, 1, 1))
    pairs = F.arrays_zip(ring.alias("a"), nxt.alias("b"))
    return rings.select("entity", F.explode(pairs).alias("e")).select(
        "entity", *[F.col(f"e.{p}.{c}").alias(f"{c}{i}") for i, p in ((1, "a"), (2, "b")) for c in ("x", "y")]
    )


def rasterise(sides: DataFrame, cell: float = 1.0) -> DataFrame:
    """Cells of each entity, by scan lines.

    Each side is cut into the scan lines it crosses, so the unit of work is one line of one
    entity and a huge territory spreads over many tasks. Along a line the crossings pair up
    into inside runs.
    """
    y_lo, y_hi = F.least("y1", "y2"), F.greatest("y1", "y2")
    lines = sides.withColumns(
        {"_from": _first_center_at_or_after(y_lo, cell), "_to": _first_center_at_or_after(y_hi, cell) - 1}
    ).filter("_from <= _to")
    crossed = lines.withColumn("cell_y", F.explode(F.sequence("_from", "_to")))
    y = (F.col("cell_y") + 0.5) * cell
    x = F.col("x1") + (y - F.col("y1")) * (F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1"))
    crossings = crossed.select("entity", "cell_y", x.alias("x"))
    along = Window.partitionBy("entity", "cell_y").orderBy("x")
    runs = crossings.withColumns(
        {"_i": F.row_number().over(along), "_to_x": F.lead("x").over(along)}
    ).filter("_i % 2 = 1")
    runs = runs.withColumns(
        {
            "_from": _first_center_at_or_after(F.col("x"), cell),
            "_to": _first_center_at_or_after(F.col("_to_x"), cell) - 1,
        }
    ).filter("_from <= _to")
    return runs.select("entity", F.explode(F.sequence("_from", "_to")).alias("cell_x"), "cell_y")


def entity_area(cells: DataFrame, cell_km: float = 1.0) -> DataFrame:
    """Area of each entity on a grid laid over projected coordinates."""
    return cells.groupBy("entity").agg((F.count("*") * F.lit(cell_km * cell_km)).alias("area_km2"))


def entity_area_degrees(cells: DataFrame, cell_deg: float) -> DataFrame:
    """The same on a longitude/latitude grid: cells shrink with the cosine of latitude."""
    latitude = (F.col("cell_y") + 0.5) * cell_deg
    side = cell_deg * KM_PER_DEGREE
    return cells.groupBy("entity").agg(
        (F.sum(F.cos(F.radians(latitude))) * F.lit(side * side)).alias("area_km2")
    )


def assign_known(entities: DataFrame, lookup: DataFrame) -> DataFrame:
    """Entities with the zone their name maps to, NULL for unmapped names."""
    return entities.join(lookup.select("name", "zone_id"), "name", "left")


def is_minor(max_km2: float = MINOR_AREA_KM2) -> Column:
    return F.col("zone_id").isNull() & (F.col("name") != NEVER_FOLDED) & (F.col("area_km2") < max_km2)


def dissolve(cells: DataFrame) -> DataFrame:
    """Distinct cells per zone."""
    return cells.select("zone_id", *CELL).distinct()


def best_overlap(minor_cells: DataFrame, zone_cells: DataFrame) -> DataFrame:
    """Zone that shares most cells with each minor entity; ties to the lower zone id."""
    shared = minor_cells.join(zone_cells, CELL).groupBy("entity", "zone_id").agg(F.count("*").alias("n"))
    best = F.min_by("zone_id", F.struct(-F.col("n"), F.col("zone_id")))
    return shared.groupBy("entity").agg(best.alias("zone_id"))


def nearest_zone(minor_cells: DataFrame, zone_cells: DataFrame, max_cells: int) -> DataFrame:
    """Closest zone within `max_cells` of each minor entity, by centre distance.

    Each cell looks up the disc of cells around it, row by row, which is an equi-join on cells: the
    work grows with the cells, not with pairs of cells, and the plan not with the disc.
    """
    reach = F.lit(max_cells)
    strips = minor_cells.select("entity", *CELL, F.explode(F.sequence(-reach, reach)).alias("dy"))
    half = F.floor(F.sqrt(F.lit(max_cells * max_cells) - F.col("dy") * F.col("dy"))).cast("int")
    reached = strips.select("entity", *CELL, "dy", F.explode(F.sequence(-half, half)).alias("dx")).select(
        "entity",
        (F.col("cell_x") + F.col("dx")).alias("cell_x"),
        (F.col("cell_y") + F.col("dy")).alias("cell_y"),
        (F.col("dx") * F.col("dx") + F.col("dy") * F.col("dy")).alias("d2"),
    )
    near = reached.groupBy("entity", *CELL).agg(F.min("d2").alias("d2"))
    found = near.join(zone_cells, CELL)
    return found.groupBy("entity").agg(
        F.min_by("zone_id", F.struct("d2", "zone_id")).alias("zone_id"), F.sqrt(F.min("d2")).alias("distance")
    )


def resolve_overlaps(claims: DataFrame) -> DataFrame:
    """Give each cell to the smallest entity that claims it; ties to the lower entity.

    A minimum per cell, reduced before the shuffle, in place of a loop over entities.
    """
    winner = F.min(F.struct("area_km2", "entity", "zone_id")).alias("w")
    return claims.groupBy(*CELL).agg(winner).select(F.col("w.zone_id").alias("zone_id"), F.col("w.entity").alias("entity"), *CELL)


def clip_to(cells: DataFrame, land_cells: DataFrame) -> DataFrame:
    return cells.join(land_cells.select(*CELL), CELL, "left_semi")


def zone_of_points(points: DataFrame, zone_cells: DataFrame, x: str, y: str, cell: float = 1.0) -> DataFrame:
    """Zone of each point by the cell it falls into; NULL outside every zone."""
    located = points.withColumns(
        {"cell_x": F.floor(F.col(x) / cell), "cell_y": F.floor(F.col(y) / cell)}
    )
    return located.join(zone_cells.select("zone_id", *CELL), CELL, "left").drop(*CELL)


def assign_territories(
    entities: DataFrame,
    cells: DataFrame,
    lookup: DataFrame,
    land_cells: DataFrame | None = None,
    minor_km2: float = MINOR_AREA_KM2,
    nearest_km: float = NEAREST_KM,
    cell_km: float = 1.0,
) -> DataFrame:
    """(zone_id, entity, cell) of every cell a zone owns.

    Mapped entities are major. A small unmapped one joins the zone it overlaps most, else
    the nearest zone within reach, else it is dropped. `cells` is read several times: pass a
    written table. The entity list is written too, so that Spark broadcasts it when it is
    small; when it is not, adaptive execution splits the entities that hold most cells.
    """
    area = entity_area(cells, cell_km)
    known = materialize(assign_known(entities.select("entity", "name"), lookup).join(area, "entity"), "entities")
    major = known.filter(F.col("zone_id").isNotNull())
    minor = known.filter(is_minor(minor_km2)).drop("zone_id")
    major_cells = cells.join(major.select("entity", "zone_id"), "entity")
    minor_cells = cells.join(minor.select("entity"), "entity", "left_semi")
    zone_cells = dissolve(major_cells)
    overlapped = best_overlap(minor_cells, zone_cells)
    lonely = minor_cells.join(overlapped, "entity", "left_anti")
    nearest = nearest_zone(lonely, zone_cells, math.floor(nearest_km / cell_km))
    folded = fill_from(minor, overlapped, nearest, "entity", "zone_id")
    owners = major.select("entity", "zone_id", "area_km2").unionByName(
        folded.select("entity", "zone_id", "area_km2")
    )
    owned = resolve_overlaps(cells.join(owners, "entity"))
    return owned if land_cells is None else clip_to(owned, land_cells)

