import math

from conftest import values

from zoneflow.operators import territory


def _rings(spark, shapes):
    rows = [(i, n, [(float(x), float(y)) for x, y in ring]) for i, n, ring in shapes]
    return spark.createDataFrame(rows, "entity int, name string, ring array<struct<x:double,y:double>>")


def _inside(px, py, ring):
    odd = False
    for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
        if (y1 > py) != (y2 > py) and px < x1 + (py - y1) * (x2 - x1) / (y2 - y1):
            odd = not odd
    return odd


def test_scan_lines_equal_point_in_polygon(spark):
    shapes = [
        (1, "a", [(0, 0), (10, 0), (10, 10), (5, 3), (0, 10)]),
        (2, "b", [(2.2, 1.1), (9.7, 4.9), (3.3, 8.6)]),
        (3, "c", [(-5, -5), (5, -5), (-5, 5), (5, 5)]),
    ]
    for size in (1.0, 0.5):
        got = set(values(territory.rasterise(territory.edges(_rings(spark, shapes)), size)))
        span = range(math.floor(-6 / size), math.ceil(11 / size))
        want = {
            (e, x, y) for e, _, ring in shapes for x in span for y in span
            if _inside((x + 0.5) * size, (y + 0.5) * size, ring)
        }
        assert got == want


def _box(x, y, w, h):
    return [(x, y), (x + w, y), (x + w, y + h), (x, y + h)]


def test_assignment(spark):
    shapes = [
        (1, "big", _box(0, 0, 20, 20)),
        (2, "other", _box(18, 0, 20, 20)),
        (3, "enclave", _box(5, 5, 3, 3)),  # inside big
        (4, "near", _box(40, 5, 2, 2)),  # two cells off the edge of other
        (5, "orphan", _box(60, 5, 2, 2)),
        (6, "large", _box(0, 30, 30, 30)),  # unmapped and not minor
        (7, territory.NEVER_FOLDED, _box(6, 6, 1, 1)),
    ]
    rings = _rings(spark, shapes)
    cells = territory.rasterise(territory.edges(rings))
    lookup = spark.createDataFrame([("big", "Z1"), ("other", "Z2")], "name string, zone_id string")
    owned = territory.assign_territories(rings, cells, lookup, minor_km2=100.0)
    n = {(r.zone_id, r.entity): r["count"] for r in owned.groupBy("zone_id", "entity").count().collect()}
    # the overlap of the two equal boxes goes to the lower entity
    assert n == {("Z1", 1): 400 - 9, ("Z2", 2): 400 - 40, ("Z1", 3): 9, ("Z2", 4): 4}
    assert owned.groupBy("cell_x", "cell_y").count().filter("count > 1").count() == 0

    land = cells.filter("cell_x < 10").select("cell_x", "cell_y")
    assert territory.clip_to(owned, land).filter("cell_x >= 10").count() == 0

    points = spark.createDataFrame([(1, 5.5, 5.5), (2, 37.9, 0.1), (3, 61.0, 5.0)], "id int, x double, y double")
    got = values(territory.zone_of_points(points, owned, "x", "y"), "id", "zone_id")
    assert got == [(1, "Z1"), (2, "Z2"), (3, None)]


def test_degree_area(spark):
    cells = spark.createDataFrame([(1, 0, 0), (1, 0, 119)], "entity int, cell_x int, cell_y int")
    area = territory.entity_area_degrees(cells, 0.5).first().area_km2
    side = 0.5 * 111.32
    want = sum(math.cos(math.radians((y + 0.5) * 0.5)) for y in (0, 119)) * side * side
    assert abs(area - want) < 1e-6


def test_dissolve_is_distinct(spark):
    df = spark.createDataFrame([("Z", 1, 1), ("Z", 1, 1)], "zone_id string, cell_x int, cell_y int")
    assert territory.dissolve(df).count() == 1


def test_every_zone_has_a_utility(spark):
    from zoneflow.schemas import ZONES
    from zoneflow.utilities import utility_lookup

    df = utility_lookup(spark)
    assert {r.zone_id for r in df.collect()} == set(ZONES)
    assert df.select("name").distinct().count() == df.count()
