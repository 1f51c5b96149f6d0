"""Grid joins against brute force, on sparse, dense and copied points."""

import functools
import math
import random
import statistics

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from cityweave.operators import nearby, skew, treewalk
from cityweave.sources import scratch
from cityweave.sources.scratch import durable


def frames(spark, probes, points):
    rows = spark.createDataFrame([(i, *p) for i, p in enumerate(probes)], "id long, lat double, lon double")
    return rows, spark.createDataFrame(points, "latitude double, longitude double")


def counted(spark, probes, points, near, **options):
    rows, pts = frames(spark, probes, points)
    return [r.n for r in nearby.with_near_count(rows, pts, near, "n", **options).orderBy("id").collect()]


def brute(probes, points, test):
    usable = [p for p in points if None not in p and not any(math.isnan(c) for c in p)]
    return [0 if None in q else sum(test(*q, *p) for p in usable) for q in probes]


def in_count_circle(lat, lon, y, x):
    if not (lat - 0.005 <= y <= lat + 0.005 and lon - 0.005 <= x <= lon + 0.005):
        return False
    north, east = (y - lat) * 111000.0, (x - lon) * 92000.0
    return north * north + east * east < 250000


def in_degree_circle(lat, lon, y, x):
    return (y - lat) * (y - lat) + (x - lon) * (x - lon) <= 0.01 * 0.01


def in_great_circle(lat, lon, y, x):
    lat, lon, y, x = map(math.radians, (lat, lon, y, x))
    a = math.sin((y - lat) / 2) ** 2 + math.cos(lat) * math.cos(y) * math.sin((x - lon) / 2) ** 2
    return 2 * math.asin(min(1.0, math.sqrt(a))) * 6371000.0 <= 500


def scatter(seed, n, size, lat=34.05, lon=-118.24):
    r = random.Random(seed)
    return [(lat + r.uniform(-size, size), lon + r.uniform(-size, size)) for _ in range(n)]


CIRCLES = [
    (nearby.COUNT_CIRCLE, in_count_circle),
    (nearby.DEGREE_CIRCLE, in_degree_circle),
    (nearby.HAVERSINE_CIRCLE, in_great_circle),
]


@pytest.mark.parametrize("near,test", CIRCLES)
@pytest.mark.parametrize("few", [10_000, 100, 16, 1, nearby.FEW])
def test_equals_brute_force(spark, near, test, few):
    points = scatter(1, 500, 0.03) + scatter(2, 400, 0.002) + [(0.0, 0.0)] * 5 + [(None, 1.0), (float("nan"), 1.0)]
    probes = scatter(3, 150, 0.03) + scatter(4, 100, 0.003) + [(0.0, 0.0)] * 3 + [(None, -118.0), (34.0, None)]
    assert counted(spark, probes, points, near, few=few) == brute(probes, points, test)


def test_negative_and_zero_coordinates(spark):
    points, probes = scatter(5, 300, 0.02, 0.0, 0.0), scatter(6, 100, 0.02, 0.0, 0.0)
    for near, test in CIRCLES:
        assert counted(spark, probes, points, near, few=5) == brute(probes, points, test)


@pytest.mark.parametrize("few", [10_000, 4])
def test_great_circle_across_date_line_and_near_poles(spark, few):
    r = random.Random(7)
    line = [(10 + r.uniform(-0.01, 0.01), r.choice((-180, 180)) * (1 - r.uniform(0, 1e-4))) for _ in range(300)]
    line = [(a, max(-180.0, min(180.0, b))) for a, b in line]
    pole = [(89.99 + r.uniform(0, 0.01), r.uniform(-180, 180)) for _ in range(300)]
    high = [(84.99 + r.uniform(-0.01, 0.02), 20 + r.uniform(-0.1, 0.1)) for _ in range(300)]
    for group in (line, pole, high):
        probes, points = group[:100], group[100:]
        expected = brute(probes, points, in_great_circle)
        assert sum(expected) > 0
        assert counted(spark, probes, points, nearby.HAVERSINE_CIRCLE, few=few) == expected


def test_box_cuts_the_circle_and_its_edge_is_outside(spark):
    lat, lon = 34.0, -118.0
    east_470 = lon + 470 / 92000
    north_490 = lat + 490 / 111000
    points = [(lat, east_470), (north_490, lon)]
    assert counted(spark, [(lat, lon)], points, nearby.COUNT_CIRCLE) == [1]
    edge = nearby.Planar(0.25, inclusive=False)
    assert counted(spark, [(1.0, 1.0)], [(1.25, 1.0), (1.0, 1.125)], edge) == [1]
    assert counted(spark, [(1.0, 1.0)], [(1.25, 1.0), (1.0, 1.125)], nearby.Planar(0.25)) == [2]


def test_trees_follow_the_crowd(spark):
    def trees(points, few=nearby.FEW):
        return nearby._trees(nearby._weighted_points(points, "latitude", "longitude", nearby.DEGREE_CIRCLE), few)

    def crowd(n, size=1e-3):
        return spark.range(n).select((34.001 + F.rand(1) * size).alias("latitude"), (F.rand(2) * size - 118).alias("longitude"))

    assert len(trees(crowd(10))[0]) == 1
    levels, points = trees(crowd(3000))
    assert len(levels) > 2 and points.count() == 3000
    assert points.groupBy("level", *nearby.CELL, *nearby.BLOCK).count().agg(F.max("count")).first()[0] <= nearby.FEW
    assert all(lv.where("not open").count() for lv in levels[:-1]) and not levels[-1].where("not open").count()
    copies = spark.range(100_000).select(F.lit(34.0).alias("latitude"), F.lit(-118.0).alias("longitude"))
    assert len(trees(copies)[0]) == 1
    # Points nearer to each other than the finest block are opened there.
    assert len(trees(crowd(50, 1e-11), few=4)[0]) == nearby.LEVELS + 1


def test_hot_location_is_split_and_stays_whole(spark):
    hot = [(34.05, -118.24)] * 3000 + [(None, None)] * 1000 + scatter(9, 500, 0.01)
    points = scatter(10, 200, 0.005)
    whole = counted(spark, hot, points, nearby.DEGREE_CIRCLE)
    split = counted(spark, hot, points, nearby.DEGREE_CIRCLE, rows_per_part=100)
    assert whole == split == brute(hot, points, in_degree_circle)


def test_work_is_balanced_when_one_cell_holds_half(spark):
    """Counts as by brute force; the largest task makes less than twice the pairs of the median one."""
    points, probes = scatter(12, 1000, 0.002) + scatter(13, 1000, 0.3), scatter(14, 2000, 0.002) + scatter(15, 2000, 0.3)
    near = nearby.DEGREE_CIRCLE
    rows, pts = frames(spark, probes, points)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        cells = durable(nearby._probe_cells(nearby._locations(rows, "lat", "lon"), near), "cells")
        leaves = nearby._weighted_points(pts, "latitude", "longitude", near)
        met = skew.join_by_work(cells, leaves, nearby.CELL, few_rows=0, least_work=1)
        tasks = sorted(r["count"] for r in met.groupBy(F.spark_partition_id()).count().collect())
        assert tasks[-1] < 2 * statistics.median(tasks) and len(tasks) == 16
        plain = cells.join(leaves, nearby.CELL)
        assert met.count() == plain.count() == met.select("q_lat", "q_lon", "p_lat", "p_lon").distinct().count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.mark.parametrize("few", [10_000, 8])
def test_counts_without_broadcast(spark, few, monkeypatch):
    points, probes = scatter(12, 400, 0.003) + scatter(13, 200, 0.3), scatter(14, 1500, 0.003) + scatter(15, 300, 0.3)
    split = functools.partial(skew.join_by_work, few_rows=0, least_work=1)
    monkeypatch.setattr(nearby, "join_by_work", split)
    assert counted(spark, probes, points, nearby.DEGREE_CIRCLE, few=few) == brute(probes, points, in_degree_circle)


def test_buffer_counts_pairs_per_place(spark):
    rows, pts = frames(spark, [(34.0, -118.0)] * 2 + [(35.0, -118.0), (None, -118.0)], [(34.0, -118.0), (34.001, -118.0)] * 2)
    got = {(r.lat, r.lon): r.inspection_count for r in nearby.inspections_in_buffer(rows, pts).collect()}
    assert got == {(34.0, -118.0): 8, (35.0, -118.0): 0, (None, -118.0): 0}


def test_same_cell_misses_neighbours_across_the_edge(spark):
    rows, pts = frames(spark, [(34.0099, -118.005)], [(34.0101, -118.005), (34.0098, -118.005)])
    assert nearby.same_cell_inspections(rows, pts).first().nearby_inspections_count == 1
    assert nearby.nearby_inspections_haversine(rows, pts).first().nearby_inspections_count == 2


def test_same_cell_in_a_crowd(spark):
    """A crowded cell, the cells around zero, which are twice as wide, and edges, against all pairs."""
    points = scatter(21, 900, 0.004, 34.005, -118.005) + scatter(22, 400, 0.012, 0.0, 0.0) + [(34.01, -118.0), (0.01, -0.01)]
    probes = scatter(23, 300, 0.005, 34.005, -118.005) + scatter(24, 200, 0.012, 0.0, 0.0) + [(34.01, -118.0), (0.01, -0.01)]

    def test(lat, lon, y, x):
        same = (int(lat / 0.01), int(lon / 0.01)) == (int(y / 0.01), int(x / 0.01))
        return same and in_great_circle(lat, lon, y, x)

    rows, pts = frames(spark, probes, points)
    found = nearby.same_cell_inspections(rows, pts).orderBy("id").collect()
    assert [r.nearby_inspections_count for r in found] == brute(probes, points, test)


def test_points_per_cell_are_whole(spark):
    points = scatter(11, 400, 0.004) * 2
    _, pts = frames(spark, [], points + [(None, 1.0)])
    found = nearby.points_per_cell(pts).collect()
    assert len(found) == 400 and {r.weight for r in found} == {2}
    assert all((r.cell_lat, r.cell_lon) == (int(r.latitude // 0.01), int(r.longitude // 0.01)) for r in found)


def test_pairs_are_not_written(spark, tmp_path):
    """Rows written for a crowd on the rims of a crowd, and counts against brute force, with several parts on each side."""
    points, probes = scatter(31, 9000, 0.004), scatter(32, 5000, 0.004)
    rows, pts = frames(spark, probes, points)
    near = nearby.Planar(0.002)
    with scratch.inside(str(tmp_path)):
        found = {(r.q_lat, r.q_lon): r.n_near for r in nearby.count_around(rows, pts, near).collect()}
    written = sum(pq.read_metadata(f).num_rows for f in tmp_path.glob("*/*.parquet"))
    assert written < 3 * (len(points) + len(probes))
    assert max(pq.read_table(f, columns=["p_part"])["p_part"].to_pylist()[0] for f in tmp_path.glob("near-parts*/*.parquet") if "p_part" in pq.read_schema(f).names) > 0
    for lat, lon in probes[::50]:
        assert found[lat, lon] == sum((y - lat) ** 2 + (x - lon) ** 2 <= 0.002 * 0.002 for y, x in points)


def test_great_circle_works_out_few_angles(monkeypatch):
    """Only pairs within a millionth of the rim, or off the globe, are put to the exact test."""
    points, probes = scatter(41, 4000, 0.01), scatter(42, 500, 0.01) + [(95.0, -118.24)]
    asked = []
    exact = nearby.GreatCircle.matches
    monkeypatch.setattr(nearby.GreatCircle, "matches", lambda near, *c: asked.append(np.broadcast(*c).size) or exact(near, *c))
    p, q = ({"lat": np.array([a for a, _ in some]), "lon": np.array([b for _, b in some])} for some in (points, probes))
    p |= {"weight": np.ones(len(points), np.int64)}
    for few in (64, 1):
        found = treewalk.count(nearby.HAVERSINE_CIRCLE, few, q | {"root": np.zeros(501, np.int64)}, p | {"root": np.zeros(4000, np.int64)})
        assert found[::25].tolist() == brute(probes[::25], points, in_great_circle) and sum(asked) < 100


def test_points_off_the_rims_are_not_shuffled(spark, tmp_path):
    """A crowd wholly around the probes is summed; the table of points and the shuffle files go when they are used."""
    rows, pts = frames(spark, scatter(43, 300, 0.0005), scatter(44, 6000, 0.003) + scatter(45, 200, 0.02))
    before = spark.conf.get(scratch.RELEASE)
    with scratch.inside(str(tmp_path)):
        found = nearby.count_around(rows, pts, nearby.DEGREE_CIRCLE).collect()
    rims = spark.read.parquet(*map(str, tmp_path.glob("near-rims*"))).agg(F.sum("within"), F.sum("rest")).first()
    assert rims[0] is None or rims[0] > 5 * (rims[1] or 0)
    assert not [*tmp_path.rglob("points-*")] and spark.conf.get(scratch.RELEASE) == before
    places = [(r.q_lat, r.q_lon) for r in found[::10]]
    crowd = [(r.latitude, r.longitude) for r in pts.collect()]
    assert [r.n_near for r in found[::10]] == brute(places, crowd, in_degree_circle)


def test_parts_are_tiles_and_rows_are_shuffled_packed(spark, tmp_path):
    """Extents of parts hardly overlap, and packed rows are what went in, in far fewer rows and bytes."""
    _, pts = frames(spark, [], scatter(51, 60_000, 0.3))
    spots = nearby._distinct_points(pts, "latitude", "longitude")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        dealt = nearby._in_parts(spots, "p_lat", "p_lon", "p_part")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    boxes = [(r[1] - r[0]) * (r[3] - r[2]) for r in dealt.groupBy("p_part").agg(F.min("p_lat"), F.max("p_lat"), F.min("p_lon"), F.max("p_lon")).select("min(p_lat)", "max(p_lat)", "min(p_lon)", "max(p_lon)").collect()]
    assert len(boxes) == 16 and sum(boxes) < 1.6 * 0.6 * 0.6
    rows = dealt.withColumn("q_part", F.col("p_part") % 3)
    packs = nearby._packed(rows, "p_lat").toArrow()
    assert packs.num_rows <= 16 * 3 and sum(len(p.as_py()) for p in packs["packed"]) < 60_000 * 24
    back = nearby._unpacked(packs)
    assert sorted(zip(back["p_lat"], back["p_lon"], back["weight"])) == sorted(map(tuple, spots.collect()))
