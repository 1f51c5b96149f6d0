"""Counting the points around other points.

Plan, for every kind of neighbourhood:

1. Points with the same coordinates become one weighted point, and each distinct probe location is looked
   up once. Copies, however many, cost one row.
2. Probes and points are each dealt into parts of at most some 500,000 neighbouring ones, tiles of stripes of equal numbers.
   Of each part the extent and weight are known; extents hardly overlap.
3. Parts are paired by their extents. A part of points wholly inside the neighbourhood of all probes of a part adds its weight
   to them, one wholly outside is dropped. Of the other pairs, points near every probe of a part are only summed, and a
   probe with all the other points around it takes their sum. What is left, the rims, meets in a task per pair.
4. There the probes walk down the tree of the points (``treewalk``), whose blocks are as small as its points are dense. So a
   crowd costs the blocks along the rim and not all of its pairs.
5. Weights are summed per probe location, partly before the shuffle, and joined back to the rows.

What is written and shuffled are rows of the two tables, repeated for the parts on whose rims they lie and packed many in
one, and one number per probe and part with a point near it; pairs of probe and block or point exist in memory only, in bounded pieces. Shuffle files go with
the step that made them.
"""

from __future__ import annotations

import io
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cityweave.functions import geo
from cityweave.functions.numbers import is_number
from cityweave.operators import treewalk
from cityweave.operators.skew import ROWS_PER_PART, join_by_work, join_per_key
from cityweave.operators.treewalk import Arrays, Box
from cityweave.sources.resume import Files
from cityweave.sources.scratch import durable, fresh_path, inside, shuffles_released

# Points up to which a block is opened.
FEW = 64
# Rows of a part; fewer where there would be fewer parts than tasks, but not below the second number.
PART_ROWS = 500_000
LEAST_PART_ROWS = 2_000
# Rows that are packed together at most.
PACK_ROWS = 200_000
# Tasks of the walk for each shuffle partition, as pairs of parts differ in work.
WALKS_PER_TASK = 8
# Cells are this much wider than the reach, so rounding cannot put a match two cells away.
SLACK = 1.1
# Fixed values of the distance tests.
BOX_DEGREES = 0.005
COUNT_RADIUS_M = 500.0
BUFFER_RADIUS_M = 200.0
DEGREE_RADIUS = 0.01


@dataclass(frozen=True)
class Planar:
    """Circle on plane coordinates with one scale per axis, optionally cut by a square in degrees."""

    radius: float
    lat_scale: float = 1.0
    lon_scale: float = 1.0
    inclusive: bool = True
    box: float | None = None

    def _reach(self, scale: float) -> float:
        return min(self.radius / scale, self.box or math.inf)

    def lat_cells(self) -> float:
        return self._reach(self.lat_scale) * SLACK

    def lon_cells(self, lat_cell: Column) -> Column:
        """Width of the cells of one row of the grid."""
        return F.lit(self._reach(self.lon_scale) * SLACK)

    def lon_index(self, lon: Column, width: Column) -> Column:
        return F.floor(lon / width)

    def lon_neighbours(self, index: Column, width: Column) -> Column:
        return F.sequence(index - 1, index + 1)

    def _inside(self, north: Any, east: Any) -> Any:
        north, east = north * self.lat_scale, east * self.lon_scale
        square = north * north + east * east
        limit = self.radius * self.radius
        return square <= limit if self.inclusive else square < limit

    def matches(self, q_lat: np.ndarray, q_lon: np.ndarray, p_lat: np.ndarray, p_lon: np.ndarray) -> np.ndarray:
        """Probe and point are near."""
        near = self._inside(p_lat - q_lat, p_lon - q_lon)
        if self.box is None:
            return near
        near &= (p_lat >= q_lat - self.box) & (p_lat <= q_lat + self.box)
        return near & (p_lon >= q_lon - self.box) & (p_lon <= q_lon + self.box)

    # The two tests of extents use their closest and farthest corners. Rounded subtraction, product
    # and sum never reverse an order, so they agree with ``matches`` on every point to the last bit.

    def may_match(self, q: Box, p: Box, m: Any) -> Any:
        """Some point of ``p`` may be near some probe of ``q``."""
        near = self._inside(_gap(q, p, "lat", m), _gap(q, p, "lon", m))
        if self.box is None:
            return near
        near = near & (p.max_lat >= q.min_lat - self.box) & (p.min_lat <= q.max_lat + self.box)
        return near & (p.max_lon >= q.min_lon - self.box) & (p.min_lon <= q.max_lon + self.box)

    def all_match(self, q: Box, p: Box, m: Any) -> Any:
        """Every point of ``p`` is near every probe of ``q``."""
        near = self._inside(_span(q, p, "lat", m), _span(q, p, "lon", m))
        if self.box is None:
            return near
        near = near & (p.min_lat >= q.max_lat - self.box) & (p.max_lat <= q.min_lat + self.box)
        return near & (p.min_lon >= q.max_lon - self.box) & (p.max_lon <= q.min_lon + self.box)

    def in_task(self, probes: dict[str, np.ndarray], points: dict[str, np.ndarray]) -> PlanarWalk:
        return PlanarWalk(self, [probes["lat"], probes["lon"]], [points["lat"], points["lon"]])


@dataclass
class PlanarWalk:
    """The tests of a walk on plane coordinates; ``probe`` and ``point`` are the axes it goes along."""

    near: Planar
    probe: list[np.ndarray]
    point: list[np.ndarray]

    def points(self, q: list[np.ndarray], p: list[np.ndarray]) -> tuple[np.ndarray, None]:
        """Which are near, and which remain to be asked."""
        return self.near.matches(*q, *p), None

    def blocks(self, q: list[np.ndarray], low: list[np.ndarray], high: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """In which blocks something may be near, and in which everything is."""
        place, extent = Box.of(*q), Box(low[0], high[0], low[1], high[1])
        return self.near.may_match(place, extent, Arrays), self.near.all_match(place, extent, Arrays)


@dataclass(frozen=True)
class GreatCircle:
    """Circle on the sphere, inclusive.

    Every row of the grid has its own whole number of cells around the globe, so cells stay wide enough
    towards the poles and the last cell borders the first one across the date line.
    """

    radius_m: float

    def _degrees(self) -> float:
        return math.degrees(self.radius_m / geo.EARTH_M)

    def lat_cells(self) -> float:
        return self._degrees() * SLACK

    def lon_cells(self, lat_cell: Column) -> Column:
        size = self.lat_cells()
        # A match may lie one row further from the equator than this row's own far edge.
        farthest = F.greatest(F.abs(lat_cell * size), F.abs((lat_cell + 1) * size)) + size
        width = F.lit(self._degrees() * SLACK) / F.cos(F.radians(farthest))
        return F.when(farthest < 85, 360 / F.floor(360 / width)).otherwise(360.0)

    def lon_index(self, lon: Column, width: Column) -> Column:
        return F.pmod(F.floor((lon + 180) / width), self._around(width))

    def lon_neighbours(self, index: Column, width: Column) -> Column:
        around = self._around(width)
        return F.array_distinct(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda d: F.pmod(index + d, around)))

    @staticmethod
    def _around(width: Column) -> Column:
        return F.round(360 / width).cast("long")

    def matches(self, q_lat: np.ndarray, q_lon: np.ndarray, p_lat: np.ndarray, p_lon: np.ndarray) -> np.ndarray:
        in_row = np.abs(p_lat - q_lat) <= self.lat_cells()
        q_lat, q_lon, p_lat, p_lon = (np.radians(c) for c in (q_lat, q_lon, p_lat, p_lon))
        half_lat, half_lon = np.sin((p_lat - q_lat) / 2), np.sin((p_lon - q_lon) / 2)
        term = half_lat * half_lat + np.cos(q_lat) * np.cos(p_lat) * half_lon * half_lon
        # As in ``geo.haversine_angle``.
        with np.errstate(invalid="ignore"):
            angle = 2 * np.arcsin(np.sqrt(np.where((term >= 1) & (term <= 2), 1.0, term)))
        return in_row & (angle * geo.EARTH_M <= self.radius_m)

    # Bounds on the haversine term over the extents. Those within a billionth of the rim are opened, which
    # is far more than the rounding of the bounds; so are latitudes beyond the poles.

    def _limit(self) -> float:
        return math.sin(self.radius_m / geo.EARTH_M / 2) ** 2

    @staticmethod
    def _square(gap: Any, m: Any) -> Any:
        half = m.sin(m.radians(gap) / 2)
        return half * half

    @staticmethod
    def _on_globe(q: Box, p: Box, m: Any) -> Any:
        return (m.greatest(q.max_lat, p.max_lat) <= 90.0) & (m.least(q.min_lat, p.min_lat) >= -90.0)

    @staticmethod
    def _least_cosine(b: Box, m: Any) -> Any:
        return m.least(m.cos(m.radians(b.min_lat)), m.cos(m.radians(b.max_lat)))

    @staticmethod
    def _most_cosine(b: Box, m: Any) -> Any:
        over_equator = (b.min_lat <= 0.0) & (b.max_lat >= 0.0)
        return m.where(over_equator, 1.0, m.greatest(m.cos(m.radians(b.min_lat)), m.cos(m.radians(b.max_lat))))

    def may_match(self, q: Box, p: Box, m: Any) -> Any:
        gap, span, north = _gap(q, p, "lon", m), _span(q, p, "lon", m), _gap(q, p, "lat", m)
        east = m.where(span >= 360.0, 0.0, m.least(self._square(gap, m), self._square(span, m)))
        least = self._square(north, m) + self._least_cosine(q, m) * self._least_cosine(p, m) * east
        return (north <= self.lat_cells()) & (~self._on_globe(q, p, m) | (least <= self._limit() * (1 + 1e-9)))

    def all_match(self, q: Box, p: Box, m: Any) -> Any:
        gap, span = _gap(q, p, "lon", m), _span(q, p, "lon", m)
        around = ((gap <= 180.0) & (span >= 180.0)) | (span >= 360.0)
        east = m.where(around, 1.0, m.greatest(self._square(gap, m), self._square(span, m)))
        most = self._square(_span(q, p, "lat", m), m) + self._most_cosine(q, m) * self._most_cosine(p, m) * east
        return self._on_globe(q, p, m) & (most <= self._limit() * (1 - 1e-9))

    def in_task(self, probes: dict[str, np.ndarray], points: dict[str, np.ndarray]) -> GreatCircleWalk:
        turn = _turn(_on_sphere(points))
        chord = 4 * self._limit()
        # Far more than the rounding of the coordinates, and still next to no pairs.
        margin = 1e-6 + 1e-14 / max(math.sqrt(chord), 1e-300)
        axes = [[*(turn @ _on_sphere(some)), _off_globe(some)] for some in (probes, points)]
        return GreatCircleWalk(*axes, chord * (1 - margin), chord * (1 + margin))


def _on_sphere(places: dict[str, np.ndarray]) -> np.ndarray:
    lat, lon = np.radians(places["lat"]), np.radians(places["lon"])
    return np.stack([np.cos(lat) * np.cos(lon), np.cos(lat) * np.sin(lon), np.sin(lat)])


def _turn(points: np.ndarray) -> np.ndarray:
    """A rotation after which the first axis goes through the middle of the points, so that blocks are flat along it."""
    middle = points.sum(axis=1)
    up = middle / max(float(np.linalg.norm(middle)), 1e-300)
    east = np.cross([0.0, 0.0, 1.0] if abs(up[2]) < 0.9 else [1.0, 0.0, 0.0], up)
    if not np.linalg.norm(east) > 1e-3:
        return np.eye(3)
    east /= np.linalg.norm(east)
    return np.stack([up, east, np.cross(up, east)])


def _off_globe(places: dict[str, np.ndarray]) -> np.ndarray:
    """NaN where only the exact test is to be trusted, otherwise 0."""
    return np.where((np.abs(places["lat"]) <= 90.0) & (np.abs(places["lon"]) <= 720.0), 0.0, np.nan)


@dataclass
class GreatCircleWalk:
    """The tests of a walk on the sphere, by the square of the chord, which is four times the haversine term for any two angles.

    The axes are three in space and one that is NaN off the globe. Chords up to ``sure`` are near for certain and above ``most``
    are not; the few between them are left to ``matches``, as is whatever is off the globe.
    """

    probe: list[np.ndarray]
    point: list[np.ndarray]
    sure: float
    most: float

    def __post_init__(self) -> None:
        self._odd = bool(np.isnan(self.probe[3]).any() or np.isnan(self.point[3]).any())

    def points(self, q: list[np.ndarray], p: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        square = sum((b - a) ** 2 for a, b in zip(q[:3], p[:3]))
        hit = square < self.sure
        if self._odd:
            hit &= q[3] + p[3] == 0
        return hit, ~hit & (square <= self.most)

    def blocks(self, q: list[np.ndarray], low: list[np.ndarray], high: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        least = most = 0.0
        for a, start, end in zip(q[:3], low[:3], high[:3]):
            before, after = start - a, a - end
            gap, span = np.maximum(np.maximum(before, after), 0.0), np.minimum(before, after)
            least, most = least + gap * gap, most + span * span
        whole = most < self.sure
        if self._odd:
            whole &= q[3] + low[3] == 0
        return least <= self.most, whole


class Columns:
    """The functions that distance tests are written in, for columns."""

    sin, cos, radians = F.sin, F.cos, F.radians

    @staticmethod
    def _column(value: Any) -> Column:
        return value if isinstance(value, Column) else F.lit(value)

    @staticmethod
    def greatest(*values: Any) -> Column:
        return F.greatest(*map(Columns._column, values))

    @staticmethod
    def least(*values: Any) -> Column:
        return F.least(*map(Columns._column, values))

    @staticmethod
    def where(condition: Column, value: Any, otherwise: Any) -> Column:
        return F.when(condition, value).otherwise(otherwise)


def _gap(q: Box, p: Box, axis: str, m: Any) -> Any:
    """Distance along one axis between the nearest edges, 0 where the extents overlap."""
    low, high = f"min_{axis}", f"max_{axis}"
    return m.greatest(getattr(p, low) - getattr(q, high), getattr(q, low) - getattr(p, high), 0.0)


def _span(q: Box, p: Box, axis: str, m: Any) -> Any:
    """Distance along one axis between the farthest edges."""
    low, high = f"min_{axis}", f"max_{axis}"
    return m.greatest(getattr(p, high) - getattr(q, low), getattr(q, high) - getattr(p, low))


# Fixed neighbourhoods of the four counts.
COUNT_CIRCLE = Planar(COUNT_RADIUS_M, geo.KM_PER_LAT_DEGREE * 1000, geo.KM_PER_LON_DEGREE * 1000, False, BOX_DEGREES)
BUFFER_CIRCLE = Planar(BUFFER_RADIUS_M, geo.KM_PER_LAT_DEGREE * 1000, geo.KM_PER_LON_DEGREE * 1000)
DEGREE_CIRCLE = Planar(DEGREE_RADIUS)
HAVERSINE_CIRCLE = GreatCircle(COUNT_RADIUS_M)


def _located(df: DataFrame, lat: str, lon: str) -> DataFrame:
    """Rows whose two coordinates are numbers; NaN sorts above infinity, so one comparison also drops it."""
    return df.where((F.col(lat) <= math.inf) & (F.col(lon) <= math.inf))


# Cells and trees as tables, as the tests look at them; the counts build theirs in the tasks (``treewalk``).
# Blocks along a block's side, as a power of two; levels of a tree. Blocks at the last are opened whatever they hold.
FAN_BITS = 2
LEVELS = 12
CELL = ["cell_lat", "cell_lon"]
BLOCK = ["block_lat", "block_lon"]


def _distinct_points(points: DataFrame, lat: str, lon: str) -> DataFrame:
    """Each place once with its number as weight, those without a location included.

    They are left out when the written table is read: a filter before would work the coordinates out again.
    """
    return points.groupBy(F.col(lat).cast("double").alias("p_lat"), F.col(lon).cast("double").alias("p_lon")).agg(
        F.count(F.lit(1)).alias("weight")
    )


def _weighted_points(points: DataFrame, lat: str, lon: str, near: Planar | GreatCircle) -> DataFrame:
    """Distinct points with weight, cell and place in the finest grid, written once because every level reads them."""
    distinct = _located(_distinct_points(points, lat, lon), "p_lat", "p_lon").withColumn("cell_lat", geo.cell_index("p_lat", near.lat_cells()))
    width = near.lon_cells(F.col("cell_lat"))
    distinct = distinct.withColumn("cell_lon", near.lon_index(F.col("p_lon"), width))
    return durable(_in_grid(distinct, F.lit(near.lat_cells()), width), "points")


def _in_grid(points: DataFrame, size: Column, width: Column) -> DataFrame:
    parts = float(1 << FAN_BITS * LEVELS)
    return points.withColumn("fine_lat", F.floor(F.col("p_lat") / (size / parts))).withColumn(
        "fine_lon", F.floor(F.col("p_lon") / (width / parts))
    )


def _at_level(points: DataFrame, level: int) -> DataFrame:
    """Points with their block of a level; a cell is one block of level 0."""
    finer = FAN_BITS * (LEVELS - level)
    place = {b: F.shiftright(f, finer) if level else F.lit(0).cast("long") for b, f in zip(BLOCK, ("fine_lat", "fine_lon"))}
    return points.withColumns(place)


def _trees(leaves: DataFrame, few: int) -> tuple[list[DataFrame], DataFrame]:
    """The blocks of each level, and the points with the level and block at which they are met one by one.

    A block has a row (cell, up: the block it is part of, block, weight, extent, open: whether its points are met).
    """
    levels, opened, rest = [], [], leaves
    for level in range(LEVELS + 1):
        rest = _at_level(rest, level)
        blocks = rest.groupBy(*CELL, *BLOCK).agg(
            F.sum("weight").alias("weight"),
            (F.lit(level == LEVELS) | (F.count(F.lit(1)) <= few)).alias("open"),
            F.min("p_lat").alias("min_lat"),
            F.max("p_lat").alias("max_lat"),
            F.min("p_lon").alias("min_lon"),
            F.max("p_lon").alias("max_lon"),
        )
        up = {f"up{b[5:]}": F.shiftright(b, FAN_BITS) if level > 1 else F.lit(0).cast("long") for b in BLOCK}
        blocks = durable(blocks.withColumns(up), "near-blocks")
        levels.append(blocks)
        deeper = blocks.where("not open").select(*CELL, *BLOCK, F.lit(True).alias("deeper"))
        if deeper.limit(1).count() == 0:
            opened.append(rest.withColumn("level", F.lit(level)))
            break
        marked = durable(rest.join(deeper, [*CELL, *BLOCK], "left"), "near-points")
        opened.append(marked.where("deeper is null").drop("deeper").withColumn("level", F.lit(level)))
        rest = marked.where("deeper").drop("deeper", *BLOCK)
    points = opened[0]
    for more in opened[1:]:
        points = points.unionByName(more)
    return levels, points.select("p_lat", "p_lon", "weight", "level", *CELL, *BLOCK)


def _probe_cells(locations: DataFrame, near: Planar | GreatCircle) -> DataFrame:
    """Each probe location once per cell of its 3 x 3 surroundings.

    The planner knows the size of ``locations`` when it comes to the join, but not that it grows here, so
    it may broadcast up to nine times its threshold, and no more.
    """
    own = geo.cell_index("q_lat", near.lat_cells())
    width = near.lon_cells(F.col("cell_lat"))
    return (
        locations.withColumn("cell_lat", F.explode(F.sequence(own - 1, own + 1)))
        .withColumn("cell_lon", F.explode(near.lon_neighbours(near.lon_index(F.col("q_lon"), width), width)))
        .select("q_lat", "q_lon", "cell_lat", "cell_lon")
    )


def count_around(
    rows: DataFrame,
    points: DataFrame,
    near: Planar | GreatCircle,
    row_lat: str = "lat",
    row_lon: str = "lon",
    point_lat: str = "latitude",
    point_lon: str = "longitude",
    few: int = FEW,
) -> DataFrame:
    """Per distinct location in ``rows``: how many rows are there and how many points are near it.

    Columns ``q_lat, q_lon, n_rows, n_near``; locations without a near point have 0.
    """
    with shuffles_released(rows.sparkSession):
        locations = _locations(rows, row_lat, row_lon)
        dealt = _point_parts(points, point_lat, point_lon)
        return durable(_summed(locations, dealt, near, few), "near-counts")


def _locations(rows: DataFrame, lat: str, lon: str) -> DataFrame:
    located = _located(rows, lat, lon).groupBy(F.col(lat).alias("q_lat"), F.col(lon).alias("q_lon"))
    return durable(located.agg(F.count(F.lit(1)).alias("n_rows")), "near-places")


def _in_parts(places: DataFrame, lat: str, lon: str, part: str) -> DataFrame:
    """Different places in tiles, whose number is in ``part``; written, so it stays what it is.

    Stripes of about equally many places from south to north are cut from west to east and back in turn, so that a tile over the end of
    one and the start of the next is small, too. Infinite places are near nothing and left out.
    """
    finite = places.where((F.abs(lat) < math.inf) & (F.abs(lon) < math.inf))
    n, tasks = finite.count(), int(places.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # A part meets several, so that far fewer parts than tasks keep all of them busy.
    parts = max(1, math.ceil(n / PART_ROWS), min(tasks, math.ceil(4 * math.sqrt(tasks)), n // LEAST_PART_ROWS))
    stripes = max(1, round(math.sqrt(parts)))
    edges = finite.approxQuantile(lat, [i / stripes for i in range(1, stripes)], 0.05 / stripes) if stripes > 1 else []
    stripe = reduce(lambda n, edge: n + (F.col(lat) > edge).cast("int"), edges, F.lit(0))
    along = F.when(stripe % 2 == 0, F.col(lon)).otherwise(-F.col(lon))
    dealt = finite.repartitionByRange(parts, stripe, along, lat).withColumn(part, F.spark_partition_id())
    return durable(dealt, "near-parts")


def _point_parts(points: DataFrame, lat: str, lon: str, also: dict[str, Column] | None = None) -> DataFrame:
    """The different points in parts. The table of points they are dealt from is deleted."""
    spark, also = points.sparkSession, also or {}
    held = fresh_path(spark, "near-held")
    with inside(held):
        spots = durable(_distinct_points(points, lat, lon), "points")
    for name, column in also.items():
        spots = spots.withColumn(name, column)
    dealt = _in_parts(_located(spots, "p_lat", "p_lon").dropna(subset=["p_lat", "p_lon", *also]), "p_lat", "p_lon", "p_part")
    Files(spark).delete(held)
    return dealt


def _extents(places: DataFrame, name: str, part: str, *also: Column) -> DataFrame:
    """One row per part."""
    edges = [f(f"{name}_{axis}").alias(f"{name}_{f.__name__}_{axis}") for axis in ("lat", "lon") for f in (F.min, F.max)]
    return durable(places.groupBy(part).agg(*edges, *also), "near-extents")


def _extent(name: str) -> Box:
    return Box(*(F.col(f"{name}_{end}_{axis}") for axis in ("lat", "lon") for end in ("min", "max")))


PAIR = ["q_part", "p_part"]


def _packed(rows: DataFrame, sorted_by: str) -> DataFrame:
    """The rows of a pair of parts packed many in one, as compressed columns: a fraction of the bytes that they take one by one."""

    def pack(some: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(some).sort_by([(c, "ascending") for c in (*PAIR, sorted_by)])
        q, p = (table[c].to_numpy() for c in PAIR)
        start = np.flatnonzero(np.r_[True, (q[1:] != q[:-1]) | (p[1:] != p[:-1])])
        packs = []
        for at, end in zip(start, [*start[1:], len(q)]):
            to = io.BytesIO()
            pq.write_table(table.slice(at, end - at).drop_columns(PAIR), to, compression="zstd", write_statistics=False, store_schema=False)
            packs.append(to.getvalue())
        return pa.record_batch([pa.array(q[start], pa.int32()), pa.array(p[start], pa.int32()), pa.array(packs, pa.binary())], [*PAIR, "packed"])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            held, n = [*held, batch], n + batch.num_rows
            if n >= PACK_ROWS:
                yield pack(held)
                held, n = [], 0
        if n:
            yield pack(held)

    return rows.mapInArrow(packed, "q_part int, p_part int, packed binary")


def _unpacked(packs: pa.Table) -> dict[str, np.ndarray]:
    table = pa.concat_tables([pq.read_table(io.BytesIO(p.as_py())) for p in packs["packed"]])
    return {c: table[c].to_numpy() for c in table.column_names}


def _summed(
    locations: DataFrame, points: DataFrame, near: Planar | GreatCircle, few: int = FEW, same: tuple[str, ...] = ()
) -> DataFrame:
    """Per location its rows and the weight near it; where the columns ``same`` are given, of points that agree in them."""
    place, zero = ["q_lat", "q_lon"], F.lit(0).cast("long")
    probes = _in_parts(locations.select(*place, "n_rows", *same).dropna(subset=[*place, *same]), *place, "q_part")
    extents = _extents(points, "p", "p_part", F.sum("weight").alias("weight"))
    q_part, p_part = _extent("q"), _extent("p")
    probe, point = Box.of(F.col("q_lat"), F.col("q_lon")), Box.of(F.col("p_lat"), F.col("p_lon"))

    def all_match(q: Box, p: Box) -> Column:
        return F.lit(False) if same else near.all_match(q, p, Columns)

    pairs = _extents(probes, "q", "q_part").join(extents, near.may_match(q_part, p_part, Columns))
    pairs = durable(pairs.withColumn("whole", all_match(q_part, p_part)), "near-pairs")
    rim = pairs.where("not whole")
    # Points near every probe of a part are counted here and meet none of them.
    within = join_by_work(points.withColumnRenamed("weight", "own"), rim, ["p_part"]).where(all_match(q_part, point))
    within = durable(within.groupBy(*PAIR).agg(F.sum("own").alias("within")), "near-within")
    rim = rim.join(within, PAIR, "left").withColumn("within", F.coalesce("within", zero))
    rim = durable(rim.withColumn("rest", F.col("weight") - F.col("within")).drop("weight", "whole"), "near-rims")
    weights = pairs.where("whole").select("q_part", "weight").unionByName(rim.select("q_part", F.col("within").alias("weight")))
    weights = durable(weights.groupBy("q_part").agg(F.sum("weight").alias("weight")), "near-weights")
    rim = rim.where("rest > 0").drop("within")
    tasks = int(locations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(1, min(rim.count(), WALKS_PER_TASK * tasks))

    def met(rows: DataFrame, part: str, q: Box, p: Box) -> DataFrame:
        """Each row once for every pair of parts in which something may be near it and something not."""
        on_rim = near.may_match(q, p, Columns) & ~all_match(q, p)
        kept = join_by_work(rows, rim, [part]).where(on_rim).select(*PAIR, *[c for c in rows.columns if c != part])
        # By number, so that adaptive execution leaves the tasks apart: they do much work per byte.
        return _packed(kept, rows.columns[0]).repartition(tasks, *PAIR)

    left = met(probes.drop("n_rows"), "q_part", probe, p_part)
    right = met(points, "p_part", q_part, point)

    def walk(q: pa.Table, p: pa.Table) -> pa.Table:
        if not q.num_rows or not p.num_rows:
            return pa.table({c: pa.array([], t) for c, t in zip((*place, "weight"), (pa.float64(), pa.float64(), pa.int64()))})
        q, p = _unpacked(q), _unpacked(p)
        probe = {"lat": q["q_lat"], "lon": q["q_lon"], **{c: q[c] for c in same}}
        point = {"lat": p["p_lat"], "lon": p["p_lon"], "weight": p["weight"], **{c: p[c] for c in same}}
        found = treewalk.count(near, few, probe, point, same)
        near_any = found > 0
        return pa.table({**{c: q[c][near_any] for c in place}, "weight": found[near_any]})

    walked = left.groupBy(*PAIR).cogroup(right.groupBy(*PAIR)).applyInArrow(walk, "q_lat double, q_lon double, weight long")
    # Per probe the weights of its part, and the rest of each part wholly around it. Some locations are in no part.
    edges = [c for c in extents.columns if c not in ("p_part", "weight")]
    around = weights.withColumn("whole", F.lit(True)).unionByName(
        rim.select("q_part", F.col("rest").alias("weight"), F.lit(False).alias("whole"), *edges), allowMissingColumns=True
    )
    summed = F.when(F.col("whole") | all_match(probe, p_part), F.col("weight")).otherwise(zero)
    found = probes.join(around, "q_part").select(*place, zero.alias("n_rows"), summed.alias("weight")).where("weight > 0")
    found = found.unionByName(locations.select(*place, "n_rows", zero.alias("weight")))
    found = found.unionByName(walked.select(*place, zero.alias("n_rows"), "weight"))
    return found.groupBy(*place).agg(F.max("n_rows").alias("n_rows"), F.sum("weight").alias("n_near"))


def with_near_count(
    rows: DataFrame,
    points: DataFrame,
    near: Planar | GreatCircle,
    column: str,
    row_lat: str = "lat",
    row_lon: str = "lon",
    few: int = FEW,
    rows_per_part: int = ROWS_PER_PART,
) -> DataFrame:
    """``rows`` with the number of near points in ``column``; 0 where there is none or no location."""
    counts = count_around(rows, points, near, row_lat, row_lon, few=few)
    return onto_rows(rows, counts, column, row_lat, row_lon, rows_per_part)


def onto_rows(
    rows: DataFrame,
    counts: DataFrame,
    column: str,
    row_lat: str = "lat",
    row_lon: str = "lon",
    rows_per_part: int = ROWS_PER_PART,
) -> DataFrame:
    """``rows`` with what :func:`count_around` found at their location in ``column``, 0 where there is none."""
    counts = counts.select(
        F.col("q_lat").alias(row_lat), F.col("q_lon").alias(row_lon), "n_rows", F.col("n_near").alias(column)
    )
    joined = join_per_key(rows, counts, [row_lat, row_lon], "n_rows", rows_per_part)
    return joined.withColumn(column, F.coalesce(F.col(column), F.lit(0))).select(*rows.columns, column)


def nearby_inspections(crime: DataFrame, inspections: DataFrame, column: str = "nearby_inspection_count") -> DataFrame:
    """Inspections strictly within 500 planar metres and inside the +-0.005 degree box of each crime."""
    return with_near_count(crime, inspections, COUNT_CIRCLE, column)


def nearby_inspection_counts(crime: DataFrame, inspections: DataFrame) -> DataFrame:
    """What :func:`nearby_inspections` looks up, by location."""
    return count_around(crime, inspections, COUNT_CIRCLE)


def nearby_inspections_degrees(crime: DataFrame, inspections: DataFrame, column: str = "nearby_inspections") -> DataFrame:
    """Inspections within 0.01 in coordinate space of each crime, edge included."""
    return with_near_count(crime, inspections, DEGREE_CIRCLE, column)


def nearby_inspections_haversine(
    crime: DataFrame, inspections: DataFrame, column: str = "nearby_inspections_count"
) -> DataFrame:
    """Inspections within 500 great-circle metres of each crime, edge included."""
    return with_near_count(crime, inspections, HAVERSINE_CIRCLE, column)


def inspections_in_buffer(crime: DataFrame, inspections: DataFrame, radius_m: float = BUFFER_RADIUS_M) -> DataFrame:
    """Per (lon, lat): pairs of a crime there and an inspection within ``radius_m`` planar metres.

    Crimes without a location form a group of their own with count 0.
    """
    circle = Planar(radius_m, BUFFER_CIRCLE.lat_scale, BUFFER_CIRCLE.lon_scale)
    counted = count_around(crime, inspections, circle).select(
        F.col("q_lon").alias("lon"),
        F.col("q_lat").alias("lat"),
        (F.col("n_rows") * F.col("n_near")).alias("inspection_count"),
    )
    unlocated = (
        crime.where(~is_number("lat") | ~is_number("lon"))
        .groupBy("lon", "lat")
        .agg(F.lit(0).cast("long").alias("inspection_count"))
    )
    return counted.unionByName(unlocated)


def same_cell_inspections(
    crime: DataFrame, inspections: DataFrame, cell: float = 0.01, column: str = "nearby_inspections_count"
) -> DataFrame:
    """The short cut of looking only at the probe's own cell, with cell ids cut towards zero.

    Misses neighbours across cell edges; kept to reproduce results obtained that way. A probe starts at the tree of its own
    cell only.
    """

    def in_cells(lat: str, lon: str) -> dict[str, Column]:
        return {"cell_lat": (F.col(lat) / cell).try_cast("long"), "cell_lon": (F.col(lon) / cell).try_cast("long")}

    with shuffles_released(crime.sparkSession):
        places = _locations(crime, "lat", "lon").withColumns(in_cells("q_lat", "q_lon"))
        dealt = _point_parts(inspections, "latitude", "longitude", in_cells("p_lat", "p_lon"))
        counts = durable(_summed(places, dealt, HAVERSINE_CIRCLE, same=("cell_lat", "cell_lon")), "same-cell")
    return onto_rows(crime, counts, column)


def points_per_cell(points: DataFrame, lat: str = "latitude", lon: str = "longitude", cell: float = 0.01) -> DataFrame:
    """The points of each grid cell, one row per cell and distinct point with its number as weight.

    One aggregation. A row says the same however many points share its cell, and no list grows with the data.
    """
    return (
        _located(points, lat, lon)
        .groupBy(
            geo.cell_index(lat, cell).alias("cell_lat"),
            geo.cell_index(lon, cell).alias("cell_lon"),
            F.col(lon).alias("longitude"),
            F.col(lat).alias("latitude"),
        )
        .agg(F.count(F.lit(1)).alias("weight"))
    )
