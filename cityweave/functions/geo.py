"""Coordinate expressions: text splitting, distances, bands and grid cells."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# City centre, planar scales at that latitude, earth radius, distance bands.
CENTRE_LAT = 34.0522
CENTRE_LON = -118.2437
KM_PER_LAT_DEGREE = 111.0
KM_PER_LON_DEGREE = 92.0
EARTH_KM = 6371.0
EARTH_M = 6371000.0
BANDS = ((10.0, "0-10km"), (20.0, "10-20km"))
OUTER_BAND = ">20km"
# Fixed values, text form "(lat, lon)": the narrow pattern accepts only digits with a decimal point, the loose one any text.
LAT_TEXT = r"\((-?\d+\.\d+),"
LON_TEXT = r", (-?\d+\.\d+)\)"
LOOSE_TEXT = r"\(([^,]+), ([^)]+)\)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def narrow_latitude(text: Column | str) -> Column:
    return F.regexp_extract(_col(text), LAT_TEXT, 1).try_cast("float")


def narrow_longitude(text: Column | str) -> Column:
    return F.regexp_extract(_col(text), LON_TEXT, 1).try_cast("float")


def loose_latitude(text: Column | str) -> Column:
    return F.regexp_extract(_col(text), LOOSE_TEXT, 1).try_cast("double")


def loose_longitude(text: Column | str) -> Column:
    return F.regexp_extract(_col(text), LOOSE_TEXT, 2).try_cast("double")


def as_written(c: Column | str) -> Column:
    """A float32 coordinate as the double that its decimal text denotes.

    Cleaned coordinates are float32 and reach the distance test through text, so ``-118.24368`` counts
    as exactly that and not as the nearest float32 widened bit by bit.
    """
    return _col(c).cast("string").cast("double")


def planar_km(lat: Column | str, lon: Column | str, to_lat: float = CENTRE_LAT, to_lon: float = CENTRE_LON) -> Column:
    """Planar distance in km to a fixed point, with one scale per axis."""
    north = (_col(lat) - to_lat) * KM_PER_LAT_DEGREE
    east = (_col(lon) - to_lon) * KM_PER_LON_DEGREE
    return F.sqrt(north * north + east * east)


def distance_band(km: Column | str) -> Column:
    """Three bands with inclusive upper edges; an unknown distance falls into the outer band."""
    km = _col(km)
    (first, near), (second, middle) = BANDS
    return F.when(km <= first, near).when(km <= second, middle).otherwise(OUTER_BAND)


def haversine_angle(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Central angle in radians between two points given in degrees."""
    lat1, lon1, lat2, lon2 = (F.radians(c) for c in (lat1, lon1, lat2, lon2))
    half_lat, half_lon = F.sin((lat2 - lat1) / 2), F.sin((lon2 - lon1) / 2)
    a = half_lat * half_lat + F.cos(lat1) * F.cos(lat2) * half_lon * half_lon
    # Rounding may lift the term of opposite points above 1; NULL and NaN pass through.
    return 2 * F.asin(F.sqrt(F.when(a.between(1, 2), 1.0).otherwise(a)))


def haversine_km(lat: Column | str, lon: Column | str, to_lat: float = CENTRE_LAT, to_lon: float = CENTRE_LON) -> Column:
    """Great-circle distance in km to a fixed point."""
    return haversine_angle(_col(lat), _col(lon), F.lit(to_lat), F.lit(to_lon)) * EARTH_KM


def haversine_m(lon1: Column | str, lat1: Column | str, lon2: Column | str, lat2: Column | str) -> Column:
    """Great-circle distance between two columns of points in whole metres, cut off, not rounded."""
    return (haversine_angle(_col(lat1), _col(lon1), _col(lat2), _col(lon2)) * EARTH_M).cast("int")


def cell_index(c: Column | str, size: float) -> Column:
    """Grid index along one axis; cells tile the axis evenly also below zero."""
    return F.floor(_col(c) / size)


def cell_name(lat: Column | str, lon: Column | str, size: float = 0.01) -> Column:
    """Cell id as text with both indexes cut towards zero, so cells touching an axis are twice as wide."""
    return F.concat((_col(lat) / size).cast("long"), F.lit(","), (_col(lon) / size).cast("long"))
