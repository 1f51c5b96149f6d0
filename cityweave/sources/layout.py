"""Tables written along a space-filling curve, so that a box predicate skips most of their row groups.

Latitude and longitude become whole numbers of 31 bits each, whose bits alternate in the key (Z-order): places that are close
together mostly have close keys, in whatever part of the map the data lie. Rows are dealt by ranges of the key and sorted by
it, so each row group covers a small area, and Parquet's own statistics tell a reader which ones a box can meet.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cityweave.functions.numbers import is_number
from cityweave.sources.scratch import durable

BITS = 31
ROWS_PER_FILE = 1_000_000
ROWS_PER_GROUP = 50_000
# Rows that a task sorts at most; it writes them to files of the asked size.
ROWS_PER_RUN = 1_000_000
#: Steps that move the bits of a number apart: how far, and which bits stay.
_SPREAD = ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555))


def _apart(number: Column) -> Column:
    for shift, mask in _SPREAD:
        number = number.bitwiseOR(F.shiftleft(number, shift)).bitwiseAND(F.lit(mask))
    return number


def _whole(degrees: Column, half: float) -> Column:
    """From -half .. half degrees to 0 .. 2^31 - 1; what lies outside counts as the edge."""
    share = (F.least(F.greatest(degrees, F.lit(-half)), F.lit(half)) + half) / (2 * half)
    return F.least(F.floor(share * (1 << BITS)), F.lit((1 << BITS) - 1)).cast("long")


def place_key(lat: str = "latitude", lon: str = "longitude") -> Column:
    """Z-order key of a place; NULL without one."""
    y, x = (_whole(F.col(c).cast("double"), half) for c, half in ((lat, 90.0), (lon, 180.0)))
    key = _apart(x).bitwiseOR(F.shiftleft(_apart(y), 1))
    return F.when(is_number(lat) & is_number(lon), key)


def write_by_place(
    df: DataFrame,
    path: str,
    lat: str = "latitude",
    lon: str = "longitude",
    rows_per_file: int = ROWS_PER_FILE,
    rows_per_group: int = ROWS_PER_GROUP,
) -> None:
    """Overwrite ``path`` with Parquet in which rows of close places lie together.

    ``df`` is worked out once: counting, the look for ranges and the sort read the written rows. Files hold the asked number of
    rows at most, and a task writes several, so neither tasks nor shuffle blocks grow with the number of files.
    Many rows of one place may share a file; they are one value to the range partitioner, which another key column, a hash
    of the row, divides.
    """
    spark = df.sparkSession
    keyed = durable(df.withColumns({"_place": place_key(lat, lon), "_mark": F.xxhash64(*df.columns)}), "by-place")
    n = keyed.count()
    files, tasks = math.ceil(n / rows_per_file), int(spark.conf.get("spark.sql.shuffle.partitions"))
    runs = max(1, min(files, tasks), math.ceil(n / ROWS_PER_RUN))
    ordered = keyed.repartitionByRange(runs, "_place", "_mark").sortWithinPartitions("_place").drop("_place", "_mark")
    limits = {"parquet.block.row.count.limit": rows_per_group, "maxRecordsPerFile": rows_per_file}
    ordered.write.mode("overwrite").options(**limits).parquet(path)


def in_box(df: DataFrame, south: float, north: float, west: float, east: float, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """Rows in a box, edges included; on a table written by place the scan skips what lies elsewhere."""
    return df.where(F.col(lat).between(south, north) & F.col(lon).between(west, east))
