"""CSV datasets: which columns are used, under which header, with which type.

Headers are matched by name, so files may have more columns, in any order. Types are declared, not
inferred: there is no extra pass over the data and codes keep their leading zeros.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Field:
    header: str
    name: str
    type: str = "string"


@dataclass(frozen=True)
class Dataset:
    fields: tuple[Field, ...]

    @property
    def headers(self) -> dict[str, str]:
        """Column name -> CSV header."""
        return {f.name: f.header for f in self.fields}

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(", ".join(f"{f.name} {f.type}" for f in self.fields))


CRIME = Dataset(
    (
        Field("DR_NO", "dr_no", "bigint"),
        Field("Date Rptd", "date_rptd"),
        Field("DATE OCC", "date_occ"),
        Field("Crm Cd 1", "crm_cd_1", "int"),
        Field("TIME OCC", "time_occ", "int"),
        Field("AREA NAME", "area_name"),
        Field("Crm Cd Desc", "crm_cd_desc"),
        Field("Vict Age", "vict_age", "int"),
        Field("Vict Sex", "vict_sex"),
        Field("Vict Descent", "vict_descent"),
        Field("Premis Desc", "premis_desc"),
        Field("LAT", "lat", "double"),
        Field("LON", "lon", "double"),
    )
)

INSPECTION = Dataset(
    (
        Field("PERMIT", "permit"),
        Field("Permit Status", "permit_status"),
        Field("Inspection Type", "inspection_type"),
        Field("Inspection Result", "inspection_result"),
        Field("Inspection Date", "inspection_date"),
        Field("Latitude/Longitude", "latitude_longitude"),
    )
)

BUSINESS = Dataset(
    (
        Field("LOCATION ACCOUNT #", "account_no"),
        Field("PRIMARY NAICS DESCRIPTION", "primary_naics_description"),
        Field("LOCATION START DATE", "location_start_date"),
    )
)

MO_CODES = Dataset((Field("Mocode", "mocodes"),))


def read_csv(spark: SparkSession, path: str, dataset: Dataset, multi_line: bool = False) -> DataFrame:
    """Scan a CSV file or folder as ``dataset``.

    Only the header line is looked at up front. Text that does not fit a numeric type becomes NULL.
    ``multi_line`` accepts line breaks inside quotes, but such files cannot be split between tasks.
    """
    raw = (
        spark.read.option("header", True)
        .option("sep", ",")
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multi_line)
        .csv(path)
    )
    found = {c.strip().lower(): c for c in raw.columns}
    missing = [f.header for f in dataset.fields if f.header.lower() not in found]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")

    def typed(f: Field):
        column = F.col(f"`{found[f.header.lower()]}`")
        return (column if f.type == "string" else column.try_cast(f.type)).alias(f.name)

    return raw.select(*[typed(f) for f in dataset.fields])
