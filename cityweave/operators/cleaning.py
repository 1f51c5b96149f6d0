"""Cleaning rules for the crime and inspection tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cityweave.functions import geo, times

UNKNOWN = "Unidentified"


def require_fields(df: DataFrame, *columns: str) -> DataFrame:
    """Keep the rows in which every given column is present."""
    present = F.lit(True)
    for c in columns:
        present = present & F.col(c).isNotNull()
    return df.where(present)


def fill_unidentified(df: DataFrame, *columns: str) -> DataFrame:
    return df.fillna(UNKNOWN, subset=list(columns))


def valid_crimes(crime: DataFrame) -> DataFrame:
    """Crimes with premises and a first crime code; nothing else is changed."""
    return require_fields(crime, "premis_desc", "crm_cd_1")


def clean_crime(crime: DataFrame) -> DataFrame:
    """Required fields, parsed dates, weekday and hour of occurrence, named unknown victims."""
    kept = valid_crimes(crime).withColumns(
        {
            "date_rptd": times.parse_timestamp("date_rptd"),
            "date_occ": times.parse_timestamp("date_occ"),
            "time_occ": times.military_hour("time_occ"),
        }
    )
    named = kept.withColumn("day_of_week_occ", times.weekday_name("date_occ"))
    return fill_unidentified(named, "vict_sex", "vict_descent")


def clean_inspections(inspection: DataFrame) -> DataFrame:
    """Located inspections with float32 coordinates, parsed date, year and month."""
    located = require_fields(inspection, "latitude_longitude").withColumns(
        {
            "latitude": geo.narrow_latitude("latitude_longitude"),
            "longitude": geo.narrow_longitude("latitude_longitude"),
            "inspection_date": times.parse_date("inspection_date"),
        }
    )
    return located.drop("latitude_longitude").withColumns(
        {"year": F.year("inspection_date"), "month": F.month("inspection_date")}
    )


def located_inspections(inspection: DataFrame) -> DataFrame:
    """Located inspections with double coordinates from the permissive text form."""
    return (
        require_fields(inspection, "latitude_longitude")
        .withColumns(
            {
                "latitude": geo.loose_latitude("latitude_longitude"),
                "longitude": geo.loose_longitude("latitude_longitude"),
            }
        )
        .drop("latitude_longitude")
    )
