"""End-to-end jobs from the raw tables to the result. Neighbour counts write their intermediate tables as they go."""

from __future__ import annotations

import hashlib
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cityweave.functions import geo, times
from cityweave.operators import cleaning, nearby, trends
from cityweave.sources import resume
from cityweave.sources.tables import write_csv, write_parquet


def text_coordinates(inspections: DataFrame) -> DataFrame:
    """Cleaned float32 coordinates as the doubles their decimal text denotes."""
    return inspections.withColumns({c: geo.as_written(c) for c in ("latitude", "longitude")})


def with_distance(crime: DataFrame) -> DataFrame:
    """Cleaned crimes with distance to the centre and distance band."""
    placed = crime.withColumn("distance_km", geo.planar_km("lat", "lon"))
    return placed.withColumn("distance_group", geo.distance_band("distance_km"))


def enrich_crime(crime: DataFrame, inspections: DataFrame) -> DataFrame:
    """Cleaned crimes with distance to the centre, distance band and number of inspections nearby."""
    return nearby.nearby_inspections(with_distance(crime), text_coordinates(inspections))


def clean_and_enrich(crime_raw: DataFrame, inspection_raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The final crime and inspection tables."""
    inspections = cleaning.clean_inspections(inspection_raw)
    return enrich_crime(cleaning.clean_crime(crime_raw), inspections), inspections


def export(crime: DataFrame, inspections: DataFrame, folder: str, format: str = "csv") -> None:
    """Write both final tables below ``folder``."""
    for name, df in (("crime_final", crime), ("ins_final", inspections)):
        if format == "csv":
            write_csv(df, f"{folder}/{name}")
        else:
            write_parquet(df, f"{folder}/{name}")


def export_job(crime_raw: DataFrame, inspection_raw: DataFrame, folder: str, format: str = "csv") -> None:
    """The whole job, from the raw tables to both final tables below ``folder``; may be killed and run again.

    Each raw table is read and cleaned once. On input that was exported before, nothing is done. CSV is gzipped, which Spark
    reads like plain text: unpacked, both tables and what they are made from would take several times the raw tables.
    """
    spark = crime_raw.sparkSession
    work = hashlib.md5(f"{resume.version_of(crime_raw, inspection_raw)} {folder} {format}".encode()).hexdigest()
    job = resume.Job(spark, "export", work)
    if job.is_published(folder):
        return
    crime = job.step("crime", lambda: cleaning.clean_crime(crime_raw))
    inspections = job.step("inspections", lambda: cleaning.clean_inspections(inspection_raw))
    points = text_coordinates(inspections)
    counts = job.step("near-counts", lambda: nearby.nearby_inspection_counts(crime, points))
    enriched = nearby.onto_rows(with_distance(crime), counts, "nearby_inspection_count")
    write = partial(write_csv, compression="gzip") if format == "csv" else write_parquet
    results = {"crime_final": (enriched, crime.count()), "ins_final": (inspections, inspections.count())}
    job.publish({name: resume.Result(df, n, write) for name, (df, n) in results.items()}, folder)


def band_summary(crime: DataFrame) -> DataFrame:
    """How many inspections lie near crimes, by distance from the centre."""
    return crime.groupBy("distance_group").agg(
        F.count(F.lit(1)).alias("n_crimes"),
        F.sum("nearby_inspection_count").alias("n_nearby"),
        F.avg("nearby_inspection_count").alias("avg_nearby"),
    )


def selected_crime(crime_raw: DataFrame) -> DataFrame:
    """Chosen crime columns with year and month of occurrence."""
    chosen = crime_raw.select("date_occ", "area_name", "crm_cd_desc", "vict_age", "vict_sex", "vict_descent")
    return trends.with_year_month(chosen.withColumn("date_occ", times.parse_timestamp("date_occ")), "date_occ")


def selected_inspections(inspection_raw: DataFrame) -> DataFrame:
    """Chosen inspection columns with year and month of inspection."""
    chosen = inspection_raw.select("inspection_date", "permit_status", "inspection_result", "inspection_type")
    parsed = chosen.withColumn("inspection_date", times.parse_date("inspection_date"))
    return trends.with_year_month(parsed, "inspection_date")
