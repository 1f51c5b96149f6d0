"""Registry of named queries. Each takes (spark, folder of benchmark tables) and returns a DataFrame.

Numbers that pass through square roots, trigonometry or sums of doubles are rounded to six places, so that
results can be compared between engines.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cityweave.functions import bins, geo, times
from cityweave.operators import charts, cleaning, crosstab, nearby, profile, serving, trends
from cityweave.operators.quantiles import quantiles
from cityweave.plans import jobs
from cityweave.sources import datasets, layout, saved, tables
from cityweave.sources.derived import raw_tables
from cityweave.sources.scratch import durable, fresh_path

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

# Parameters of the registered queries.
TOP_TYPES = 5
TABLE_TYPES = 15
SHARE_TYPES = 3
KEPT_TYPES = 2
# The least frequent value kept, as a share of all rows.
STATUS_SHARE = 0.2
INSPECTION_TYPE_SHARE = 0.084
CRIME_TYPE_SHARE = 0.05
SAMPLE_ROWS = 10_000
OPENINGS_SINCE = 2010
CORRELATED = ("time_occ", "vict_age", "lat", "lon")
BOX = (34.04, 34.06, -118.26, -118.23)
REFRESHED_SINCE = "1998-03-15"
CHOSEN_TYPE = "Crime-0"
CHOSEN_DESCENT = "BUILDING"


class Tables:
    """The raw tables of one folder and the cleaned forms most queries start from."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        raw = raw_tables(spark, folder.rstrip("/"))
        self.crime_raw, self.inspection_raw, self.business_raw = raw["crime"], raw["inspection"], raw["business"]

    @property
    def crime(self) -> DataFrame:
        return cleaning.clean_crime(self.crime_raw)

    @property
    def valid(self) -> DataFrame:
        return cleaning.valid_crimes(self.crime_raw)

    @property
    def inspections(self) -> DataFrame:
        return cleaning.clean_inspections(self.inspection_raw)

    @property
    def located(self) -> DataFrame:
        return cleaning.located_inspections(self.inspection_raw)

    @property
    def dated_inspections(self) -> DataFrame:
        return self.inspection_raw.withColumn("inspection_date", times.parse_date("inspection_date"))

    @property
    def measured(self) -> DataFrame:
        """Valid crimes with great-circle distance to the centre."""
        return self.valid.withColumn("distance", geo.haversine_km("lat", "lon"))

    @property
    def types_by_nearby(self) -> DataFrame:
        """Crime type, inspections within 0.01 degrees and number of such crimes, for the most frequent types."""
        kept = profile.keep_top_values(self.valid, "crm_cd_desc", TABLE_TYPES)
        near = nearby.nearby_inspections_degrees(kept.select("crm_cd_desc", "lat", "lon"), self.located)
        return durable(near.groupBy("crm_cd_desc", "nearby_inspections").agg(F.count("*").alias("n")), "nearby")

    def cells(self, labelled: DataFrame, label: str) -> DataFrame:
        """Observed (type, label) cells of the types most frequent in the whole table."""
        kept = profile.keep_top_values(labelled, "crm_cd_desc", TOP_TYPES)
        return crosstab.observed_cells(kept, "crm_cd_desc", label)

    @property
    def by_time(self) -> DataFrame:
        return self.valid.withColumn("hour_category", bins.HOURS.label(times.military_hour("time_occ")))

    @property
    def by_distance(self) -> DataFrame:
        # Through the explosion no filter on the bin reaches the distance, which it would compute again for each edge.
        once = self.measured.withColumn("distance", F.explode(F.array("distance")))
        return once.withColumn("distance_bin", bins.DISTANCES.label("distance"))


def query(make: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return make(Tables(spark, folder))

    run.__doc__ = make.__doc__
    REGISTRY[make.__name__] = run
    return make


def r6(c: Column | str, name: str | None = None) -> Column:
    rounded = F.round(c, 6)
    return rounded.alias(name or c) if name or isinstance(c, str) else rounded


def as_int(df: DataFrame, column: str) -> DataFrame:
    """Counts are bigint; the export's column is an int."""
    return df.withColumn(column, F.col(column).cast("int"))


def share_of_rows(df: DataFrame, share: float) -> Column:
    return df.agg(F.count(F.lit(1)) * F.lit(share)).scalar()


# --- scans, sinks, tables


@query
def scan_csv(t: Tables) -> DataFrame:
    """Raw crimes written as CSV under the source headers and scanned back with declared types."""
    path = fresh_path(t.spark, "crime-csv")
    tables.write_csv(t.crime_raw, path, datasets.CRIME.headers)
    return datasets.read_csv(t.spark, path, datasets.CRIME)


@query
def scan_csv_inspections(t: Tables) -> DataFrame:
    """Raw inspections written as CSV under the source headers and scanned back; permits are text there."""
    path = fresh_path(t.spark, "inspection-csv")
    tables.write_csv(t.inspection_raw, path, datasets.INSPECTION.headers)
    return datasets.read_csv(t.spark, path, datasets.INSPECTION)


@query
def scan_csv_business(t: Tables) -> DataFrame:
    """Raw businesses written as CSV under the source headers and scanned back; account numbers are text there."""
    path = fresh_path(t.spark, "business-csv")
    tables.write_csv(t.business_raw, path, datasets.BUSINESS.headers)
    return datasets.read_csv(t.spark, path, datasets.BUSINESS)


@query
def export_job(t: Tables) -> DataFrame:
    """The whole job: both final tables exported as CSV, read back and counted by area and by status."""
    path = fresh_path(t.spark, "export")
    jobs.export_job(t.crime_raw, t.inspection_raw, path)
    csv = t.spark.read.option("header", True).option("escape", '"').csv
    near = F.sum(F.col("nearby_inspection_count").cast("long")).alias("n_nearby")
    crimes = csv(f"{path}/crime_final").groupBy(F.col("area_name").alias("label")).agg(F.count("*").alias("n_rows"), near)
    inspections = csv(f"{path}/ins_final").groupBy(F.col("permit_status").alias("label"))
    return crimes.unionByName(inspections.agg(F.count("*").alias("n_rows"), F.lit(0).cast("long").alias("n_nearby")))


@query
def box_on_layout(t: Tables) -> DataFrame:
    """Inspections of each type in a box around the centre, from a table written along a space-filling curve."""
    path = fresh_path(t.spark, "by-place")
    layout.write_by_place(t.located.select("inspection_type", "latitude", "longitude"), path, rows_per_file=20_000, rows_per_group=2_000)
    boxed = layout.in_box(t.spark.read.parquet(path), *BOX)
    return boxed.groupBy("inspection_type").agg(F.count("*").alias("n"))


def _table_name() -> str:
    return f"area_counts_{uuid.uuid4().hex}"


@query
def ctas_if_absent(t: Tables) -> DataFrame:
    """A saved table is kept when it is created a second time with other rows."""
    name = _table_name()
    counts = profile.counts_by(t.valid, "area_name")
    tables.create_table_if_absent(counts, name, fresh_path(t.spark, "table"))
    found = tables.create_table_if_absent(counts.where("n < 0"), name)
    t.spark.sql(f"drop table {name}")
    return found


@query
def replace_table(t: Tables) -> DataFrame:
    """A saved table takes the rows it was last replaced with."""
    name, path = _table_name(), fresh_path(t.spark, "table")
    counts = profile.counts_by(t.valid, "area_name")
    tables.create_table_if_absent(counts.where("n < 0"), name, path)
    found = tables.replace_table(counts, name, path)
    t.spark.sql(f"drop table {name}")
    return found


@query
def publish_table(t: Tables) -> DataFrame:
    """Two versions swapped in through the catalog; one that fails its check changes nothing."""
    name, folder = _table_name(), fresh_path(t.spark, "versions")
    counts = profile.counts_by(t.valid, "area_name")
    saved.publish(counts.where("n < 0"), name, "1", 0, folder)
    saved.publish(counts, name, "2", folder=folder)
    try:
        saved.publish(counts.where("n < 0"), name, "3", 1, folder)
    except RuntimeError:
        found = durable(t.spark.table(name), "published")
    t.spark.sql(f"drop view {name}")
    for version in "12":
        t.spark.sql(f"drop table {name}__{version}")
    return found


@query
def update_saved(t: Tables) -> DataFrame:
    """A saved table gets a column and an update; only the areas with such crimes are rewritten."""
    name = _table_name()
    crimes = t.valid.select("dr_no", "vict_age", "area_name")
    crimes.write.partitionBy("area_name").option("path", fresh_path(t.spark, "saved")).saveAsTable(name)
    saved.add_column(t.spark, name, "checked", "int", "0")
    found = saved.update(t.spark, name, {"checked": F.lit(1)}, F.col("area_name").like("%A") | (F.col("vict_age") < 2))
    counted = found.groupBy("area_name").agg(F.count("*").alias("n"), F.sum("checked").alias("n_checked"))
    counted = durable(counted, "checked")
    t.spark.sql(f"drop table {name}")
    return counted


@query
def sink_csv(t: Tables) -> DataFrame:
    """Cleaned inspections written as CSV and read back."""
    path = fresh_path(t.spark, "inspections-csv")
    cleaned = jobs.text_coordinates(t.inspections)
    tables.write_csv(cleaned, path)
    return t.spark.read.schema(cleaned.schema).option("header", True).option("escape", '"').csv(path)


@query
def sink_parquet(t: Tables) -> DataFrame:
    """Cleaned crimes written as Parquet, one folder per area, and read back."""
    path = fresh_path(t.spark, "crime-parquet")
    crimes = t.crime.select("dr_no", "area_name", "date_occ", "time_occ", "vict_sex")
    tables.write_parquet(crimes, path, ("area_name",))
    return t.spark.read.schema(crimes.schema).parquet(path)


@query
def sql_view(t: Tables) -> DataFrame:
    """A DataFrame exposed to SQL text."""
    tables.expose(t.valid, "valid_crime")
    return t.spark.sql(
        "select area_name, count(*) as n, min(vict_age) as youngest, max(vict_age) as oldest "
        "from valid_crime group by area_name"
    )


@query
def add_column_if_missing(t: Tables) -> DataFrame:
    """Two new columns with a default; the third exists in another letter case and is left alone."""
    df = tables.add_column_if_missing(t.crime_raw, "downtown_distance", "string")
    df = tables.add_column_if_missing(df, "nearby_inspection_count", "int", 0)
    df = tables.add_column_if_missing(df, "LAT", "double", 0.0)
    return df.select("dr_no", "lat", "downtown_distance", "nearby_inspection_count")


@query
def update_column(t: Tables) -> DataFrame:
    """Distance band filled into a column, then corrected on the rows without a location."""
    df = tables.add_column_if_missing(t.crime_raw, "downtown_distance", "string")
    df = tables.update_columns(df, {"downtown_distance": geo.distance_band(geo.planar_km("lat", "lon"))})
    df = tables.update_columns(df, {"downtown_distance": F.lit("unknown")}, F.col("lat").isNull())
    return df.select("dr_no", "downtown_distance")


@query
def row_count(t: Tables) -> DataFrame:
    return tables.row_count(t.crime_raw)


@query
def describe_columns(t: Tables) -> DataFrame:
    """Positions, names and types of the raw crime columns."""
    return tables.describe_columns(t.crime_raw)


@query
def list_tables(t: Tables) -> DataFrame:
    """Two saved tables, found in the list of tables by their names."""
    mark, counts = _table_name(), profile.counts_by(t.valid, "area_name")
    for label in ("a", "b"):
        tables.create_table_if_absent(counts, f"{mark}_{label}", fresh_path(t.spark, "table"))
    found = [(n.rsplit("_", 1)[1], t.spark.table(n).count()) for n in tables.list_tables(t.spark) if n.startswith(mark)]
    for label in ("a", "b"):
        t.spark.sql(f"drop table {mark}_{label}")
    return t.spark.createDataFrame(found, "label string, n_areas long")


@query
def preview(t: Tables) -> DataFrame:
    return tables.preview(t.crime_raw, "dr_no", 5)


# --- projections and filters


@query
def project_columns(t: Tables) -> DataFrame:
    return t.crime_raw.select("date_occ", "area_name", "crm_cd_desc", "vict_age", "vict_sex", "vict_descent")


@query
def rename_columns(t: Tables) -> DataFrame:
    names = {"time_occ": "time_of_day", "vict_age": "victim_age", "lat": "latitude", "lon": "longitude"}
    return t.valid.select("dr_no", *names).withColumnsRenamed(names)


@query
def require_fields(t: Tables) -> DataFrame:
    return t.valid.select("dr_no", "premis_desc", "crm_cd_1")


@query
def filter_top_types(t: Tables) -> DataFrame:
    """Crimes of the most frequent types."""
    return profile.keep_top_values(t.valid.select("dr_no", "crm_cd_desc"), "crm_cd_desc", KEPT_TYPES)


@query
def frequent_values(t: Tables) -> DataFrame:
    return profile.frequent_values(t.located, "permit_status", share_of_rows(t.located, STATUS_SHARE))


@query
def frequent_inspection_types(t: Tables) -> DataFrame:
    return profile.frequent_values(t.located, "inspection_type", share_of_rows(t.located, INSPECTION_TYPE_SHARE))


@query
def frequent_crime_types(t: Tables) -> DataFrame:
    return profile.frequent_values(t.valid, "crm_cd_desc", share_of_rows(t.valid, CRIME_TYPE_SHARE))


# --- scalar functions


@query
def parse_timestamp(t: Tables) -> DataFrame:
    parsed = {c: times.parse_timestamp(c) for c in ("date_rptd", "date_occ")}
    return t.crime_raw.select("dr_no", *[e.alias(c) for c, e in parsed.items()])


@query
def parse_date(t: Tables) -> DataFrame:
    return t.dated_inspections.select("permit", "inspection_date")


@query
def parse_strict(t: Tables) -> DataFrame:
    """Business start dates, all of which must parse."""
    date = times.parse_strict("location_start_date", times.parse_date("location_start_date"))
    return t.business_raw.select("account_no", date.alias("location_start_date"))


@query
def year_month(t: Tables) -> DataFrame:
    dated = t.crime_raw.select("dr_no", times.parse_timestamp("date_occ").alias("date_occ"))
    return trends.with_year_month(dated, "date_occ").drop("date_occ")


@query
def weekday_hour(t: Tables) -> DataFrame:
    day = times.weekday_name(times.parse_timestamp("date_occ"))
    return t.crime_raw.select("dr_no", day.alias("day_of_week"), times.military_hour("time_occ").alias("hour"))


@query
def fill_unidentified(t: Tables) -> DataFrame:
    return cleaning.fill_unidentified(t.crime_raw.select("dr_no", "vict_sex", "vict_descent"), "vict_sex", "vict_descent")


@query
def split_latlon(t: Tables) -> DataFrame:
    """Float32 coordinates, shown as the doubles their text denotes."""
    return jobs.text_coordinates(t.inspections).select("permit", "latitude", "longitude")


@query
def split_latlon_loose(t: Tables) -> DataFrame:
    return t.located.select("permit", "latitude", "longitude")


@query
def planar_distance(t: Tables) -> DataFrame:
    return t.crime_raw.select("dr_no", r6(geo.planar_km("lat", "lon"), "distance_km"))


@query
def distance_band(t: Tables) -> DataFrame:
    band = geo.distance_band(geo.planar_km("lat", "lon"))
    return t.crime_raw.groupBy(band.alias("distance_group")).agg(F.count(F.lit(1)).alias("n"))


@query
def haversine_km(t: Tables) -> DataFrame:
    return t.crime_raw.select("dr_no", r6(geo.haversine_km("lat", "lon"), "distance_km"))


@query
def haversine_m(t: Tables) -> DataFrame:
    """Whole metres between each inspection and the crime whose number its permit starts with."""
    near = t.located.withColumn("dr_no", F.expr("permit div 10"))
    metres = geo.haversine_m("lon", "lat", "longitude", "latitude")
    return near.join(t.crime_raw, "dr_no").select("permit", "dr_no", metres.alias("metres"))


@query
def grid_cell(t: Tables) -> DataFrame:
    return t.crime_raw.select(
        "dr_no",
        geo.cell_index("lat", 0.01).alias("cell_lat"),
        geo.cell_index("lon", 0.01).alias("cell_lon"),
        geo.cell_name("lat", "lon").alias("grid_id"),
    )


@query
def bin_hours(t: Tables) -> DataFrame:
    hour = times.military_hour("time_occ")
    return t.crime_raw.select(
        "dr_no", bins.HOURS.label(hour).alias("hour_category"), bins.HOURS.rank(hour).alias("hour_rank")
    )


@query
def bin_distance(t: Tables) -> DataFrame:
    km = geo.haversine_km("lat", "lon")
    return t.crime_raw.select(
        "dr_no", bins.DISTANCES.label(km).alias("distance_bin"), bins.DISTANCES.rank(km).alias("distance_rank")
    )


# --- joins


@query
def nearby_count(t: Tables) -> DataFrame:
    return as_int(nearby.nearby_inspections(t.crime_raw.select("dr_no", "lat", "lon"), t.located), "nearby_inspection_count").drop("lat", "lon")


@query
def nearby_count_degrees(t: Tables) -> DataFrame:
    return as_int(nearby.nearby_inspections_degrees(t.crime_raw.select("dr_no", "lat", "lon"), t.located), "nearby_inspections").drop("lat", "lon")


@query
def buffer_count(t: Tables) -> DataFrame:
    return nearby.inspections_in_buffer(t.crime_raw.select("lat", "lon"), t.located)


@query
def nearby_count_haversine(t: Tables) -> DataFrame:
    return as_int(nearby.nearby_inspections_haversine(t.crime_raw.select("dr_no", "lat", "lon"), t.located), "nearby_inspections_count").drop("lat", "lon")


@query
def nearby_count_same_cell(t: Tables) -> DataFrame:
    return as_int(nearby.same_cell_inspections(t.crime_raw.select("dr_no", "lat", "lon"), t.located), "nearby_inspections_count").drop("lat", "lon")


@query
def nearby_count_one_level(t: Tables) -> DataFrame:
    """The 500 m count with trees whose blocks are opened from eight points down."""
    rows = t.crime_raw.select("dr_no", "lat", "lon")
    counted = nearby.with_near_count(rows, t.located, nearby.COUNT_CIRCLE, "nearby_inspection_count", few=8)
    return as_int(counted, "nearby_inspection_count").drop("lat", "lon")


@query
def nearby_count_two_levels(t: Tables) -> DataFrame:
    """The great-circle count with trees down to single points."""
    rows = t.crime_raw.select("dr_no", "lat", "lon")
    counted = nearby.with_near_count(rows, t.located, nearby.HAVERSINE_CIRCLE, "nearby_inspections_count", few=1)
    return as_int(counted, "nearby_inspections_count").drop("lat", "lon")


@query
def nearby_count_hot_parts(t: Tables) -> DataFrame:
    """The count within 0.01 degrees; locations with more than 50 crimes are joined in parts."""
    rows = t.crime_raw.select("dr_no", "lat", "lon")
    counted = nearby.with_near_count(rows, t.located, nearby.DEGREE_CIRCLE, "nearby_inspections", rows_per_part=50)
    return as_int(counted, "nearby_inspections").drop("lat", "lon")


@query
def points_per_cell(t: Tables) -> DataFrame:
    """The distinct points of each grid cell."""
    return nearby.points_per_cell(t.located)


# --- aggregations and statistics


@query
def value_counts(t: Tables) -> DataFrame:
    return profile.value_counts(t.crime_raw, "premis_desc")


@query
def victim_sex_counts(t: Tables) -> DataFrame:
    return profile.value_counts(t.valid, "vict_sex")


@query
def null_profile(t: Tables) -> DataFrame:
    return profile.null_profile(t.crime_raw)


@query
def null_profile_inspections(t: Tables) -> DataFrame:
    return profile.null_profile(t.inspections)


@query
def monthly_permits(t: Tables) -> DataFrame:
    return trends.monthly_counts(t.dated_inspections.dropna(subset=["latitude_longitude"]), "inspection_date", "permit")


@query
def monthly_inspections(t: Tables) -> DataFrame:
    return trends.monthly_counts(t.inspections, "inspection_date")


@query
def monthly_crime(t: Tables) -> DataFrame:
    return trends.monthly_counts(t.crime, "date_rptd")


@query
def yearly_openings(t: Tables) -> DataFrame:
    dated = t.business_raw.select(times.parse_date("location_start_date").alias("start"))
    return trends.yearly_counts(dated, "start", OPENINGS_SINCE)


@query
def crosstab_time(t: Tables) -> DataFrame:
    """Crime type by hour category, one column per category."""
    kept = profile.keep_top_values(t.by_time, "crm_cd_desc", TOP_TYPES)
    return crosstab.wide(
        kept, "crm_cd_desc", "hour_category", bins.HOURS.labels, ("night", "morning", "afternoon", "evening")
    )


@query
def crosstab_distance(t: Tables) -> DataFrame:
    """Crime type by distance bin, one column per bin."""
    kept = profile.keep_top_values(t.by_distance, "crm_cd_desc", TOP_TYPES)
    names = ("km_0_5", "km_5_10", "km_10_15", "km_15_20", "km_20_up")
    return crosstab.wide(kept, "crm_cd_desc", "distance_bin", bins.DISTANCES.labels, names)


@query
def sex_share_by_type(t: Tables) -> DataFrame:
    """Share of each victim sex within the most frequent crime types, in order of their frequency."""
    kept = profile.keep_top_values(t.valid, "crm_cd_desc", SHARE_TYPES)
    shares = crosstab.row_share(crosstab.observed_cells(kept, "crm_cd_desc", "vict_sex"), "crm_cd_desc", "vict_sex")
    ranked = profile.ranking(t.valid, "crm_cd_desc", SHARE_TYPES)
    return profile.in_order_of(shares, ranked, "crm_cd_desc").select("rank", "crm_cd_desc", "vict_sex", r6("share"))


@query
def time_pct(t: Tables) -> DataFrame:
    cells = t.cells(t.by_time, "hour_category")
    return crosstab.row_share(cells, "crm_cd_desc", "hour_category", 100, "pct", bins.HOURS.labels).withColumn("pct", r6("pct"))


@query
def distance_pct(t: Tables) -> DataFrame:
    cells = t.cells(t.by_distance, "distance_bin")
    return crosstab.row_share(cells, "crm_cd_desc", "distance_bin", 100, "pct", bins.DISTANCES.labels).withColumn("pct", r6("pct"))


@query
def day_hour_matrix(t: Tables) -> DataFrame:
    day = times.weekday_name(times.parse_timestamp("date_occ"))
    return trends.day_hour_matrix(t.valid, day, times.military_hour("time_occ"))


def _test_result(df: DataFrame) -> DataFrame:
    return df.select(r6("statistic"), "dof", r6("p_value"), "verdict")


@query
def chi2_time(t: Tables) -> DataFrame:
    return _test_result(crosstab.chi_square(t.cells(t.by_time, "hour_category"), "crm_cd_desc", "hour_category"))


@query
def chi2_distance(t: Tables) -> DataFrame:
    return _test_result(crosstab.chi_square(t.cells(t.by_distance, "distance_bin"), "crm_cd_desc", "distance_bin"))


@query
def chi2_expected(t: Tables) -> DataFrame:
    table = crosstab.full_table(t.cells(t.by_time, "hour_category"), "crm_cd_desc", "hour_category", bins.HOURS.labels)
    return table.select("crm_cd_desc", "hour_category", "n", r6("expected"))


@query
def median_by_type(t: Tables) -> DataFrame:
    """Median number of inspections within 0.01 degrees per crime type, rising."""
    medians = quantiles(t.types_by_nearby, "nearby_inspections", {"median": 0.5}, ["crm_cd_desc"], "n")
    return medians.orderBy("median", "crm_cd_desc")


@query
def boxplot_stats(t: Tables) -> DataFrame:
    return charts.box_plot(t.types_by_nearby, "crm_cd_desc", "nearby_inspections", "n")


@query
def describe_distance(t: Tables) -> DataFrame:
    d = profile.describe(t.measured, "distance")
    return d.select("n", *[r6(c) for c in d.columns if c != "n"])


@query
def quantiles_refined(t: Tables) -> DataFrame:
    """Quantiles of the distance per area, by splitting ranges until each holds a single value."""
    levels = {"p01": 0.01, "p50": 0.5, "p99": 0.99}
    found = quantiles(t.measured, "distance", levels, ["area_name"], few=0)
    return found.select("area_name", *map(r6, levels))


@query
def corr_matrix(t: Tables) -> DataFrame:
    return profile.correlation_matrix(t.valid, CORRELATED).withColumn("correlation", r6("correlation"))


def _bars(df: DataFrame) -> DataFrame:
    return df.select("bin", r6("lower_edge"), r6("upper_edge"), "n")


@query
def age_histogram(t: Tables) -> DataFrame:
    return _bars(charts.histogram(t.valid, "vict_age"))


@query
def distance_histogram(t: Tables) -> DataFrame:
    return _bars(charts.histogram(t.measured, "distance"))


def _curve(df: DataFrame) -> DataFrame:
    return df.select("point", r6("x"), r6("density"), F.round("n_curve", 3).alias("n_curve"))


@query
def distance_kde(t: Tables) -> DataFrame:
    """Exact density curve over all crimes."""
    return _curve(charts.density(t.measured, "distance", bins=None))


@query
def distance_kde_binned(t: Tables) -> DataFrame:
    """Density curve from part sums."""
    return _curve(charts.density(t.measured, "distance"))


@query
def dashboard_monthly(t: Tables) -> DataFrame:
    return trends.dashboard_monthly(t.crime)


@query
def dashboard_monthly_filtered(t: Tables) -> DataFrame:
    return trends.dashboard_monthly(t.crime, types=[CHOSEN_TYPE], descents=[CHOSEN_DESCENT])


@query
def dashboard_descent_share(t: Tables) -> DataFrame:
    share = trends.dashboard_descent_share(t.crime)
    return share.withColumn("percentage", r6("percentage"))


@query
def dashboard_descent_share_filtered(t: Tables) -> DataFrame:
    share = trends.dashboard_descent_share(t.crime, types=[CHOSEN_TYPE])
    return share.withColumn("percentage", r6("percentage"))


@query
def dashboard_descent_share_both(t: Tables) -> DataFrame:
    """Shares under a filter on type and on descent at once."""
    share = trends.dashboard_descent_share(t.crime, types=[CHOSEN_TYPE], descents=[CHOSEN_DESCENT, "AUTOMOBILE"])
    return share.withColumn("percentage", r6("percentage"))


def _cube(t: Tables) -> DataFrame:
    """The serving table: built from the crimes up to a day, then refreshed with the later ones."""
    path, crime = fresh_path(t.spark, "cube"), t.crime
    later = F.coalesce(F.col("date_occ") >= F.lit(REFRESHED_SINCE), F.lit(False))
    serving.build(crime.where(~later), path)
    serving.refresh(crime, crime.where(later), path)
    return serving.read(t.spark, path)


@query
def dashboard_cube(t: Tables) -> DataFrame:
    return _cube(t)


@query
def dashboard_from_cube(t: Tables) -> DataFrame:
    """Shares under both filters, answered from the serving table."""
    share = serving.descent_share(_cube(t), types=[CHOSEN_TYPE], descents=[CHOSEN_DESCENT, "AUTOMOBILE"])
    return share.withColumn("percentage", r6("percentage"))


# --- top-k, sorting, sampling


@query
def top_values(t: Tables) -> DataFrame:
    return profile.top_values(t.business_raw, "primary_naics_description", 15)


@query
def top_victim_descents(t: Tables) -> DataFrame:
    return profile.top_values(t.valid, "vict_descent", 3)


@query
def top_inspection_results(t: Tables) -> DataFrame:
    return profile.top_values(t.located, "inspection_result", 10)


@query
def nlargest(t: Tables) -> DataFrame:
    largest = profile.nlargest(t.measured.withColumn("distance", r6("distance")), "distance", 10, "dr_no")
    return largest.select("dr_no", "crm_cd_desc", "distance")


@query
def nlargest_nearby(t: Tables) -> DataFrame:
    """The crimes with most inspections within 0.01 degrees."""
    near = nearby.nearby_inspections_degrees(t.valid.select("dr_no", "crm_cd_desc", "lat", "lon"), t.located)
    largest = profile.nlargest(near, "nearby_inspections", 10, "dr_no")
    return as_int(largest, "nearby_inspections").select("dr_no", "crm_cd_desc", "nearby_inspections")


@query
def crime_by_area(t: Tables) -> DataFrame:
    return profile.value_counts(t.valid, "area_name", "number_of_crimes")


@query
def sample_n(t: Tables) -> DataFrame:
    return profile.sample_n(t.valid, SAMPLE_ROWS, "dr_no").select("dr_no", "crm_cd_desc", "lat", "lon")


@query
def sample_all(t: Tables) -> DataFrame:
    """A sample larger than the table is the table."""
    return profile.sample_n(t.business_raw, (1 << 31) - 1, "account_no").select("account_no")


# --- jobs


@query
def clean_crime(t: Tables) -> DataFrame:
    return t.crime


@query
def clean_inspections(t: Tables) -> DataFrame:
    return jobs.text_coordinates(t.inspections)


@query
def enrich_crime(t: Tables) -> DataFrame:
    enriched, _ = jobs.clean_and_enrich(t.crime_raw, t.inspection_raw)
    return as_int(enriched, "nearby_inspection_count").withColumn("distance_km", r6("distance_km"))


@query
def band_summary(t: Tables) -> DataFrame:
    """The full job, summed up per distance band."""
    enriched, _ = jobs.clean_and_enrich(t.crime_raw, t.inspection_raw)
    return jobs.band_summary(enriched).withColumn("avg_nearby", r6("avg_nearby"))


@query
def select_and_year_month(t: Tables) -> DataFrame:
    return jobs.selected_crime(t.crime_raw)


@query
def select_and_year_month_inspections(t: Tables) -> DataFrame:
    return jobs.selected_inspections(t.inspection_raw)
