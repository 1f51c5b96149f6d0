import datetime as dt
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from cityweave.operators import cleaning, trends
from cityweave.operators.skew import join_per_key
from cityweave.plans import jobs
from cityweave.sources import datasets, layout, scratch, tables
from cityweave.sources.derived import raw_tables


def write(path, text):
    path.write_text(text)
    return str(path)


def test_csv_is_matched_by_header_in_any_order_and_case(spark, tmp_path):
    text = (
        'Extra,lat,LON,Crm Cd 1,DR_NO,Date Rptd,DATE OCC,TIME OCC,AREA NAME,Crm Cd Desc,Vict Age,Vict Sex,Vict Descent,Premis Desc\n'
        '1,34.5,-118.5,510,7,03/01/2020 12:00:00 AM,03/01/2020 12:00:00 AM,0005,Wilshire,"THEFT, ""PETTY""",0,M,,STREET\n'
        '2,bad,,x,8,,,2130,,,,,,\n'
    )
    df = datasets.read_csv(spark, write(tmp_path / "crime.csv", text), datasets.CRIME)
    assert df.columns == [f.name for f in datasets.CRIME.fields]
    first, second = df.orderBy("dr_no").collect()
    assert (first.dr_no, first.time_occ, first.crm_cd_desc, first.lat, first.vict_descent) == (7, 5, 'THEFT, "PETTY"', 34.5, None)
    assert (second.lat, second.lon, second.crm_cd_1, second.time_occ) == (None, None, None, 2130)


def test_missing_csv_columns_are_named(spark, tmp_path):
    with pytest.raises(ValueError, match="Inspection Date"):
        datasets.read_csv(spark, write(tmp_path / "i.csv", "PERMIT,Permit Status\n1,x\n"), datasets.INSPECTION)


def test_code_list_is_renamed_and_keeps_leading_zeros(spark, tmp_path):
    codes = datasets.read_csv(spark, write(tmp_path / "mo.csv", "Mocode,Text\n0100,a\n1402,b\n"), datasets.MO_CODES)
    assert codes.columns == ["mocodes"] and [r.mocodes for r in codes.orderBy("mocodes").collect()] == ["0100", "1402"]


def parts(path):
    return [f for f in os.listdir(path) if f.startswith("part-") and f.endswith(".csv")]


def test_csv_sink_round_trip(spark, tmp_path):
    df = spark.range(100).select("id", F.lit('a "b", c').alias("t")).repartition(4)
    path = str(tmp_path / "out")
    tables.write_csv(df, path, {"t": "The Text"})
    assert len(parts(path)) == 4
    back = spark.read.option("header", True).option("escape", '"').csv(path)
    assert back.columns == ["id", "The Text"] and back.count() == 100 and back.first()[1] == 'a "b", c'


def test_saved_tables(spark, tmp_path):
    a, b = spark.range(3), spark.range(5)
    path = str(tmp_path / "saved")
    assert tables.create_table_if_absent(a, "saved_numbers", path).count() == 3
    assert tables.create_table_if_absent(b, "saved_numbers", path).count() == 3
    assert "saved_numbers" in tables.list_tables(spark)
    assert tables.replace_table(b, "saved_numbers", path).count() == 5
    spark.sql("drop table saved_numbers")


def test_columns_and_shape(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "k int, LAT string")
    assert tables.add_column_if_missing(df, "lat", "double", 0.0).columns == ["k", "LAT"]
    added = tables.add_column_if_missing(df, "n", "int", 0)
    assert added.schema["n"].dataType.simpleString() == "int" and added.first().n == 0
    updated = tables.update_columns(df, {"LAT": F.lit("z")}, F.col("k") == 2)
    assert [r.LAT for r in updated.orderBy("k").collect()] == ["a", "z"]
    assert [tuple(r) for r in tables.describe_columns(df).collect()] == [(1, "k", "int"), (2, "LAT", "string")]
    assert tuple(tables.row_count(df).first()) == (2, 2)
    assert [r.k for r in tables.preview(df, "k", 1).collect()] == [1]


class Settings(dict):
    """Stands in for a session of which only the settings are asked."""

    conf = property(lambda self: self)


def test_shared_folder_comes_from_the_session():
    assert scratch.shared_folder(Settings({scratch.SETTING: "hdfs://x/y/"})) == "hdfs://x/y"
    with pytest.raises(RuntimeError, match=scratch.SETTING):
        scratch.shared_folder(Settings({"spark.master": "yarn"}))
    local = Settings({"spark.master": "local[2]", "spark.app.id": "test-app"})
    assert scratch.shared_folder(local) == scratch.shared_folder(local)


def test_durable_tables_lie_in_the_shared_folder(spark):
    kept = scratch.durable(spark.range(4).withColumn("x", F.lit("a")), "numbers")
    assert kept.count() == 4 and kept.columns == ["id", "x"]
    assert all(scratch.shared_folder(spark) in f for f in kept.inputFiles())


def test_join_per_key_keeps_every_row_once(spark):
    rows = spark.range(5000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, None).when(F.col("id") % 3 == 1, 7).otherwise(F.col("id")).alias("k")
    )
    per_key = rows.where("k is not null").groupBy("k").agg(F.count("*").alias("n"), (F.max("k") * 10).alias("v"))
    joined = join_per_key(rows, per_key, ["k"], "n", rows_per_part=50)
    got = joined.agg(F.count("*"), F.count_distinct("id"), F.count_if(F.expr("v = k * 10")), F.count_if(F.expr("k is null and v is null"))).first()
    assert tuple(got) == (5000, 5000, 3333, 1667)


RAW_CRIME = "dr_no long, date_rptd string, date_occ string, crm_cd_1 int, time_occ int, vict_sex string, vict_descent string, premis_desc string, lat double, lon double"


def test_full_job(spark, tmp_path):
    stamp = "03/01/2020 09:30:00 PM"
    crime = spark.createDataFrame(
        [
            (1, stamp, stamp, 510, 2130, None, "H", "STREET", 34.0522, -118.2437),
            (2, "unknown", "unknown", 510, 5, "M", None, "STREET", None, None),
            (3, stamp, stamp, None, 5, "M", "H", "STREET", 34.0, -118.0),
            (4, stamp, stamp, 510, 5, "M", "H", None, 34.0, -118.0),
        ],
        RAW_CRIME,
    )
    inspections = spark.createDataFrame(
        [("p1", "01/05/2020", "(34.0522, -118.2437)"), ("p2", "n/a", "(34.0530, -118.2437)"), ("p3", "01/05/2020", None), ("p4", "01/05/2020", "(34, -118)")],
        "permit string, inspection_date string, latitude_longitude string",
    )
    enriched, cleaned = jobs.clean_and_enrich(crime, inspections)
    one, two = enriched.orderBy("dr_no").collect()
    assert (one.dr_no, one.time_occ, one.day_of_week_occ, one.vict_sex) == (1, 21, "Sunday", "Unidentified")
    assert (one.distance_km, one.distance_group, one.nearby_inspection_count) == (0.0, "0-10km", 2)
    assert (two.dr_no, two.date_occ, two.day_of_week_occ, two.vict_descent) == (2, None, None, "Unidentified")
    assert (two.distance_km, two.distance_group, two.nearby_inspection_count) == (None, ">20km", 0)
    rows = {r.permit: r for r in cleaned.collect()}
    assert set(rows) == {"p1", "p2", "p4"} and "latitude_longitude" not in cleaned.columns
    assert (rows["p1"].year, rows["p1"].month, rows["p2"].year, rows["p4"].latitude) == (2020, 1, None, None)
    assert dict(cleaned.dtypes)["latitude"] == "float"
    for kind in ("csv", "parquet"):
        jobs.export(enriched, cleaned, str(tmp_path / kind), kind)
        jobs.export(enriched, cleaned, str(tmp_path / kind), kind)
        assert (spark.read.option("header", True).csv if kind == "csv" else spark.read.parquet)(str(tmp_path / kind / "crime_final")).count() == 2


def test_day_hour_matrix_has_all_days_and_null_cells(spark):
    df = spark.createDataFrame([("Monday", 0), ("Monday", 0), ("Sunday", 23), (None, 5), ("Monday", 24), ("Monday", None)], "d string, h int")
    rows = trends.day_hour_matrix(df, F.col("d"), F.col("h")).collect()
    assert [r.day_of_week for r in rows][:2] == ["Monday", "Tuesday"] and len(rows) == 7
    assert (rows[0].h00, rows[0].h23, rows[6].h23, rows[1].h00) == (2, None, 1, None)
    assert (rows[0].not_listed, rows[6].not_listed) == (2, None)


def test_dashboard_filters_combine(spark):
    day = dt.datetime(2020, 3, 5)
    df = spark.createDataFrame(
        [(day, "a", "H"), (day, "a", "W"), (day, "b", "H"), (None, "a", "H")], "date_occ timestamp_ntz, crm_cd_desc string, vict_descent string"
    )
    both = trends.dashboard_monthly(df, types=["a"], descents=["H"]).collect()
    assert [(r.year, r.month, r.month_date, r.n) for r in both] == [(2020, 3, dt.date(2020, 3, 1), 1)]
    share = {r.vict_descent: r.percentage for r in trends.dashboard_descent_share(df, types=["a"]).collect()}
    assert share == {"H": pytest.approx(200 / 3), "W": pytest.approx(100 / 3)}


def test_required_fields_and_fill(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (3, None)], "x int, s string")
    assert cleaning.require_fields(df, "x", "s").count() == 1
    assert [r.s for r in cleaning.fill_unidentified(df, "s").orderBy(F.col("x").asc_nulls_first()).collect()] == ["b", "a", "Unidentified"]


def test_derived_tables_have_the_rows_that_rules_are_about(spark, small):
    raw = raw_tables(spark, small)
    crime = raw["crime"]
    facts = crime.selectExpr(
        "count(distinct crm_cd_desc) as types", "count_if(date_occ = 'unknown') as undated", "count_if(time_occ = 2400) as midnight"
    ).first()
    assert facts.types >= 40 and facts.undated and facts.midnight
    assert crime.groupBy("lat", "lon").count().where("lat > 0").agg({"count": "max"}).first()[0] > 100
    assert raw["inspection"].select("inspection_result").distinct().count() >= 20
    assert raw["business"].select("primary_naics_description").distinct().count() >= 20


def test_box_reads_few_row_groups(spark, tmp_path):
    """Under 5 % of the row groups can meet a box, by their statistics; the rows are those of a plain filter."""
    path, box = str(tmp_path / "by-place"), (34.04, 34.06, -118.26, -118.23)
    points = spark.range(120_000).select(
        "id", (33.7 + F.rand(1) * 0.7).alias("latitude"), (-118.7 + F.rand(2) * 0.9).alias("longitude")
    )
    odd = spark.createDataFrame([(-1, None, 1.0), (-2, float("nan"), 1.0), (-3, 200.0, -999.0)], "id long, latitude double, longitude double")
    points = points.unionByName(odd).cache()
    layout.write_by_place(points, path, rows_per_file=10_000, rows_per_group=500)
    met = groups = 0
    for file in (f for f in os.listdir(path) if f.endswith(".parquet")):
        footer = pq.read_metadata(f"{path}/{file}")
        names = [footer.schema.column(i).name for i in range(footer.num_columns)]
        for g in range(footer.num_row_groups):
            lat, lon = (footer.row_group(g).column(names.index(c)).statistics for c in ("latitude", "longitude"))
            groups += 1
            if lat is None or not lat.has_min_max:
                met += 1
            else:
                met += lat.max >= box[0] and lat.min <= box[1] and lon.max >= box[2] and lon.min <= box[3]
    assert groups > 100 and met < 0.05 * groups
    written = spark.read.parquet(path)
    assert written.count() == points.count()
    found = layout.in_box(written, *box)
    assert sorted(r.id for r in found.collect()) == sorted(r.id for r in layout.in_box(points, *box).collect()) != []
    assert "PushedFilters: [IsNotNull(latitude)" in found._jdf.queryExecution().executedPlan().toString()


def test_place_key_alternates_bits(spark):
    rows = [(-90.0, -180.0), (90.0, 180.0), (-90.0, 180.0), (0.0, 0.0), (None, 1.0), (float("nan"), 1.0), (12.5, -77.25)]
    df = spark.createDataFrame(rows, "latitude double, longitude double")

    def plain(lat, lon):
        if lat is None or lat != lat:
            return None
        y, x = (min(int((v + h) / (2 * h) * 2**31), 2**31 - 1) for v, h in ((lat, 90.0), (lon, 180.0)))
        return sum(((y >> b & 1) << 2 * b + 1) | ((x >> b & 1) << 2 * b) for b in range(31))

    assert [r.k for r in df.select(layout.place_key().alias("k")).collect()] == [plain(*r) for r in rows]


def test_layout_works_its_input_out_once(spark, tmp_path):
    """And files are as small as asked, written by few tasks."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def looked_at(x):
        seen.add(1)
        return x

    df = spark.range(4000).select("id", looked_at(F.rand(1) + 34).alias("latitude"), (F.rand(2) - 118).alias("longitude"))
    path = str(tmp_path / "by-place")
    layout.write_by_place(df, path, rows_per_file=100, rows_per_group=20)
    files = [pq.read_metadata(f"{path}/{f}") for f in os.listdir(path) if f.endswith(".parquet")]
    assert sum(f.num_rows for f in files) == 4000 == seen.value and max(f.num_rows for f in files) <= 100
    assert len({f.split("-")[1] for f in os.listdir(path) if f.endswith(".parquet")}) <= 4
