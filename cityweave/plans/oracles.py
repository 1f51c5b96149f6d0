"""DuckDB SQL with the same result as each registered query, over the whole benchmark tables.

Each statement starts from named parts, which are put in front of it as common table expressions. Distance
joins are limited to neighbouring latitude bands; the pairs are then tested with the plain predicate.
"""

from __future__ import annotations

import re

from cityweave.functions.times import DAYS
from cityweave.operators.charts import CURVE_PARTS
from cityweave.plans import queries as q
from cityweave.sources.derived import duckdb_views

CENTRE_LAT, CENTRE_LON = "34.0522e0", "(-118.2437e0)"


def _timestamp(c: str) -> str:
    form = r"\d{2}/\d{2}/\d{4} \d{2}:\d{2}:\d{2} [AP]M"
    return f"case when regexp_full_match({c}, '{form}') then try_strptime({c}, '%m/%d/%Y %I:%M:%S %p') end"


def _date(c: str) -> str:
    return f"case when regexp_full_match({c}, '\\d{{2}}/\\d{{2}}/\\d{{4}}') then try_strptime({c}, '%m/%d/%Y') end"


def _planar(lat: str, lon: str) -> str:
    return f"sqrt(pow(({lat} - {CENTRE_LAT}) * 111, 2) + pow(({lon} - {CENTRE_LON}) * 92, 2))"


def _angle(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return (
        f"2 * asin(sqrt(pow(sin((radians({lat2}) - radians({lat1})) / 2), 2) + cos(radians({lat1})) "
        f"* cos(radians({lat2})) * pow(sin((radians({lon2}) - radians({lon1})) / 2), 2)))"
    )


_KM = f"{_angle('lat', 'lon', CENTRE_LAT, CENTRE_LON)} * 6371"
_HOUR = "(time_occ // 100)"
_BAND = "case when {d} <= 10 then '0-10km' when {d} <= 20 then '10-20km' else '>20km' end"
_HOUR_BIN = (
    f"case when {_HOUR} > 0 and {_HOUR} <= 6 then 'Night (0-6)' when {_HOUR} > 6 and {_HOUR} <= 12 then 'Morning (6-12)' "
    f"when {_HOUR} > 12 and {_HOUR} <= 18 then 'Afternoon (12-18)' when {_HOUR} > 18 and {_HOUR} <= 24 then 'Evening (18-24)' end"
)
_DISTANCE_BIN = (
    "case when {d} > 0 and {d} <= 5 then '0-5 km' when {d} > 5 and {d} <= 10 then '5-10 km' "
    "when {d} > 10 and {d} <= 15 then '10-15 km' when {d} > 15 and {d} <= 20 then '15-20 km' when {d} > 20 then '20+ km' end"
)
_BOX_CIRCLE = (
    "latitude between lat - 5e-3 and lat + 5e-3 and longitude between lon - 5e-3 and lon + 5e-3 "
    "and pow((latitude - lat) * 111000, 2) + pow((longitude - lon) * 92000, 2) < 250000"
)
_GREAT_CIRCLE = f"{_angle('lat', 'lon', 'latitude', 'longitude')} * 6371000 <= 500"


def _hits(points: str, predicate: str) -> str:
    """Number of points near each distinct crime location that has any."""
    return f"""
        select lat, lon, count(*) as hits
        from (select lat, lon, cast(floor(lat / 0.011e0) as bigint) + unnest([-1, 0, 1]) as band
              from (select distinct lat, lon from crime_raw where lat is not null and lon is not null)) as probe
        join (select latitude, longitude, cast(floor(latitude / 0.011e0) as bigint) as band
              from {points} where latitude is not null and longitude is not null) as point using (band)
        where {predicate} group by lat, lon"""


def _near(points: str, predicate: str, column: str) -> str:
    return (
        f"with near as ({_hits(points, predicate)}) "
        f"select dr_no, cast(coalesce(hits, 0) as integer) as {column} from crime_raw left join near using (lat, lon)"
    )


def _top(table: str, column: str, k: int) -> str:
    return (
        f"select {column}, count(*) as n from {table} where {column} is not null "
        f"group by {column} order by n desc, {column} limit {k}"
    )


def _counts(table: str, column: str, name: str = "n") -> str:
    return f"select {column}, count(*) as {name} from {table} where {column} is not null group by {column}"


def _monthly(table: str, date: str, count: str = "count(*)") -> str:
    return (
        f"select cast(year({date}) as integer) as year, cast(month({date}) as integer) as month, {count} as n, "
        f"make_date(year({date}), month({date}), 1) as month_date from {table} where {date} is not null "
        "group by all"
    )


def _grid(labelled: str, label: str) -> str:
    """All combinations of observed types and labels with n, totals and expected count."""
    return f"""
        cells as (select crm_cd_desc, {label} as label, count(*) as n from {labelled}
                  where {label} is not null and crm_cd_desc in (select crm_cd_desc from top_types) group by all),
        types as (select crm_cd_desc, sum(n) as row_total from cells group by all),
        labels as (select label, sum(n) as column_total from cells group by all),
        grid as (select crm_cd_desc, label, coalesce(n, 0) as n, row_total, column_total,
                        row_total * column_total / cast((select sum(n) from cells) as double) as expected
                 from types cross join labels left join cells using (crm_cd_desc, label))"""


def _percent(labelled: str, label: str) -> str:
    return (
        f"with {_grid(labelled, label)} select crm_cd_desc, label as {label}, cast(n as bigint) as n, "
        "round(n / cast(row_total as double) * 100, 6) as pct from grid"
    )


def _chi_square(labelled: str, label: str) -> str:
    # For an even number of degrees of freedom the tail is a finite sum of Poisson terms.
    return f"""
        with {_grid(labelled, label)},
        found as (select sum(pow(n - expected, 2) / expected) as statistic,
                         cast((count(distinct crm_cd_desc) - 1) * (count(distinct label) - 1) as integer) as dof from grid),
        tested as (select statistic, dof, list_sum(list_transform(range(0, dof // 2),
                          lambda i: exp(i * ln(statistic / 2) - lgamma(i + 1) - statistic / 2))) as p_value from found)
        select round(statistic, 6) as statistic, dof, round(p_value, 6) as p_value,
               case when p_value < 5e-2 then 'significant' else 'not significant' end as verdict from tested"""


def _wide(labelled: str, label: str, columns: dict[str, str]) -> str:
    cells = ", ".join(f"count(*) filter (where {label} = '{value}') as {name}" for name, value in columns.items())
    listed = ", ".join(f"'{value}'" for value in columns.values())
    cells += f", count(*) filter (where {label} not in ({listed})) as not_listed"
    return (
        f"select crm_cd_desc, {cells} from {labelled} where {label} is not null "
        "and crm_cd_desc in (select crm_cd_desc from top_types) group by crm_cd_desc"
    )


def _histogram(table: str, value: str) -> str:
    return f"""
        with v as (select cast({value} as double) as v from {table} where {value} is not null),
        ends as (select min(v) as low, (max(v) - min(v)) / 30 as width, max(v) as high from v),
        edges as (select cast(i as integer) as bin, low + (i - 1) * width as lower_edge,
                         case when i = 30 then high else low + i * width end as upper_edge
                  from ends, range(1, 31) as r(i))
        select bin, round(lower_edge, 6) as lower_edge, round(upper_edge, 6) as upper_edge,
               count(v) filter (where v >= lower_edge and (v < upper_edge or bin = 30)) as n
        from edges, v group by all"""


def _density(parts: str, kernel: str) -> str:
    return f"""
        with v as (select distance as v from measured where distance is not null),
        facts as (select count(*) as n, min(v) as low, max(v) as high,
                         stddev_samp(v) * pow(count(*), -0.2e0) as h from v),
        parts as ({parts}),
        grid as (select cast(i as integer) as point, low + i * ((high - low) / 199) as x, n, low, high, h
                 from facts, range(0, 200) as r(i)),
        curve as (select point, x, n, low, high, sum({kernel}) / (n * h * sqrt(2 * pi())) as density
                  from grid, parts group by point, x, n, low, high, h)
        select point, round(x, 6) as x, round(density, 6) as density,
               round(density * n * (high - low) / 30, 3) as n_curve from curve"""


def _nulls(table: str, columns: list[str]) -> str:
    return " union all ".join(
        f"select {i} as position, '{c}' as column_name, count(*) filter (where {c} is null) as n_null from {table}"
        for i, c in enumerate(columns, 1)
    )


_CRIME = "dr_no date_rptd date_occ crm_cd_1 time_occ area_name crm_cd_desc vict_age vict_sex vict_descent premis_desc lat lon"
_CRIME_TYPES = {"dr_no": "bigint", **dict.fromkeys(("crm_cd_1", "time_occ", "vict_age"), "int"), "lat": "double", "lon": "double"}
_INSPECTION = "permit permit_status inspection_type inspection_result inspection_date latitude longitude year month"

PARTS = {
    **duckdb_views(),
    "valid": "select * from crime_raw where premis_desc is not null and crm_cd_1 is not null",
    "crime": f"""
        select * replace ({_timestamp('date_rptd')} as date_rptd, {_timestamp('date_occ')} as date_occ,
                          {_HOUR} as time_occ, coalesce(vict_sex, 'Unidentified') as vict_sex,
                          coalesce(vict_descent, 'Unidentified') as vict_descent),
               dayname({_timestamp('date_occ')}) as day_of_week_occ
        from valid""",
    "float_inspections": rf"""
        select permit, permit_status, inspection_type, inspection_result, {_date('inspection_date')} as inspection_date,
               try_cast(regexp_extract(latitude_longitude, '\((-?\d+\.\d+),', 1) as float) as latitude,
               try_cast(regexp_extract(latitude_longitude, ', (-?\d+\.\d+)\)', 1) as float) as longitude
        from inspection_raw where latitude_longitude is not null""",
    # A float32 half-way between two texts of six places is printed with seven here; use the even one of six.
    "inspections": """
        select * replace (cast(case when length(cast(latitude as varchar)) > 9
                                     and cast(printf('%.6f', latitude) as float) = latitude
                                    then printf('%.6f', latitude) else cast(latitude as varchar) end as double) as latitude,
                          cast(cast(longitude as varchar) as double) as longitude),
               cast(year(inspection_date) as integer) as year, cast(month(inspection_date) as integer) as month
        from float_inspections""",
    "located": r"""
        select permit, permit_status, inspection_type, inspection_result, inspection_date,
               try_cast(regexp_extract(latitude_longitude, '\(([^,]+), ([^)]+)\)', 1) as double) as latitude,
               try_cast(regexp_extract(latitude_longitude, '\(([^,]+), ([^)]+)\)', 2) as double) as longitude
        from inspection_raw where latitude_longitude is not null""",
    "measured": f"select *, {_KM} as distance from valid",
    "by_time": f"select *, {_HOUR_BIN} as hour_category from valid",
    "by_distance": f"select *, {_DISTANCE_BIN.format(d='distance')} as distance_bin from measured",
    "top_types": _top("valid", "crm_cd_desc", q.TOP_TYPES),
    "degree_hits": _hits("located", "pow(latitude - lat, 2) + pow(longitude - lon, 2) <= 1e-2 * 1e-2"),
    "types_by_nearby": f"""
        select crm_cd_desc, coalesce(hits, 0) as nearby_inspections from valid left join degree_hits using (lat, lon)
        where crm_cd_desc in (select crm_cd_desc from ({_top('valid', 'crm_cd_desc', q.TABLE_TYPES)}))""",
    "enriched": f"""
        select crime.*, {_planar('lat', 'lon')} as distance_km, {_BAND.format(d=_planar('lat', 'lon'))} as distance_group,
               cast(coalesce(hits, 0) as integer) as nearby_inspection_count
        from crime left join ({_hits('inspections', _BOX_CIRCLE)}) as near using (lat, lon)""",
}

_QUERIES = {
    "scan_csv": "select * from crime_raw",
    "scan_csv_inspections": "select * replace (cast(permit as varchar) as permit) from inspection_raw",
    "scan_csv_business": "select * replace (cast(account_no as varchar) as account_no) from business_raw",
    "describe_columns": "select cast(i as integer) as position, name as column_name, type as column_type from (values "
    + ", ".join(f"({i}, '{c}', '{_CRIME_TYPES.get(c, 'string')}')" for i, c in enumerate(_CRIME.split(), 1))
    + ") as c(i, name, type) where exists (select 1 from crime_raw)",
    "list_tables": """select label, (select count(distinct area_name) from valid) as n_areas
        from (values ('a'), ('b')) as t(label)""",
    "box_on_layout": """select inspection_type, count(*) as n from located
        where latitude between {} and {} and longitude between {} and {} group by inspection_type""".format(*q.BOX),
    "export_job": """select area_name as label, count(*) as n_rows, cast(sum(nearby_inspection_count) as bigint) as n_nearby
        from enriched group by 1 union all select permit_status, count(*), 0 from inspections group by 1""",
    "ctas_if_absent": _counts("valid", "area_name"),
    "replace_table": _counts("valid", "area_name"),
    "publish_table": _counts("valid", "area_name"),
    "update_saved": """select area_name, count(*) as n,
        cast(count(*) filter (where area_name like '%A' or vict_age < 2) as bigint) as n_checked from valid group by area_name""",
    "sink_csv": f"select {_INSPECTION.replace(' ', ', ')} from inspections",
    "sink_parquet": "select dr_no, area_name, date_occ, time_occ, vict_sex from crime",
    "sql_view": "select area_name, count(*) as n, min(vict_age) as youngest, max(vict_age) as oldest from valid group by area_name",
    "add_column_if_missing": """select dr_no, lat, cast(null as varchar) as downtown_distance,
        cast(0 as integer) as nearby_inspection_count from crime_raw""",
    "update_column": f"""select dr_no, case when lat is null then 'unknown' else {_BAND.format(d=_planar('lat', 'lon'))} end
        as downtown_distance from crime_raw""",
    "row_count": "select count(*) as n_rows, 13 as n_columns from crime_raw",
    "preview": "select * from crime_raw order by dr_no limit 5",
    "project_columns": "select date_occ, area_name, crm_cd_desc, vict_age, vict_sex, vict_descent from crime_raw",
    "rename_columns": """select dr_no, time_occ as time_of_day, vict_age as victim_age, lat as latitude, lon as longitude
        from valid""",
    "require_fields": "select dr_no, premis_desc, crm_cd_1 from valid",
    "filter_top_types": f"""select dr_no, crm_cd_desc from valid
        where crm_cd_desc in (select crm_cd_desc from ({_top('valid', 'crm_cd_desc', q.KEPT_TYPES)}))""",
    "frequent_values": f"{_counts('located', 'permit_status')} having count(*) >= (select count(*) from located) * {q.STATUS_SHARE}::double",
    "frequent_inspection_types": f"{_counts('located', 'inspection_type')} having count(*) >= (select count(*) from located) * {q.INSPECTION_TYPE_SHARE}::double",
    "frequent_crime_types": f"{_counts('valid', 'crm_cd_desc')} having count(*) >= (select count(*) from valid) * {q.CRIME_TYPE_SHARE}::double",
    "parse_timestamp": f"select dr_no, {_timestamp('date_rptd')} as date_rptd, {_timestamp('date_occ')} as date_occ from crime_raw",
    "parse_date": f"select permit, {_date('inspection_date')} as inspection_date from inspection_raw",
    "parse_strict": """select account_no, strptime(location_start_date, '%m/%d/%Y') as location_start_date
        from business_raw""",
    "year_month": f"""select dr_no, cast(year({_timestamp('date_occ')}) as integer) as year,
        cast(month({_timestamp('date_occ')}) as integer) as month from crime_raw""",
    "weekday_hour": f"select dr_no, dayname({_timestamp('date_occ')}) as day_of_week, {_HOUR} as hour from crime_raw",
    "fill_unidentified": """select dr_no, coalesce(vict_sex, 'Unidentified') as vict_sex,
        coalesce(vict_descent, 'Unidentified') as vict_descent from crime_raw""",
    "split_latlon": "select permit, latitude, longitude from inspections",
    "split_latlon_loose": "select permit, latitude, longitude from located",
    "planar_distance": f"select dr_no, round({_planar('lat', 'lon')}, 6) as distance_km from crime_raw",
    "distance_band": f"select {_BAND.format(d=_planar('lat', 'lon'))} as distance_group, count(*) as n from crime_raw group by 1",
    "haversine_km": f"select dr_no, round({_KM}, 6) as distance_km from crime_raw",
    "haversine_m": f"""select permit, dr_no, cast(trunc({_angle('lat', 'lon', 'latitude', 'longitude')} * 6371000) as integer)
        as metres from located join crime_raw on permit // 10 = dr_no""",
    "grid_cell": """select dr_no, cast(floor(lat / 0.01e0) as bigint) as cell_lat, cast(floor(lon / 0.01e0) as bigint) as cell_lon,
        cast(cast(trunc(lat / 0.01e0) as bigint) as varchar) || ',' || cast(cast(trunc(lon / 0.01e0) as bigint) as varchar)
        as grid_id from crime_raw""",
    "bin_hours": f"""select dr_no, {_HOUR_BIN} as hour_category,
        case when {_HOUR} between 1 and 24 then cast(ceil({_HOUR} / 6e0) as integer) end as hour_rank from crime_raw""",
    "bin_distance": f"""select dr_no, {_DISTANCE_BIN.format(d='km')} as distance_bin,
        case when km > 0 then cast(least(ceil(km / 5), 5) as integer) end as distance_rank
        from (select dr_no, {_KM} as km from crime_raw)""",
    "nearby_count": _near("located", _BOX_CIRCLE, "nearby_inspection_count"),
    "nearby_count_degrees": """select dr_no, cast(coalesce(hits, 0) as integer) as nearby_inspections
        from crime_raw left join degree_hits using (lat, lon)""",
    "buffer_count": f"""
        with near as ({_hits('located', 'pow((latitude - lat) * 111000, 2) + pow((longitude - lon) * 92000, 2) <= 40000')}),
        places as (select lon, lat, count(*) as n from crime_raw group by lon, lat)
        select lon, lat, coalesce(n * hits, 0) as inspection_count from places left join near using (lat, lon)""",
    "nearby_count_one_level": _near("located", _BOX_CIRCLE, "nearby_inspection_count"),
    "nearby_count_two_levels": _near("located", _GREAT_CIRCLE, "nearby_inspections_count"),
    "nearby_count_hot_parts": """select dr_no, cast(coalesce(hits, 0) as integer) as nearby_inspections
        from crime_raw left join degree_hits using (lat, lon)""",
    "nearby_count_haversine": _near("located", _GREAT_CIRCLE, "nearby_inspections_count"),
    "nearby_count_same_cell": _near(
        "located",
        "trunc(lat / 0.01e0) = trunc(latitude / 0.01e0) and trunc(lon / 0.01e0) = trunc(longitude / 0.01e0) "
        f"and {_GREAT_CIRCLE}",
        "nearby_inspections_count",
    ),
    "points_per_cell": """select cast(floor(latitude / 0.01e0) as bigint) as cell_lat,
        cast(floor(longitude / 0.01e0) as bigint) as cell_lon, longitude, latitude, count(*) as weight
        from located where latitude is not null and longitude is not null group by all""",
    "value_counts": _counts("crime_raw", "premis_desc"),
    "victim_sex_counts": _counts("valid", "vict_sex"),
    "null_profile": _nulls("crime_raw", _CRIME.split()),
    "null_profile_inspections": _nulls("inspections", _INSPECTION.split()),
    "monthly_permits": _monthly(
        f"(select permit, {_date('inspection_date')} as d from inspection_raw where latitude_longitude is not null)",
        "d",
        "count(permit)",
    ),
    "monthly_inspections": _monthly("inspections", "inspection_date"),
    "monthly_crime": _monthly("crime", "date_rptd"),
    "yearly_openings": f"""select cast(year(d) as integer) as year, count(*) as n
        from (select {_date('location_start_date')} as d from business_raw) where year(d) >= {q.OPENINGS_SINCE} group by 1""",
    "crosstab_time": _wide(
        "by_time",
        "hour_category",
        {"night": "Night (0-6)", "morning": "Morning (6-12)", "afternoon": "Afternoon (12-18)", "evening": "Evening (18-24)"},
    ),
    "crosstab_distance": _wide(
        "by_distance",
        "distance_bin",
        {
            "km_0_5": "0-5 km",
            "km_5_10": "5-10 km",
            "km_10_15": "10-15 km",
            "km_15_20": "15-20 km",
            "km_20_up": "20+ km",
        },
    ),
    "sex_share_by_type": f"""
        with top as (select crm_cd_desc, row_number() over (order by n desc, crm_cd_desc) as rank
                     from ({_top('valid', 'crm_cd_desc', q.SHARE_TYPES)})),
        known as (select crm_cd_desc, vict_sex from valid where crm_cd_desc is not null and vict_sex is not null),
        sexes as (select distinct vict_sex from known)
        select cast(rank as integer) as rank, crm_cd_desc, sexes.vict_sex,
               round(count(*) filter (where known.vict_sex = sexes.vict_sex) / cast(count(*) as double), 6) as share
        from top join known using (crm_cd_desc) cross join sexes group by all""",
    "time_pct": _percent("by_time", "hour_category"),
    "distance_pct": _percent("by_distance", "distance_bin"),
    "day_hour_matrix": "with days(day_rank, day_of_week) as (values "
    + ", ".join(f"({i}, '{d}')" for i, d in enumerate(DAYS, 1))
    + "), occurred as (select day_of_week_occ as day_of_week, time_occ as hour, 1 as one from crime where day_of_week_occ is not null) "
    + "select cast(day_rank as integer) as day_rank, days.day_of_week, "
    + ", ".join(f"nullif(count(*) filter (where hour = {h}), 0) as h{h:02d}" for h in range(24))
    + ", nullif(count(*) filter (where one = 1 and (hour is null or hour not between 0 and 23)), 0) as not_listed"
    + " from days left join occurred using (day_of_week) group by 1, 2",
    "chi2_time": _chi_square("by_time", "hour_category"),
    "chi2_distance": _chi_square("by_distance", "distance_bin"),
    "chi2_expected": f"""with {_grid('by_time', 'hour_category')}
        select crm_cd_desc, label as hour_category, cast(n as bigint) as n, round(expected, 6) as expected from grid""",
    "median_by_type": """select crm_cd_desc, median(cast(nearby_inspections as double)) as median
        from types_by_nearby group by crm_cd_desc""",
    "boxplot_stats": """
        with box as (select crm_cd_desc, quantile_cont(cast(nearby_inspections as double), 0.25) as q1,
                            quantile_cont(cast(nearby_inspections as double), 0.5) as median,
                            quantile_cont(cast(nearby_inspections as double), 0.75) as q3
                     from types_by_nearby group by crm_cd_desc),
        fenced as (select *, cast(nearby_inspections as double) as v, q1 - 1.5e0 * (q3 - q1) as low, q3 + 1.5e0 * (q3 - q1) as high
                   from types_by_nearby join box using (crm_cd_desc))
        select crm_cd_desc, q1, median, q3, count(*) as n, least(min(v) filter (where v >= low), q1) as whisker_low,
               greatest(max(v) filter (where v <= high), q3) as whisker_high,
               count(*) filter (where v < low or v > high) as n_outliers
        from fenced group by crm_cd_desc, q1, median, q3""",
    "describe_distance": """select count(distance) as n, round(avg(distance), 6) as mean, round(stddev_samp(distance), 6) as std,
        round(min(distance), 6) as min, round(quantile_cont(distance, 0.25), 6) as p25,
        round(quantile_cont(distance, 0.5), 6) as p50, round(quantile_cont(distance, 0.75), 6) as p75,
        round(max(distance), 6) as max from measured""",
    "quantiles_refined": """select area_name, round(quantile_cont(distance, 0.01), 6) as p01,
        round(quantile_cont(distance, 0.5), 6) as p50, round(quantile_cont(distance, 0.99), 6) as p99
        from measured where distance is not null group by area_name""",
    "corr_matrix": " union all ".join(
        f"select '{a}' as row_variable, '{b}' as column_variable, "
        + ("1e0 as correlation" if a == b else f"round(corr({a}, {b}), 6) as correlation from valid")
        for a in q.CORRELATED
        for b in q.CORRELATED
    ),
    "age_histogram": _histogram("valid", "vict_age"),
    "distance_histogram": _histogram("measured", "distance"),
    "distance_kde": _density("select v from v", "exp(-pow((x - v) / h, 2) / 2)"),
    "distance_kde_binned": _density(
        f"""select avg(v) as v, count(*) as weight, var_pop(v) as variance from v, facts
            group by least(floor((v - low) / (high - low) * {CURVE_PARTS}), {CURVE_PARTS - 1})""",
        "weight * exp(-pow((x - v) / h, 2) / 2) * (1 + variance / (2 * h * h) * (pow((x - v) / h, 2) - 1))",
    ),
    "dashboard_monthly": """select cast(year(date_occ) as integer) as year, cast(month(date_occ) as integer) as month,
        crm_cd_desc, vict_descent, count(*) as n, make_date(year(date_occ), month(date_occ), 1) as month_date
        from crime where date_occ is not null group by all""",
    "dashboard_monthly_filtered": f"""select cast(year(date_occ) as integer) as year, cast(month(date_occ) as integer) as month,
        crm_cd_desc, vict_descent, count(*) as n, make_date(year(date_occ), month(date_occ), 1) as month_date
        from crime where date_occ is not null and crm_cd_desc = '{q.CHOSEN_TYPE}' and vict_descent = '{q.CHOSEN_DESCENT}'
        group by all""",
    "dashboard_descent_share": """select vict_descent, count(*) as n,
        round(count(*) / cast(sum(count(*)) over () as double) * 100, 6) as percentage from crime group by vict_descent""",
    "dashboard_descent_share_filtered": f"""select vict_descent, count(*) as n,
        round(count(*) / cast(sum(count(*)) over () as double) * 100, 6) as percentage
        from crime where crm_cd_desc = '{q.CHOSEN_TYPE}' group by vict_descent""",
    "dashboard_descent_share_both": f"""select vict_descent, count(*) as n,
        round(count(*) / cast(sum(count(*)) over () as double) * 100, 6) as percentage
        from crime where crm_cd_desc = '{q.CHOSEN_TYPE}' and vict_descent in ('{q.CHOSEN_DESCENT}', 'AUTOMOBILE')
        group by vict_descent""",
    "dashboard_cube": """select case when grouping(crm_cd_desc) + grouping(vict_descent) = 2 then 'month'
            when grouping(crm_cd_desc) = 1 then 'descent' when grouping(vict_descent) = 1 then 'type' else 'cell' end as level,
        cast(month_date as date) as month_date, crm_cd_desc, vict_descent, count(*) as n
        from (select *, date_trunc('month', date_occ) as month_date from crime)
        group by grouping sets ((month_date, crm_cd_desc, vict_descent), (month_date, crm_cd_desc),
            (month_date, vict_descent), (month_date))""",
    "dashboard_from_cube": f"""select vict_descent, count(*) as n,
        round(count(*) / cast(sum(count(*)) over () as double) * 100, 6) as percentage
        from crime where crm_cd_desc = '{q.CHOSEN_TYPE}' and vict_descent in ('{q.CHOSEN_DESCENT}', 'AUTOMOBILE')
        group by vict_descent""",
    "top_values": _top("business_raw", "primary_naics_description", 15),
    "top_victim_descents": _top("valid", "vict_descent", 3),
    "top_inspection_results": _top("located", "inspection_result", 10),
    "nlargest": """select dr_no, crm_cd_desc, round(distance, 6) as distance from measured where distance is not null
        order by round(distance, 6) desc, dr_no limit 10""",
    "nlargest_nearby": """select dr_no, crm_cd_desc, cast(coalesce(hits, 0) as integer) as nearby_inspections
        from valid left join degree_hits using (lat, lon) order by 3 desc, dr_no limit 10""",
    "sample_all": "select account_no from business_raw",
    "crime_by_area": _counts("valid", "area_name", "number_of_crimes"),
    "sample_n": f"""select dr_no, crm_cd_desc, lat, lon from valid
        order by md5('42:' || cast(dr_no as varchar)), dr_no limit {q.SAMPLE_ROWS}""",
    "clean_crime": "select * from crime",
    "clean_inspections": "select * from inspections",
    "enrich_crime": "select * replace (round(distance_km, 6) as distance_km) from enriched",
    "band_summary": """select distance_group, count(*) as n_crimes, cast(sum(nearby_inspection_count) as bigint) as n_nearby,
        round(avg(nearby_inspection_count), 6) as avg_nearby from enriched group by distance_group""",
    "select_and_year_month": f"""select d as date_occ, area_name, crm_cd_desc, vict_age, vict_sex, vict_descent,
        cast(year(d) as integer) as year, cast(month(d) as integer) as month
        from (select *, {_timestamp('date_occ')} as d from crime_raw)""",
    "select_and_year_month_inspections": f"""select d as inspection_date, permit_status, inspection_result, inspection_type,
        cast(year(d) as integer) as year, cast(month(d) as integer) as month
        from (select *, {_date('inspection_date')} as d from inspection_raw)""",
}


def _with_parts(sql: str) -> str:
    """``sql`` with the parts it names, directly or through other parts, in front."""
    needed: set[str] = set()
    open_texts = [sql]
    while open_texts:
        text = open_texts.pop()
        for name in PARTS:
            if name not in needed and re.search(rf"\b(from|join)\s+\(*{name}\b", text):
                needed.add(name)
                open_texts.append(PARTS[name])
    parts = ", ".join(f"{name} as ({PARTS[name]})" for name in PARTS if name in needed)
    body = sql.strip()
    if body.startswith("with "):
        return f"with {parts}, {body[len('with '):]}"
    return f"with {parts} {body}"


ORACLES = {name: _with_parts(sql) for name, sql in _QUERIES.items()}
