"""Jobs that are killed and run again, and the serving table."""

import os

import pytest
from pyspark.sql import functions as F

from cityweave.operators import nearby, serving, trends
from cityweave.plans import jobs
from cityweave.plans.queries import Tables
from cityweave.sources import resume, scratch


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.fixture
def shared(tmp_path, monkeypatch):
    """A shared folder of its own, so that what a job leaves there can be seen."""
    monkeypatch.setattr(scratch, "shared_folder", lambda spark: str(tmp_path / "shared"))
    return tmp_path / "shared"


@pytest.fixture
def raw(spark, small, tmp_path):
    """Raw tables as files, so that their version can change."""
    t = Tables(spark, small)
    for name, df in (("crime", t.crime_raw), ("inspection", t.inspection_raw)):
        df.write.parquet(str(tmp_path / name))
    return lambda: [spark.read.parquet(str(tmp_path / n)) for n in ("crime", "inspection")]


def leftovers(folder):
    return [os.path.join(at, f) for at, _, files in os.walk(folder) for f in files]


def test_killed_job_goes_on(spark, raw, shared, tmp_path, monkeypatch):
    counted, out = [], str(tmp_path / "out")
    count_around = nearby.count_around
    monkeypatch.setattr(nearby, "count_around", lambda *a, **k: counted.append(1) or count_around(*a, **k))
    move, stage = resume.Files.move, resume.Job._stage

    def killed(*args):
        raise KeyboardInterrupt

    for owner, name, real in ((resume.Job, "_stage", stage), (resume.Files, "move", move)):
        monkeypatch.setattr(owner, name, killed)
        with pytest.raises(KeyboardInterrupt):
            jobs.export_job(*raw(), out)
        monkeypatch.setattr(owner, name, real)
        assert leftovers(shared)
    jobs.export_job(*raw(), out)
    assert len(counted) == 1 and not leftovers(shared)
    assert sorted(d for d in os.listdir(out) if not d.startswith(("_", "."))) == ["crime_final", "ins_final"]
    assert not any(d.startswith("_staged") for d in os.listdir(out))
    enriched, inspections = jobs.clean_and_enrich(*raw())
    read = spark.read.option("header", True).option("escape", '"').csv
    assert read(f"{out}/crime_final").count() == enriched.count() and read(f"{out}/ins_final").count() == inspections.count()
    total = F.sum(F.col("nearby_inspection_count").cast("long"))
    assert read(f"{out}/crime_final").agg(total).first() == enriched.agg(total).first()


def test_export_keeps_little_on_disk(spark, raw, shared, tmp_path, monkeypatch):
    """What a step writes in between is gone when it is done, and the exported CSV is packed and whole."""
    kept, step = [], resume.Job.step

    def looked_at(job, name, make):
        found = step(job, name, make)
        kept.extend(f for f in leftovers(shared) if "/scratch/" in f)
        return found

    monkeypatch.setattr(resume.Job, "step", looked_at)
    out, before = str(tmp_path / "out"), spark.conf.get(scratch.RELEASE)
    jobs.export_job(*raw(), out)
    assert not kept and spark.conf.get(scratch.RELEASE) == before
    for name, df in zip(("crime_final", "ins_final"), jobs.clean_and_enrich(*raw())):
        packed = [f for f in leftovers(f"{out}/{name}") if "/part-" in f]
        assert packed and all(f.endswith(".csv.gz") for f in packed)
        assert spark.read.option("header", True).option("escape", '"').csv(f"{out}/{name}").count() == df.count()


def test_same_input_is_exported_once_and_new_input_again(spark, raw, shared, tmp_path):
    out = str(tmp_path / "out")
    jobs.export_job(*raw(), out, format="parquet")
    first = spark.read.parquet(f"{out}/crime_final").count()
    files = os.listdir(f"{out}/crime_final")
    jobs.export_job(*raw(), out, format="parquet")
    assert os.listdir(f"{out}/crime_final") == files
    raw()[0].where("crm_cd_1 is not null and premis_desc is not null").limit(1).write.mode("append").parquet(str(tmp_path / "crime"))
    jobs.export_job(*raw(), out, format="parquet")
    assert spark.read.parquet(f"{out}/crime_final").count() == first + 1 and not leftovers(shared)


def test_failed_check_leaves_the_earlier_result(spark, shared, tmp_path):
    out = str(tmp_path / "out")

    def write(df, path):
        df.write.mode("overwrite").parquet(path)

    resume.Job(spark, "j", "1").publish({"t": resume.Result(spark.range(3), 3, write)}, out)
    with pytest.raises(RuntimeError, match="not 5"):
        resume.Job(spark, "j", "2").publish({"t": resume.Result(spark.range(4), 5, write)}, out)
    assert spark.read.parquet(f"{out}/t").count() == 3
    resume.Job(spark, "j", "2").publish({"t": resume.Result(spark.range(5), 5, write)}, out)
    assert spark.read.parquet(f"{out}/t").count() == 5 and not leftovers(shared)


def test_one_cube_answers_the_dashboard(spark, small, tmp_path):
    crime, path = Tables(spark, small).crime, str(tmp_path / "cube")
    serving.build(crime, path)
    cube = serving.read(spark, path)
    some = crime.groupBy("crm_cd_desc").count().orderBy(F.desc("count"), "crm_cd_desc").limit(2).collect()
    types, descents = [r.crm_cd_desc for r in some], ["BUILDING", "AUTOMOBILE"]
    for chosen in ({}, {"types": types}, {"descents": descents}, {"types": types, "descents": descents}):
        assert rows(serving.monthly(cube, **chosen)) == rows(trends.dashboard_monthly(crime, **chosen).select(*serving.monthly(cube).columns))
        assert rows(serving.descent_share(cube, **chosen)) == rows(trends.dashboard_descent_share(crime, **chosen))


def test_a_new_month_rewrites_that_month_only(spark, small, tmp_path):
    crime, path = Tables(spark, small).crime, str(tmp_path / "cube")
    last = crime.agg(F.max("date_occ")).first()[0].date().replace(day=1)
    is_last = F.coalesce(F.col("date_occ") >= F.lit(last), F.lit(False))
    serving.build(crime.where(~is_last), path)
    before = {d: os.listdir(f"{path}/{d}") for d in os.listdir(path) if "=" in d}
    for _ in range(2):
        serving.refresh(crime, crime.where(is_last), path)
        assert rows(serving.read(spark, path)) == rows(serving.cells(crime))
    after = {d: os.listdir(f"{path}/{d}") for d in os.listdir(path) if "=" in d}
    assert {d for d in after if before.get(d) != after[d]} == {f"month_date={last:%Y-%m-%d}"}
    undated = crime.limit(1).withColumn("date_occ", F.lit(None).cast("timestamp_ntz"))
    serving.refresh(crime.unionByName(undated), undated, path)
    assert rows(serving.read(spark, path)) == rows(serving.cells(crime.unionByName(undated)))
