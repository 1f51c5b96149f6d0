"""Saved tables: columns added, partitions updated, versions swapped."""

import functools
import os
import uuid

import pytest
from pyspark.sql import functions as F

from cityweave.sources import saved


@pytest.fixture
def name(spark, tmp_path):
    name = f"t{uuid.uuid4().hex}"
    yield name
    spark.sql(f"drop view if exists {name}") if saved.current_version(spark, name) else spark.sql(f"drop table if exists {name}")
    for t in spark.catalog.listTables(pattern=f"{name}__*"):
        spark.sql(f"drop table if exists {t.name}")


def files(path):
    return {d: sorted(f for f in os.listdir(f"{path}/{d}") if not f.startswith(".")) for d in os.listdir(path) if "=" in d}


def save(spark, name, tmp_path):
    df = spark.range(100).select("id", (F.col("id") * 2).alias("n"), F.nullif(F.col("id") % 5, F.lit(4)).alias("part"))
    df.write.partitionBy("part").option("path", str(tmp_path / name)).saveAsTable(name)
    return str(tmp_path / name)


def test_update_rewrites_touched_partitions_only(spark, name, tmp_path):
    path = save(spark, name, tmp_path)
    before = files(path)
    saved.update(spark, name, {"n": F.col("n") + 1000}, F.col("id") == 7)
    after = files(path)
    assert {d for d in before if before[d] != after[d]} == {"part=2"}
    rows = {r.id: r.n for r in spark.table(name).collect()}
    assert rows == {i: 2 * i + 1000 * (i == 7) for i in range(100)}
    saved.update(spark, name, {"n": F.lit(0).cast("long")}, F.col("part").isNull())
    assert {d for d in after if after[d] != files(path)[d]} == {"part=__HIVE_DEFAULT_PARTITION__"}
    assert spark.table(name).where("part is null and n <> 0").count() == 0 and spark.table(name).count() == 100
    now = files(path)
    saved.update(spark, name, {"n": F.col("n") + 1}, F.col("id") > 1000)
    assert files(path) == now
    saved.update(spark, name, {"n": F.col("n") + 1})
    assert spark.table(name).agg(F.sum("n")).first()[0] == sum(r.n for r in spark.table(name).collect())
    with pytest.raises(ValueError, match="partition"):
        saved.update(spark, name, {"part": F.lit(1)}, F.col("id") == 1)


def test_added_column_touches_no_file(spark, name, tmp_path):
    path = save(spark, name, tmp_path)
    before = files(path)
    for _ in range(2):
        found = saved.add_column(spark, name, "Score", "int", "7")
    assert files(path) == before and {r.Score for r in found.collect()} == {7}
    assert "note" in saved.add_column(spark, name, "note", "string").columns
    saved.update(spark, name, {"score": F.lit(1)}, F.col("id") == 3)
    assert {r.id: r.Score for r in spark.table(name).collect()} == {i: 1 if i == 3 else 7 for i in range(100)}


def test_versions_are_swapped_whole(spark, name, tmp_path):
    publish = functools.partial(saved.publish, folder=str(tmp_path / "versions"))
    for version, n in (("a", 3), ("b", 4)):
        assert publish(spark.range(n), name, version, n).count() == n
    with pytest.raises(RuntimeError, match="not 9"):
        publish(spark.range(5), name, "c", 9)
    broken = spark.range(5).select(F.raise_error(F.lit("killed")).cast("long").alias("id"))
    with pytest.raises(Exception, match="killed"):
        publish(broken, name, "c").count()
    assert spark.table(name).count() == 4 and saved.current_version(spark, name) == "b"
    assert publish(broken, name, "b", 4).count() == 4  # the same version again: nothing is computed
    publish(spark.range(6), name, "c", 6)
    publish(spark.range(7), name, "d", 7)
    left = {t.name for t in spark.catalog.listTables(pattern=f"{name}__*")}
    assert left == {f"{name}__c", f"{name}__d"} and spark.table(name).count() == 7
    assert {d.lower() for d in os.listdir(tmp_path / "versions")} == left
