"""Publishing single partitions of a table."""

import pytest
from pyspark.sql import functions as F

from padronix.sources import published


def table(spark, year, rows, name="v"):
    return spark.range(rows).select(F.lit(year).cast("int").alias("year"), F.col("id").alias(name))


def per_year(df):
    return {r.year: r.n for r in df.groupBy("year").agg(F.count(F.lit(1)).alias("n")).collect()}


def test_a_year_replaces_itself_only(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        published.read_published(spark, path)
    both = table(spark, 2021, 5).unionAll(table(spark, 2022, 7))
    audit = published.publish_partitions(both, path, "year", {"top": F.max("v"), "years": F.count_if(F.col("year") == 2022)})
    assert audit == {"n_rows": 12, "top": 6, "years": 7}
    old = published.read_published(spark, path)
    published.publish_partitions(table(spark, 2022, 3).unionAll(table(spark, None, 2)), path, "year")
    new = published.read_published(spark, path)
    assert new.columns == ["v", "year"] and per_year(new) == {2021: 5, 2022: 3, None: 2}
    assert per_year(old) == {2021: 5, 2022: 7} == per_year(published.read_published(spark, path, 1))
    plan = new.where("year = 2022")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    assert published.publish_partitions(table(spark, 2021, 0), path, "year")["n_rows"] == 0
    assert published.versions(spark, path) == [1, 2]


def test_a_failed_write_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    published.publish_partitions(table(spark, 2021, 50), path, "year")
    bad = table(spark, 2021, 100).withColumn("v", F.when(F.col("v") == 99, F.raise_error(F.lit("broken"))).otherwise(F.col("v")).cast("bigint"))
    with pytest.raises(Exception, match="broken"):
        published.publish_partitions(bad, path, "year")
    assert per_year(published.read_published(spark, path)) == {2021: 50} and published.versions(spark, path) == [1]


def test_the_slower_of_two_publications_gives_way(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    published.publish_partitions(table(spark, 2021, 1), path, "year")
    published.publish_partitions(table(spark, 2022, 2), path, "year")
    monkeypatch.setattr(published, "versions", lambda spark, path: [1])
    with pytest.raises(published.PublishConflict):
        published.publish_partitions(table(spark, 2023, 3), path, "year")
    monkeypatch.undo()
    assert per_year(published.read_published(spark, path)) == {2021: 1, 2022: 2}


def test_columns_are_added_not_retyped(spark, tmp_path):
    path = str(tmp_path / "t")
    published.publish_partitions(table(spark, 2021, 1), path, "year")
    published.publish_partitions(table(spark, 2022, 1).withColumn("more", F.lit("x")), path, "year")
    got = published.read_published(spark, path).select("year", "v", "more").collect()
    assert sorted(map(tuple, got)) == [(2021, 0, None), (2022, 0, "x")]
    with pytest.raises(ValueError, match="v"):
        published.publish_partitions(table(spark, 2021, 1).withColumn("v", F.lit("x")), path, "year")
    assert per_year(published.read_published(spark, path)) == {2021: 1, 2022: 1}
