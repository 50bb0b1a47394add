"""A kept table has the partitions, and so the sums, of the query it keeps."""

from pyspark.sql import functions as F

from padronix.operators.shared import kept


def test_kept_rows_add_up_as_others(spark):
    rows = spark.range(20_000).select((F.col("id") % 997).alias("k"), (F.col("id") * 0.1).alias("x"))
    table = rows.groupBy("k").agg(F.sum("x").alias("x"))
    parts = [r[0] for r in table.select(F.spark_partition_id()).distinct().collect()]
    name = "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning"
    before = spark.conf.get(name)
    held = kept(table)
    try:
        assert spark.conf.get(name) == before
        assert [r[0] for r in held.select(F.spark_partition_id()).distinct().collect()] == parts == [0]
        assert held.agg(F.sum("x")).first()[0].hex() == table.agg(F.sum("x")).first()[0].hex()
    finally:
        held.unpersist()


def test_sector_rows_are_computed_once(spark, monkeypatch):
    """Both passes of the clusters' features joined the tables anew."""
    from padronix.plans.catalog import registry

    cells = [(f"SECTOR {i % 4}", i % 11 / 10, float(i % 5), i % 6, "Micro", f"P{i % 7}") for i in range(400)]
    names = "section_name string, share_women double, size_mid double, export_quintile int, size_class string, province string"
    done = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def section(name):
        done.add(1)
        return name[-1]

    rows = spark.createDataFrame(cells, names).withColumn("section", section.asNondeterministic()("section_name"))
    monkeypatch.setattr(registry, "full", lambda spark, d: rows)
    assert sum(r.n_groups for r in registry.registry_clusters(spark, "").collect()) == 4
    assert done.value == 400
    spark.catalog.clearCache()
