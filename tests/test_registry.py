"""The registry pipeline on small raw tables with one fault each."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from padronix.operators import quality
from padronix.operators.cleaning import dedupe, rule_report, unmapped
from padronix.operators.joins import keep_valid, orphan_keys, orphan_summary
from padronix.operators.quality import n_distinct
from padronix.plans import registry
from padronix.sources import published
from padronix.sources.contracts import CONTRACTS


def text(spark, name, rows):
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in CONTRACTS[name].names))


@pytest.fixture(scope="module")
def raw(spark):
    return {
        "actividades": text(spark, "actividades", [
            ("111110", "1", "A", "Cultivo  de arroz", "Agro", "AGRICULTURA"),
            ("111110", "2", "A", "copy", "Agro", "AGRICULTURA"),
            ("22222", "10", "C", "Lácteos", "Industria", "INDUSTRIA MANUFACTURERA"),
            # the first row of this code is invalid: keep-first runs before the rules, so the code is lost
            ("333333", "0", "C", "bad first", "x", "x"),
            ("333333", "5", "C", "good second", "x", "x"),
            ("444444", "5", "Z", "unknown section", "x", "x"),
            ("77", "5", "C", "short code", "x", "x"),
        ]),
        "departamentos": text(spark, "departamentos", [
            ("14", "14014", " Capital ", "Cordoba"),
            ("2", "2007", "Comuna 1", "Capital Federal"),
            ("2", "2007", "Comuna 1 bis", "CABA"),
            ("90", "90001", "Burruyacú", "Tucuman"),
            ("94", "94001", None, "Tierra del Fuego"),
        ]),
        "depto_actividad": text(spark, "depto_actividad", [
            ("2021", "14014", "Capital", "14", "Cordoba", "111110", "1", "A", " hombre", "10", "4", "1"),
            ("2022", "14014", "Capital", "14", "Cordoba", "111110", "1", "A", "MUJERES", "10", "0", "0"),
            ("2020", "14014", "Capital", "14", "Cordoba", "111110", "1", "A", "Mujeres", "10", "4", "1"),
            ("2021", "14014", "Capital", "14", "Cordoba", "111110", "1", "A", "otro", "10", "4", "1"),
            ("2021", "14014", "Capital", "14", "Cordoba", "111110", "1", "A", "f", "-1", "4", "1"),
        ]),
        "establecimientos": text(spark, "establecimientos", [
            ("30-1", "1", "2021", "-31.4", "-64.2", "111110", "14014", "14", "0", "a. 1-9", "0.5"),
            ("30-1", "1", "2021", "-31.4", "-64.2", "22222", "14014", "14", "3", "b. 10-49", "0.9"),
            ("30-1", "1", "2022", "-31.4", "-64.2", "22222.0", "2007", "2", "5", "f. 500 y más", "1"),
            ("30-2", "1", "2021", "bad", "-64.2", "22222", "2007", "2", "1", "c. 50-99", "0.3"),
            ("30-3", "1", "2021", "-31.4", "-64.2", "999999", "2007", "2", "1", "c. 50-99", "0.3"),
            ("30-4", "1", "2021", "-31.4", "-64.2", "22222", "50001", "50", "1", "c. 50-99", "0.3"),
            ("30-5", "1", "2020", "-31.4", "-64.2", "22222", "2007", "2", "1", "c. 50-99", "0.3"),
            ("30-6", "1", "2021", "-31.4", "-64.2", "22222", "2007", "2", "6", "c. 50-99", "0.3"),
            ("30-7", "1", "2021", "-31.4", "-64.2", "22222", "2007", "2", "1", "50 a 199", "0.3"),
            ("30-8", "1", "2021", "-31.4", "-64.2", "22222", "2007", "2", "1", "c. 50-99", "1.2"),
            ("30-9", "1", "2021", "-31.4", "-64.2", "22222", "2007", "2", "1", "c. 50-99", None),
        ]),
    }


@pytest.fixture(scope="module")
def built(raw):
    return registry.build(raw)


def test_activities_keep_first_before_rules(built):
    rows = {r.activity_code: r.activity_name for r in built.activities.collect()}
    assert rows == {111110: "Cultivo de arroz", 22222: "Lácteos"}


def test_areas(built):
    rows = {(r.province_id, r.area_id): (r.area_name, r.province) for r in built.areas.collect()}
    assert rows == {(14, 14014): ("Capital", "Córdoba"), (2, 2007): ("Comuna 1", "CABA"), (90, 90001): ("Burruyacú", "Tucumán")}


def test_area_activity(built):
    rows = built.area_activity.select("gender", "jobs_per_establishment", "exporter_share").collect()
    assert sorted(tuple(r) for r in rows) == [("Mujeres", 0.0, 0.0), ("Varones", 2.5, 0.25)]


def test_establishments_rules_before_keep_first(built):
    rows = {(r.owner_id, r.year): (r.activity_code, r.size_mid, r.lat) for r in built.establishments.collect()}
    assert rows == {
        ("30-1", 2021): (22222, 29.5, -31.4),
        ("30-1", 2022): (22222, 750.0, -31.4),
        ("30-2", 2021): (22222, 74.5, None),
        ("30-3", 2021): (999999, 74.5, -31.4),
        ("30-4", 2021): (22222, 74.5, -31.4),
    }


def test_integrated_table(built):
    assert len(built.full.columns) == 24
    rows = {(r.owner_id, r.year): (r.section, r.province, r.region) for r in built.full.collect()}
    assert rows == {
        ("30-1", 2021): ("C", "Córdoba", "Centro"),
        ("30-1", 2022): ("C", "CABA", "Centro"),
        ("30-2", 2021): ("C", "CABA", "Centro"),
    }


def test_audit_and_retention(built):
    rows = {r.stage: (r.n_before, r.n_after, r.n_removed, r.pct_removed) for r in built.audit.collect()}
    assert rows == {
        "activities": (7, 2, 5, 71.43),
        "areas": (5, 3, 2, 40.0),
        "area_activity": (5, 2, 3, 60.0),
        "establishments": (11, 5, 6, 54.55),
    }
    assert {r.table: r.pct_kept for r in quality.retention(built.audit).collect()}["establishments"] == 45.45


def test_rule_report_adds_up(raw):
    from padronix.operators.cleaning import conform
    from padronix.sources.contracts import public_schema, publish

    typed = conform(publish(raw["establecimientos"]), public_schema(CONTRACTS["establecimientos"]))
    rows = {r.rule: r for r in rule_report(typed, registry.establishment_rules()).collect()}
    assert {n: r.n_rejected for n, r in rows.items()} == {
        "year": 1, "code_length": 0, "province_id": 0, "area_id": 0, "size_label": 1, "share_women": 2, "export_quintile": 1,
    }
    assert rows["year"].n_kept == 6 and rows["year"].n_rows == 11


def test_validation(raw):
    checks = registry.validate(raw)
    assert {r.status for r in checks["contract"].collect()} == {"ok"}
    assert {r.table: r.n_rows for r in checks["summary"].collect()}["establecimientos"] == 11
    orphans = checks["orphan_activities"].first()
    assert (orphans.n_keys, orphans.n_rows, orphans.examples) == (1, 1, "999999")
    assert checks["orphan_areas"].first().examples == "50-50001"
    bounds = checks["bounds"].first()
    assert (bounds.n_rows, bounds.n_valid) == (10, 10)
    assert {r.value: r.allowed for r in checks["years"].collect()} == {2020: False, 2021: True, 2022: True}


def test_written_registry(built, spark, tmp_path):
    folder = str(tmp_path / "out")
    registry.write_registry(built, folder)
    assert spark.read.parquet(f"{folder}/establishments_full").where("year = 2022").count() == 1
    kpis = spark.read.csv(f"{folder}/reports/kpis", header=True, inferSchema=True).first()
    assert (kpis.n_rows, kpis.provinces, kpis.years, kpis.n_events) == (3, 2, 2, 3)


def test_published_years_leave_others(built, spark, tmp_path):
    folder = str(tmp_path / "out")
    audit = registry.publish_years(built, folder)
    rows = published.read_published(spark, f"{folder}/establishments_full")
    assert rows.count() == built.full.count() == audit["establishments_full"]["n_rows"]
    one = replace(built, establishments=built.establishments.where("year = 2022"), full=built.full.where("year = 2022").limit(0))
    assert registry.publish_years(one, folder)["establishments"]["no_year"] == 0
    for name in ("establishments", "establishments_full"):
        now = published.read_published(spark, f"{folder}/{name}")
        assert sorted(now.columns) == sorted(getattr(built, "full" if name.endswith("full") else name).columns)
        assert now.count() == getattr(built, "full" if name.endswith("full") else name).count()


def test_unmapped_labels_are_reported(spark):
    df = spark.createDataFrame([("Atlantida",), ("CABA",), ("Atlantida",)], "province string")
    df = df.withColumn("region", registry.region_of(F.col("province")))
    assert [tuple(r) for r in unmapped(df, "province", "region", "Otras").collect()] == [("Atlantida", 2)]


def test_dedupe_limits_each_key_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    out = dedupe(df, ["k"], ["v"])
    assert sorted(r.v for r in out.collect()) == [0, 1, 2]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_distinct_counts_null_as_a_value(spark):
    df = spark.createDataFrame([("a",), (None,), ("b",), (None,)], "c string")
    assert df.agg(n_distinct("c").alias("x"), n_distinct("c", count_null=False).alias("y")).first() == (3, 2)


def test_key_checks(spark):
    fact = spark.createDataFrame([(1, "x"), (1, "y"), (2, "z"), (3, "w")], "k int, v string")
    dim = spark.createDataFrame([(1,), (1,)], "k int")
    orphans = orphan_keys(fact, dim, ["k"])
    assert sorted(tuple(r) for r in orphans.collect()) == [(2, 1), (3, 1)]
    assert tuple(orphan_summary(orphans, ["k"]).first()) == (2, 2, "2,3")
    assert keep_valid(fact, dim, ["k"]).count() == 2


def test_a_full_run_writes_every_table(spark, tmp_path):
    """The tables of FIXTURES F4, from the smallest generated tables and with few trees."""
    import os

    from padronix.operators import models
    from padronix.plans import hypotheses, results
    from padronix.plans.derived import raw_tables

    folder = str(tmp_path)
    tables = raw_tables(spark, "/root/testdata/sf0.001")
    registry.write_validation(tables, folder)
    registry.write_registry(registry.build(tables), folder)
    full = spark.read.parquet(f"{folder}/establishments_full")
    few = {"forest": {"numTrees": 3, "maxDepth": 4}, "mtry": (2,), "folds": 2}
    results.write_results(
        full, folder, 20, 2, nstart=3, exporter=replace(hypotheses.EXPORTER, **few),
        geography=replace(hypotheses.GEOGRAPHY, folds=2), health=replace(hypotheses.HEALTH, **few),
        gender=replace(hypotheses.GENDER, **few),
    )
    assert set(os.listdir(f"{folder}/reports")) == {
        "audit", "retention", "kpis", "unmapped_provinces", "province_spellings", "sector_profile", "sector_clusters", "cluster_profile",
        "executive_summary", "insights", "hypotheses", "algorithms", "model_comparison", "classification_summary",
    }
    assert {"contract", "missing", "profile_text", "profile_numeric", "summary"} <= set(os.listdir(f"{folder}/validation"))
    hypothesis = spark.read.csv(f"{folder}/reports/hypotheses", header=True).collect()
    assert {r.hypothesis for r in hypothesis} == {"H1", "H2", "H3"}
    assert next(r.verdict for r in hypothesis if r.hypothesis == "H3") in {"highly identifiable", "moderately identifiable", "hard to identify"}
    audit = {r.stage: r for r in spark.read.parquet(f"{folder}/audit").collect()}
    assert audit["establishments"].n_after == spark.read.parquet(f"{folder}/establishments").count()
    again = models.load_model(spark, f"{folder}/models/H1")
    scored = again.score(hypotheses.exporter_data(full))
    assert {r.predicted for r in scored.select("predicted").distinct().collect()} <= {"Exportador", "No_Exportador"}


def test_unmapped_provinces_and_loose_spellings(spark):
    df = spark.createDataFrame([("cordoba",), ("CÓRDOBA",), ("Atlántida",)], "province string")
    full = df.withColumn("region", registry.region_of(F.col("province"), fold_accents=True))
    assert [r.region for r in full.collect()] == ["Centro", "Centro", "Otras"]
    assert [tuple(r) for r in registry.unmapped_provinces(full).collect()] == [("Atlántida", 1)]
