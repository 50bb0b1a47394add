"""The registry pipeline from end to end, on raw tables derived from the order tables."""

from dataclasses import replace

from pyspark.sql import functions as F

from padronix.operators import cleaning, stats
from padronix.operators.shared import kept
from padronix.plans import explore, hypotheses, registry
from padronix.plans.catalog.base import query
from padronix.plans.derived import RAW_SQL, raw_tables
from padronix.sources.contracts import CONTRACTS, publish, public_schema

INT = "CAST(trunc(TRY_CAST({} AS DOUBLE)) AS INTEGER)"


def _int(c):
    return INT.format(c)


ACTIVITIES = f"""SELECT * FROM (
  SELECT {_int("clae6")} AS activity_code, {_int("clae2")} AS division_code, letra AS section,
    trim(regexp_replace(clae6_desc, '\\s+', ' ', 'g')) AS activity_name,
    trim(regexp_replace(letra_desc, '\\s+', ' ', 'g')) AS section_name,
    row_number() OVER (PARTITION BY {_int("clae6")} ORDER BY {_int("clae2")}, letra,
      trim(regexp_replace(clae6_desc, '\\s+', ' ', 'g'))) AS rn FROM ({RAW_SQL["actividades"]}))
WHERE rn = 1 AND length(CAST(activity_code AS VARCHAR)) IN (5, 6) AND division_code > 0 AND section BETWEEN 'A' AND 'U'"""

AREAS = f"""SELECT * FROM (
  SELECT {_int("provincia_id")} AS province_id, {_int("in_departamentos")} AS area_id, trim(departamento) AS area_name,
    CASE trim(regexp_replace(provincia, '\\s+', ' ', 'g')) WHEN 'Cordoba' THEN 'Córdoba' WHEN 'Capital Federal' THEN 'CABA'
      WHEN 'Tucuman' THEN 'Tucumán' WHEN 'Neuquen' THEN 'Neuquén' WHEN 'Entre Rios' THEN 'Entre Ríos'
      ELSE trim(regexp_replace(provincia, '\\s+', ' ', 'g')) END AS province,
    row_number() OVER (PARTITION BY provincia_id, in_departamentos ORDER BY trim(departamento), provincia) AS rn
  FROM ({RAW_SQL["departamentos"]}))
WHERE rn = 1 AND province_id > 0 AND area_id > 0"""

TYPED = f"""SELECT cuit AS owner_id, {_int("sucursal")} AS branch, {_int("anio")} AS "year", TRY_CAST(lat AS DOUBLE) AS lat,
  TRY_CAST(lon AS DOUBLE) AS lon, {_int("clae6")} AS activity_code, {_int("in_departamentos")} AS area_id,
  {_int("provincia_id")} AS province_id, {_int("quintil")} AS export_quintile, empleo AS size_label,
  TRY_CAST(proporcion_mujeres AS DOUBLE) AS share_women FROM ({RAW_SQL["establecimientos"]})"""

LABELS = "('a. 1-9', 'b. 10-49', 'c. 50-99', 'd. 100-199', 'e. 200-499', 'f. 500 y más')"
ESTABLISHMENTS = f"""SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY owner_id, branch, "year" ORDER BY activity_code, area_id, province_id, lat, lon,
    share_women, export_quintile, size_label) AS rn
  FROM ({TYPED}) WHERE "year" IN (2021, 2022) AND size_label IN {LABELS} AND share_women BETWEEN 0 AND 1
    AND export_quintile BETWEEN 0 AND 5 AND length(CAST(activity_code AS VARCHAR)) IN (5, 6) AND area_id > 0 AND province_id > 0)
WHERE rn = 1"""

FULL = f"""SELECT e.*, a.activity_name, a.division_code, a.section, a.section_name, d.area_name, d.province,
  CASE size_label WHEN 'a. 1-9' THEN 5.0::DOUBLE WHEN 'b. 10-49' THEN 29.5 WHEN 'c. 50-99' THEN 74.5 WHEN 'd. 100-199' THEN 149.5
    WHEN 'e. 200-499' THEN 349.5 ELSE 750 END AS size_mid,
  CASE WHEN size_label = 'a. 1-9' THEN 'Micro' WHEN size_label = 'b. 10-49' THEN 'Pequeña'
    WHEN size_label IN ('c. 50-99', 'd. 100-199') THEN 'Mediana' ELSE 'Grande' END AS size_class,
  CASE export_quintile WHEN 0 THEN 'No exporta' WHEN 1 THEN 'Exportador bajo' WHEN 2 THEN 'Exportador medio'
    WHEN 3 THEN 'Exportador medio' ELSE 'Exportador alto' END AS export_class,
  CASE WHEN share_women < 0.3 THEN 'Predominio masculino' WHEN share_women > 0.7 THEN 'Predominio femenino'
    ELSE 'Composición mixta' END AS gender_class,
  CASE d.province WHEN 'Córdoba' THEN 'Centro' WHEN 'CABA' THEN 'Centro' WHEN 'Entre Ríos' THEN 'Centro' WHEN 'Mendoza' THEN 'Cuyo'
    WHEN 'Tucumán' THEN 'NOA' WHEN 'Chaco' THEN 'NEA' WHEN 'Neuquén' THEN 'Patagonia' ELSE 'Otras' END AS region
FROM ({ESTABLISHMENTS}) e JOIN ({ACTIVITIES}) a ON a.activity_code = e.activity_code
JOIN ({AREAS}) d ON d.province_id = e.province_id AND d.area_id = e.area_id"""

SHOWN = ["owner_id", "branch", "year", "activity_name", "section", "section_name", "area_name", "province", "region",
         "size_mid", "size_class", "export_class", "gender_class"]


def full(spark, d):
    return registry.build(raw_tables(spark, d)).full


@query(f"SELECT {', '.join(SHOWN)} FROM ({FULL})".replace(", year,", ', "year",'))
def registry_integrated(spark, d):
    return full(spark, d).select(*SHOWN)


def _audit_sql(stage, note, raw, clean):
    return f"""SELECT '{stage}' AS stage, '{note}' AS description, b AS n_before, a AS n_after, b - a AS n_removed,
  round((b - a) * 100.0 / b, 2) AS pct_removed
FROM (SELECT (SELECT count(*) FROM ({RAW_SQL[raw]})) AS b, (SELECT count(*) FROM ({clean})) AS a)"""


AREA_ACTIVITY = f"""SELECT "year", area_id, gender, jobs, establishments,
  CASE WHEN establishments > 0 THEN jobs / establishments ELSE 0.0 END AS jobs_per_establishment,
  CASE WHEN establishments > 0 THEN exporters / establishments ELSE 0.0 END AS exporter_share
FROM (SELECT {_int("anio")} AS "year", {_int("in_departamentos")} AS area_id, {_int("clae6")} AS code,
  CASE lower(trim(genero)) WHEN 'hombres' THEN 'Varones' WHEN 'mujer' THEN 'otro' ELSE trim(genero) END AS gender,
  {_int("Empleo")} AS jobs, {_int("Establecimientos")} AS establishments, {_int("empresas_exportadoras")} AS exporters
  FROM ({RAW_SQL["depto_actividad"]}))
WHERE "year" IN (2021, 2022) AND gender IN ('Varones', 'Mujeres') AND length(CAST(code AS VARCHAR)) IN (5, 6)"""


@query(
    " UNION ALL ".join(
        [
            _audit_sql("activities", "text cleaning, keep-first, rules", "actividades", ACTIVITIES),
            _audit_sql("areas", "text cleaning, keep-first, rules", "departamentos", AREAS),
            _audit_sql("area_activity", "text cleaning, rules", "depto_actividad", AREA_ACTIVITY),
            _audit_sql("establishments", "rules, keep-first", "establecimientos", ESTABLISHMENTS),
        ]
    )
)
def registry_audit(spark, d):
    return registry.build(raw_tables(spark, d), stamp=False).audit


@query(f"""
SELECT gender, "year", count(*) AS n, round(avg(jobs_per_establishment), 4) AS jobs_per_establishment,
  round(avg(exporter_share), 6) AS exporter_share FROM ({AREA_ACTIVITY}) GROUP BY 1, 2
""")
def registry_area_activity(spark, d):
    rows = registry.clean_area_activity(raw_tables(spark, d)["depto_actividad"])
    return rows.groupBy("gender", "year").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.avg("jobs_per_establishment"), 4).alias("jobs_per_establishment"),
        F.round(F.avg("exporter_share"), 6).alias("exporter_share"),
    )


@query(f"""
SELECT count(*) AS n_rows, count(DISTINCT province) AS provinces, count(DISTINCT area_id) AS areas,
  count(DISTINCT activity_code) AS activities, count(DISTINCT "year") AS years, round(avg(share_women), 3) AS mean_share,
  count(*) FILTER (export_quintile > 0) AS n_events,
  round(avg(CASE WHEN export_quintile > 0 THEN 1.0 ELSE 0.0 END) * 100, 2) AS event_rate
FROM ({FULL})
""")
def registry_kpis(spark, d):
    return registry.kpis(full(spark, d))


RULES = {
    "year": "\"year\" IN (2021, 2022)",
    "code_length": "length(CAST(activity_code AS VARCHAR)) IN (5, 6)",
    "province_id": "province_id > 0",
    "area_id": "area_id > 0",
    "size_label": f"size_label IN {LABELS}",
    "share_women": "share_women BETWEEN 0 AND 1",
    "export_quintile": "export_quintile BETWEEN 0 AND 5",
}
EVERY_RULE = " AND ".join(RULES.values())


@query(
    f"WITH t AS ({TYPED}) "
    + " UNION ALL ".join(
        f"""SELECT '{n}' AS rule, count(*) - count(*) FILTER ({r}) AS n_rejected, count(*) FILTER ({EVERY_RULE}) AS n_kept,
  count(*) AS n_rows FROM t"""
        for n, r in RULES.items()
    )
)
def registry_rules(spark, d):
    raw = publish(raw_tables(spark, d)["establecimientos"])
    typed = cleaning.conform(raw, public_schema(CONTRACTS["establecimientos"]))
    return cleaning.rule_report(typed, registry.establishment_rules())


@query(f"""
WITH f AS (SELECT province_id, area_id, count(*) AS n FROM ({TYPED}) GROUP BY 1, 2),
o AS (SELECT * FROM f WHERE (province_id, area_id) NOT IN (SELECT ({_int("provincia_id")}, {_int("in_departamentos")})
  FROM ({RAW_SQL["departamentos"]})))
SELECT count(*) AS n_keys, CAST(coalesce(sum(n), 0) AS BIGINT) AS n_rows,
  (SELECT coalesce(string_agg(k, ',' ORDER BY k), '') FROM (SELECT concat_ws('-', province_id, area_id) AS k FROM o
    ORDER BY province_id, area_id LIMIT 10)) AS examples
FROM o
""")
def registry_orphan_areas(spark, d):
    return registry.validate(raw_tables(spark, d))["orphan_areas"]


@query(f"""
WITH t AS (SELECT lat BETWEEN -55 AND -21.5 AS a, lon BETWEEN -74 AND -53.5 AS b FROM ({TYPED}))
SELECT count(*) AS n_rows, count(*) FILTER (a AND b) AS n_valid, count(*) FILTER (NOT a) AS n_bad_lat,
  count(*) FILTER (NOT b) AS n_bad_lon, round(count(*) FILTER (a AND b) * 100.0 / count(*), 2) AS pct_valid FROM t
""")
def registry_bounds(spark, d):
    return registry.validate(raw_tables(spark, d))["bounds"]


@query(f"""
WITH f AS ({FULL})
SELECT section_name, count(*) AS n, round(avg(share_women), 6) AS mean, round(median(share_women), 6) AS median,
  round(stddev_samp(share_women), 6) AS sd, round(avg(share_women) - (SELECT avg(share_women) FROM f), 6) AS deviation,
  section_name AS label
FROM f GROUP BY 1 HAVING count(*) >= 20
""")
def registry_sector_profile(spark, d):
    return explore.sector_profile(full(spark, d).select("section_name", "share_women").persist(), min_n=20)


@query(f"""
SELECT section_name = 'INDUSTRIA MANUFACTURERA' AS industry, section_name = 'COMERCIO' AS trade,
  section_name = 'SALUD HUMANA' AS health, count(*) AS n, count(*) FILTER (export_quintile > 0) AS events,
  round(count(*) FILTER (export_quintile > 0) * 100.0 / count(*), 4) AS rate
FROM ({FULL}) GROUP BY 1, 2, 3 HAVING count(*) > 20
""")
def registry_export_rates(spark, d):
    rows = hypotheses.exporter_data(full(spark, d)).select(
        (F.col("industry") == "Industria").alias("industry"),
        (F.col("trade") == "Comercio").alias("trade"),
        (F.col("health") == "Salud").alias("health"),
        "exporter",
    )
    return stats.rate_by(rows, ["industry", "trade", "health"], F.col("exporter") == "Exportador", 20, 4)


@query(f"""
WITH g AS (SELECT province, area_name, region, count(*) AS n, avg(share_women) AS m FROM ({FULL}) GROUP BY 1, 2, 3 HAVING count(*) >= 5)
SELECT province, area_name, n, CASE WHEN m > (SELECT median(m) FROM g) THEN 'Alta' ELSE 'Baja' END AS high_women FROM g
""")
def registry_area_targets(spark, d):
    rows = full(spark, d)
    areas = stats.area_profile(
        rows,
        ["province", "area_name", "region"],
        "share_women",
        "section",
        F.col("is_exporter"),
        F.col("size_class") == "Pequeña",
        5,
    )
    return hypotheses.median_split(areas, "mean_share", "high_women").select(
        "province", "area_name", "n", "high_women"
    )


PANEL = ("share_women", "size_mid", "export_quintile")
PANEL_ROWS = 2000


@query(
    f"WITH s AS (SELECT * FROM ({FULL}) ORDER BY md5(concat_ws('|', '42', owner_id, branch, \"year\")) LIMIT {PANEL_ROWS}) "
    + " UNION ALL ".join(f"SELECT '{a}' AS var1, '{b}' AS var2, round(corr({a}, {b}), 3) AS r FROM s" for a in PANEL for b in PANEL if a != b)
    + " UNION ALL "
    + " UNION ALL ".join(f"SELECT '{c}', '{c}', 1.0::DOUBLE" for c in PANEL)
)
def registry_pairs_panel(spark, d):
    """Correlations of the panel, over a sample of fixed size as the analysis has it."""
    return explore.pairs_panel(full(spark, d), PANEL, PANEL_ROWS)[0]


@query()
def registry_hypotheses(spark, d):
    rows = full(spark, d).persist()
    areas = hypotheses.geography_data(rows, min_n=2)
    results = {}
    for name, data, spec, said, algorithm in (
        ("H1", hypotheses.exporter_data(rows), hypotheses.EXPORTER, "Random Forest", "forest"),
        ("H2", areas, hypotheses.GEOGRAPHY, "Logistic Regression", "logit"),
        ("H3", hypotheses.health_data(rows), hypotheses.HEALTH, "Random Forest", "forest"),
    ):
        outcome = hypotheses.run(data, spec, said, algorithm)
        results[name] = outcome.metrics
        outcome.release()
    rows.unpersist()
    return hypotheses.hypothesis_table(results)


@query()
def registry_model_comparison(spark, d):
    rows = hypotheses.gender_data(full(spark, d)).persist()
    out = hypotheses.compare(rows, hypotheses.GENDER, replace(hypotheses.GENDER, scale=True))
    rows.unpersist()
    return out


@query()
def registry_reduced_forest(spark, d):
    rows = hypotheses.gender_data(full(spark, d)).persist()
    try:
        outcome = hypotheses.run(rows, hypotheses.GENDER_REDUCED, "Random_Forest")
        outcome.release()
        return outcome.metrics
    finally:
        rows.unpersist()


@query()
def registry_clusters(spark, d):
    rows = kept(full(spark, d).select(*explore.SECTOR_INPUT))  # passed over twice
    groups = explore.sector_features(rows, min_n=20).persist()
    assigned, _, _ = explore.cluster_sectors(groups, k=3, nstart=25)
    return explore.cluster_report(assigned)
