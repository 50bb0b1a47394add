"""The establishment registry from raw tables to one integrated table, and its reports."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from padronix.functions.text import plain
from padronix.functions.values import recode, safe_ratio, three_way, to_int
from padronix.operators import quality
from padronix.operators.cleaning import apply_rules, canonicalize, conform, dedupe, squish_columns, unmapped
from padronix.operators.joins import integrate, orphan_keys, orphan_summary
from padronix.operators.spelling import match_names
from padronix.sources.contracts import CONTRACTS, public_schema, publish
from padronix.sources.files import write_report, write_table
from padronix.sources.published import publish_partitions

# Spellings and their canonical names.
PROVINCE_RULES = [
    ("^Buenos Aires$", "Buenos Aires"),
    ("^CABA$|^Ciudad|^Capital", "CABA"),
    ("^Cordoba$|^Córdoba$", "Córdoba"),
    ("^Entre Rios$", "Entre Ríos"),
    ("^Neuquen$", "Neuquén"),
    ("^Rio Negro$", "Río Negro"),
    ("^Santa Fe$", "Santa Fe"),
    ("^Tucuman$", "Tucumán"),
]
GENDER_RULES = [
    ("^varones?$|^hombres?$|^masculino$|^m$", "Varones"),
    ("^mujeres?$|^femenino$|^f$", "Mujeres"),
]
# Size labels with midpoint and class, export classes by quintile, regions by province.
SIZE_MIDPOINTS = {
    "a. 1-9": 5.0,
    "b. 10-49": 29.5,
    "c. 50-99": 74.5,
    "d. 100-199": 149.5,
    "e. 200-499": 349.5,
    "f. 500 y más": 750.0,
}
SIZE_CLASSES = {
    "Micro": ["a. 1-9"],
    "Pequeña": ["b. 10-49"],
    "Mediana": ["c. 50-99", "d. 100-199"],
    "Grande": ["e. 200-499", "f. 500 y más"],
}
EXPORT_CLASSES = {
    "No exporta": [0],
    "Exportador bajo": [1],
    "Exportador medio": [2, 3],
    "Exportador alto": [4, 5],
}
REGIONS = {
    "Centro": ["CABA", "Buenos Aires", "Córdoba", "Entre Ríos", "Santa Fe"],
    "Cuyo": ["Mendoza", "San Juan", "San Luis", "La Rioja"],
    "NOA": ["Catamarca", "Jujuy", "Salta", "Santiago del Estero", "Tucumán"],
    "NEA": ["Chaco", "Corrientes", "Formosa", "Misiones"],
    "Patagonia": ["Chubut", "La Pampa", "Neuquén", "Río Negro", "Santa Cruz", "Tierra del Fuego"],
}
GENDER_CLASSES = ("Predominio masculino", "Composición mixta", "Predominio femenino")
SECTIONS = list("ABCDEFGHIJKLMNOPQRSTU")
YEARS = [2021, 2022]
GENDERS = ["Varones", "Mujeres"]
LAT_RANGE, LON_RANGE = (-55.0, -21.5), (-74.0, -53.5)
NO_REGION = "Otras"


def _code_length(c: str) -> Column:
    return F.length(F.col(c).cast("string")).isin(5, 6)


def region_of(province: Column, fold_accents: bool = False) -> Column:
    """Region of a province; anything unknown is "Otras". `fold_accents` matches spellings loosely."""
    if not fold_accents:
        return recode(province, REGIONS, NO_REGION)
    folded = {
        region: [p.lower().translate(str.maketrans("áéíóúüñ", "aeiouun")) for p in names]
        for region, names in REGIONS.items()
    }
    return recode(plain(province), folded, NO_REGION)


def clean_activities(raw: DataFrame, order_by=("division_code", "section", "activity_name")) -> DataFrame:
    """Tidy text, type, keep the first row per code, then apply the validity rules (in that order)."""
    df = conform(publish(raw), public_schema(CONTRACTS["actividades"]))
    df = squish_columns(df, ["activity_name", "division_name", "section_name"])
    df = dedupe(df, ["activity_code"], order_by)
    return apply_rules(df, activity_rules())


def activity_rules() -> Mapping[str, Column]:
    return {
        "code_present": F.col("activity_code").isNotNull(),
        "division_present": F.col("division_code").isNotNull(),
        "section_present": F.col("section").isNotNull(),
        "code_length": _code_length("activity_code"),
        "division_positive": F.col("division_code") > 0,
        "section_known": F.col("section").isin(*SECTIONS),
    }


def clean_areas(raw: DataFrame, order_by=("area_name", "province")) -> DataFrame:
    """As for activities: keep-first comes before the rules, so a bad first row hides a good second."""
    df = squish_columns(publish(raw), ["area_name", "province"])
    df = canonicalize(df, "province", PROVINCE_RULES)
    df = conform(df, public_schema(CONTRACTS["departamentos"]))
    df = dedupe(df, ["province_id", "area_id"], order_by)
    return apply_rules(df, area_rules())


def area_rules() -> Mapping[str, Column]:
    return {
        "province_id": F.col("province_id").isNotNull() & (F.col("province_id") > 0),
        "area_id": F.col("area_id").isNotNull() & (F.col("area_id") > 0),
        "area_name": F.col("area_name").isNotNull(),
        "province": F.col("province").isNotNull(),
    }


def clean_area_activity(raw: DataFrame) -> DataFrame:
    """Pre-aggregated counts per area, activity and gender: rules and two guarded ratios, no keep-first."""
    df = squish_columns(publish(raw), ["area_name", "province", "gender"])
    df = canonicalize(df, "gender", GENDER_RULES, lower=True)
    df = conform(df, public_schema(CONTRACTS["depto_actividad"]))
    df = apply_rules(df, area_activity_rules())
    return df.withColumns(
        {
            "jobs_per_establishment": safe_ratio(F.col("jobs"), F.col("establishments")),
            "exporter_share": safe_ratio(F.col("exporters"), F.col("establishments")),
        }
    )


def area_activity_rules() -> Mapping[str, Column]:
    return {
        "year": F.col("year").isin(*YEARS),
        "province_id": F.col("province_id") > 0,
        "area_id": F.col("area_id") > 0,
        "code_length": _code_length("activity_code"),
        "gender": F.col("gender").isin(*GENDERS),
        "jobs": F.col("jobs") >= 0,
        "establishments": F.col("establishments") >= 0,
    }


def establishment_rules() -> Mapping[str, Column]:
    return {
        "year": F.col("year").isin(*YEARS),
        "code_length": _code_length("activity_code"),
        "province_id": F.col("province_id") > 0,
        "area_id": F.col("area_id") > 0,
        "size_label": F.col("size_label").isin(*SIZE_MIDPOINTS),
        "share_women": F.col("share_women").between(0.0, 1.0),
        "export_quintile": F.col("export_quintile").between(0, 5),
    }


def derive_establishment(df: DataFrame) -> DataFrame:
    """Size midpoint and class, exporter flag and class, gender composition."""
    midpoint = recode(F.col("size_label"), {v: [k] for k, v in SIZE_MIDPOINTS.items()})
    return df.withColumns(
        {
            "size_mid": midpoint,
            "size_class": recode(F.col("size_label"), SIZE_CLASSES, "Desconocido"),
            "is_exporter": F.col("export_quintile") > 0,
            "export_class": recode(F.col("export_quintile"), EXPORT_CLASSES, "Desconocido"),
            "gender_class": three_way(F.col("share_women"), 0.3, 0.7, GENDER_CLASSES, upper_closed=False),
        }
    )


def clean_establishments(
    raw: DataFrame,
    order_by=(
        "activity_code", "area_id", "province_id", "lat", "lon", "share_women", "export_quintile", "size_label",
    ),
) -> DataFrame:
    """Type, apply the rules, derive, then keep the first row per (owner, branch, year).

    What text decides is filtered before the casts: the labels at the scan, the years in front of the typing.
    """
    labelled = {"size_label": F.col("size_label").isin(*SIZE_MIDPOINTS), "year": to_int(F.col("year")).isin(*YEARS)}
    df = conform(apply_rules(publish(raw), labelled), public_schema(CONTRACTS["establecimientos"]))
    df = derive_establishment(apply_rules(df, establishment_rules()))
    return dedupe(df, ["owner_id", "branch", "year"], order_by)


@dataclass(frozen=True)
class Registry:
    """The cleaned tables, the integrated one, and the audit log."""

    activities: DataFrame
    areas: DataFrame
    area_activity: DataFrame | None
    establishments: DataFrame
    full: DataFrame
    audit: DataFrame
    stages: tuple[tuple[str, str, DataFrame, DataFrame], ...] = ()


def integrate_registry(establishments: DataFrame, activities: DataFrame, areas: DataFrame) -> DataFrame:
    """Drop establishments with unknown codes, then join activities, areas and region: 24 columns."""
    activity_cols = ["activity_code", "activity_name", "division_code", "division_name", "section", "section_name"]
    dims = [(activities.select(*activity_cols), ["activity_code"]), (areas, ["province_id", "area_id"])]
    full = integrate(establishments, dims, how="inner")
    return full.withColumn("region", region_of(F.col("province"), fold_accents=True))


def unmapped_provinces(full: DataFrame) -> DataFrame:
    """Provinces that no region holds under any spelling, with their rows."""
    return unmapped(full, "province", "region", NO_REGION)


def province_spellings(table: DataFrame, max_distance: int = 2) -> DataFrame:
    """Every province spelling with the nearest known province, whatever its case and accents (see `match_names`)."""
    known = [(p,) for names in REGIONS.values() for p in names]
    return match_names(table, "province", table.sparkSession.createDataFrame(known, "name string"), "name", max_distance, plain)


def build(raw: Mapping[str, DataFrame], stamp: bool = True) -> Registry:
    """Clean every raw table and integrate. Lazy: nothing runs until a result is used."""
    activities = clean_activities(raw["actividades"])
    areas = clean_areas(raw["departamentos"])
    establishments = clean_establishments(raw["establecimientos"])
    stages = [
        ("activities", "text cleaning, keep-first, rules", raw["actividades"], activities),
        ("areas", "text cleaning, keep-first, rules", raw["departamentos"], areas),
    ]
    area_activity = None
    if "depto_actividad" in raw:
        area_activity = clean_area_activity(raw["depto_actividad"])
        stages.append(("area_activity", "text cleaning, rules", raw["depto_actividad"], area_activity))
    stages.append(("establishments", "rules, keep-first", raw["establecimientos"], establishments))
    audit = quality.stack_rows([quality.audit_row(*s, stamp=stamp) for s in stages])
    full = integrate_registry(establishments, activities, areas)
    return Registry(activities, areas, area_activity, establishments, full, audit, tuple(stages))


KPI_COLUMNS = {"provinces": "province", "areas": "area_id", "activities": "activity_code", "years": "year"}


def kpis(full: DataFrame) -> DataFrame:
    return quality.quality_metrics(full, KPI_COLUMNS, "share_women", F.col("is_exporter"))


def write_registry(registry: Registry, folder: str) -> None:
    """Write the cleaned tables (facts by year), the integrated table and the reports.

    Dimensions come first. The integrated table and the audit's second counts come from the written tables, so
    cleaning runs once.
    """
    spark = registry.full.sparkSession
    written = {}
    for name, partition_by in (("activities", ()), ("areas", ()), ("area_activity", ("year",)), ("establishments", ("year",))):
        table = getattr(registry, name)
        if table is not None:
            write_table(table, f"{folder}/{name}", partition_by)
            written[name] = spark.read.schema(table.schema).parquet(f"{folder}/{name}")
    full = integrate_registry(written["establishments"], written["activities"], written["areas"])
    write_table(full, f"{folder}/establishments_full", ["year"])
    full = spark.read.schema(full.schema).parquet(f"{folder}/establishments_full")
    audit = quality.stack_rows([quality.audit_row(n, said, raw, written[n]) for n, said, raw, _ in registry.stages])
    write_table(audit, f"{folder}/audit")
    audit = spark.read.parquet(f"{folder}/audit")
    write_report(audit, f"{folder}/reports/audit")
    write_report(quality.retention(audit), f"{folder}/reports/retention")
    write_report(kpis(full), f"{folder}/reports/kpis")
    write_report(unmapped_provinces(full), f"{folder}/reports/unmapped_provinces")
    write_report(province_spellings(full).where("distance > 0 OR match IS NULL"), f"{folder}/reports/province_spellings")


def publish_years(registry: Registry, folder: str) -> dict[str, dict]:
    """Replace the years that the facts hold, other years stay; returns each table's audit counts.

    Read the tables with `published.read_published`. Each table appears at once; the integrated one comes last.
    """
    facts = {"area_activity": registry.area_activity, "establishments": registry.establishments, "establishments_full": registry.full}
    return {
        name: publish_partitions(table, f"{folder}/{name}", "year", {"no_year": F.count_if(F.col("year").isNull())})
        for name, table in facts.items()
        if table is not None
    }


def write_validation(raw: Mapping[str, DataFrame], folder: str) -> None:
    """Write every check of `validate` as a report."""
    for name, table in validate(raw).items():
        write_report(table, f"{folder}/validation/{name}")


def validate(raw: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The checks run on raw tables: contract, missing, profiles, summary, orphans, bounds and years.

    Raw columns keep their file names here; text is typed first, as the checks compare numbers.
    """
    typed = {n: conform(df, CONTRACTS[n]) for n, df in raw.items()}
    profiles = {n: quality.profile(df.select(*[c for c in CONTRACTS[n].names if c in df.columns])) for n, df in typed.items()}

    def by_table(parts: Mapping[str, DataFrame | None]) -> DataFrame:
        return quality.stack_rows([p.select(F.lit(n).alias("table"), "*") for n, p in parts.items() if p is not None])

    only = ["clae6", "provincia_id", "in_departamentos", "lat", "lon", "anio"]
    fact = conform(raw["establecimientos"].select(*only), CONTRACTS["establecimientos"])
    area_key = ["provincia_id", "in_departamentos"]
    return {
        "contract": quality.stack_rows(
            [quality.check_contract(df, CONTRACTS[n].names, n) for n, df in raw.items()]
        ),
        "missing": by_table({n: quality.missing_report(df) for n, df in raw.items()}),
        "profile_text": by_table({n: p[0] for n, p in profiles.items()}),
        "profile_numeric": by_table({n: p[1] for n, p in profiles.items()}),
        "summary": quality.validation_summary(raw),
        "orphan_activities": _orphans(fact, typed["actividades"], ["clae6"]),
        "orphan_areas": _orphans(fact, typed["departamentos"], area_key),
        "bounds": quality.bounds_check(fact, "lat", "lon", LAT_RANGE, LON_RANGE),
        "years": quality.domain_check(fact, "anio", YEARS),
    }


def _orphans(fact: DataFrame, dim: DataFrame, on: list[str]) -> DataFrame:
    return orphan_summary(orphan_keys(fact, dim, on), on)


