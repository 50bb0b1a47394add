"""Reading under several encodings, manifests, tables, reports."""

import pytest
from pyspark.sql import functions as F

from padronix.operators.quality import check_contract, contract_holds
from padronix.sources import files
from padronix.sources.contracts import CONTRACTS, PUBLIC_NAMES, public_schema, publish

TEXT = 'departamento,provincia,n\n"Ñuñoa, sur", Córdoba ,1\nAzul,NA,2\nB,,3\n'


def write(tmp_path, name, text, encoding):
    path = tmp_path / name
    path.write_bytes(text.encode(encoding))
    return str(path)


@pytest.mark.parametrize("encoding", ["utf-8", "latin-1"])
def test_csv_falls_back_to_the_next_encoding(spark, tmp_path, encoding):
    df = files.read_csv_safe(spark, write(tmp_path, "a.csv", TEXT, encoding))
    rows = {r.n: (r.departamento, r.provincia) for r in df.collect()}
    assert rows == {"1": ("Ñuñoa, sur", "Córdoba"), "2": ("Azul", None), "3": ("B", None)}
    assert {f.dataType.simpleString() for f in df.schema} == {"string"}


def test_header_alone_can_force_the_fallback(spark, tmp_path):
    df = files.read_csv_safe(spark, write(tmp_path, "h.csv", "año,tamaño\n1,2\n", "latin-1"))
    assert df.columns == ["año", "tamaño"]


def test_undecodable_and_missing_files(spark, tmp_path):
    with pytest.raises(UnicodeError):
        files.read_csv_safe(spark, write(tmp_path, "b.csv", TEXT, "latin-1"), encodings=["UTF-8"])
    with pytest.raises(FileNotFoundError):
        files.read_csv_safe(spark, str(tmp_path / "none.csv"))


def test_manifest_and_sizes(spark, tmp_path):
    path = write(tmp_path, "a.csv", TEXT, "utf-8")
    tables = files.load_tables(spark, {"one": path, "two": path})
    sizes = {tuple(r) for r in files.table_sizes(tables).collect()}
    assert sizes == {("one", 3, 3), ("two", 3, 3)}


def test_partitioned_table_prunes(spark, tmp_path):
    path = str(tmp_path / "t")
    files.write_table(spark.range(10).withColumn("year", (F.col("id") % 2 + 2021).cast("int")), path, ["year"])
    kept = files.read_table(spark, path).where("year = 2022")
    assert kept.count() == 5
    assert "PartitionFilters: [isnotnull(year" in kept._jdf.queryExecution().executedPlan().toString()


def test_report_is_one_file_with_a_header(spark, tmp_path):
    path = str(tmp_path / "r")
    files.write_report(spark.range(100).repartition(8).withColumn("x", F.lit(0.5)), path)
    assert len(list((tmp_path / "r").glob("part-*.csv"))) == 1
    back = files.read_report(spark, path, "id long, x double")
    assert back.count() == 100 and back.columns == ["id", "x"]


def test_report_in_many_files(spark, tmp_path):
    files.write_report(spark.range(100).repartition(4), str(tmp_path / "big"), one_file=False)
    assert len(list((tmp_path / "big").glob("part-*.csv"))) == 4


def test_quotes_and_line_breaks_are_read(spark, tmp_path):
    text = 'id,name\n1,"x ""y"" z"\n2,"two\nlines, and a comma"\n3,plain\n'
    for encoding in ("utf-8", "latin-1"):
        df = files.read_csv_safe(spark, write(tmp_path, f"q-{encoding}.csv", text + "4,año\n", encoding))
        assert {r.id: r.name for r in df.collect()} == {"1": 'x "y" z', "2": "two\nlines, and a comma", "3": "plain", "4": "año"}


def test_reports_round_trip_quotes(spark, tmp_path):
    rows = [(1, 'a "b" c'), (2, "x, y"), (3, "p\nq"), (4, "\\"), (5, 'ends with "')]
    files.write_report(spark.createDataFrame(rows, "id long, t string"), str(tmp_path / "q"))
    assert sorted(map(tuple, files.read_report(spark, str(tmp_path / "q"), "id long, t string").collect())) == rows
    part = next((tmp_path / "q").glob("part-*.csv")).read_text()
    assert '"a ""b"" c"' in part


def test_contracts(spark):
    assert {n: len(s) for n, s in CONTRACTS.items()} == {
        "actividades": 6, "departamentos": 4, "depto_actividad": 12, "establecimientos": 11,
    }
    df = spark.createDataFrame([(1, 2)], "clae6 int, other int")
    status = {r.column: r.status for r in check_contract(df, CONTRACTS["actividades"].names, "actividades").collect()}
    assert status["clae6"] == "ok" and status["letra"] == "missing" and status["other"] == "extra"
    assert not contract_holds(df, CONTRACTS["actividades"].names)
    assert publish(df).columns == ["activity_code", "other"]
    for schema in CONTRACTS.values():
        assert set(public_schema(schema).names) <= set(PUBLIC_NAMES.values()) | {"lat", "lon"}
