"""Quoted line breaks in files that are cut anywhere."""

import random

import pytest

from padronix.sources import files, quoted

TEXT = 'id,name,note\n1,"x ""y"" z",plain\n2,"two\nlines, and\n\na comma",NA\r\n3,"a\r\nb","""\n"""\n\n4, año ,"last\n"\n5,,end'


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture
def cut(spark):
    """Files are cut at every multiple of a number of bytes."""
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = [spark.conf.get(k) for k in keys]

    def at(size):
        spark.conf.set(keys[0], str(size))
        spark.conf.set(keys[1], "0")

    yield at
    for k, v in zip(keys, old, strict=True):
        spark.conf.set(k, v)


@pytest.mark.parametrize("encoding", ["utf-8", "latin-1"])
def test_cuts_at_every_offset_change_nothing(spark, tmp_path, cut, encoding):
    (tmp_path / "a.csv").write_bytes(TEXT.encode(encoding))
    want = rows(files.read_csv_safe(spark, str(tmp_path / "a.csv")))
    assert len(want) == 5 and ("2", "two\nlines, and\n\na comma", None) in want
    for size in (1, 3, 40):
        cut(size)
        got = quoted.read_quoted_csv(spark, str(tmp_path / "a.csv"))
        assert got.columns == ["id", "name", "note"] and rows(got) == want


def test_random_files_in_a_folder(spark, tmp_path, cut):
    rng = random.Random(5)
    for n in range(3):
        body = ['"k\n1",v']
        for i in range(60):
            field = "".join(rng.choice(["a", '""', "\n", ",", " b"]) for _ in range(rng.randint(1, 9)))
            body.append(f'{n}-{i},"x{field}x"')
        (tmp_path / f"{n}.csv").write_text("\n".join(body) + "\n")
    want = rows(files.read_csv_safe(spark, str(tmp_path)))
    cut(100)
    got = quoted.read_quoted_csv(spark, str(tmp_path))
    assert got.columns == ["k\n1", "v"] and len(want) == 180 and rows(got) == want


def test_plain_open_and_missing_files(spark, tmp_path):
    (tmp_path / "plain.csv").write_text('a,b\n1,"x, y"\n2,z\n')
    df = quoted.read_quoted_csv(spark, str(tmp_path / "plain.csv"))
    assert rows(df) == [("1", "x, y"), ("2", "z")]
    (tmp_path / "open.csv").write_text('a,b\n1,"x\n2,z\n')
    with pytest.raises(ValueError, match=r"open\.csv"):
        quoted.read_quoted_csv(spark, str(tmp_path / "open.csv"))
    (tmp_path / "latin.csv").write_bytes("a\naño\n".encode("latin-1"))
    with pytest.raises(UnicodeError):
        quoted.read_quoted_csv(spark, str(tmp_path / "latin.csv"), encodings=["UTF-8"])
    with pytest.raises(FileNotFoundError):
        quoted.read_quoted_csv(spark, str(tmp_path / "none.csv"))
