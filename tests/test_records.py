"""CSV read by many tasks against the reader that takes a file in one task."""

import csv
import random

import pytest

from profilematch.sources.records import read_csv, read_records
from profilematch.sources.tables import read_companies

PIECES = ["a", "é", "x, y", '"', '""', "\n", "\n\n", ",", "long " * 9, "", " ", '"\n"', "'"]


def cells(seed, rows, columns=3):
    draw = random.Random(seed)
    return [["".join(draw.choice(PIECES) for _ in range(draw.randrange(5))) or "z" for _ in range(columns)] for _ in range(rows)]


def write(path, rows, header=("k", "some text", "c"), end="\n"):
    with open(path, "w", newline="", encoding="utf8") as f:
        csv.writer(f, lineterminator=end).writerows([header, *rows])


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "61")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("few", [100_000, 0])
def test_equal_to_the_one_task_reader(spark, tmp_path, small_splits, few):
    expected = []
    for i in range(3):
        expected += (rows := cells(i, 12))
        write(tmp_path / f"{i}.csv", rows)
    found = read_csv(spark, str(tmp_path), few)
    assert found.columns == ["k", "some text", "c"]
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, expected))


def test_same_as_spark_on_one_file(spark, tmp_path, small_splits):
    write(tmp_path / "a.csv", [*cells(7, 12), ["only"], ["x", "", "y"], ["1", "2", "3", "4"]])
    whole = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(str(tmp_path))
    assert sorted(map(repr, read_csv(spark, str(tmp_path)).collect())) == sorted(map(repr, whole.collect()))


def test_many_splits_in_one_cell_and_long_headers(spark, tmp_path, small_splits):
    text = "\n".join(f'line {i}, "quoted"' for i in range(30))
    write(tmp_path / "a.csv", [["1", text, "e"], ["2", "s", text]], header=("k", "a\n" + "long " * 20, "c"))
    assert sorted(r.k + r[1] + r.c for r in read_csv(spark, str(tmp_path)).collect()) == ["1" + text + "e", "2s" + text]
    assert read_records(spark, str(tmp_path)).where("first").count() == 1


def test_ends_of_lines_marks_and_empty_files(spark, tmp_path, small_splits):
    (tmp_path / "a.csv").write_bytes(b'\xef\xbb\xbfk,v\r\n1,"a\r\nb"\r\n\r\n2,c')
    (tmp_path / "b.csv").write_bytes(b"")
    (tmp_path / "c.csv").write_bytes(b"k,v\n")
    assert sorted(map(tuple, read_csv(spark, str(tmp_path)).collect())) == [("1", "a\r\nb"), ("2", "c")]
    (tmp_path / "d.csv").write_bytes(b'k,v\n1,"open\n2,3\n')
    with pytest.raises(ValueError, match="d.csv ends inside"):
        read_csv(spark, str(tmp_path))
    (tmp_path / "d.csv").write_bytes(b"k,w\n")
    with pytest.raises(ValueError, match="different headers"):
        read_csv(spark, str(tmp_path))


def test_companies_from_csv(spark, tmp_path, small_splits):
    write(tmp_path / "a.csv", [[str(i), f'n "{i}"\nx', "IT"] for i in range(12)], header=("Id", "Company name", "Company type"))
    found = read_companies(spark, str(tmp_path / "a.csv"), "csv")
    assert found.dtypes[0] == ("id", "bigint") and found.columns == ["id", "company_name", "company_type"]
    assert {r.id: r.company_name for r in found.collect()} == {i: f'n "{i}"\nx' for i in range(12)}
