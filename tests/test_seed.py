"""Seed files: types, quoting, ragged rows, line breaks, sizes."""

import csv
import io
import random
import re
from collections import Counter
from datetime import date
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException

from frames import collected
from tablewright import Check, CheckFailed, ColumnSpec, SeedError, SpecError, TableSpec, read_seed, run_seed

COUNTRIES = (ColumnSpec("code", "string", primary_key=True), ColumnSpec("POPULATION", "bigint"))


def write(tmp_path, text, name="seed.csv"):
    path = tmp_path / name
    path.write_bytes(text.encode())
    return str(path)


def test_types_quotes_backslashes_and_empty_cells(spark, tmp_path):
    path = write(tmp_path, 'code, population ,note\nNL,17900000,"it\'s ""so"""\nDE,,a\\b\n,5,\n"","",""\n')
    got = read_seed(spark, path, TableSpec("t", COUNTRIES))
    assert got.dtypes == [("code", "string"), ("population", "bigint"), ("note", "string")]
    assert collected(got) == Counter(
        [("NL", 17900000, 'it\'s "so"'), ("DE", None, "a\\b"), ("", 5, ""), ("", None, "")]
    )


def test_ragged_rows_blank_lines_and_spaces(spark, tmp_path):
    path = write(tmp_path, "a,b,c\n1\n\n1,2,3,4\n x , y ,z\n")
    got = read_seed(spark, path, TableSpec("t"))
    assert collected(got) == Counter([("1", "", ""), ("1", "2", "3"), (" x ", " y ", "z")])


def test_many_types(spark, tmp_path):
    columns = (
        ColumnSpec("d", "date"),
        ColumnSpec("m", "decimal(10,2)"),
        ColumnSpec("b", "boolean"),
        ColumnSpec("x", "double"),
        ColumnSpec("t", "text"),
        ColumnSpec("v", "varchar(3)"),
        ColumnSpec("c", "char(3)"),
    )
    path = write(tmp_path, "d,m,b,x,t,v,c\n2024-02-29,1.50,true,1e3,,ab ,a\n,,,,,,\n")
    got = read_seed(spark, path, TableSpec("t", columns))
    assert collected(got) == Counter(
        [
            (date(2024, 2, 29), Decimal("1.50"), True, 1000.0, "", "ab ", "a  "),
            (None, None, None, None, "", "", "   "),
        ]
    )


def test_too_long_for_its_type(spark, tmp_path):
    path = write(tmp_path, "v\nabcd\n")
    with pytest.raises(PySparkException, match="longer than"):
        read_seed(spark, path, TableSpec("t", (ColumnSpec("v", "varchar(3)"),))).collect()


def test_bad_cells(spark, tmp_path):
    path = write(tmp_path, "code,population\nNL,many\n")
    with pytest.raises(PySparkException):
        read_seed(spark, path, TableSpec("t", COUNTRIES)).collect()
    got = read_seed(spark, path, TableSpec("t", COUNTRIES), on_bad_cell="null")
    assert collected(got) == Counter([("NL", None)])
    with pytest.raises(SpecError):
        read_seed(spark, path, TableSpec("t"), on_bad_cell="skip")


def test_header_only_is_an_empty_table_and_nothing_is_an_error(spark, tmp_path):
    assert read_seed(spark, write(tmp_path, "a,b\n"), TableSpec("t")).count() == 0
    with pytest.raises(SeedError, match="empty"):
        read_seed(spark, write(tmp_path, "", "empty.csv"), TableSpec("t"))
    with pytest.raises(SeedError, match="twice"):
        read_seed(spark, write(tmp_path, "a,A\n1,2\n", "twice.csv"), TableSpec("t"))
    with pytest.raises(SeedError, match="without a name"):
        read_seed(spark, write(tmp_path, "a,\n1,2\n", "unnamed.csv"), TableSpec("t"))


def random_cells(seed, count):
    rng = random.Random(seed)
    pieces = ["a", "b,c", '"', "\n", "\n\n", "é", " ", "'", "\\", '""\n"', "line\nline"]
    return [
        ["".join(rng.choice(pieces) for _ in range(rng.randrange(6))) for _ in range(3)]
        for _ in range(count)
    ]


@pytest.mark.parametrize("split", [None, 64, 700])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_line_breaks_inside_cells(spark, tmp_path, split, end):
    """Read file by file, or put together over splits smaller than a record."""
    cells = random_cells(3, 120)
    cells = [row for row in cells if any(row)]
    paths = []
    for i, chunk in enumerate((cells[:70], cells[70:])):
        out = io.StringIO()
        writer = csv.writer(out, lineterminator="\n", quoting=csv.QUOTE_ALL)
        writer.writerow(["first\nname", "b", "c"])
        writer.writerows(chunk)
        paths.append(write(tmp_path, out.getvalue().replace("\n", end), f"{i}.csv"))
    if split:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = read_seed(spark, paths, TableSpec("t"))
        assert got.columns == ["first\nname", "b", "c"]
        assert collected(got) == Counter(tuple(row) for row in cells)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_open_quote_over_splits_is_an_error(spark, tmp_path):
    path = write(tmp_path, 'a,b\n1,"x\n' + "2,3\n" * 50)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        with pytest.raises(Exception, match="never closed"):
            read_seed(spark, path, TableSpec("t")).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_seed_replaces_its_table_and_checks_it(spark, store, tmp_path):
    name = f"{store.schema}.countries"
    columns = (
        ColumnSpec("code", "string", primary_key=True, checks=(Check("not_null"), Check("unique"))),
        ColumnSpec("population", "bigint", checks=(Check("positive"),)),
    )
    spec = TableSpec(name, columns)
    run_seed(store, spec, write(tmp_path, "code,population\nNL,1\nDE,2\n"))
    got = run_seed(store, spec, write(tmp_path, "code,population\nFR,3\n", "b.csv"))
    assert collected(got) == Counter([("FR", 3)])
    with pytest.raises(CheckFailed, match="population positive: 2 rows; code unique: 1 rows"):
        run_seed(store, spec, write(tmp_path, "code,population\nFR,0\nFR,-1\n", "c.csv"))


def test_many_rows(spark, tmp_path):
    path = write(tmp_path, "value\n" + "".join(f"{i}\n" for i in range(501)))
    got = read_seed(spark, path, TableSpec("t", (ColumnSpec("value", "int"),)))
    assert got.selectExpr("count(*)", "sum(value)").first()[:] == (501, 501 * 250)


@pytest.mark.parametrize("split", [None, 64, 1000])
def test_a_bare_quote_is_refused_however_the_file_is_split(spark, tmp_path, split):
    lines = [f"{i},plain" for i in range(60)]
    for bad in ('7,5" pipe', '7,"a"b', '7,a"', '7,"a" '):
        path = write(tmp_path, "a,b\n" + "\n".join([*lines[:20], bad, *lines[20:], bad]) + "\n", f"{split}{hash(bad)}.csv")
        if split:
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
            spark.conf.set("spark.sql.files.openCostInBytes", "0")
        try:
            with pytest.raises(SeedError, match="not doubled"):
                read_seed(spark, path, TableSpec("t"))
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")


def test_files_with_other_headers_are_refused(spark, tmp_path):
    for tail in ("", '3,"x\ny"\n'):
        one = write(tmp_path, "id,t\n1,2\n" + tail, "one.csv")
        same = write(tmp_path, "id, t\n8,9\n", "same.csv")
        assert read_seed(spark, [one, same], TableSpec("t")).count() == 2 + bool(tail)
        for header in ("t,id", "id", "id,t,u"):
            other = write(tmp_path, f"{header}\n8,9\n", "other.csv")
            with pytest.raises(SeedError, match="different headers"):
                read_seed(spark, [one, other], TableSpec("t"))


def test_bad_cells_raise_whatever_the_session_says(spark, tmp_path):
    path = write(tmp_path, "code,population\nNL,many\n")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(PySparkException, match="does not fit"):
            read_seed(spark, path, TableSpec("t", COUNTRIES)).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


RETURNS = "id,t\n1,a\rb\n2,\"c\rd\"\r\n3,e\r\r\n4,\r"


@pytest.mark.parametrize("split", [None, 9])
@pytest.mark.parametrize("more", ["", '\n5,"two\r\nlines"\n', "\n6,x\n"])
def test_carriage_returns_belong_to_cells(spark, tmp_path, more, split):
    """The same rows alone, beside records of several lines, and in any splits."""
    path = write(tmp_path, RETURNS + more)
    setting = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(setting)
    try:
        if split:
            spark.conf.set(setting, str(split))
        got = collected(read_seed(spark, path, TableSpec("t")))
    finally:
        spark.conf.set(setting, before)
    want = [("1", "a\rb"), ("2", "c\rd"), ("3", "e\r"), ("4", "")]
    want += {"": [], '\n5,"two\r\nlines"\n': [("5", "two\nlines")], "\n6,x\n": [("6", "x")]}[more]
    assert got == Counter(want)


def test_returns_without_line_feeds_make_one_line(spark, tmp_path):
    got = read_seed(spark, write(tmp_path, "a,b\r1,2\r"), TableSpec("t"))
    assert got.columns == ["a", "b\r1", "2"] and got.collect() == []


def test_plain_lines_with_inner_returns(spark, tmp_path):
    path = write(tmp_path, "id,t\n1,a\rb\n2,\rc\n3,\"x\ry\"\n")
    assert collected(read_seed(spark, path, TableSpec("t"))) == Counter([("1", "a\rb"), ("2", "\rc"), ("3", "x\ry")])


def test_lines_across_rows_are_counted_once(spark, tmp_path):
    path = write(tmp_path, 'a,b\n1,"x\ny"\n2,"p,""q""\n\nr"\n3,z\n')
    got = read_seed(spark, path, TableSpec("t", (ColumnSpec("a", "int"),)))
    assert collected(got) == Counter([(1, "x\ny"), (2, 'p,"q"\n\nr'), (3, "z")])
    # the quote check and the header check read the same counted lines as the rows do
    assert "Window" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_lines_are_counted_where_they_are_read(spark, tmp_path, monkeypatch):
    from pyspark.sql import DataFrameWriter

    body = "".join(f'{i},"a\n""{i}""\n\nb",{i}\n' for i in range(60))
    path = write(tmp_path, "id,text,n\n" + body)
    plans = []
    real = DataFrameWriter.parquet

    def seen(self, *args, **kwargs):
        plans.append(self._df._jdf.queryExecution().optimizedPlan().toString())
        return real(self, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", seen)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50")
    try:
        got = collected(read_seed(spark, path, TableSpec("t", (ColumnSpec("id", "int"),))))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == Counter((i, f'a\n"{i}"\n\nb', str(i)) for i in range(60))
    # no window over the lines of a block: they are not shuffled to be counted
    assert plans and not any(re.search(r"\], \[file#\d+L?, block#\d+L?\], \[", plan) for plan in plans)


def test_small_splits_share_tasks(spark, store, tmp_path, monkeypatch):
    """Files of many splits: as many blocks, few tasks, for the lines, their copy and the written table."""
    from tablewright.plans import sizing
    from tablewright.sources import seed

    monkeypatch.setattr(sizing, "_TASKS_PER_CORE", 1, raising=False)
    body = "".join(f'{i},"a\n""{i}""\n\nb",{i}\n' for i in range(300))
    path = write(tmp_path, "id,text,n\n" + body)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50")
    try:
        lines = seed._lines(spark, path)
        assert lines.select("block").distinct().count() > 50
        assert lines.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
        spec = TableSpec(f"{store.schema}.split", (ColumnSpec("id", "int"),))
        got = run_seed(store, spec, path)
        (part,) = store.state(spec.name).parts
        assert part.rows == 300
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert collected(got) == Counter((i, f'a\n"{i}"\n\nb', str(i)) for i in range(300))
