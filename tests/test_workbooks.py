"""Workbooks and archives as contents in tables and as data sources: merges, dates, sheet choice, errors, pushed tests."""

import datetime
import zipfile

import pytest
from ledgerline.operators import sheets
from ledgerline.sources import workbooks as W


@pytest.fixture()
def book(tmp_path):
    day = datetime.date(2024, 2, 29)
    data = W.workbook_bytes({"Data": ([["Title"], ["a", 1, 2.5, day, True, None, "x<y"]], ["A1:C1", "D2:D4"]), "Other": ([["one"]], ["A1:XFD1048576"])})
    (tmp_path / "b.xlsx").write_bytes(data)
    return str(tmp_path)


def test_cells_tags_and_merges(spark, book):
    W.register(spark)
    rows = spark.read.format("workbook").load(book).collect()
    cells = sorted((r["sheet"], r["row"], r["col"], r["value"], r["ctype"]) for r in rows if r["ctype"] != "m")
    assert cells == [("Data", 1, 1, "Title", "s"), ("Data", 2, 1, "a", "s"), ("Data", 2, 2, "1", "n"), ("Data", 2, 3, "2.5", "n"), ("Data", 2, 4, "2024-02-29", "d"), ("Data", 2, 5, "1", "b"), ("Data", 2, 7, "x<y", "s"), ("Other", 1, 1, "one", "s")]
    merges = sorted((r["sheet"], r["row"], r["col"], r["last_row"], r["last_col"]) for r in rows if r["ctype"] == "m")
    assert merges == [("Data", 1, 1, 1, 3), ("Data", 2, 4, 4, 4), ("Other", 1, 1, 1048576, 16384)]
    assert sorted(map(tuple, W.contents_of(spark.read.format("binaryFile").load(book)).drop("file").collect()), key=str) == sorted((tuple(r)[1:] for r in rows), key=str)


def test_formats_that_show_dates():
    assert [W.shows_date(f) for f in ("dd/mm/yyyy", "[h]:mm", "mmm yy", '0.0" days"', "#,##0", "General", "[Red]0.00", "0.00E+00", "[$-409]d-mmm")] == [True, True, True, False, False, False, False, False, True]


def test_one_partition_a_sheet_and_only_the_asked_one_opened(spark, book, monkeypatch):
    reader = W.WorkbookReader(book, ".xlsx", ("file", "sheet"))
    assert [p.names for p in reader.partitions()] == [("Data",), ("Other",)]
    left = list(reader.pushFilters([W.EqualTo(("sheet",), "Other"), W.EqualTo(("row",), 1)]))
    assert [f.attribute for f in left] == [("row",)]
    parts = reader.partitions()
    assert [p.names for p in parts] == [("Other",)]
    opened = []
    was = zipfile.ZipFile.open
    monkeypatch.setattr(zipfile.ZipFile, "open", lambda self, name, *a, **k: opened.append(getattr(name, "filename", name)) or was(self, name, *a, **k))
    assert sum(b.num_rows for p in parts for b in reader.read(p)) == 2
    assert "xl/worksheets/sheet2.xml" in opened and "xl/worksheets/sheet1.xml" not in opened
    W.register(spark)
    asked = spark.read.format("workbook").load(book).where("sheet = 'Other' and ctype = 's'")
    assert [r["value"] for r in asked.collect()] == ["one"]
    assert asked.rdd.getNumPartitions() == 1
    monkeypatch.setattr(W, "PLANNED", 0)
    assert [p.names for p in W.WorkbookReader(book, ".xlsx", ("file", "sheet")).partitions()] == [None]


def test_sheet_choice_and_errors(spark, book, tmp_path):
    assert W.read_workbook(spark, book, "Other").count() == 2
    with pytest.raises(Exception, match="several sheets, of which one must be named: Data, Other"):
        W.read_workbook(spark, book).count()
    with pytest.raises(Exception, match="no such sheet; there are Data, Other"):
        W.read_workbook(spark, book, "None").count()
    (tmp_path / "bad.xlsx").write_bytes(b"no zip")
    with pytest.raises(Exception, match="bad.xlsx is damaged"):
        W.read_cells(spark, book).count()


def test_archives(spark, tmp_path):
    for name in ("a", "b"):
        with zipfile.ZipFile(tmp_path / f"{name}.zip", "w") as z:
            for member in ("x.csv", "in/y.xlsx", "readme.txt"):
                z.writestr(member, name + member)
            z.mkdir("folder.csv")
    W.register(spark)
    rows = spark.read.format("archive").load(str(tmp_path))
    assert sorted((r["archive"][-5:], r["member"], r["size"], bytes(r["content"])) for r in rows.collect()) == [(f"{n}.zip", m, len(n + m), (n + m).encode()) for n in "ab" for m in ("in/y.xlsx", "x.csv")]
    assert rows.rdd.getNumPartitions() == 4
    one = rows.where("member = 'x.csv'")
    assert one.rdd.getNumPartitions() == 2 and one.count() == 2
    assert rows.where("member = 'none'").count() == 0


def naive(cells, merges):
    """Every cell of every range, opened."""
    values = {(r, c): v for r, c, v in cells}
    out = {k: (v, False) for k, v in values.items()}
    for r1, r2, c1, c2 in merges:
        for r in range(r1, r2 + 1):
            for c in range(c1, c2 + 1):
                out[r, c] = (values.get((r1, c1), ""), True)
    return out


def test_merges_meet_cells_by_ranges(spark, monkeypatch):
    monkeypatch.setattr(sheets, "BIN", 3)
    cells = [(1, 1, "t"), (2, 1, "a"), (2, 5, "b"), (7, 2, "c"), (8, 2, "d"), (20, 9, "e"), (12, 3, "h")]
    merges = [(1, 1, 1, 4), (7, 9, 2, 3), (3, 5, 4, 6), (10, 19, 1, 2)]
    given = spark.createDataFrame([("f", "s", r, c, v, "s") for r, c, v in cells], "file string, sheet string, row int, col int, value string, ctype string")
    ranges = spark.createDataFrame([("f", "s", *m) for m in merges], "file string, sheet string, first_row int, last_row int, first_col int, last_col int")
    got = {(r["row"], r["col"]): (r["value"], r["is_merged"]) for r in sheets.resolved(given, ranges).collect()}
    assert got == naive(cells, merges)
    monkeypatch.setattr(sheets, "BLANK", 2)
    got = {(r["row"], r["col"]): (r["value"], r["is_merged"]) for r in sheets.resolved(given, ranges).collect()}
    used = {r for r, *_ in cells} | {m[0] + k for m in merges for k in (0, 1)}
    assert got == {k: v for k, v in naive(cells, merges).items() if k[0] in used}


def test_a_merge_of_a_whole_sheet_costs_what_the_sheet_holds(spark):
    given = spark.createDataFrame([("f", "s", 1, 1, "all", "s"), ("f", "s", 900_000, 3, "x", "n")], "file string, sheet string, row int, col int, value string, ctype string")
    ranges = spark.createDataFrame([("f", "s", 1, 1_048_576, 1, 16_384)], "file string, sheet string, first_row int, last_row int, first_col int, last_col int")
    rows = sheets.resolved(given, ranges).collect()
    assert len(rows) == sheets.BLANK + 3 * sheets.BLANK
    assert all(r["value"] == "all" and r["is_merged"] for r in rows)
