"""Declared checks with a failing row each, and sheets read from made files."""

import zipfile

import pytest

from sparkledger.operators.constraints import checked
from sparkledger.sources import sheets


def test_each_kind_of_check_passes_fails_and_may_not_apply(spark):
    people = spark.createDataFrame([(1, "Ann", 30, 7), (2, None, 200, 7), (3, "b", None, 9), (3, "Cy", -1, None)], "id int, name string, age int, team int")
    teams = spark.createDataFrame([(7,), (8,), (None,)], "team int")
    tables = {"people": people, "teams": teams, "none": people.limit(0)}
    own = {"table": "people", "key": "id"}
    checks = [
        {"id": "a", "kind": "not_null", "column": "name", **own}, {"id": "b", "kind": "interval", "column": "age", "low": 0, "high": 150, **own}, {"id": "c", "kind": "pattern", "column": "name", "pattern": "^[A-Z]", **own},
        {"id": "d", "kind": "holds", "expression": "age < 40", **own}, {"id": "e", "kind": "unique", "table": "people", "columns": ["id"]}, {"id": "f", "kind": "foreign_key", "table": "people", "column": "team", "to": "teams", "target": "team"},
        {"id": "g", "kind": "cardinality", "table": "people", "column": "team", "of": "teams", "parent": "team", "low": 1, "high": 1}, {"id": "h", "kind": "not_null", "column": "id", **own}, {"id": "i", "kind": "unique", "table": "none", "columns": ["id"]},
        {"id": "j", "kind": "not_null", "column": "name", "where": "age > 500", **own}, {"id": "k", "kind": "foreign_key", "table": "none", "column": "team", "to": "teams", "target": "team"}, {"id": "l", "kind": "interval", "column": "age", "low": -1, **own},
    ]
    got = {r["check"]: tuple(r)[2:] for r in checked(tables, checks).collect()}
    assert got == {
        "a": (4, 1, "fail", ["2"]), "b": (3, 2, "fail", ["2", "3"]), "c": (3, 1, "fail", ["3"]), "d": (4, 2, "fail", ["2", "3"]), "e": (3, 1, "fail", ["3"]), "f": (3, 1, "fail", ["9"]), "g": (2, 2, "fail", ["7", "8"]), "h": (4, 0, "pass", []),
        "i": (0, 0, "not_applicable", []), "j": (0, 0, "not_applicable", []), "k": (0, 0, "not_applicable", []), "l": (3, 0, "pass", []),
    }
    with pytest.raises(ValueError, match="one id"):
        checked(tables, [checks[0], checks[0]])
    with pytest.raises(ValueError, match="kind of check"):
        checked(tables, [{"id": "x", "kind": "odd", "table": "people"}])


def workbook(path, made, strings=()):
    """made: name -> XML of the rows."""
    main, rel = "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    with zipfile.ZipFile(path, "w") as book:
        book.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets>' + "".join(f'<sheet name="{n}" sheetId="{k}" r:id="rId{k}"/>' for k, n in enumerate(made, 1)) + "</sheets></workbook>")
        links = "".join(f'<Relationship Id="rId{k}" Type="t" Target="{"/xl/" if k % 2 else ""}worksheets/sheet{k}.xml"/>' for k in range(1, len(made) + 1))
        book.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{links}</Relationships>')
        for k, rows in enumerate(made.values(), 1):
            book.writestr(f"xl/worksheets/sheet{k}.xml", f'<worksheet xmlns="{main}"><sheetData>{rows}</sheetData></worksheet>')
        if strings:
            book.writestr("xl/sharedStrings.xml", f'<sst xmlns="{main}">' + "".join(f"<si>{s}</si>" for s in strings) + "</sst>")


def test_sheets_with_shared_strings_and_gaps(spark, tmp_path):
    strings = ["<t>Primer name</t>", "<t>Sequence (5'-3')</t>", "<r><t>P</t></r><r><t>1</t></r><rPh><t>no</t></rPh>", "<t>ACGT</t>"]
    first = (
        '<row r="1"><c r="A1" t="inlineStr"><is><t>Table 2</t></is></c></row>'
        '<row r="3"><c r="B3" t="s"><v>0</v></c><c r="C3" t="s"><v>1</v></c></row>'
        '<row r="4"><c r="B4" t="s"><v>2</v></c><c r="C4" t="s"><v>3</v></c></row>'
        '<row r="6"><c r="B6" t="str"><v> P2 </v></c></row>'
        '<row><c/><c t="inlineStr"><is><t>P1</t></is></c><c><v>12.5</v></c></row>'
        '<row r="9"><c r="AB9" t="b"><v>1</v></c></row><row r="10"><c r="B10" t="inlineStr"><is><t>  </t></is></c></row>'
    )
    workbook(f"{tmp_path}/a.xlsx", {"Sheet1": first, "Notes": '<row r="1"><c r="A1"><v>1</v></c></row>'}, strings)
    workbook(f"{tmp_path}/b.xlsx", {"引物": '<row r="1"><c r="A1" t="inlineStr"><is><t>引物</t></is></c><c r="B1" t="inlineStr"><is><t>序列</t></is></c></row><row r="2"><c r="A2" t="inlineStr"><is><t>x</t></is></c><c r="B2" t="inlineStr"><is><t>y</t></is></c></row>'})
    (tmp_path / "broken.xlsx").write_bytes(b"no workbook")
    cells = sheets.read_cells(spark, f"file://{tmp_path}")
    placed = {(r["row"], r["col"]): r["value"] for r in cells.where("sheet = 'Sheet1'").collect()}
    assert placed == {(1, 1): "Table 2", (3, 2): "Primer name", (3, 3): "Sequence (5'-3')", (4, 2): "P1", (4, 3): "ACGT", (6, 2): " P2 ", (7, 2): "P1", (7, 3): "12.5", (9, 28): "TRUE", (10, 2): "  "}
    rows = sheets.tables_in(cells, {"name": "primer|引物", "sequence": "sequence|序列"}, keys=["name"]).orderBy("path", "row").collect()
    assert [(r["locator"], r["problem"], r["name"], r["sequence"]) for r in rows] == [
        ("Sheet1!B4:C4", None, "P1", "ACGT"), ("Sheet1!B6:C6", "EMPTY_CELL", "P2", None), ("Sheet1!B7:C7", "REPEATED_KEY", "P1", "12.5"), ("引物!A2:B2", None, "x", "y"),
    ]
    assert sheets.column_number("AB") == 28 and cells.where("sheet = 'Notes' AND sheet_no = 1").count() == 1
