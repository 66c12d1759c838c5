"""Register files with unreadable rows."""

import json

import pytest

from padron.plans.register import standardise_register
from padron.sources.register import BAD_ID, MALFORMED, NO_ID, scan_register

HEADER = "ID_EMPRESA;NIF;NOMBRE;UTE;nota"


def written(tmp_path, *files):
    folder = tmp_path / "register"
    folder.mkdir()
    for i, lines in enumerate(files):
        (folder / f"{i}.csv").write_text("\n".join(lines) + "\n")
    return str(folder)


def test_lines_that_do_not_fit_are_set_aside(spark, tmp_path):
    path = written(tmp_path, [HEADER, "1;12345678Z;Acme, S.L.;S;x", "2;;Norte;;", "3;a;b", "4;a;b;c;d;e;f", ";a;b;N;", "x5;a;b;N;"], [HEADER, " 6 ;b;Sur;N;", '7;b;"a;b";N;'])
    scan = scan_register(spark, path)
    assert sorted(map(tuple, scan.rows.collect())) == [(1, "12345678Z", "Acme, S.L.", "S"), (2, None, "Norte", None), (6, "b", "Sur", "N"), (7, "b", "a;b", "N")]
    assert {r.reason: r.n for r in scan.reasons().collect()} == {MALFORMED: 2, NO_ID: 1, BAD_ID: 1}
    records = {r.reason: (r.record, r.file) for r in scan.rejected.filter(f"reason <> '{MALFORMED}'").collect()}
    assert json.loads(records[BAD_ID][0])["ID_EMPRESA"] == "x5" and records[BAD_ID][1].endswith("0.csv")
    assert {r.record for r in scan.rejected.filter(f"reason = '{MALFORMED}'").collect()} == {"3;a;b", "4;a;b;c;d;e;f"}
    assert standardise_register(scan.rows).filter("ID_EMPRESA = 1").first().valid_nif


def test_a_file_without_a_column_is_an_error(spark, tmp_path):
    path = written(tmp_path, ["ID_EMPRESA;NIF;Name", "1;a;b"])
    with pytest.raises(ValueError, match="NOMBRE, UTE"):
        scan_register(spark, path)
    names = {"ID_EMPRESA": "ID_EMPRESA", "NIF": "NIF", "Name": "NOMBRE"}
    with pytest.raises(ValueError, match="UTE"):
        scan_register(spark, path, names=names)
    with pytest.raises(ValueError, match="spreadsheet"):
        scan_register(spark, path, "spreadsheet")


def test_parquet_with_numbers_and_nulls(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.createDataFrame([(1, "a", "b", None, 5), (None, "c", "d", "S", 6)], "id long, NIF string, NOMBRE string, UTE string, _record int").write.parquet(path)
    scan = scan_register(spark, path, "parquet", {"id": "ID_EMPRESA", "NIF": "NIF", "NOMBRE": "NOMBRE", "UTE": "UTE"})
    assert [tuple(r) for r in scan.rows.collect()] == [(1, "a", "b", None)]
    assert [(r.reason, json.loads(r.record)["NIF"]) for r in scan.rejected.collect()] == [(NO_ID, "c")]


def test_only_a_header(spark, tmp_path):
    scan = scan_register(spark, written(tmp_path, [HEADER]))
    assert scan.rows.count() == 0 and scan.reasons().count() == 0
