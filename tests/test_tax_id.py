from helpers import many, one

from padron.functions import tax_id
from padron.operators.classify import decode_cif


def test_dni_codes(spark):
    ids = ["12345678z", "12345678a", "1234567z", "x2345678z", "1234x678z", "00000000t", "k1234567l", "k0000000t"]
    assert many(spark, ids, tax_id.dni_code) == [1, -4, -1, -2, -3, -3, 1, -3]


def test_nie_codes(spark):
    assert many(spark, ["x1234567l", "y1234567x", "w1234567l", "x123456al", "x1234567"], tax_id.nie_code) == [1, 1, -2, -3, -1]


def test_cif_codes(spark):
    ids = ["a58818501", "b5881850a", "p2807900b", "q0000000j", "i58818501", "a69000001", "a8900000x", "a5881850", "a58818502", "n0032484h"]
    assert many(spark, ids, tax_id.cif_code) == [1, -4, 1, -3, -2, -5, -5, -1, -4, 1]


def test_control_is_letter_digit_or_either(spark):
    # control number 1 is the letter a
    assert many(spark, ["a58818501", "a5881850a", "p58818501", "p5881850a", "g58818501", "g5881850a"], tax_id.cif_code) == [1, -4, -4, 1, 1, 1]


def test_type_and_validity(spark):
    ids = ["a58818501", "12345678z", "x1234567l", "nonsense", "", None]
    assert many(spark, ids, tax_id.id_type) == ["CIF", "DNI", "NIE", None, None, None]
    assert many(spark, ids, tax_id.is_valid_id) == [True, True, True, False, False, False]
    assert many(spark, ["A-58.818.501"], lambda c: tax_id.valid_or_null(tax_id.normalise_id(c))) == ["a58818501"]


def test_correction_inserts_one_zero(spark):
    ids = ["1234567l", "01234567l", "12345678a", "p280790b", "", None, "---"]
    assert many(spark, ids, lambda c: tax_id.correct_id(tax_id.normalise_id(c))) == ["01234567l", "01234567l", None, None, None, None, None]


def test_decode(spark):
    df = spark.createDataFrame([("u28123456",), ("a58818501",), ("x",), (None,)], "ID string")
    got = {r.ID: (r.Province, r.CompanyType, r.CompanyDescription) for r in decode_cif(df).collect()}
    assert got["a58818501"] == ("Barcelona", "s.a.", "Sociedades anónimas")
    assert got["x"] == got[None] == (None, None, None)


def test_error_text(spark):
    assert one(spark, -5, lambda c: tax_id.error_text(c, "cif"), "int") == "Error in cif: wrong province code."
    assert one(spark, 1, lambda c: tax_id.error_text(c, "cif"), "int") is None
