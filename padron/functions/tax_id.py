"""Spanish tax IDs: DNI, NIE and CIF checks as column expressions.

Every function takes an ID already passed through ``normalise_id``, as a plain column:
an expression handed in would be worked out once per place it is used.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from padron.functions.cells import bind
from padron.sources.lookups import ENTITY_LETTERS, PROVINCE_CODES

# Control letters, leading letters and result codes.
DNI_CONTROL = "trwagmyfpdxbnjzsqvhlcke"
DNI_LETTERS = "klm"
NIE_LETTERS = "xyz"
CIF_CONTROL = "jabcdefghi"
CIF_LETTER_CONTROL = "pqrsw"
CIF_DIGIT_CONTROL = "abeh"
VALID = 1
BAD_LENGTH = -1
BAD_FIRST = -2
BAD_DIGITS = -3
BAD_CONTROL = -4
BAD_PROVINCE = -5
ERRORS = {
    BAD_LENGTH: "wrong length.",
    BAD_FIRST: "wrong first digit.",
    BAD_DIGITS: "invalid sequence of numbers.",
    BAD_CONTROL: "wrong control digit.",
    BAD_PROVINCE: "wrong province code.",
}


def normalise_id(c: Column) -> Column:
    return F.regexp_replace(F.lower(c), r"(?U)\W", "")


def _control_letter(number: Column) -> Column:
    return F.substr(F.lit(DNI_CONTROL), (F.pmod(number, F.lit(23)) + 1).cast("int"), F.lit(1))


def _number_code(digits: Column, control: Column, width: str) -> Column:
    number = digits.try_cast("int")
    return (
        F.when(~digits.rlike(f"^[0-9]{width}$") | (number == 0), F.lit(BAD_DIGITS))
        .when(control != _control_letter(number), F.lit(BAD_CONTROL))
        .otherwise(F.lit(VALID))
    )


def dni_code(c: Column) -> Column:
    first, middle, control = F.substring(c, 1, 1), F.substring(c, 2, 7), F.substring(c, 9, 1)
    return (
        F.when(c.isNull(), F.lit(None).cast("int"))
        .when(F.length(c) != 9, F.lit(BAD_LENGTH))
        .when(first.rlike("^[0-9]$"), _number_code(F.substring(c, 1, 8), control, "{8}"))
        .when(~first.isin(*DNI_LETTERS), F.lit(BAD_FIRST))
        .otherwise(_number_code(middle, control, "{7}"))
    )


def nie_code(c: Column) -> Column:
    first, middle, control = F.substring(c, 1, 1), F.substring(c, 2, 7), F.substring(c, 9, 1)
    digits = F.concat(F.translate(first, NIE_LETTERS, "012"), middle)
    return (
        F.when(c.isNull(), F.lit(None).cast("int"))
        .when(F.length(c) != 9, F.lit(BAD_LENGTH))
        .when(~first.isin(*NIE_LETTERS), F.lit(BAD_FIRST))
        .otherwise(_number_code(digits, control, "{8}"))
    )


def cif_control(c: Column) -> Column:
    """Control number 0-9 from the seven digits after the letter."""
    digit = [F.ascii(F.substring(c, at, 1)) - 48 for at in range(2, 9)]
    even = digit[1] + digit[3] + digit[5]
    # digit sum of the doubled digit, by digit
    odd = reduce(lambda a, b: a + b, [F.pmod(d * 2, F.lit(10)) + (d >= 5).cast("int") for d in digit[0::2]])
    return F.pmod(10 - F.pmod(even + odd, F.lit(10)), F.lit(10))


def cif_code(c: Column) -> Column:
    letter, digits, province = F.substring(c, 1, 1), F.substring(c, 2, 7), F.substring(c, 2, 2)
    control = F.substring(c, 9, 1)
    # for each control number its letter and its digit, side by side
    both = "".join(mark + str(n) for n, mark in enumerate(CIF_CONTROL))
    allowed = F.substr(F.lit(both), cif_control(c) * 2 + 1, F.lit(2))
    letter_only = letter.isin(*CIF_LETTER_CONTROL) | (province == "00")
    digit_only = letter.isin(*CIF_DIGIT_CONTROL) & ~letter_only
    is_digit = control.between("0", "9")
    fits = (F.instr(allowed, control) > 0) & ~(letter_only & is_digit) & ~(digit_only & ~is_digit)
    return (
        F.when(c.isNull(), F.lit(None).cast("int"))
        .when(F.length(c) != 9, F.lit(BAD_LENGTH))
        .when(~digits.rlike("^[0-9]{7}$") | (digits == "0000000"), F.lit(BAD_DIGITS))
        .when(~letter.isin([row[0] for row in ENTITY_LETTERS]), F.lit(BAD_FIRST))
        .when(~province.isin([code for codes, _ in PROVINCE_CODES for code in codes.split(",")]), F.lit(BAD_PROVINCE))
        .when(~fits, F.lit(BAD_CONTROL))
        .otherwise(F.lit(VALID))
    )


def id_type(c: Column) -> Column:
    return (
        F.when(cif_code(c) > 0, F.lit("CIF")).when(dni_code(c) > 0, F.lit("DNI")).when(nie_code(c) > 0, F.lit("NIE"))
    )


def is_valid_id(c: Column) -> Column:
    return F.coalesce(id_type(c).isNotNull(), F.lit(False))


def valid_or_null(c: Column) -> Column:
    return bind(c, lambda id_: F.when(id_type(id_).isNotNull(), id_))


def with_zero(c: Column) -> Column:
    """Insert one zero: after a leading letter, else at the front."""
    return F.when(c.rlike(r"(?U)^\p{Alpha}"), F.concat(F.substring(c, 1, 1), F.lit("0"), F.substr(c, F.lit(2)))).when(
        F.length(c) > 0, F.concat(F.lit("0"), c)
    )


def correct_id(c: Column) -> Column:
    """The ID if valid, else its zero-padded form if that is valid, else null."""
    return bind(c, lambda id_: F.coalesce(valid_or_null(id_), valid_or_null(with_zero(id_))))


def error_text(code: Column, kind: str) -> Column:
    text = None
    for value, message in ERRORS.items():
        full = F.lit(f"Error in {kind}: {message}")
        text = F.when(code == value, full) if text is None else text.when(code == value, full)
    return text
