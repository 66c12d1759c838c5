"""List-valued cells: missing values, scalars and stringified lists become arrays."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

WHITESPACE = "".join(chr(code) for code in range(0x3001) if chr(code).isspace())

_LIST_JSON = {"allowSingleQuotes": "true", "allowBackslashEscapingAnyCharacter": "true"}


def bind(c: Column, body: Callable[[Column], Column]) -> Column:
    """``body(c)`` with ``c`` worked out once, however often the body uses it.

    Without this a filter pushed below a chain of such bodies would repeat the chain
    at every use.
    """
    return F.get(F.transform(F.array(c), body), 0)


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITESPACE))


def is_missing(c: Column) -> Column:
    return c.isNull() | (c == "nan")


def null_array() -> Column:
    return F.array(F.lit(None).cast("string"))


def fill_missing(c: Column, fill: Column | None = None) -> Column:
    """Replace a null array, or one holding only nulls and "nan", by ``fill`` (default ``[null]``)."""
    other = null_array() if fill is None else fill
    return bind(c, lambda a: F.when(F.coalesce(F.forall(a, is_missing), F.lit(True)), other).otherwise(a))


def parse_list_text(c: Column) -> Column:
    """Text of a list literal -> array. Read as data, never evaluated; null when it does not parse."""
    bare_null = F.regexp_replace(c, r"(?<=[\[ ])(None|nan)(?=[,\]])", "null")
    bare_bool = F.regexp_replace(
        F.regexp_replace(bare_null, r"(?<=[\[ ])True(?=[,\]])", "true"), r"(?<=[\[ ])False(?=[,\]])", "false"
    )
    return F.from_json(bare_bool, "array<string>", _LIST_JSON)


def _looks_like_list(c: Column) -> Column:
    return c.startswith("[") & c.endswith("]")


def parse_text_cell(c: Column) -> Column:
    """String cell -> array: null -> ``[null]``, list text -> its items, else one item."""
    return bind(
        c,
        lambda t: F.when(is_missing(t), null_array())
        .when(_looks_like_list(t), F.coalesce(parse_list_text(t), F.array(t)))
        .otherwise(F.array(t)),
    )


def parse_array_cell(c: Column) -> Column:
    """Array cell -> array; a list text as the first item stands for the whole list."""

    def parse(a: Column) -> Column:
        head = F.get(a, 0)
        return (
            F.when(head.isNull(), null_array())
            .when(_looks_like_list(head), F.coalesce(parse_list_text(head), a))
            .otherwise(a)
        )

    return bind(c, parse)


def tidy_items(c: Column, lower: bool = True) -> Column:
    """Trim (and lower-case) every item; an empty first item makes the whole cell missing."""

    def tidy(a: Column) -> Column:
        items = F.transform(a, lambda x: F.lower(strip(x)) if lower else strip(x))
        return F.when(F.coalesce(F.get(a, 0), F.lit("")) == "", null_array()).otherwise(items)

    return bind(c, tidy)


def list_cell(c: Column, is_array: bool, lower: bool = True) -> Column:
    parsed = parse_array_cell(fill_missing(c)) if is_array else parse_text_cell(c)
    return tidy_items(parsed, lower)


def pad(c: Column, n: Column) -> Column:
    """Extend an array with nulls to ``n`` items."""
    return F.concat(c, F.array_repeat(F.lit(None).cast("string"), F.greatest(n - F.size(c), F.lit(0))))


def flag_from_text(c: Column) -> Column:
    """"true" -> true, empty or null -> null, anything else -> false."""
    return F.when(c.isNull() | (c == ""), F.lit(None).cast("boolean")).otherwise(c == "true")


def flag_from_letter(c: Column, yes: str = "S", no: str = "N") -> Column:
    return F.when(c == yes, F.lit(True)).when(c == no, F.lit(False))
