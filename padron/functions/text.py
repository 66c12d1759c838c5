"""Name and text standardisation as column expressions."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from padron.functions.cells import bind, strip
from padron.functions.legal_forms import remove_legal_form, standardise_legal_form

# Accents folded before consortium matching.
FOLD_FROM = "áéíóúÁÉÍÓÚòÒ"
FOLD_TO = "aeiouAEIOUoO"

# Boilerplate inside consortium names, and wordings removed after it, in order.
BOILERPLATE = [
    r"ley.*?(enero|febrero|marzo|abril|mayo|junio|julio|agosto|septiembre|octubre|noviembre|diciembre)",
    r"revista.*?\d+",
    r"expte.*?\d+",
    r"ley.*\d+",
    r"contr.*\d+",
]
CONSORTIUM_WORDING = [
    "u.t.e.",
    "u.t.e",
    "union temporal de empresas",
    "compromiso de ",
    "abreviadamente",
    "compromiso",
]

# Fixed value: separators between the words of a name.
TOKEN_SEPARATORS = r"(?U)[.,!?;:\s()-]"


def squash_space(c: Column) -> Column:
    """Drop white space after a word-then-symbol pair and before a symbol-then-word pair."""
    # begins with the white space itself, so that other characters are passed over at once
    return F.regexp_replace(c, r"(?U)\s(?:(?<=\w\W\s)\s*|\s*(?=\W\w))", "")


def strip_embedded_id(name: Column, id_: Column) -> Column:
    """Remove the row's own ID from its name; an unknown or empty ID changes nothing."""
    # replacing an empty text changes nothing
    return F.replace(name, F.coalesce(id_, F.lit("")), F.lit(""))


def clean_text(c: Column) -> Column:
    """Lower-case; keep only ``, . -`` as punctuation, hyphens set apart; trim symbols (a final dot stays)."""
    spaced = F.replace(F.regexp_replace(F.lower(c), r"\p{P}(?<![,.-])", " "), F.lit("-"), F.lit(" - "))
    bare = F.regexp_replace(spaced, r"(?U)^[\s\p{P}]+|[\s\p{P}]+(?<![.])$", "")
    return F.regexp_replace(bare, r"(?U)\s{2,}", " ")


def clean_name(c: Column, remove_type: bool = False) -> Column:
    """Name with its legal form standardised (or removed); null or empty gives null."""
    change = remove_legal_form if remove_type else standardise_legal_form
    return bind(F.lower(c), lambda low: F.when(low != "", clean_text(change(low))))


def _ascii_table() -> tuple[str, str, list[tuple[str, str]]]:
    single, target, several = [], [], [("ß", "ss"), ("æ", "ae"), ("œ", "oe"), ("þ", "th"), ("€", "eur")]
    single += ["ø", "đ", "ł", "ð", "ħ", "ı"]
    target += ["o", "d", "l", "d", "h", "i"]
    for code in [*range(0xA0, 0x250), *range(0x1E00, 0x1F00)]:
        char = chr(code)
        plain = unicodedata.normalize("NFKD", char).encode("ascii", "ignore").decode().lower()
        if char != char.lower() or char in single or not plain.isalnum():
            continue
        if len(plain) == 1:
            single.append(char)
            target.append(plain)
        else:
            several.append((char, plain))
    return "".join(single), "".join(target), several


_ASCII_FROM, _ASCII_TO, _ASCII_SEVERAL = _ascii_table()


def to_ascii(c: Column) -> Column:
    """Transliterate lower-case Latin letters; plain ASCII text skips the work."""

    def fold(text: Column) -> Column:
        folded = F.translate(text, _ASCII_FROM, _ASCII_TO)
        for char, plain in _ASCII_SEVERAL:
            folded = F.replace(folded, F.lit(char), F.lit(plain))
        return F.when(text.rlike(r"[^\x00-\x7f]"), folded).otherwise(text)

    return bind(c, fold)


def name_key(c: Column) -> Column:
    """Matching key: lower case, ASCII letters, word characters only; null or empty gives null."""
    return bind(F.lower(c), lambda low: F.when(low != "", F.regexp_replace(to_ascii(low), r"(?U)\W", "")))


def fold_accents(c: Column) -> Column:
    return F.translate(c, FOLD_FROM, FOLD_TO)


def fold_accents_list(c: Column) -> Column:
    return F.transform(c, fold_accents)


def strip_boilerplate(c: Column) -> Column:
    bare = F.regexp_replace(c, "(?iu)" + "|".join(BOILERPLATE), "")
    for wording in CONSORTIUM_WORDING:
        bare = F.replace(bare, F.lit(wording), F.lit(" "))
    return strip(bare)


def remove_all(c: Column, part: Column) -> Column:
    """Every occurrence of ``part`` becomes a space; an empty part changes nothing."""
    return F.when(part == "", c).otherwise(F.replace(c, part, F.lit(" ")))


def remove_first(c: Column, part: Column) -> Column:
    at = F.instr(c, part)
    return F.when(
        (at > 0) & (F.length(part) > 0),
        F.concat(F.substr(c, F.lit(1), at - 1), F.substr(c, at + F.length(part))),
    ).otherwise(c)


def words(c: Column) -> Column:
    return F.filter(F.split(c, r"(?U)\s+"), lambda w: w != "")


def word_difference(a: Column, b: Column) -> Column:
    """Distinct words of ``a`` not in ``b``, in order of first appearance."""
    return F.array_join(F.array_except(words(a), words(b)), " ")


def word_ngrams(ws: Column, longest: int | None = None) -> Column:
    """Every contiguous run of words as text, up to ``longest`` words."""
    n = F.size(ws)
    last = n if longest is None else F.least(n, F.lit(longest))
    grams = F.flatten(
        F.transform(
            F.sequence(F.lit(1), n),
            lambda i: F.transform(
                F.sequence(F.lit(1), F.least(last, n - i + 1)),
                lambda k: F.array_join(F.slice(ws, i, k), " "),
            ),
        )
    )
    return F.when(n > 0, grams).otherwise(F.array().cast("array<string>"))


def leading_segment(c: Column, separator: str) -> Column:
    return F.substring_index(c, separator, 1)


def reformat_timestamp(c: Column) -> Column:
    """dd/MM/yyyy HH:mm:ss -> yyyy-MM-dd HH:mm:ss+00:00; other text passes through."""
    parsed = F.try_to_timestamp(c, F.lit("dd/MM/yyyy HH:mm:ss"))
    return F.coalesce(F.date_format(parsed, "yyyy-MM-dd HH:mm:ss'+00:00'"), c)


def used_names(*lists: Column) -> Column:
    """Sorted set of all names in several arrays."""
    return F.array_sort(F.array_distinct(F.array_compact(F.concat(*lists))))


def longest_name(sorted_names: Column) -> Column:
    """Longest item; the first in order among equals."""
    best = F.array_min(F.transform(sorted_names, lambda x: F.struct((-F.length(x)).alias("len"), x.alias("name"))))
    return best["name"]


def is_digits(c: Column) -> Column:
    return c.rlike(r"^\p{Nd}+$")
