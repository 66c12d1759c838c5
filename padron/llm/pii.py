"""Personal data: regular expressions propose spans, checksums confirm, context weighs.

Everything is a Spark expression. A text is split at a kind's matches and its matches are
extracted; the lengths of the pieces give the offsets, in code points, end exclusive.
Texts without the characters a kind needs are not searched for it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words that speak for a kind when they stand within CONTEXT code points before a span.
WORDS = {
    "card": "card|visa|mastercard|amex|credit|karte|tarjeta|carte",
    "phone": "phone|call|fax|mobile|cell|telefon|handy|móvil|teléfono|téléphone",
    "iban": "iban|account|konto|cuenta|compte|bank",
}
CONTEXT = 40
#: A proposed span is kept from this score on.
ACCEPT = 0.5
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban")


@dataclass(frozen=True)
class Kind:
    """A pattern, a cheap test that texts with a match pass, and a validator of matches.

    ``score`` is the worth of a valid match and ``with_context`` what a context word adds.
    """

    name: str
    pattern: str
    hint: str
    valid: Callable[[Column], Column]
    base: bool
    score: float = 1.0
    with_context: float = 0.0


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda s, x: s + x)


def luhn(digits: Column) -> Column:
    """Whether the digits, every second one from the right doubled, sum up to a multiple of ten."""

    def worth(c: Column, i: Column) -> Column:
        d = c.cast("int")
        return F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d)

    return _sum(F.transform(F.regexp_extract_all(F.reverse(digits), F.lit("[0-9]"), 0), worth)) % 10 == 0


def mod97(account: Column) -> Column:
    """Whether an account number leaves 1, its first four characters moved to the end."""
    compact = F.replace(account, F.lit(" "), F.lit(""))
    moved = F.concat(F.substr(compact, F.lit(5)), F.left(compact, F.lit(4)))

    def step(rest: Column, c: Column) -> Column:
        code = F.ascii(c)
        return F.when(code < 65, rest * 10 + code - 48).otherwise(rest * 100 + code - 55) % 97

    return F.aggregate(F.regexp_extract_all(moved, F.lit("[0-9A-Z]"), 0), F.lit(0), step) == 1


def _address(match: Column) -> Column:
    def small(part: Column) -> Column:
        digits = F.regexp_replace(part, "^0+(?=[0-9])", "")
        return (F.length(digits) <= 3) & (F.when(F.length(digits) <= 3, digits.cast("int")) <= 255)

    return F.forall(F.split(match, "[.]"), small)


def _length(low: int, high: int) -> Callable[[Column], Column]:
    return lambda match: F.length(_digits(match)).between(low, high)


# Fixed patterns of the base kinds. A run of characters that may start an address is entered
# at its first character or where the last match ended: later ones would fail alike. Groups
# repeat possessively: Java matches those in a loop, others by recursion on the stack.
_LOCAL = "[A-Za-z0-9._%+-]"
SEARCHES = (
    Kind("email", rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", lambda m: F.lit(True), True),
    Kind("ip", r"[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)", r"[0-9]\.[0-9]++\.[0-9]", _address, True),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", "[0-9](?:[\\x20-]?[0-9]){15}", lambda m: F.when(_length(16, 19)(m), luhn(_digits(m))).otherwise(False), True),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]", _length(8, 15), True),
    # what the base rules miss
    Kind("card", r"(?<![0-9][\x20-]?)3[47][0-9]{2}[\x20-]?[0-9]{6}[\x20-]?[0-9]{5}(?![\x20-]?[0-9])", "3[47][0-9]{2}", lambda m: luhn(_digits(m)), False, 0.4, 0.4),
    Kind("phone", r"(?<![0-9+().-][\x20]?)\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9.-])", r"[0-9]{3}[\x20.-][0-9]{4}", _length(10, 10), False, 0.2, 0.4),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])", "[A-Z]{2}[0-9]{2}", mod97, False, 0.7, 0.2),
)

SPAN = "array<struct<rank:int,start:bigint,end:bigint,kind:string,score:double>>"


def _matches(kind: Kind, text: Column) -> Column:
    """Spans of the valid matches of a kind."""
    found = F.regexp_extract_all(text, F.lit(kind.pattern), 0)
    gaps = F.transform(F.split(text, kind.pattern, -1), lambda piece: F.length(piece).cast("bigint"))

    def add(done: Column, pair: Column) -> Column:
        start = done["at"] + pair["gap"]
        end = start + F.length(pair["match"])
        one = F.struct(start.alias("start"), end.alias("end"), pair["match"].alias("match"))
        return F.struct(end.alias("at"), F.concat(done["spans"], F.array(one)).alias("spans"))

    pairs = F.zip_with(F.slice(gaps, 1, F.size(found)), found, lambda gap, match: F.struct(gap.alias("gap"), match.alias("match")))
    empty = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint,match:string>>").alias("spans"))
    spans = F.aggregate(pairs, empty, add, lambda done: done["spans"])
    valid = F.filter(spans, lambda s: kind.valid(s["match"]))
    placed = F.transform(
        valid,
        lambda s: F.struct(
            F.lit(KINDS.index(kind.name)).alias("rank"), s["start"].alias("start"), s["end"].alias("end"), F.lit(kind.name).alias("kind"), _score(kind, text, s["start"]).alias("score")
        ),
    )
    if not kind.base:
        placed = F.filter(placed, lambda s: s["score"] >= ACCEPT)
    return F.when(text.rlike(kind.hint), placed).otherwise(F.array().cast(SPAN))


def _score(kind: Kind, text: Column, start: Column) -> Column:
    if kind.name not in WORDS:
        return F.lit(kind.score)
    before = F.substr(text, F.greatest(F.lit(1), start - CONTEXT + 1).cast("int"), F.least(start, F.lit(CONTEXT)).cast("int"))
    bonus = F.when(before.rlike(rf"(?i)(?<!\w)(?:{WORDS[kind.name]})"), kind.with_context).otherwise(0.0)
    return F.lit(kind.score) + bonus


def find_personal_data(documents: DataFrame) -> DataFrame:
    """doc_id, base, spans for every row of ``documents(doc_id, text)``.

    Both are arrays of (rank, start, end, kind, score) sorted by kind and start. ``base``
    holds what the fixed rules find; ``spans`` also what the method adds, which never
    overlaps a base span. Null is an empty text; repeated rows get equal results; other
    columns are ignored; an empty table gives no rows.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    base = F.concat(*[_matches(k, text) for k in SEARCHES if k.base])
    more = F.concat(*[_matches(k, text) for k in SEARCHES if not k.base])
    found = documents.select("doc_id", F.array_sort(base).alias("base"), more.alias("more"))
    free = lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
    return found.select("doc_id", "base", F.array_sort(F.concat("base", F.filter("more", free))).alias("spans"))


def joined(spans: Column) -> Column:
    """``kind:start:end`` of every span, separated by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest(found: DataFrame) -> DataFrame:
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *map(count, BASE_KINDS), F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def mask(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in angle brackets; overlapping spans merge into the first."""

    def add(done: Column, s: Column) -> Column:
        gap = F.substr(text, (done["at"] + 1).cast("int"), F.greatest(s["start"] - done["at"], F.lit(0)).cast("int"))
        fresh = s["start"] >= done["at"]
        out = F.when(fresh, F.concat(done["out"], gap, F.lit("<"), s["kind"], F.lit(">"))).otherwise(done["out"])
        return F.struct(F.greatest(done["at"], s["end"]).alias("at"), out.alias("out"))

    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))
    return F.aggregate(ordered, start, add, lambda done: F.concat(done["out"], F.substr(text, (done["at"] + 1).cast("int"))))
