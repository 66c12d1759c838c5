"""Spanish legal forms: every spelling of a form becomes one canonical form, or is removed."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from padron.functions.cells import bind

# Spelling pattern -> canonical form, applied in this order.
# A "." in a pattern stands for any run of spaces and dots.
LEGAL_FORMS: list[tuple[str, str]] = [
    (r"s(oc(iedad)?)?.l(im(itada)?)?", "s.l"),
    (r"s(oc(iedad)?)?.l(im(itada)?)?.l(ab(oral)?)?", "s.l.l"),
    (r"s(oc(iedad)?)?.l(im(itada)?)?.u(nipersonal)?", "s.l.u"),
    (r"s(oc(iedad)?)?.l(im(itada)?)?.p(rof(esional)?)?", "s.l.p"),
    (r"s(oc(iedad)?)?.l(im(itada)?)?.n(ueva)?.e(mp(resa)?)?", "s.l.n.e"),
    (r"s(oc(iedad)?)?.(de )?r(es(p(onsabilidad)?)?)?.l(im(itada)?)?", "s.r.l"),
    (r"s(oc(iedad)?)?.a(n(o|ó)nima)?", "s.a"),
    (r"s(oc(iedad)?)?.a(n(o|ó)nima)?.l(ab(oral)?)?", "s.a.l"),
    (r"s(oc(iedad)?)?.a(n(o|ó)nima)?.u(nipersonal)?", "s.a.u"),
    (r"s(oc(iedad)?)?.a(n(o|ó)nima)?.d(ep(ortiva)?)?", "s.a.d"),
    (r"s(oc(iedad)?)?.a(n(o|ó)nima)?.e(s(p(añola)?)?)?", "s.a.e"),
    (r"s(oc(iedad)?)?.c(iv(il)?)?", "s.c"),
    (r"s(oc(iedad)?)?.c(iv(il)?)?.p(riv(ada)?)?", "s.c.p"),
    (r"s(oc(iedad)?)?.c(iv(il)?)?.p(art(icular)?)?", "s.c.p"),
    (r"(s(oc(iedad)?)?)?.c.o.o.p(erativa)?", "c.o.o.p"),
    (r"s(oc(iedad)?)?.c(oop(erativa)?)?.a(ndaluza)?", "s.c.a"),
    (r"s(oc(iedad)?)?.c(oop(erativa)?)?.l(im(itada)?)?", "s.c.l"),
    (r"s(oc(iedad)?)?.c(oop(erativa)?)?.i(nd(ustrial)?)?", "s.c.i"),
    (r"s(oc(iedad)?)?.a(graria)?.(de )?t(ransformaci(o|ó)n)?", "s.a.t"),
    (r"s(oc(iedad)?)?.(de )?g(arant(i|í)a)?.r(ec(i|í)proca)?", "s.g.r"),
    (r"s(oc(iedad)?)?.i(rr(eg(ular)?)?)?", "s.i"),
    (r"s(oc(iedad)?)?.r(eg(ular)?)?.c(ol(ectiva)?)?", "s.r.c"),
    (r"s(uc(ursal)?)?.(en )?e(s(p(aña)?)?)?", "s.e.e"),
    (r"s(oc(iedad)?)?.(en )?c(om(andita)?)?", "s.e.n.c"),
    (r"c(om(unidad)?)?.(de )?b(ienes)?", "c.b"),
    (r"a(grupaci(o|ó)n)?.(de )?i(nt(er(e|é)s)?)?.e(con(o|ó)mico)?", "a.i.e"),
    (r"a(grupaci(o|ó)n)?.e(uropea)?.(de )?i(nt(er(e|é)s)?)?.e(con(o|ó)mico)?", "a.e.i.e"),
    (r"u(ni(o|ó)?n)?.t(emp(oral)?)?.(de )?e(mp(resas)?)?", "u.t.e"),
    (r"inc(orporated)?.", "inc"),
    (r"l(imi)?t(e)?d.", "ltd"),
    (r"co", "co"),
]
# What may stand around a form.
BEFORE_FORM = r"[\s.,-]*(?<![\w.])"
AFTER_FORM = r"[\s.,-]*(?![\w.])"
# Words that stand for one part of a form and no several (as "temp" may); each is known by its first letter alone.
LONG_PARTS = [
    "soc", "sociedad", "lim", "limitada", "lab", "laboral", "unipersonal", "prof", "profesional", "nueva", "emp", "empresa", "empresas",
    "res", "resp", "responsabilidad", "anonima", "anónima", "dep", "deportiva", "es", "esp", "españa", "española", "civ", "civil",
    "priv", "privada", "part", "particular", "andaluza", "ind", "industrial", "agraria", "transformacion", "transformación",
    "garantia", "garantía", "reciproca", "recíproca", "irr", "irreg", "irregular", "reg", "regular", "col", "colectiva",
    "suc", "sucursal", "com", "comandita", "comunidad", "bienes", "agrupacion", "agrupación", "int", "interes", "interés",
    "economico", "económico", "europea", "union", "unión", "temporal",
]
# Words between parts that no part is made of.
LINKS = ["de", "en"]
# Fixed value: letters that a rule writes without having read them, so that later rules may find them.
WRITTEN = {23: {"e", "n"}}


def _plain_groups(spelling: str) -> str:
    """Groups that nothing refers to need not be recorded at each step of a match."""
    return spelling.replace("(", "(?:")


def form_pattern(spelling: str) -> str:
    return "(?U)" + BEFORE_FORM + _plain_groups(spelling).replace(".", r"[\s.]*") + AFTER_FORM


def _first_word(spelling: str) -> str:
    """The first word of any text that a spelling matches: its first parts written together, one at least."""
    first, *others = spelling.split(".")
    if re.fullmatch(r"\(.*\)\?", first):  # may be missing: then the form begins with the space before the next part
        first, *others = first + r"[\s.]*" + others[0], *others[1:]
    return first + "".join(f"(?:{part}" for part in others) + ")?" * len(others)


def zone_pattern(spellings: Sequence[str]) -> str:
    """From the signs before the first word that could begin a form to the end of the text."""
    firsts = "|".join(sorted({re.sub(r"\((?!\?)", "(?:", _first_word(s)) for s in spellings}))
    letters = "".join(sorted({re.sub(r"\W", "", s)[0] for s in spellings}))
    return rf"(?Us){BEFORE_FORM}(?=[\s.]*[{letters}])(?:{firsts})(?!\w).*$"


ZONE = zone_pattern([spelling for spelling, _ in LEGAL_FORMS])


def rule_parts(spelling: str) -> list[str]:
    """The parts of a spelling, as patterns; ``(de )?`` is a part of its own."""
    return [p for p in spelling.replace("(de )?", "(de)?.").replace("(en )?", "(en)?.").split(".") if p]


def needed_letters(spelling: str) -> set[str]:
    """The letters outside all groups, which stand in whatever a spelling matches."""
    while (shorter := re.sub(r"\([^()]*\)\??", "", spelling)) != spelling:
        spelling = shorter
    return set(spelling) - {"."}


def letters_pattern() -> str:
    """All words, in two ways. Group 1: the first letter of a long part; null for words that no form is made of.

    Words that are several parts written together, and single letters, are not matched.
    """
    by_letter: dict[str, list[str]] = {}
    for word in LONG_PARTS:
        by_letter.setdefault(word[0], []).append(word[1:])
    long = "|".join(f"{letter}(?=(?:{'|'.join(rests)})(?!\\w))" for letter, rests in by_letter.items())
    parts = {_plain_groups(part.removeprefix("(").removesuffix(")?") if part.startswith("(") else part) for s, _ in LEGAL_FORMS for part in rule_parts(s)}
    most = max(len(rule_parts(s)) for s, _ in LEGAL_FORMS)
    return rf"(?U)(?<!\w)(?:({long})\w+|(?:{'|'.join(LINKS)})(?!\w)|(?!(?:{'|'.join(sorted(parts))}){{1,{most}}}(?!\w))\w+)"


LETTERS = letters_pattern()


def _rules_without() -> dict[str, int]:
    """For each letter the rules, as bits, that can match where it is missing."""
    written: set[str] = set()
    needs = []
    for i, (spelling, _) in enumerate(LEGAL_FORMS):
        needs.append(needed_letters(spelling) - written)
        written |= WRITTEN.get(i, set())
    return {c: sum(1 << i for i, need in enumerate(needs) if c not in need) for c in sorted(set().union(*needs))}


RULES_WITHOUT = _rules_without()


def _if(condition: Column, yes: Column, no: Column) -> Column:
    """``when`` with one condition; half the cost inside lambdas, which are not compiled."""
    return F.call_function("if", condition, yes, no)


def possible_rules(zone: Column) -> Column:
    """The rules, in order, that may match the text as it is or as the rules before them leave it.

    A match consists of whole words, each made of parts of the form, and a rule writes
    no letter that it has not read (but those of ``WRITTEN``). So a letter that every
    spelling of a form has must be in some word that parts are made of.
    """
    every = (1 << len(LEGAL_FORMS)) - 1
    letters = lambda text: reduce(
        Column.bitwiseAND, [_if(F.instr(text, c) > 0, F.lit(every), F.lit(left)) for c, left in RULES_WITHOUT.items()]
    )
    some = lambda bits: F.filter(F.array(*map(F.lit, range(len(LEGAL_FORMS)))), lambda i: F.getbit(bits, i) == 1)
    return bind(bind(F.regexp_replace(zone, LETTERS, "$1"), letters), some)


def _apply(c: Column, target) -> Column:
    """The rules on a name that is worked out once, not again at each place that uses it."""
    return bind(c, lambda name: _apply_rules(name, target))


def _apply_rules(c: Column, target) -> Column:
    """The rules in order, on the part of the name that begins with the first possible form.

    No rule matches before it, so most of a name is read once instead of once for each
    rule, and of the rules only those are tried whose letters the part has. The character
    before the part goes with it, for the rules look back at it, behind one that makes
    no form of a letter.
    """

    def rule(text: Column, i: Column, first: int = 0, end: int = len(LEGAL_FORMS)) -> Column:
        if end - first == 1:
            spelling, form = LEGAL_FORMS[first]
            return F.regexp_replace(text, form_pattern(spelling), target(form))
        half = (first + end) // 2
        return _if(i < half, rule(text, i, first, half), rule(text, i, half, end))

    def rules(zone: Column) -> Column:
        head = F.substr(c, F.lit(1), F.length(c) - F.length(zone))
        before = F.concat(F.lit("x"), F.right(F.concat(F.lit("("), head), F.lit(1)), zone)
        changed = F.aggregate(possible_rules(zone), before, lambda text, i: rule(text, i))
        return F.when(zone == "", c).otherwise(F.concat(head, F.substring(changed, 3, 2**31 - 1)))

    whole = bind(F.regexp_extract(c, ZONE, 0), rules)
    return F.trim(F.regexp_replace(whole, r"(?U)\s+", " "))


def standardise_legal_form(c: Column) -> Column:
    """"acme soc. limitada" -> "acme s.l." (input already lower case)."""
    return _apply(c, lambda form: f" {form}. ")


def remove_legal_form(c: Column) -> Column:
    return _apply(c, lambda form: " ")
