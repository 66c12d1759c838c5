import regex
from helpers import many, one
from pyspark.sql import functions as F

from padron.functions import text
from padron.functions.fuzzy import lcs_length
from padron.functions.legal_forms import LEGAL_FORMS, form_pattern, remove_legal_form, standardise_legal_form


def test_squash_space_keeps_single_spaces_and_drops_those_beside_symbols(spark):
    got = many(spark, ["acme obras", "acme, obras", "acme ,obras", "a  b", None], text.squash_space)
    assert got == ["acme obras", "acme,obras", "acme,obras", "ab", None]


SPELLINGS = [
    "sl", "s. l.", "sociedad limitada laboral", "s.l. unipersonal", "soc. limitada nueva empresa",
    "sociedad de resp. limitada", "sociedad anónima", "s a u", "sociedad anónima deportiva", "sociedad anonima española",
    "sociedad civil", "sociedad civil particular", "s. coop", "soc cooperativa andaluza", "s.coop. ltda", "s.a.t.",
    "sociedad de garantía recíproca", "s.i", "sociedad regular colectiva", "sucursal en españa", "s. en c.", "c.b.",
    "comunidad de bienes", "agrupación de interés económico", "a.e.i.e.", "unión temporal de empresas", "ute", "u.t.e",
    "inc", "incorporated", "ltd", "limited", "co", "llc",
]


def by_regex(value, remove):
    """The rules run by another regular-expression engine."""
    for spelling, form in LEGAL_FORMS:
        value = regex.sub(form_pattern(spelling).removeprefix("(?U)"), " " if remove else f" {form}. ", value)
    return regex.sub(r"\s+", " ", value).strip()


def test_legal_forms_agree_with_another_engine(spark):
    bodies = ["acme", "peña y hijos", "salas, casal", "co obras", "s.l. u", "áurea-2", ""]
    names = [f"{body}{gap}{spelt}{end}" for body in bodies for gap in (" ", ", ", "-") for spelt in SPELLINGS for end in ("", ".", " b")]
    assert many(spark, names, standardise_legal_form) == [by_regex(n, False) for n in names]
    assert many(spark, names, remove_legal_form) == [by_regex(n, True) for n in names]


def test_legal_form_spellings(spark):
    spelt = {
        "acme, s. l.": "acme s.l.",
        "acme sociedad limitada laboral": "acme s.l.l.",
        "acme s.l. unipersonal": "acme s.l.u.",
        "acme soc. limitada nueva empresa": "acme s.l.n.e.",
        "acme sociedad anónima deportiva": "acme s.a.d.",
        "acme sociedad civil particular": "acme s.c.p.",
        "acme sociedad de garantía recíproca": "acme s.g.r.",
        "acme unión temporal de empresas": "acme u.t.e.",
        "acme ltd": "acme ltd.",
        "salas y casal": "salas y casal",
        # the order of the rules decides: a plain s.c. ends as s.e.n.c., any cooperative as c.o.o.p.
        "acme s.c.": "acme s.e.n.c.",
        "acme soc cooperativa andaluza": "acme c.o.o.p. andaluza",
    }
    assert many(spark, list(spelt), standardise_legal_form) == list(spelt.values())


def test_clean_text(spark):
    got = many(spark, ["(ACME)-Obras!", "¿acme?  s.l.", "acme s.l. -", "", "a_b/c"], text.clean_text)
    assert got == ["acme - obras", "acme s.l.", "acme s.l", "", "a b c"]


def test_clean_name_and_key(spark):
    assert many(spark, ["Peña & Söhne, S.L.", "", None], text.clean_name) == ["peña söhne s.l.", None, None]
    assert many(spark, ["Peña & Söhne, S.L."], lambda c: text.clean_name(c, remove_type=True)) == ["peña söhne"]
    assert many(spark, ["peña söhne", "straße nº 3", "+", "", None], text.name_key) == ["penasohne", "strasseno3", "", None, None]


def test_fold_accents_is_limited_to_its_set(spark):
    assert many(spark, ["fundación", "òÒ", "peña", "à"], text.fold_accents) == ["fundacion", "oO", "peña", "à"]


def test_strip_boilerplate(spark):
    names = ["u.t.e. acme, abreviadamente u.t.e.", "acme ley 18/1982 de 26 de mayo", "acme Expte. 12 b", "compromiso de u.t.e acme"]
    assert many(spark, names, text.strip_boilerplate) == ["acme,", "acme", "acme  b", "acme"]


def test_remove_first_and_all(spark):
    df = spark.createDataFrame([("abcabc", "b"), ("abc", ""), ("abc", "x")], "t string, p string")
    got = df.select(text.remove_first(F.col("t"), F.col("p")).alias("f"), text.remove_all(F.col("t"), F.col("p")).alias("a"))
    assert [tuple(r) for r in got.collect()] == [("acabc", "a ca c"), ("abc", "abc"), ("abc", "abc")]


def test_word_difference_keeps_first_appearance(spark):
    df = spark.createDataFrame([("b a  b c", "a")], "x string, y string")
    assert df.select(text.word_difference(F.col("x"), F.col("y"))).first()[0] == "b c"


def test_word_ngrams(spark):
    assert one(spark, "a b c", lambda c: F.array_sort(text.word_ngrams(text.words(c)))) == ["a", "a b", "a b c", "b", "b c", "c"]
    assert one(spark, "a b c", lambda c: F.array_sort(text.word_ngrams(text.words(c), 1))) == ["a", "b", "c"]
    assert one(spark, " ", lambda c: text.word_ngrams(text.words(c))) == []


def test_reformat_timestamp(spark):
    assert many(spark, ["01/02/2020 03:04:05", "2020-01-01"], text.reformat_timestamp) == ["2020-02-01 03:04:05+00:00", "2020-01-01"]


def test_strip_embedded_id(spark):
    df = spark.createDataFrame([("acme b12", "b12"), ("acme", None), (None, "b12")], "n string, i string")
    assert [r[0] for r in df.select(text.strip_embedded_id(F.col("n"), F.col("i"))).collect()] == ["acme ", "acme", None]


def test_lcs_length():
    def slow(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            last = row
            row = [0]
            for j, y in enumerate(b, 1):
                row.append(last[j - 1] + 1 if x == y else max(last[j], row[-1]))
        return row[-1]

    samples = ["", "a", "abc", "acb", "construcciones y obras", "construciones obras y", "ñandú çedilla", "x" * 70, "xy" * 40]
    for a in samples:
        for b in samples:
            assert lcs_length(a, b) == slow(a, b)
