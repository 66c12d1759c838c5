"""Legal forms against the rules applied one by one to whole names."""

import random
import re

import pytest
from pyspark.sql import functions as F

from padron.functions.legal_forms import LEGAL_FORMS, LINKS, LONG_PARTS, form_pattern, needed_letters, possible_rules, remove_legal_form, rule_parts, standardise_legal_form


def direct(c, target):
    for spelling, form in LEGAL_FORMS:
        c = F.regexp_replace(c, form_pattern(spelling), target(form))
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


PARTS = [
    "s", "soc", "sociedad", "l", "lim", "limitada", "a", "anónima", "anonima", "u", "unipersonal", "p", "prof", "n", "nueva", "e", "emp", "empresa",
    "c", "civ", "civil", "coop", "cooperativa", "o", "i", "ind", "de", "t", "transformación", "g", "r", "reg", "col", "suc", "en", "es", "españa",
    "com", "comandita", "comunidad", "b", "bienes", "agrupación", "interés", "económico", "eco", "europea", "unión", "union", "temporal", "empresas",
    "inc", "incorporated", "ltd", "limited", "co", "sl", "sa", "slu", "sau", "sll", "scoop", "ute", "aie", "x", "acme", "obras", "ñu", "2000", "sales", "costa",
]
SIGNS = [" ", " ", ".", ". ", ",", ", ", "-", " - ", "", "  ", "(", ")", "/", "\t", "_", "é"]


@pytest.mark.parametrize("seed", range(3))
def test_rules_on_a_part_equal_rules_on_the_whole(spark, seed):
    rng = random.Random(seed)
    names = {"".join(rng.choice(SIGNS) + rng.choice(PARTS) for _ in range(rng.randint(1, 7))) + rng.choice(SIGNS) for _ in range(6000)}
    names |= {f"acme{sign}{p}{other}{q}" for sign in SIGNS for other in SIGNS[:6] for p in PARTS[:12] for q in PARTS[:12]} if seed == 0 else set()
    df = spark.createDataFrame([(n,) for n in sorted(names)], "n string").repartition(8)
    c = F.col("n")
    both = df.select(
        "n",
        standardise_legal_form(c).alias("form"), direct(c, lambda form: f" {form}. ").alias("form_direct"),
        remove_legal_form(c).alias("bare"), direct(c, lambda form: " ").alias("bare_direct"),
    )
    assert both.filter("form <> form_direct OR bare <> bare_direct").limit(5).collect() == []
    assert both.filter("form <> n").count() > 1000


def test_names_without_a_form_or_a_text(spark):
    df = spark.createDataFrame([(i, n) for i, n in enumerate([None, "", " ", "acme", "x" * 20_000, "obras " * 3000 + "s.l."])], "i int, n string")
    got = [r.f for r in df.select("i", standardise_legal_form(F.col("n")).alias("f")).orderBy("i").collect()]
    assert got == [None, "", "", "acme", "x" * 20_000, "obras " * 3000 + "s.l."]


@pytest.mark.parametrize("change", [standardise_legal_form, remove_legal_form])
def test_a_name_is_worked_out_once(spark, change):
    df = spark.createDataFrame([("acme s.l.",)], "n string").select(change(F.md5(F.col("n").cast("binary"))).alias("form"))
    assert df._jdf.queryExecution().optimizedPlan().toString().count("md5(") == 1


def test_long_parts_stand_for_their_first_letter_alone():
    for spelling, _ in LEGAL_FORMS:
        parts = rule_parts(spelling)
        for i in range(len(parts)):
            for j in range(i + 1, len(parts) + 1):
                made_of = re.compile("".join(parts[i:j]))
                for word in LONG_PARTS:
                    needed = set().union(*(needed_letters(part) for part in parts[i:j]))
                    assert not made_of.fullmatch(word) or needed <= {word[0]}, (spelling, word)
                for word in LINKS:
                    assert not made_of.fullmatch(word) or parts[i:j] == [f"({word})?"], (spelling, word)


def test_only_rules_whose_letters_stand_there_are_tried(spark):
    zones = [" sociedad limitada", " s.l.", ", soc. anónima", " unión temporal de empresas", " comunidad de bienes", " madrid"]
    df = spark.createDataFrame([(i, z) for i, z in enumerate(zones)], "i int, z string")
    tried = [[LEGAL_FORMS[n][1] for n in r.rules] for r in df.orderBy("i").select(possible_rules(F.col("z")).alias("rules")).collect()]
    assert tried == [["s.l", "s.l.l"], ["s.l", "s.l.l"], ["s.a"], ["u.t.e"], ["c.b"], []]


def test_a_word_that_several_parts_make(spark):
    df = spark.createDataFrame([("acme u temp",), ("acme s.coop. l",), ("acme s. c, l",), ("acme sociedadlimitada",), ("acme.coop",)], "n string")
    c = F.col("n")
    rows = df.select(standardise_legal_form(c).alias("form"), direct(c, lambda form: f" {form}. ").alias("form_direct")).collect()
    assert [r.form for r in rows] == [r.form_direct for r in rows]
    assert rows[0].form == "acme u.t.e."
