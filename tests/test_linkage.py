"""Blocked joins against brute force on every pair."""

import re

import pytest
from helpers import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from padron.functions.fuzzy import lcs_length
from padron.operators import linkage
from padron.operators.quality import coverage, evaluate_links, frequency_stoplist
from padron.operators.splits import split_consortium
from padron.plans.linking import consortium_members, link_by_split, link_by_tokens


def frame(spark, values, column):
    return spark.createDataFrame([(v,) for v in values], f"{column} string")


def ratio(a, b):
    return round(200 * lcs_length(a, b) / (len(a) + len(b))) if a or b else 100


def damaged(name, at, kind):
    at = at % len(name)
    if kind == 0:
        return name[:at] + name[at + 1 :]
    if kind == 1:
        return name[:at] + "k" + name[at:]
    if kind == 2:
        return name[:at] + "z" + name[at + 1 :]
    return name[:at] + name[at + 1 : at + 2] + name[at : at + 1] + name[at + 2 :]


BASES = [
    "acme",
    "construcciones y obras llorente s.a.",
    "servicios integrales de limpieza y mantenimiento del norte s.l.",
    "ñandú 2000, s.l.",
    "agrupación de interés económico para la gestión del agua y los residuos urbanos de la comarca central a.i.e.",
    "sociedad estatal de infraestructuras " * 3,
    "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa",
    "ab" * 50,
]
LONG = ["suministros y montajes eléctricos del noroeste peninsular " * 3, "x1y2z3w4 " * 20]


def damages(name):
    out = {name}
    for at in range(0, len(name), max(1, len(name) // 3)):
        for kind in range(4):
            once = damaged(name, at, kind)
            out |= {once, damaged(once, at * 7 + 3, (kind + 1) % 4)}
            many = once
            for step in range(len(name) // 45):
                many = damaged(many, at + 13 * step, (kind + step) % 4)
            out.add(many)
    return out


def test_fuzzy_join_equals_brute_force(spark):
    right = sorted({d for base in BASES + LONG for d in damages(base)})
    left = BASES + LONG
    expected = sorted((a, b, ratio(a, b)) for a in left for b in right if ratio(a, b) > 95)
    got = linkage.fuzzy_join(frame(spark, left, "company"), "company", frame(spark, right, "piece"), "piece")
    assert sorted(rows(got, "company", "piece", "ratio")) == expected
    assert len(expected) > len(left)


@pytest.mark.parametrize("threshold", [80, 90])
def test_fuzzy_join_other_thresholds(spark, threshold):
    right = sorted({d for base in BASES[:4] for d in damages(base)})
    expected = sorted((a, b) for a in BASES[:4] for b in right if ratio(a, b) > threshold)
    got = linkage.fuzzy_join(frame(spark, BASES[:4], "a"), "a", frame(spark, right, "b"), "b", threshold)
    assert sorted(rows(got, "a", "b")) == expected


word = st.sampled_from(["acme", "obras", "s.l.", "y", "-", "ñu", "2", "(acme)", "+", "a+b", "acme-obras", ",", "_x"])
phrase = st.lists(word, min_size=1, max_size=5).map(" ".join)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(phrase, min_size=1, max_size=12), st.lists(phrase, min_size=1, max_size=12))
def test_containment_equals_regex(spark, companies, consortia):
    companies = [*companies, "acme s.l.", "-", "+", ""]
    consortia = [*consortia, "acme s.l.x obras", "obras acme s.l.", "a-b a+b"]
    expected = sorted(
        {(c, u) for c in companies for u in consortia if c and re.search(r"\b" + re.escape(c) + r"\b", u)}
    )
    got = linkage.containment_join(frame(spark, companies, "c"), "c", frame(spark, consortia, "u"), "u")
    assert sorted(rows(got, "c", "u")) == expected


def test_token_overlap(spark):
    stops = frame(spark, ["fundación", "garcia"], "term")
    names = frame(spark, ["garcia obras sl", "fundacion agua", "solo", "agua 2020 xyz", "sccl norte"], "company")
    tokens = linkage.distinctive_tokens(names, "company", stops)
    assert rows(tokens, "company", "token") == [
        ("agua 2020 xyz", "agua"),
        ("fundacion agua", "agua"),
        ("garcia obras sl", "obras"),
        ("sccl norte", "norte"),
    ]
    joint = frame(spark, ["Agua-Obras UTE", "agua", "norte,sur"], "consortium")
    got = linkage.token_overlap_join(tokens, "company", joint, "consortium")
    assert rows(got, "company", "consortium") == [
        ("agua 2020 xyz", "Agua-Obras UTE"),
        ("fundacion agua", "Agua-Obras UTE"),
        ("garcia obras sl", "Agua-Obras UTE"),
        ("sccl norte", "norte,sur"),
    ]


def test_anti_join_keeps_rows_without_a_key(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), ("b", 3)], "k string, v int")
    others = spark.createDataFrame([("a",), (None,)], "k string")
    assert rows(linkage.exclude_names(df, others, "k"), "v") == [(2,), (3,)]


def test_split_rules(spark):
    known = frame(spark, ["acme obras", "beta", "gama delta", "gama"], "FullName")
    cases = {
        "u.t.e. acme - beta - gama": ["acme", "beta", "gama"],
        "acme s.l. beta s.a.": ["acme s.l.", "beta s.a."],
        "acme s.l. beta s.a. gama": ["acme s.l.", "beta s.a.", "gama"],
        "acme-s.l., beta s.a.u.": ["acme s.l.", "beta s.a.u."],
        "acme y beta s.l.": ["acme", "beta s.l."],
        "yeso norte s.l.": ["yeso norte s.l."],
        "acme y beta": ["acme", "beta"],
        "lote a - 12 norte, sur": ["lote a - 12 norte, sur"],
        "otros acme obras fin": ["acme obras", "otros fin"],
        "beta gama delta": ["beta", "gama", "gama delta"],
        "nada conocido": ["nada conocido"],
        "y acme + beta y": ["acme", "beta"],
    }
    got = split_consortium(frame(spark, list(cases), "FullName"), "FullName", known)
    assert {r.FullName: sorted(r.pieces) for r in got.collect()} == {k: sorted(v) for k, v in cases.items()}


def test_link_plans(spark):
    companies = spark.createDataFrame(
        [("1", "construcciones pérez hermanos s.a.", "construcciones pérez hermanos"), ("2", "aguas del norte s.l.", "aguas del norte"), ("3", "ute x", "x")],
        "NIF string, FullName string, Name string",
    )
    consortia = spark.createDataFrame(
        [("u1", "construciones pérez hermanos s.a. - aguas del norte s.l. u.t.e."), ("u2", "aguas del norte y otros"), ("u3", "ute x"), ("u4", None)],
        "NIF string, FullName string",
    )
    by_split = link_by_split(companies, consortia)
    assert rows(by_split, "company", "n_splits") == [("aguas del norte s.l.", 1), ("construcciones pérez hermanos s.a.", 1)]
    links = link_by_tokens(companies, consortia, frame(spark, ["norte"], "term"))
    assert rows(links, "company", "consortium") == [
        ("aguas del norte", "aguas del norte y otros"),
        ("aguas del norte", "construciones perez hermanos s.a. - aguas del norte s.l. u.t.e."),
        ("construcciones perez hermanos", "construciones perez hermanos s.a. - aguas del norte s.l. u.t.e."),
    ]
    members = consortium_members(links, companies, consortia)
    assert rows(members, "NIF", "member") == [
        ("u1", "aguas del norte s.l."),
        ("u1", "construcciones pérez hermanos s.a."),
        ("u2", "aguas del norte s.l."),
        ("u3", None),
        ("u4", None),
    ]


def test_stoplist_uses_linear_percentile(spark):
    counts = {"a": 1, "b": 2, "c": 3, "d": 4, "e": 100}
    tokens = frame(spark, [t for t, n in counts.items() for _ in range(n)], "token")
    # the 95th percentile of the counts is 80.8
    assert rows(frequency_stoplist(tokens, manual=["z"])) == [("e",), ("z",)]
    assert rows(frequency_stoplist(tokens, percentile=0.5, manual=[])) == [("d",), ("e",)]


def test_quality_of_links(spark):
    found = spark.createDataFrame([("a", "u1"), ("b", "u1"), ("a", "u9")], "company string, consortium string")
    truth = spark.createDataFrame([("a", "u1"), ("c", "u1"), ("c", None)], "company string, consortium string")
    assert rows(evaluate_links(found, truth, "company", "consortium")) == [(1, 2, 2, 0.5, 0.5)]
    joint = frame(spark, ["u1", "u1", "u2", "u9"], "FullName")
    assert rows(coverage({"m": found, "t": truth}, "consortium", joint)) == [("m", 2, 4, 50.0), ("t", 1, 4, 25.0)]
