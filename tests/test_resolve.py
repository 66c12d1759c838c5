from collections import Counter, defaultdict

from helpers import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from padron.operators import survivorship
from padron.operators.resolve import golden_records, id_summary, mention_groups, replaced_ids, unify_repeated
from padron.plans.company_table import company_tables


def best(weights):
    """Heaviest, then longest, then first in order."""
    return min(weights, key=lambda v: (-weights[v], -len(v), v))


def expected_golden(pairs):
    groups = Counter(pairs)
    by_id, by_name, out = defaultdict(Counter), defaultdict(Counter), Counter()
    for (i, n), count in groups.items():
        by_id[i][n] += count
    for i, names in by_id.items():
        if len(names) > 1:
            out[i, best(names)] += sum(names.values())
        else:
            ((n, count),) = names.items()
            by_name[n][i] += count
    for n, ids in by_name.items():
        out[best(ids), n] += sum(ids.values())
    return out


pair = st.tuples(st.sampled_from(["a", "b", "cc", "d", "e"]), st.sampled_from(["x", "y", "zz", "w", "v", "u"]))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(pair, min_size=1, max_size=25))
def test_golden_records(spark, pairs):
    data = [(i, n, at) for at, (i, n) in enumerate(pairs)]
    df = spark.createDataFrame(data, "ID string, Name_norm string, ord int").repartition(3)
    ids = id_summary(mention_groups(df))
    got = golden_records(ids).collect()
    assert {(r.ID, r.Name_norm): r["count"] for r in got} == dict(expected_golden(pairs))
    assert len({r.ID for r in got}) == len(got)
    owners = {r.ID: r.golden_id for r in replaced_ids(ids).collect()}
    assert {owners.get(i, i) for i, _ in pairs} == {r.ID for r in got}


def test_null_keys_drop_out(spark):
    df = spark.createDataFrame([("a", None, 1), (None, "x", 2), ("a", "", 3)], "ID string, Name_norm string, ord int")
    assert rows(mention_groups(df), "ID", "Name_norm", "count") == [("a", "", 1)]


def test_unify_weights_by_count(spark):
    df = spark.createDataFrame(
        [("a", "x", 3, 1), ("a", "longer", 1, 2), ("b", "y", 1, 3), ("b", "zz", 1, 4), ("c", "w", 9, 5)],
        "ID string, Name_norm string, count long, first int",
    )
    assert rows(unify_repeated(df, "ID", "Name_norm"), "ID", "Name_norm", "count") == [("a", "x", 4), ("b", "zz", 2)]


def test_modes(spark):
    df = spark.createDataFrame(
        [("a", "x", 1), ("a", "yy", 0), ("a", None, 2), ("b", None, 3), ("c", "", 4), ("c", "", 5), ("c", "z", 6)],
        "k string, v string, at int",
    )
    assert rows(survivorship.mode_value(df, ["k"], "v")) == [("a", "yy"), ("b", None), ("c", "")]
    assert rows(survivorship.mode_value(df, ["k"], "v", skip_empty=True)) == [("a", "yy"), ("b", None), ("c", "z")]
    seen = survivorship.first_seen_mode(df.dropna(), ["k"], "v", F.col("at"))
    assert rows(seen, "k", "v") == [("a", "yy"), ("c", "")]


def test_votes(spark):
    df = spark.createDataFrame(
        [("a", True, "x", "1.0"), ("a", True, None, "1.0"), ("b", None, "x", "1"), ("b", True, "y", "1.0"), ("c", False, None, None)],
        "k string, flag boolean, city string, zone string",
    )
    got = df.groupBy("k").agg(
        survivorship.flag_consensus(F.col("flag")).alias("flag"),
        survivorship.unanimous(F.col("city")).alias("city"),
        survivorship.unanimous_code(F.col("zone")).alias("zone"),
    )
    assert rows(got) == [("a", True, "x", "1"), ("b", False, None, None), ("c", False, None, None)]


def mention_rows():
    acme, other = "B28000008", "12345678Z"
    return [
        ("t1", acme, "Acme, S.L.", True, "madrid", "28001.0", 1),
        ("t2", acme.lower(), "ACME SL", True, None, "28001.0", 2),
        ("t3", "b-28000008", "Acme Obras SL", True, "madrid", "28001.0", 3),
        ("t3", other, "Juan Pérez", None, "x", "1", 4),
        ("t4", "U28000001", "Acme y Juan U.T.E.", None, None, None, 5),
        ("t5", "bad", "Nobody", None, None, None, 6),
        ("t6", other, "S.L.", None, "y", "2", 7),
    ]


SCHEMA = "id_tender string, ID string, Name string, SMEAwardedIndicator boolean, CityName string, PostalZone string, ord int"


def cif(letter, digits):
    even = sum(int(d) for d in digits[1::2])
    odd = sum(sum(map(int, str(2 * int(d)))) for d in digits[::2])
    return f"{letter}{digits}{(10 - (even + odd) % 10) % 10}"


def test_company_tables(spark):
    acme, joint = cif("B", "2800000"), cif("U", "2800001")
    data = [tuple(v.replace("28000008", acme[1:]) if isinstance(v, str) else v for v in r) for r in mention_rows()]
    data = [tuple(joint if v == "U28000001" else v for v in r) for r in data]
    tables = company_tables(spark.createDataFrame(data, SCHEMA).repartition(3))
    got = {r.NIF: r for r in tables.companies.collect()}
    assert tables.companies.count() == len(got)
    tenders = defaultdict(list)
    for r in tables.tenders.orderBy("NIF", "ID", "Name_norm", "ord").collect():
        tenders[r.NIF].append(r.id_tender)
    assert set(got) == {acme.lower(), joint.lower(), "12345678z"}
    row = got[acme.lower()]
    assert (row.FullName, row.Name, row.Province, row.NIFtype, row.CompanyType) == ("acme obras s.l.", "acme", "Madrid", "CIF", "s.l.")
    assert (row.isPYME, row.City, row.PostalCode) == (True, "madrid", "28001")
    assert tenders[acme.lower()] == ["t1", "t2", "t3"]
    # a name that is only a legal form leaves nothing to group by
    assert tenders["12345678z"] == ["t3"] and got["12345678z"].City == "x"
    assert [r.NIF for r in tables.consortia.collect()] == [joint.lower()]
