"""Every registered query against its SQL counterpart on the smallest test tables."""

import math
from pathlib import Path

import duckdb
import pytest

from padron.catalogue import ORACLES, QUERIES

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in DATA.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def comparable(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def plain(value):
        if isinstance(value, float):
            return "nan" if math.isnan(value) else round(value, 6)
        return round(float(value), 6) if hasattr(value, "as_tuple") else value

    return sorted(columns), sorted((tuple(plain(row[i]) for i in order) for row in data), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, str(DATA))
    got = comparable(df.columns, [tuple(r) for r in df.collect()])
    if name not in ORACLES:
        assert got[1]
        return
    cursor = duck.execute(ORACLES[name])
    assert got == comparable([c[0] for c in cursor.description], cursor.fetchall())


def test_joins_between_names_compare_no_cross_product(spark):
    for name in ("q_phrase_containment_join", "q_token_overlap_join", "q_fuzzy_join", "q_link_consortia", "q_register_merge"):
        plan = QUERIES[name](spark, str(DATA))._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_dictionary_hits_in_all_six_ways_of_writing_a_consortium(spark):
    rows = QUERIES["q_ngram_dictionary_join_all_styles"](spark, str(DATA)).collect()
    assert {r.o % 6 for r in rows} == set(range(6))
