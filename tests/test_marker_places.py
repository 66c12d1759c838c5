"""Places of markers in texts, counted in characters and found in one pass."""

from padron.operators.splits import marker_hits


def test_places_are_found_in_one_pass(spark):
    texts = spark.createDataFrame([(1, "😀ñ acme s.l. obras s.a"), (2, "obras"), (3, ""), (4, None), (5, "s.l.\ts.a")], "id int, t string")
    forms = spark.createDataFrame([("s.l.",), ("s.a",), ("ñ a",), ("",), (None,)], "form string")
    hits = marker_hits(texts, "id", "t", forms)
    assert "filter(sequence(" not in hits._jdf.queryExecution().optimizedPlan().toString()
    got = {r.key: [(h["at"], -h["less"]) for h in r.hits] for r in hits.collect()}
    assert got == {1: [(2, 3), (9, 4), (20, 3)], 5: [(1, 4), (6, 3)]}
