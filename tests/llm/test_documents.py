"""Operators on single documents against plain Python, on the smallest tables and at the edges."""

import random

import pytest
from brute import EDGES, EMPTY, contamination, personal, quality_counts, sha

from padron.llm import pii
from padron.llm.decontaminate import drop_contaminated, find_contamination
from padron.llm.quality import judge_quality

DATA = "/root/testdata/sf0.001"


def documents(spark, texts):
    rows = [(i, t, "other", 1) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_words string, found int")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{DATA}/labels.parquet")


@pytest.fixture(scope="module")
def texts(spark):
    return [r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").orderBy("doc_id").collect()] + EDGES


def test_quality_counts(spark, texts, labels):
    train = spark.read.parquet(f"{DATA}/documents.parquet")
    docs = train.select("doc_id", "text").unionByName(documents(spark, EDGES).selectExpr("doc_id + 1000000 AS doc_id", "text"))
    for r in judge_quality(docs, labels).collect():
        text = texts[r.doc_id] if r.doc_id < 1_000_000 else EDGES[r.doc_id - 1_000_000]
        counts = quality_counts(text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts, r.doc_id
        assert r.base_failed == (counts[0] < 50 or 100 * counts[4] > 50 * counts[0])
        assert not (r.base_failed and r.kept)


def test_quality_without_labels_or_documents(spark, labels):
    docs = documents(spark, ["word %d and other words" % i for i in range(3)])
    assert judge_quality(docs, labels.limit(0)).count() == 3
    assert judge_quality(docs.limit(0), labels).count() == 0


def test_quality_tells_junk_from_prose(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    judged = judge_quality(docs, labels).join(labels, "doc_id").filter("NOT base_failed").collect()
    right = sum(r.kept == (r.quality == 1) for r in judged)
    assert right / len(judged) > 0.9
    good = [r for r in judged if r.quality == 1]
    assert sum(r.kept for r in good) / len(good) > 0.98


@pytest.mark.parametrize("limit", [1 << 24, 2000])
def test_contamination(spark, texts, limit):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    items += [(900, "One"), (901, "one two three four"), (902, None), (903, "..."), (904, "b a b"), (905, "One")]
    benchmark = spark.createDataFrame([(i, t, 0) for i, t in items] + [(None, "one", 0)], "item_id long, text string, doc_id int")
    docs = documents(spark, texts)
    got = find_contamination(docs, benchmark, limit).collect()
    assert len(got) == len(texts)
    for r in got:
        expected = contamination(texts[r.doc_id] if len(texts[r.doc_id] or "") < 100_000 else "word", items)
        if len(texts[r.doc_id] or "") < 100_000:
            assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == expected, r.doc_id
    clean = {r.doc_id for r in got if not r.contaminated}
    kept = drop_contaminated(docs, benchmark, limit)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == clean


def test_contamination_offsets(spark):
    question = "what is the name of the long river in the north"
    text = "Ünd: WHAT is   the name, of the long\nriver in the (north)! And"
    benchmark = spark.createDataFrame([(5, question)], "item_id long, text string")
    row = find_contamination(documents(spark, [text]), benchmark).first()
    assert [text[s.start : s.end] for s in row.spans] == [text[5 : text.index("north") + 5]]


def test_empty_benchmark(spark):
    benchmark = spark.createDataFrame([], "item_id long, text string")
    rows = find_contamination(documents(spark, ["a b", None]), benchmark).collect()
    assert {(r.n_items, r.items_sha256, r.contaminated) for r in rows} == {(0, EMPTY, False)}


PERSONAL = [
    "a@b.c@d.e x@y.z_w@q.r, mail: é.ö@x.y ..@a-.b.c a@b a@.b a@b..c",
    "1.2.3.4.5.6.7.8 256.1.1.1 1.2.3.0000255 001.002.003.004 1..2.3.4 9999999999999.1.1.1 0.0.0.0",
    "4111 1111 1111 1111 and 4111-1111-1111-1112, 41111111111111111111 4111  1111 1111 1111 5500005555555559 1",
    "+1 (319) 555-5132 +12 +1234567 +12345678. +1-2-3-4-5-6-7-8-) x +123456789012345678 ++49 30 901820",
    "ü" * 30 + "+49 (30) 901820, 4111111111111111 x@y.zz 10.0.0.1",
]


def test_personal_data(spark, texts):
    rng = random.Random(3)
    noise = ["".join(rng.choice("0123456789 .-+()@ab_%é\n") for _ in range(300)) for _ in range(60)]
    cases = PERSONAL + noise + texts
    for r in pii.digest(pii.find_personal_data(documents(spark, cases))).collect():
        base = personal(cases[r.doc_id])
        assert r.base_sha256 == sha(",".join(base)), (r.doc_id, cases[r.doc_id][:80], base)
        count = lambda kind: sum(b.startswith(kind) for b in base)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(map(count, pii.BASE_KINDS))
        assert set(base) <= set(r.spans.split(",")) | {""}


def test_personal_data_beyond_the_base(spark):
    cases = ["Pay to IBAN DE89 3704 0044 0532 0130 00 now", "IBAN DE89 3704 0044 0532 0130 01", "amex 3782 822463 10005", "3782 822463 10005", "Phone: (319) 555-5132!", "id 319-555-5132"]
    got = [r.spans for r in pii.digest(pii.find_personal_data(documents(spark, cases))).orderBy("doc_id").collect()]
    assert got == ["iban:12:39", "", "card:5:22", "", "phone:7:21", ""]


def test_personal_data_in_long_runs(spark):
    digits = "card 4111 1111 1111 1111, then " + "3 " * 100_000
    cases = [digits, "4111-1111-1111-1111 " + "7" * 100_000, "write to a@b" + ".c" * 100_000 + " now"]
    got = pii.digest(pii.find_personal_data(documents(spark, cases))).orderBy("doc_id").collect()
    assert [(r.n_email, r.n_card) for r in got] == [(0, 1), (0, 0), (1, 0)]
    assert [r.base_sha256 for r in got] == [sha(",".join(personal(c))) for c in cases]


def test_mask(spark):
    docs = documents(spark, ["to a@b.cc and 10.0.0.1!", "nothing", None])
    found = pii.find_personal_data(docs).join(docs, "doc_id").orderBy("doc_id")
    from pyspark.sql import functions as F

    assert [r[0] for r in found.select(pii.mask(F.col("text"), F.col("spans"))).collect()] == ["to <email> and <ip>!", "nothing", None]
