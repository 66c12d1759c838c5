"""Resampling, search and sharding against plain Python."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from brute import EDGES, LOWER, TERM
from pyspark.sql import functions as F

from padron.llm import resample as draw
from padron.llm import search, sharding
from padron.llm.words import PUNCTUATION, Words

DATA = "/root/testdata/sf0.001"


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def frame(spark, rows):
    """Documents with columns whose names the operators use themselves."""
    held = [(d, t, "x", 1, 2, 3) for d, t in rows]
    return spark.createDataFrame(held, "doc_id long, text string, score string, n int, _row long, rank long")


@pytest.fixture(scope="module")
def corpus(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    rows += [(10_000 + i, t) for i, t in enumerate(EDGES)]
    return rows + [(20_000, "one two three " * 90), (20_001, "漢字" * 300 + " é ß"), (5, rows[5][1]), (None, "one two"), (None, None)]


# --- resampling ------------------------------------------------------------------------


def grams(text):
    w = terms(text)
    return [zlib.crc32(" ".join(w[i : i + k]).encode()) % 10_000 for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def resampled(corpus, target, percent=5):
    held = [(d, grams(t), len(terms(t))) for d, t in corpus]
    s, t = Counter(b for _, g, _ in held for b in g), Counter(b for x in target for b in grams(x))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1.0) * (all_s + 10_000.0) / ((s[b] + 1.0) * (all_t + 10_000.0)))) for b in range(10_000)]
    out = []
    for d, g, n in held:
        h = int(hashlib.sha256(f"42:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in g)
        out.append((d, len(g), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n))
    able = sorted((-score, -1 if d is None else d, i) for i, (d, _, _, score, n) in enumerate(out) if n >= 20)
    rank = {i: k + 1 for k, (_, _, i) in enumerate(able[: percent * len(able) // 100])}
    return sorted((d or -1, n, w, score, rank.get(i)) for i, (d, n, w, score, _) in enumerate(out))


@pytest.mark.parametrize("percent", [5, 60, 0, 100])
def test_resample_equals_plain_python(spark, corpus, percent):
    target = [r.text for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()] + [None, "", "One two"]
    benchmark = spark.createDataFrame([(t, 0) for t in target], "text string, doc_id int")
    got = draw.resample(frame(spark, corpus), benchmark, percent)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    key = lambda r: (*r[:4], r[4] or 0)
    assert sorted(((r[0] or -1, *r[1:]) for r in got.collect()), key=key) == sorted(resampled(corpus, target, percent), key=key)


def test_resample_draws_an_exact_number_among_equal_rows(spark):
    text = "word " * 30
    rows = [(7, text)] * 150 + [(d, text) for d in range(50)]
    got = draw.resample(frame(spark, rows).repartition(9), frame(spark, []), 50).collect()
    assert sorted(r.rank for r in got if r.rank) == list(range(1, 101))
    order = sorted(got, key=lambda r: (-r.score, r.doc_id))
    assert [(r.score, r.doc_id) for r in sorted((r for r in got if r.rank), key=lambda r: r.rank)] == [(r.score, r.doc_id) for r in order[:100]]


def test_resample_of_nothing(spark):
    assert draw.resample(frame(spark, []), frame(spark, [(1, "a b")])).count() == 0
    short = draw.resample(frame(spark, [(1, "a b"), (2, None)]), frame(spark, [])).collect()
    assert {(r.doc_id, r.n_features, r["rank"]) for r in short} == {(1, 3, None), (2, 0, None)}


def test_checksums_of_runs_of_words():
    rng = random.Random(5)
    long = [rng.randbytes(n).replace(b" ", b"x") for n in (1, 3, 63, 64, 65, 200, 5000)]
    text = b"".join(bytes(b | 0x80 for b in x) + b" " for x in long)
    words = Words(np.frombuffer(text, np.uint8), np.array([0, len(text)]), PUNCTUATION)
    parts = text.split()
    expected = [[zlib.crc32(b" ".join(parts[i : i + k])) % 10_000 for i in range(len(parts) - k + 1)] for k in (1, 2, 3)]
    assert [b.tolist() for _, b in draw.features(words)] == expected


@pytest.mark.parametrize("values", [[3], [5, 5, 5], [-(2**62), 0, 2**62], list(range(-40, 4000, 7)) * 2])
def test_bisection(spark, values):
    rows = spark.createDataFrame([(v,) for v in values], "v long")
    for k in {1, len(values) // 2 or 1, len(values)}:
        kth = sorted(values)[k - 1]
        assert draw.kth(rows, F.col("v"), k) == (kth, sum(v < kth for v in values), sum(v <= kth for v in values))


# --- search ----------------------------------------------------------------------------


def searched(corpus, items):
    held = [(d, Counter(terms(t))) for d, t in corpus]
    held = [(d, c, sum(c.values())) for d, c in held if c]
    n_docs, n_terms = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for d, c, n in held:
            m = 75 + 25 * n * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t in terms(text) if t in c)
            if score and d is not None:
                scores.append((-score, d))
        out += [(item, i + 1, d, -s) for i, (s, d) in enumerate(sorted(scores)[:20])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("block_bytes", [1 << 22, 3000])
def test_search_equals_plain_python(spark, corpus, block_bytes):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    items += [(900, "One, two; one WORD"), (901, "unseen_"), (902, None), (903, "!"), (900, "One, two; one WORD"), (None, "three 漢字")]
    queries = spark.createDataFrame([(i, t, 1, 2) for i, t in items], "item_id long, text string, doc_id int, query int")
    got = search.rank_documents(frame(spark, corpus), queries, block_bytes=block_bytes)
    assert got.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert sorted(map(tuple, got.collect()), key=repr) == searched(corpus, items)


def test_search_among_many_copies_takes_the_smallest_ids(spark):
    rows = [(d, "alpha beta " * 300 + "gamma") for d in range(2000, 1000, -1)] + [(d, f"alpha noise{d}") for d in range(500)]
    items = [(1, "alpha beta"), (2, "noise7 alpha")]
    queries = spark.createDataFrame(items, "item_id long, text string")
    assert sorted(map(tuple, search.rank_documents(frame(spark, rows), queries).collect()), key=repr) == searched(rows, items)


def test_search_of_nothing(spark):
    queries = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert search.rank_documents(frame(spark, []), queries).count() == 0
    assert search.rank_documents(frame(spark, [(1, None)]), queries).count() == 0
    assert search.rank_documents(frame(spark, [(1, "a")]), queries.limit(0)).count() == 0


def test_bounds_are_never_below_the_score(spark, corpus):
    items = [(1, " ".join(t or "" for _, t in corpus[:3])), (2, "one two three word")]
    held = [(q, t.encode(), n) for q, text in items for t, n in Counter(terms(text)).items()]
    block = search.Block(held)
    block.weights[:] = 1 + np.arange(len(block)) % 9
    texts = frame(spark, [r for r in corpus if r[0] is not None]).select("doc_id", "text")
    batch = search.build_index(texts).toArrow().combine_chunks().to_batches()[0]
    bounds = search._bounds(block, 100, 30_000, batch)
    by_id = defaultdict(list)
    for d, row in zip(batch.column(0).to_pylist(), bounds, strict=True):
        by_id[d].append(row)
    loose = 0
    for d, text in corpus:
        if d is not None:
            data = np.frombuffer((text or "").encode(), np.uint8)
            exact = search._exact(block, 100, 30_000, data, np.array([0, len(data)]))[0]
            assert all((row >= exact).all() for row in by_id[d])
            loose += int(by_id[d][0][1] > exact[1])
    assert loose < len(corpus) / 3  # the bound of a short query mostly is the score itself


# --- sharding --------------------------------------------------------------------------


@pytest.mark.parametrize("shards", [24, 1, 7])
def test_shards(spark, corpus, shards):
    got = sharding.shard_documents(frame(spark, corpus), shards).collect()
    size = lambda t: len((t or "").encode())
    assert sorted(((r.doc_id or -1, r.size, r.text_crc32) for r in got)) == sorted((d or -1, size(t) + 8, zlib.crc32((t or "").encode())) for d, t in corpus)
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
        assert (r.law, r.grown_shard) == ("rows", None)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    counts = [len(slots[s]) for s in range(shards)]
    assert max(counts) - min(counts) <= 1 and set(slots) <= set(range(shards))
    again = sharding.shard_documents(frame(spark, corpus).repartition(5), shards).collect()
    assert {(r.doc_id, r.shard) for r in got if r.doc_id not in (None, 5)} == {(r.doc_id, r.shard) for r in again if r.doc_id not in (None, 5)}


def test_shards_of_a_repeated_row_and_of_nothing(spark):
    got = sharding.shard_documents(frame(spark, [(3, "same")] * 500 + [(d, None) for d in range(100, 200)])).groupBy("shard").count().collect()
    assert sorted(r["count"] for r in got) == [25] * 24
    assert sharding.shard_documents(frame(spark, [])).count() == 0


def test_one_more_shard_moves_few_rows(spark):
    docs = spark.range(60_000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    old, new = (sharding.shard_documents(docs, n).select("doc_id", F.col("shard").alias(f"s{n}")) for n in (24, 25))
    moved = old.join(new, "doc_id").filter("s24 <> s25").count() / 60_000
    assert 1 / 25 <= moved < 0.12  # a plain modulo moves 0.96


def test_every_row_walks_to_the_next_node_with_room():
    owners, counts, room = [0, 1, 0, 2, 1], [5, 0, 4, 0, 1], [4, 3, 3]
    assert sharding.pieces(counts, owners, room) == [[(0, 4), (1, 1)], [], [(2, 3), (1, 1)], [], [(1, 1)]]
    rng = random.Random(1)
    counts = [rng.randrange(50) for _ in range(300)]
    owners = [rng.randrange(7) for _ in counts]
    cut = sharding.pieces(counts, owners, sharding.shares(sum(counts), 7))
    assert [sum(n for _, n in p) for p in cut] == counts
    assert [sum(n for p in cut for s, n in p if s == k) for k in range(7)] == sharding.shares(sum(counts), 7)


def test_a_new_shard_never_moves_a_node():
    before, after = dict(sharding.ring(5)), dict(sharding.ring(6))
    assert {c: s for c, s in after.items() if s < 5} == before


def test_shards_written_as_files(spark, corpus, tmp_path):
    sharding.write_shards(frame(spark, corpus), str(tmp_path / "shards"), 4)
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert sorted(((r.d or -1, r.t or "") for r in back.select(F.col("document.doc_id").alias("d"), F.col("document.text").alias("t")).collect())) == sorted((d or -1, t or "") for d, t in corpus)
    sizes = back.groupBy("shard").agg(F.count("*").alias("n"), F.max("slot").alias("m")).collect()
    assert len(sizes) == 4 and all(r.n == r.m + 1 for r in sizes)
