"""The CRF over lines against all paths, and texts of two halves."""

from itertools import product

import numpy as np
import pytest

from padron.llm import quality
from padron.llm.words import SPACES, Words

DATA = "/root/testdata/sf0.01"


def all_paths(emit, change):
    """(path, score) of every sequence of states."""
    for path in product((0, 1), repeat=len(emit)):
        score = sum(emit[i, s] for i, s in enumerate(path)) + sum(change[a, b] for a, b in zip(path, path[1:], strict=False))
        yield path, score


@pytest.mark.parametrize("seed", range(4))
def test_chances_equal_all_paths(seed):
    rng = np.random.default_rng(seed)
    lengths = np.array([8, 5, 5, 2, 1, 1])
    starts = np.cumsum(lengths) - lengths
    emit, change, weight = rng.normal(0, 2, (lengths.sum(), 2)), rng.normal(0, 1, (2, 2)), rng.random(len(lengths))
    chance, pair = quality.chances(emit, change, starts, lengths, weight)
    expected, pairs = np.zeros_like(emit), np.zeros((2, 2))
    for a, n, w in zip(starts, lengths, weight, strict=True):
        paths = list(all_paths(emit[a : a + n], change))
        total = sum(np.exp(score) for _, score in paths)
        for path, score in paths:
            p = np.exp(score) / total
            for i, state in enumerate(path):
                expected[a + i, state] += p
            for s, t in zip(path, path[1:], strict=False):
                pairs[s, t] += p * w
    assert np.allclose(chance, expected) and np.allclose(pair, pairs)


@pytest.mark.parametrize("seed", range(4))
def test_viterbi_equals_all_paths(seed):
    rng = np.random.default_rng(seed)
    lengths = [8, 1, 6, 3]
    emit, change = rng.normal(0, 1, (sum(lengths), 2)), rng.normal(0, 2, (2, 2))
    first = np.isin(np.arange(sum(lengths)), np.cumsum([0, *lengths[:-1]]))
    path = quality.viterbi(emit, change, first)
    at = 0
    for n in lengths:
        best = max(all_paths(emit[at : at + n], change), key=lambda x: x[1])[0]
        assert tuple(path[at : at + n]) == best
        at += n


def test_states_agree_with_the_label():
    junk, size = np.array([0.9, 0.2, 0.6, 0.1]), np.array([10, 40, 10, 40])
    assert quality.constrained(junk, size, False).tolist() == [1, 0, 1, 0]
    assert quality.constrained(junk, size, True).tolist() == [1, 1, 1, 0]
    assert quality.constrained(1 - junk, size, False).tolist() == [0, 0, 0, 1]


@pytest.fixture(scope="module")
def model(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    return quality.learn(docs, labels)


def decoded(text, model):
    weights, change = model
    data = np.frombuffer(text.encode(), np.uint8)
    lines = quality.Lines(Words(data, np.array([0, len(data)]), SPACES, lower=False))
    first = np.arange(len(lines.row)) == 0
    return quality.viterbi(lines.features(lines.duplicates()) @ weights, change, first), lines.sizes()


def test_texts_of_a_good_and_a_junk_half(spark, model):
    """Lines of a kept and of a rejected document after each other: the change is found where it is."""
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    kinds = {q: [] for q in (0, 1)}
    for r in spark.read.parquet(f"{DATA}/labels.parquet").collect():
        lines = [x for x in (docs.get(r.doc_id) or "").split("\n") if x.strip()]
        # documents that by themselves are one kind throughout
        if len(lines) >= 5 and set(decoded("\n".join(lines), model)[0].tolist()) == {1 - r.quality}:
            kinds[r.quality].append(lines)
    pairs = list(zip(kinds[1], kinds[0], strict=False))[:60]
    assert len(pairs) >= 10
    near = between = 0
    for good, junk in pairs:
        for a, b, x in ((good, junk, 0), (junk, good, 1)):
            path, size = decoded("\n".join(a + b), model)
            change = np.flatnonzero(np.diff(path))
            near += bool(path[0] == x and len(change) and abs(change[0] + 1 - len(a)) <= 2)
            between += 0 < size[path == 0].sum() < size.sum()
    assert near / (2 * len(pairs)) > 0.8 and between / (2 * len(pairs)) > 0.9


def test_sample_takes_whole_documents_once(spark, monkeypatch):
    monkeypatch.setattr(quality, "TRAINING_LINES", 299)
    texts = [(i, "\n".join(f"line {k}" for k in range(2 + i % 3))) for i in range(50)] + [(i, "again") for i in range(50)] + [(99, "\n".join("x" * 250))]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in [*range(50), 99]], "doc_id long, quality int")
    rows = quality.training_sample(docs, labels).collect()
    assert len(rows) == len({r.doc_id for r in rows}) == 50 and {r.text for r in rows} == {"again"}
