"""The splitting tree: draws that vary as a hypergeometric number does, and shards that own blocks."""

from collections import defaultdict

import numpy as np
import pytest

from padron.llm import mixing, toxicity

DATA = "/root/testdata/sf0.01"


@pytest.mark.parametrize("held", [(600, 500, 100), (6 * 10**9, 5 * 10**9, 10**9), (3 * 10**12, 10**3, 10**12)])
def test_draws_vary_at_any_size(held):
    held = np.array(held, np.int64)
    total, draws = int(held.sum()), int(held.sum()) // 2
    found = np.array([mixing._draw(held, draws, np.random.default_rng([9, i])) for i in range(300)])
    assert (found.sum(1) == draws).all() and (found >= 0).all() and (found <= held).all()
    share = held / total
    mean, spread = draws * share, np.sqrt(draws * share * (1 - share) * (total - draws) / (total - 1))
    assert (np.abs(found.mean(0) - mean) < 5 * spread / np.sqrt(300) + 1e-9).all()
    assert (np.abs(found.std(0) / spread - 1) < 0.2).all()


def test_both_ways_to_draw_have_one_distribution(monkeypatch):
    draw = lambda i: mixing._drawn(70, 130, 50, np.random.default_rng([3, i]))
    one = np.bincount([draw(i) for i in range(4000)], minlength=51) / 4000
    monkeypatch.setattr(mixing, "_RANGE", 0)
    other = np.bincount([draw(i) for i in range(4000)], minlength=51) / 4000
    assert np.abs(np.cumsum(one) - np.cumsum(other)).max() < 0.04


@pytest.mark.parametrize("most", [mixing.MOST_BLOCKS, 500])
def test_shards_own_disjoint_blocks_that_add_up_to_the_quotas(spark, most):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    owner, sizes = {}, defaultdict(int)
    for r in mixing.plan_mix(docs, shards=8, most_blocks=most).collect():
        sizes[r.source] = int(r.target)
        for d in r.draws:
            assert owner.setdefault((r.source, d.block), d.shard) == d.shard
    total = sum(sizes.values())
    width = max(mixing.BLOCK_WORDS, -(-total // most))
    quota = {s: -(-n // width) for s, n in sizes.items()}
    assert all(0 <= block < quota[s] for s, block in owner)
    names = sorted(quota, key=lambda s: (s is None, s or ""))
    share = mixing.split_tree(np.array([quota[s] for s in names]), 8)
    for k, s in enumerate(names):
        assert share[:, k].sum() == quota[s]
        begins = np.searchsorted(np.cumsum(share[:, k]), range(quota[s]), "right")
        assert all(owner[s, b] == begins[b] for b in range(quota[s]) if (s, b) in owner)


def test_a_rare_insult_is_learned():
    rng = np.random.default_rng(1)
    letters = list("abcdefghiklmnoprstu")
    words = ["".join(rng.choice(letters, rng.integers(3, 9))) for _ in range(400)]
    texts = [" ".join(dict.fromkeys(rng.choice(words, 25))) + (" zwqkvx" if i % 25 == 0 else "") for i in range(300)]
    toxic = [int(i % 25 == 0) for i in range(300)]
    table, bias = toxicity.train(texts, [np.ones(len(t.split()), "<i8").tobytes() for t in texts], toxic)
    data = [np.frombuffer(t.encode(), np.uint8) for t in texts]
    scores = [toxicity.score_rows(toxicity.Words(d, np.array([0, len(d)]), toxicity.SPACES), table, bias)[0] for d in data]
    assert [int(s >= 0.5) for s in scores] == toxic
