"""Learned models and token packing: held-out accuracy, exact base scores, round trips."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from brute import EDGES, LOWER, WORD

import corpus_pipeline
from padron.llm import lm, packing
from padron.llm.toxicity import drop_toxic, score_toxicity

DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def documents(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text")
    rows = [(100_000 + i, t) for i, t in enumerate(EDGES)] + [(None, "no id here"), (100_000, None)]
    return docs.unionByName(spark.createDataFrame(rows, "doc_id long, text string"))


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{DATA}/labels.parquet")


def test_toxicity_on_held_out_documents(spark, documents, labels):
    scores = score_toxicity(documents, labels)
    rows = scores.collect()
    assert len(rows) == documents.count()
    for r in rows:
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
        assert r.held_out is None if r.doc_id is None else r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    judged = [(r.predicted, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    assert sum(p == t for p, t in judged) / len(judged) > 0.95
    assert all(r.predicted == 0 for r in rows if r.doc_id is not None and r.doc_id in (100_000, 100_001, 100_002))
    kept = drop_toxic(documents, labels)
    assert kept.columns == documents.columns
    assert kept.count() == sum(1 - r.predicted for r in rows)


def test_toxicity_of_misspelt_words(spark):
    rng = random.Random(1)
    plain = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    rows = []
    for i in range(400):
        words = rng.choices(plain, k=60)
        if i % 4 == 0:
            for k in rng.sample(range(60), 4):
                words[k] = rng.choice(["wretched", "wretchedly", "rottener", "rotten"])
        rows.append((i, " ".join(words), int(i % 4 == 0)))
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    new = [(1000, " ".join(plain[:30] + ["wretchedd", "rottenn", "wretchedness"])), (1001, " ".join(plain[:30]))]
    docs = frame.select("doc_id", "text").unionByName(spark.createDataFrame(new, "doc_id long, text string"))
    got = {r.doc_id: r.predicted for r in score_toxicity(docs, frame.select("doc_id", "toxic")).collect()}
    assert (got[1000], got[1001]) == (1, 0)


def test_toxicity_learns_from_whole_texts(spark):
    rng = random.Random(4)
    plain = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    rows = []
    for i in range(200):
        words = rng.choices(plain, k=800)
        if i % 4 == 0:
            for k in rng.sample(range(620, 800), 4):
                words[k] = rng.choice(["wretched", "wretchedly", "rottener", "rotten"])
        rows.append((i, " ".join(words), int(i % 4 == 0)))
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    new = [(1000, " ".join(plain[:30] + ["wretched", "rotten", "rottener"])), (1001, " ".join(plain[:30]))]
    docs = frame.select("doc_id", "text").unionByName(spark.createDataFrame(new, "doc_id long, text string"))
    got = {r.doc_id: r.predicted for r in score_toxicity(docs, frame.select("doc_id", "toxic")).collect()}
    assert (got[1000], got[1001]) == (1, 0)


def test_toxicity_without_labels(spark, documents, labels):
    assert {r.predicted for r in score_toxicity(documents, labels.limit(0)).collect()} == {0}
    assert score_toxicity(documents.limit(0), labels).count() == 0


@pytest.mark.parametrize("frequent", [lm.FREQUENT, 1e-4])
def test_language_model(spark, documents, monkeypatch, frequent):
    monkeypatch.setattr(lm, "FREQUENT", frequent)
    rows = lm.score_documents(documents).collect()
    texts = defaultdict(list)
    for r in documents.collect():
        texts[r.doc_id].append(WORD.findall((r.text or "").translate(LOWER)) + ["\n"])
    out = lambda d: None if d is None else zlib.crc32(str(d).encode()) % 7 == 2
    count = Counter(w for d, all_ in texts.items() if out(d) is False for t in all_ for w in t)
    total, kinds = sum(count.values()), len(count)
    held = []
    for r in rows:
        tokens = max(texts[r.doc_id], key=lambda t: len(t) == r.n_tokens)
        assert (r.held_out, r.n_tokens, r.train_tokens) == (out(r.doc_id), len(tokens), total)
        assert r.n_known == sum(count[w] > 0 for w in tokens)
        base = sum(math.log10((count[w] + 1) / (total + kinds + 1)) for w in tokens)
        assert math.isclose(r.base_score, base, rel_tol=1e-9, abs_tol=1e-6)
        if r.held_out:
            held.append(r)
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_language_model_is_normalised():
    rng = np.random.default_rng(1)
    triple = rng.integers(0, lm.CLASSES**3, 500)
    table = lm.train(np.unique(triple), np.ones(len(np.unique(triple))))
    assert np.allclose((10.0**table).sum(-1), 1, atol=1e-4)


def test_language_model_learns_from_every_triple():
    """Nothing is drawn in training, so the order of the counts changes nothing."""
    rng = np.random.default_rng(2)
    triple = np.unique(rng.integers(0, lm.CLASSES**3, 2000))
    count = rng.integers(1, 50, len(triple))
    table = lm.train(triple, count)
    assert np.allclose(table, lm.train(triple[::-1], count[::-1]), atol=1e-3)


def test_language_model_of_nothing(spark, documents):
    assert lm.score_documents(documents.limit(0)).count() == 0
    lone = spark.createDataFrame([(None, "a b")], "doc_id long, text string")
    row = lm.score_documents(lone).first()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.base_score) == (3, 0, 0, 0.0)


def test_best_fit_against_a_list():
    rng = random.Random(2)
    lengths = [rng.randint(1, 100) for _ in range(500)] + [100, 100, 1]
    rooms, rows = [], []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        fits = [k for k, room in enumerate(rooms) if room >= lengths[i]]
        k = min(fits, key=lambda k: rooms[k], default=len(rooms))
        if k == len(rooms):
            rooms.append(100)
            rows.append([])
        rooms[k] -= lengths[i]
        rows[k].append(i)
    got = packing.best_fit(lengths, 100)
    assert sorted(i for r in got for i in r) == list(range(len(lengths)))
    assert sorted(sum(lengths[i] for i in r) for r in got) == sorted(100 - room for room in rooms)


def test_packing_round_trip(spark, documents):
    import tiktoken  # noqa: F401

    encode = packing.encoder(packing.TOKENIZER)
    packed = packing.pack_documents(documents, capacity=256, group=20_000).collect()
    pieces = defaultdict(dict)
    full = 0
    for r in packed:
        ids = packing.read_ids(r.ids, r.n_tokens)
        assert len(ids) == r.n_tokens == r.cu_seqlens[-1] <= 256
        full += r.n_tokens
        for doc, piece, a, b in zip(r.doc_ids, r.pieces, r.cu_seqlens, r.cu_seqlens[1:], strict=False):
            pieces[doc].setdefault(piece, []).append(ids[a:b].tolist())
    assert full / len(packed) > 0.9 * 256
    once = [r for r in documents.collect() if r.doc_id is not None and r.doc_id != 100_000]
    for r in once:
        got = [i for k in sorted(pieces[r.doc_id]) for i in pieces[r.doc_id][k][0]]
        assert got == encode(r.text or "").tolist(), r.doc_id
    assert packing.pack_documents(documents.limit(0)).count() == 0


def test_matrices(spark, documents):
    packed = packing.pack_documents(documents.limit(40), capacity=128)
    blocks = packing.matrices(packed, rows=16, capacity=128).collect()
    assert sum(b.n_rows for b in blocks) == packed.count()
    for b in blocks:
        matrix = np.frombuffer(b.matrix, "<i4").reshape(b.n_rows, 128)
        places = np.frombuffer(b.positions, "<i4").reshape(b.n_rows, 128)
        for row, place, cu in zip(matrix, places, b.cu_seqlens, strict=True):
            assert (place[cu[:-1]] == 0).all() and (row[cu[-1] :] == packing.END_ID).all()
            assert set(np.flatnonzero(place == 0)) == {x for x in cu if x < 128}


def test_matrices_are_written_in_small_pages(spark, tmp_path):
    """A page of many matrices takes its size three times over while it is compressed."""
    rng = random.Random(3)
    texts = [(i, " ".join(str(rng.randrange(10**6)) for _ in range(20_000))) for i in range(24)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").coalesce(1)
    packing.pack_matrices(docs).write.parquet(str(tmp_path / "packed"))
    files = spark._jvm.org.apache.hadoop.fs.Path
    hadoop, conf = spark._jvm.org.apache.parquet.hadoop, spark._jsc.hadoopConfiguration()
    blocks = most = 0
    for file in (tmp_path / "packed").glob("*.parquet"):
        reader = hadoop.ParquetFileReader.open(hadoop.util.HadoopInputFile.fromPath(files(str(file)), conf))
        for group in reader.getFooter().getBlocks():
            for column in group.getColumns():
                if column.getPath().toDotString() in ("matrix", "positions"):
                    pages = reader.readOffsetIndex(column).getPageCount()
                    most = max(most, group.getRowCount() / pages)
                    blocks += group.getRowCount()
        reader.close()
    assert blocks >= 12 and most <= 4


def test_pipeline(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    kept, clean = docs, None
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, kept, DATA)
        assert out.columns == docs.columns
        kept = out
        if name == "decontamination":
            clean = {r.doc_id for r in out.collect()}
    mixed = kept.collect()
    assert {r.doc_id for r in mixed} <= clean
    words = lambda rows: sum(len(WORD.findall(r.text or "")) for r in rows)
    before = words(docs.filter(docs.doc_id.isin(list(clean))).collect())
    assert abs(words(mixed) - before) <= 20
    originals = {r.doc_id: r for r in docs.collect()}
    cut = [r for r in mixed if r.text != originals[r.doc_id].text]
    assert len(cut) <= 20 and all(originals[r.doc_id].text.startswith(r.text) and r.n_chars == len(r.text) for r in cut)
    packed = corpus_pipeline.run(spark, DATA)
    assert {d for r in packed.collect() for d in r.doc_ids} == {r.doc_id for r in mixed}
