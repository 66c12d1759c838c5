"""Quality rules: word statistics and a linear-chain CRF over the lines of a text.

Lines are described by shape features (length, symbols, digits, letter case, table
bars, repetition, sentence ends). A conditional random field with two states, content
and boilerplate, is trained in numpy on a bounded sample of labelled documents. A label says on
which side of one half a document's share of content lies; the states of its lines are
found in turns with the weights. Viterbi decoding marks every line of every document; the
share of characters in content lines decides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from padron.llm.words import POSITION, SPACES, Words, chunks, code_points, mix, per_row
from padron.sources.staging import stage

#: Fixed characters that count as symbols.
SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
MIN_WORDS = 50
REPEATED_PERCENT = 50
CONTENT_SHARE = 0.5
#: Bound on the labelled documents the CRF is trained on, those of the smallest hashes.
TRAINING_DOCUMENTS = 2000
#: Lines of all documents of the sample together; a document is taken whole or left out.
TRAINING_LINES = 50_000
#: Times that lines are given states and the CRF is fitted to them, after the first fit to the labels.
ROUNDS = 2
STEPS, RATE, PENALTY = 150, 0.2, 1e-3

_BREAK = np.arange(256) == 0x0A
COUNTS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
FEATURES = 12


def _marks(test: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(test)))


class Lines:
    """Newline-separated lines of the rows of a chunk, with their features."""

    def __init__(self, words: Words):
        data, bounds = words.data, words.bounds
        breaks = np.flatnonzero(data == 0x0A)
        self.starts = np.union1d(bounds[:-1], breaks + 1)
        self.starts = self.starts[self.starts < len(data)]
        self.ends = np.append(self.starts[1:], len(data))[: len(self.starts)]
        self.row = np.searchsorted(bounds, self.starts, "right") - 1
        inner = (self.ends > self.starts) & (data[np.maximum(self.ends - 1, 0)] == 0x0A)
        self.ends = self.ends - inner
        self.first_word = np.searchsorted(words.starts, self.starts)
        self.n_words = np.searchsorted(words.starts, self.ends) - self.first_word
        self.words, self.data = words, data

    def duplicates(self) -> np.ndarray:
        """Lines with a word that equal an earlier line of their row."""
        out = np.zeros(len(self.starts), bool)
        worded = np.flatnonzero(self.n_words > 0)
        if len(worded):
            # seen between line breaks only, a line is one "word"
            whole = Words(self.data, np.append(self.starts, len(self.data)), _BREAK, lower=False)
            key = np.zeros(len(self.starts), np.uint64)
            key[whole.row] = whole.hashes()
            key = mix(key[worded] + self.row[worded].astype(np.uint64) * POSITION[50])
            _, first = np.unique(key, return_index=True)
            again = np.ones(len(worded), bool)
            again[first] = False
            out[worded] = again
        return out

    def sizes(self) -> np.ndarray:
        """Code points of each line, its line break included."""
        return code_points(self.data, np.append(self.starts, len(self.data))) if len(self.row) else np.zeros(0, np.int64)

    def features(self, duplicate: np.ndarray) -> np.ndarray:
        data, (a, b) = self.data, (self.starts, self.ends)
        count = lambda test: (lambda m: m[b] - m[a])(_marks(test)).astype(np.float32)
        size = np.maximum(count((data & 0xC0) != 0x80), 1)
        upper = count((data >= 0x41) & (data <= 0x5A))
        lower = count((data >= 0x61) & (data <= 0x7A))
        digits = count((data >= 0x30) & (data <= 0x39))
        words = self.n_words.astype(np.float32)
        last = data[np.maximum(b - 1, 0)] if len(data) else np.zeros(len(a), np.uint8)
        out = np.stack(
            [
                np.ones(len(a), np.float32),
                np.log1p(words) / 4,
                (words < 4).astype(np.float32),
                np.minimum(count(SYMBOLS[data]) / np.maximum(words, 1), 2),
                np.minimum(count(data == 0x7C) / np.maximum(words, 1), 1),
                upper / np.maximum(upper + lower, 1),
                digits / size,
                np.minimum(count(data == 0x21) / np.maximum(words, 1), 1),
                duplicate.astype(np.float32),
                np.isin(last, np.frombuffer(b".!?", np.uint8)).astype(np.float32),
                np.minimum(size / np.maximum(words, 1) / 10, 3),
                (upper > 4 * (lower + 1)).astype(np.float32),
            ],
            axis=1,
        )
        return out


def statistics(data: np.ndarray, bounds: np.ndarray) -> tuple[list[np.ndarray], Lines, np.ndarray]:
    words = Words(data, bounds, SPACES, lower=False)
    lines = Lines(words)
    duplicate = lines.duplicates()
    hashes = words.hashes()
    at, window = words.windows(hashes, 3)
    repeat = np.zeros(len(words) + 3, bool)
    if len(at):
        key = mix(window + words.row[at].astype(np.uint64) * POSITION[51])
        _, which, times = np.unique(key, return_inverse=True, return_counts=True)
        found = at[times[which] > 1]
        for k in range(3):
            repeat[found + k] = True
    heads = _marks((data & 0xC0) != 0x80)
    counts = [
        words.count,
        per_row(words.rows, words.row, heads[words.ends] - heads[words.starts]),
        np.diff(_marks(SYMBOLS[data])[bounds]),
        per_row(words.rows, lines.row, duplicate),
        per_row(words.rows, words.row, repeat[: len(words)]),
    ]
    return [c.astype(np.int64) for c in counts], lines, duplicate


def viterbi(scores: np.ndarray, change: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Best state path of each run of lines; ``first`` marks where a document begins.

    Ties go to state 0 (content).
    """
    n = len(scores)
    back = np.zeros((n, 2), np.int8)
    path = np.zeros(n, np.int8)
    (s00, s01), (s10, s11) = change.tolist()
    best0 = best1 = 0.0
    rows, begins = scores.tolist(), first.tolist()
    for i, (x0, x1) in enumerate(rows):
        if begins[i]:
            best0, best1 = x0, x1
            continue
        a, b = best0 + s00, best1 + s10
        c, d = best0 + s01, best1 + s11
        back[i] = (a < b, c < d)
        best0, best1 = max(a, b) + x0, max(c, d) + x1
        rows[i] = (best0, best1)
    last = None
    for i in range(n - 1, -1, -1):
        if last is None:
            last = int(rows[i][0] < rows[i][1])
        path[i] = last
        last = None if begins[i] else int(back[i, last])
    return path


def chances(emit: np.ndarray, change: np.ndarray, starts: np.ndarray, lengths: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probability of each line's states, and of each pair of neighbouring states summed with the documents' weights.

    Forward-backward over documents of any lengths, which come longest first: at each
    step the documents that still have a line are the first ones.
    """
    forward, backward, pair = np.empty_like(emit), np.zeros_like(emit), np.zeros((2, 2))
    open_ = np.searchsorted(-lengths, -np.arange(int(lengths[0]) + 1), "left") if len(lengths) else np.zeros(1, int)
    forward[starts] = emit[starts]
    for t in range(1, len(open_) - 1):
        at = starts[: open_[t]] + t
        before = forward[at - 1]
        forward[at] = np.logaddexp(before[:, :1] + change[0], before[:, 1:] + change[1]) + emit[at]
    ends = forward[starts + lengths - 1]
    total = np.logaddexp(ends[:, 0], ends[:, 1])
    for t in range(len(open_) - 3, -1, -1):
        n = open_[t + 1]
        at = starts[:n] + t
        ahead = emit[at + 1] + backward[at + 1]
        joint = forward[at][:, :, None] + change + ahead[:, None, :] - total[:n, None, None]
        pair += (np.exp(joint) * weight[:n, None, None]).sum(0)
        backward[at] = np.logaddexp(change[:, 0] + ahead[:, :1], change[:, 1] + ahead[:, 1:])
    return np.exp(forward + backward - np.repeat(total, lengths)[:, None]), pair


def _ascend(x, states, starts, lengths, weight, weights, change, moving: bool) -> tuple[np.ndarray, np.ndarray]:
    """Gradient ascent on the likelihood of the lines' states; transitions stay as they are unless ``moving``."""
    step_w, step_c = np.zeros_like(weights), np.zeros_like(change)
    each = np.repeat(weight, lengths)
    truth = np.eye(2)[states]
    inner = np.ones(len(x), bool)
    inner[starts + lengths - 1] = False
    follows = np.flatnonzero(inner)
    seen = np.zeros((2, 2))
    np.add.at(seen, (states[follows], states[follows + 1]), each[follows])
    n = len(starts)
    for _ in range(STEPS):
        chance, pair = chances(x @ weights, change, starts, lengths, weight)
        grad_w = x.T @ ((truth - chance) * each[:, None]) / n - PENALTY * weights
        step_w += grad_w**2
        weights = weights + RATE * grad_w / np.sqrt(step_w + 1e-8)
        if moving:
            grad_c = (seen - pair) / n - PENALTY * change
            step_c += grad_c**2
            change = change + RATE * grad_c / np.sqrt(step_c + 1e-8)
    return weights, change


def constrained(junk: np.ndarray, size: np.ndarray, rejected: bool) -> np.ndarray:
    """Likelier state of each line of a document, with the least sure lines turned until its
    share of content characters agrees with its label."""
    state = (junk > 0.5).astype(np.int64)
    wrong, limit = int(not rejected), size.sum() * CONTENT_SHARE
    order = np.argsort(-junk if rejected else junk, kind="stable")
    content = size[state == 0].sum()
    for line in order[state[order] != int(rejected)]:
        if (content < limit) == rejected:
            break
        state[line] = 1 - wrong
        content += size[line] if wrong else -size[line]
    return state


def train(sequences: list[np.ndarray], labels: list[int], sizes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Weights (features x 2) and transitions (2 x 2) of the CRF; ``sizes`` are the characters of each line.

    A label says on which side of CONTENT_SHARE a document's share of content is; its
    lines have states of their own. They start from the label; weights fitted to that
    give each line its likelier state within the label's constraint, and the CRF is fitted
    to those states, ROUNDS times. With labels of one class only, or none, weights are
    zero and every line is content.
    """
    weights, change = np.zeros((FEATURES, 2)), np.zeros((2, 2))
    if len(set(labels)) < 2:
        return weights, change
    order = sorted(range(len(labels)), key=lambda i: -len(sequences[i]))
    x, size = np.concatenate([sequences[i] for i in order]), np.concatenate([sizes[i] for i in order])
    label = np.array([labels[i] for i in order])
    lengths = np.array([len(sequences[i]) for i in order])
    starts = np.cumsum(lengths) - lengths
    weight = 0.5 / (np.bincount(label, minlength=2) / len(label))[label] / lengths
    states = np.repeat(label, lengths)
    for turn in range(ROUNDS + 1):
        weights, change = _ascend(x, states, starts, lengths, weight, weights, change, turn > 0)
        chance, _ = chances(x @ weights, change, starts, lengths, weight)
        states = np.concatenate([constrained(chance[a : a + n, 1], size[a : a + n], bool(y)) for a, n, y in zip(starts, lengths, label, strict=True)])
    return weights, change


def training_sample(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, quality, text of the documents to learn from, each whole and once.

    At most TRAINING_DOCUMENTS labelled documents of the smallest hashes, as far as they
    have TRAINING_LINES lines together; those with more than a hundredth of these come last.
    Of several labels of a document the smallest counts, and of several texts.
    """
    chosen = (
        labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min("quality").cast("int").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(TRAINING_DOCUMENTS)
    )
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "quality").agg(F.min("text").alias("text"))
    rows = stage(rows.filter("text <> ''"), "labelled")
    lines = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1
    counted = rows.select("doc_id", lines.alias("lines"))
    order = Window.orderBy(F.col("lines") * 100 > TRAINING_LINES, F.xxhash64("doc_id"), "doc_id")  # of TRAINING_DOCUMENTS rows
    fits = counted.withColumn("upto", F.sum("lines").over(order)).filter(F.col("upto") <= TRAINING_LINES)
    return rows.join(F.broadcast(fits.select("doc_id")), "doc_id")


def _learned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found = []
    for batch in batches:
        for start, end, data, bounds in chunks(batch):
            _, lines, duplicate = statistics(data, bounds)
            features, size = lines.features(duplicate), lines.sizes()
            edges = np.searchsorted(lines.row, np.arange(end - start + 1))
            part = batch.slice(start, end - start)
            for a, b, doc, quality in zip(edges[:-1], edges[1:], part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                if b > a:
                    found.append((doc, features[a:b].astype(float), int(quality < 1), size[a:b]))
    found.sort(key=lambda r: r[0])
    weights, change = train([r[1] for r in found], [r[2] for r in found], [r[3] for r in found])
    yield pa.record_batch([pa.array([weights.ravel().tolist()]), pa.array([change.ravel().tolist()])], ["weights", "change"])


def learn(documents: DataFrame, labels: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The CRF learned from the bounded sample, in one task."""
    sample = training_sample(documents, labels).select("doc_id", "quality", "text").repartition(1)
    model = sample.mapInArrow(_learned, "weights array<double>, change array<double>").collect()
    if not model:
        return train([], [], [])
    return np.array(model[0].weights).reshape(FEATURES, 2), np.array(model[0].change).reshape(2, 2)


def judge_quality(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, the five counts, base_failed, kept, content_share for every row of ``documents``.

    Null text counts as empty; a text without lines has content share 0. Rows are judged
    one by one, so repeated rows get equal results; other columns are ignored.
    """
    weights, change = learn(documents, labels)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("doc_id"))
            for start, end, data, bounds in chunks(batch):
                counts, lines, duplicate = statistics(data, bounds)
                first = np.ones(len(lines.row), bool)
                first[1:] = lines.row[1:] != lines.row[:-1]
                path = viterbi(lines.features(duplicate) @ weights, change, first)
                size = lines.sizes()
                content = per_row(end - start, lines.row, size * (path == 0))
                total = per_row(end - start, lines.row, size)
                share = content / np.maximum(total, 1)
                yield pa.record_batch([ids.slice(start, end - start), *map(pa.array, counts), pa.array(share)], names)

    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "content_share"]
    judged = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(judge, f"doc_id long, {COUNTS}, content_share double")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEATED_PERCENT * F.col("n_words"))
    return judged.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("content_share") >= CONTENT_SHARE))
