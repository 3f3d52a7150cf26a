"""Quality classifier: random-indexing word vectors and a small network.

Words (runs of letters or digits, and runs of other signs, as written) fall into a
fixed number of slots by hash. Every slot has a sparse index vector of +1 and -1,
made from its number. A slot's word vector is the sum of the index vectors of its
neighbours over the whole corpus, scaled to unit length, so its table has the same
size for any corpus. A text is pooled into the mean and the spread of its word
vectors, the likeness of neighbours, and its length. A network with one hidden layer, in
numpy, is fitted on a bounded sample of labelled texts, and a temperature on texts
kept apart makes its outputs probabilities.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylens.llm.boosting import sigmoid
from staylens.llm.shared import keyed_texts, pieces, small_batches, stored

SLOTS = 8192
SIZE = 32
NONZERO = 4
WINDOW = 2
HIDDEN = 24
#: Labelled texts that the network is fitted on (bound), the share of them kept for the temperature.
SAMPLE = 20_000
CALIBRATION = 0.2
THRESHOLD = 0.3
#: Words of a text that are turned into vectors at once.
BLOCK = 1 << 16

WORD = re.compile(r"[^\W_]+|[^\w\s]+|_+")


class Slots(dict):
    """Word to slot; emptied when full."""

    def __missing__(self, word: str) -> int:
        if len(self) >= 100_000:
            self.clear()
        self[word] = slot = zlib.crc32(word.encode("utf-8")) % SLOTS
        return slot


_SLOTS = Slots()


def slots(text: str) -> np.ndarray:
    words = WORD.findall(text)
    return np.fromiter(map(_SLOTS.__getitem__, words), np.int32, len(words))


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Per slot the positions of its non-zero entries and their signs."""
    rng = np.random.default_rng(42)
    at = np.argsort(rng.random((SLOTS, SIZE)), axis=1)[:, :NONZERO]
    return at.astype(np.int64), np.where(rng.random((SLOTS, NONZERO)) < 0.5, -1.0, 1.0)


def contexts(df: DataFrame) -> DataFrame:
    """``(slot, entries)``: sums of the neighbours' index vectors over all texts of
    ``df(text)``. A task sends each slot once at most, whatever it reads."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, sign = index_vectors()
        total = np.zeros(SLOTS * SIZE)
        held: list[np.ndarray] = []
        size = 0
        gap = np.full(WINDOW, -1, dtype=np.int32)

        def add() -> None:
            nonlocal size
            s = np.concatenate(held) if held else np.zeros(0, np.int32)
            held.clear()
            size = 0
            for step in range(1, WINDOW + 1):
                a, b = s[:-step], s[step:]
                both = (a >= 0) & (b >= 0)
                a, b = a[both], b[both]
                for x, y in ((a, b), (b, a)):
                    for k in range(NONZERO):
                        total[:] += np.bincount(x * np.int64(SIZE) + at[y, k], weights=sign[y, k], minlength=SLOTS * SIZE)

        for batch in pieces(batches):
            for text in batch.column(0).to_pylist():
                found = slots(text)
                held.extend((found, gap))
                size += len(found)
                if size > 4 * BLOCK:
                    add()
        add()
        table = total.reshape(SLOTS, SIZE)
        used = np.flatnonzero(np.abs(table).any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.FixedSizeListArray.from_arrays(pa.array(table[used].ravel(), pa.float64()), SIZE).cast(pa.list_(pa.float64()))], ["slot", "entries"]
        )

    parts = df.select("text").mapInArrow(summed, "slot int, entries array<double>")
    return parts.groupBy("slot").agg(F.array(*[F.sum(F.col("entries")[i]) for i in range(SIZE)]).alias("entries"))


def word_vectors(df: DataFrame) -> np.ndarray:
    """The table of unit word vectors, SLOTS x SIZE, for the texts of ``df``. Slots
    without neighbours keep their index vector."""
    at, sign = index_vectors()
    table = np.zeros((SLOTS, SIZE))
    np.put_along_axis(table, at, sign, axis=1)
    for row in contexts(df).collect():  # at most SLOTS rows
        table[row["slot"]] = row["entries"]
    # Without their common direction, vectors tell more of each word.
    table -= table.mean(axis=0)
    return (table / np.maximum(np.linalg.norm(table, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def pooled(text: str, vectors: np.ndarray) -> np.ndarray:
    """Mean, spread, mean likeness of neighbours, and log of the number of words."""
    found = slots(text)
    n = max(1, len(found))
    total, squares, alike = np.zeros(SIZE), np.zeros(SIZE), 0.0
    for start in range(0, len(found), BLOCK):
        v = vectors[found[start : start + BLOCK]]
        total += v.sum(axis=0, dtype=np.float64)
        squares += np.einsum("ij,ij->j", v, v)
        alike += float(np.einsum("ij,ij->", v[1:], v[:-1]))
    mean = total / n
    spread = np.sqrt(np.maximum(squares / n - mean**2, 0))
    return np.concatenate([mean, spread, [alike / n, float(mean @ mean), np.log1p(len(found))]])


def features(df: DataFrame, vectors: np.ndarray) -> DataFrame:
    """``(doc_id, x)`` of ``df(doc_id, text)``."""
    kind = df.schema["doc_id"].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            x = [pooled(t, vectors).astype(np.float32) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.list_(pa.float32()))], ["doc_id", "x"])

    return df.select("doc_id", "text").mapInArrow(rows, f"doc_id {kind}, x array<float>")


@dataclass
class Network:
    """Standardised inputs, tanh layer, logit, temperature."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logit(self, x: np.ndarray) -> np.ndarray:
        """Sums in a fixed order for each row: those of a matrix product depend on how
        many rows are multiplied at once, and equal texts would differ in the last bits."""
        x = (x - self.mean) / self.scale
        hidden = np.tile(self.b1, (len(x), 1))
        for j, weights in enumerate(self.w1):
            hidden += x[:, j : j + 1] * weights
        hidden = np.tanh(hidden)
        out = np.full(len(x), self.b2)
        for k, weight in enumerate(self.w2):
            out += hidden[:, k] * weight
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.logit(x) / self.temperature)


def fit(x: np.ndarray, y: np.ndarray, held: np.ndarray, hidden: int = HIDDEN, epochs: int = 60, penalty: float = 1e-4) -> Network:
    """Adam on log loss over the rows that aren't held; the temperature then minimises log loss on those that are."""
    rng = np.random.default_rng(42)
    train, target = x[~held].astype(float), y[~held].astype(float)
    net = Network(train.mean(axis=0), train.std(axis=0) + 1e-6, rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], hidden)), np.zeros(hidden), rng.normal(0, hidden**-0.5, hidden), 0.0)
    inputs = (train - net.mean) / net.scale
    values = [net.w1, net.b1, net.w2, np.array([0.0])]
    m, v, step = [np.zeros_like(p) for p in values], [np.zeros_like(p) for p in values], 0
    for epoch in range(epochs):
        order = rng.permutation(len(inputs))
        for start in range(0, len(order), 256):
            rows = order[start : start + 256]
            a = inputs[rows]
            h = np.tanh(a @ values[0] + values[1])
            d = (sigmoid(h @ values[2] + values[3][0]) - target[rows]) / len(rows)
            dh = np.outer(d, values[2]) * (1 - h * h)
            grads = [a.T @ dh + penalty * values[0], dh.sum(axis=0), h.T @ d + penalty * values[2], np.array([d.sum()])]
            step += 1
            rate = 0.01 * (1 - epoch / epochs) + 1e-4
            for i, g in enumerate(grads):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                values[i] = values[i] - rate * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
    net.w1, net.b1, net.w2, net.b2 = values[0], values[1], values[2], float(values[3][0])
    if held.any():
        z, t = net.logit(x[held]), y[held]
        losses = {c: float(np.mean(np.logaddexp(0, z / c) - t * z / c)) for c in np.exp(np.linspace(-2, 3, 101))}
        net.temperature = min(losses, key=losses.get)
    return net


def held_out(key: Column) -> Column:
    """Documents whose labels are never learned from: crc32 of the key as text, mod 5, is 0."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def labelled(keys: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``(doc_id, quality, h)``: the labels to learn from, at most ``sample`` (those of the
    smallest hashes), of keys that ``keys(doc_id)`` holds and that aren't held out."""
    known = labels.where("quality in (0, 1)").groupBy("doc_id").agg(F.max("quality").alias("quality")).where(~held_out(F.col("doc_id")))
    there = known.join(keys.select("doc_id"), "doc_id", "left_semi")
    return stored(there.withColumn("h", F.xxhash64("doc_id")).orderBy("h", "doc_id").limit(sample))


def learned(found: DataFrame, known: DataFrame, sample: int = SAMPLE) -> Network | None:
    """Fit on the rows of ``found(doc_id, x)`` that ``known`` has labels for, at most
    ``sample`` of them. None without any label of both kinds."""
    rows = found.join(F.broadcast(known), "doc_id").select("h", "quality", "x")  # at most ``sample`` rows are broadcast
    rows = rows.orderBy("h", F.xxhash64("x")).limit(sample).collect()
    y = np.array([r["quality"] for r in rows], dtype=float)
    if len(set(y)) < 2:
        return None
    held = np.array([(r["h"] >> 20) % 100 < 100 * CALIBRATION for r in rows])
    if len(set(y[~held])) < 2:
        held[:] = False
    return fit(np.array([r["x"] for r in rows], dtype=np.float32), y, held)


def scores(df: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``doc_id``, ``held_out``, ``score`` (0 to 1, likelihood of label 1)
    and ``predicted`` (1 from ``threshold`` on).

    NULL and empty texts are pooled to zeros and scored as such. Repeated rows get
    equal scores. Labels other than 0 and 1 are ignored, and of several for one key
    the larger counts; without labels of both kinds every score is 0.5. A NULL key
    stays NULL, is held out and never learned from.
    """
    rows = keyed_texts(df, key, text)
    found = stored(features(rows, word_vectors(rows)))
    net = learned(found, labelled(found, labels, sample), sample)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1) if len(batch) else np.zeros((0, 1))
            p = np.full(len(batch), 0.5) if net is None or not len(batch) else net.score(x)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p, pa.float64())], ["doc_id", "score"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    out = found.mapInArrow(scored, f"doc_id {kind}, score double")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def kept(df: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``df``, unchanged, whose text scores ``threshold`` or more. Texts
    are pooled again instead of joined to their scores, which moves no text."""
    small_batches(df.sparkSession)
    rows = keyed_texts(df, key, text)
    vectors = word_vectors(rows)
    known = labelled(rows, labels, sample)
    net = learned(stored(features(rows.join(F.broadcast(known), "doc_id", "left_semi"), vectors)), known, sample)
    if net is None:
        return df
    at = df.columns.index(text)

    def good(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            x = [pooled(t or "", vectors).astype(np.float32) for t in batch.column(at).to_pylist()]
            yield batch.filter(pa.array(net.score(np.array(x)) >= threshold if x else [], pa.bool_()))

    return df.mapInArrow(good, df.schema)
