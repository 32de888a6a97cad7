"""Language identification by a convolutional network over bytes.

Texts are read as windows of 256 UTF-8 bytes. A window's bytes are embedded, filters of widths 2, 3
and 4 slide over them, each filter's greatest response goes through a rectifier, and a softmax
gives a probability per language. A document's prediction is the mean over all its windows, by the
bytes they hold, so texts of any length are read whole.

Training is plain numpy (Adam on the cross-entropy, fixed seed) on a bounded sample: at most
`SAMPLE` documents over all languages, those with the smallest hash of doc_id, and at most
`WINDOWS` evenly spaced windows of each. Inside Spark the network is applied in map tasks; the
first two filter bytes are looked up as one byte pair, so a position costs two table rows.

A null text, or one without a letter, is `und` with score 0. Without a single labelled text there
is nothing to learn and every document is `und`. Rows with a null label or text are never learnt
from. A null doc_id counts as the empty string in the split. Repeated rows get equal results; an
empty table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

WINDOW, EMBEDDED, FILTERS, WIDTHS = 256, 8, 16, (2, 3, 4)
SAMPLE, WINDOWS = 2048, 12
STEPS, BATCH, RATE = 500, 64, 0.01
UNKNOWN = "und"
_REACH = max(WIDTHS) - 1
#: Positions that one pass looks up.
_PASS = 1 << 13


def _has_letter(text: str) -> bool:
    """Whether a character is of a Unicode category of letters; digits, fractions and numbers in
    circles are not."""
    return any(map(str.isalpha, text))


@dataclass
class Network:
    """Embedding (256, e), one (width, e, f) kernel per width, output layer; labels in order."""

    labels: list[str]
    embedding: np.ndarray
    kernels: list[np.ndarray]
    biases: list[np.ndarray]
    output: np.ndarray
    offset: np.ndarray

    def parameters(self) -> list[np.ndarray]:
        return [self.embedding, *self.kernels, *self.biases, self.output, self.offset]


def _fresh(labels: list[str], rng: np.random.Generator) -> Network:
    scale = lambda *shape: rng.normal(0, 1 / np.sqrt(np.prod(shape[:-1])), shape).astype(np.float32)
    return Network(
        labels,
        rng.normal(0, 0.5, (256, EMBEDDED)).astype(np.float32),
        [scale(w, EMBEDDED, FILTERS) for w in WIDTHS],
        [np.zeros(FILTERS, np.float32) for _ in WIDTHS],
        scale(FILTERS * len(WIDTHS), len(labels)),
        np.zeros(len(labels), np.float32),
    )


def _gradients(net: Network, windows: np.ndarray, truth: np.ndarray) -> list[np.ndarray]:
    rows = np.arange(len(windows))
    tops, places = [], []
    for kernel, bias in zip(net.kernels, net.biases):
        response = sum(
            (net.embedding @ kernel[o])[windows[:, o : o + WINDOW]] for o in range(len(kernel))
        )
        place = response.argmax(axis=1)
        places.append(place)
        tops.append(np.take_along_axis(response, place[:, None, :], axis=1)[:, 0, :] + bias)
    pooled = np.concatenate(tops, axis=1)
    hidden = np.maximum(pooled, 0)
    logits = hidden @ net.output + net.offset
    chances = np.exp(logits - logits.max(axis=1, keepdims=True))
    chances /= chances.sum(axis=1, keepdims=True)
    chances[rows, truth] -= 1
    chances /= len(windows)
    back = (chances @ net.output.T) * (pooled > 0)
    embedding = np.zeros_like(net.embedding)
    kernels, biases = [], []
    for k, (kernel, place) in enumerate(zip(net.kernels, places)):
        part = back[:, k * FILTERS : (k + 1) * FILTERS]
        change = np.zeros_like(kernel)
        for o in range(len(kernel)):
            seen = windows[rows[:, None], place + o]
            change[o] = np.einsum("bfe,bf->ef", net.embedding[seen], part)
            np.add.at(embedding, seen.ravel(), (part[:, :, None] * kernel[o].T[None]).reshape(-1, EMBEDDED))
        kernels.append(change)
        biases.append(part.sum(axis=0))
    return [embedding, *kernels, *biases, hidden.T @ chances, chances.sum(axis=0)]


def train(windows: np.ndarray, truth: np.ndarray, labels: list[str], seed: int = 0) -> Network:
    """Network for windows (n, WINDOW + reach) of bytes; languages are drawn equally often."""
    rng = np.random.default_rng(seed)
    net = _fresh(labels, rng)
    by_label = [np.flatnonzero(truth == i) for i in range(len(labels))]
    state = [(np.zeros_like(p), np.zeros_like(p)) for p in net.parameters()]
    for step in range(1, STEPS + 1):
        drawn = rng.integers(0, len(labels), BATCH)
        chosen = np.array([by_label[i][rng.integers(len(by_label[i]))] for i in drawn])
        batch = windows[chosen].copy()
        for row in np.flatnonzero(rng.random(BATCH) < 0.4):  # short texts must be known too
            batch[row, rng.integers(12, WINDOW) :] = 0
        rate = RATE * min(1.0, 2 * (1 - step / STEPS) + 0.02)
        for value, (mean, square), change in zip(net.parameters(), state, _gradients(net, batch, drawn)):
            mean += 0.1 * (change - mean)
            square += 0.01 * (change * change - square)
            value -= (rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return net


class Reader:
    """Applies a network; built once per task from its few parameters."""

    def __init__(self, net: Network):
        self.net = net
        single = [[net.embedding @ k[o] for o in range(len(k))] for k in net.kernels]
        pair = lambda a, b: (a[:, None, :] + b[None, :, :]).reshape(65536, -1)
        nothing = np.zeros_like(single[0][0])
        self.first = np.concatenate([pair(s[0], s[1]) for s in single], axis=1)
        self.second = np.concatenate([pair(single[1][2], nothing), pair(single[2][2], single[2][3])], axis=1)

    def windows(self, data: np.ndarray) -> np.ndarray:
        """Probabilities of the windows that fill `data`, which has some zeros behind."""
        count = (len(data) - _REACH) // WINDOW
        pairs = data[:-1].astype(np.int32) * 256 + data[1:]
        pooled = np.empty((count, FILTERS * len(WIDTHS)), np.float32)
        for start in range(0, count, _PASS // WINDOW):
            end = min(count, start + _PASS // WINDOW)
            at = slice(start * WINDOW, end * WINDOW)
            response = self.first[pairs[at]]
            response[:, FILTERS:] += self.second[pairs[at.start + 2 : at.stop + 2]]
            pooled[start:end] = response.reshape(end - start, WINDOW, -1).max(axis=1)
        hidden = np.maximum(pooled + np.concatenate(self.net.biases), 0)
        logits = hidden @ self.net.output + self.net.offset
        chances = np.exp(logits - logits.max(axis=1, keepdims=True))
        return chances / chances.sum(axis=1, keepdims=True)

    def documents(self, texts: list[bytes]) -> np.ndarray:
        """Mean probabilities of each text, by the bytes of its windows."""
        counts = [(len(t) + _REACH) // WINDOW + 1 for t in texts]
        data = np.zeros(sum(counts) * WINDOW + _REACH + 1, np.uint8)
        weights, at = [], 0
        for text, count in zip(texts, counts):
            data[at : at + len(text)] = np.frombuffer(text, np.uint8)
            weights.append(np.clip(len(text) - WINDOW * np.arange(count), 0, WINDOW))
            at += count * WINDOW
        chances = self.windows(data[:-1]) * np.concatenate(weights)[:, None]
        begins = np.cumsum([0, *counts[:-1]])
        return np.add.reduceat(chances, begins, axis=0) / np.array([max(1, len(t)) for t in texts])[:, None]


def _groups(texts: list[str | None]) -> Iterator[list[int]]:
    """Indices of texts with a letter, in groups of bounded size."""
    held, size = [], 0
    for i, text in enumerate(texts):
        if text is None or not _has_letter(text):
            continue
        held.append(i)
        size += len(text)
        if size >= 1 << 18:
            yield held
            held, size = [], 0
    if held:
        yield held


def _predict(net: Network | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(net) if net else None
        for batch in batches:
            texts = batch.column("text").to_pylist()
            named, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
            for group in _groups(texts) if reader else ():
                chances = reader.documents([texts[i].encode() for i in group])
                for i, row in zip(group, chances):
                    best = int(row.argmax())
                    named[i], scores[i] = net.labels[best], min(1.0, float(row[best]))
            others = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in others), pa.array(named, pa.string()), pa.array(scores, pa.float64())],
                names=[*others, "lang_pred", "score"],
            )

    return run


def _take_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        labels, parts = [], []
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            if text is None or not _has_letter(text):
                continue
            data = text.encode()
            last = max(0, len(data) - WINDOW)
            for at in sorted({round(last * i / max(1, WINDOWS - 1)) for i in range(WINDOWS)}):
                labels.append(lang)
                parts.append(data[at : at + WINDOW + _REACH])
        yield pa.RecordBatch.from_arrays([pa.array(labels, pa.string()), pa.array(parts, pa.binary())], names=["lang", "part"])


def held_out(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 4 == 2


def fit(docs: DataFrame) -> Network | None:
    """The network learnt from labelled rows outside the held-out quarter.

    Every language gives the first rows by the hashes of doc_id and text, copies counted, so equal
    inputs give equal samples whatever ties. The choice comes from narrow columns and has `SAMPLE`
    rows at most, or one per language; only the windows of those rows, `WINDOWS` of 259 bytes each
    at most, reach the driver."""
    learnable = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out())
    hashed = learnable.select(
        "lang", "text", F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("_h"), F.xxhash64("text").alias("_t")
    )
    labels = sorted(r["lang"] for r in hashed.select("lang").distinct().collect())
    if not labels:
        return None
    each = max(1, SAMPLE // len(labels))
    first = Window.partitionBy("lang").orderBy("_h", "_t")
    chosen = (
        hashed.select("lang", "_h", "_t")
        .withColumn("_r", F.row_number().over(first))
        .where(F.col("_r") <= each)
        .groupBy("lang", "_h", "_t")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    chosen = docs.sparkSession.createDataFrame(chosen.collect(), chosen.schema)
    taken = (
        hashed.join(F.broadcast(chosen), ["lang", "_h", "_t"])
        .dropDuplicates(["lang", "_h", "_t"])
        .select("lang", "text", F.explode(F.sequence(F.lit(1).cast("bigint"), "_n")))
        .select("lang", "text")
        .mapInArrow(_take_windows, "lang string, part binary")
        .orderBy("lang", "part")
        .collect()
    )
    windows = np.zeros((len(taken), WINDOW + _REACH), np.uint8)
    for row, r in zip(windows, taken):
        row[: len(r["part"])] = np.frombuffer(r["part"], np.uint8)
    labels = sorted({r["lang"] for r in taken})
    if not labels:
        return None
    return train(windows, np.array([labels.index(r["lang"]) for r in taken]), labels)


def predict(docs: DataFrame, net: Network | None, keep: list[str]) -> DataFrame:
    """The columns `keep` of `docs` with lang_pred and score. Only the text is looked at."""
    row = docs.select(F.struct(*keep).alias("row"), "text")
    kind = row.schema["row"].dataType.simpleString()
    return row.mapInArrow(_predict(net), f"row {kind}, lang_pred string, score double").select("row.*", "lang_pred", "score")


def languages(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score for every row of `documents`."""
    return predict(docs, fit(docs), ["doc_id"]).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
