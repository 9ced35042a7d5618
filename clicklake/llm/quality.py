"""Quality classifier: a byte-level convolutional network in numpy.

A text's UTF-8 bytes are cut into overlapping chunks that cover all of it. In each chunk, learned filters run over
embedded bytes; the largest answer of every filter goes through a hidden layer to one logit for the chunk. The mean,
least and largest logit of the chunks are combined into one probability. Everything is learned by gradient
descent on at most ``LABELLED`` labelled documents, drawn by a hash of their id.

Defined cases: a null or empty text is one chunk of zero bytes, and scored; a text of any length is scored whole;
equal texts score alike; labels that are null or neither 0 nor 1 are left out; without labels of both kinds, every
score is the share of ones among the labels that there are (one half if none); a null doc_id counts as the empty text in the
fold rule; an empty table gives no rows; other columns are not read, or pass through ``keep`` untouched.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicklake.llm.common import slices, table

LABELLED = 4000
CHUNK, STEP = 512, 384
WIDTH, STRIDE = 8, 4
EMBEDDING, FILTERS, HIDDEN = 8, 32, 16
EPOCHS, GROUP, RATE = 14, 32, 0.01
THRESHOLD = 0.3
POSITIONS = (CHUNK - WIDTH) // STRIDE + 1


def chunks(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """A row of bytes for each chunk, filled up with zeros, and each text's first row."""
    encoded = [(t or "").encode("utf-8", "replace") for t in texts]
    counts = np.array([max(0, -(-(len(e) - CHUNK) // STEP)) + 1 for e in encoded], np.int64)
    firsts = np.cumsum(counts) - counts
    rows = np.zeros((int(counts.sum()), CHUNK), np.uint8)
    for data, first, count in zip(encoded, firsts, counts):
        padded = np.zeros((count - 1) * STEP + CHUNK, np.uint8)
        padded[: len(data)] = np.frombuffer(data, np.uint8)
        rows[first : first + count] = np.lib.stride_tricks.sliding_window_view(padded, CHUNK)[::STEP]
    return rows, firsts


def sigmoid(x):
    return 0.5 * (1 + np.tanh(0.5 * x))


class Network:
    """The parameters by name; ``prior`` stands in for a network that could not be fitted."""

    def __init__(self, seed: int = 0, prior: float | None = None):
        draw = np.random.default_rng(seed)
        normal = lambda scale, *shape: (draw.standard_normal(shape) * scale).astype(np.float32)
        self.prior = prior
        self.p = {
            "embed": normal(0.5, 256, EMBEDDING),
            "filter": normal((WIDTH * EMBEDDING) ** -0.5, WIDTH * EMBEDDING, FILTERS),
            "filter_bias": np.zeros(FILTERS, np.float32),
            "hidden": normal(FILTERS**-0.5, FILTERS, HIDDEN),
            "hidden_bias": np.zeros(HIDDEN, np.float32),
            "out": normal(HIDDEN**-0.5, HIDDEN),
            "combine": np.array([1, 0.1, 0.1, 0], np.float32),
        }

    def _columns(self, rows: np.ndarray) -> np.ndarray:
        embedded = self.p["embed"][rows].reshape(len(rows), -1)
        windows = np.lib.stride_tricks.sliding_window_view(embedded, WIDTH * EMBEDDING, axis=1)
        return windows[:, :: STRIDE * EMBEDDING]

    def pooled(self, rows: np.ndarray, places: bool = False):
        """The largest answer of each filter in each chunk, and where it was found."""
        columns = np.ascontiguousarray(self._columns(rows)).reshape(-1, WIDTH * EMBEDDING)
        answers = (columns @ self.p["filter"]).reshape(len(rows), POSITIONS, FILTERS)
        if not places:
            return answers.max(axis=1) + self.p["filter_bias"]
        at = answers.argmax(axis=1)
        best = np.take_along_axis(answers, at[:, None], axis=1)[:, 0]
        return best + self.p["filter_bias"], at, columns.reshape(len(rows), POSITIONS, -1)

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if self.prior is not None:
            return np.full(len(texts), self.prior)
        rows, firsts = chunks(texts)
        logits = np.empty(len(rows), np.float32)
        for start in range(0, len(rows), 128):
            top = np.maximum(self.pooled(rows[start : start + 128]), 0)
            hidden = np.maximum(top @ self.p["hidden"] + self.p["hidden_bias"], 0)
            logits[start : start + 128] = hidden @ self.p["out"]
        return sigmoid(self._combined(logits, firsts)[0]).astype(float)

    def _combined(self, logits, firsts):
        count = np.diff(np.append(firsts, len(logits)))
        parts = [np.add.reduceat(logits, firsts) / count, np.minimum.reduceat(logits, firsts), np.maximum.reduceat(logits, firsts)]
        features = np.stack([*parts, np.ones(len(firsts), np.float32)], axis=1)
        return features @ self.p["combine"], features

    def gradients(self, texts: list[str | None], labels: np.ndarray) -> dict[str, np.ndarray]:
        rows, firsts = chunks(texts)
        best, at, columns = self.pooled(rows, places=True)
        top = np.maximum(best, 0)
        before = top @ self.p["hidden"] + self.p["hidden_bias"]
        hidden = np.maximum(before, 0)
        logits = hidden @ self.p["out"]
        total, features = self._combined(logits, firsts)
        error = ((sigmoid(total) - labels) / len(labels)).astype(np.float32)
        g = {"combine": features.T @ error}
        mean, least, most, _ = self.p["combine"]
        count = np.diff(np.append(firsts, len(rows)))
        owner = np.repeat(np.arange(len(firsts)), count)
        d_logits = error[owner] * (
            mean / count[owner] + least * (logits == features[owner, 1]) + most * (logits == features[owner, 2])
        )
        g["out"] = hidden.T @ d_logits
        d_before = d_logits[:, None] * self.p["out"] * (before > 0)
        g["hidden"], g["hidden_bias"] = top.T @ d_before, d_before.sum(axis=0)
        d_best = (d_before @ self.p["hidden"].T) * (best > 0)
        g["filter_bias"] = d_best.sum(axis=0)
        winners = np.take_along_axis(columns, at[:, :, None], axis=1)
        g["filter"] = np.einsum("nf,nfk->kf", d_best, winners)
        places = (at * STRIDE)[:, :, None] + np.arange(WIDTH)
        hit = rows[np.arange(len(rows))[:, None, None], places]
        d_windows = (d_best[:, :, None] * self.p["filter"].T).reshape(*hit.shape, EMBEDDING)
        flat, d_flat = hit.ravel(), d_windows.reshape(-1, EMBEDDING)
        g["embed"] = np.stack([np.bincount(flat, d_flat[:, e], 256) for e in range(EMBEDDING)], axis=1)
        return g


def fit(texts: list[str | None], labels: list[int], seed: int = 0) -> Network:
    """A network fitted by Adam; the order of the documents decides only the groups they are visited in."""
    labels = np.asarray(labels, np.float32)
    if len(set(labels.tolist())) < 2:
        return Network(prior=float(labels.mean()) if len(labels) else 0.5)
    net, draw = Network(seed), np.random.default_rng(seed + 1)
    first = {k: np.zeros_like(v) for k, v in net.p.items()}
    second = {k: np.zeros_like(v) for k, v in net.p.items()}
    epochs = max(EPOCHS, -(-2000 * EPOCHS // (4 * len(labels))))
    steps = epochs * -(-len(labels) // GROUP)
    step = 0
    for _ in range(epochs):
        order = draw.permutation(len(labels))
        for start in range(0, len(order), GROUP):
            group = order[start : start + GROUP]
            step += 1
            rate = RATE * (1 - (step - 1) / steps)
            for name, g in net.gradients([texts[i] for i in group], labels[group]).items():
                first[name] += np.float32(0.1) * (g - first[name])
                second[name] += np.float32(0.01) * (g * g - second[name])
                scale = np.sqrt(second[name] / (1 - 0.99**step)) + 1e-7
                net.p[name] = (net.p[name] - rate * first[name] / (1 - 0.9**step) / scale).astype(np.float32)
    return net


def fold(key):
    """crc32 of the id as text, modulo 5; remainder 0 is held out."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 5


def labelled(docs: DataFrame, labels: DataFrame, limit: int = LABELLED) -> DataFrame:
    """order, quality, text: at most ``limit`` labelled documents that are not held out, drawn by a hash of their id and text."""
    drawn = (
        labels.where(F.col("quality").isin(0, 1) & (fold(F.col("doc_id")) != 0))
        .select("doc_id", F.col("quality").cast("int").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "quality")
        .limit(limit)
    )
    return (
        docs.select("doc_id", "text")
        .join(F.broadcast(drawn), "doc_id")
        .select(F.xxhash64("doc_id", "text").alias("order"), "quality", "text")
        .orderBy("order", "quality")
        .limit(limit)
    )


def train(docs: DataFrame, labels: DataFrame, limit: int = LABELLED) -> Network:
    """A network fitted on the ``labelled`` documents. One task holds those few rows, the driver no more than the parameters."""

    def learn(batches):
        held = sorted((row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns))), key=lambda row: row[:2])
        net = fit([text for *_, text in held], [label for _, label, _ in held])
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps((net.prior, net.p))], pa.binary())], names=["net"])

    found = labelled(docs, labels, limit).repartition(1).mapInArrow(learn, "net binary").first()
    net = fit([], [])
    if found:
        net.prior, net.p = pickle.loads(found["net"])
    return net


def score(docs: DataFrame, net: Network) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in slices(batches, 256):
            found = np.round(net.scores(batch.column(2).to_pylist()), 6)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found), pa.array((found >= THRESHOLD).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    rows = docs.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "text")
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int")


def keep(docs: DataFrame, net: Network, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score at least ``threshold``, with all their columns."""
    place = docs.columns.index("text")

    def run(batches):
        for batch in slices(batches, 256):
            found = np.round(net.scores(batch.column(place).to_pylist()), 6)
            yield batch.filter(pa.array(found >= threshold))

    return docs.mapInArrow(run, docs.schema)


def op6_quality(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, train(docs, table(spark, sf_dir, "labels")))
