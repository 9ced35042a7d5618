"""Toxicity by classifier chains of linear models.

A chain predicts its categories one after the other. Each link is a logistic regression over the text's words and
beginnings of words, hashed, and over the probabilities of all earlier links. Links are trained on out-of-fold
predictions: an earlier link's probability for a training document comes from a model that has not seen it, so
that later links learn to trust earlier ones as far as they deserve. For scoring, each link is fitted once more
on all training documents.

The features of a text are those of its distinct words, summed and divided by the square root of the number of
those words. A link's linear part is then a sum over words, so each distinct word is looked up once in a worker.

Training uses at most ``LABELLED`` labelled documents, drawn by a hash of their id; every document is scored whole.

Defined cases: words are runs of ``\\w``, lower-cased; a null text, an empty one, or one without words is scored by the
links' intercepts; equal texts score alike; labels that are null or neither 0 nor 1 are left out, and a category of
which only one kind is left has that constant probability; an empty table gives no rows; other columns are not
read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicklake.llm.common import WORD, slices, table, worker_cache

LABELLED = 4000
WORDS_HELD = 800_000
FOLDS = 5
BEGINNINGS = (4, 5, 6, 7)
BITS = 20
RARE = 3
THRESHOLD = 0.25
ROUNDS, RATE, SHRINK = 60, 0.5, 1e-4

#: Words of two kinds of abuse; with a toxic label they mark the training documents of the first two categories.
INSULTS = ["clown", "dumb", "fool", "idiot", "imbecile", "jerk", "loser", "moron", "stupid"]
CONTEMPT = ["disgusting", "filth", "garbage", "pathetic", "scum", "trash", "vermin", "worthless"]
CATEGORIES = ["insult", "contempt", "toxic"]


def features(word: str) -> list[int]:
    """Hashed features of a word: itself and its beginnings."""
    import xxhash

    names = [f"w{word}", *(f"b{word[:n]}" for n in BEGINNINGS if len(word) > n)]
    return [xxhash.xxh3_64_intdigest(n.encode("utf-8", "surrogatepass")) >> (64 - BITS) for n in names]


def distinct_words(text: str | None) -> set[str]:
    return set(WORD.findall(text.lower())) if text else set()


@dataclass
class Rows:
    """A sparse matrix: row and column of each entry, values scaled per row, and dense columns beside it."""

    row: np.ndarray
    column: np.ndarray
    value: np.ndarray
    shape: tuple[int, int]
    dense: np.ndarray

    def part(self, mask: np.ndarray) -> Rows:
        held = mask[self.row]
        number = np.cumsum(mask) - 1
        return Rows(number[self.row[held]], self.column[held], self.value[held], (int(mask.sum()), self.shape[1]), self.dense[mask])

    def with_dense(self, column: np.ndarray) -> Rows:
        return Rows(self.row, self.column, self.value, self.shape, np.column_stack([self.dense, column]))

    def linear(self, sparse: np.ndarray, dense: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.value * sparse[self.column], self.shape[0]) + self.dense @ dense


def logistic(rows: Rows, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights of sparse and dense columns by accelerated adaptive gradient steps; the last dense column is one."""
    sparse, dense = np.zeros(rows.shape[1]), np.zeros(rows.dense.shape[1])
    share = min(max(labels.mean(), 1e-3), 1 - 1e-3) if len(labels) else 0.5
    dense[0] = math.log(share / (1 - share))
    if len(labels) == 0 or labels.min() == labels.max():
        dense[0] = 20.0 * (2 * share - 1) if len(labels) else 0.0
        return sparse, dense
    first = [np.zeros_like(sparse), np.zeros_like(dense)]
    second = [np.zeros_like(sparse), np.zeros_like(dense)]
    for step in range(1, ROUNDS + 1):
        error = (0.5 * (1 + np.tanh(0.5 * rows.linear(sparse, dense))) - labels) / len(labels)
        gradients = [
            np.bincount(rows.column, rows.value * error[rows.row], rows.shape[1]) + SHRINK * sparse,
            rows.dense.T @ error,
        ]
        for i, (weights, g) in enumerate(zip((sparse, dense), gradients)):
            first[i] += 0.1 * (g - first[i])
            second[i] += 0.01 * (g * g - second[i])
            weights -= RATE * first[i] / (1 - 0.9**step) / (np.sqrt(second[i] / (1 - 0.99**step)) + 1e-6)
    return sparse, dense


def probability(x):
    return 0.5 * (1 + np.tanh(0.5 * np.asarray(x)))


@dataclass
class Chain:
    """Weights of each hashed feature (a row of one number for each link) and of each link's dense inputs."""

    categories: list[str]
    weights: dict[int, np.ndarray] = field(default_factory=dict)
    dense: list[np.ndarray] = field(default_factory=list)
    mark: str = ""

    def word(self, word: str) -> np.ndarray | float:
        total = 0.0
        for f in features(word):
            if (w := self.weights.get(f)) is not None:
                total = total + w
        return total

    def linear(self, texts: Sequence[str | None]) -> np.ndarray:
        """The sum over words for each text and link."""
        cache = worker_cache("toxicity")
        if cache.get("mark") != self.mark or len(cache["words"]) > WORDS_HELD:
            cache.clear()
            cache.update(mark=self.mark, words={}, sums=np.zeros((1 << 12, len(self.categories)), np.float32))
        words = cache["words"]
        out = np.zeros((len(texts), len(self.categories)))
        for i, text in enumerate(texts):
            held = distinct_words(text)
            for new in held.difference(words):
                place = words[new] = len(words)
                if place == len(cache["sums"]):
                    cache["sums"] = np.concatenate([cache["sums"], np.zeros_like(cache["sums"])])
                cache["sums"][place] = self.word(new)
            if held:
                at = np.fromiter(map(words.__getitem__, held), np.int64, len(held))
                out[i] = cache["sums"][np.sort(at)].sum(axis=0, dtype=float) / math.sqrt(len(held))
        return out

    def probabilities(self, texts: Sequence[str | None]) -> np.ndarray:
        linear = self.linear(texts)
        out = np.zeros_like(linear)
        for j, dense in enumerate(self.dense):
            out[:, j] = probability(linear[:, j] + dense[0] + out[:, :j] @ dense[1:])
        return out


def fit(words: Sequence[set[str]], labels: np.ndarray, categories: list[str], folds: np.ndarray) -> Chain:
    """A chain over documents given by their distinct words; ``labels`` has a column for each category."""
    known: dict[str, list[int]] = {}
    row, column = [], []
    for i, held in enumerate(words):
        for word in sorted(held):
            found = known.get(word) or known.setdefault(word, features(word))
            row += [i] * len(found)
            column += found
    row, column = np.array(row, np.int64), np.array(column, np.int64)
    often = np.bincount(column, minlength=1 << BITS)[column] >= RARE
    row, column = row[often], column[often]
    names, column = np.unique(column, return_inverse=True)
    scale = np.array([1 / math.sqrt(max(1, len(held))) for held in words])
    rows = Rows(row, column, scale[row] if len(row) else scale[:0], (len(words), len(names)), np.ones((len(words), 1)))
    links, dense = [], []
    for j in range(len(categories)):
        sparse, inputs = logistic(rows, labels[:, j])
        links.append(sparse)
        dense.append(inputs)
        if j + 1 < len(categories):
            unseen = np.zeros(len(words))
            for k in np.unique(folds):
                held = folds == k
                part = rows.part(held)
                unseen[held] = probability(part.linear(*logistic(rows.part(~held), labels[~held, j])))
            rows = rows.with_dense(unseen)
    table = np.array(links).T
    chain = Chain(categories, {int(n): w for n, w in zip(names, table)}, dense)
    chain.mark = f"{hash(table.tobytes())}-{len(words)}"
    return chain


def train(
    docs: DataFrame, labels: DataFrame, categories: list[str] = CATEGORIES, limit: int = LABELLED,
    mark: Callable[[str, int], list[int]] | None = None,
) -> Chain:
    """Fits on at most ``limit`` labelled documents; ``mark`` gives a document's categories from text and label."""
    mark = mark or mark_categories
    drawn = (
        labels.where(F.col("toxic").isin(0, 1))
        .select("doc_id", F.col("toxic").cast("int").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "toxic")
        .limit(limit)
    )

    def words(batches):
        for batch in slices(batches, 256):
            texts, toxic = (batch.column(i).to_pylist() for i in (0, 1))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([sorted(distinct_words(t)) for t in texts], pa.list_(pa.string())),
                    pa.array([mark(t or "", x) for t, x in zip(texts, toxic)], pa.list_(pa.int32())),
                    batch.column(2),
                ],
                names=["words", "marks", "fold"],
            )

    fold = F.pmod(F.xxhash64("doc_id", "text"), F.lit(FOLDS)).cast("int")
    rows = (
        docs.select("doc_id", "text")
        .join(F.broadcast(drawn), "doc_id")
        .orderBy(F.xxhash64("doc_id", "text"), "toxic")
        .limit(limit)
        .select("text", "toxic", fold.alias("fold"))
        .mapInArrow(words, "words array<string>, marks array<int>, fold int")
        .toArrow()
    )
    marks = np.array(rows["marks"].to_pylist(), float).reshape(rows.num_rows, len(categories))
    return fit([set(w) for w in rows["words"].to_pylist()], marks, categories, rows["fold"].to_numpy())


def mark_categories(text: str, toxic: int) -> list[int]:
    """insult, contempt, toxic: the label itself, and whether a toxic text holds words of either kind."""
    held = distinct_words(text) if toxic else set()
    return [int(bool(held.intersection(kind))) for kind in (INSULTS, CONTEMPT)] + [toxic]


def score(docs: DataFrame, chain: Chain, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, a probability for each category, and toxic: whether the last one reaches the threshold."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = [f"p_{c}" for c in chain.categories]

    def run(batches):
        for batch in slices(batches, 256):
            found = np.round(chain.probabilities(batch.column(1).to_pylist()), 6)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c) for c in found.T.copy()), pa.array(found[:, -1] >= threshold)],
                names=["doc_id", *names, "toxic"],
            )

    schema = ", ".join([f"doc_id {kind}", *(f"{n} double" for n in names), "toxic boolean"])
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def op3_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, train(docs, table(spark, sf_dir, "labels")))
