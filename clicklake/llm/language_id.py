"""Language identification by hierarchical discrimination.

Texts are compared by their runs of one to four letters, with one blank between words: frequencies hashed into ``DIMENSIONS``
places. First the language's family is predicted, by a linear support vector machine for each family against the rest;
then linear machines, one for each pair of languages within the family, vote on the language. All are fitted by dual
coordinate descent on at most ``LABELLED`` labelled documents, as many of each language as there are.

A machine's score is linear in frequencies, so scoring looks the weights of a text's runs up and adds them; weights are whole numbers
(parts of ``UNIT``), so sums, and with them the result, do not depend on how rows are batched. Memory is bounded by windows of
``WINDOW`` letters over a batch, whatever the length of a text.

Families of languages are a parameter; a language that it does not name is a family of its own.

Defined cases: a null text and one without a letter is ``und`` with score 0; any other gets one of the learned languages, and a text
of one letter too; a text of any length is read whole; equal texts get equal answers; a null or empty ``lang`` teaches nothing; with one
learned language all texts get it, with none all are ``und``; a null doc_id counts as the empty text in the fold rule; rows that
share an id are each scored; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clicklake.llm.common import byte_slices, mix, table, worker_cache

LABELLED = 2048
#: The most frequent languages, at most so many, are learned.
LANGUAGES = 1000
DIMENSIONS = 1 << 13
ORDERS = 4
WINDOW = 1 << 17
ROWS, SIZE = 1024, 1 << 18
UNIT = 1 << 16
SCALE, COST, EPOCHS, BIAS = 16.0, 10.0, 30, 0.25
STEEPNESS = 4.0
UNKNOWN = "und"

#: Common language codes by family.
FAMILIES = {
    "germanic": ["af", "da", "de", "en", "fo", "fy", "is", "lb", "nb", "nl", "nn", "no", "sv", "yi"],
    "romance": ["ca", "es", "fr", "gl", "it", "la", "oc", "pt", "rm", "ro"],
    "slavic": ["be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"],
    "baltic": ["lt", "lv"],
    "celtic": ["br", "cy", "ga", "gd"],
    "uralic": ["et", "fi", "hu", "se"],
    "turkic": ["az", "kk", "ky", "tk", "tr", "tt", "ug", "uz"],
    "indic": ["bn", "gu", "hi", "mr", "ne", "pa", "si", "ur"],
    "dravidian": ["kn", "ml", "ta", "te"],
    "iranian": ["fa", "ku", "ps", "tg"],
    "semitic": ["am", "ar", "he", "mt"],
    "austronesian": ["id", "jv", "mg", "mi", "ms", "su", "tl"],
    "chinese": ["wuu", "yue", "zh"],
}


def _letters() -> np.ndarray:
    cache = worker_cache("language id")
    if "letters" not in cache:
        cache["letters"] = np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)
    return cache["letters"]


def normalized(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of the texts, each text's first place, and its number of them (0 without a letter).

    A text is three zeros, a blank, and its words, lower-cased, with a blank after each; three zeros are at the very end.
    """
    lower = [(t or "").lower() for t in texts]
    codes = np.frombuffer("".join(t + "\n" for t in lower).encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.array([len(t) + 1 for t in lower], np.int64)
    letter = _letters()[codes]
    kept = letter.copy()
    kept[1:] |= letter[:-1]
    number = np.add.reduceat(kept, np.cumsum(sizes) - sizes, dtype=np.int64) if len(sizes) else sizes
    firsts = np.cumsum(number) - number + 4 * np.arange(len(sizes))
    out = np.zeros(int(number.sum()) + 4 * len(sizes) + 3, np.uint32)
    place = np.flatnonzero(kept)
    target = np.arange(len(place)) + np.repeat(4 * np.arange(1, len(sizes) + 1), number)
    out[target] = np.where(letter[place], codes[place], 32)
    out[firsts[number > 0] + 3] = 32
    return out, firsts, number


def runs(codes: np.ndarray, a: int, b: int):
    """For each length, the hashed place of the run that begins at each of a .. b - 1; ``DIMENSIONS`` where none does."""
    value = mix(codes[a : b + ORDERS - 1].astype(np.uint64)).astype(np.uint32)
    there = codes[a : b + ORDERS - 1] != 0
    hashed = np.zeros(b - a, np.uint32)
    for k in range(ORDERS):
        hashed = (hashed ^ value[k : k + b - a]) * np.uint32(0x9E3779B1)
        place = ((hashed ^ (hashed >> np.uint32(15))) * np.uint32(0x85EBCA6B)) >> np.uint32(32 - 13)
        yield np.where(there[: b - a] & there[k : k + b - a], place, DIMENSIONS)


def run_counts(number: np.ndarray) -> np.ndarray:
    """How many runs a text of so many code points has (its first blank is not among them)."""
    held = np.where(number > 0, number + 1, 0)
    return sum(np.maximum(held - k, 0) for k in range(ORDERS))


def frequencies(texts: list[str | None]) -> np.ndarray:
    """A row of hashed frequencies for each text, times ``SCALE``, and the bias."""
    out = np.zeros((len(texts), DIMENSIONS + 1), np.float32)
    for row, text in zip(out, texts):
        codes, _, number = normalized([text])
        for a in range(0, len(codes) - ORDERS + 1, WINDOW):
            for place in runs(codes, a, min(a + WINDOW, len(codes) - ORDERS + 1)):
                row += np.bincount(place, minlength=DIMENSIONS + 1)
        row *= SCALE / max(1, int(run_counts(number)[0]))
    out[:, DIMENSIONS] = BIAS
    return out


def fit_machine(x: np.ndarray, y: np.ndarray, seed: int = 0) -> np.ndarray:
    """Weights of a linear support vector machine (hinge loss, labels -1 and 1) by dual coordinate descent.

    The cost of an error is shared out so that both sides weigh alike.
    """
    weight = np.zeros(x.shape[1], np.float32)
    norm = np.einsum("ij,ij->i", x, x)
    cost = COST * np.where(y > 0, len(y) / (2 * max(1, (y > 0).sum())), len(y) / (2 * max(1, (y < 0).sum())))
    held = np.zeros(len(y))
    draw = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        moved = 0.0
        for i in draw.permutation(len(y)):
            slope = y[i] * float(x[i] @ weight) - 1
            new = min(max(held[i] - slope / norm[i], 0.0), cost[i])
            if new != held[i]:
                weight += np.float32((new - held[i]) * y[i]) * x[i]
                moved = max(moved, abs(new - held[i]))
                held[i] = new
        if moved < 1e-3:
            break
    return weight


@dataclass
class Model:
    """Families, each with its languages; columns of ``weights`` are families, then pairs of languages (-1 and 1 of each)."""

    families: list[list[str]]
    pairs: list[tuple[str, str]]
    weights: np.ndarray

    def margins(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Each machine's score of each text, and whether the text has a letter."""
        codes, firsts, number = normalized(texts)
        total = np.zeros((len(texts), self.weights.shape[1]), np.int64)
        for a in range(0, len(codes) - ORDERS + 1, WINDOW):
            b = min(a + WINDOW, len(codes) - ORDERS + 1)
            first, last = np.searchsorted(firsts, a, "right") - 1, np.searchsorted(firsts, b, "left")
            starts = np.maximum(firsts[first:last] - a, 0)
            for place in runs(codes, a, b):
                total[first:last] += np.add.reduceat(self.weights[place], starts, axis=0, dtype=np.int64)
        each = SCALE / UNIT / np.maximum(run_counts(number), 1)
        return total * each[:, None] + BIAS / UNIT * self.weights[DIMENSIONS + 1], number > 0

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """A language and a score in 0 .. 1 for each text."""
        if not self.families or not texts:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        margins, lettered = self.margins(texts)
        score = np.ones(len(texts))
        family = np.zeros(len(texts), int)
        if (n := len(self.families)) > 1:
            family = margins[:, :n].argmax(axis=1)
            best = np.sort(margins[:, :n], axis=1)
            score *= 1 / (1 + np.exp(-STEEPNESS * (best[:, -1] - best[:, -2])))
            margins = margins[:, n:]
        out = np.empty(len(texts), object)
        for f, languages in enumerate(self.families):
            rows = np.flatnonzero(family == f)
            place = {x: i for i, x in enumerate(languages)}
            votes, sums, least = (np.zeros((len(rows), len(languages))) for _ in range(3))
            least += np.inf
            for column, pair in enumerate(self.pairs):
                if pair[0] in place:
                    for sign, name in zip((-1, 1), pair):
                        duel, i = sign * margins[rows, column], place[name]
                        votes[:, i] += (duel > 0) + 0.5 * (duel == 0)
                        sums[:, i] += duel
                        least[:, i] = np.minimum(least[:, i], duel)
            # most votes; among equals the larger sum, then the first by name
            leading = votes == votes.max(axis=1, keepdims=True)
            chosen = np.where(leading, sums, -np.inf).argmax(axis=1)
            out[rows] = np.array(languages, object)[chosen]
            score[rows] *= 1 / (1 + np.exp(-STEEPNESS * least[np.arange(len(rows)), chosen]))
        out[~lettered] = UNKNOWN
        return out.tolist(), np.where(lettered, np.round(score, 6), 0.0)


def fit(texts: list[str | None], languages: list[str], families: dict[str, list[str]] = FAMILIES) -> Model:
    """The machines of both levels, from labelled texts."""
    family_of = {x: name for name, members in families.items() for x in members}
    learned = sorted(set(languages))
    groups: dict[tuple, list[str]] = {}
    for language in learned:
        groups.setdefault((family_of.get(language) is None, family_of.get(language, language)), []).append(language)
    members = [groups[g] for g in sorted(groups)]
    x, y = frequencies(texts), np.array(languages, object)
    columns, pairs = [], []
    if len(members) > 1:
        columns += [fit_machine(x, np.where(np.isin(y, group), 1, -1)) for group in members]
    for group in members:
        for i, one in enumerate(group):
            for other in group[i + 1 :]:
                some = (y == one) | (y == other)
                columns.append(fit_machine(x[some], np.where(y[some] == other, 1, -1)))
                pairs.append((one, other))
    # between the places and the bias, a row of zeros for what is no run
    weights = np.array(columns, np.float64).reshape(len(columns), -1).T if columns else np.zeros((DIMENSIONS + 1, 0))
    weights = np.insert(weights, DIMENSIONS, 0, axis=0)
    return Model(members, pairs, np.round(weights * UNIT).astype(np.int32))


def fold(key):
    """crc32 of the id as text, modulo 4; remainder 2 is held out."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 4


def train(docs: DataFrame, limit: int = LABELLED, families: dict[str, list[str]] = FAMILIES) -> Model:
    """Fits on at most ``limit`` documents with a language that are not held out, drawn by a hash, languages in turn."""
    known = (F.col("lang") != "") & (fold(F.col("doc_id")) != 2)
    place = F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 1).alias("place")
    rows = docs.where(known).select("lang", "text", place)
    # of a language with n documents, about 4 * limit are ranked, whatever n is: those below that share of all hashes
    upto = F.greatest(F.min("place"), (F.least(F.lit(4.0 * limit) / F.count("*"), F.lit(1.0)) * float((1 << 63) - 1024)).cast("long")).alias("upto")
    shares = rows.groupBy(F.col("lang").alias("language")).agg(F.count("*").alias("n"), upto)
    shares = shares.orderBy(F.desc("n"), "language").limit(LANGUAGES).select("language", "upto")
    few = rows.join(F.broadcast(shares), F.col("lang") == F.col("language")).where("place <= upto")
    few = few.select("language", "place").distinct()
    turn = F.row_number().over(Window.partitionBy("language").orderBy("place"))
    drawn = few.withColumn("turn", turn).orderBy("turn", F.xxhash64("language")).limit(limit)
    drawn = drawn.select("language", F.col("place").alias("spot"))
    rows = (
        rows.join(F.broadcast(drawn), (F.col("lang") == F.col("language")) & (F.col("place") == F.col("spot")))
        .select("lang", "text", "place").orderBy("place", "lang").limit(limit).toArrow()
    )
    return fit(rows["text"].to_pylist(), rows["lang"].to_pylist(), families)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score: a row for each document."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in byte_slices(batches, 2, ROWS, SIZE):
            names, score = model.predict(batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(score)],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    rows = docs.select("doc_id", (fold(F.col("doc_id")) == 2).alias("held_out"), "text")
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def op11_language_id(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return predict(docs, train(docs))
