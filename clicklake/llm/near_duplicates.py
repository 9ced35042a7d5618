"""Near-duplicates by improved consistent weighted sampling over TF-IDF shingles.

A document is the weighted set of its five-word shingles: how often each occurs, times its inverse document
frequency. Improved consistent weighted sampling draws ``BANDS * ROWS`` samples, each equal in two documents with
a chance of their weighted Jaccard similarity. Bands of samples are buckets; documents of a bucket are candidates,
and pairs are linked where the weighted Jaccard similarity of the whole documents is at least ``THRESHOLD``. Classes are
the connected components of the links.

*Document frequencies.* A weight runs from 1 (in every document) to 1.5 (in at most a share of ``COMMON`` of them), in
proportion to the logarithm. Shingles above that share are few, at most the mean length of a document over
``COMMON``, so their exact counts travel with the tasks. They are found in two passes: lossy counting in each task
gives all shingles that may be common, then those are counted in all documents.

*Samples.* The gamma and uniform variates of a shingle come from a table of 65,536 triples, by a hash of shingle and
sample number. For the weight that most shingles have, the outcome is a table as well.

*Skew.* Exact copies share a node. In a bucket every node is held against the bucket's smallest one by the share of
equal samples; only those below ``LOOSE`` are held against all others of the bucket, in blocks of about ``SIDE`` nodes
a side inside tasks. So no pair that shares a band is passed over. What hangs together this way is a candidate component. In each, nodes are verified against its smallest
node first. Only those that fail are compared with all nodes of their component, in blocks of about ``SIDE`` nodes
a side, as matrix products inside tasks that return a spanning set of the links that they find.

Defined cases: words are runs of ``\\w``, lower-cased; a text of fewer than five words is one shingle; a text without words
is in a class with equal texts only; a null text is alone, in a class named after its doc_id; equal rows share a
class. A class is named after its smallest doc_id; a text whose smallest doc_id is null, or also that of another text,
counts under a hash of its own above 2**62 instead. Long texts are taken whole; an empty table gives no rows; columns
beside doc_id and text are not read, or pass through ``distinct`` untouched.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clicklake.llm.common import (
    SHINGLE, WordHashes, byte_slices, join_often, mix, shingle_hashes, stored, table, word_hashes, worker_cache,
)
from clicklake.llm.components import components

THRESHOLD = 0.8
BANDS, ROWS = 16, 4
COMMON = 0.01
LOOSE = 0.4
SIDE = 256
SLOTS = 1 << 21
BATCH = 128
#: Letters of text that a task turns into shingles at once; a longer text is taken by itself.
SIZE = 1 << 20
TOP_WEIGHT = 1.5

_draw = np.random.default_rng(5_310_977)
_R = _draw.gamma(2.0, 1.0, 1 << 16)
_LOG_C = np.log(_draw.gamma(2.0, 1.0, 1 << 16))
_BETA = _draw.random(1 << 16)
FACTORS = _draw.integers(0, 1 << 31, BANDS * ROWS, np.uint32) * np.uint32(2) + np.uint32(1)
SHIFTS = _draw.integers(0, 1 << 32, BANDS * ROWS, np.uint32)


def _sortable(values: np.ndarray) -> np.ndarray:
    """32-bit floats as unsigned integers of the same order."""
    bits = values.astype(np.float32).view(np.uint32)
    return bits ^ np.where(bits >> np.uint32(31), np.uint32(0xFFFFFFFF), np.uint32(0x80000000))


def outcome(index: np.ndarray, weight) -> np.ndarray:
    """Logarithm of a sample's hash value, for a table place and a weight, as a sortable integer."""
    r, beta = _R[index], _BETA[index]
    t = np.floor(np.log(weight) / r + beta)
    return _sortable(_LOG_C[index] - r * (t - beta) - r)


USUAL = outcome(np.arange(1 << 16), TOP_WEIGHT)


def shingle_set(text: str | None, known: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of a text, rising, and how often each occurs."""
    words = word_hashes(text, known)
    if not len(words):
        return words, np.zeros(0, np.int64)
    return np.unique(shingle_hashes(words, min(SHINGLE, len(words))), return_counts=True)


def _known() -> WordHashes:
    return worker_cache("word hashes").setdefault("all", WordHashes())


class Weights:
    """Inverse document frequencies: exact for common shingles, the top weight for all others."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray, documents: int):
        order = np.argsort(hashes)
        self.hashes = hashes[order].astype(np.uint64)
        share = documents / np.maximum(counts[order], 1)
        self.values = 1 + (TOP_WEIGHT - 1) * np.log(np.clip(share, 1, 1 / COMMON)) / np.log(1 / COMMON)

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        out = np.full(len(hashes), TOP_WEIGHT)
        if len(self.hashes):
            at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
            common = self.hashes[at] == hashes
            out[common] = self.values[at[common]]
        return out


class LossyCounts:
    """Document frequencies within one task: each is at most ``share`` times the documents too low."""

    def __init__(self, share: float):
        self.share, self.documents = share, 0
        self.hashes, self.counts, self.slack = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, sets: list[np.ndarray]) -> None:
        before = int(self.share * self.documents)
        self.documents += len(sets)
        new, counts = np.unique(np.concatenate(sets), return_counts=True)
        merged, place = np.unique(np.concatenate([self.hashes, new]), return_inverse=True)
        total = np.bincount(place, np.concatenate([self.counts, counts]), len(merged)).astype(np.int64)
        slack = np.full(len(merged), before)
        slack[place[: len(self.hashes)]] = self.slack
        keep = total + slack > int(self.share * self.documents)
        self.hashes, self.counts, self.slack = merged[keep], total[keep], slack[keep]

    def frequent(self) -> tuple[np.ndarray, np.ndarray]:
        keep = self.counts + self.slack >= self.share * self.documents
        return self.hashes[keep], self.counts[keep]


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.astype(np.uint64).view(np.int64))


def common_shingles(docs: DataFrame, documents: int) -> Weights:
    """Weights from the exact document frequencies of all shingles in more than a share of ``COMMON``."""

    def guess(batches):
        held = LossyCounts(COMMON / 4)
        for batch in byte_slices(batches, 0, 1024, SIZE):
            held.add([shingle_set(t, _known())[0] for t in batch.column(0).to_pylist()])
        hashes, counts = held.frequent()
        for start in range(0, len(hashes), 10_000):
            part = slice(start, start + 10_000)
            yield pa.RecordBatch.from_arrays([_signed(hashes[part]), pa.array(counts[part])], names=["hash", "n"])

    texts = docs.select("text").where("text is not null")
    few = texts.coalesce(max(1, documents // 4096))
    likely = few.mapInArrow(guess, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n"))
    likely = likely.where(F.col("n") >= COMMON * documents / 2).select("hash").toArrow()
    candidates = np.sort(likely["hash"].to_numpy().view(np.uint64))
    if not len(candidates):
        return Weights(candidates, np.zeros(0, np.int64), documents)

    def count(batches):
        totals = np.zeros(len(candidates), np.int64)
        for batch in byte_slices(batches, 0, BATCH, SIZE):
            for text in batch.column(0).to_pylist():
                hashes = shingle_set(text, _known())[0]
                at = np.minimum(np.searchsorted(candidates, hashes), len(candidates) - 1)
                totals[at[candidates[at] == hashes]] += 1
        some = np.flatnonzero(totals)
        if len(some):
            yield pa.RecordBatch.from_arrays([_signed(candidates[some]), pa.array(totals[some])], names=["hash", "n"])

    exact = texts.mapInArrow(count, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n"))
    exact = exact.where(F.col("n") >= COMMON * documents).toArrow()
    return Weights(exact["hash"].to_numpy().view(np.uint64), exact["n"].to_numpy(), documents)


def samples(sets: list[tuple[np.ndarray, np.ndarray]], weights: Weights) -> np.ndarray:
    """For each (non-empty) weighted set, its samples: hash value and shingle in one integer, equal if both are."""
    hashes = np.concatenate([h for h, _ in sets])
    weight = weights(hashes) * np.concatenate([c for _, c in sets])
    odd = np.flatnonzero(weight != TOP_WEIGHT)
    starts = np.cumsum([0] + [len(h) for h, _ in sets[:-1]])
    short = mix(hashes).astype(np.uint32)
    low = short.astype(np.uint64)
    out = np.empty((len(sets), BANDS * ROWS), np.uint64)
    for k, (factor, shift) in enumerate(zip(FACTORS, SHIFTS)):
        index = (short * factor + shift) >> np.uint32(16)
        value = USUAL[index]
        if len(odd):
            value[odd] = outcome(index[odd], weight[odd])
        out[:, k] = np.minimum.reduceat(value.astype(np.uint64) << np.uint64(32) | low, starts)
    return out


def band_keys(drawn: np.ndarray) -> np.ndarray:
    """A bucket for each band of a row of samples."""
    rows = drawn.reshape(len(drawn), BANDS, ROWS)
    key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), rows.shape[:2]).copy()
    for i in range(ROWS):
        key = mix(key + rows[:, :, i])
    return key


def sketches(docs: DataFrame, weights: Weights) -> DataFrame:
    """doc_id, digest, bands and short samples (empty for a text without words): a row for each non-null text."""

    def draw(batches):
        for batch in byte_slices(batches, 2, BATCH, SIZE):
            sets = [shingle_set(t, _known()) for t in batch.column(2).to_pylist()]
            full = [i for i, (h, _) in enumerate(sets) if len(h)]
            bands, short = [[]] * len(sets), [b""] * len(sets)
            if full:
                drawn = samples([sets[i] for i in full], weights)
                keys = band_keys(drawn).view(np.int64)
                for i, row, key in zip(full, mix(drawn).astype(np.uint16), keys):
                    bands[i], short[i] = key, row.tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(bands, pa.list_(pa.int64())), pa.array(short, pa.binary())],
                names=["doc_id", "digest", "bands", "short"],
            )

    rows = docs.where("text is not null").select(F.col("doc_id").cast("long"), F.md5("text").alias("digest"), "text")
    return rows.mapInArrow(draw, "doc_id long, digest string, bands array<long>, short binary")


def make_nodes(drawn: DataFrame) -> DataFrame:
    """node, digest, first_id, bands, short, copies: a row for each different text; a node is its smallest doc_id where that is its own."""
    merged = drawn.groupBy("digest").agg(
        F.min("doc_id").alias("first_id"), F.first("bands").alias("bands"), F.first("short").alias("short"),
        F.count("*").alias("copies"),
    )
    ids = merged.select("digest", "first_id")
    hashed = F.shiftrightunsigned(F.xxhash64("digest"), 2).bitwiseOR(F.lit(1 << 62))
    turn = F.row_number().over(Window.partitionBy("first_id").orderBy("digest"))
    own = ids.where("first_id is not null").select("digest", F.when(turn == 1, F.col("first_id")).otherwise(hashed).alias("node"))
    named = own.unionByName(ids.where("first_id is null").select("digest", hashed.alias("node")))
    return merged.join(named, "digest").select("node", "digest", "first_id", "bands", "short", "copies")


def bucket_blocks(some: DataFrame, others: DataFrame, sizes: DataFrame) -> DataFrame:
    """bucket, i, j, left, node: blocks of about ``SIDE`` a side that hold ``some`` of a bucket's nodes against the ``others``.

    ``sizes`` has bucket and its number of others; some and others have bucket and node, and may have nodes in common.
    """
    blocks = (
        some.groupBy("bucket").agg(F.count("*").alias("some")).join(sizes, "bucket")
        .select("bucket", F.ceil(F.col("some") / SIDE).alias("lefts"), F.ceil(F.col("others") / SIDE).alias("rights"))
    )
    place = lambda n: F.pmod(F.xxhash64("node"), F.col(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    lefts = some.join(blocks, "bucket").select("bucket", "node", place("lefts").alias("i"), every("rights").alias("j"), F.lit(True).alias("left"))
    rights = others.join(blocks, "bucket").select("bucket", "node", every("lefts").alias("i"), place("rights").alias("j"), F.lit(False).alias("left"))
    return lefts.unionByName(rights)


def candidate_edges(nodes: DataFrame, documents: int | None = None) -> DataFrame:
    """a, b: nodes that share a bucket and enough samples; they connect what all such pairs connect.

    A bucket's pivot is its smallest node. Nodes that are close to it hang together by it. Each of the rest is compared with all nodes
    of the bucket but the pivot, in blocks inside tasks that return a spanning set of the pairs that they find.
    """

    def compare(batches):
        for batch in batches:
            left, right = (
                np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint16).reshape(batch.num_rows, -1) for i in (2, 3)
            )
            share = (left == right).mean(axis=1) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(share >= LOOSE)], names=["b", "a", "close"]
            )

    members = nodes.select("node", F.explode("bands").alias("bucket"))
    short = nodes.select("node", "short")
    shared = members.groupBy("bucket").agg(F.min("node").alias("a"), F.count("*").alias("n")).where("n > 1")
    paired = members.join(shared, "bucket").where("node > a").select("bucket", F.col("node").alias("b"), "a", "n")
    paired = stored(paired, "bucket-pairs", documents)
    pairs = (
        paired.select("a", "b")
        .distinct()
        .join(short.withColumnsRenamed({"node": "b", "short": "right"}), "b")
        .join(short.withColumnsRenamed({"node": "a", "short": "left"}), "a")
        .select("b", "a", "left", "right")
    )
    judged = stored(pairs.mapInArrow(compare, "b long, a long, close boolean"), "bucket-judged", documents)
    star = judged.where("close").select("a", "b")
    apart = paired.where("n > 2").join(judged.where(~F.col("close")), ["a", "b"])
    apart = stored(apart.select("bucket", F.col("b").alias("node"), "n"), "bucket-left", documents)
    sizes = apart.select("bucket", (F.col("n") - 1).alias("others")).distinct()
    rows = bucket_blocks(apart.select("bucket", "node"), paired.where("n > 2").select("bucket", F.col("b").alias("node")), sizes)
    rows = rows.join(short, "node").select("bucket", "i", "j", "left", "node", "short")
    rows = rows.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")

    def block(held):
        a, b = ([n for *_, side, n, _ in held if side == left] for left in (True, False))
        if not a or not b:
            return []
        one, other = (
            np.frombuffer(b"".join(s for *_, side, _, s in held if side == left), np.uint16).reshape(-1, BANDS * ROWS)
            for left in (True, False)
        )
        equal = np.zeros((len(a), len(b)), np.uint8)
        for k in range(BANDS * ROWS):
            equal += one[:, k, None] == other[None, :, k]
        return spanning((a[i], b[j]) for i, j in zip(*np.nonzero(equal >= LOOSE * BANDS * ROWS)) if a[i] != b[j])

    def grouped(batches):
        held, last = [], None
        for batch in batches:
            out = []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[:3] != last and held:
                    out += block(held)
                    held = []
                last = row[:3]
                held.append(row)
            yield _edges(out)
        yield _edges(block(held) if held else [])

    return star.unionByName(stored(rows.mapInArrow(grouped, "a long, b long"), "bucket-links", documents))


def elements(text: str, weights: Weights) -> tuple[np.ndarray, np.ndarray]:
    """A weighted set as plain elements: the n-th occurrence of a shingle is an element of its own."""
    hashes, counts = shingle_set(text, _known())
    repeat = np.repeat(np.arange(len(hashes)), counts)
    turn = (np.arange(len(repeat)) - np.repeat(np.cumsum(counts) - counts, counts)).astype(np.uint64)
    return mix(hashes[repeat] + turn * np.uint64(0x9E3779B97F4A7C15)), weights(hashes)[repeat]


def similarity(one: tuple[np.ndarray, np.ndarray], other: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two sets of elements."""
    shared = one[1][np.isin(one[0], other[0])].sum()
    union = one[1].sum() + other[1].sum() - shared
    return float(shared / union) if union else 1.0


def similarities(one: list, other: list) -> np.ndarray:
    """All weighted Jaccard similarities between two bounded lists of sets, by a product of incidence matrices."""
    sets = [*one, *other]
    owner = np.repeat(np.arange(len(sets)), [len(e) for e, _ in sets])
    names, column, count = np.unique(np.concatenate([e for e, _ in sets]), return_inverse=True, return_counts=True)
    weight = np.concatenate([w for _, w in sets])
    total = np.array([w.sum() for _, w in sets])
    shared = np.zeros((len(one), len(other)))
    number = np.cumsum(count > 1) - 1
    often = count[column] > 1
    owner, column, weight = owner[often], number[column[often]], weight[often]
    order = np.argsort(column, kind="stable")
    owner, column, weight = owner[order], column[order], weight[order]
    step = 4096
    for start in range(0, int(number[-1]) + 1 if len(number) else 0, step):
        a, b = np.searchsorted(column, [start, start + step])
        matrix = np.zeros((len(sets), step))
        matrix[owner[a:b], column[a:b] - start] = np.sqrt(weight[a:b])
        shared += matrix[: len(one)] @ matrix[len(one) :].T
    return shared / np.maximum(total[: len(one), None] + total[None, len(one) :] - shared, 1e-12)


def spanning(pairs) -> list[tuple[int, int]]:
    """Of some edges, enough to connect what they all connect."""
    parent: dict[int, int] = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    out = []
    for a, b in pairs:
        if (ra := root(a)) != (rb := root(b)):
            parent[ra] = rb
            out.append((a, b))
    return out


def verified_links(labels: DataFrame, texts: DataFrame, weights: Weights, documents: int | None = None) -> DataFrame:
    """a, b: links that connect what all links within the candidate components connect.

    ``labels`` has node and label (its component's smallest node), ``texts`` the text of every such node.
    """
    sizes = stored(labels.groupBy("label").agg(F.count("*").alias("nodes")).where("nodes > 1"), "component-sizes", documents)
    total = labels.count()
    sized = join_often(labels, sizes, "label", "nodes", total)
    place = lambda n: F.pmod(F.xxhash64("node"), F.col(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    by = ["label", "i", "left", "node"]

    # a component's nodes in parts of about SIDE, each with the smallest node in front
    stars = sized.withColumn("parts", F.ceil(F.col("nodes") / SIDE))
    others = stars.where("node <> label").select("label", place("parts").alias("i"), F.lit(False).alias("left"), "node")
    bases = stars.where("node = label").select("label", every("parts").alias("i"), F.lit(True).alias("left"), "node")
    rows = others.unionByName(bases).join(texts, "node").select(*by, "text")
    rows = rows.repartition("label", "i").sortWithinPartitions("label", "i", F.desc("left"), "node")

    def star(batches):
        last, held = None, None
        for batch in byte_slices(batches, 4, SIDE, SIZE):
            found = []
            for label, i, base, node, text in zip(*(c.to_pylist() for c in batch.columns)):
                if base:
                    last, held = (label, i), elements(text, weights)
                elif last == (label, i):
                    found.append((node, label, similarity(held, elements(text, weights)) >= THRESHOLD))
            columns = [pa.array([f[k] for f in found], kind) for k, kind in enumerate((pa.int64(), pa.int64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "close"])

    judged = stored(rows.mapInArrow(star, "a long, b long, close boolean"), "star-links", documents)
    links = judged.where("close").select("a", "b")
    # a component of two is settled by its star
    large = sizes.where("nodes > 2")
    apart = judged.where(~F.col("close")).select(F.col("a").alias("node"), F.col("b").alias("label"))
    counted = apart.groupBy("label").agg(F.count("*").alias("apart"))
    blocks = stored(
        counted.join(large, "label")
        .select("label", "nodes", "apart", F.ceil(F.col("apart") / SIDE).alias("lefts"), F.ceil(F.col("nodes") / SIDE).alias("rights")),
        "component-blocks", documents,
    )
    by = ["label", "i", "j", "left", "node"]
    lefts = join_often(apart, blocks, "label", "nodes", total)
    lefts = lefts.select("label", place("lefts").alias("i"), every("rights").alias("j"), F.lit(True).alias("left"), "node")
    rights = join_often(labels, blocks, "label", "nodes", total)
    rights = rights.select("label", every("lefts").alias("i"), place("rights").alias("j"), F.lit(False).alias("left"), "node")
    rows = lefts.unionByName(rights).join(texts, "node").select(*by, "text")
    rows = rows.repartition("label", "i", "j").sortWithinPartitions(*by)

    def compare(held):
        left, right = ([(n, t) for *_, side, n, t in held if side == which] for which in (True, False))
        found = []
        for some in portions(left):
            one = [elements(t, weights) for _, t in some]
            for others in portions(right):
                close = similarities(one, [elements(t, weights) for _, t in others]) >= THRESHOLD
                found += [(some[i][0], others[j][0]) for i, j in zip(*np.nonzero(close)) if some[i][0] != others[j][0]]
        return spanning(found)

    def grouped(batches):
        held, last = [], None
        for batch in byte_slices(batches, 5, SIDE, SIZE):
            out = []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[:3] != last and held:
                    out += compare(held)
                    held = []
                last = row[:3]
                held.append(row)
            yield _edges(out)
        yield _edges(compare(held) if held else [])

    return links.unionByName(rows.mapInArrow(grouped, "a long, b long"))


def portions(nodes: list[tuple[int, str]]):
    """The nodes in lists of texts of about ``SIZE`` letters together, one at least."""
    held, size = [], 0
    for node in nodes:
        if held and size + len(node[1]) > SIZE:
            yield held
            held, size = [], 0
        held.append(node)
        size += len(node[1])
    if held:
        yield held


def _edges(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)], names=["a", "b"])


def texts_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """node and text for the wanted nodes (node, digest, first_id).

    Before texts are shuffled, those whose digest falls on none of the wanted nodes' places among ``SLOTS`` are dropped:
    that set has at most so many numbers, whatever the size of the corpus, and is broadcast.
    """
    slot = F.pmod(F.xxhash64("digest"), F.lit(SLOTS)).alias("slot")
    rows = docs.where("text is not null").select(F.col("doc_id").cast("long").alias("id"), F.md5("text").alias("digest"), "text")
    rows = rows.select("*", slot).join(F.broadcast(wanted.select(slot).distinct()), "slot", "left_semi")
    own = F.coalesce(F.col("id"), F.lit(0)) == F.coalesce("first_id", F.lit(0))
    return (
        rows.join(wanted, "digest").where(own).groupBy("digest", "node").agg(F.first("text").alias("text"))
        .select("node", "text")
    )


def text_classes(docs: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """(doc_id, digest) of all non-null texts; (digest, label, copies) of all different ones, texts of one class sharing a label;
    and the number of documents."""
    documents = docs.count()
    weights = common_shingles(docs, documents)
    drawn = stored(sketches(docs, weights), "sketches", documents)
    nodes = stored(make_nodes(drawn), "nodes", documents)
    near = components(candidate_edges(nodes, documents), documents)
    wanted = nodes.join(near, "node").select("node", "digest", "first_id")
    texts = stored(texts_of(docs, stored(wanted, "candidates", documents)), "candidate-texts", documents)
    classes = components(stored(verified_links(near, texts, weights, documents), "links", documents), documents)
    label = F.coalesce("label", "node").alias("label")
    labels = nodes.join(classes, "node", "left").select("digest", label, "copies")
    return drawn.select("doc_id", "digest"), stored(labels, "text-labels", documents), documents


def classes(docs: DataFrame) -> DataFrame:
    """doc_id, class_id, class_size: a row for each document."""
    ids, labels, documents = text_classes(docs)
    sizes = labels.groupBy("label").agg(F.sum("copies").alias("class_size"))
    sized = join_often(labels, stored(sizes, "class-sizes", documents), "label", "class_size", documents)
    sized = stored(sized.select("digest", F.col("label").alias("class_id"), "class_size", "copies"), "text-classes", documents)
    out = join_often(ids, sized, "digest", "copies", documents).select("doc_id", "class_id", "class_size")
    alone = docs.where("text is null").select(F.col("doc_id").cast("long"))
    return out.unionByName(alone.select("doc_id", F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("class_size")))


def distinct(docs: DataFrame) -> DataFrame:
    """One document of each class, with all its columns: the one with the smallest doc_id; documents without text stay."""
    ids, labels, _ = text_classes(docs)
    # an aggregate, not a window: each map task sends one row for each class
    order = F.struct(F.col("first_id").isNull(), "first_id", "digest").alias("least")
    firsts = ids.groupBy("digest").agg(F.min("doc_id").alias("first_id")).join(labels, "digest").select("label", order)
    chosen = firsts.groupBy("label").agg(F.min("least").alias("least")).select("least.first_id", "least.digest")
    rows = docs.where("text is not null").select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    rows = rows.withColumn("id", F.col("row.doc_id").cast("long")).withColumn("sum", F.md5("row.text"))
    same = (F.col("sum") == F.col("digest")) & F.col("id").eqNullSafe(F.col("first_id"))
    # equal rows under one id: any one of them, again by an aggregate
    kept = rows.join(chosen, same).groupBy("sum", "id").agg(F.first("row").alias("row"))
    return kept.select("row.*").unionByName(docs.where("text is null"))


def op8_near_duplicates(spark, sf_dir: str) -> DataFrame:
    return classes(table(spark, sf_dir, "documents"))
