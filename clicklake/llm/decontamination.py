"""Benchmark decontamination: short test items found inside long documents.

Size-partitioned MinHash containment search. A set of five-word shingles inside a far larger one has a tiny Jaccard
similarity, so items are partitioned by size into classes that double (8, 16, 32, ... shingles), and documents are
seen through windows of each class: two blocks of the class's size, one block apart, so that some window holds any
passage of that size whole. An item and the window around it then have similar sizes, and its containment bounds
their Jaccard similarity from below by about 0.2. ``FUNCTIONS`` MinHash values, each a band of its own, make a
pair with 0.2 a candidate but for one in a million. Items of fewer than ``FEW`` shingles are too small for even the smallest
window, so they are found by a second method: they are looked up by their shingle hashes themselves, and none is missed. So are items of fewer than
five words: all their words are one shingle, looked up among the document's runs of as many words. Candidates are verified by exact
containment: the share of the item's distinct shingles, as words, that the document holds.

The search is one pass over the documents without a shuffle. Items travel with the tasks in blocks of at most about
``ITEM_BLOCK``, a pass for each block, whose result is stored before the next block is read.

Defined cases: words are runs of ``\\w``, lower-cased; items and documents without a word, empty and null ones match nothing; a
document of fewer than five words can only hold items of so few; equal items and equal documents match alike, row by row; long texts are searched
whole; other columns are not looked at and pass through ``remove`` untouched. Either table may be empty.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicklake.llm.common import SHINGLE, WORD, WordHashes, byte_slices, shingle_hashes, stored, table, word_hashes, worker_cache

THRESHOLD = 0.8
FUNCTIONS = 64
ITEM_BLOCK = 20_000
BASE = 8
FEW = 4
_draw = np.random.default_rng(8_241_733)
FACTORS = _draw.integers(0, 1 << 31, FUNCTIONS, np.uint32) * np.uint32(2) + np.uint32(1)
SHIFTS = _draw.integers(0, 1 << 32, FUNCTIONS, np.uint32)


def shingles(text: str | None, width: int = SHINGLE) -> list[tuple[str, ...]]:
    """The distinct runs of ``width`` words."""
    words = WORD.findall(text.lower()) if text else []
    return list(dict.fromkeys(zip(*(words[i:] for i in range(width)))))


class ItemIndex:
    """Items of one block by size class and MinHash value."""

    def __init__(self, texts: list[str | None]):
        known = WordHashes()
        words = [word_hashes(t, known) for t in texts]
        #: words in each item's shingles, 0 in an item without words
        self.width = [min(SHINGLE, len(w)) for w in words]
        self.shingles = [frozenset(shingles(t, n)) if n else frozenset() for t, n in zip(texts, self.width)]
        sizes: dict[int, list[int]] = {}
        hashes = []
        for i, own in enumerate(words):
            hashes.append(shingle_hashes(own).astype(np.uint32))
            if (count := len(hashes[-1])) >= FEW:
                sizes.setdefault(max(BASE, 1 << count.bit_length()), []).append(i)
        bits = max(16, 4 + len(texts).bit_length())
        self.classes = []
        for size, items in sorted(sizes.items()):
            tables = []
            for factor, shift in zip(FACTORS, SHIFTS):
                least = np.array([(hashes[i] * factor + shift).min() for i in items], np.uint32)
                order = np.argsort(least, kind="stable")
                seen = np.zeros(1 << bits, bool)
                seen[least >> np.uint32(32 - bits)] = True
                tables.append((least[order], np.array(items, np.int32)[order], seen))
            self.classes.append((size, tables))
        self.bits = np.uint32(32 - bits)
        few = [(h, i) for i, hs in enumerate(hashes) if len(hs) < FEW for h in hs]
        order = np.argsort(np.array([h for h, _ in few], np.uint32), kind="stable")
        self.few = np.array([h for h, _ in few], np.uint32)[order]
        self.few_items = np.array([i for _, i in few], np.int32)[order]
        self.short: dict[int, dict[int, list[int]]] = {}
        for i, (own, n) in enumerate(zip(words, self.width)):
            if 0 < n < SHINGLE:
                self.short.setdefault(n, {}).setdefault(int(shingle_hashes(own, n)[0]), []).append(i)
        self.short_hashes = {n: np.array(sorted(items), np.uint64) for n, items in self.short.items()}

    def short_candidates(self, words: list[np.ndarray]) -> set[tuple[int, int]]:
        """Pairs of a document's place in the list and that of an item of fewer than five words."""
        found: set[tuple[int, int]] = set()
        for n, hashes in self.short_hashes.items():
            for d, own in enumerate(words):
                runs = shingle_hashes(own, n)
                at = np.minimum(np.searchsorted(hashes, runs), len(hashes) - 1)
                for hit in np.unique(runs[hashes[at] == runs]).tolist():
                    found.update((d, i) for i in self.short[n][hit])
        return found

    def candidates(self, hashes: list[np.ndarray]) -> set[tuple[int, int]]:
        """Pairs of a document's place in the list and that of an item of five words or more."""
        found: set[tuple[int, int]] = set()
        held = [(d, h) for d, h in enumerate(hashes) if len(h)]
        if held and len(self.few):
            flat = np.concatenate([h for _, h in held]).astype(np.uint32)
            owner = np.repeat([d for d, _ in held], [len(h) for _, h in held])
            left, right = (np.searchsorted(self.few, flat, side) for side in ("left", "right"))
            for hit in np.flatnonzero(left < right):
                found.update((int(owner[hit]), int(item)) for item in self.few_items[left[hit] : right[hit]])
        if not held or not self.classes:
            return found
        counts = np.array([len(h) for _, h in held])
        short = -counts % BASE
        # padded to whole blocks by repeating the last shingle, which no minimum sees
        flat = np.concatenate([np.pad(h, (0, s), mode="edge") for (_, h), s in zip(held, short)])
        lanes = np.ascontiguousarray(flat.astype(np.uint32).reshape(-1, BASE).T)
        blocks = (counts + short) // BASE
        firsts = np.cumsum(blocks) - blocks
        windows = []
        for size, tables in self.classes:
            step = size // BASE
            each = -(-blocks // step)
            owner = np.repeat(np.arange(len(held)), each)
            place = np.arange(len(owner)) - np.repeat(np.cumsum(each) - each, each)
            windows.append((np.repeat(firsts, each) + place * step, owner, owner[1:] == owner[:-1], tables))
        for k, (factor, shift) in enumerate(zip(FACTORS, SHIFTS)):
            least = (lanes * factor + shift).min(axis=0)
            for starts, owner, joined, tables in windows:
                keys, items, seen = tables[k]
                value = np.minimum.reduceat(least, starts)
                value[:-1] = np.where(joined, np.minimum(value[:-1], value[1:]), value[:-1])
                hits = np.flatnonzero(seen[value >> self.bits])
                if not len(hits):
                    continue
                left = np.searchsorted(keys, value[hits], "left")
                right = np.searchsorted(keys, value[hits], "right")
                for hit, a, b in zip(owner[hits], left, right):
                    found.update((held[hit][0], int(item)) for item in items[a:b])
        return found

    def matches(self, texts: list[str | None], threshold: float) -> list[tuple[int, int, int]]:
        """Verified pairs: place of the text, place of the item, shared shingles."""
        known = worker_cache("word hashes").setdefault("all", WordHashes())
        words = [word_hashes(t, known) for t in texts]
        pairs = self.candidates([shingle_hashes(w) for w in words]) | self.short_candidates(words)
        out, last, held = [], None, {}
        for d, i in sorted(pairs):
            if d != last:
                last, held = d, {}
            width = self.width[i]
            if width not in held:
                held[width] = frozenset(shingles(texts[d], width))
            shared = len(self.shingles[i] & held[width])
            if shared >= threshold * len(self.shingles[i]):
                out.append((d, i, shared))
        return out


def _blocks(items: DataFrame, item: str, text: str):
    """Item ids and texts, a bounded block at a time, and whether it is the last."""
    rows = items.select(F.col(item).alias("item"), F.col(text).alias("text"))
    count = rows.count()
    blocks = -(-count // ITEM_BLOCK)
    for block in range(blocks):
        part = rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block).collect()
        yield [r["item"] for r in part], [r["text"] for r in part], block == blocks - 1


def find(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """key, item, shared (shingles), shingles (of the item), containment: a row for each item found in a document."""
    kinds = [docs.schema[key].dataType.simpleString(), items.schema[item].dataType.simpleString()]
    schema = f"`{key}` {kinds[0]}, `{item}` {kinds[1]}, shared long, shingles long, containment double"
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    out = docs.sparkSession.createDataFrame([], schema)
    for ids, texts, last in _blocks(items, item, text):

        def search(batches, ids=ids, index=ItemIndex(texts)):
            kind = None
            for batch in byte_slices(batches, 1, 256, 1 << 20):
                pairs = index.matches(batch.column(1).to_pylist(), threshold)
                if not pairs:
                    continue
                kind = kind or pa.infer_type([i for i in ids if i is not None][:1])
                sizes = [len(index.shingles[i]) for _, i, _ in pairs]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array([d for d, _, _ in pairs])),
                        pa.array([ids[i] for _, i, _ in pairs], kind),
                        pa.array([s for _, _, s in pairs], pa.int64()),
                        pa.array(sizes, pa.int64()),
                        pa.array([s / n for (_, _, s), n in zip(pairs, sizes)], pa.float64()),
                    ],
                    names=[key, item, "shared", "shingles", "containment"],
                )

        found = rows.mapInArrow(search, schema)
        # stored, a block leaves the driver
        out = out.unionByName(found if last else stored(found, "items-found"))
    return out


def remove(docs: DataFrame, items: DataFrame, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents that hold no item, with all their columns."""
    place = docs.columns.index(text)
    for _, texts, last in _blocks(items, "item_id", "text"):

        def keep(batches, index=ItemIndex(texts)):
            for batch in byte_slices(batches, place, 256, 1 << 20):
                found = index.matches(batch.column(place).to_pylist(), threshold)
                mask = np.ones(batch.num_rows, bool)
                mask[[d for d, _, _ in found]] = False
                yield batch.filter(pa.array(mask))

        docs = docs.mapInArrow(keep, docs.schema)
        docs = docs if last else stored(docs, "clean-documents")
    return docs


def op2_decontamination(spark, sf_dir: str) -> DataFrame:
    return find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
