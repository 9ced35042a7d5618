"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes, and how often over a corpus.

Both tokenizers cut the same bytes. Offsets where a token of each ends cut a text into groups; every token of one tokenizer is
linked with every token of the other in its group. A pair of ids counts once for each document that links it.

*First pass.* Each task numbers the pairs that it meets and counts its documents for each. The distinct pairs of all tasks are
dealt to blocks by a hash, and each block gets a minimal perfect hash function: levels of bits, in each of which a key owns the
place that no other key hashes to, and keys that collide go on to the next; a key's index is the number of bits before its own.
Every task's counts become dense vectors indexed by that function, and vectors are summed as a tree, ``FAN`` at a time, until one
is left for each block. Beside it lie the keys in the same order: an index whose key is another one is no index.

*Second pass.* Documents are aligned again, and each pair is looked up. All that a document needs is a sum over its pieces, so
a task looks up a pair once, when it first meets a piece that has it. The highest count of each id of the first tokenizer has a
place for each entry of that vocabulary, whatever the corpus. The pairs travel with the tasks in groups of blocks of at
most about ``GROUP`` pairs; beyond one group the pass is repeated, and sums add up, so memory has a bound at every size.

Both passes encode each distinct blank-separated piece once in a task (``pieces``).

Defined cases: a null or empty text, and one whose tokens' bytes are not its own (it holds the second tokenizer's sign for a blank), has
no tokens: zeros and an empty string; strings of special tokens are plain text; equal rows and rows that share an id count as
documents of their own; a text of any length is aligned whole; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicklake.llm.common import byte_slices, mix, stored, table, text_bytes, worker_cache
from clicklake.llm.pieces import MARKS, PieceTable, byte_tokenizer, encode_joined, holds, joinable, spread

BLOCK = 1 << 16
GROUP = 1 << 22
FAN = 64
ROWS, SIZE = 2048, 1 << 20
#: Bits for each key in a level, and levels before what is left is listed.
ROOM, LEVELS = 1.5, 40
#: Groups of more links than this are kept as distinct pairs with their numbers.
MANY = 4096
SHIFT = 32


def piece_tokenizer(path: str):
    """The tokenizer, loaded once in a worker; each id's bytes, and their number; whether words end before marks."""
    cache = worker_cache("tokenizers")
    if path not in cache:
        from sentencepiece import SentencePieceProcessor

        tokenizer = SentencePieceProcessor(model_file=path)
        tokens = []
        for i in range(tokenizer.get_piece_size()):
            piece = tokenizer.id_to_piece(i)
            tokens.append(bytes([int(piece[3:-1], 16)]) if tokenizer.is_byte(i) else piece.replace("▁", " ").encode())
        held = [tokenizer.id_to_piece(i) for i in range(len(tokens)) if not tokenizer.is_byte(i)]
        # no entry goes from a letter to a mark, or holds a line end: what follows such a place is encoded independently
        apart = not any("\n" in p or any(x.isascii() and x.isalpha() and y in MARKS for x, y in zip(p, p[1:])) for p in held)
        cache[path] = tokenizer, tokens, np.array([len(t) for t in tokens], np.int64), apart
    return cache[path]


class MinimalHash:
    """A bijection between distinct keys and 0 .. n - 1; any other number gets an index too, so keys must be compared."""

    def __init__(self, keys: np.ndarray):
        keys = np.asarray(keys, np.int64).view(np.uint64)
        self.words, self.ranks, self.sizes = [], [], []
        before = 0
        for level in range(LEVELS):
            if not len(keys):
                break
            size = max(64, int(len(keys) * ROOM) + 63 & ~63)
            place = self._place(keys, level, size)
            once = np.bincount(place.astype(np.int64), minlength=size) == 1
            words = np.packbits(once, bitorder="little").view(np.uint64)
            each = np.bitwise_count(words).astype(np.int64)
            self.words.append(words)
            self.ranks.append(before + np.cumsum(each) - each)
            self.sizes.append(size)
            before += int(each.sum())
            keys = keys[~once[place]]
        self.rest, self.before = np.sort(keys), before

    @staticmethod
    def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return mix(keys + np.uint64((level + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) % np.uint64(size)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        keys = np.asarray(keys, np.int64).view(np.uint64)
        out = np.zeros(len(keys), np.int64)
        left = np.arange(len(keys))
        for level, (words, ranks, size) in enumerate(zip(self.words, self.ranks, self.sizes)):
            place = self._place(keys[left], level, size)
            word, bit = words[place >> np.uint64(6)], place & np.uint64(63)
            hit = (word >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1)))
            out[left[hit]] = ranks[(place >> np.uint64(6)).astype(np.int64)][hit] + below[hit]
            left = left[~hit]
        if len(left) and len(self.rest):
            out[left] = self.before + np.searchsorted(self.rest, keys[left]).clip(max=len(self.rest) - 1)
        return out


class Links(PieceTable):
    """The alignment of each piece: for texts, sums over their pieces; for pairs of ids, numbers within the task."""

    def __init__(self, first: str, second: str, strings: bool = False):
        self.a, self.a_size, self.a_added = byte_tokenizer(first, plain_specials=True)
        self.b, self.b_tokens, self.b_size, self.marks = piece_tokenizer(second)
        self.strings = strings
        super().__init__()

    def reset(self) -> None:
        super().reset()
        # for each piece: valid, tokens of both, groups, links; the place of its distinct pairs and their number
        self.facts = np.zeros((0, 5), np.int64)
        self.first, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pairs, self.times = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.codes, self.number = np.zeros(0, np.int64), {}
        self.text: list[str] = []

    def _encode_a(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.int64) for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_b(self, texts: list[str]) -> list[np.ndarray]:
        # the tokenizer puts a blank in front itself; a piece without one goes behind a letter, which is one token
        led = [t[1:] if t[0] == " " else "a" + t for t in texts]
        found = self.b.encode(led, num_threads=1)
        return [np.array(ids if t[0] == " " else ids[1:], np.int64) for t, ids in zip(texts, found)]

    def learn(self, pieces: pa.Array) -> None:
        joined = joinable(pieces) & ~holds(pieces, [*self.a_added, "▁"])
        a, a_count = encode_joined(pieces, joined, self._encode_a, self.a_size)
        b, b_count = encode_joined(pieces, joined, self._encode_b, self.b_size)
        data, offsets = text_bytes(pieces)
        size = np.diff(offsets)
        n = len(size)
        a_piece, b_piece = np.repeat(np.arange(n), a_count), np.repeat(np.arange(n), b_count)
        valid = (np.bincount(a_piece, self.a_size[a], n) == size) & (np.bincount(b_piece, self.b_size[b], n) == size)
        # bytes of the second tokenizer's tokens, where the numbers agree
        told = np.frombuffer(b"".join([self.b_tokens[i] for i in b[valid[b_piece]].tolist()]), np.uint8)
        own = spread(offsets[:-1][valid], size[valid])
        valid[np.searchsorted(offsets, own[told != data[own]], "right") - 1] = False
        of_a, of_b = valid[a_piece], valid[b_piece]
        self._align(a[of_a], a_piece[of_a], b[of_b], b_piece[of_b], valid, int(size[valid].sum()))

    def _align(self, a, a_piece, b, b_piece, valid, total) -> None:
        n = len(valid)
        a_ends, b_ends = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        shared = np.zeros(total + 1, np.uint8)
        shared[a_ends] += 1
        shared[b_ends] += 1
        ends = np.flatnonzero(shared == 2)
        groups = len(ends)
        a_group, b_group = np.searchsorted(ends, a_ends), np.searchsorted(ends, b_ends)
        a_in, b_in = np.bincount(a_group, minlength=groups), np.bincount(b_group, minlength=groups)
        a_from, b_from = np.cumsum(a_in) - a_in, np.cumsum(b_in) - b_in
        piece = a_piece[a_from] if groups else np.zeros(0, np.int64)
        links = a_in * b_in
        facts = np.column_stack([
            valid, np.bincount(a_piece, minlength=n), np.bincount(b_piece, minlength=n), np.bincount(piece, minlength=n),
            np.bincount(piece, links, minlength=n),
        ]).astype(np.int64)
        few = links <= MANY
        small = few[a_group]
        reach = b_in[a_group[small]]
        code = np.repeat(a[small] << SHIFT, reach) | b[spread(b_from[a_group[small]], reach)]
        owner = np.repeat(a_piece[small], reach)
        times = np.ones(len(code), np.int64)
        for g in np.flatnonzero(~few):
            ones, one_times = np.unique(a[a_from[g] : a_from[g] + a_in[g]], return_counts=True)
            others, other_times = np.unique(b[b_from[g] : b_from[g] + b_in[g]], return_counts=True)
            code = np.append(code, (ones[:, None] << SHIFT | others).ravel())
            times = np.append(times, np.outer(one_times, other_times).ravel())
            owner = np.append(owner, np.full(len(ones) * len(others), piece[g]))
        distinct, code = np.unique(code, return_inverse=True)
        numbers = np.fromiter(map(self.number.get, distinct.tolist(), [-1] * len(distinct)), np.int64, len(distinct))
        new = np.flatnonzero(numbers < 0)
        numbers[new] = np.arange(len(self.codes), len(self.codes) + len(new))
        self.number.update(zip(distinct[new].tolist(), numbers[new].tolist()))
        self.codes = np.append(self.codes, distinct[new])
        # the distinct pairs of each piece
        both, place = np.unique(owner * max(1, len(distinct)) + code, return_inverse=True)
        owner, pair = np.divmod(both, max(1, len(distinct)))
        count = np.bincount(owner, minlength=n)
        self.first = np.append(self.first, len(self.pairs) + np.cumsum(count) - count)
        self.count = np.append(self.count, count)
        self.pairs = np.append(self.pairs, numbers[pair])
        self.times = np.append(self.times, np.bincount(place, times, len(both)).astype(np.int64))
        self.facts = np.concatenate([self.facts, facts])
        if self.strings:
            left, right = list(map(str, a.tolist())), list(map(str, b.tolist()))
            told = [
                f"{left[i]}|{right[k]}" if m == l == 1 else f"{','.join(left[i : i + m])}|{','.join(right[k : k + l])}"
                for i, m, k, l in zip(a_from.tolist(), a_in.tolist(), b_from.tolist(), b_in.tolist())
            ]
            upto = np.cumsum(facts[:, 3])
            self.text += [";".join(told[i:j]) for i, j in zip((upto - facts[:, 3]).tolist(), upto.tolist())]

    def sums(self, numbers: np.ndarray, first: np.ndarray, *more: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each text has tokens, and for it: tokens of both, groups, links, and sums of further facts of pieces."""
        facts = np.column_stack([1 - self.facts[:, :1], self.facts[:, 1:], *more])[numbers]
        total = np.concatenate([np.zeros((1, facts.shape[1]), np.int64), np.cumsum(facts, axis=0)])
        out = np.diff(total[first], axis=0)
        valid = (out[:, 0] == 0) & (np.diff(first) > 0)
        return valid, out[:, 1:] * valid[:, None]


def _texts(text: str):
    """The text with a blank in front; none for a null or empty one."""
    return F.when(F.col(text) != "", F.concat(F.lit(" "), F.col(text))).otherwise("").alias("text")


def place(pairs: np.ndarray) -> np.ndarray:
    """A hash of 31 bits that deals pairs to blocks."""
    return (mix(pairs.view(np.uint64) + np.uint64(0x5851F42D4C957F2D)) >> np.uint64(33)).astype(np.int64)


def count_pairs(docs: DataFrame, first: str, second: str, text: str = "text") -> DataFrame:
    """part, pair, place, n: how many documents of each task link each pair of ids (``first << SHIFT | second``)."""

    def run(batches):
        part = TaskContext.get().partitionId()
        links = Links(first, second)
        counts = np.zeros(0, np.int64)

        def told():
            kept = np.flatnonzero(counts)
            for start in range(0, len(kept), 100_000):
                some = kept[start : start + 100_000]
                pairs = links.codes[some]
                columns = [np.full(len(some), part), pairs, place(pairs), counts[some]]
                yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), names=["part", "pair", "place", "n"])

        for batch in byte_slices(batches, 0, ROWS, SIZE):
            if links.full:
                yield from told()
                links.reset()
                counts = np.zeros(0, np.int64)
            numbers, begins = links.numbers(*text_bytes(batch.column(0)))
            counts = np.append(counts, np.zeros(len(links.codes) - len(counts), np.int64))
            valid, _ = links.sums(numbers, begins)
            owner = np.repeat(np.arange(len(valid)), np.diff(begins))
            owner, numbers = owner[valid[owner]], numbers[valid[owner]]
            reach = links.count[numbers]
            pairs = links.pairs[spread(links.first[numbers], reach)]
            once = np.unique(np.repeat(owner, reach) * max(1, len(counts)) + pairs) % max(1, len(counts))
            counts += np.bincount(once, minlength=len(counts))
        yield from told()

    return docs.select(_texts(text)).mapInArrow(run, "part long, pair long, place long, n long")


def _vector(values: np.ndarray) -> pa.Array:
    return pa.array([values.astype(np.int64).tobytes()], pa.binary())


def _longs(value) -> np.ndarray:
    return np.frombuffer(value, np.int64)


def pair_table(counts: DataFrame) -> tuple[DataFrame, int]:
    """block, keys, counts (vectors in the order of the block's minimal perfect hash), and the number of blocks."""
    distinct = stored(counts.select("pair", "place").distinct(), "pairs")
    blocks = -(-distinct.count() // BLOCK)
    block = (F.col("place") % F.lit(max(1, blocks))).alias("block")

    def build(table: pa.Table) -> pa.Table:
        keys = table["pair"].to_numpy()
        ordered = np.empty_like(keys)
        ordered[MinimalHash(keys)(keys)] = keys
        return pa.table({"block": table["block"][:1], "keys": _vector(ordered)})

    keyed = distinct.select(block, "pair").groupBy("block").applyInArrow(build, "block long, keys binary")
    keyed = stored(keyed, "pair-keys")

    def count(left: pa.Table, right: pa.Table) -> pa.Table:
        keys = _longs(right["keys"][0].as_py())
        vector = np.zeros(len(keys), np.int64)
        np.add.at(vector, MinimalHash(keys)(left["pair"].to_numpy()), left["n"].to_numpy())
        return pa.table({"block": right["block"][:1], "slice": right["slice"][:1], "counts": _vector(vector)})

    def add(table: pa.Table) -> pa.Table:
        total = sum(_longs(v.as_py()) for v in table["counts"])
        return pa.table({"block": table["block"][:1], "slice": table["slice"][:1], "counts": _vector(total)})

    schema = "block long, slice long, counts binary"
    some = counts.select(block, F.expr(f"part div {FAN}").alias("slice"), "pair", "n")
    there = some.select("block", "slice").distinct().join(keyed, "block")
    there = there.select(*[F.col(c).alias(c) for c in there.columns])
    by = ["block", "slice"]
    sums = stored(some.groupBy(*by).cogroup(there.groupBy(*by)).applyInArrow(count, schema), "pair-counts")
    while (sums.agg(F.max("slice")).first()[0] or 0) > 0:
        above = sums.select("block", F.expr(f"slice div {FAN}").alias("slice"), "counts")
        sums = stored(above.groupBy(*by).applyInArrow(add, schema), "pair-counts")
    return stored(keyed.join(sums.select("block", "counts"), "block"), "pair-table"), blocks


def highest(pairs: DataFrame, size: int) -> np.ndarray:
    """For each id of the first tokenizer, the highest count of its pairs; ``size`` is that of its vocabulary."""

    def run(batches):
        for batch in batches:
            for keys, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                best = np.zeros(size, np.int64)
                np.maximum.at(best, _longs(keys) >> SHIFT, _longs(counts))
                ids = np.flatnonzero(best)
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(best[ids])], names=["id", "n"])

    rows = pairs.select("keys", "counts").mapInArrow(run, "id long, n long").groupBy("id").agg(F.max("n").alias("n"))
    found = rows.toArrow()
    best = np.zeros(size, np.int64)
    best[found["id"].to_numpy()] = found["n"].to_numpy()
    return best


class Counted(Links):
    """Links with sums of the counts in some blocks of pairs, and of the links that have their first id's highest one."""

    def __init__(self, first: str, second: str, blocks: int, held: dict, best: np.ndarray, strings: bool):
        self.blocks, self.held, self.best = blocks, held, best
        super().__init__(first, second, strings)

    def reset(self) -> None:
        super().reset()
        self.n = np.zeros(0, np.int64)
        self.more = np.zeros((0, 2), np.int64)

    def learn(self, pieces: pa.Array) -> None:
        known, met, begun = len(self.codes), len(self.facts), len(self.pairs)
        super().learn(pieces)
        codes = self.codes[known:]
        block = place(codes) % max(1, self.blocks)
        order = np.argsort(block, kind="stable")
        n = np.zeros(len(codes), np.int64)
        names, starts = np.unique(block[order], return_index=True)
        for name, some in zip(names.tolist(), np.split(order, starts[1:])):
            if name in self.held:
                function, keys, counts = self.held[name]
                index = function(codes[some])
                n[some] = np.where(keys[index] == codes[some], counts[index], 0)
        self.n = np.append(self.n, n)
        pairs, times = self.pairs[begun:], self.times[begun:]
        count = self.n[pairs]
        # a pair of another group has no count here
        top = (count > 0) & (count == self.best[self.codes[pairs] >> SHIFT])
        owner = np.repeat(np.arange(len(self.facts) - met), self.count[met:])
        more = np.zeros((len(self.facts) - met, 2), np.int64)
        np.add.at(more, owner, np.column_stack([times * top, times * count]))
        self.more = np.concatenate([self.more, more])


def paths(first: str | None, second: str | None) -> tuple[str, str]:
    import public_tokenizers

    return first or public_tokenizers.path("byte_bpe_50k.json"), second or public_tokenizers.path("piece_bpe_32k.model")


NAMES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]


def align(docs: DataFrame, key: str = "doc_id", text: str = "text", first: str | None = None, second: str | None = None) -> DataFrame:
    """key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups (``a1,a2|b1;a3|b2,b3``): a row for each document."""
    first, second = paths(first, second)
    spark = docs.sparkSession
    table, blocks = pair_table(stored(count_pairs(docs, first, second, text), "pair-parts"))
    best = highest(table, len(byte_tokenizer(first, plain_specials=True)[1]))
    each = max(1, GROUP // BLOCK)
    groups = max(1, -(-blocks // each))
    zero = F.lit(0).cast("long")
    rows = docs.select(F.col(key).alias("key"), _texts(text), zero.alias("n_best"), zero.alias("count_sum"))
    kind = docs.schema[key].dataType.simpleString()
    for group in range(groups):
        part = table.where((F.col("block") >= group * each) & (F.col("block") < (group + 1) * each)).toArrow()
        held = {}
        for row in part.to_pylist():
            keys = _longs(row["keys"])
            held[row["block"]] = MinimalHash(keys), keys, _longs(row["counts"])
        shipped = spark.sparkContext.broadcast(held)
        last = group == groups - 1

        def run(batches, shipped=shipped, last=last):
            links = Counted(first, second, blocks, shipped.value, best, strings=last)
            for batch in byte_slices(batches, 1, ROWS, SIZE):
                numbers, begins = links.numbers(*text_bytes(batch.column(1)))
                valid, sums = links.sums(numbers, begins, links.more)
                before = np.column_stack([batch.column(2).to_numpy(), batch.column(3).to_numpy()])
                totals = list(map(pa.array, (before + sums[:, 4:]).T))
                if not last:
                    yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *totals], names=["key", "text", *NAMES[4:]])
                    continue
                told = [
                    ";".join(map(links.text.__getitem__, numbers[a:b].tolist())) if v else ""
                    for a, b, v in zip(begins.tolist(), begins[1:].tolist(), valid.tolist())
                ]
                columns = [*map(pa.array, sums[:, :4].T), *totals, pa.array(told, pa.string())]
                yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=[key, *NAMES, "groups"])

        if not last:
            rows = stored(rows.mapInArrow(run, f"key {kind}, text string, n_best long, count_sum long"), "pair-sums")
    return rows.mapInArrow(run, f"`{key}` {kind}, " + ", ".join(f"{n} long" for n in NAMES) + ", groups string")


def op13_token_links(spark, sf_dir: str) -> DataFrame:
    told = align(table(spark, sf_dir, "documents"))
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256)).alias("groups_sha256")
    return told.select("doc_id", *NAMES, digest)
