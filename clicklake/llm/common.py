"""Helpers shared by the corpus operators."""

from __future__ import annotations

import re
import sys
import types
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clicklake.session import scratch_path

WORD = re.compile(r"\w+")
SHINGLE = 5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Narrow rows that a file of a stored table holds, more or less.
FILE_ROWS = 1 << 16


def stored(df: DataFrame, label: str, rows: int | None = None) -> DataFrame:
    """The rows written to the shared scratch folder and read back: a lost executor recomputes nothing above.

    Given about how many ``rows`` there may be, small neighbouring partitions are written by one task: many narrow tables as a file for
    each shuffle partition would cost more in files than in rows. There are always tasks enough for all cores.
    """
    path = scratch_path(df.sparkSession, label)
    if rows is not None:
        df = df.coalesce(max(4 * df.sparkSession.sparkContext.defaultParallelism, rows // FILE_ROWS))
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def join_often(rows: DataFrame, facts: DataFrame, key: str, weight: str, total: int, share: int = 1000) -> DataFrame:
    """``rows`` joined with ``facts``, which has one row for each key and how many rows have it (``weight``, of ``total``).

    Keys with more than one in ``share`` of all rows are fewer than ``share``, so they are broadcast and no task gets all their rows;
    the others are joined as usual.
    """
    often = F.col(weight) * share > total
    hot = facts.where(often)
    rest = rows.join(F.broadcast(hot.select(key)), key, "left_anti")
    return rows.join(F.broadcast(hot), key).unionByName(rest.join(facts.where(~often), key))


def ascii_lower(column):
    """A-Z lower-cased; other letters stay."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def worker_cache(name: str) -> dict:
    """A dictionary that its tasks share in a Python worker, until work of another name begins there."""
    holder = sys.modules.setdefault("clicklake_worker_cache", types.ModuleType("clicklake_worker_cache"))
    if holder.__dict__.get("name") != name:
        holder.name, holder.held = name, {}
    return holder.held


class WordHashes(dict):
    """Word -> 64-bit hash, remembered while fewer than ``limit`` words are held (about 15 MB)."""

    limit = 100_000

    def __missing__(self, word: str) -> int:
        import xxhash

        if len(self) >= self.limit:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return value


def word_hashes(text: str | None, known: WordHashes) -> np.ndarray:
    """One 64-bit hash for each word (``\\w+``, lower-cased) of the text, in order."""
    words = WORD.findall(text.lower()) if text else []
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def shingle_hashes(words: np.ndarray, width: int = SHINGLE) -> np.ndarray:
    """Hashes of all runs of ``width`` words; none when there are fewer words."""
    count = len(words) - width + 1
    if count <= 0:
        return words[:0]
    total = words[:count].copy()
    for i in range(1, width):
        total = mix(total) + words[i : i + count]
    return mix(total)


def slices(batches: Iterable, rows: int) -> Iterator:
    """Arrow record batches of at most ``rows`` rows."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column one after the other, nulls as empty, and each text's first place (and the end)."""
    column = pc.fill_null(column, "") if column.null_count else column
    wide = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, places, data = column.buffers()
    if not len(column) or data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(places, wide, len(column) + 1, column.offset * np.dtype(wide).itemsize).astype(np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def text_column(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """The string column of such bytes, without copying them."""
    return pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets), pa.py_buffer(data))


def byte_slices(batches: Iterable, place: int, rows: int, size: int) -> Iterator:
    """Arrow record batches of at most ``rows`` rows and about ``size`` bytes of text in column ``place``, one row at least."""
    for batch in batches:
        ends = text_bytes(batch.column(place))[1][1:]
        start = 0
        while start < batch.num_rows:
            upto = int(ends[start - 1] if start else 0) + size
            stop = min(start + rows, max(start + 1, int(np.searchsorted(ends, upto, "right"))))
            yield batch.slice(start, stop - start)
            start = stop
