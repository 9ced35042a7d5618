"""Token files: documents as token ids in Arrow streams of fixed-size lists.

A file holds two columns, ``ids`` and ``mask``, each a list of ``length`` values in every row: the ids of its
documents one after the other, cut into sequences of equal length, a multiple of eight. The mask is true where there is an
id, false in the padding of the last sequence. Every record batch but the last has ``batch`` sequences, so all of them take
the same number of bytes, and sequence *i* is found by arithmetic; in a memory map, its ids and its mask, eight places to a byte
as Arrow keeps them, are views of the file (``TokenFile``). A byte for each place would take half as much again as the ids. Ids are 16-bit where the vocabulary allows it. Beside each file lies a ``docs`` stream: a row for each
document, with its key and its number of ids. A file is closed once it holds ``roll`` ids; a document lies in one file.

Documents are dealt by ranges of their key, so files in order of part and number hold documents in order of key. A
task writes under a name of its own attempt and reports it; the stored manifest lists what the successful
attempts wrote, so a lost executor or a second attempt leaves no trace in the result.

Texts are encoded by the tokenizers library with its default settings, each distinct piece once in a task (``pieces``).

Defined cases: a null or empty text has no ids but the closing one; rows that share a key are all written, in
order of a hash of their text; a null key comes first; a text of any length is encoded whole; the string of a special token
gives what the library makes of it; an empty table gives no file; columns beside key and text are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clicklake.llm.common import byte_slices, scratch_path, stored, table
from clicklake.llm.pieces import PieceIds

LENGTH = 2048
BATCH = 32
ROLL = 1 << 26
ROWS, SIZE = 4096, 1 << 20


def _open(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


class Writer:
    """Appends documents to one token file and the list of its documents."""

    def __init__(self, uri: str, kind: pa.DataType, width: type, length: int, batch: int):
        if length % 8:
            raise ValueError("the length of a sequence must be a multiple of eight")
        filesystem, path = _open(uri)
        filesystem.create_dir(path.rsplit("/", 1)[0], recursive=True)
        self.uri, self.length, self.batch, self.width = uri, length, batch, width
        self.sinks = [filesystem.open_output_stream(f"{path}.{name}.arrow") for name in ("ids", "docs")]
        item = pa.from_numpy_dtype(width)
        self.schema = pa.schema([("ids", pa.list_(item, length)), ("mask", pa.list_(pa.bool_(), length))])
        self.ids = pa.ipc.new_stream(self.sinks[0], self.schema)
        self.docs_schema = pa.schema([("key", kind), ("tokens", pa.int64())])
        self.docs = pa.ipc.new_stream(self.sinks[1], self.docs_schema)
        self.held = np.zeros(0, width)
        self.tokens = self.sequences = self.documents = 0

    def add(self, keys: pa.Array, ids: np.ndarray, counts: np.ndarray) -> None:
        self.docs.write_batch(pa.RecordBatch.from_arrays([keys, pa.array(counts)], schema=self.docs_schema))
        self.tokens += len(ids)
        self.documents += len(counts)
        self.held = np.concatenate([self.held, ids.astype(self.width)])
        if len(self.held) >= self.length * self.batch:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        step = self.length * self.batch
        full = len(self.held) if last else len(self.held) // step * step
        for start in range(0, full, step):
            part = self.held[start : min(start + step, full)]
            rows = -(-len(part) // self.length)
            padded = np.zeros(rows * self.length, self.width)
            padded[: len(part)] = part
            mask = np.arange(len(padded)) < len(part)
            lists = [pa.FixedSizeListArray.from_arrays(pa.array(c), type=f.type) for c, f in zip((padded, mask), self.schema)]
            self.ids.write_batch(pa.RecordBatch.from_arrays(lists, schema=self.schema))
            self.sequences += rows
        self.held = self.held[full:]

    def close(self) -> pa.RecordBatch:
        """Ends the file; its line of the manifest, but for part and number."""
        self._flush(True)
        self.ids.close()
        self.docs.close()
        for sink in self.sinks:
            sink.close()
        values = [self.uri, self.documents, self.tokens, self.sequences]
        return dict(zip(["file", "documents", "tokens", "sequences"], values))


class TokenFile:
    """Random access to the sequences of a token file: views of a local one's memory map, reads of one batch elsewhere."""

    def __init__(self, uri: str):
        filesystem, path = _open(uri)
        self.local = filesystem.type_name == "local"
        self.source = pa.memory_map(path) if self.local else filesystem.open_input_file(path)
        self.buffer = self.source.read_buffer() if self.local else None
        self.source.seek(0)
        self.schema = pa.ipc.read_schema(self.source)
        self.head = self.source.tell()
        self.batch = self.step = 0
        try:
            message = pa.ipc.read_message(self.source)
        except EOFError:
            return
        self.batch, self.step = pa.ipc.read_record_batch(message, self.schema).num_rows, self.source.tell() - self.head

    def sequence(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of sequence ``i`` and its mask in packed bits (``unpacked`` spreads them)."""
        offset = self.head + i // self.batch * self.step
        source = self.buffer[offset : offset + self.step] if self.local else self.source.read_at(self.step, offset)
        batch = pa.ipc.read_record_batch(pa.ipc.read_message(source), self.schema)
        ids = batch.column(0)[i % self.batch].values.to_numpy()
        bits = np.frombuffer(batch.column(1).values.buffers()[1], np.uint8)
        each = len(ids) // 8
        return ids, bits[i % self.batch * each : (i % self.batch + 1) * each]

    def batches(self) -> Iterator[np.ndarray]:
        """The ids of each record batch, without padding."""
        self.source.seek(0)
        for batch in pa.ipc.open_stream(self.source):
            ids, mask = (batch.column(c).flatten() for c in (0, 1))
            yield ids.to_numpy()[: mask.true_count]


def unpacked(mask: np.ndarray) -> np.ndarray:
    """A mask as one boolean for each place."""
    return np.unpackbits(mask, bitorder="little").view(bool)


def write_tokens(
    docs: DataFrame, folder: str, tokenizer: str, end: int, key: str = "doc_id", text: str = "text",
    length: int = LENGTH, batch: int = BATCH, roll: int = ROLL,
) -> DataFrame:
    """Writes the token files under ``folder``; returns their manifest: part, number, file, documents, tokens, sequences."""

    def write(batches):
        part = TaskContext.get().partitionId()
        name = f"{folder}/part-{part:06d}-{TaskContext.get().taskAttemptId()}"
        encoder = PieceIds(tokenizer)
        width = np.uint16 if len(encoder.bytes) <= 1 << 16 else np.uint32
        writer, number = None, 0

        def line():
            return pa.RecordBatch.from_pylist([{"part": part, "number": number, **writer.close()}])

        for rows in byte_slices(batches, 1, ROWS, SIZE):
            writer = writer or Writer(f"{name}-{number}", rows.column(0).type, width, length, batch)
            found, counts = encoder.encode(rows.column(1))
            ids = np.full(len(found) + len(counts), end, np.int64)
            inner = np.ones(len(ids), bool)
            inner[np.cumsum(counts + 1) - 1] = False
            ids[inner] = found
            writer.add(rows.column(0), ids, counts + 1)
            if writer.tokens >= roll:
                yield line()
                writer, number = None, number + 1
        if writer is not None:
            yield line()

    ordered = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.xxhash64(text).alias("content"))
    ordered = ordered.repartitionByRange("key", "content").sortWithinPartitions("key", "content")
    manifest = ordered.select("key", "text").mapInArrow(
        write, "part long, number long, file string, documents long, tokens long, sequences long"
    )
    # a short row for each token file: one file, and no task that encodes writes another
    return stored(manifest.repartition(1), "token-manifest")


def read_documents(manifest: DataFrame, kind: str, key: str = "doc_id") -> DataFrame:
    """From the files: key, start, n_tokens, ids_crc32 (of the ids as little-endian 32-bit integers)."""

    def read(batches):
        for batch in batches:
            for file, start in zip(*(batch.column(i).to_pylist() for i in (0, 1))):
                filesystem, path = _open(f"{file}.docs.arrow")
                with filesystem.open_input_file(path) as source:
                    listed = pa.ipc.open_stream(source).read_all().combine_chunks()
                counts = listed.column("tokens").to_numpy()
                ends = np.cumsum(counts)
                sums = np.zeros(len(counts), np.int64)
                at, place = 0, 0
                for ids in TokenFile(f"{file}.ids.arrow").batches():
                    ids = np.ascontiguousarray(ids, "<u4")
                    stop = place + len(ids)
                    while at < len(ends) and place < stop:
                        upto = min(int(ends[at]), stop)
                        sums[at] = zlib.crc32(ids[len(ids) - (stop - place) : len(ids) - (stop - upto)], int(sums[at]))
                        place = upto
                        at += place == ends[at]
                columns = [pa.array(start + ends - counts), pa.array(counts), pa.array(sums)]
                out = pa.Table.from_arrays(
                    [listed.column("key"), *columns], names=[key, "start", "n_tokens", "ids_crc32"]
                )
                yield from out.to_batches(max_chunksize=10_000)

    # one short row for each file
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.select("file", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("start"))
    files = files.repartition(max(1, manifest.count()))
    return files.mapInArrow(read, f"`{key}` {kind}, start long, n_tokens long, ids_crc32 long")


#: The end id that the query appends to each document.
END = 2


def encode_documents(docs: DataFrame, tokenizer: str | None = None, end: int = END) -> DataFrame:
    """Writes ``docs`` as token files in the shared scratch folder and reads them back, a row for each document."""
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    manifest = write_tokens(docs, scratch_path(docs.sparkSession, "token-files"), tokenizer, end)
    return read_documents(manifest, docs.schema["doc_id"].dataType.simpleString())


def op10_token_files(spark, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"))
