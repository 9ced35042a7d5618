import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from clicklake.llm import pieces
from clicklake.llm import token_files as tf
from tests.llm.helpers import as_rows, documents

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    None, "", " ", "  ", "a", " a", "a ", "a  b", "a \n b", "a\n \nb", "\n\n x", "a\t b", "don't can't 'll", "x<|endoftext|>y", "a <|endoftext|> b", "<|endoftext|>", "<|endoftext|> x",
    "y<|endoftext|>", "a<|endoftext|>, b. <|endoftext", "1 22 333",
    "word, word. Word! (x) #$%", "é èa ñ, ß. 漢字 かな", "a b c d e　 f", "\x1c a", "a \x1cb", "²³ x² ½,", "😀 😀, é",
    "Ǆ ǅ, ʰ.", "tail \r\n", "a,b.c", "'s 't", " 's", "x 're,", "long " * 30_000, "ordinary words, as they come.\nAnd a new line.",
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def plain(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, tf.END]


def expected(tokenizer, rows):
    out, start = [], 0
    for key, text in rows:
        ids = plain(tokenizer, text)
        out.append((key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return sorted(out, key=str)


def test_pieces_encode_like_whole_texts(tokenizer, monkeypatch):
    draw = random.Random(0)
    parts = ["a", "Word", "é", "'s", ",", ".", " ", "  ", "\n", "\t", "12", "#", " ", "漢", "don't", "ab,", "x!?", "<|endoftext|>", " Th", " the", "\u3000", "\x1c", "\u2028", "ab. ", "*", ";&", "“"]
    texts = ODD + ["".join(draw.choices(parts, k=draw.randint(1, 12))) for _ in range(3000)]
    monkeypatch.setattr(pieces, "LIMIT", 300)
    monkeypatch.setattr(pieces, "CHUNK", 100)
    encoder = pieces.PieceIds(PATH)
    for start in range(0, len(texts), 100):
        some = texts[start : start + 100]
        ids, counts = encoder.encode(pa.array(some))
        got = [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]
        assert got == [plain(tokenizer, t)[:-1] for t in some]


def test_documents_come_back_in_order(spark, tokenizer):
    docs = documents(spark, *ODD).repartition(5)
    assert as_rows(tf.encode_documents(docs)) == expected(tokenizer, list(enumerate(ODD)))


def test_the_corpus_against_plain_encoding(spark, tokenizer):
    folder = "/root/testdata/sf0.001"
    rows = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect())
    assert as_rows(tf.op10_token_files(spark, folder)) == expected(tokenizer, rows)


def test_repeated_and_null_keys(spark, tokenizer):
    docs = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b b"), (None, "c"), (0, "d"), (None, None)], "doc_id long, text string")
    got = tf.encode_documents(docs).orderBy("start").collect()
    assert [r["doc_id"] for r in got] == [None, None, 0, 1, 1, 1]
    assert [r["start"] for r in got] == [sum(r["n_tokens"] for r in got[:i]) for i in range(6)]
    assert tf.encode_documents(docs.limit(0)).count() == 0


def test_sequences_have_equal_length_and_random_access(spark, tokenizer, tmp_path):
    texts = [f"document {i} " * (i % 13) for i in range(120)]
    docs = documents(spark, *texts).repartition(3)
    manifest = tf.write_tokens(docs, f"file://{tmp_path}/tokens", PATH, tf.END, length=16, batch=4)
    files = manifest.orderBy("part").collect()
    ids = [plain(tokenizer, t) for t in texts]
    at = 0
    for row in files:
        held = sum(ids[at : at + row["documents"]], [])
        at += row["documents"]
        assert row["tokens"] == len(held) and row["sequences"] == -(-len(held) // 16)
        file = tf.TokenFile(f"{row['file']}.ids.arrow")
        for i in random.Random(1).sample(range(row["sequences"]), row["sequences"]):
            sequence, mask = file.sequence(i)
            assert len(sequence) == 8 * len(mask) == 16
            assert sequence[tf.unpacked(mask)].tolist() == held[16 * i : 16 * i + 16]
        with pa.memory_map(row["file"].removeprefix("file://") + ".ids.arrow") as source:
            stream = pa.ipc.open_stream(source)
            assert stream.schema.field("ids").type == pa.list_(pa.uint16(), 16)
            assert {b.num_rows for b in list(stream)[:-1]} <= {4}
    assert at == len(texts)


def test_access_does_not_copy(spark, tmp_path):
    manifest = tf.write_tokens(documents(spark, "some words " * 500), f"file://{tmp_path}/t", PATH, tf.END, length=8, batch=2)
    file = tf.TokenFile(f"{manifest.first()['file']}.ids.arrow")
    for view in file.sequence(5):
        address = view.__array_interface__["data"][0]
        assert file.buffer.address <= address < file.buffer.address + file.buffer.size
    elsewhere = tf.TokenFile(f"{manifest.first()['file']}.ids.arrow")
    elsewhere.local = False
    for i in (0, 5, manifest.first()["sequences"] - 1):
        assert all((a == b).all() for a, b in zip(file.sequence(i), elsewhere.sequence(i)))


def test_files_are_rolled_at_a_number_of_ids(spark, tokenizer, tmp_path, monkeypatch):
    monkeypatch.setattr(tf, "ROWS", 4)
    texts = [f"document {i} of some words" for i in range(40)]
    docs = documents(spark, *texts).repartition(2)
    manifest = tf.write_tokens(docs, f"file://{tmp_path}/t", PATH, tf.END, length=8, batch=2, roll=50)
    assert manifest.count() >= 4 and manifest.agg({"tokens": "max"}).first()[0] < 90
    assert as_rows(tf.read_documents(manifest, "long")) == expected(tokenizer, list(enumerate(texts)))


def test_files_of_failed_attempts_are_not_read(spark, tokenizer, tmp_path):
    folder = tmp_path / "t"
    manifest = tf.write_tokens(documents(spark, "a b", "c d"), f"file://{folder}", PATH, tf.END)
    (folder / "part-000000-999.ids.arrow").write_bytes(b"broken")
    (folder / "part-000000-999.docs.arrow").write_bytes(b"broken")
    assert as_rows(tf.read_documents(manifest, "long")) == expected(tokenizer, [(0, "a b"), (1, "c d")])
