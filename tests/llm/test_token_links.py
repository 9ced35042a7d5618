import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from clicklake.llm import pieces, token_links as tl
from clicklake.llm.common import text_bytes
from tests.llm.helpers import as_rows, documents

FIRST, SECOND = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    None, "", " ", "  ", "a", " a", "a ", "a  b", "a \n b", "a\tb\r\n", "don't can't", "x<|endoftext|>y <s> </s> <0x41>", "1 22 333",
    "word, word. Word! (x) #$%", "é èa ñ, ß. 漢字 かな", "a b c d　f", "\x1c a \x1cb", "😀 😀, é", "a▁b", "▁", "words ▁ here",
    "\x00 a\x00", "the the the the", "x" * 700, "long words " * 3000, "internationalization of tokenizers.\nAnd a new line.",
]


@pytest.fixture(scope="module")
def tokenizers():
    a = Tokenizer.from_file(FIRST)
    a.encode_special_tokens = True
    letters = [*range(33, 127), *range(161, 173), *range(174, 256)]
    decode = {chr(b): b for b in letters}
    decode |= {chr(256 + i): b for i, b in enumerate(x for x in range(256) if x not in letters)}
    return a, decode, SentencePieceProcessor(model_file=SECOND)


def aligned(tokenizers, text):
    """Token by token, on the whole text: groups of ids."""
    a, decode, b = tokenizers
    if not text:
        return []
    whole = (" " + text).encode()
    one = [(i, bytes(decode[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    other = []
    for i in b.encode(text):
        piece = b.id_to_piece(i)
        other.append((i, bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()))
    if any(b"".join(t for _, t in tokens) != whole for tokens in (one, other)):
        return []
    ends = [list(np.cumsum([len(t) for _, t in tokens])) for tokens in (one, other)]
    shared = set(ends[0]) & set(ends[1])
    groups, k, left, right = [], 0, [], []
    for (i, _), end in zip(one, ends[0]):
        left.append(i)
        if end in shared:
            while k < len(other) and ends[1][k] <= end:
                right.append(other[k][0])
                k += 1
            groups.append((left, right))
            left, right = [], []
    return groups


def brute(tokenizers, rows):
    texts = [aligned(tokenizers, t) for _, t in rows]
    links = [[(i, j) for x, y in groups for i in x for j in y] for groups in texts]
    counts = Counter(pair for held in links for pair in set(held))
    best = Counter()
    for (i, _), n in counts.items():
        best[i] = max(best[i], n)
    out = []
    for (key, _), groups, held in zip(rows, texts, links):
        told = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((
            key, sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), len(held),
            sum(counts[p] == best[p[0]] for p in held), sum(counts[p] for p in held),
            hashlib.sha256(told.encode()).hexdigest() if told else "",
        ))
    return sorted(out, key=str)


def random_texts(count, seed):
    draw = random.Random(seed)
    parts = [" ", "  ", "\n", "a", " the", " Th", "don't", "é", " ", "12", "!?", ".", "<|endoftext|>", "漢", "“x", "▁", "\t", " word", "ing", "\x1c", ",", ".\n", "*"]
    weights = [6, 1, 2] + [6] * (len(parts) - 3)
    weights[parts.index("▁")] = 0.3
    return ["".join(draw.choices(parts, weights, k=draw.randrange(14))) for _ in range(count)]


def query(spark, folder, rows, columns="doc_id long, text string"):
    spark.createDataFrame(rows, columns).repartition(3).write.parquet(str(folder / "documents.parquet"))
    return tl.op13_token_links(spark, str(folder))


def test_minimal_hash_is_a_bijection():
    draw = np.random.default_rng(1)
    for n in (0, 1, 2, 63, 1000, 40_000):
        keys = np.unique(draw.integers(0, 1 << 50, n))
        assert sorted(tl.MinimalHash(keys)(keys).tolist()) == list(range(len(keys)))
        other = tl.MinimalHash(keys)(draw.integers(0, 1 << 50, 500))
        assert n == 0 or (0 <= other.min() and other.max() < len(keys))


def test_leftover_keys_are_listed(monkeypatch):
    monkeypatch.setattr(tl, "LEVELS", 1)
    keys = np.arange(5000) * 7
    made = tl.MinimalHash(keys)
    assert len(made.rest) and sorted(made(keys).tolist()) == list(range(5000))


def test_pieces_align_like_whole_texts(tokenizers, monkeypatch):
    monkeypatch.setattr(pieces, "LIMIT", 200)
    monkeypatch.setattr(pieces, "CHUNK", 50)
    monkeypatch.setattr(tl, "MANY", 3)
    texts = ODD + random_texts(1500, 1)
    links = tl.Links(FIRST, SECOND, strings=True)
    for start in range(0, len(texts), 100):
        some = [f" {t}" if t else "" for t in texts[start : start + 100]]
        numbers, begins = links.numbers(*text_bytes(pa.array(some)))
        valid, sums = links.sums(numbers, begins)
        for i, text in enumerate(texts[start : start + 100]):
            groups = aligned(tokenizers, text)
            told = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
            own = numbers[begins[i] : begins[i + 1]]
            assert (";".join(links.text[k] for k in own) if valid[i] else "") == told, text
            each = Counter((x << tl.SHIFT) | y for left, right in groups for x in left for y in right)
            held = Counter()
            for k in own if valid[i] else []:
                at = slice(links.first[k], links.first[k] + links.count[k])
                for code, times in zip(links.codes[links.pairs[at]].tolist(), links.times[at].tolist()):
                    held[code] += times
            assert held == each
            assert sums[i].tolist() == [sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), sum(each.values())]


def test_query_matches_brute_force(spark, tokenizers, tmp_path):
    rows = list(enumerate(ODD + random_texts(120, 2)))
    assert as_rows(query(spark, tmp_path, rows)) == brute(tokenizers, rows)


def test_many_blocks_groups_slices_and_resets(spark, tokenizers, tmp_path, monkeypatch):
    # functions go to the workers by value of what they close over, so constants are set where they are read: on the driver
    monkeypatch.setattr(tl, "BLOCK", 10)
    monkeypatch.setattr(tl, "GROUP", 40)
    monkeypatch.setattr(tl, "FAN", 2)
    rows = list(enumerate(ODD[:23] + random_texts(100, 3)))
    spark.createDataFrame(rows, "doc_id long, text string").repartition(9).write.parquet(str(tmp_path / "documents.parquet"))
    table, blocks = tl.pair_table(tl.count_pairs(spark.read.parquet(str(tmp_path / "documents.parquet")), FIRST, SECOND))
    assert blocks > 8 and table.count() == blocks
    assert as_rows(tl.op13_token_links(spark, str(tmp_path))) == brute(tokenizers, rows)


def test_odd_tables(spark, tokenizers, tmp_path):
    rows = [(None, "one two three"), (None, None), (5, "x y"), (5, "x y"), (5, "other text")]
    frame = documents(spark).limit(0)
    got = query(spark, tmp_path / "a", [(k, t, 1, "z") for k, t in rows], "doc_id long, text string, n_a int, place string")
    assert as_rows(got) == brute(tokenizers, rows)
    frame.write.parquet(str(tmp_path / "none" / "documents.parquet"))
    assert as_rows(tl.op13_token_links(spark, str(tmp_path / "none"))) == []
    assert as_rows(query(spark, tmp_path / "c", [(1, None), (2, "")])) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]
